"""Chat formatting by token-level assembly.

Every turn is three segments: its header, its text and its end.  Texts are
encoded by themselves, so no token spans a border, and marks are reserved ids
beyond the vocabulary that no text can produce.  Where each segment stands in its
conversation comes from prefix sums of segment lengths, and so does the loss
mask, which covers the text of assistant turns.  A conversation is its turns'
rows in order; it is never one row, so its length doesn't matter.

A text may contain a mark's written form.  Its first character is then followed
by ``ESCAPE`` + 1, and ``ESCAPE`` itself by 0; reading back undoes both.

Defined results: null roles and texts count as empty; turns are ordered by turn
(null first), role and text, so repeated turns stand side by side; a null
conversation id is a conversation of its own; an empty table gives only what is
added to it.  Other columns are left out.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradetide.llm.bpe import per_batch, texts_of, vocabulary

ESCAPE = "␛"
# The marks, in the order of their reserved ids, and other control strings
# that texts must not show unescaped.
MARKS = ["<|turn|>", "<|text|>", "<|end|>"]
OTHERS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>"]
TURN, TEXT, END = range(3)
ADDED = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
LEARNED_ROLE = "assistant"

_CONTROL = re.compile(f"{ESCAPE}|(?=(?:{'|'.join(map(re.escape, MARKS + OTHERS))}))(.)", re.S)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: ESCAPE + "0" if m[1] is None else m[1] + ESCAPE + "1", text)


def unescape(text: str) -> str:
    return text.replace(ESCAPE + "1", "").replace(ESCAPE + "0", ESCAPE)


def reserved(definition: str) -> int:
    """The first reserved id: the number of ids the vocabulary uses."""
    return len(vocabulary(definition).token_bytes)


def packed(*ids: int) -> bytes:
    return np.array(ids, "<u4").tobytes()


def assemble(turns: DataFrame, definition: str) -> DataFrame:
    """A row per turn: conv_id, turn_no, ids (the turn's part of the conversation), and in
    tokens of the whole conversation first, loss_from and loss_to (end exclusive; equal
    where nothing is learned)."""
    first = reserved(definition)

    def convert(batch):
        words = vocabulary(definition)
        heads = [packed(first + TURN) + words.encode_ordinary(escape(r)) + packed(first + TEXT)
                 for r in texts_of(batch, "role")]
        bodies = [words.encode_ordinary(escape(t)) for t in texts_of(batch, "text")]
        end = packed(first + END)
        return [
            pa.array([h + b + end for h, b in zip(heads, bodies)], pa.binary()),
            pa.array([len(h) // 4 for h in heads], pa.int64()),
            pa.array([len(b) // 4 for b in bodies], pa.int64())]

    narrow = turns.select(
        "conv_id", F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    # Order of the turns without their texts.
    narrow = narrow.withColumn("order", F.sha2("text", 256)).withColumn(
        "learned", F.col("role") == LEARNED_ROLE).withColumn("by_role", F.col("role"))
    encoded = per_batch(narrow, convert, ["text", "role"], [
        T.StructField("ids", T.BinaryType()), T.StructField("head", T.LongType()),
        T.StructField("body", T.LongType())])
    along = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "by_role", "order")
    size = F.octet_length("ids") / 4
    start = (F.sum(size).over(along.rowsBetween(Window.unboundedPreceding, 0)) - size).cast("long")
    placed = encoded.withColumn("turn_no", F.row_number().over(along) - 1).withColumn("first", start)
    loss_from = F.col("first") + F.col("head")
    return placed.select(
        "conv_id", F.col("turn_no").cast("long").alias("turn_no"), "ids", "first", loss_from.alias("loss_from"),
        F.when(F.col("learned"), loss_from + F.col("body")).otherwise(loss_from).alias("loss_to"))


def read_back(words, ids: np.ndarray, first: int) -> tuple[str, str]:
    """Role and text of a turn's ids, unescaped."""
    marks = np.flatnonzero(ids >= first)
    if ids[marks].tolist() != [first + TURN, first + TEXT, first + END] or marks[0] != 0 or marks[2] != len(ids) - 1:
        raise ValueError("a turn's marks are out of place")
    role, text = (
        unescape(words.decode(ids[a + 1:b].tobytes()).decode()) for a, b in zip(marks, marks[1:]))
    return role, text


def shown(words, ids: np.ndarray, first: int) -> int:
    """Code points of a turn written out, marks included."""
    marks = ids >= first
    return (len(words.decode(ids[~marks].tobytes()).decode())
            + sum(len(MARKS[i - first]) for i in ids[marks].tolist()))


DIGESTS = ("conv_id {id}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string,"
           " formatted_chars bigint, n_tokens bigint")


def digests(assembled: DataFrame, definition: str) -> DataFrame:
    """Read back from the assembled rows, conversation by conversation in one sorted stream:
    only the running digests of one conversation are held, whatever its length."""
    kind = assembled.schema["conv_id"].dataType.simpleString()
    schema = T._parse_datatype_string(DIGESTS.format(id=kind))
    names = schema.names

    def run(batches):
        words, first = vocabulary(definition), reserved(definition)
        open_id = state = id_kind = None

        def closed(rows, id_kind):
            kinds = [id_kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        def result():
            return (open_id, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4], state[5])

        done = []
        for batch in batches:
            id_kind = batch.schema.field(0).type
            ids_of, masks = batch.column(2), zip(batch.column(3), batch.column(4), batch.column(5))
            for conv, raw, (start, loss_from, loss_to) in zip(batch.column(0).to_pylist(), ids_of, masks):
                if state is None or conv != open_id:
                    if state is not None:
                        done.append(result())
                    open_id, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                ids = np.frombuffer(raw.as_py(), "<u4")
                role, text = read_back(words, ids, first)
                start, loss_from, loss_to = start.as_py(), loss_from.as_py(), loss_to.as_py()
                if start != state[5]:
                    raise ValueError("turns do not follow one another")
                learned = unescape(words.decode(ids[loss_from - start:loss_to - start].tobytes()).decode())
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[2] += len(learned)
                state[3].update(learned.encode())
                state[4] += shown(words, ids, first)
                state[5] += len(ids)
            if done:
                yield closed(done, id_kind)
                done = []
        if state is not None:
            yield closed([result()], id_kind)

    ordered = assembled.repartition("conv_id").sortWithinPartitions("conv_id", "turn_no")
    return ordered.mapInArrow(run, schema)


def report(conversations: DataFrame, definition: str) -> DataFrame:
    """The digests of all conversations and of the one added for its control strings."""
    added = conversations.sparkSession.createDataFrame(
        ADDED, T.StructType([conversations.schema["conv_id"], conversations.schema["turn"],
                             T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))
    turns = conversations.select("conv_id", "turn", "role", "text").unionByName(added)
    return digests(assemble(turns, definition), definition)


def report_sql() -> str:
    """The report's columns but for the number of tokens, in DuckDB's SQL."""
    escaped = f"replace(text, '{ESCAPE}', '{ESCAPE}0')"
    for mark in MARKS + OTHERS:
        escaped = f"replace({escaped}, '{mark}', '{mark[0]}{ESCAPE}1{mark[1:]}')"
    added = ", ".join(f"({c}, {t}, '{r}', '{x}')" for c, t, r, x in ADDED)
    return f"""
    with turns as (
        select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
        from (select conv_id, turn, role, text from conversations
              union all select * from (values {added}))),
    shown as (select *, {escaped} as escaped, role = '{LEARNED_ROLE}' as learned from turns)
    select conv_id, count(*) as n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), ''
                  order by turn nulls first, role, sha256(text))) as turns_sha256,
           sum(case when learned then length(text) else 0 end)::bigint as loss_chars,
           sha256(coalesce(string_agg(text, '' order by turn nulls first, role, sha256(text))
                  filter (learned), '')) as loss_sha256,
           sum({sum(map(len, MARKS))} + length(role) + length(escaped))::bigint as formatted_chars
    from shown group by conv_id"""
