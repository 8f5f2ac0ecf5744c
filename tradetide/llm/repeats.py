"""Substring dedup: repeated windows of words, by a compacted de Bruijn graph.

An edge of the graph is a window of ``WINDOW`` consecutive words.  Edges that
follow one another in a text and have the same least ``ANCHOR``-word hash form a
piece, a stretch of a path that every text containing it cuts at the same
places if its surroundings agree.  Pieces, not edges, go through Spark's joins:

1. Anchors that occur once in the corpus can't have a repeated edge; their
   pieces go.
2. Equal pieces meet by (anchor, digest of their words).  A piece that occurs
   twice or more is a path that doesn't branch: all its edges are repeated, and
   it stays compact.
3. At anchors where some piece is alone, paths branch.  Only there the pieces
   are opened: each lone piece and one occurrence of each repeated piece give
   their edges, and edges meet by the digest of their words.

Digests (128 bits, BLAKE2b) are taken of the source words at the coordinates a
piece or edge claims, so that equality means equal word sequences; the 64-bit
hashes only decide where pieces begin.

Hot keys: a passage that a third of all documents share is one row per document
and piece, combined before the shuffle where counted, and split by adaptive
execution where joined (each join has exchanges of its own).  Nothing collects
a group but the spans of one document, which its length bounds: rows equal in id
and text give each span once, however many they are.

Defined results: null and empty texts have no words; fewer words than a window
are kept whole; rows with the same id are documents of their own, and equal
rows repeat each other; a null id is an id like others; an empty table gives an
empty result.  Only the id and the text are read, so other columns can't clash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradetide.llm.components import stored

WINDOW, ANCHOR = 35, 8
MULTIPLIER = 0x9E3779B97F4A7C15
INVERSE = pow(MULTIPLIER, -1, 1 << 64)
PIECE_ROWS = 20_000

PIECES = "doc_id {id}, row_key bigint, anchor bigint, piece binary, start int, n int, occurs int"
EDGES = "edge binary, weight int, doc_id {id}, row_key bigint, start int"


class Powers:
    """Powers of an odd number modulo 2^64, as many as the longest text so far asked for."""

    def __init__(self, base: int):
        self.base, self.values = np.uint64(base), np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if n > len(self.values):
            size = max(n, 2 * len(self.values))
            self.values = np.concatenate([[np.uint64(1)], np.cumprod(np.full(size - 1, self.base), dtype=np.uint64)])
        return self.values[:n]


UP, DOWN = Powers(MULTIPLIER), Powers(INVERSE)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of a text: joined by single spaces, with the first and last byte of each."""

    def __init__(self, text: str):
        self.words = text.encode().split()
        self.joined = b" ".join(self.words)
        sizes = np.fromiter(map(len, self.words), np.int64, len(self.words))
        self.ends = np.cumsum(sizes + 1) - 1
        self.starts = self.ends - sizes

    def __len__(self) -> int:
        return len(self.words)

    def digest(self, start: int, end: int) -> bytes:
        """Of the words start to end - 1."""
        return hashlib.blake2b(self.joined[self.starts[start]:self.ends[end - 1]], digest_size=16).digest()

    def hashes(self) -> np.ndarray:
        """A hash of each word: differences of a running polynomial, shifted back to power 0."""
        data = np.frombuffer(self.joined, np.uint8).astype(np.uint64) + np.uint64(1)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(data * UP.upto(len(data)), dtype=np.uint64)])
        return mixed((sums[self.ends] - sums[self.starts]) * DOWN.upto(len(data))[self.starts])


def pieces(words: Words, window: int = WINDOW, anchor: int = ANCHOR):
    """(anchor hash, start, edges, occurrences of the anchor) of each piece, as arrays."""
    n = len(words) - window + 1
    if n < 1:
        return [np.zeros(0, np.int64)] * 4
    hashes, grams = words.hashes(), len(words) - anchor + 1
    code = np.zeros(grams, np.uint64)
    for i in range(anchor):
        code = code * np.uint64(MULTIPLIER) + hashes[i:i + grams]
    code = mixed(code)
    wide, least = window - anchor + 1, code
    span = 1
    while 2 * span <= wide:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < wide:
        least = np.minimum(least[:n], least[wide - span:wide - span + n])
    starts = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
    sizes = np.diff(np.append(starts, n))
    occurs = np.ones(len(starts), np.int64)
    ordered = np.sort(code)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    for i in np.flatnonzero(np.isin(least[starts], twice)).tolist() if len(twice) else ():
        a = starts[i]
        occurs[i] = np.count_nonzero(code[a:a + sizes[i] + wide - 1] == least[a])
    return [least[starts].view(np.int64), starts, sizes, occurs]


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, row_key and text.  Rows with one id but different texts have different keys."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", F.xxhash64("doc_id", text).alias("row_key"), text.alias("text"))


def id_type(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def all_pieces(rows: DataFrame, window: int, anchor: int, anchors_only: bool) -> DataFrame:
    """A row for each piece; with ``anchors_only`` just the anchor and its occurrences."""
    schema = "anchor bigint, occurs int" if anchors_only else PIECES.format(id=id_type(rows))
    schema = T._parse_datatype_string(schema)

    def run(batches):
        for batch in batches:
            got, origin, digests = [], [], []
            for row, text in enumerate(batch.column(2)):
                words = Words(text.as_py())
                found = pieces(words, window, anchor)
                got.append(found)
                if not anchors_only:
                    origin.append(np.full(len(found[0]), row))
                    digests += [
                        words.digest(a, a + n + window - 1) for a, n in zip(found[1].tolist(), found[2].tolist())]
            if not got:
                continue
            hashes, starts, sizes, occurs = (np.concatenate(x) for x in zip(*got))
            occurs = pa.array(occurs.astype(np.int32))
            if anchors_only:
                yield pa.RecordBatch.from_arrays([pa.array(hashes), occurs], names=schema.names)
                continue
            take = pa.array(np.concatenate(origin).astype(np.int64))
            whole = pa.RecordBatch.from_arrays([
                batch.column(0).take(take), batch.column(1).take(take), pa.array(hashes),
                pa.array(digests, pa.binary()), pa.array(starts.astype(np.int32)),
                pa.array(sizes.astype(np.int32)), occurs], names=schema.names)
            for at in range(0, whole.num_rows, PIECE_ROWS):
                yield whole.slice(at, PIECE_ROWS)

    return rows.mapInArrow(run, schema)


def on(left: DataFrame, right: DataFrame, names: list[str], how: str = "inner") -> DataFrame:
    """A null-safe join that keeps the left side's key columns.

    A constant among the keys keeps both sides' shuffles apart from those of the
    aggregations around, so that adaptive execution may split hot keys.
    """
    right = right.select(*[F.col(c).alias(f"_{c}" if c in names else c) for c in right.columns], F.lit(0).alias("_r"))
    same = F.col("_l") == F.col("_r")
    for c in names:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return left.withColumn("_l", F.lit(0)).join(right, same, how).drop("_l", "_r", *[f"_{c}" for c in names])


def classified(rows: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """The pieces that matter: doc_id, row_key, start, n, ``repeated`` (the piece occurs
    again), ``opened`` (its edges are wanted) and ``weight`` of those."""
    counts = all_pieces(rows, window, anchor, True).groupBy("anchor").agg(F.sum("occurs").alias("total"))
    several = stored(counts.where("total > 1").select("anchor"), "repeats-anchors")
    candidates = stored(
        on(all_pieces(rows, window, anchor, False), several, ["anchor"]).drop("occurs"), "repeats-pieces")
    kinds = candidates.groupBy("anchor", "piece").agg(
        F.count("*").alias("times"), F.min("row_key").alias("first"))
    branching = kinds.where("times = 1").select("anchor").distinct().withColumn("branches", F.lit(True))
    kinds = on(kinds, branching, ["anchor"], "left").select(
        "anchor", "piece", "times", "first", F.coalesce("branches", F.lit(False)).alias("branches"))
    return on(candidates, kinds, ["anchor", "piece"]).select(
        "doc_id", "row_key", "start", "n", (F.col("times") > 1).alias("repeated"),
        (F.col("branches") & (F.col("row_key") == F.col("first"))).alias("opened"),
        F.least("times", F.lit(2)).cast("int").alias("weight"))


def edges(rows: DataFrame, opened: DataFrame, window: int = WINDOW) -> DataFrame:
    """The edges of opened pieces, with the digest of their words."""
    asked = opened.groupBy("doc_id", "row_key").agg(
        F.collect_set(F.struct("start", "n", "weight")).alias("spans"))
    schema = T._parse_datatype_string(EDGES.format(id=id_type(rows)))
    names = schema.names

    def run(batches):
        for batch in batches:
            origin, starts, weights, digests = [], [], [], []

            def made():
                take = pa.array(origin, pa.int64())
                return pa.RecordBatch.from_arrays([
                    pa.array(digests, pa.binary()), pa.array(weights, pa.int32()), batch.column(0).take(take),
                    batch.column(1).take(take), pa.array(starts, pa.int32())], names=names)

            for row in range(batch.num_rows):
                words = Words(batch.column(2)[row].as_py())
                for span in batch.column(3)[row].as_py():
                    for at in range(span["start"], span["start"] + span["n"]):
                        origin.append(row)
                        starts.append(at)
                        weights.append(span["weight"])
                        digests.append(words.digest(at, at + window))
                if len(origin) >= PIECE_ROWS:
                    yield made()
                    origin, starts, weights, digests = [], [], [], []
            yield made()

    return on(rows, asked, ["doc_id", "row_key"]).select("doc_id", "row_key", "text", "spans").mapInArrow(run, schema)


def covered(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """doc_id, row_key, start, n: runs of n repeated windows from word ``start`` on."""
    rows = keyed(docs)
    kinds = stored(classified(rows, window, anchor), "repeats-kinds")
    found = edges(rows, kinds.where("opened"), window)
    again = found.groupBy("edge").agg(F.sum("weight").alias("times")).where("times > 1").select("edge")
    single = on(found.where("weight = 1"), again, ["edge"]).select(
        "doc_id", "row_key", "start", F.lit(1).alias("n"))
    return kinds.where("repeated").select("doc_id", "row_key", "start", "n").unionByName(single)


def cleaned(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """doc_id, ``text`` (the kept words joined by single spaces), n_words and n_removed."""
    spans = covered(docs, window, anchor).groupBy("doc_id", "row_key").agg(
        F.collect_set(F.struct("start", "n")).alias("spans"))
    rows = on(keyed(docs), spans, ["doc_id", "row_key"], "left").select("doc_id", "text", "spans")
    schema = T._parse_datatype_string(
        f"doc_id {id_type(docs)}, text string, n_words bigint, n_removed bigint")

    def run(batches):
        for batch in batches:
            texts, sizes, gone = [], [], []
            for text, spans in zip(batch.column(1), batch.column(2)):
                words = text.as_py().encode().split()
                spans = spans.as_py()
                if spans:
                    change = np.zeros(len(words) + 1, np.int64)
                    np.add.at(change, [s["start"] for s in spans], 1)
                    np.add.at(change, [s["start"] + s["n"] + window - 1 for s in spans], -1)
                    kept = [w for w, c in zip(words, np.cumsum(change).tolist()) if not c]
                else:
                    kept = words
                texts.append(b" ".join(kept).decode())
                sizes.append(len(words))
                gone.append(len(words) - len(kept))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), pa.array(sizes, pa.int64()),
                 pa.array(gone, pa.int64())], names=schema.names)

    return rows.mapInArrow(run, schema)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and SHA-256 of the kept words."""
    return cleaned(docs).select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))
