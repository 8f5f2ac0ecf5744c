"""Quality rules: fixed base rules and thresholds adapted to language and source.

Every document gets counts over its whole text and from them the MEASURES.  For
each measure, language and source there is a quantile sketch of the documents
that pass the base rules: counts of logarithmic bins, which are the same whatever
the order rows come in, which merge by adding, and whose quantiles are right to
within a factor ``GAMMA``.  A document is dropped if a measure lies more than
``DISTANCES`` quartile distances above the upper quartile of its group or, for
the word length, as far below the lower one.  Nothing else is fixed: the
distance is at least ``LEAST_SPREAD`` of the upper quartile, so that a group of
documents that are all alike doesn't reject small differences.  Documents where
a measure is 0 or that have too few words for it are not in its sketch, so a
measure that most documents don't have is judged by those that do.

Groups with fewer than ``LEAST_ROWS`` documents in a sketch use the one of their
language, or of the corpus, merged from the same bins; if that has too few as
well, the measure drops nothing.

Defined results: a null text counts as empty and fails the base rule (fewer
than ten words); null languages and sources are groups of their own; each row
of a repeated document is judged alike; very long texts are counted whole; an
empty table gives an empty result.  Columns the rules do not know stay as they
are, but one with the name of a result column is replaced.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from tradetide.llm.bpe import per_batch, texts_of
from tradetide.llm.components import stored
from tradetide.llm.rows import packed, unpacked

BASE_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
COUNTS = [*BASE_COUNTS, "n_lines", "n_marks", "n_distinct", "n_top"]
LEAST_WORDS, MOST_REPEATED_PERCENT = 10, 20
GAMMA = 1.005
LEAST_ROWS = 50
DISTANCES = 3.5
LEAST_SPREAD = 0.05
SYMBOLS = b"#*$%&|<>"
MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())
REPEAT_WINDOW = 5

# Measure: its value in SQL, the number of words from which it says something, and
# whether documents far below the others are dropped too.
MEASURES = {
    "word_length": ("word_chars / n_words", 50, True),
    "marks": ("n_marks / word_chars", 20, False),
    "top_share": ("n_top / n_words", 50, False),
    "sameness": ("1 - ln(n_distinct) / ln(n_words)", 50, False),
    "dup_lines": ("n_dup_lines / n_lines", 20, False),
    "repeats": ("n_repeat_words / n_words", 20, False),
}


def repeated_words(words: list[bytes], size: int = REPEAT_WINDOW) -> int:
    """Words covered by windows of ``size`` words that occur twice or more in the text.

    Equal windows have equal hashes; windows whose hashes are equal are then
    compared word by word.
    """
    n = len(words) - size + 1
    if n < 2:
        return 0
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    code = np.zeros(n, np.uint64)
    for i in range(size):
        code = code * np.uint64(0x9E3779B97F4A7C15) + hashes[i:i + n]
    order = np.argsort(code, kind="stable")
    same = np.flatnonzero(code[order][1:] == code[order][:-1])
    if not len(same):
        return 0
    starts = np.unique(order[np.concatenate([same, same + 1])]).tolist()
    windows = Counter(tuple(words[i:i + size]) for i in starts)
    mask = np.zeros(len(words), bool)
    for i in starts:
        if windows[tuple(words[i:i + size])] > 1:
            mask[i:i + size] = True
    return int(mask.sum())


def counts(text: str) -> tuple[int, ...]:
    """The values of COUNTS for one text."""
    raw = text.encode()
    words = raw.split()
    in_words = sum(map(len, words))
    times = Counter(words)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text) - (len(raw) - in_words),
        len(raw) - len(raw.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(raw) - len(raw.translate(None, MARKS)),
        len(times),
        max(times.values(), default=0),
    )


def with_counts(docs: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with the COUNTS of every whole text; without the text if not ``keep_text``."""

    def convert(batch):
        rows = np.array([counts(t) for t in texts_of(batch, text)], np.int64).reshape(-1, len(COUNTS))
        return [pa.array(rows[:, i]) for i in range(len(COUNTS))]

    return per_batch(docs, convert, [] if keep_text else [text],
                     [T.StructField(c, T.LongType()) for c in COUNTS])


def measured(frame: DataFrame) -> DataFrame:
    """With the base rules' verdict and the MEASURES as columns, null where they say nothing."""
    values = {m: F.expr(f"case when n_words >= {least} then {value} end") for m, (value, least, _) in MEASURES.items()}
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    return frame.withColumns(values | {"base_failed": failed})


def sketches(frame: DataFrame) -> DataFrame:
    """Mergeable sketches: rows per language, source, measure and bin.

    A value's bin is its logarithm to the base GAMMA, rounded up."""
    values = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in MEASURES]))
    return (
        frame.where("not base_failed").select("lang", "source", values.alias("v")).where("v.value > 0")
        .groupBy("lang", "source", F.col("v.measure").alias("measure"),
                 F.ceil(F.ln("v.value") / F.lit(math.log(GAMMA))).alias("bin"))
        .agg(F.count("*").alias("n")))


def fences(sketch: DataFrame) -> DataFrame:
    """``most_`` and ``least_`` of each measure, a row for each language and source.

    ``level`` 2 is that group's own sketch, 1 the language's, 0 the corpus's.  The most
    special one with enough rows decides."""
    levels = F.explode(F.array(*[
        F.struct(
            F.lit(level).alias("level"),
            (F.col("lang") if level else F.lit(None).cast("string")).alias("over_lang"),
            (F.col("source") if level == 2 else F.lit(None).cast("string")).alias("over_source"))
        for level in (0, 1, 2)]))
    group = ["level", "over_lang", "over_source", "measure"]
    merged = (
        sketch.select("measure", "bin", "n", levels.alias("l"))
        .groupBy("l.level", "l.over_lang", "l.over_source", "measure", "bin").agg(F.sum("n").alias("n")))
    # A window holds the bins of one sketch: their number is bounded by the range of doubles.
    along = Window.partitionBy(*group).orderBy("bin")
    ranked = merged.withColumn("up_to", F.sum("n").over(along)).withColumn(
        "rows", F.sum("n").over(Window.partitionBy(*group)))

    def quantile(q):
        reached = F.min(F.when(F.col("up_to") >= F.ceil(F.col("rows") * q), F.col("bin")))
        return F.pow(F.lit(GAMMA), reached) * (2 / (GAMMA + 1))

    limits = ranked.groupBy(*group).agg(
        F.max("rows").alias("rows"), quantile(0.25).alias("low"), quantile(0.75).alias("high")
    ).where(F.col("rows") >= LEAST_ROWS)
    reach = DISTANCES * F.greatest(F.col("high") - F.col("low"), LEAST_SPREAD * F.col("high"))
    limits = limits.withColumn("most", F.col("high") + reach).withColumn("least", F.col("low") - reach)
    groups = sketch.select("lang", "source").distinct().select(
        "lang", "source", F.explode(F.array(*[F.lit(m) for m in MEASURES])).alias("measure"),
        F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("want"))
    fits = (
        F.col("limits.measure").eqNullSafe(F.col("groups.measure"))
        & F.col("over_lang").eqNullSafe(F.when(F.col("want") > 0, F.col("lang")))
        & F.col("over_source").eqNullSafe(F.when(F.col("want") == 2, F.col("source")))
        & (F.col("level") == F.col("want")))
    chosen = groups.alias("groups").join(limits.alias("limits"), fits)

    def deciding(measure: str, limit: str):
        own = F.col("groups.measure") == measure
        return F.max_by(F.when(own, F.col(limit)), F.when(own, F.col("level"))).alias(f"{limit}_{measure}")

    return chosen.groupBy("lang", "source").agg(*[
        deciding(m, limit) for m, (_, _, both) in MEASURES.items() for limit in ("most", "least")[:1 + both]])


def judge(frame: DataFrame, limits: DataFrame) -> DataFrame:
    """``frame`` (measured) with ``failed``, the names of the measures beyond their thresholds,
    and ``kept``.  ``limits`` has one row per language and source and is read from a table, so
    that Spark knows its size and only broadcasts it if it is small."""
    names = [c for c in limits.columns if c not in ("lang", "source")]
    limits = limits.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), *names)
    joined = frame.join(
        limits,
        F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    failed = F.concat_ws(",", *[
        F.when((F.col(m) > F.col(f"most_{m}")) | ((F.col(m) < F.col(f"least_{m}")) if both else F.lit(False)), m)
        for m, (_, _, both) in MEASURES.items()])
    return joined.withColumn("failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("failed") == "")).drop("_lang", "_source", *names)


def verdicts(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed, kept, the other counts and the measures that failed."""
    frame = measured(stored(
        with_counts(docs.select("doc_id", "lang", "source", "text"), keep_text=False), "quality-counts"))
    limits = stored(fences(sketches(frame)), "quality-limits")
    return judge(frame, limits).select(
        "doc_id", *BASE_COUNTS, "base_failed", "kept", *COUNTS[len(BASE_COUNTS):], "failed")


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with their own columns.

    The counts are taken twice, once for the sketches and once for the verdict:
    that is cheaper than writing or shuffling every text.
    """
    lean = with_counts(docs.select("lang", "source", "text"), keep_text=False)
    limits = stored(fences(sketches(measured(lean))), "quality-limits")
    rows = packed(docs, lang=F.col("lang"), source=F.col("source"))
    return unpacked(judge(measured(with_counts(rows)), limits).where("kept"), docs.columns)
