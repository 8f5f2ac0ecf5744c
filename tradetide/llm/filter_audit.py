"""How filters interact: what each removes, and what others would have removed anyway.

Five filters may be applied in any order.  A document's failures are a set of
letters, so everything an order's audit asks for follows from how many documents
have which set:

1. One pass over the texts gives the failures A to D of each document, and the
   hash of its text.
2. E, "identical to the text of a smaller id", is an existential self-join: texts
   whose hash occurs under several ids are left-semi joined with the smallest id
   of each such text, on hash, exact text and smaller id.
3. The ids this marks and the other failures are put together, the letters of a
   document become one number, and documents are counted by part, number and
   labels.
4. Only these counts, 32 numbers by part and labels, are opened over the steps.

Hot texts: the inner side of the self-join has one row per text, combined before
its shuffle, and is dealt to one part for every ``COPIES_PER_PART`` copies;
the outer side's rows go to one of these parts each.  Texts that occur once never move as
long as the hashes that occur again are few enough for Spark to broadcast.

Defined results: a null text is empty; a null language is the part ``''``; rows
that share an id are documents of their own and never each other's copies; a
null id is neither smaller nor larger than another, so it never fails E, and it
has no labels; several label rows of an id count if one of them says so; labels
without a document count nothing; an empty table gives an empty result.  Other
columns are not read.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradetide.llm.bpe import per_batch, texts_of
from tradetide.llm.components import stored

LETTERS = "ABCDE"
BIT = {letter: 1 << i for i, letter in enumerate(LETTERS)}
LEAST_WORDS, LEAST_DISTINCT_PERCENT, MOST_CAPITALS_PERCENT = 200, 50, 3
CAPITALS, SYMBOLS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*|"
ORDERS = ["".join(p) for p in permutations(LETTERS)]
COPIES_PER_PART = 500
COUNTED = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def own_failures(text: str) -> int:
    """The failures A to D of one text, as bits."""
    raw = text.encode()
    words = raw.split()
    capitals = len(raw) - len(raw.translate(None, CAPITALS))
    return (
        BIT["A"] * (len(words) < LEAST_WORDS)
        | BIT["B"] * (100 * len(set(words)) < LEAST_DISTINCT_PERCENT * len(words))
        | BIT["C"] * (100 * capitals > MOST_CAPITALS_PERCENT * len(text))
        | BIT["D"] * (len(raw.translate(None, SYMBOLS)) < len(raw)))


def hashed(docs: DataFrame) -> DataFrame:
    """doc_id, part, text and its hash."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id", F.coalesce("lang", F.lit("")).alias("part"), text.alias("text"), F.xxhash64(text).alias("hash"))


def failures(docs: DataFrame) -> DataFrame:
    """doc_id, part, hash and ``bits`` (A to D) of every document."""

    def convert(batch):
        return [pa.array(np.fromiter(map(own_failures, texts_of(batch, "text")), np.int32, batch.num_rows))]

    return per_batch(hashed(docs), convert, ["text"], [T.StructField("bits", T.IntegerType())])


def copies(docs: DataFrame, facts: DataFrame) -> DataFrame:
    """doc_id, part and hash of the rows whose exact text a smaller id has too."""
    several = stored(
        facts.groupBy("hash").agg(
            F.min("doc_id").alias("least"), F.max("doc_id").alias("most"),
            F.ceil(F.count("*") / COPIES_PER_PART).alias("parts"))
        .where("least < most").select("hash", "parts"), "audit-hashes")
    rows = hashed(docs).where("doc_id is not null").join(several, "hash")
    smallest = rows.groupBy("hash", "text").agg(F.min("doc_id").alias("least"), F.max("parts").alias("parts"))
    smallest = smallest.withColumn("part_of", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    rows = rows.withColumn("part_of", F.pmod(F.xxhash64("doc_id"), F.col("parts")))
    return rows.alias("d").join(smallest.alias("s"), [
        F.col("d.hash") == F.col("s.hash"), F.col("d.part_of") == F.col("s.part_of"),
        F.col("d.text") == F.col("s.text"), F.col("s.least") < F.col("d.doc_id")],
        "left_semi").select("doc_id", "part", "hash")


def combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, bits (A to E), good, toxic and ``n``, the documents that are so."""
    facts = stored(failures(docs), "audit-facts")
    marked = copies(docs, facts).distinct().withColumn("bits", F.lit(BIT["E"])).withColumn("n", F.lit(0))
    bits = (
        facts.withColumn("n", F.lit(1)).unionByName(marked)
        .groupBy("doc_id", "part", "hash").agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n")))
    told = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    return (
        bits.withColumn("zero", F.lit(0)).join(told.withColumn("zero", F.lit(0)), ["doc_id", "zero"], "left")
        .groupBy("part", "bits", F.coalesce("good", F.lit(False)).alias("good"),
                 F.coalesce("toxic", F.lit(False)).alias("toxic"))
        .agg(F.sum("n").alias("n")))


def steps(counts: DataFrame, orders: list[str] | None = None) -> DataFrame:
    """The audit of every part, order and step; see the contract of ``audit``.

    A step's counts depend on its letter and on which letters came before it, not on
    their order: counts are first summed for each such state and then given to the steps.
    """
    orders = ORDERS if orders is None else orders
    states = {}
    for order in orders:
        for i, letter in enumerate(order):
            states.setdefault((letter, sum(BIT[x] for x in order[:i])), []).append((order, i + 1))
    state = F.explode(F.array(*[
        F.struct(F.lit(BIT[letter]).alias("own"), F.lit(before).alias("before")) for letter, before in states]))
    bits, own, before = F.col("bits"), F.col("own"), F.col("before")
    fails = bits.bitwiseAND(own) != 0
    gone = bits.bitwiseAND(before) != 0
    removed = fails & ~gone

    def total(condition):
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    # Of the orders of all filters, a failing one comes first of k failing ones in one of k.
    first = F.lit(len(ORDERS)) / F.bit_count("bits")
    by_state = (
        counts.select("*", state.alias("s")).select(*counts.columns, "s.own", "s.before")
        .groupBy("part", "own", "before").agg(
            total(~fails & ~gone).alias("kept"), total(removed).alias("removed"), total(fails & gone).alias("redundant"),
            total(bits == own).alias("unique_fails"), total(removed & F.col("good")).alias("good_lost"),
            total(removed & F.col("toxic")).alias("toxic_lost"),
            F.sum(F.when(fails, F.col("n") * first.cast("long")).otherwise(0)).alias("shapley")))
    at = F.create_map(*[x for (letter, b), found in states.items() for x in (
        F.lit(32 * BIT[letter] + b), F.array(*[
            F.struct(F.lit(o).alias("filter_order"), F.lit(i).alias("step")) for o, i in found]))])
    return by_state.select("*", F.explode(at[own * 32 + before]).alias("at")).select(
        "part", "at.filter_order", "at.step", *[F.col(c).cast("long").alias(c) for c in COUNTED])


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step and, of the part's documents, how many are ``kept`` after the
    step, ``removed`` by it, ``redundant`` (fail its filter but went earlier), ``unique_fails``
    (fail its filter only), ``good_lost`` and ``toxic_lost`` (removed here, with that label), and
    ``shapley``: what the filter removes, summed over all orders."""
    return steps(stored(combinations(docs, labels), "audit-counts"))
