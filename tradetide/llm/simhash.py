"""SimHash near duplicates by pigeonhole blocks.

A fingerprint of 64 bits is cut into ``radius + 1`` blocks.  Two fingerprints
that differ in at most ``radius`` bits agree in at least one block, so rows are
joined on (block number, block value) and the Hamming distance is verified.

Only distinct fingerprints take part: copies share one and combine before any
join.  A block value with more than ``SMALL_BUCKET`` distinct fingerprints would
mean very many pairs; those buckets take an exact way whose rows grow with the
number of fingerprints alone: each fingerprint names all patterns within half the
radius of itself in the bucket, and fingerprints that name a common pattern are
linked to the smallest of them.  Two fingerprints within the radius always name
a common one, and two that do are within the radius (it is even here), so the
links reach exactly the same groups as all pairs would.

Defined results: a null or empty text has fingerprint 0, as have texts of white
space; documents with fingerprint 0 are linked like any other.  Equal rows fall
into one group.  Null ids are carried along and are never a group's name unless
the group has no other.  An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradetide.llm.bpe import per_batch, texts_of
from tradetide.llm.components import components, stored
from tradetide.llm.rows import packed, unpacked

BITS = 64
SHINGLE, RADIUS, SEED = 3, 2, 42
SMALL_BUCKET = 64
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Bit i is 1 if it is set in more than half of the shingles' hashes."""
    words = text.encode().translate(LOWER).split()
    if not words:
        return 0
    # Words of ordinary texts are joined once; shingles are then slices of it.
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:len(words) - shingle] + 1])
    digest, ones = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, len(starts), 8192):
        pieces = zip(starts[at:at + 8192].tolist(), ends[at + shingle - 1:at + shingle + 8191].tolist())
        hashes = np.array([digest(joined[a:b], seed) for a, b in pieces], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(starts), bitorder="little").tobytes(), "little")


def with_fingerprint(docs: DataFrame, text: str = "text", keep_text: bool = True,
                     shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``docs`` with ``fp``, the fingerprint as a signed long."""

    def convert(batch):
        prints = [fingerprint(t, shingle, seed) for t in texts_of(batch, text)]
        return [pa.array(np.array(prints, np.uint64).view(np.int64))]

    return per_batch(docs, convert, [] if keep_text else [text], [T.StructField("fp", T.LongType())])


def block_masks(count: int) -> list[int]:
    """Masks of ``count`` blocks of nearly equal width that cover all bits."""
    edges = [BITS * i // count for i in range(count + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]


def signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def links(prints: DataFrame, radius: int = RADIUS, small: int = SMALL_BUCKET) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` whose groups are those of all
    pairs within ``radius`` (even) bits."""
    if radius % 2 or radius < 0:
        raise ValueError("the radius must be even")
    masks = block_masks(radius + 1)
    blocks = prints.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("block"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("value"))
        for i, m in enumerate(masks)])).alias("k")).select("fp", "k.block", "k.value")
    sizes = blocks.groupBy("block", "value").agg(F.count("*").alias("n")).where("n > 1")
    # The third key keeps this shuffle apart from the one for the counts, so that
    # adaptive execution may split a large bucket.
    filled = stored(
        blocks.withColumn("zero", F.lit(0)).join(sizes.withColumn("zero", F.lit(0)), ["block", "value", "zero"])
        .drop("zero"), "simhash-blocks")
    few = filled.where(F.col("n") <= small).drop("n")
    pairs = few.alias("x").join(few.alias("y"), [
        F.col("x.block") == F.col("y.block"), F.col("x.value") == F.col("y.value"),
        F.col("x.fp") < F.col("y.fp"),
        F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= radius,
    ]).select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))
    many = filled.where(F.col("n") > small)
    flips = F.lit(None)
    for i, mask in enumerate(masks):
        free = [p for p in range(BITS) if not mask >> p & 1]
        patterns = [
            sum(1 << p for p in chosen)
            for k in range(radius // 2 + 1) for chosen in combinations(free, k)]
        flips = F.when(F.col("block") == i, F.array(*[F.lit(signed(x)) for x in patterns])).otherwise(flips)
    named = many.select("block", "fp", F.explode(flips).alias("flip")).select(
        "block", F.col("fp").bitwiseXOR(F.col("flip")).alias("pattern"), "fp")
    centres = named.groupBy("block", "pattern").agg(
        F.min("fp").alias("least"), F.count("*").alias("n")).where("n > 1").drop("n")
    stars = named.withColumn("zero", F.lit(0)).join(
        centres.withColumn("zero", F.lit(0)), ["block", "pattern", "zero"]).where("fp > least").select(
        F.col("fp").alias("a"), F.col("least").alias("b"))
    return pairs.unionByName(stars)


def groups(marked: DataFrame, key: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """(fp, component_id) for every fingerprint of ``marked``: the smallest key of its group."""
    prints = stored(marked.groupBy("fp").agg(F.min(key).alias("least")), "simhash-prints")
    linked = components(links(prints.select("fp"), radius), "simhash-links")
    named = prints.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp"))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    return stored(
        named.select("fp", "component").join(smallest, "component").select("fp", "component_id"), "simhash-groups")


def with_component(marked: DataFrame, key: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """``marked`` with ``component_id``.  Many documents may share a fingerprint: both sides
    are shuffled for this join alone, so that adaptive execution may split them."""
    return marked.join(groups(marked, key, radius), "fp")


def classes(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id of every document."""
    marked = stored(with_fingerprint(docs.select("doc_id", "text"), keep_text=False), "simhash-marked")
    return with_component(marked, "doc_id", radius).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """One document of each group, with its own columns: the smallest key's (null keys come
    last), and of several rows with that key the one with the smallest text digest.

    Decisions are made on ids, digests and fingerprints; the texts move once, for the
    join with them.
    """
    lean = docs.select(F.col(key).alias("key"), F.xxhash64("text").alias("digest"), "text")
    marked = stored(with_fingerprint(lean, keep_text=False), "simhash-marked")
    best = with_component(marked, "key", radius).withColumn("group", F.col("component_id"))
    return first_of_groups(docs, key, marked, best)


def first_of_groups(docs: DataFrame, key: str, marked: DataFrame, best: DataFrame) -> DataFrame:
    """The row of ``docs`` that stays of each group.  ``marked`` has key and digest of every
    row, ``best`` also its fp and group."""
    row = F.struct(F.col("key").isNull().alias("none"), "key", "digest")
    # A group all of whose keys are null has no name; its fingerprint stands in.
    winners = best.groupBy("group", F.when(F.col("group").isNull(), F.col("fp")).alias("of")).agg(
        F.min(row).alias("w"), F.count("*").alias("size")).select("w.key", "w.digest")
    copies = marked.groupBy("key", "digest").agg(F.count("*").alias("copies"))
    winners = stored(
        winners.alias("w").join(copies.alias("c"), F.col("w.key").eqNullSafe(F.col("c.key"))
                                & (F.col("w.digest") == F.col("c.digest"))).select("w.*", "copies"),
        "simhash-winners")
    rows = packed(docs, of_key=F.col(key), of_digest=F.xxhash64("text"))
    kept = rows.join(
        winners, F.col("of_key").eqNullSafe(F.col("key")) & (F.col("of_digest") == F.col("digest")))
    once = kept.where("copies = 1")
    again = kept.where("copies > 1").dropDuplicates(["key", "digest"])
    return unpacked(once.unionByName(again), docs.columns)
