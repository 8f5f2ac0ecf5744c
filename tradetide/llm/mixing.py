"""Mixing sources to target weights by Pfair scheduling.

Each source's rows are cut into blocks.  Block k of a source with weight w (a
share of all slots) is released at slot floor(k / w) and due by slot
ceil((k + 1) / w).  Slot by slot the released block with the earliest deadline
goes next, so after every slot each source is less than one block away from its
share.  Weights are whole parts of ``PARTS``; the schedule therefore repeats
after at most that many slots, is found once for one period, and block k of a
source with p parts falls on slot (k div p) * PARTS + (its slot for k mod p).

All of it is DataFrame and SQL functions; the schedule of one period is a fold
over its slots.  All rows are kept.  A source that ends leaves its slots empty:
the others go on in their own proportions, and positions stay gapless.

Defined results: a null source is a source of its own; rows that are equal in
key, source and everything else are still rows of their own and get successive
positions.  Very long texts only pass through their size or digest.  An empty table gives an empty result.  Columns of the input stay,
but those with the name of a result column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradetide.llm.components import stored
from tradetide.llm.numbering import expanded, numbered
from tradetide.llm.rows import packed, unpacked

PARTS = 1000
BLOCK_ROWS = 4
BUCKETS = 1024
TEMPERATURE = 0.7


def tempered_weights(docs: DataFrame, temperature: float = TEMPERATURE) -> DataFrame:
    """(source, weight): shares of rows, raised to a power below 1 so that small sources gain."""
    return docs.groupBy("source").agg(F.count("*").alias("n")).select(
        "source", F.pow("n", F.lit(temperature)).alias("weight"))


def in_parts(weights: DataFrame, parts: int = PARTS) -> DataFrame:
    """(source, parts, of): weights as whole parts of ``of``, by largest remainders.

    ``of`` is ``parts``, or four times the number of sources if that is more.
    Each source has one part at least.
    """
    total = weights.agg(F.sum("weight").alias("sum"), F.count("*").alias("sources")).first()
    of, sources = max(parts, 4 * total["sources"]), total["sources"]
    shares = weights.withColumn("of", F.lit(of).cast("long")).withColumn(
        "share", F.col("weight") / F.lit(total["sum"]).cast("double") * (of - sources))
    shares = shares.withColumn("whole", F.floor("share"))
    rest = of - sources - F.sum("whole").over(Window.partitionBy("of"))
    rank = F.row_number().over(Window.partitionBy("of").orderBy(
        F.desc(F.col("share") - F.col("whole")), F.col("source").asc_nulls_first()))
    return shares.select(
        "source", (1 + F.col("whole") + F.when(rank <= rest, 1).otherwise(0)).cast("long").alias("parts"), "of")


def schedule(shares: DataFrame) -> DataFrame:
    """(source, turn, slot) of one period: earliest deadline first among released blocks.

    One row holds the parts of all sources; the fold carries how many blocks each
    source has had, and the slots' picks in pieces of 64.
    """
    ranked = shares.select("source", "parts", "of").groupBy("of").agg(
        F.array_sort(F.collect_list(F.struct(
            F.coalesce("source", F.lit("")).alias("name"), F.col("source").isNull().alias("none"),
            F.col("source").alias("source"), F.col("parts").alias("parts")))).alias("all"))

    def pick(had: Column, slot: Column) -> Column:
        """Index of the source that goes next."""
        options = F.transform(F.col("all"), lambda s, i: F.struct(
            # Not yet released: after all others.
            F.when(F.get(had, i) * F.col("of") >= (slot + 1) * s["parts"], 1).otherwise(0).alias("late"),
            F.ceil((F.get(had, i) + 1) * F.col("of") / s["parts"]).alias("due"),
            # Of equal deadlines, the one whose next block is due first.
            F.ceil((F.get(had, i) + 2) * F.col("of") / s["parts"]).alias("next"),
            i.alias("i")))
        return F.array_min(options)["i"]

    long_array = "array<bigint>"
    none = F.transform(F.col("all"), lambda s: F.lit(0).cast("long"))

    def one(acc: Column, slot: Column) -> Column:
        chosen = pick(acc["had"], slot)
        return F.struct(
            F.transform(acc["had"], lambda n, i: n + F.when(i == chosen, 1).otherwise(0)).cast(long_array).alias("had"),
            F.concat(acc["piece"], F.array(chosen.cast("long"))).cast(long_array).alias("piece"))

    def many(acc: Column, first: Column) -> Column:
        done = F.aggregate(
            F.sequence(first, F.least(first + 63, F.col("of") - 1)),
            F.struct(acc["had"].alias("had"), F.array().cast(long_array).alias("piece")), one)
        # A fold of one element gives the result of the inner fold a name.
        return F.aggregate(
            F.array(done), F.struct(acc["had"].alias("had"), acc["picks"].alias("picks")),
            lambda a, d: F.struct(
                d["had"].cast(long_array).alias("had"),
                F.concat(a["picks"], F.array(d["piece"])).cast(f"array<{long_array}>").alias("picks")))

    picks = F.aggregate(
        F.sequence(F.lit(0).cast("long"), F.col("of") - 1, F.lit(64).cast("long")),
        F.struct(none.cast(long_array).alias("had"), F.array().cast(f"array<{long_array}>").alias("picks")),
        many, lambda acc: F.flatten(acc["picks"]))
    slots = ranked.withColumn("picks", picks).select(
        F.posexplode("picks").alias("slot", "i"), "all").select(
        F.get("all", F.col("i").cast("int"))["source"].alias("source"), F.col("slot").cast("long").alias("slot"))
    turn = F.row_number().over(Window.partitionBy("source").orderBy("slot")) - 1
    return slots.withColumn("turn", turn.cast("long"))


def mixed(rows: DataFrame, key: str = "doc_id", weights: DataFrame | None = None,
          block_rows: int = BLOCK_ROWS, parts: int = PARTS, ties: tuple[str, ...] = ()) -> DataFrame:
    """The mix of ``rows`` (a few narrow columns: key, source and what identifies a row).

    The columns ``ties`` only order rows that are equal in all others.  Adds ``block`` (number in
    the source), ``release``, ``deadline`` and ``slot`` in blocks, and ``position`` in rows,
    gapless from 0.
    """
    # A digest of the whole row but for ``ties``, so that a key with very many unlike rows is spread
    # over the buckets.
    others = [c for c in rows.columns if c not in (key, *ties)]
    alike = rows.groupBy(*rows.columns).agg(F.count("*").alias("copies")).withColumn(
        "key_digest", F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in [key, *others]])))
    leading = (F.conv(F.substring("key_digest", 1, 4), 16, 10).cast("int") * BUCKETS / 65536).cast("int")
    order = ["key_digest", *[F.col(c).asc_nulls_first() for c in rows.columns]]
    started = numbered(alike, ["source"], leading, order, "copies", "first_row", "mixing-rows")
    numbers = expanded(started, "copies", "first_row", "row").withColumn(
        "block", F.floor(F.col("row") / block_rows))
    if weights is None:
        weights = tempered_weights(rows)
    shares = stored(in_parts(weights, parts), "mixing-shares")
    period = stored(
        schedule(shares).withColumnRenamed("slot", "slot_of_turn").alias("p").join(
            shares.alias("s"), F.col("p.source").eqNullSafe(F.col("s.source")))
        .select("p.source", "turn", "slot_of_turn", "parts", "of").groupBy("source", "parts", "of").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("turn", "slot_of_turn"))),
                        lambda x: x["slot_of_turn"]).alias("slots")),
        "mixing-period")
    due = numbers.alias("n").join(period.alias("p"), F.col("n.source").eqNullSafe(F.col("p.source"))).select(
        "n.*",
        F.floor(F.col("block") * F.col("of") / F.col("parts")).alias("release"),
        F.ceil((F.col("block") + 1) * F.col("of") / F.col("parts")).alias("deadline"),
        (F.floor(F.col("block") / F.col("parts")) * F.col("of")
         + F.get("slots", F.pmod("block", "parts").cast("int"))).alias("slot"))
    # Positions: slots are cut into ranges with about as many rows each; the ranges' edges
    # need not be exact quantiles.
    due = stored(due.withColumn("one", F.lit(1).cast("long")).withColumn("_all", F.lit(0)), "mixing-due")
    edges = due.agg(F.percentile_approx(
        "slot", [i / BUCKETS for i in range(1, BUCKETS)], 10 * BUCKETS).alias("edges")).first()["edges"]
    range_of = F.size(F.filter(
        F.array(*[F.lit(e) for e in sorted(set(edges or []))]).cast("array<bigint>"), lambda e: e <= F.col("slot")))
    placed = numbered(due, ["_all"], range_of, ["slot", "row"], "one", "position", "mixing-slots")
    return placed.drop("one", "_all", "row", "key_digest")


def size() -> Column:
    return F.octet_length(F.coalesce("text", F.lit("")))


def mix_report(docs: DataFrame) -> DataFrame:
    """doc_id, source, block, release, deadline, slot and position of every document."""
    rows = docs.select("doc_id", "source", size().alias("bytes"))
    return mixed(rows).select("doc_id", "source", "block", "release", "deadline", "slot", "position")


def in_mixed_order(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """All of ``docs``, their columns unchanged, in the order of the mix: by range of
    positions over the partitions and sorted within them, so that files written from the
    result follow the mix.  The order is that of ``mix_report``.  Rows with equal key, source and
    text go to the first position of their kind.
    """
    digest = F.xxhash64("text")
    rows = docs.select(F.col(key).alias("key"), "source", size().alias("bytes"), digest.alias("digest"))
    positions = stored(
        mixed(rows, "key", ties=("digest",)).groupBy("key", "source", "digest").agg(F.min("position").alias("position")),
        "mixing-positions")
    joined = packed(docs, of_key=F.col(key), of_source=F.col("source"), of_digest=digest).join(
        positions, F.col("of_key").eqNullSafe(F.col("key")) & F.col("of_source").eqNullSafe(F.col("source"))
        & (F.col("of_digest") == F.col("digest")))
    return unpacked(joined.repartitionByRange("position").sortWithinPartitions("position"), docs.columns)
