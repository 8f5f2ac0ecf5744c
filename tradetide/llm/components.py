"""Connected components of a graph given as a table of links.

Alternating large-star and small-star steps: every node hangs its larger (or
its other) neighbours on the smallest node it knows, until nothing changes.
The number of rounds grows with the logarithm of the longest chain.  No step
collects links or nodes: minima combine before the shuffle, and each round's
links are written below the shared folder, so a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradetide.session import work_dir


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """Written below the shared folder and read again: later jobs start from the files."""
    path = work_dir(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def star(links: DataFrame, large: bool) -> DataFrame:
    """Links (a > b) after one step.

    Large: each node links its larger neighbours to the smallest of itself and
    all neighbours.  Small: each node links its smaller neighbours and itself to
    the smallest of them.
    """
    if large:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = links
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("at"), F.least("a", "m").alias("m"))
    # A second key keeps the shuffle for the join apart from the one for the minima,
    # so that adaptive execution may split a node with very many links.
    joined = both.withColumn("zero", F.lit(0)).join(
        least.withColumn("zero", F.lit(0)).withColumnRenamed("zero", "z"),
        (F.col("a") == F.col("at")) & (F.col("zero") == F.col("z")))
    if large:
        out = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.explode(F.array(
            F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("l")).select("l.*")
    return out.where(F.col("a") > F.col("b")).distinct()


def components(links: DataFrame, purpose: str = "components") -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); the component is its smallest node.

    Links may come in either direction and more than once; null ends and loops are ignored.
    """
    links = stored(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), purpose)
    before = None
    while True:
        links = stored(star(star(links, large=True), large=False), purpose)
        now = links.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if before == (now["n"], now["h"]):
            break
        before = (now["n"], now["h"])
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
