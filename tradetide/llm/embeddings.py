"""Embedding near duplicates: an exact subspace pigeonhole join.

Vectors are scaled to length 1 and rotated by a fixed random rotation.  Two of
them have cosine c when their squared distance is 2 - 2c.  The coordinates are
cut into blocks; if the squared distance is within the limit, at least one block's
is within the limit's share for that block (its part of the coordinates).  Each
block is range-joined under its share: a tree of splits, fitted on a bounded sample,
cuts the block's space into boxes.  A point is at home in its box and a guest in
every later box within range, so each pair in range meets once, at the home of the
one in the later box.  The boxes grow in number with the points (``tree_depth``).  A
task orders its homes by splits of its own and compares each strip only with
the guests in range of it.

Pairs in range are verified by their cosine over the whole vectors; a pair that
several blocks find counts for the first of them.  Whether a block finds a pair is
decided by ``within`` alone, in every task, on turned coordinates that are computed once
per point and stored: its result for two points is the same wherever it is taken.
The cosine of the turned vectors, which are single precision, decides all pairs but
those within ``DOUBT`` of the least cosine, which is eight times what rounding can do;
these are returned as pairs and decided in double precision on the vectors themselves.

Equal vectors are one point with a multiplicity.  A task compares at most
``HOMES`` points with ``GUESTS``; larger boxes are cut into that many fragments on
both sides.  It returns the number of links of each point, a spanning forest
of the links it found and the doubtful pairs, never all pairs.

The sample decides how the work is cut, not what is found.  The number of compared
pairs still grows faster than the number of distinct vectors, by a fraction of its
square that falls as boxes are added: that is the price of missing no link.  Each
length of vectors has its own chain of jobs.

Defined results: null and zero vectors, and vectors with null or non-finite
components, link with nothing; so do vectors of different lengths with each
other.  Rows without links, null ids included, are groups of their own.  Equal
rows link with each other.  An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradetide.llm.components import components, stored

LEAST_COSINE = 0.95
BLOCK_DIMENSIONS = 8
DEEPEST, SAMPLE_BOX = 12, 8  # levels of a tree at most; sampled points for each of its boxes
HOMES, GUESTS, STRIP, PAIRS = 4096, 16384, 128, 50_000
SLACK = 1e-5  # of a block's share, and of candidates by single precision over the share
DOUBT = 1e-6
SEED = 7


def rotation(dimensions: int) -> np.ndarray:
    """A random rotation, the same in every process."""
    return np.linalg.qr(np.random.default_rng(SEED).standard_normal((dimensions, dimensions)))[0]


def block_edges(dimensions: int) -> list[tuple[int, int]]:
    count = max(1, dimensions // BLOCK_DIMENSIONS)
    cuts = np.linspace(0, dimensions, count + 1).astype(int).tolist()
    return list(zip(cuts, cuts[1:]))


def usable(column: str):
    """Whether a vector can link: finite components that are not all zero."""
    c = F.col(column)
    finite = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(c.isNotNull() & finite & F.exists(c, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def turned(vectors: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Scaled to length 1 and rotated, rounded to single precision at the end.  Scaling by the
    largest component first keeps squares within range."""
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return (vectors / np.linalg.norm(vectors, axis=1, keepdims=True) @ by).astype(np.float32)


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a to all rows of b."""
    return (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)


def split(x: np.ndarray) -> tuple[int, float]:
    """The coordinate along which points lie furthest apart, and their median there."""
    if not len(x):
        return 0, math.inf
    axis = int(x.var(axis=0).argmax())
    return axis, float(np.median(x[:, axis]))


def boxes(sample: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper corners of 2 ** depth boxes that fill the space, no point in two: upper
    faces belong to the next box.  Boxes the sample leaves empty may have no room."""
    parts = [(sample, np.full(sample.shape[1], -math.inf), np.full(sample.shape[1], math.inf))]
    for _ in range(depth):
        halves = []
        for x, low, high in parts:
            axis, at = split(x)
            left, right = high.copy(), low.copy()
            left[axis], right[axis] = min(at, high[axis]), max(at, low[axis])
            below = x[:, axis] < at
            halves += [(x[below], low, left), (x[~below], right, high)]
        parts = halves
    return np.array([p[1] for p in parts]), np.array([p[2] for p in parts])


def beyond(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances of points to boxes, one row per point."""
    total = np.zeros((len(x), len(low)))
    for k in range(x.shape[1]):
        c = x[:, k, None]
        total += np.maximum(np.maximum(low[:, k] - c, c - high[:, k]), 0) ** 2
    return total


def inside(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The box each point lies in."""
    found = np.ones((len(x), len(low)), bool)
    for k in range(x.shape[1]):
        c = x[:, k, None]
        found &= (low[:, k] <= c) & (c < high[:, k])
    return found.argmax(axis=1)


def strips(x: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """``rows`` of x in parts of at most ``STRIP``, each close together."""
    if len(rows) <= STRIP:
        return [rows] if len(rows) else []
    axis, _ = split(x[rows])
    rows = rows[np.argsort(x[rows, axis], kind="stable")]
    return strips(x, rows[:len(rows) // 2]) + strips(x, rows[len(rows) // 2:])


def within(x: np.ndarray, one: np.ndarray, two: np.ndarray, block: tuple[int, int], share: float) -> np.ndarray:
    """Whether points ``one`` and ``two`` of x (double precision) are within a block's share.
    Adding coordinate by coordinate gives the same bits whatever the number of points."""
    total = np.zeros(len(one))
    for k in range(*block):
        apart = x[one, k] - x[two, k]
        total += apart * apart
    return total <= share


def shares(blocks: list[tuple[int, int]], limit: float) -> list[float]:
    return [limit * (b - a) / blocks[-1][1] + SLACK for a, b in blocks]


def with_turned(points: DataFrame, dimensions: int) -> DataFrame:
    """cid, copies and ``x``, the turned vector."""
    by = rotation(dimensions)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = turned(matrix(batch.column(2), dimensions), by)
                ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * dimensions)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.ListArray.from_arrays(ends, pa.array(x.ravel()))],
                    names=["cid", "copies", "x"])

    return points.select("cid", "copies", "v").mapInArrow(run, "cid bigint, copies bigint, x array<float>")


def tree_depth(points: int) -> int:
    """So many levels that a box is home to about ``HOMES`` points."""
    return min(DEEPEST, math.ceil(math.log2(max(1, points / HOMES))))


HOME, OWN, FOREIGN = 0, 1, 2  # at home; the same point as a guest at home; guest from an earlier box


def placed(points: DataFrame, sample: np.ndarray, depth: int, limit: float) -> DataFrame:
    """Each point in the box where it is at home and, as a guest, in it and in all later boxes in
    range: block, cell, role.  ``sample`` are turned vectors.

    A point of the box is no nearer than the box; ``SLACK`` covers the rounding of both.
    """
    dimensions = sample.shape[1]
    blocks = block_edges(dimensions)
    trees = [boxes(sample[:, a:b], depth) for a, b in blocks]
    reach = [share + SLACK for share in shares(blocks, limit)]
    step = max(1, 2 ** 20 >> depth)

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                some = batch.slice(start, step)
                whole = matrix(some.column(2), dimensions).astype(np.float64)
                every = np.arange(len(whole))
                for number, (a, b) in enumerate(blocks):
                    x, (low, high) = whole[:, a:b], trees[number]
                    home = inside(x, low, high)
                    guest = beyond(x, low, high) <= reach[number]
                    guest &= np.arange(len(low)) > home[:, None]
                    row, cell = np.nonzero(guest)
                    for role, rows, cells in ((HOME, every, home), (OWN, every, home), (FOREIGN, row, cell)):
                        for at in range(0, len(rows), 10_000):
                            take = pa.array(rows[at:at + 10_000])
                            size = len(take)
                            yield pa.RecordBatch.from_arrays([
                                pa.array(np.full(size, number, np.int32)),
                                pa.array(cells[at:at + 10_000].astype(np.int32)),
                                pa.array(np.full(size, role, np.int32)),
                                *[some.column(i).take(take) for i in range(3)],
                            ], names=["block", "cell", "role", "cid", "copies", "x"])

    return points.select("cid", "copies", "x").mapInArrow(
        run, "block int, cell int, role int, cid bigint, copies bigint, x array<float>")


def in_fragments(cells: DataFrame) -> DataFrame:
    """Cells cut into fragments: every part of the homes with every part of the guests."""
    at_home = F.col("role") == HOME
    sizes = cells.groupBy("block", "cell").agg(
        F.ceil(F.count_if(at_home) / HOMES).cast("int").alias("h"),
        F.ceil(F.count_if(~at_home) / GUESTS).cast("int").alias("g"))
    # At most blocks x 2 ** DEEPEST rows.
    cells = cells.join(F.broadcast(sizes), ["block", "cell"])
    whole = F.sequence(F.lit(0), F.greatest(F.lit(1), F.when(at_home, F.col("g")).otherwise(F.col("h"))) - 1)
    own = F.pmod(F.xxhash64("cid"), F.when(at_home, F.col("h")).otherwise(F.col("g"))).cast("int")
    cells = cells.where("h > 0").withColumn("own", own).withColumn("other", F.explode(whole))
    return cells.select(
        "block", "cell", F.when(at_home, F.col("own")).otherwise(F.col("other")).alias("h"),
        F.when(at_home, F.col("other")).otherwise(F.col("own")).alias("g"), "role", "cid", "copies", "x")


def forest(left: list[int], right: list[int], size: int) -> list[int]:
    """Positions of pairs that join parts not joined before."""
    root = list(range(size))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    kept = []
    for i, (a, b) in enumerate(zip(left, right)):
        a, b = find(a), find(b)
        if a != b:
            root[a] = b
            kept.append(i)
    return kept


FOUND = "cid bigint, links bigint, other bigint"


def compared(fragments: DataFrame, dimensions: int, cosine: float) -> DataFrame:
    """For each fragment: rows (cid, links, other).  ``links`` counts linked vectors; ``other``
    is an end of a link of the forest or, where ``links`` is null, of a doubtful pair."""
    blocks = block_edges(dimensions)
    share = shares(blocks, 2 - 2 * cosine)

    def run(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        role = table.column("role").to_numpy()
        cid, copies = table.column("cid").to_numpy(), table.column("copies").to_numpy()
        single = matrix(table.column("x"), dimensions)
        x = single.astype(np.float64)
        lengths = np.sqrt((x * x).sum(1))
        guests = np.flatnonzero(role != HOME)
        links = np.zeros(len(cid), np.int64)
        left, right, doubt = [], [], [np.zeros((0, 2), np.int64)]
        a, b = blocks[block]
        for strip in strips(single[:, a:b], np.flatnonzero(role == HOME)):
            low, high = x[strip, a:b].min(axis=0), x[strip, a:b].max(axis=0)
            close = guests[beyond(x[guests, a:b], low[None], high[None])[:, 0] <= share[block] + SLACK]
            near = squares(single[strip, a:b], single[close, a:b]) <= share[block] + SLACK
            near &= (role[close] == FOREIGN)[None, :] | (cid[strip][:, None] < cid[close][None, :])
            i, j = np.nonzero(near)
            for part in range(0, len(i), PAIRS):
                one, two = strip[i[part:part + PAIRS]], close[j[part:part + PAIRS]]
                here = within(x, one, two, blocks[block], share[block])
                one, two = one[here], two[here]
                above = np.einsum("ij,ij->i", x[one], x[two]) / (lengths[one] * lengths[two]) - cosine
                take = above >= -DOUBT
                one, two, above = one[take], two[take], above[take]
                # Found by an earlier block?
                for k in range(block):
                    if not len(one):
                        break
                    new = ~within(x, one, two, blocks[k], share[k])
                    one, two, above = one[new], two[new], above[new]
                sure = above > DOUBT
                doubt.append(np.stack([cid[one[~sure]], cid[two[~sure]]], axis=1))
                one, two = one[sure], two[sure]
                np.add.at(links, one, copies[two])
                np.add.at(links, two, copies[one])
                kept = forest(one.tolist(), two.tolist(), len(cid))
                left += one[kept].tolist()
                right += two[kept].tolist()
        kept = forest(left, right, len(cid))
        left, right = np.array(left, np.int64)[kept], np.array(right, np.int64)[kept]
        doubt = np.concatenate(doubt)
        some = np.flatnonzero(links)
        return pa.table({
            "cid": np.concatenate([cid[some], cid[left], doubt[:, 0]]),
            "links": pa.concat_arrays([
                pa.array(links[some]), pa.array(np.zeros(len(left), np.int64)), pa.nulls(len(doubt), pa.int64())]),
            "other": np.concatenate([cid[some], cid[right], doubt[:, 1]]),
        })

    return fragments.groupBy("block", "cell", "h", "g").applyInArrow(run, FOUND)


def settled(doubtful: DataFrame, points: DataFrame, dimensions: int, cosine: float) -> DataFrame:
    """The links among doubtful pairs (cid, other), decided in double precision on the vectors."""

    def side(end: str) -> DataFrame:
        return points.select(F.col("cid").alias(end), F.col("copies").alias(f"n_{end}"), F.col("v").alias(f"v_{end}"))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            one, two = (matrix(batch.column(f"v_{end}"), dimensions).astype(np.float64) for end in ("cid", "other"))
            one, two = (v / np.abs(v).max(axis=1, keepdims=True) for v in (one, two))
            length = np.sqrt((one * one).sum(1)) * np.sqrt((two * two).sum(1))
            some = batch.filter(pa.array(np.einsum("ij,ij->i", one, two) / length >= cosine))
            for end, other in (("cid", "other"), ("other", "cid")):
                yield pa.RecordBatch.from_arrays(
                    [some.column(end), some.column(f"n_{other}"), some.column(other)], names=["cid", "links", "other"])

    both = doubtful.join(side("cid"), "cid").join(side("other"), "other")
    return both.mapInArrow(run, FOUND)


def near_points(points: DataFrame, dimensions: int, cosine: float) -> DataFrame:
    moved = stored(with_turned(points, dimensions), "embedding-turned")
    depth = tree_depth(moved.count())
    chosen = moved.orderBy(F.xxhash64("cid"), "cid").limit(SAMPLE_BOX << depth).select("x").toArrow()
    sample = matrix(chosen.column("x"), dimensions).astype(np.float64)
    cells = stored(placed(moved, sample, depth, 2 - 2 * cosine), "embedding-cells")
    found = stored(compared(in_fragments(cells), dimensions, cosine), "embedding-links")
    doubtful = found.where(F.col("links").isNull()).select("cid", "other")
    return found.where(F.col("links").isNotNull()).unionByName(
        stored(settled(doubtful, points, dimensions, cosine), "embedding-settled"))


def classes(vectors: DataFrame, cosine: float = LEAST_COSINE, key: str = "vec_id",
            column: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector."""
    rows = vectors.select(F.col(key).alias("vec_id"), F.col(column).alias("v"), usable(column).alias("ok"))
    points = stored(
        rows.where("ok").groupBy("v").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"))
        .withColumn("cid", F.monotonically_increasing_id()), "embedding-points")
    sizes = [r[0] for r in points.select(F.size("v")).distinct().collect()]
    found = None
    for n in sizes:
        part = near_points(points.where(F.size("v") == n), n, cosine)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], "cid bigint, links bigint, other bigint")
    linked = components(found.select(F.col("cid").alias("a"), F.col("other").alias("b")), "embedding-components")
    counts = found.groupBy("cid").agg(F.sum("links").alias("links"))
    named = points.join(counts, "cid", "left").join(linked.withColumnRenamed("node", "cid"), "cid", "left").select(
        "v", "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "cid").alias("component"))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = stored(
        named.join(smallest, "component").select(F.col("v").alias("w"), "n_links", "component_id"),
        "embedding-classes")
    # Both sides are shuffled for this join alone, so that adaptive execution may split a
    # vector that very many rows have.
    return rows.join(named, F.col("ok") & (F.col("v") == F.col("w")), "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.coalesce("component_id", "vec_id")).alias("kept"))
