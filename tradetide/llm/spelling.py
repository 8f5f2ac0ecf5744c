"""Spelling variants: words one edit apart, by k-d trees over letter counts.

A word's vector counts its letters.  Replacing a letter takes one from one count
and adds one to another, inserting one adds one: a single edit moves the vector
by an L1 distance of two at most, and within a pair of lengths also by a known
number of units up and down.  So for words of one length, and for the pair of a
length and the next one:

1. Words are counted over all texts, combined within tasks before the shuffle.
2. For each length with many words a k-d tree is fitted on a bounded sample of
   them (``SAMPLE_PER_CELL`` words for each of at most ``MOST_CELLS`` cells).  Its
   leaves are cells of the whole space, so every word has one home, and a word is
   a guest of the cells whose box its units up and down can reach.  Trees only
   decide which task does what; no result depends on the sample.
3. Homes and guests meet by cell, in fragments of bounded size if a cell is large.
   There a k-d tree over the homes, pruned by boxes in the same way, leaves few
   homes for each guest; the vectors' distance and then the order of the letters
   are verified.  A task returns the number of near words and the best one for
   each word, never pairs.
4. A word's form is the near word that occurs most, if at least ``TIMES`` as often
   as the word itself.  Counts grow along forms, so there are no circles; roots
   are found by joining pointers with themselves, which doubles the way each time.

Words that are anagrams of one another have one vector and can't be told apart
by boxes; within a cell they are compared letter by letter.

Defined results: null and empty texts have no words; a null id counts as the
empty string; equal rows and rows of one id are documents of their own; of equal
counts the word smaller in code-point order is the form; an empty table gives an
empty result.  Long runs of letters are words like others.  Only the id and the
text are read, so other columns can't clash.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradetide.llm.components import stored

RUN = re.compile("[a-zÀ-ÿ]+")
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
LEAST_LETTERS, LEAST_COUNT, TIMES = 5, 3, 2
DROP_ONE_IN = 97

# Column of the vectors of each code point below 256: 26 lower-case letters, then U+00C0 to U+00FF.
COLUMN = np.full(256, -1, np.int64)
COLUMN[97:123] = np.arange(26)
COLUMN[192:256] = np.arange(26, 90)
DIMENSIONS = 90

WORDS_HELD = 200_000  # counts a task holds before it passes them on
CELL, MOST_CELLS, SAMPLE_PER_CELL = 8192, 1024, 16
HOME_LETTERS, GUEST_LETTERS = 400_000, 2_000_000  # of a fragment
LEAF, GUESTS_AT_ONCE, AT_ONCE = 64, 32_768, 4_000_000

HOME, SAME, SHORTER = 0, 1, 2
# Units a home may have more and less than a guest.
BUDGET = {HOME: (0, 0), SAME: (1, 1), SHORTER: (1, 0)}
# Squared distance of their vectors, which is 2 only for one unit up and one down, as lengths are equal.
APART = {SAME: 2, SHORTER: 1}


# ------------------------------------------------------------------ counting


def word_of(run: str, start: int) -> str:
    """The word a lower-cased run stands for; ``start`` is the CRC of what precedes it."""
    h = zlib.crc32(run.encode(), start)
    if h % DROP_ONE_IN:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def words_of(doc_id: str, text: str) -> Counter:
    """Words of a text and how often they occur."""
    start = zlib.crc32(f"{doc_id}:".encode())
    found: Counter = Counter()
    for run, n in Counter(RUN.findall(text.encode().translate(LOWER).decode())).items():
        word = word_of(run, start)
        if len(word) >= LEAST_LETTERS:
            found[word] += n
    return found


def vocabulary(docs: DataFrame) -> DataFrame:
    """word, length and ``n`` of the words that occur often enough."""

    def count(batches):
        held: dict[str, int] = {}

        def made():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                for word, n in words_of(doc_id.as_py(), text.as_py()).items():
                    held[word] = held.get(word, 0) + n
                if len(held) > WORDS_HELD:
                    yield made()
                    held.clear()
        yield made()

    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit("")))
    return (
        rows.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
        .where(F.col("n") >= LEAST_COUNT).select("word", F.length("word").alias("length"), "n"))


# ------------------------------------------------------------------ trees


def letters(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row for each."""
    size = len(words[0]) if words else 0
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(-1, size)


def vectors(codes: np.ndarray) -> np.ndarray:
    """How often each letter occurs in each row of letters."""
    n = len(codes)
    at = (COLUMN[codes] + DIMENSIONS * np.arange(n)[:, None]).ravel()
    return np.bincount(at, minlength=n * DIMENSIONS).reshape(n, DIMENSIONS)


def halves(points: np.ndarray) -> tuple[int, int] | None:
    """(column, value): points with at most that value on one side; None if all are equal."""
    spread = points.var(axis=0)
    column = int(spread.argmax())
    if not spread[column]:
        return None
    values = points[:, column]
    value = int(np.median(values))
    return column, value if value < values.max() else int(values.max()) - 1


class Tree:
    """A k-d tree whose leaves are cells of the whole space."""

    def __init__(self, points: np.ndarray, leaves: int):
        self.nodes: list[tuple] = []
        self.leaves = 0
        self._grow(points, max(0, (leaves - 1).bit_length()))

    def _grow(self, points: np.ndarray, depth: int) -> int:
        at = len(self.nodes)
        self.nodes.append(())
        split = halves(points) if depth and len(points) > 1 else None
        if split is None:
            self.nodes[at] = (None, self.leaves)
            self.leaves += 1
        else:
            low = points[:, split[0]] <= split[1]
            self.nodes[at] = (*split, self._grow(points[low], depth - 1), self._grow(points[~low], depth - 1))
        return at

    def reached(self, points: np.ndarray, budget: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
        """Rows and the leaves whose boxes they reach; with a budget of (0, 0) their own leaf."""
        rows, leaves = [], []
        todo = [(0, Reach(points, budget), {})]
        while todo:
            node, reach, box = todo.pop()
            split = self.nodes[node]
            if split[0] is None:
                rows.append(reach.rows)
                leaves.append(np.full(len(reach.rows), split[1]))
                continue
            for child, (side, inner) in zip(split[2:], reach.sides(box, *split[:2])):
                if len(side.rows):
                    todo.append((child, side, inner))
        return np.concatenate(rows), np.concatenate(leaves)


class Reach:
    """Points with the units up and down that are left to them within the box at hand."""

    def __init__(self, points, budget=(0, 0), rows=None, up=None, down=None):
        self.points = points
        self.rows = np.arange(len(points)) if rows is None else rows
        self.up = np.full(len(points), budget[0]) if up is None else up
        self.down = np.full(len(points), budget[1]) if down is None else down

    def sides(self, box: dict, column: int, value: int):
        """What reaches the half up to ``value`` and the one above, and the boxes of both.

        ``box`` has the limits (low, high) of the columns that were split before.
        """
        low, high = box.get(column, (0, None))
        at = self.points[self.rows, column]
        # A home below must be so many units less, one above so many more.
        less = np.maximum(at - value, 0) - (np.maximum(at - high, 0) if high is not None else 0)
        more = np.maximum(value + 1 - at, 0) - np.maximum(low - at, 0)
        below, above = self.down >= less, self.up >= more
        yield self._of(below, 0, less), box | {column: (low, value)}
        yield self._of(above, more, 0), box | {column: (value + 1, high)}

    def _of(self, keep, more, less) -> Reach:
        return Reach(self.points, rows=self.rows[keep], up=(self.up - more)[keep], down=(self.down - less)[keep])


def close(homes: np.ndarray, guests: np.ndarray, role: int):
    """(guest, home) rows whose vectors are as far apart as one edit takes them, in arrays."""
    kind = np.float32 if homes.sum(axis=1).max(initial=0) < 2000 else np.float64
    real, own = homes.astype(kind), guests.astype(kind)
    squares, own_squares = (real * real).sum(axis=1), (own * own).sum(axis=1)
    todo = [(np.arange(len(homes)), Reach(guests, BUDGET[role]), {})]
    while todo:
        here, reach, box = todo.pop()
        split = halves(homes[here]) if len(here) > LEAF else None
        if split is not None:
            low = homes[here, split[0]] <= split[1]
            for inside, (side, inner) in zip((here[low], here[~low]), reach.sides(box, *split)):
                if len(side.rows):
                    todo.append((inside, side, inner))
            continue
        step = max(1, AT_ONCE // len(here))
        for at in range(0, len(reach.rows), step):
            some = reach.rows[at:at + step]
            distance = own_squares[some][:, None] + squares[here] - 2 * (own[some] @ real[here].T)
            guest, home = np.nonzero(distance == APART[role])
            yield some[guest], here[home]


def one_edit(guests: np.ndarray, homes: np.ndarray, role: int) -> np.ndarray:
    """Of rows of letters: do they differ by one replaced letter, or is the guest the home less one?"""
    if role == SAME:
        return (guests != homes).sum(axis=1) == 1
    size = guests.shape[1]
    before = guests != homes[:, :size]
    after = guests != homes[:, 1:]
    first = np.where(before.any(axis=1), before.argmax(axis=1), size)
    last = np.where(after.any(axis=1), size - 1 - after[:, ::-1].argmax(axis=1), -1)
    return last < first


def near_pairs(homes: list[str], guests: list[str], role: int):
    """(guest, home) indexes of words one edit apart, in arrays."""
    if not homes or not guests:
        return
    home_codes, guest_codes = letters(homes), letters(guests)
    home_vectors = vectors(home_codes)
    for start in range(0, len(guests), GUESTS_AT_ONCE):
        codes = guest_codes[start:start + GUESTS_AT_ONCE]
        for guest, home in close(home_vectors, vectors(codes), role):
            step = max(1, AT_ONCE // home_codes.shape[1])
            for at in range(0, len(guest), step):
                g, h = guest[at:at + step], home[at:at + step]
                keep = one_edit(codes[g], home_codes[h], role)
                yield g[keep] + start, h[keep]


# ------------------------------------------------------------------ cells


def fitted(words: DataFrame) -> dict[int, Tree]:
    """A tree for each length with more than ``CELL`` words, from a bounded sample of them."""
    many = words.groupBy("length").agg(F.count("*").alias("n")).where(F.col("n") > CELL).collect()
    leaves = {r.length: min(MOST_CELLS, 2 * r.n // CELL) for r in many}
    if not leaves:
        return {}
    parts = 1_000_000
    share = F.create_map(*[F.lit(x) for r in many for x in (
        r.length, min(parts, SAMPLE_PER_CELL * leaves[r.length] * parts // r.n))])
    drawn = words.where(F.pmod(F.xxhash64("word"), F.lit(parts)) < share[F.col("length")])
    sample: dict[int, list[str]] = {length: [] for length in leaves}
    for r in drawn.select("word", "length").collect():
        sample[r.length].append(r.word)
    return {n: Tree(vectors(letters(sorted(sample[n]))), leaves[n]) for n in leaves if sample[n]}


def routed(words: DataFrame, trees: dict[int, Tree]) -> DataFrame:
    """size (of the homes), cell, role, word and n: each word at home and as a guest."""
    names = ["size", "cell", "role", "word", "n"]

    def run(batches):
        for batch in batches:
            lengths = batch.column(1).to_numpy()
            for length in np.unique(lengths).tolist():
                take = np.flatnonzero(lengths == length)
                points = None
                for role, size in ((HOME, length), (SAME, length), (SHORTER, length + 1)):
                    rows, cells = np.arange(len(take)), np.zeros(len(take), np.int64)
                    if size in trees:
                        if points is None:
                            points = vectors(letters(batch.column(0).take(pa.array(take)).to_pylist()))
                        rows, cells = trees[size].reached(points, BUDGET[role])
                    at = pa.array(take[rows])
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(rows), size, np.int32)), pa.array(cells.astype(np.int32)),
                        pa.array(np.full(len(rows), role, np.int32)), batch.column(0).take(at),
                        batch.column(2).take(at)], names=names)

    return words.mapInArrow(run, "size int, cell int, role int, word string, n bigint")


def dealt(rows: DataFrame) -> DataFrame:
    """``rows`` with the fragments of homes and of guests they belong to, of bounded size each."""
    letters_of = F.sum(F.when(F.col("role") == HOME, F.col("size")).otherwise(0))
    guest_letters = F.sum(F.when(F.col("role") != HOME, F.col("size")).otherwise(0))
    cells = stored(rows.groupBy("size", "cell").agg(
        F.ceil(letters_of / HOME_LETTERS).alias("home_parts"),
        F.ceil(guest_letters / GUEST_LETTERS).alias("guest_parts"))
        .where("home_parts > 0 and guest_parts > 0"), "spelling-cells")
    own = F.xxhash64("word")

    def among(parts: str, mine):
        every = F.sequence(F.lit(0).cast("bigint"), F.col(parts) - 1)
        return F.explode(F.when(mine, F.array(F.pmod(own, F.col(parts)))).otherwise(every))

    home = F.col("role") == HOME
    joined = rows.withColumn("zero", F.lit(0)).join(cells.withColumn("zero", F.lit(0)), ["size", "cell", "zero"])
    return joined.withColumn("home_part", among("home_parts", home)).withColumn(
        "guest_part", among("guest_parts", ~home)).select(
        "size", "cell", "home_part", "guest_part", "role", "word", "n")


FOUND = "word string, n_near bigint, best_n bigint, best string"


def found_in(table: pa.Table) -> pa.Table:
    """For the words of one fragment: how many near ones it holds, and the best of them."""
    roles = table.column("role").to_numpy()
    order = np.argsort(roles, kind="stable")
    table, roles = table.take(pa.array(order)), roles[order]
    words, counts = table.column("word").to_pylist(), table.column("n").to_numpy()
    edges = np.searchsorted(roles, [HOME, SAME, SHORTER, SHORTER + 1])
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    near = np.zeros(len(words), np.int64)
    best = np.full(len(words), -1)

    def add(subject, other):
        np.add.at(near, subject, 1)
        # The best so far takes part again.
        known = np.flatnonzero(best >= 0)
        subject, other = np.concatenate([subject, known]), np.concatenate([other, best[known]])
        sort = np.lexsort((rank[other], -counts[other], subject))
        subject, other = subject[sort], other[sort]
        first = np.concatenate([[True], subject[1:] != subject[:-1]])
        best[subject[first]] = other[first]

    homes = words[edges[0]:edges[1]]
    for role in (SAME, SHORTER):
        start, end = edges[role], edges[role + 1]
        subjects, others, held = [], [], 0
        for guest, home in near_pairs(homes, words[start:end], role):
            subjects.append(guest + start)
            others.append(home)
            if role == SHORTER:
                subjects.append(home)
                others.append(guest + start)
            held += len(guest)
            if held > AT_ONCE:
                add(np.concatenate(subjects), np.concatenate(others))
                subjects, others, held = [], [], 0
        if held:
            add(np.concatenate(subjects), np.concatenate(others))
    had = np.flatnonzero(near)
    take, best_of = pa.array(had), pa.array(best[had])
    return pa.table([
        table.column("word").take(take), pa.array(near[had]), table.column("n").take(best_of),
        table.column("word").take(best_of)], names=["word", "n_near", "best_n", "best"])


# ------------------------------------------------------------------ forms and roots


def with_forms(words: DataFrame) -> DataFrame:
    """``words`` with n_near, form and form_n."""
    rows = stored(routed(words, fitted(words)), "spelling-routed")
    found = dealt(rows).groupBy("size", "cell", "home_part", "guest_part").applyInArrow(found_in, FOUND)
    merged = found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"),
        F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word"))).alias("best"))
    is_form = -F.col("best.less") >= TIMES * F.col("n")
    return words.join(merged, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(is_form, F.col("best.word")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n"))


def with_roots(words: DataFrame) -> DataFrame:
    """``words`` with ``root``, the last word on the way along the forms."""
    way = stored(words.where("form is not null").select("word", F.col("form").alias("root")), "spelling-way")
    while True:
        # The constant keeps exchanges apart from others, so that a root of very many words may be split.
        ahead = way.select(F.col("word").alias("root"), F.col("root").alias("then"), F.lit(0).alias("zero"))
        way = stored(
            way.select("word", "root", F.lit(0).alias("zero")).join(ahead, ["root", "zero"], "left").select(
                "word", F.coalesce("then", "root").alias("root"), F.col("then").isNotNull().alias("moved")),
            "spelling-way")
        if way.where("moved").isEmpty():
            break
        way = way.drop("moved")
    return words.join(way.select("word", "root"), "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word."""
    words = stored(vocabulary(docs), "spelling-words")
    formed = stored(with_forms(words), "spelling-forms")
    return with_roots(formed).select("word", "form", "root", "n", "n_near", "form_n")
