"""Language identification by unigram pieces, summed over all segmentations.

A fixed public vocabulary gives the pieces.  Each language has a probability for
each piece; a word's probability in a language is the sum, over all ways to cut
it into pieces, of the product of their probabilities, which a forward pass over
the word's bytes gives.  A text's score is the product over its words, and the
language with the largest one is predicted; ``score`` is its share of the sum
over all languages, which are held to be equally likely beforehand.

The probabilities are learned by expectation and maximisation from the words of
all labelled texts that are not held out: words are counted per language in one
pass, combined within tasks before the shuffle, and each round runs forward and
backward over the counted words on the executors.  What comes back to the driver
is the model, at most one number per piece and language.

Texts are lower-cased and cut into runs of letters, each with a space before it;
pieces that could not occur in such a run are left out, single bytes are pieces,
so every word has a segmentation.

Defined results: a null text and one without a letter are ``und`` with score 0,
and so is everything if nothing was learned; of equal scores the language first
in code-point order is taken; a null id counts as the empty string (and is not
held out); rows of one id, and equal rows, are documents of their own; very long
words are taken whole; an empty table gives an empty result.  Other columns are
not read.
"""

from __future__ import annotations

import base64
import itertools
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradetide.llm.components import stored

LETTERS = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"
FOLDS, HELD_OUT = 4, 2
ROUNDS, SMOOTHING = 3, 0.1
LONGEST_PIECE = 16  # bytes
LONG_WORD, RAISED = 32, 5.0  # bytes; longer words are walked one by one, in logarithms
WORDS_HELD = 200_000
CELLS_AT_ONCE = 500_000
LEADING = 20  # bits of a hash that tell where to look for it
SHIFT = np.uint64(64 - LEADING)
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


# ------------------------------------------------------------------ words


def words_of(text: str) -> Counter:
    """Lower-cased runs of letters of a text and how often they occur."""
    found = Counter(LETTERS.findall(text.lower()))
    # The pattern also lets through other numbers, such as superscripts.
    for word in [w for w in found if not w.isalpha()]:
        n = found.pop(word)
        for part in "".join(c if c.isalpha() else " " for c in word).split():
            found[part] += n
    return found


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, word and ``n`` over all texts of ``docs`` (lang, text)."""

    def count(batches):
        held: Counter = Counter()

        def made():
            keys = list(held)
            return pa.RecordBatch.from_arrays([
                pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
                pa.array(list(held.values()), pa.int64())], names=["lang", "word", "n"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for word, n in words_of(text.as_py()).items():
                    held[lang, word] += n
                if len(held) > WORDS_HELD:
                    yield made()
                    held.clear()
        yield made()

    rows = docs.where("lang is not null and text is not null").select("lang", "text")
    return rows.mapInArrow(count, "lang string, word string, n bigint").groupBy("lang", "word").agg(
        F.sum("n").alias("n"))


# ------------------------------------------------------------------ pieces


def read_pieces(path: str) -> list[bytes]:
    """Pieces of a vocabulary file (base64 and rank in each line) that words can hold."""

    def fits(piece: bytes) -> bool:
        try:
            text = piece.decode().removeprefix(" ")
        except UnicodeDecodeError:
            return False
        return text.isalpha() and text == text.lower() and len(piece) <= LONGEST_PIECE

    with open(path, "rb") as file:
        listed = [base64.b64decode(line.split()[0]) for line in file if line.strip()]
    return [bytes([b]) for b in range(256)] + [p for p in listed if len(p) > 1 and fits(p)]


class Pieces:
    """Finds the pieces at every place of words, by hashes of their bytes."""

    def __init__(self, pieces: list[bytes]):
        self.count = len(pieces)
        self.longest = max(map(len, pieces))
        self.sizes = np.array(list(map(len, pieces)))
        hashes = np.array([self._hash(np.frombuffer(p, np.uint8)[None])[0] for p in pieces], np.uint64)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        if (self.hashes[1:] == self.hashes[:-1]).any():
            raise ValueError("two pieces share a hash")
        # Where the hashes with the same leading bits start; most have none or one.
        leading = (self.hashes >> SHIFT).astype(np.int64)
        self.first = np.searchsorted(leading, np.arange((1 << LEADING) + 1)).astype(np.int32)
        self.most = int(np.diff(self.first).max())

    @staticmethod
    def _step(code: np.ndarray, byte: np.ndarray) -> np.ndarray:
        code = (code ^ (byte.astype(np.uint64) + np.uint64(1))) * MULTIPLIER
        return code ^ (code >> np.uint64(29))

    def _hash(self, rows: np.ndarray) -> np.ndarray:
        code = np.zeros(len(rows), np.uint64)
        for k in range(rows.shape[1]):
            code = self._step(code, rows[:, k])
        return code * MULTIPLIER

    def at(self, codes: np.ndarray):
        """Pieces in rows of bytes of one length: (size, edges, rows, pieces) for each size of
        pieces, where those that start at byte ``i`` lie from edges[i] to edges[i + 1]."""
        turned = np.ascontiguousarray(codes.T)
        size = len(turned)
        code = np.zeros(turned.shape, np.uint64)
        for n in range(1, min(self.longest, size) + 1):
            code = self._step(code[:size - n + 1], turned[n - 1:])
            hashes = code * MULTIPLIER
            leading = (hashes >> SHIFT).astype(np.int64)
            starts, rows = np.nonzero(self.first[leading] < self.first[leading + 1])
            wanted, leading = hashes[starts, rows], leading[starts, rows]
            place, end = self.first[leading], self.first[leading + 1]
            for _ in range(1, self.most):
                place = np.where((self.hashes[place] != wanted) & (place + 1 < end), place + 1, place)
            same = self.hashes[place] == wanted
            edges = np.searchsorted(starts[same], np.arange(size - n + 2)).tolist()
            yield n, edges, rows[same], self.order[place[same]]


def grouped(words: list[str]):
    """(indexes, rows of bytes) of words of one length each, in pieces of bounded size; words
    longer than ``LONG_WORD`` come one by one."""
    coded = [b" " + w.encode() for w in words]
    sizes = np.fromiter(map(len, coded), np.int64, len(coded))
    order = np.argsort(sizes, kind="stable")
    edges = np.flatnonzero(np.diff(sizes[order], prepend=-1, append=-1))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        size = int(sizes[order[a]])
        step = max(1, CELLS_AT_ONCE // size) if size <= LONG_WORD else 1
        for at in range(a, b, step):
            some = order[at:min(b, at + step)]
            yield some, np.frombuffer(b"".join([coded[i] for i in some.tolist()]), np.uint8).reshape(-1, size)


def forward(found: list, shape: tuple[int, int], weights: np.ndarray) -> np.ndarray:
    """Sums over the segmentations of every beginning: (bytes + 1, words, languages)."""
    alpha = np.zeros((shape[1] + 1, shape[0], weights.shape[1]))
    alpha[0] = 1
    for end in range(1, shape[1] + 1):
        for n, edges, rows, pieces in found[:end]:
            a, b = edges[end - n], edges[end - n + 1]
            if a < b:
                alpha[end, rows[a:b]] += alpha[end - n, rows[a:b]] * weights[pieces[a:b]]
    return alpha


def backward(found: list, shape: tuple[int, int], weights: np.ndarray) -> np.ndarray:
    """The same for every end of the words."""
    size = shape[1]
    beta = np.zeros((size + 1, shape[0], weights.shape[1]))
    beta[size] = 1
    for start in range(size - 1, -1, -1):
        for n, edges, rows, pieces in found[:size - start]:
            a, b = edges[start], edges[start + 1]
            if a < b:
                beta[start, rows[a:b]] += beta[start + n, rows[a:b]] * weights[pieces[a:b]]
    return beta


def walk(found: list, size: int, logs: np.ndarray, back: bool = False) -> np.ndarray:
    """Logs of the sums of one long word: (bytes + 1, languages).  Its pieces go by byte."""
    sums = np.full((size + 1, logs.shape[1]), -np.inf)
    sums[size if back else 0] = 0
    for i in range(1, size + 1):
        at = size - i if back else i
        terms = []
        for n, edges, _, pieces in found[:i]:
            start = at if back else at - n
            terms += [sums[at + n if back else start] + logs[p] for p in pieces[edges[start]:edges[start + 1]]]
        sums[at] = np.logaddexp.reduce(terms, axis=0)
    return sums


def weights_of(logs: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Probabilities of pieces, raised by a factor for each byte so that words of up to
    ``LONG_WORD`` bytes stay within the range of doubles."""
    return np.exp(logs + RAISED * sizes[:, None])


# ------------------------------------------------------------------ learning


def count_in(totals, found, shape, logs, weights, times) -> None:
    """Adds how often each piece is expected in words of one length that occur ``times``."""
    size = shape[1]
    if size > LONG_WORD:
        alpha, beta = (walk(found, size, logs[:, None], back)[:, 0] for back in (False, True))
        for n, edges, _, pieces in found:
            starts = np.repeat(np.arange(size - n + 1), np.diff(edges))
            share = np.exp(alpha[starts] + logs[pieces] + beta[starts + n] - alpha[size])
            totals += np.bincount(pieces, share * times[0], len(totals))
        return
    alpha, beta = forward(found, shape, weights)[:, :, 0], backward(found, shape, weights)[:, :, 0]
    each = times / alpha[size]
    for n, edges, rows, pieces in found:
        starts = np.repeat(np.arange(size - n + 1), np.diff(edges))
        share = alpha[starts, rows] * weights[pieces, 0] * beta[starts + n, rows] * each[rows]
        totals += np.bincount(pieces, share, len(totals))


def expected(counts: DataFrame, pieces: Pieces, logs: dict[str, np.ndarray]) -> DataFrame:
    """lang, piece and ``n``: how often each piece is expected, given the model."""

    def run(batches):
        totals = {lang: np.zeros(pieces.count) for lang in logs}
        weights = {lang: weights_of(own[:, None], pieces.sizes) for lang, own in logs.items()}
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            words, times = batch.column(1).to_pylist(), batch.column(2).to_numpy()
            for lang in set(langs.tolist()):
                own = np.flatnonzero(langs == lang)
                for some, codes in grouped([words[i] for i in own.tolist()]):
                    count_in(totals[lang], list(pieces.at(codes)), codes.shape, logs[lang], weights[lang], times[own[some]])
        for lang, total in totals.items():
            had = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * len(had), pa.string()), pa.array(had.astype(np.int32)),
                pa.array(total[had])], names=["lang", "piece", "n"])

    return counts.mapInArrow(run, "lang string, piece int, n double").groupBy("lang", "piece").agg(
        F.sum("n").alias("n"))


def learned(docs: DataFrame, vocabulary: list[bytes], rounds: int = ROUNDS) -> tuple[list[str], np.ndarray]:
    """The languages of ``docs`` (lang, text) in order, and the log probabilities of the pieces in each."""
    pieces = Pieces(vocabulary)
    counts = stored(word_counts(docs), "language-words")
    langs = sorted(r.lang for r in counts.select("lang").distinct().collect())
    logs = {lang: np.full(pieces.count, -np.log(pieces.count)) for lang in langs}
    for _ in range(rounds if langs else 0):
        totals = {lang: np.full(pieces.count, SMOOTHING) for lang in langs}
        found = expected(counts, pieces, logs).toPandas()
        for lang, piece, n in zip(found["lang"], found["piece"], found["n"]):
            totals[lang][piece] += n
        logs = {lang: np.log(t / t.sum()) for lang, t in totals.items()}
    return langs, np.stack([logs[lang] for lang in langs], 1) if langs else np.zeros((pieces.count, 0))


# ------------------------------------------------------------------ prediction


def word_scores(words: list[str], pieces: Pieces, logs: np.ndarray) -> np.ndarray:
    """Log probability of each word in each language."""
    scores, weights = np.zeros((len(words), logs.shape[1])), weights_of(logs, pieces.sizes)
    for some, codes in grouped(words):
        found, size = list(pieces.at(codes)), codes.shape[1]
        if size > LONG_WORD:
            scores[some] = walk(found, size, logs)[size]
        else:
            scores[some] = np.log(forward(found, codes.shape, weights)[size]) - RAISED * size
    return scores


def predictions(texts: list[str], langs: list[str], pieces: Pieces, logs: np.ndarray):
    """(language, score) of each text."""
    index: dict[str, int] = defaultdict(itertools.count().__next__)
    sizes, words, times = [], [], []
    for text in texts:
        found = words_of(text)
        sizes.append(len(found))
        words += map(index.__getitem__, found)
        times += found.values()
    if not langs or not words:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    rows = np.repeat(np.arange(len(texts)), sizes)
    scores = word_scores(list(index), pieces, logs)[np.array(words)] * np.array(times)[:, None]
    totals = np.stack([np.bincount(rows, s, len(texts)) for s in scores.T], 1)
    best = totals.argmax(axis=1)
    share = 1 / np.exp(totals - totals.max(axis=1, keepdims=True)).sum(axis=1)
    return [langs[b] if n else UNKNOWN for b, n in zip(best.tolist(), sizes)], np.where(np.array(sizes) > 0, share, 0.0)


def held_out(doc_id):
    """Is the row kept out of learning?"""
    name = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.pmod(F.crc32(name), F.lit(FOLDS)) == HELD_OUT


def identified(docs: DataFrame, langs: list[str], logs: np.ndarray, vocabulary: list[bytes]) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document; only the text decides."""
    pieces = Pieces(vocabulary)

    def run(batches):
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column(2)]
            names, scores = predictions(texts, langs, pieces, logs)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores)],
                names=["doc_id", "held_out", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def report(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """Learned from all labelled documents that are not held out, applied to all."""
    known = docs.where(~held_out(F.col("doc_id"))).select("lang", "text")
    langs, logs = learned(known, vocabulary)
    return identified(docs.select("doc_id", "text"), langs, logs, vocabulary)
