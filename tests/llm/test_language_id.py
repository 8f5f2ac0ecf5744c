"""Language identification: sums over segmentations by brute force, and held-out accuracy."""

import math
import random
import zlib

import common
import numpy as np
import pytest
from pyspark.sql import functions as F

from tradetide.llm import language_id, queries

PIECES = [bytes([b]) for b in range(256)] + [b" a", b"ab", b"abc", b" ab", b"bc", b"ca", "é".encode(), "éa".encode(), b" abcabc"]


def every_cut(word, logs, index):
    """Log of the summed probabilities, and how often each piece is expected, by all segmentations."""
    def cuts(rest):
        if not rest:
            yield ()
        for n in range(1, len(rest) + 1):
            if rest[:n] in index:
                for more in cuts(rest[n:]):
                    yield (rest[:n], *more)

    weights = {c: math.exp(sum(logs[index[p]] for p in c)) for c in cuts(word)}
    total = sum(weights.values())
    expected = np.zeros(len(index))
    for cut, weight in weights.items():
        for piece in cut:
            expected[index[piece]] += weight / total
    return math.log(total), expected


@pytest.fixture
def logs():
    rng = np.random.default_rng(1)
    values = rng.random((len(PIECES), 3)) + 0.01
    return np.log(values / values.sum(axis=0))


def test_forward_sums_all_segmentations(logs):
    words = ["abcabc", "a", "bca", "éab", "zz", "abcab", "caéa"]
    index = {p: i for i, p in enumerate(PIECES)}
    got = language_id.word_scores(words, language_id.Pieces(PIECES), logs)
    for word, scores in zip(words, got):
        for k in range(3):
            assert math.isclose(scores[k], every_cut(b" " + word.encode(), logs[:, k], index)[0], rel_tol=1e-9)


def test_long_words_are_walked_whole(spark, logs, monkeypatch):
    words = ["abcéa" * 6, "bca" * 9, "a" * 31]
    pieces = language_id.Pieces(PIECES)
    counts = spark.createDataFrame([("x", w, i + 1) for i, w in enumerate(words)], "lang string, word string, n bigint")
    whole = language_id.word_scores(words, pieces, logs)
    totals = {r.piece: r.n for r in language_id.expected(counts, pieces, {"x": logs[:, 0]}).collect()}
    found = np.zeros(len(PIECES))
    for i, (some, codes) in enumerate(language_id.grouped(words)):
        monkeypatch.setattr(language_id, "LONG_WORD", 5)
        language_id.count_in(found, list(pieces.at(codes)), codes.shape, logs[:, 0], None, some + 1)
        monkeypatch.undo()
    assert np.allclose(found[list(totals)], list(totals.values())) and np.isclose(found.sum(), sum(totals.values()))
    monkeypatch.setattr(language_id, "LONG_WORD", 5)
    assert np.allclose(language_id.word_scores(words, pieces, logs), whole, rtol=1e-12)
    monkeypatch.undo()
    assert np.isfinite(language_id.word_scores(["x" * 20_000, "ab" * 10_000], pieces, logs)).all()
    unseen = np.full(logs.shape, -25.0)
    assert np.isfinite(language_id.word_scores(["z" * 31, "z" * 40], pieces, unseen)).all()


def test_expected_counts_equal_brute_force(spark, logs):
    words = {"abcabc": 3, "éab": 2, "bca": 1}
    index = {p: i for i, p in enumerate(PIECES)}
    counts = spark.createDataFrame([("x", w, n) for w, n in words.items()] + [("y", "a", 5)], "lang string, word string, n bigint")
    got = language_id.expected(counts, language_id.Pieces(PIECES), {"x": logs[:, 0], "y": logs[:, 1]}).collect()
    found = np.zeros(len(PIECES))
    for r in got:
        if r.lang == "x":
            found[r.piece] = r.n
    want = sum(n * every_cut(b" " + w.encode(), logs[:, 0], index)[1] for w, n in words.items())
    assert np.allclose(found, want, atol=1e-9)


def test_words():
    assert language_id.words_of("Ab ab² x_y 12 É¼é") == {"ab": 2, "x": 1, "y": 1, "é": 2}


@pytest.fixture(scope="module")
def vocabulary():
    return queries.piece_vocabulary()


def test_held_out_accuracy(spark, vocabulary):
    docs = common.sample(spark, "/root/testdata/sf0.01")
    langs = {r.doc_id: r.lang for r in docs.collect()}
    rows = language_id.report(docs, vocabulary).collect()
    assert sorted(r.doc_id for r in rows) == sorted(langs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    apart = [r for r in rows if r.held_out]
    assert len(apart) > 200 and sum(r.lang_pred == langs[r.doc_id] for r in apart) >= 0.99 * len(apart)


def test_labels_of_held_out_rows_and_other_columns_decide_nothing(spark, vocabulary):
    docs = common.sample(spark, "/root/testdata/sf0.001")
    wrong = docs.selectExpr(
        "doc_id", "text", "if(pmod(crc32(string(doc_id)), 4) = 2, 'zz', lang) as lang", "'q' as source", "0 as n_chars",
        "'w' as word", "1 as n", "'s' as score", "'h' as held_out")
    a = {r.doc_id: tuple(r) for r in language_id.report(docs, vocabulary).collect()}
    b = {r.doc_id: tuple(r) for r in language_id.report(wrong, vocabulary).collect()}
    assert {i: r[:3] for i, r in a.items()} == {i: r[:3] for i, r in b.items()}


def test_odd_documents(spark, vocabulary):
    rng = random.Random(3)
    rows = [(100 + i, rng.choice(["der die das und ", "the of and "]) * 20, None, "a", 1) for i in range(20)]
    rows = [(i, t, "de" if t[0] == "d" else "en", s, n) for i, t, _, s, n in rows]
    docs = common.clashing(spark).select(*common.SCHEMA.names).withColumn("lang", F.lit(None).cast("string"))
    docs = docs.unionByName(spark.createDataFrame(rows + [(50, "²½ 12 _", "en", "a", 7)], common.SCHEMA))
    got = language_id.report(docs, vocabulary).collect()
    assert len(got) == docs.count()
    assert {(r.doc_id, r.score) for r in got if r.lang_pred == "und"} == {(1, 0), (2, 0), (3, 0), (50, 0)}
    texts = {i: t for i, t, *_ in rows}
    assert all(r.lang_pred == ("de" if texts[r.doc_id][0] == "d" else "en") for r in got if r.doc_id in texts)
    assert not any(r.held_out for r in got if r.doc_id is None)
    assert language_id.report(common.empty(spark), vocabulary).count() == 0
    unknown = language_id.report(docs.withColumn("lang", F.lit(None).cast("string")), vocabulary).collect()
    assert all(r.lang_pred == "und" and r.score == 0 for r in unknown) and len(unknown) == len(got)
