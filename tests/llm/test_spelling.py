"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import common
import numpy as np
import pytest

from tradetide.llm import spelling


def slow_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def edits(word, alphabet):
    for i in range(len(word) + 1):
        yield word[:i] + word[i + 1:]
        for c in alphabet:
            yield word[:i] + c + word[i + 1:]
            yield word[:i] + c + word[i:]


def slow_variants(words):
    alphabet = {c for w in words for c in w}
    near = {w: {e for e in edits(w, alphabet) if e in words and e != w} for w in words}
    form = {}
    for w, around in near.items():
        best = min(around, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()}


def planted(rng):
    """Rows whose words are chains of edits, anagrams and repeated letters, with very unlike counts."""
    counts = Counter()
    for _ in range(60):
        word = "".join(rng.choice("abcdeéÿñ") for _ in range(rng.randrange(4, 12)))
        for _ in range(12):
            counts[word] += rng.choice([1, 3, 7, 20, 60])
            word = rng.choice(sorted(set(edits(word, "abcdeéÿñ"))))
    counts |= Counter({"".join(rng.sample("abcdef", 6)): rng.randrange(3, 30) for _ in range(150)})
    counts |= Counter({"aaaaa": 3, "aaaaaa": 6, "aaaaaaa": 12, "baaaaaa": 12, "x" * 3000: 5, "x" * 2999 + "y": 20,
                       "x" * 3001: 9})
    told = list(counts.elements())
    rng.shuffle(told)
    return [(i, " ".join(told[i::25])) for i in range(25)]


@pytest.mark.parametrize("small", [False, True])
def test_variants_equal_brute_force(spark, monkeypatch, small):
    if small:
        # Trees of many cells, several fragments of each, and leaves of few words.
        for name, value in {"CELL": 12, "LEAF": 3, "HOME_LETTERS": 60, "GUEST_LETTERS": 90, "WORDS_HELD": 50,
                            "GUESTS_AT_ONCE": 7, "AT_ONCE": 20, "MOST_CELLS": 32}.items():
            monkeypatch.setattr(spelling, name, value)
    rows = planted(random.Random(6)) + [(None, "Words words WORDS"), (None, None), (3, ""), (3, "Words words"), (3, "Words words")]
    docs = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], "doc_id bigint, text string, word string, n string, size int")
    got = spelling.variants(docs)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = slow_variants(slow_words(rows))
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(want) and set(rows) == want
    assert any(r[1] and r[2] != r[1] for r in rows)


def test_variants_of_odd_documents(spark):
    got = {tuple(r) for r in spelling.variants(common.clashing(spark)).collect()}
    words = slow_words([(i, t) for i, t, *_ in common.ODD])
    assert got == slow_variants(words) and spelling.variants(common.empty(spark)).count() == 0


def test_boxes_never_lose_a_near_vector():
    rng = np.random.default_rng(2)
    points = rng.integers(0, 3, (400, spelling.DIMENSIONS)) * (rng.random((400, spelling.DIMENSIONS)) < 0.1)
    tree = spelling.Tree(points, 64)
    own = dict(zip(*tree.reached(points, (0, 0))))
    assert tree.leaves > 30 and len(own) == len(points)
    seen = defaultdict(set)
    for row, leaf in zip(*tree.reached(points, (1, 1))):
        seen[row].add(leaf)
    for a in range(len(points)):
        for up, down in rng.integers(0, spelling.DIMENSIONS, (20, 2)):
            other = points[a].copy()
            other[up] += 1
            other[down] -= other[down] > 0
            leaf = tree.reached(other[None], (0, 0))[1][0]
            assert leaf in seen[a]


@pytest.mark.parametrize("a, b, replaced, inserted", [
    ("abcde", "abxde", True, None), ("abcde", "bacde", False, None), ("abcde", "abcde", False, None),
    ("aabb", "aaabb", None, True), ("abcd", "abcde", None, True), ("abcd", "xabcd", None, True), ("abcd", "badce", None, False),
    ("abcd", "acbde", None, False)])
def test_order_of_letters(a, b, replaced, inserted):
    rows = [spelling.letters([w]) for w in (a, b)]
    role = spelling.SAME if inserted is None else spelling.SHORTER
    assert spelling.one_edit(*rows, role).tolist() == [replaced if inserted is None else inserted]
