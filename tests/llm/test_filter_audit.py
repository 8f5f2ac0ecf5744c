"""The filter audit against brute force, with odd rows and hot texts."""

import re
from collections import Counter
from itertools import permutations

import common

from tradetide.llm import filter_audit


def fails(rows):
    """(part, id, failing letters) of each row, one row at a time."""
    for doc_id, text, lang, *_ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        found = "A" * (len(words) < 200) + "B" * (100 * len(set(words)) < 50 * len(words))
        found += "C" * (100 * len(re.findall("[A-Z]", text)) > 3 * len(text)) + "D" * bool(re.search(r"[#$%&*|]", text))
        same = any((t or "") == text and i is not None and doc_id is not None and i < doc_id for i, t, *_ in rows)
        yield lang or "", doc_id, found + "E" * same


def slow_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    found = list(fails(rows))
    out, shapley = {}, Counter()
    for part in {f[0] for f in found}:
        for order in permutations("ABCDE"):
            left, gone = [f for f in found if f[0] == part], []
            for step, own in enumerate(order, 1):
                bad = [f for f in left if own in f[2]]
                out[part, "".join(order), step] = (
                    len(left) - len(bad), len(bad), sum(own in f[2] for f in gone),
                    sum(f[0] == part and f[2] == own for f in found), sum(f[1] in good for f in bad),
                    sum(f[1] in toxic for f in bad))
                left, gone = [f for f in left if own not in f[2]], gone + bad
                shapley[part, own] += len(bad)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_equals_brute_force(spark, sf):
    docs = common.clashing(spark).select(*common.SCHEMA.names, "kept", "position").unionByName(
        common.sample(spark, sf).where("doc_id between 10 and 120"), allowMissingColumns=True)
    hot = [(1000 + i, "A hot text", "en", "a", 1) for i in range(300)] + [(None, "A hot text", None, "a", 1)] * 3
    docs = docs.unionByName(spark.createDataFrame(hot, common.SCHEMA), allowMissingColumns=True)
    labels = [(i, i % 2, i % 3 == 0 and 1 or 0) for i in range(10, 120)] + [
        (4, 1, None), (4, 0, 1), (None, 1, 1), (5, None, None), (1003, 1, 1), (99999, 1, 1)]
    rows = docs.select(*common.SCHEMA.names).collect()
    got = filter_audit.audit(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    found = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in got.collect()}
    assert got.columns == ["part", "filter_order", "step", *filter_audit.COUNTED]
    want = slow_audit(rows, labels)
    assert found == want and len(found) == 600 * len({r.lang or "" for r in rows})
    assert any(v[4] for v in want.values()) and any(v[5] for v in want.values())


def test_audit_of_nothing(spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert filter_audit.audit(common.empty(spark), labels).count() == 0
    one = spark.createDataFrame([(1, "", None, None, 0)], common.SCHEMA)
    rows = filter_audit.audit(one, labels).collect()
    assert len(rows) == 600 and sum(r.removed for r in rows) == 120 and {r.part for r in rows} == {""}


def test_one_text_in_two_languages_keeps_its_parts(spark):
    rows = [(1, "same", "en", "a", 4), (2, "same", "en", "a", 4), (2, "same", "de", "a", 4)]
    got = filter_audit.combinations(
        spark.createDataFrame(rows, common.SCHEMA), spark.createDataFrame([], "doc_id bigint, quality int, toxic int"))
    e = filter_audit.BIT["E"]
    assert sorted((r.part, bool(r.bits & e), r.n) for r in got.collect()) == [
        ("de", True, 1), ("en", False, 1), ("en", True, 1)]
