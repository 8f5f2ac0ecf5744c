"""SimHash, embeddings, sharding, mixing, chat, pages and the pipeline against brute force."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import common
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tradetide.llm import chat, embeddings, main_text, mixing, quality, queries, sharding, simhash
from tradetide.llm.components import components


def roots(nodes, pairs):
    above = {n: n for n in nodes}

    def find(x):
        while above[x] != x:
            x = above[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        above[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(3)
    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    rng.shuffle(pairs)
    want = roots({x for p in pairs if p[0] != p[1] for x in p}, [p for p in pairs if p[0] != p[1]])
    got = components(spark.createDataFrame(pairs, "a bigint, b bigint"))
    assert {r.node: r.component for r in got.collect()} == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# ------------------------------------------------------------------ SimHash


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_equals_brute_force(spark, sf):
    docs = common.clashing(spark).select("doc_id", "text").unionByName(
        common.sample(spark, sf).selectExpr("doc_id + 1000 as doc_id", "text"))
    rows = [(r.doc_id, slow_fingerprint(r.text or "")) for r in docs.collect() if r.text != common.LONG]
    prints = {fp for _, fp in rows} | {simhash.fingerprint(common.LONG)}
    near = [(a, b) for a, b in itertools.combinations(prints, 2) if (a ^ b).bit_count() <= 2]
    group = roots(prints, near)
    rows.append((5, simhash.fingerprint(common.LONG)))
    least = defaultdict(lambda: 1 << 60)
    for doc_id, fp in rows:
        if doc_id is not None:
            least[group[fp]] = min(least[group[fp]], doc_id)
    want = Counter((i, f"{fp:016x}", least.get(group[fp])) for i, fp in rows)
    assert Counter(map(tuple, simhash.classes(docs).collect())) == want
    assert simhash.classes(common.empty(spark)).count() == 0


@pytest.mark.parametrize("small", [2, 64])
def test_large_buckets_have_the_same_groups(spark, small):
    rng = random.Random(1)
    prints = {0}
    for _ in range(200):
        a = rng.choice(sorted(prints))
        for _ in range(rng.choice([1, 2, 2, 3, 30])):
            a ^= 1 << rng.randrange(64)
        prints.add(a)
    near = [(a, b) for a, b in itertools.combinations(prints, 2) if (a ^ b).bit_count() <= 2]
    want = defaultdict(set)
    for fp, root in roots(prints, near).items():
        want[root].add(simhash.signed(fp))
    frame = spark.createDataFrame([(simhash.signed(fp),) for fp in prints], "fp bigint")
    linked = {r.node: r.component for r in components(simhash.links(frame, 2, small)).collect()}
    got = defaultdict(set)
    for fp in prints:
        got[linked.get(simhash.signed(fp), simhash.signed(fp))].add(simhash.signed(fp))
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_one_document_of_each_group_stays(spark, sf):
    docs = common.clashing(spark)
    kept = simhash.keep_one(docs)
    rows = kept.collect()
    assert kept.columns == docs.columns and all(r.fp == "x" for r in rows)
    groups = {r.component_id for r in simhash.classes(docs).collect()}
    assert len(rows) == len(groups) and len({r.text for r in rows}) == len(rows)
    assert simhash.keep_one(common.empty(spark)).count() == 0


# ------------------------------------------------------------------ embeddings


def test_embeddings_equal_brute_force(spark, sf, monkeypatch):
    monkeypatch.setattr(embeddings, "STRIP", 16)
    monkeypatch.setattr(embeddings, "PAIRS", 64)
    monkeypatch.setattr(embeddings, "HOMES", 32)
    rng = np.random.default_rng(4)
    centre = rng.standard_normal(64)
    cluster = [(5000 + i, (centre + 0.08 * rng.standard_normal(64)).astype(np.float32).tolist()) for i in range(60)]
    odd = [
        (9000, None), (9001, [0.0] * 64), (9002, [float("nan")] + [1.0] * 63), (9003, [None] + [1.0] * 63),
        (None, [5.0] * 64), (9004, [1.0] * 64), (9005, [1.0] * 64), (9005, [1.0] * 64), (9006, [1.0] * 3),
        (9007, [2.0] * 3), (9008, []), (9009, [float("inf")] * 64)]
    docs = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding")
    docs = docs.unionByName(spark.createDataFrame(cluster + odd, docs.schema))
    rows = docs.collect()
    good = [i for i, r in enumerate(rows) if r.embedding and all(x is not None and np.isfinite(x) for x in r.embedding)
            and any(r.embedding)]
    unit = {i: np.array(rows[i].embedding) / np.linalg.norm(rows[i].embedding) for i in good}
    near = [(a, b) for a, b in itertools.combinations(good, 2) if len(unit[a]) == len(unit[b])
            and unit[a] @ unit[b] >= 0.95]
    group = roots(range(len(rows)), near)
    links = Counter(x for p in near for x in p)
    least = {}
    for i, r in enumerate(rows):
        if r.vec_id is not None:
            least[group[i]] = min(least.get(group[i], 1 << 60), r.vec_id)
    want = Counter(
        (r.vec_id, links[i], least.get(group[i]), r.vec_id == least.get(group[i])) for i, r in enumerate(rows))
    assert Counter(map(tuple, embeddings.classes(docs).collect())) == want
    assert max(links.values()) > 20
    assert embeddings.classes(docs.limit(0)).count() == 0


def link_counts(unit):
    """Links of each vector at cosine 0.95, and the smallest and largest cosine's distance from it."""
    cosines = unit @ unit.T
    np.fill_diagonal(cosines, 0)
    return (cosines >= 0.95).sum(1), np.abs(cosines - 0.95).min()


@pytest.mark.parametrize("jitter", [1e-4, 1e-5, 1e-6, 1e-7])
def test_tight_clusters_over_several_boxes(spark, jitter, monkeypatch):
    monkeypatch.setattr(embeddings, "HOMES", 64)
    rng = np.random.default_rng(8)
    centre = rng.standard_normal(64)
    centre /= np.linalg.norm(centre)
    tight = centre + jitter * rng.standard_normal((300, 64))
    side = rng.standard_normal((300, 64))
    side -= np.outer(side @ centre, centre)
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    cosine = rng.uniform(0.9505, 0.97, (300, 1))
    vectors = np.concatenate([tight, cosine * centre + np.sqrt(1 - cosine ** 2) * side])
    want, margin = link_counts(vectors / np.linalg.norm(vectors, axis=1, keepdims=True))
    assert margin > 1e-12
    frame = spark.createDataFrame(list(enumerate(vectors.tolist())), "vec_id bigint, embedding array<double>")
    got = {r.vec_id: r.n_links for r in embeddings.classes(frame).collect()}
    assert [got[i] for i in range(len(want))] == want.tolist()


def test_a_pair_at_the_edge_of_a_share_counts_once(spark):
    # Pairs in one direction of block 0 and one of block 1, their distance in block 0 within
    # 3e-8 of its share: single precision decides some of them either way.
    rng = np.random.default_rng(5)
    by = embeddings.rotation(64).astype(np.float64)
    share = 0.1 / 8 + embeddings.SLACK
    pairs = []
    for i in range(400):
        base = rng.standard_normal(64)
        apart = np.zeros(64)
        apart[0], apart[9] = np.sqrt(share + rng.uniform(-3e-8, 3e-8)), 0.05
        base[[0, 9]] = -apart[[0, 9]] / 2
        rest = np.setdiff1d(np.arange(64), [0, 9])
        base[rest] *= np.sqrt((1 - (base[[0, 9]] ** 2).sum()) / (base[rest] ** 2).sum())
        pairs += [base @ by.T, (base + apart) @ by.T]
    vectors = np.array(pairs)
    want, margin = link_counts(vectors / np.linalg.norm(vectors, axis=1, keepdims=True))
    assert margin > 1e-12 and (want == 1).all()
    frame = spark.createDataFrame(list(enumerate(vectors.tolist())), "vec_id bigint, embedding array<double>")
    assert all(r.n_links == 1 for r in embeddings.classes(frame).collect())


def test_pairs_too_close_for_single_precision(spark):
    # Cosines within 1e-7 of the least one on either side; every other vector comes three times.
    rng = np.random.default_rng(6)
    vectors = []
    for i in range(200):
        a, b = np.linalg.qr(rng.standard_normal((64, 2)))[0].T
        cosine = 0.95 + (1 if i % 3 else -1) * 10.0 ** rng.uniform(-11, -7)
        vectors += [a] * (1 + 2 * (i % 2)) + [cosine * a + np.sqrt(1 - cosine ** 2) * b]
    vectors = np.array(vectors)
    want, margin = link_counts(vectors / np.linalg.norm(vectors, axis=1, keepdims=True))
    assert 1e-13 < margin < 1e-9 and {0, 1, 3} <= set(want.tolist())
    frame = spark.createDataFrame(list(enumerate(vectors.tolist())), "vec_id bigint, embedding array<double>")
    got = {r.vec_id: r.n_links for r in embeddings.classes(frame).collect()}
    assert [got[i] for i in range(len(want))] == want.tolist()


def test_boxes_fill_the_space_without_overlap():
    rng = np.random.default_rng(9)
    for sample in (rng.standard_normal((50, 8)), np.zeros((20, 8)), np.repeat(rng.standard_normal((2, 8)), 9, axis=0)):
        low, high = embeddings.boxes(sample, 5)
        x = np.concatenate([sample, 3 * rng.standard_normal((500, 8))])
        member = ((low <= x[:, None]) & (x[:, None] < high)).all(axis=2)
        assert len(low) == 32 and (member.sum(axis=1) == 1).all()
        assert (member.argmax(axis=1) == embeddings.inside(x, low, high)).all()
        assert (embeddings.beyond(x, low, high)[member] == 0).all()


def test_fragments_bound_a_task_and_find_the_same(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/embeddings.parquet")
    whole = sorted(map(tuple, embeddings.classes(docs).collect()))
    monkeypatch.setattr(embeddings, "HOMES", 20)
    monkeypatch.setattr(embeddings, "GUESTS", 30)
    assert sorted(map(tuple, embeddings.classes(docs).collect())) == whole


# ------------------------------------------------------------------ sharding


def test_shards_slots_and_growth(spark, sf):
    docs = common.odd(spark).unionByName(common.sample(spark, sf))
    rows = docs.collect()
    got = sharding.placed(docs).collect()
    want = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.law == "key" and r.grown_shard in (r.shard, 8)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(8))
    assert sharding.placed(common.empty(spark)).count() == 0


def test_rows_move_only_within_subtrees_whose_weights_change(spark):
    keys = spark.range(4000).withColumnRenamed("id", "k")
    before = sharding.topology()
    after = [sharding.Shard(s.number, s.region, s.rack, 3.0 if s.number == 1 else s.weight) for s in before]
    moved = sharding.assign(sharding.assign(keys, "k", before), "k", after, "then").where("shard <> then").collect()
    assert moved and all(r.then in (0, 1, 2, 3) for r in moved)
    share = sharding.assign(keys, "k", after).groupBy("shard").count().collect()
    assert {r.shard: r["count"] for r in share}[1] > 900


def test_a_row_that_stands_very_often_is_expanded_whole(spark):
    docs = spark.createDataFrame([(1, "x", "en", "a", 1)] * 9000, common.SCHEMA)
    assert sorted(r.slot for r in sharding.placed(docs).collect()) == list(range(9000))


@pytest.mark.parametrize("bucket_of", ["sharding", "mixing"])
def test_a_hot_key_of_unlike_rows_is_spread_over_buckets(spark, monkeypatch, bucket_of):
    """Rows with a null id and unlike texts: numbered in many windows, not one."""
    module, seen = (sharding if bucket_of == "sharding" else mixing), []
    numbered = module.numbered

    def watched(rows, group, bucket, *rest):
        seen.append(rows.select(bucket.alias("b")).distinct().count())
        return numbered(rows, group, bucket, *rest)

    monkeypatch.setattr(module, "numbered", watched)
    docs = spark.range(4000).selectExpr(
        "cast(null as bigint) as doc_id", "repeat('x', int(id % 3000)) || id as text", "'en' as lang", "'a' as source", "1L as n_chars")
    out = sharding.placed(docs) if bucket_of == "sharding" else mixing.mix_report(docs)
    column = "slot" if bucket_of == "sharding" else "position"
    assert sorted(r[column] for r in out.collect()) == list(range(4000)) and seen[0] > 500


# ------------------------------------------------------------------ mixing


def slow_mix(rows):
    """Slots and positions of (doc_id, source, bytes) rows, one row at a time."""
    counts = Counter(s for _, s, _ in rows)
    weight = {s: n ** mixing.TEMPERATURE for s, n in counts.items()}
    of, total = max(mixing.PARTS, 4 * len(weight)), math.fsum(weight.values())
    share = {s: w / total * (of - len(weight)) for s, w in weight.items()}
    parts = {s: 1 + math.floor(x) for s, x in share.items()}
    by_rest = sorted(share, key=lambda s: (-(share[s] - math.floor(share[s])), s is not None, s or ""))
    for s in by_rest[:of - sum(parts.values())]:
        parts[s] += 1
    had, turns = Counter(), defaultdict(list)
    for slot in range(of):
        open_ = [s for s in parts if had[s] * of < (slot + 1) * parts[s]]
        best = min(open_, key=lambda s: (
            -(-(had[s] + 1) * of // parts[s]), -(-(had[s] + 2) * of // parts[s]), s or "", s is not None))
        turns[best].append(slot)
        had[best] += 1
    placed = []
    for s in parts:
        own = [r for r in rows if r[1] == s]
        own.sort(key=lambda r: (hashlib.md5("|".join(
            "" if x is None else str(x) for x in r).encode()).hexdigest(), r[0] is not None, r[0] or 0))
        for i, (doc_id, _, _) in enumerate(own):
            block = i // mixing.BLOCK_ROWS
            placed.append(((block // parts[s]) * of + turns[s][block % parts[s]], i, doc_id, s, block,
                           block * of // parts[s], -(-(block + 1) * of // parts[s])))
    placed.sort(key=lambda p: p[:2])
    return Counter((d, s, b, rel, due, slot, at) for at, (slot, _, d, s, b, rel, due) in enumerate(placed))


def test_mix_equals_brute_force(spark, sf):
    docs = common.clashing(spark).select(*common.SCHEMA.names).unionByName(common.sample(spark, sf))
    rows = [(r.doc_id, r.source, len((r.text or "").encode())) for r in docs.collect()]
    assert Counter(map(tuple, mixing.mix_report(docs).collect())) == slow_mix(rows)


def test_schedule_of_a_period_is_pfair(spark):
    weights = spark.createDataFrame([("a", 5.0), ("b", 3.0), ("c", 1.0), (None, 1.0)], "source string, weight double")
    shares = mixing.in_parts(weights, 40)
    parts = {r.source: (r.parts, r.of) for r in shares.collect()}
    assert sum(p for p, _ in parts.values()) == 40
    slots = sorted((r.slot, r.source or "", r.source, r.turn) for r in mixing.schedule(shares).collect())
    assert [s[0] for s in slots] == list(range(40))
    had = Counter()
    for slot, _, source, turn in slots:
        assert turn == had[source]
        had[source] += 1
        for s, (p, of) in parts.items():
            assert abs(had[s] - p * (slot + 1) / of) < 1


def test_mix_keeps_all_rows_in_windows(spark, sf):
    docs = common.odd(spark).unionByName(common.sample(spark, sf))
    rows = sorted(mixing.mix_report(docs).collect(), key=lambda r: r.position)
    assert [r.position for r in rows] == list(range(docs.count()))
    assert Counter((r.doc_id, r.source) for r in rows) == Counter((r.doc_id, r.source) for r in docs.collect())
    assert all(r.release <= r.slot < r.deadline for r in rows)
    assert [r.slot for r in rows] == sorted(r.slot for r in rows)
    assert mixing.mix_report(common.empty(spark)).count() == 0


def test_mixed_order_keeps_columns_and_rows(spark, tmp_path):
    docs = common.clashing(spark)
    out = mixing.in_mixed_order(docs)
    assert out.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in out.collect()) == Counter((i, t) for i, t, *_ in common.ODD)


# ------------------------------------------------------------------ chat


@pytest.mark.parametrize("text", [
    "", chat.ESCAPE, "[INST][/INST]</s>", f"a<|im_start|>b{chat.ESCAPE}1<<SYS>>", "<<</SYS>>", "<|end|><|end|>"])
def test_escaping_is_reversible_and_hides_marks(text):
    hidden = chat.escape(text)
    assert chat.unescape(hidden) == text and not any(m in hidden for m in chat.MARKS + chat.OTHERS)


def test_chat_equals_brute_force(spark, sf):
    turns = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text")
    odd = [(None, 0, None, None), (10**6, None, "user", "x"), (10**6, 0, "assistant", "<|endoftext|> <|end|> é␛"),
           (10**6, 0, "assistant", "again")] + [(10**6 + 1, i, "assistant", "a") for i in range(300)]
    turns = turns.unionByName(spark.createDataFrame(odd, turns.schema))
    groups = defaultdict(list)
    for r in [*turns.collect(), *chat.ADDED]:
        conv, turn, role, text = tuple(r)
        text = text or ""
        groups[conv].append((turn is not None, turn or 0, role or "", hashlib.sha256(text.encode()).hexdigest(), text))
    want = Counter()
    for conv, told in groups.items():
        told.sort()
        whole = "".join(f"{t[2]}\n{t[4]}\n" for t in told)
        loss = "".join(t[4] for t in told if t[2] == "assistant")
        size = sum(len(f"<|turn|>{t[2]}<|text|>{chat.escape(t[4])}<|end|>") for t in told)
        want[(conv, len(told), hashlib.sha256(whole.encode()).hexdigest(), len(loss),
              hashlib.sha256(loss.encode()).hexdigest(), size)] += 1
    got = chat.report(turns.withColumn("ids", turns.text), queries.tokenizer_definition()).drop("n_tokens").collect()
    assert Counter(map(tuple, got)) == want


# ------------------------------------------------------------------ pages


@pytest.fixture(scope="module")
def trees(spark):
    return main_text.fit(spark)


def test_held_out_pages(trees):
    rng = random.Random(99)
    pages = [main_text.sample_page(rng) for _ in range(300)]
    got = main_text.texts([p for p, _ in pages], trees)
    assert sum(g == w for g, (_, w) in zip(got, pages)) >= 0.95 * len(pages)


def test_pages_of_the_corpus(spark, sf, trees):
    import html

    rows = spark.read.parquet(f"{sf}/pages.parquet").collect()
    got = main_text.texts([r.html for r in rows], trees)
    same = 0
    for text, r in zip(got, rows):
        inside = r.html[r.html.index("<article>"):r.html.index("</article>")]
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|br|h1)>", inside))
        same += text == "\n".join(b for b in blocks if b)
    assert same >= 0.98 * len(rows)


def test_decoding_never_keeps_below_a_dropped_node(trees):
    rng = random.Random(5)
    for _ in range(50):
        nodes = main_text.parse(main_text.sample_page(rng)[0])
        kept = main_text.decode(nodes, np.array([rng.uniform(-4, 4) for _ in nodes]))
        assert all(kept[n.parent] for n, k in zip(nodes[1:], kept[1:]) if k)


def test_odd_pages(spark, trees):
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    pages = [None, "", "plain text only", "<p>&lt;b&gt; &amp;amp; &am", "<script>var a='</p>'", "<!-- open", "<a href='",
             deep, "</p></div><li>", "<table><tr><td>a<td>b</table>"]
    frame = spark.createDataFrame([(i, "u", p, "x") for i, p in enumerate(pages)],
                                  "page_id bigint, url string, html string, text string")
    got = {r.page_id: r.text for r in main_text.extract(frame, trees).collect()}
    assert got[0] == got[1] == got[4] == got[5] == "" and len(got) == len(pages)
    assert main_text.extract(frame.limit(0), trees).count() == 0


# ------------------------------------------------------------------ pipeline


PLANTED_TEXT = "Der Hafen lag still, und die Boote schaukelten leise im Wind; niemand sprach ein Wort an jenem Abend. "


def planted_documents():
    """Odd rows, junk, and texts with copies, near copies, secrets and clean ones, under clashing columns."""
    rng = random.Random(21)
    rows = list(common.ODD)
    for i in range(40):
        words = [rng.choice(["hand", "wort", "Stein", "licht", "wasser", "grün", "weit", "Tür,", "auf", "zu", "über"])
                 + rng.choice("abcdefgh") for _ in range(120)]
        rows.append((100 + 3 * i, " ".join(words), "de", f"s{i % 3}", 1))
        if i % 4 == 0:
            rows.append((101 + 3 * i, " ".join(words), "de", "s9", 1))
        if i % 5 == 0:
            rows.append((102 + 3 * i, " ".join(words) + " password: hunter2secret", "de", "s1", 1))
    rows += [(300, "### $$$ %%% &&& " * 30, "de", "s0", 1), (301, "no", "de", "s0", 1), (302, PLANTED_TEXT * 2, None, None, 1)]
    return rows


def test_pipeline_stages_equal_brute_force(spark, sf, tmp_path):
    """Each stage against plain Python over its own input."""
    docs = spark.createDataFrame(planted_documents(), common.SCHEMA)
    for name in common.CLASHING:
        docs = docs.withColumn(name, F.lit("x"))
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules", "SimHash near duplicates", "secrets", "mixing", "tokens"]

    def after(name, frame):
        stages[name](spark, frame, sf).write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    def key(r):
        return r.doc_id, r.text, r.lang, r.source

    # Quality: the verdicts of the rules, row by row.
    good = after("quality rules", docs)
    verdict = {}
    for r in quality.verdicts(docs).collect():
        verdict.setdefault((r.doc_id, r.n_words), r.kept)
    want = Counter(key(r) for r in docs.collect() if verdict[r.doc_id, len((r.text or "").encode().split())])
    assert Counter(map(key, good.collect())) == want and 300 not in {k[0] for k in want}

    # Near duplicates: the smallest id of each group of fingerprints within two bits.
    apart = after("SimHash near duplicates", good)
    rows = good.collect()
    prints = [slow_fingerprint(r.text or "") for r in rows]
    group = roots(set(prints), [(a, b) for a, b in itertools.combinations(set(prints), 2) if (a ^ b).bit_count() <= 2])
    least = {}
    for r, fp in zip(rows, prints):
        least[group[fp]] = min(least.get(group[fp], (True, 0)), (r.doc_id is None, r.doc_id or 0))
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in apart.collect()) == sorted(least.values())
    assert len(least) < len(rows)

    # Secrets: nothing of a finding is left, all else is as it was.
    clean = after("secrets", apart)
    before = {r.doc_id: r for r in apart.collect()}
    got = clean.collect()
    assert {r.doc_id for r in got} == set(before) and any("hunter2secret" in r.text for r in before.values())
    for r in got:
        assert "hunter2secret" not in r.text and r.n_chars == len(r.text)
        if "password" not in before[r.doc_id].text:
            assert r.text == before[r.doc_id].text

    # Mixing: the same rows, in the order of the report's positions.
    mix = after("mixing", clean)
    position = {r.doc_id: r.position for r in mixing.mix_report(clean).collect()}
    order = [r.doc_id for r in stages["mixing"](spark, clean, sf).collect()]
    assert order == sorted(order, key=position.get) and Counter(map(key, mix.collect())) == Counter(map(key, got))

    # Tokens: the library's ids.
    from tokenizers import Tokenizer
    library = Tokenizer.from_str(queries.tokenizer_definition())
    tokens = after("tokens", mix)
    texts = {r.doc_id: r.text for r in got}
    for r in tokens.collect():
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.n_tokens == len(ids)
    assert tokens.count() == len(got)


def test_pipeline_stages(spark, sf, tmp_path):
    docs = common.sample(spark, sf)
    columns, before = docs.columns, None
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(f"{tmp_path}/{name}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{name}")
        assert name == "tokens" or docs.columns == columns
        assert 0 < docs.count() <= before.count()
    assert docs.count() == before.count() and docs.where("n_tokens = 0").count() == 0


def test_pipeline_stages_take_empty_tables(spark, sf):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, common.empty(spark), sf).count() == 0
