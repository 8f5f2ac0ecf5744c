"""Secret scan: fixed patterns, and strings that look random.

The patterns give the base findings.  Further findings are runs of key
characters (``RUN``) that a character Markov model of random strings explains
better than one of ordinary identifiers, by a log-likelihood ratio of at least
``THRESHOLD`` thousandths of a nat, and that touch no base finding.  Runs of fewer
than ``SHORTEST_RUN`` characters are not scored: a key that short is found by the
base patterns only.  Both models
are trained from labelled samples: generated keys in the usual alphabets, and
ordinary words, joined identifiers, numbers and dates.  The words are ``NAME_WORDS`` and
at most ``SAMPLE_WORDS`` of at most ``SAMPLE_DOCUMENTS`` documents; that
bounds the training, not the scan, which covers every whole text.

All of it is DataFrame and SQL functions.  The models end in one table of
128 x 128 integers, which is added up along a string.

Defined results: null and empty texts have no findings; rows are scanned one by
one, so repeated rows give repeated results; other columns are carried along,
but one with the name of a result column is replaced; with an empty table to
learn words from, the generated identifiers alone stand for ordinary text.
Positions are code points from 0, ends exclusive.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradetide.llm.rows import packed, unpacked

SAMPLE_DOCUMENTS, SAMPLE_WORDS, SAMPLE_KEYS = 2_000, 20_000, 20_000
THRESHOLD = 12_000
SHORTEST_RUN = 12
MARK = "[SECRET]"

# Words that ordinary names are made of, whatever the corpus's language.
NAME_WORDS = (
    "add all and any app array as at back base be block body by call case check class client close code color"
    " column config content count create data date default delete of on end error event example false field file"
    " first for form format from function get group handle hash header height id image in index info init input"
    " is item key label last length level line link list load local log main map max message method min mode"
    " model module name new next node not null number object old open option or order out page param parent"
    " path point port position process project query read record remove request reset response result return"
    " root row run save score search section select server service set size some sort source start state status"
    " step stop string style table target temp test text the this time title to token total tree true type"
    " update url use user value version view where width with word write")

# The base patterns, the group that must be long enough, and its length.
BASE = [
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
]
# Shorter runs fail anyway; asking for the length in the pattern finds the same runs sooner.
SOONER = {"access": r"AKIA[A-Z0-9]{16,}", "hex": r"[0-9a-f]{24,}"}
RUN = rf"[A-Za-z0-9+/_=-]{{{SHORTEST_RUN},}}"
PIECE = 256  # matches whose positions are added up at a time
SPANS = "array<struct<start:int,kind:int,end:int>>"


def generated_keys(spark: SparkSession, rows: int = SAMPLE_KEYS) -> DataFrame:
    """Random strings in the alphabets keys use, from digests of the row number."""
    digest = F.sha2(F.col("id").cast("string"), 512)
    base64 = F.base64(F.unhex(digest))
    return spark.range(rows).select(F.element_at(F.array(
        F.substring(digest, 1, 40),
        F.substring(base64, 1, 40),
        F.translate(F.substring(base64, 1, 40), "+/", "-_"),
        F.regexp_replace(F.substring(base64, 1, 48), "[+/=]", ""),
        F.upper(F.regexp_replace(F.substring(base64, 1, 40), "[+/=]", "")),
    ), (F.col("id") % 5 + 1).cast("int")).alias("text"))


def ordinary_identifiers(docs: DataFrame, text: str = "text") -> DataFrame:
    """Words of a bounded sample of documents, alone and joined as in names, paths and
    constants, and generated numbers, dates and rules."""
    spark = docs.sparkSession
    key = F.xxhash64(*[c for c in docs.columns if c != text]) if len(docs.columns) > 1 else F.xxhash64(text)
    sample = docs.select(F.col(text).alias("text"), key.alias("k"))
    most = sample.select("k").orderBy("k").limit(SAMPLE_DOCUMENTS).agg(F.max("k")).first()[0]
    kept = sample.where(F.col("k") <= F.lit(most))
    words = (
        kept.select(F.explode(F.regexp_extract_all("text", F.lit(r"(?<![^\s])[A-Za-z]{2,}(?=[\s.,;:!?])"), F.lit(0))).alias("w"))
        .distinct().orderBy(F.xxhash64("w"), "w").limit(SAMPLE_WORDS))
    names = spark.range(1).select(F.explode(F.split(F.lit(NAME_WORDS), " ")).alias("w"))
    words = words.unionByName(names)
    # Each word with the two after it in three of 64 classes by hash.
    ranked = words.select("w", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("turn")).select(
        "w", F.pmod(F.xxhash64("w", "turn"), F.lit(64)).alias("c"))
    firsts = ranked.groupBy("c").agg(F.sort_array(F.collect_list("w")).alias("all"))
    several = firsts.select(F.posexplode("all").alias("i", "a"), "all").select(
        "a", F.coalesce(F.get("all", F.col("i") + 1), "a").alias("b"),
        F.coalesce(F.get("all", F.col("i") + 2), "a").alias("c"))
    joined = several.select(F.explode(F.array(
        "a", F.concat_ws("_", "a", "b", "c"), F.concat_ws("-", "a", "b", "c"),
        F.concat_ws("/", "a", "b", "c"), F.concat("a", F.initcap("b"), F.initcap("c")),
        F.upper(F.concat_ws("_", "a", "b")), F.concat("a", "b", "c"))).alias("text"))
    n = F.col("id")
    numbers = spark.range(4_000).select(F.explode(F.array(
        F.format_string("%04d-%02d-%02d", 1990 + n % 40, 1 + n % 12, 1 + n % 28),
        F.pmod(F.xxhash64("id"), F.lit(10**16)).cast("string"),
        F.concat(F.pmod(F.xxhash64("id"), F.lit(10**9)).cast("string"), F.lit("-"), n.cast("string")),
        F.repeat(F.element_at(F.split(F.lit("- _ = + /"), " "), (n % 5 + 1).cast("int")), (2 + n % 60).cast("int")),
    )).alias("text"))
    return joined.unionByName(numbers)


def labelled_samples(docs: DataFrame, text: str = "text") -> DataFrame:
    """(text, random): what the models are trained from."""
    return generated_keys(docs.sparkSession).withColumn("random", F.lit(True)).unionByName(
        ordinary_identifiers(docs, text).withColumn("random", F.lit(False)))


def train(samples: DataFrame) -> list[int]:
    """Log-likelihood ratios of two characters in a row, in thousandths of a nat.

    The entry of characters a, b is at 128 * a + b.  ^ and $ stand for the ends.
    Only counts by pair of characters come to the driver: 2 x 128 x 128 rows at most.
    """
    chars = F.split(F.concat(F.lit("^"), "text", F.lit("$")), "")
    pairs = F.explode(F.arrays_zip(chars.alias("a"), F.slice(chars, 2, F.size(chars)).alias("b"))).alias("p")
    counts = (
        samples.where("text rlike '^[ -~]+$'").select("random", pairs)
        .select("random", F.ascii("p.a").alias("a"), F.ascii("p.b").alias("b")).where("b > 0")
        .groupBy("random", "a", "b").count().collect())
    seen = {(r["random"], r["a"], r["b"]): r["count"] for r in counts}
    after = {}
    for (random, a, _), n in seen.items():
        after[random, a] = after.get((random, a), 0) + n
    size = 66

    def log_probability(random, a, b):
        return math.log((seen.get((random, a, b), 0) + 0.5) / (after.get((random, a), 0) + 0.5 * size))

    return [
        round(1000 * (log_probability(True, a, b) - log_probability(False, a, b)))
        for a in range(128) for b in range(128)]


def score(run: Column, model: list[int]) -> Column:
    """Log-likelihood ratio of a string of ASCII characters."""
    table = F.expr(f"cast(split('{','.join(map(str, model))}', ',') as array<int>)")
    codes = F.transform(F.split(F.concat(F.lit("^"), run, F.lit("$")), ""), F.ascii)
    return F.aggregate(
        codes, F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-1).alias("before")),
        lambda acc, code: F.struct(
            F.when((acc["before"] >= 0) & (code > 0),
                   acc["sum"] + F.coalesce(F.get(table, acc["before"] * 128 + code), F.lit(0)))
            .otherwise(acc["sum"]).alias("sum"),
            F.when(code > 0, code).otherwise(acc["before"]).alias("before")),
        lambda acc: acc["sum"])


def located(text: str, found: str, pattern: str, kind: int) -> Column:
    """Spans of the leftmost non-overlapping matches ``found`` (a column of strings): the
    text between them comes from splitting at them, and lengths add up to positions."""
    between = F.split(F.col(text), pattern, -1)
    sizes = F.transform(
        F.arrays_zip(F.col(found).alias("m"), between.alias("g")),
        lambda x: F.struct(F.length(x["g"]).alias("gap"), F.length(x["m"]).alias("len")))
    none = F.expr(f"cast(array() as {SPANS})")

    def add(acc: Column, x: Column) -> Column:
        return F.when(x["len"].isNull(), acc).otherwise(F.struct(
            (acc["at"] + x["gap"] + x["len"]).alias("at"),
            F.concat(acc["out"], F.array(F.struct(
                (acc["at"] + x["gap"]).alias("start"), F.lit(kind).alias("kind"),
                (acc["at"] + x["gap"] + x["len"]).alias("end")))).cast(SPANS).alias("out")))

    def add_piece(acc: Column, some: Column) -> Column:
        done = F.aggregate(some, F.struct(acc["at"].alias("at"), none.alias("out")), add)
        # A fold of one element gives the result of the inner fold a name.
        return F.aggregate(
            F.array(done), acc, lambda a, d: F.struct(
                d["at"].alias("at"), F.concat(a["out"], F.array(d["out"])).cast(f"array<{SPANS}>").alias("out")))

    def whole(all_sizes: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as array<{SPANS}>)").alias("out"))
        firsts = F.sequence(F.lit(1), F.size(all_sizes), F.lit(PIECE))
        return F.flatten(F.aggregate(
            firsts, start, lambda acc, first: add_piece(acc, F.slice(all_sizes, first, F.lit(PIECE))),
            lambda acc: acc["out"]))

    # Spans grow piece by piece: a fold that appends to one array copies it each time.
    spans = F.element_at(F.transform(F.array(sizes), whole), 1)
    return F.when(F.size(found) == 0, none).otherwise(spans)


def scan(docs: DataFrame, model: list[int], text: str = "text") -> DataFrame:
    """``docs`` with ``base`` and ``found``: sorted spans (start, kind, end) of the base
    patterns, and of all findings.  ``kind`` counts the names of KINDS."""
    names = {k: f"_{k}" for k, *_ in BASE}
    frame = docs.drop("base", "found", "_text").withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    frame = frame.withColumns(
        {names[k]: F.regexp_extract_all("_text", F.lit(SOONER.get(k, p)), F.lit(0)) for k, p, *_ in BASE}
        | {"_run": F.regexp_extract_all("_text", F.lit(RUN), F.lit(0))})
    spans = []
    for number, (kind, pattern, group, least) in enumerate(BASE):
        at = located("_text", names[kind], SOONER.get(kind, pattern), number)
        if kind not in SOONER:
            value = F.regexp_extract_all("_text", F.lit(pattern), F.lit(group))
            long_enough = F.filter(
                F.arrays_zip(at.alias("s"), value.alias("v")), lambda x: F.length(x["v"]) >= least)
            at = F.when(F.size(names[kind]) == 0, F.expr(f"cast(array() as {SPANS})")).otherwise(
                F.transform(long_enough, lambda x: x["s"]))
        spans.append(at)
    frame = frame.withColumn("base", F.array_sort(F.concat(*spans)))
    likely = F.transform("_run", lambda run: score(run, model) >= THRESHOLD)
    frame = frame.withColumn("_likely", F.when(F.size("_run") == 0, F.array().cast("array<boolean>")).otherwise(likely))
    some = F.exists("_likely", lambda x: x)
    runs = F.filter(
        F.arrays_zip(located("_text", "_run", RUN, len(BASE)).alias("s"), F.col("_likely").alias("y")),
        lambda x: x["y"] & ~F.exists("base", lambda b: (b["start"] < x["s"]["end"]) & (x["s"]["start"] < b["end"])))
    more = F.when(some, F.transform(runs, lambda x: x["s"])).otherwise(F.expr(f"cast(array() as {SPANS})"))
    return frame.withColumn("found", F.array_sort(F.concat("base", more))).drop(
        "_text", "_run", "_likely", *names.values())


KINDS = [*(k for k, *_ in BASE), "markov"]


def written(spans: str) -> Column:
    """kind:start:end of all spans, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def findings(docs: DataFrame) -> DataFrame:
    """doc_id, numbers of base findings by kind, their digest, and all spans."""
    scanned = scan(docs.select("doc_id", "text"), train(labelled_samples(docs.select("doc_id", "text"))))

    def number_of(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return scanned.select(
        "doc_id", *[number_of(i).alias(f"n_{k}") for i, (k, *_) in enumerate(BASE)],
        F.sha2(written("base"), 256).alias("base_sha256"), written("found").alias("spans"))


def redact(docs: DataFrame, model: list[int], text: str = "text") -> DataFrame:
    """``docs`` with every finding in the text replaced by ``MARK``; findings that overlap
    become one mark.  Null texts stay null."""
    scanned = scan(packed(docs, text), model)
    merged = F.aggregate(
        "found", F.expr(f"cast(array() as {SPANS})"),
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= s["start"]),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
                F.element_at(acc, -1)["start"].alias("start"), s["kind"].alias("kind"),
                F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end")))).cast(SPANS))
        .otherwise(F.concat(acc, F.array(s)).cast(SPANS)))
    scanned = scanned.withColumn("_m", F.when(F.size("found") > 0, merged))
    kept = F.transform("_m", lambda s, i: F.concat(
        F.substring(F.col("text"), F.when(i == 0, F.lit(1)).otherwise(F.get("_m", i - 1)["end"] + 1),
                    s["start"] - F.when(i == 0, F.lit(0)).otherwise(F.get("_m", i - 1)["end"])),
        F.lit(MARK)))
    rest = F.substring(F.col("text"), F.element_at("_m", -1)["end"] + 1, F.length("text"))
    hidden = scanned.withColumn("text", F.when(
        F.size("found") > 0, F.concat(F.array_join(kept, ""), rest)).otherwise(F.col("text")))
    return unpacked(hidden, docs.columns, text)
