"""Documents that every operator must take: nulls, empty and long texts, ties, repeats, clashing columns."""

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())])
LONG = " ".join(f"word{i % 977}" for i in range(30_000))
ODD = [
    (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \t\n", None, None, 3), (None, "no id here", "en", "b", 10),
    (4, "same same same", "en", "a", 14), (4, "same same same", "en", "a", 14), (4, "other text", "de", "a", 10),
    (5, LONG, "en", None, len(LONG)), (6, "é ß 日本語 😀   x", "fr", "b", 14), (7, "same same same", "en", "b", 14),
]
CLASHING = ["fp", "component_id", "digest", "base", "found", "_text", "ids", "n_tokens", "n_words", "kept",
            "position", "block", "row", "key", "copies", "shard"]


def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


def clashing(spark):
    frame = odd(spark)
    for name in CLASHING:
        frame = frame.selectExpr("*", f"'x' as {name}")
    return frame


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def sample(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
