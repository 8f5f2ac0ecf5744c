"""Result tables: the latest value per key, written batch by batch.

Each batch of changes is one ``batch_id=N`` folder.  Writing a batch replaces
that folder only, so a micro-batch that is replayed after a failure leaves the
table as it was.  The current value of a key is the one of its latest batch.

Batches are grouped in generations of ``span`` batches.  A generation starts
from a base, the current values at its beginning, so reading the table never
takes more than one generation, however long a job has been running.  Finding
the newest one lists the generations' names and that one's folder, not the
batches of the others.  Older generations are not read again; ``prune`` removes them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradetide.functions import exact_sum, to_money


class KeyedTable:
    """Keys to a double.  A null value marks a deleted key.

    One writer at a time, with rising batch numbers.
    """

    def __init__(self, spark: SparkSession, path: str, keys: str = "key string", span: int = 256):
        self.spark = spark
        self.path = path.rstrip("/")
        self.span = span
        fields = T.StructType.fromDDL(keys)
        self.keys = fields.fieldNames()
        self.schema = fields.add("value", "double")
        self._ready = 0

    def create(self) -> KeyedTable:
        """Start the table, or leave it alone where it exists."""
        empty = self.spark.createDataFrame([], self.schema)
        empty.write.mode("ignore").parquet(self._folder(0, -1))
        return self

    # ------------------------------------------------------------- reading

    def history(self, upto: int | None = None) -> DataFrame:
        """Changes since the latest base, or since the one in use at a batch."""
        if upto is None:
            return self._changes(self._newest())
        return self._changes(upto // self.span).filter(F.col("batch_id") <= upto)

    def current(self, upto: int | None = None) -> DataFrame:
        """Current value per key; ``upto`` gives the state right after a batch."""
        return self._latest(self.history(upto))

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The given keys with their current value, null where there is none."""
        return keys.select(*self.keys).join(self.current(), self.keys, "left")

    # ------------------------------------------------------------- writing

    def upsert(self, rows: DataFrame, batch_id: int) -> None:
        """Set keys to absolute values; ``rows`` has each key once."""
        self._start_generation(batch_id)
        self._write(rows, self._folder(batch_id // self.span, batch_id))

    def upsert_changed(self, rows: DataFrame, batch_id: int) -> None:
        """Like ``upsert``, but leaves out keys that already have their value."""
        before = self._latest(self._before(batch_id)).withColumnRenamed("value", "published")
        same = F.col("value").eqNullSafe(F.col("published"))
        self.upsert(rows.join(before, self.keys, "left").filter(~same), batch_id)

    def increment(self, deltas: DataFrame, batch_id: int) -> None:
        """Add to keys; unknown keys start from zero and may occur repeatedly."""
        added = deltas.groupBy(*self.keys).agg(exact_sum("value").cast("double").alias("added"))
        old = to_money(F.coalesce("value", F.lit(0.0)))
        total = (old + to_money("added")).cast("double").alias("value")
        joined = added.join(self._latest(self._before(batch_id)), self.keys, "left")
        self.upsert(joined.select(*self.keys, total), batch_id)

    def delete(self, keys: DataFrame, batch_id: int) -> None:
        """Remove keys."""
        gone = keys.select(*self.keys).distinct()
        self.upsert(gone.withColumn("value", F.lit(None).cast("double")), batch_id)

    def reset(self, batch_id: int) -> None:
        """Set every known key to 0.0; this does not delete it."""
        keys = self._before(batch_id).select(*self.keys).distinct()
        self.upsert(keys.withColumn("value", F.lit(0.0)), batch_id)

    def prune(self, keep: int = 2) -> None:
        """Remove all but the newest generations; ``upto`` then reaches back no further."""
        if keep < 1:
            raise ValueError("at least the newest generation stays")
        newest = self._newest()
        for generation in self._numbers(self.path, "generation"):
            if generation <= newest - keep:
                folder = self.spark._jvm.org.apache.hadoop.fs.Path(
                    f"{self.path}/generation={generation}")
                self._files(folder).delete(folder, True)

    # ------------------------------------------------------------ internals

    def _files(self, folder):
        """The file system a Hadoop path lies in."""
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _numbers(self, path: str, name: str, written: bool = False) -> list[int]:
        """Numbers of the folders ``name=N`` right below a path, the newest first; of
        ``written`` ones only those whose writing has ended."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        files = self._files(folder)
        if not files.exists(folder):
            return []
        found = []
        for status in files.listStatus(folder):
            prefix, _, number = status.getPath().getName().partition("=")
            done = self.spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
            if prefix == name and (not written or files.exists(done)):
                found.append(int(number))
        return sorted(found, reverse=True)

    def _folder(self, generation: int, batch_id: int) -> str:
        return f"{self.path}/generation={generation}/batch_id={batch_id}"

    def _write(self, rows: DataFrame, folder: str) -> None:
        out = rows.select(*self.keys, F.col("value").cast("double").alias("value"))
        out.write.mode("overwrite").parquet(folder)

    def _changes(self, generation: int) -> DataFrame:
        schema = T.StructType([*self.schema, T.StructField("batch_id", T.LongType())])
        return self.spark.read.schema(schema).parquet(f"{self.path}/generation={generation}")

    def _latest(self, changes: DataFrame) -> DataFrame:
        latest = changes.groupBy(*self.keys).agg(F.max_by("value", "batch_id").alias("value"))
        return latest.filter("value is not null")

    def _before(self, batch_id: int) -> DataFrame:
        self._start_generation(batch_id)
        return self._changes(batch_id // self.span).filter(F.col("batch_id") < batch_id)

    def _newest(self, below: int | None = None) -> int:
        """Newest generation with a batch of its own.

        One that has only its base may still be being written.
        """
        for generation in self._numbers(self.path, "generation"):
            if below is None or generation < below:
                batches = self._numbers(f"{self.path}/generation={generation}", "batch_id", written=True)
                if batches and batches[0] >= generation * self.span:
                    return generation
        return 0

    def _start_generation(self, batch_id: int) -> None:
        """Write the base of the batch's generation unless batches follow it already."""
        generation = batch_id // self.span
        if generation <= self._ready:
            return
        if self._newest(below=generation + 1) < generation:
            base = self._latest(self._changes(self._newest(below=generation)))
            self._write(base, self._folder(generation, generation * self.span - 1))
        self._ready = generation


def reset_all(tables: list[KeyedTable], batch_id: int) -> None:
    """Set every key ever published in any of the tables to 0.0."""
    for table in tables:
        table.reset(batch_id)


def result_table(spark: SparkSession, path: str) -> KeyedTable:
    """Published results: key to value."""
    return KeyedTable(spark, path).create()
