"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# What a job should run with.  AQE coalesces small shuffle partitions and
# splits skewed ones, so the partition count only has to be large enough.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
STATE_PARTITIONS = "tradetide.statePartitions"


SHUFFLE_TARGET = 128 * 1024 * 1024


def configure(spark: SparkSession, shuffle_bytes: int | None = None) -> SparkSession:
    """Apply the runtime settings every transform here relies on.

    ``shuffle_bytes`` is the size of the largest shuffle to expect, for example
    of the pruned payment columns.  Shuffles then start with enough partitions
    for it, and adaptive execution merges those that turn out small.
    """
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    if shuffle_bytes is not None:
        fixed = int(spark.conf.get("spark.sql.shuffle.partitions"))
        wanted = max(fixed, -(-shuffle_bytes // SHUFFLE_TARGET))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", wanted)
    return spark


def stateful(spark: SparkSession, state_partitions: int) -> SparkSession:
    """A session of its own for stateful queries.

    The number of state partitions is fixed for good by a query's first start and is
    not adapted later: set it for the state the job will hold one day, whatever the
    cluster it starts on.  Streams of a job are read in this session.
    """
    if state_partitions < 1:
        raise ValueError("a stateful query needs at least one state partition")
    own = spark.newSession()
    for name, value in SETTINGS.items():
        own.conf.set(name, value)
    own.conf.set(STATE_PROVIDER, ROCKSDB)
    own.conf.set(STATE_PARTITIONS, state_partitions)
    own.conf.set("spark.sql.shuffle.partitions", state_partitions)
    return own


def checked_state_session(stream: DataFrame) -> SparkSession:
    """The stream's session, if it is one of ``stateful``."""
    spark = stream.sparkSession
    if spark.conf.get(STATE_PARTITIONS, None) is None:
        raise ValueError("read the stream in a session of session.stateful, which fixes the state partitions")
    return spark


def state_partitions_of(spark: SparkSession) -> int:
    return int(spark.conf.get(STATE_PARTITIONS))


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it then gets a temporary
    folder.  On a cluster a machine-local path would be lost with its machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="tradetide-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
