"""Session construction and the shared scratch location.

Library code never invents a machine-local folder on a cluster: scratch
tables live under ``spark.checkpoint.dir`` read from the session. Only when
that is unset (local tests) is a private temporary directory chosen.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

from .config import DEFAULT, Tuning

LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.driver.memory": "16g",
}


def cluster_conf(input_bytes: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Suggested settings for a cluster run over ``input_bytes`` of input.

    Initial shuffle partitions are sized so each holds about
    ``partition_bytes`` before AQE coalesces small ones and splits skewed
    ones; input splits are the same size, so a task's sort and hash buffers
    fit executor memory. Dedupe state for streams goes to RocksDB (off heap,
    spills to local disk) instead of the JVM heap.
    """
    partitions = max(200, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.session.timeZone": "UTC",
        # Spark ML's tree training shuffles JVM objects (RDD aggregates): Kryo.
        "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }


#: State on the executors' disks with a bound on its memory; a row is put without a look at what was there.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


@contextmanager
def with_conf(spark: SparkSession, conf: Mapping[str, str]) -> Iterator[None]:
    """``conf`` inside the block, the session's own values after it. A stream keeps those it was started with."""
    had = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in had.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def state_partitions(spark: SparkSession, rows: int, tuning: Tuning = DEFAULT) -> int:
    """Partitions for a stream's state of ``rows`` keys: one a core, more by ``Tuning.state_rows``, at most the session's."""
    wanted = max(spark.sparkContext.defaultParallelism, -(-rows // tuning.state_rows))
    return min(wanted, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def local_session(cores: int | str = "*", app: str = "churnlens", **extra: str) -> SparkSession:
    """Local-mode session used by tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in {**LOCAL_CONF, **extra}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder from the session.

    When it is unset, a private temporary folder is chosen in local mode (as in
    tests); on a cluster that would be machine-local, so it is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session has no local SparkContext
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = (sc.master if sc is not None else spark.conf.get("spark.master", "")) or ""
        if not master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: set it to a folder every executor "
                             "and the driver share (scratch tables and lineage cuts go there)")
        configured = tempfile.mkdtemp(prefix="churnlens-ckpt-")  # local mode only
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "churnlens", f"{name}-{uuid.uuid4().hex[:12]}")
