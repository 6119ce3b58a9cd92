"""Session factory and shared-storage helpers.

Every job and test gets its session here, so the settings the library relies on
(UTC calendar, AQE with skew handling, RocksDB state) are in one place.
Scratch data (streaming checkpoints, staged files, change logs written by the
registered queries) always lives under the folder the cluster names in
``spark.checkpoint.dir``; a private folder is made only when that is unset,
which is the case in local tests.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

# Settings that results depend on or that keep big plans healthy.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # No broadcast on the planner's size estimate (compressed file size); joins
    # broadcast only when AQE has measured the materialized side.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
}

# Every stateful operator has a store a partition, each with buffers of its own outside the heap; bounded, they
# share one cache an executor.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "500",
    # A restart needs the state of the last batch, or of the one before if that is repeated.
    "spark.sql.streaming.minBatchesToRetain": "2",
}

DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_session(
    master: str | None = None,
    app: str = "lakelayer",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and scratch tables.

    Read from the session; only when the cluster names none (local tests) is a
    private folder created and registered as the checkpoint dir.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if root:
        return root.rstrip("/")
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="lakelayer-ckpt-")
    sc.setCheckpointDir(root)
    return (sc.getCheckpointDir() or root).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder below the checkpoint root."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def ensure_state_provider(spark: SparkSession) -> None:
    """State belongs on disk: the RocksDB provider (transformWithState needs it) within bounded memory, and this
    package in the Python workers."""
    ship_package(spark)
    for k, v in STATE_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that run, and streams that start, in here delete their shuffle files when they (a stream's batch) are
    done. Otherwise the files stay until the driver happens to collect garbage."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per Spark context.

    Functions that run in tasks are pickled by reference, so a worker must be
    able to import the package wherever the driver was started from.
    """
    sc = spark.sparkContext
    if getattr(sc, "_lakelayer_shipped", False):
        return
    here = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="lakelayer-ship-")) / "lakelayer.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(here.rglob("*.py")):
            z.write(f, f.relative_to(here.parent))
    sc.addPyFile(str(archive))
    sc._lakelayer_shipped = True


__all__ = [
    "get_session",
    "checkpoint_root",
    "scratch_path",
    "shuffle_partitions",
    "ensure_state_provider",
    "shuffles_dropped",
    "ship_package",
]
