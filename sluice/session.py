"""Settings the library needs on a session it is given, and lineage cutting."""

from __future__ import annotations

import tempfile
import threading
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTINGS = {
    # Event times are stored without a zone and mean UTC.
    "spark.sql.session.timeZone": "UTC",
    # Re-plan joins and split or merge shuffle partitions from measured sizes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Keep streaming state (watermarked windows, de-duplication) off the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to ``spark`` and return it.

    The number of shuffle partitions, memory and timeouts belong to the cluster
    and are left as they are.
    """
    for name, value in _SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def create_session(app_name: str, master: str | None = None) -> SparkSession:
    """A configured session for one application of long-running streams.

    ``master`` is only needed outside ``spark-submit``.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        # Streams of one application take turns instead of queueing behind each other.
        .config("spark.scheduler.mode", "FAIR")
        # How long a silent executor is waited for.
        .config("spark.network.timeout", "600s")
        .config("spark.executor.heartbeatInterval", "60s")
    )
    if master is not None:
        builder = builder.master(master)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a single-machine session may go without it; it then gets a fresh
    temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="sluice-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


@contextmanager
def freeing_shuffles(spark: SparkSession, seconds: float = 20):
    """Have the shuffle files of finished jobs removed while the block runs, and at its end.

    Spark removes them once the driver's garbage collector finds them unused, which may take
    it until long after the disks are full. ``spark.cleaner.periodicGC.interval`` does the
    same where the session's settings can be chosen.
    """
    collect, ended = spark.sparkContext._jvm.System.gc, threading.Event()

    def repeat() -> None:
        while not ended.wait(seconds):
            collect()

    thread = threading.Thread(target=repeat, daemon=True)
    thread.start()
    try:
        yield
    finally:
        ended.set()
        thread.join()
        collect()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once, so later reads all see the same rows."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)
