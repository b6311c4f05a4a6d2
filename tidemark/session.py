"""SparkSession construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: What streams keep their state in: outside of the heap. The default provider refuses keyed processors.
STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
PARTITIONS = "spark.sql.shuffle.partitions"

# Settings every session needs for correct results: UTC everywhere (timestamps are compared
# to the microsecond), AQE for runtime re-planning and skew splitting, Arrow for pandas UDFs.
_REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    STATE_PROVIDER: ROCKSDB,
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tidemark") -> SparkSession:
    """Return the active session or build one (local tests / bench)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in _REQUIRED.items():
        builder = builder.config(k, v)
    builder = (builder.config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k, v in _REQUIRED.items():
        if spark.conf.isModifiable(k):
            spark.conf.set(k, v)
        elif spark.conf.get(k, None) != v:
            raise RuntimeError(f"the session needs {k}={v}, and it can only be set when it is started")
    ensure_checkpoint_dir(spark)
    return spark


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session with ``values`` for a moment; what it had before comes back."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``. Only a local master may go without one (tests):
    it gets a private folder; on a cluster that folder would be seen by one machine alone, so it raises."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A location under the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tables", name)
