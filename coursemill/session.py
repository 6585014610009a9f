"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

# AQE does the work that hand-set shuffle counts and forced join types did: it sizes reducers,
# splits skewed join partitions and turns a join into a broadcast once the real size is known.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
    # running totals of many keys live outside the executors' heap, and only what changed is checkpointed
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "coursemill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; keyword settings use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh folder for written intermediates, below the folder the cluster shares between executors.

    ``spark.checkpoint.dir`` names that folder. Only on one machine may it be unset (tests): a local temporary folder is made
    there. On a cluster each executor would write to its own, so that is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not re.fullmatch(r"local(\[[^,]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    base = shared.rstrip("/") if shared else tempfile.mkdtemp(prefix="coursemill-")
    return f"{base}/coursemill/{name}-{uuid.uuid4().hex[:12]}"


@contextlib.contextmanager
def shuffle_files_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write that ends inside are removed with it, not when the driver collects its garbage."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)
