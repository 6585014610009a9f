"""Batch sinks: name-aligned appends, partition overwrites, bucketed tables, versioned snapshots and change logs."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Codecs offered for written files (LZO has no built-in Parquet writer, zstd takes its place).
CODECS = ("snappy", "zstd", "gzip", "uncompressed")


def insert_by_name(df: DataFrame, table: str, overwrite: bool = False) -> None:
    """Insert into a catalog table by column name; overwriting replaces only the partitions present in ``df``."""
    spark = df.sparkSession
    aligned = df.select(*spark.table(table).columns)
    if not overwrite:
        aligned.write.mode("append").insertInto(table)
        return
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        aligned.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def write_files(
    df: DataFrame,
    path: str,
    *,
    partition_by: Sequence[str] = (),
    overwrite: bool = False,
    codec: str = "zstd",
    compact: bool = False,
    order_by: Sequence[Column | str] = (),
) -> None:
    """Parquet append, or overwrite of only the partitions present in ``df``.

    ``order_by`` keeps an order in the files: rows are range-partitioned and sorted once, by partition value and then by
    that order, so the files of a partition value, read by name, give it. It takes the place of ``compact``, which would
    shuffle sorted rows again.

    ``compact`` rebalances rows by partition value before the write: adaptive execution then merges small pieces into
    one file and splits a value that holds much of the data over several tasks, instead of serialising the write.
    """
    if codec not in CODECS:
        raise ValueError(f"unknown codec: {codec}")
    if order_by:
        # an absent value and an empty text share a folder; told apart here, the writer would turn one into the other
        # in a projection above the sort, no longer see the order and sort again by folder alone
        texts = [c for c in partition_by if df.schema[c].dataType.typeName() == "string"]
        df = df.withColumns({c: F.coalesce(c, F.lit("")) for c in texts}).orderBy(*partition_by, *order_by)
    elif compact:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.option("compression", codec).mode("overwrite" if overwrite else "append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
        if overwrite:
            writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def append_bucketed(
    df: DataFrame,
    table: str,
    *,
    bucket_by: str,
    buckets: int,
    partition_by: Sequence[str],
    path: str | None = None,
) -> None:
    """Append to a partitioned table bucketed and sorted on ``bucket_by``; joins on that column then need no shuffle.

    Rows are first rebalanced by their bucket (the same hash as the writer's). A task then writes few buckets, not all
    of them, and adaptive execution splits a large bucket over several tasks: a hot order is never written by one task.
    """
    bucket = F.pmod(F.hash(bucket_by), F.lit(buckets))
    writer = (
        df.withColumn("_bucket", bucket)
        .hint("rebalance", "_bucket")
        .drop("_bucket")
        .write.mode("append")
        .partitionBy(*partition_by)
        .bucketBy(buckets, bucket_by)
        .sortBy(bucket_by)
    )
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def publish_snapshot(df: DataFrame, root: str, version: str | None = None, partition_by: Sequence[str] = ()) -> None:
    """Write a whole new version next to the old ones, then announce it.

    ``df`` may read the current version of the same root, as the new one has a folder of its own. Announcing after the
    write means that a reader, or a job that lost its executors half-way, never sees an unfinished version.
    """
    version = version or uuid.uuid4().hex
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{root}/version={version}")
    spark = df.sparkSession
    announced = spark.range(1).select(
        F.lit(version).alias("version"), F.current_timestamp().cast("double").alias("at")
    )
    announced.write.mode("append").parquet(f"{root}/published")


def _located(spark: SparkSession, path: str):
    """A path and the file system that its name means."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is something at a path, in whatever file system it names."""
    files, where = _located(spark, path)
    return files.exists(where)


def _numbers(spark: SparkSession, path: str, kind: str) -> list[int]:
    """The numbers of the folders ``<kind>=<number>`` right below a path, in order."""
    files, where = _located(spark, path)
    names = [status.getPath().getName() for status in files.listStatus(where)] if files.exists(where) else []
    return sorted(int(name.partition("=")[2]) for name in names if name.startswith(f"{kind}="))


def latest_version(spark: SparkSession, root: str) -> str | None:
    """Name of the version announced last, if any was. A log that is there but cannot be read is an error, not "none yet"."""
    if not exists(spark, f"{root}/published"):
        return None
    published = spark.read.schema("version string, at double").parquet(f"{root}/published")
    return published.agg(F.max_by("version", "at").alias("version")).first()["version"]


def read_snapshot(spark: SparkSession, root: str, schema: str | StructType | None = None) -> DataFrame:
    """The version announced last; with a ``schema``, an empty frame where none was announced yet."""
    version = latest_version(spark, root)
    if version is None:
        if schema is None:
            raise ValueError(f"nothing published below {root}")
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{root}/version={version}")


def publish_changes(df: DataFrame, root: str, batch_id: int, compact: bool = False) -> None:
    """Record the changed rows of one batch under its id; a replayed batch overwrites its own folder.

    ``compact`` merges the small outputs of a micro-batch's many state partitions into few files.
    """
    if compact:
        df = df.hint("rebalance")
    df.write.mode("overwrite").parquet(f"{root}/changes/batch={batch_id}")


def _recorded(spark: SparkSession, root: str, upto: int | None = None) -> DataFrame:
    """All change rows with their ``batch``: the folded base, if there is one, and what came after it, up to batch ``upto``."""
    changes = spark.read.option("basePath", f"{root}/changes").parquet(f"{root}/changes")
    changes = changes.withColumn("batch", F.col("batch").cast("long"))
    if upto is not None:
        changes = changes.where(F.col("batch") <= upto)
    folded = latest_version(spark, f"{root}/base")
    if folded is None:
        return changes
    base = read_snapshot(spark, f"{root}/base").withColumn("batch", F.lit(int(folded)).cast("long"))
    return changes.where(F.col("batch") > int(folded)).unionByName(base)


def latest_rows(spark: SparkSession, root: str, keys: Sequence[str], upto: int | None = None) -> DataFrame:
    """Last value per key over all recorded batches (partial aggregation, so a hot key shrinks before the shuffle)."""
    changes = _recorded(spark, root, upto)
    values = [c for c in changes.columns if c not in {*keys, "batch"}]
    picked = changes.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("r"))
    return picked.select(*keys, *[F.col(f"r.{v}").alias(v) for v in values])


def additive_totals(spark: SparkSession, root: str, keys: Sequence[str], upto: int | None = None) -> DataFrame:
    """Sum of the recorded per-batch amounts per key: ``total = total + ?`` without any read-modify-write."""
    changes = _recorded(spark, root, upto)
    values = [c for c in changes.columns if c not in {*keys, "batch"}]
    return changes.groupBy(*keys).agg(*[F.sum(v).alias(v) for v in values])


def fold_changes(spark: SparkSession, root: str, keys: Sequence[str], additive: bool = False) -> None:
    """Fold the batches recorded so far into one base, so that readers open only the base and later batches.

    Run now and then. What is folded ends at the batch that the base is named after: one that lands meanwhile stays in the log
    alone, and the newest one waits for the next fold while its files are still being committed. The base is announced when
    it is complete; until then readers use what they used before. Batches and bases that an earlier fold had replaced are
    deleted afterwards, so a reader that began before this fold finds its files until the next one, and the folders to
    list are those of two folds and no more.
    """
    batches = _numbers(spark, f"{root}/changes", "batch")
    if batches and not exists(spark, f"{root}/changes/batch={batches[-1]}/_SUCCESS"):
        batches.pop()
    before = latest_version(spark, f"{root}/base")
    last = -1 if before is None else int(before)
    if not batches or batches[-1] <= last:
        return
    rows = (additive_totals if additive else latest_rows)(spark, root, keys, batches[-1])
    publish_snapshot(rows, f"{root}/base", str(batches[-1]))
    old = [f"changes/batch={n}" for n in batches if n <= last]
    old += [f"base/version={n}" for n in _numbers(spark, f"{root}/base", "version") if n < last]
    for folder in old:
        files, where = _located(spark, f"{root}/{folder}")
        files.delete(where, True)


def replace_table(df: DataFrame, root: str) -> None:
    """Truncate and reload a small result, read with ``read_snapshot``: readers see the old rows until the new ones are all there."""
    publish_snapshot(df, root)


def replay_lines(
    lines: DataFrame,
    kind: str,
    where: str,
    *,
    servers: str | None = None,
    partitions: int = 10,
    per_file: int = 400_000,
) -> None:
    """Send every line of a log to a topic, or, offline, to a folder.

    A topic gets ``partitions`` parallel writers. A folder is written where the lines are read, without a shuffle, unless
    they come in too few pieces to write in parallel. Its files are compressed and, as such files are read by one task
    each, hold at most ``per_file`` lines: their number grows with the log, not their size.
    """
    lines = lines.select("value")
    if kind == "kafka":
        spread = lines.repartition(partitions)
        spread.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", where).save()
    elif kind == "files":
        if lines.rdd.getNumPartitions() < min(partitions, lines.sparkSession.sparkContext.defaultParallelism):
            lines = lines.repartition(partitions)
        lines.write.mode("append").option("compression", "lz4").option("maxRecordsPerFile", per_file).text(where)
    else:
        raise ValueError(f"unknown sink kind: {kind}")


def data_files(spark: SparkSession, path: str) -> int:
    """Number of data files right below a path."""
    files, where = _located(spark, path)
    return sum(status.getPath().getName()[0] not in "._" for status in files.listStatus(where))
