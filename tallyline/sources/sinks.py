"""Sinks: appended landing files, idempotent batches, dead letters, published reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.operators.ingest import FAILED
from tallyline.operators.latest import latest_by_key
from tallyline.sources.landing import EVENT_TIME_FORMAT

BUFFER_INTERVAL = "60 seconds"
CHAT_KEYS = ["instanceId", "contactId"]


# Text and JSON, of records that repeat their field names, take a small part of their size when compressed. Such a file
# is read by one task, so its rows are bounded.
TEXT_OPTIONS = {"compression": "gzip", "maxRecordsPerFile": 100_000}


def write_json(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).options(**TEXT_OPTIONS).option("timestampFormat", EVENT_TIME_FORMAT).json(path)


def write_lines(df: DataFrame, path: str, mode: str = "append") -> None:
    """Lines of a landing folder."""
    df.write.mode(mode).options(**TEXT_OPTIONS).text(path)


def each_batch(store):
    """``store(batch, batch_id, run)`` as a function for ``foreachBatch``.

    ``run`` is the id of the streaming query, which its checkpoint keeps: the
    same after a restart, another under a new checkpoint.
    """
    def call(batch: DataFrame, batch_id: int) -> None:
        store(batch, batch_id, batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId"))
    return call


def write_batch(df: DataFrame, path: str, batch_id: int, fmt: str = "json", run: str | None = None) -> str:
    """Write one micro-batch to its own folder. A replay overwrites it, so the
    folder holds each batch once however often it is retried. An empty batch
    is written too, so that a replay that turns out empty leaves nothing behind."""
    target = f"{path}/batch={batch_id}" if run is None else f"{path}/run={run}/batch={batch_id}"
    writer = df.write.mode("overwrite")
    if fmt in ("json", "text"):
        writer = writer.options(**TEXT_OPTIONS)
    if fmt == "json":
        writer = writer.option("timestampFormat", EVENT_TIME_FORMAT)
    writer.format(fmt).save(target)
    return target


def staged(parsed: DataFrame, checkpoint: str) -> DataFrame:
    """Parsed lines of a micro-batch in a compressed folder beside its checkpoint, for several sinks to read.

    The next micro-batch, or a replay, overwrites it, so it holds one at a
    time. Cached rows would take several times what the batch reads. Text is
    kept of what did not parse only.
    """
    folder = f"{checkpoint}/staged"
    kept = parsed.withColumn("value", F.when(F.col("result") == FAILED, F.col("value")))
    kept.write.mode("overwrite").option("compression", "zstd").parquet(folder)
    return parsed.sparkSession.read.schema(kept.schema).parquet(folder)


def write_dead_letters(rejects: DataFrame, path: str) -> None:
    """Rejected lines, byte for byte, under an error prefix."""
    write_lines(rejects.select("value"), path)


def write_chat_usage(usage: DataFrame, path: str) -> None:
    """Batch upsert: one row per chat, the last written transcript wins."""
    rows = latest_by_key(usage, CHAT_KEYS, "written", "source_object")
    write_json(rows.drop("written", "source_object"), path, "overwrite")


BUCKETS = 64


def merge_by_key(updates: DataFrame, path: str, keys: list[str], order: list[str], buckets: int = BUCKETS) -> None:
    """Keyed upsert into a Parquet table: one row per key, the last in ``order`` wins.

    Keys are hashed into buckets, which are the table's partitions. Only the
    buckets of the given keys are read and replaced, whole, when the write
    commits; the same updates again change nothing. ``buckets`` stays as it was
    when the table was made, and suits its size.
    """
    spark = updates.sparkSession
    given = updates.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    touched = [r[0] for r in given.select("bucket").distinct().collect()]  # at most ``buckets`` numbers
    if not touched:
        return
    held = table_by_key(spark, path, updates)
    rows = given if held is None else given.unionByName(held.filter(F.col("bucket").isin(touched)).select(given.columns))
    merged = latest_by_key(rows, [*keys, "bucket"], *order).select(given.columns)
    # Different keys spread evenly, so a task per bucket is even too.
    (merged.repartition(len(touched), "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("bucket").parquet(path))


def table_by_key(spark, path: str, like: DataFrame) -> DataFrame | None:
    """The table that ``merge_by_key`` keeps, with its ``bucket``; None before the first merge."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return None
    return spark.read.schema(T.StructType(like.schema.fields + [T.StructField("bucket", T.IntegerType())])).parquet(path)


def write_columnar(df: DataFrame, path: str, partition_by: list[str], mode: str = "append") -> None:
    """Compact landing rows into Parquet that later reads can prune.

    Rows are not moved to fewer tasks per partition value: one value may hold
    most of the data, and a task per value would then write it alone.
    """
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def publish_view(df: DataFrame, name: str) -> str:
    """Expose a report by name to the session."""
    df.createOrReplaceTempView(name)
    return name


def publish_table(df: DataFrame, name: str, buckets: int | None = None, key: str | None = None,
                  mode: str = "overwrite") -> str:
    """Store a report as a catalog table, optionally bucketed by its join key
    so that later joins and groupings on that key need no shuffle."""
    writer = df.write.mode(mode).format("parquet")
    if buckets and key:
        writer = writer.bucketBy(buckets, key).sortBy(key)
    writer.saveAsTable(name)
    return name


def with_partition_day(df: DataFrame, stamp: str, to: str = "day") -> DataFrame:
    """Add the date part of an ISO timestamp, to partition stored rows by."""
    return df.withColumn(to, F.substring(stamp, 1, 10))
