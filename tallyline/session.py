"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Read by the jobs on whatever session they are handed. Timestamps are stored
# as ISO text in UTC, so the session zone has to be UTC as well.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


# What one shuffle partition should hold.
SHUFFLE_BYTES = 128 << 20


def configure(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Apply the runtime settings the jobs rely on to an existing session.

    ``input_bytes`` sizes the shuffles for a job of that much input. Adaptive
    execution merges partitions that turn out small, but cannot add any.
    """
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    if input_bytes is not None:
        wanted = -(-input_bytes // SHUFFLE_BYTES)
        least = spark.sparkContext.defaultParallelism
        spark.conf.set("spark.sql.shuffle.partitions", str(max(wanted, least)))
    return spark


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Settings for what starts inside the block. A streaming query keeps the
    settings it was started with, so they can be put back right after."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def local_session(cpus: int | str = "*", app: str = "tallyline", partitions: int = 8, **conf: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session, where
    executors and driver share one disk, may fall back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="tallyline-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` to reliable storage and cut its lineage there."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch(spark, "checkpoint"))
    return df.checkpoint(eager=True)
