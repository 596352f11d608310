"""Joins that stay balanced when one key holds much of the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot when its rows outweigh both a fixed floor and an even share of
# the table. Fewer than MAX_HOT_KEYS keys can exceed that share, which bounds
# the broadcast below whatever the table's size.
MAX_HOT_KEYS = 4096
HOT_FLOOR_BYTES = 64 << 20

BROADCAST_ROWS = 200_000


def hot_keys(rows: DataFrame, key: str, weight: Column, floor: int = HOT_FLOOR_BYTES,
             limit: int = MAX_HOT_KEYS) -> DataFrame:
    """``key, _lanes`` for the hot keys of ``rows``: into how many lanes to split each."""
    weights = rows.groupBy(key).agg(F.sum(weight).alias("_weight"))
    share = weights.select((F.sum("_weight") / F.lit(limit)).alias("share")).scalar()
    cut = F.greatest(F.lit(float(floor)), share)
    return (weights.filter(F.col(key).isNotNull() & (F.col("_weight") > cut))
            .select(key, F.ceil(F.col("_weight") / cut).cast("int").alias("_lanes")))


def row_bytes(df: DataFrame) -> Column:
    """Rough width of a row. It reads every column, so the plan that computes
    it is the plan of the rows themselves and Spark reuses one exchange for both."""
    text = [F.coalesce(F.length(F.col(c).cast("string")), F.lit(0)) for c in df.columns]
    return sum(text[1:], text[0]) + F.lit(16 * len(text))


def salted_left_join(left: DataFrame, right: DataFrame, key: str, spread: str, hot: DataFrame) -> DataFrame:
    """LEFT JOIN on ``key`` where the right rows of a hot key are dealt into lanes.

    Each left row of a hot key is repeated once per lane. A hot key has at
    least one right row by definition, so a lane that finds none is a repeat to
    drop and never a genuine miss: the result is exactly the plain left join.
    """
    hot = F.broadcast(hot)
    lanes = F.coalesce(F.col("_lanes"), F.lit(1))
    dealt = (right.filter(F.col(key).isNotNull()).join(hot, key, "left")
             .withColumn("_lane", F.pmod(F.xxhash64(spread), lanes).cast("int"))
             .withColumn("_found", F.lit(True)).drop("_lanes"))
    repeated = (left.join(hot, key, "left")
                .withColumn("_lane", F.explode(F.sequence(F.lit(0), lanes - 1))))
    return (repeated.join(dealt, [key, "_lane"], "left")
            .filter(F.col("_lanes").isNull() | F.col("_found"))
            .drop("_lane", "_lanes", "_found"))


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``rows`` rows.

    Partitions are read in growing steps until enough rows are seen, and only a
    constant per row comes back. (A LIMIT would cut every partition to the
    limit and then gather all of that in one task.)
    """
    return len(df.select(F.lit(1)).take(rows + 1)) <= rows


def attach_small(df: DataFrame, small: DataFrame, key: str | list[str], rows: int = BROADCAST_ROWS) -> DataFrame:
    """LEFT JOIN a table that is usually small: broadcast it if it is, shuffle if not."""
    return df.join(F.broadcast(small) if fits_broadcast(small, rows) else small, key, "left")


def spread_ties() -> Column:
    """Last sort key that lets a range partitioner cut a run of equal rows.

    The partition number is stable across task retries, unlike a row counter.
    """
    return F.spark_partition_id()
