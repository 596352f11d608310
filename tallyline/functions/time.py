"""Timestamps kept as ISO-8601 text, and the durations billed from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MICROS = 1_000_000

# The ISO shapes the default cast does not read.
SHORT_ISO = "yyyy-MM-dd'T'HH[:mm[:ss]][XXX][XX][X]"

MILLIS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
MICROS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def iso_timestamp(text: Column | str) -> Column:
    """Timestamp of an ISO-8601 string; NULL when the text is not one.

    The default cast is the fast path, and the pattern only runs for text it
    rejects. The shape test keeps out bare times of day, which the cast would
    complete with today's date.
    """
    text = _column(text)
    dated = F.substring(text, 5, 1).isin("-", "")
    return F.when(dated, F.coalesce(F.try_to_timestamp(text), F.try_to_timestamp(text, F.lit(SHORT_ISO))))


def epoch_micros(text: Column | str) -> Column:
    return F.unix_micros(iso_timestamp(text))


def epoch_millis(text: Column | str) -> Column:
    return F.unix_millis(iso_timestamp(text))


def unix_time(text: Column | str) -> Column:
    """Seconds since the epoch as a double, fraction kept."""
    return epoch_micros(text) / F.lit(MICROS)


def round_micros(micros: Column) -> Column:
    """Microseconds to whole seconds, halves away from zero.

    Present-day microseconds stay below 2**53, so the division is exact enough
    for the truncating cast never to land on the wrong side.
    """
    half = F.when(micros < 0, -MICROS // 2).otherwise(MICROS // 2)
    return ((micros + half) / F.lit(MICROS)).cast("bigint")


def epoch_seconds(text: Column | str) -> Column:
    """Whole epoch seconds of an ISO string, each end rounded on its own."""
    return round_micros(epoch_micros(text))


def elapsed(start: Column | str, end: Column | str) -> Column:
    """Seconds between two ISO strings: round both ends, then subtract."""
    return (epoch_seconds(end) - epoch_seconds(start)).cast("int")


def minimum_charge(seconds: Column | str, least: int) -> Column:
    """Raise a duration to the minimum charge; an unknown duration stays NULL."""
    seconds = _column(seconds)
    return F.when(seconds < least, F.lit(least)).otherwise(seconds)


def iso_millis(stamp: Column | str) -> Column:
    return F.date_format(_column(stamp), MILLIS_FORMAT)


def iso_micros(stamp: Column | str) -> Column:
    return F.date_format(_column(stamp), MICROS_FORMAT)


def timestamp_quality(df: DataFrame, *columns: str) -> DataFrame:
    """One row per column: how many values are present, absent and unreadable."""
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("column"), F.col(name).alias("text")) for name in columns
    ])).alias("cell"))
    text = F.col("cell.text")
    return stacked.groupBy(F.col("cell.column").alias("column")).agg(
        F.count(text).alias("present"),
        F.count_if(text.isNull()).alias("absent"),
        F.count_if(text.isNotNull() & iso_timestamp(text).isNull()).alias("unreadable"),
    )
