"""Keyed upsert: the last version of each key wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_by_key(rows: DataFrame, keys: list[str], *order: Column | str) -> DataFrame:
    """One row per key, the one that comes last in ``order``.

    An aggregate rather than a ranking window: versions combine before the
    shuffle, so a key with very many of them stays cheap.
    """
    rest = [c for c in rows.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order))
    return rows.groupBy(*keys).agg(last.alias("_last")).select(*keys, "_last.*")
