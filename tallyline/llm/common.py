"""What the operators share: tables, stored intermediates, connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.session import scratch, settings

# ASCII white space and its complement; Python's bytes.split() uses the same six bytes.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, and safe when an executor is lost."""
    path = scratch(df.sparkSession, label)
    # Once the table is written, its shuffles are not needed again.
    with settings(df.sparkSession, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(edges: DataFrame, label: str = "components", most_rounds: int = 40) -> DataFrame:
    """``node, root`` for every node of ``edges(a, b)``; root is the least node that it is joined to.

    Alternates large-star and small-star: each round hangs the neighbours of a
    node on the least of them, until the edges form stars. Only counts come to
    the driver. Edges whose ends are equal are ignored; an empty table gives
    an empty table.
    """
    stars = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m"))
                   .distinct(), label)
    before = None
    for _ in range(most_rounds):
        both = stars.union(stars.select(F.col("m").alias("v"), F.col("v").alias("m")))
        least = both.groupBy("v").agg(F.min("m").alias("least"))
        large = (both.join(least, "v").filter("m > v")
                 .select(F.col("m").alias("v"), F.least("v", "least").alias("m")).distinct())
        least = large.groupBy("v").agg(F.min("m").alias("least"))
        small = (large.join(least, "v")
                 .select(F.explode(F.array(F.struct("v", F.col("least").alias("m")),
                                           F.struct(F.col("m").alias("v"), F.col("least").alias("m")))).alias("e"))
                 .select("e.*").filter("v <> m").distinct())
        stars = stored(small, label)
        # Stars are done once no root hangs on another node; sums of both ends tell two rounds apart.
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("v", "m").cast("decimal(38,0)"))).first()
        if now == before:
            return stars.select(F.col("v").alias("node"), F.col("m").alias("root"))
        before = now
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
