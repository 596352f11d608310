"""Mixing sources to target weights: every document is repeated as its source's target asks.

A source's rate is its target size over its size. A document goes out
floor(rate) times, and once more if a hash of its id falls below the
fraction, so reruns agree and no state is kept between rows.

Nulls and ties: a null or blank text has size 0 and takes nothing away; a null
source is a source of its own, last in order; a null doc_id hashes as the empty
text; rows that repeat a doc_id share its draw. A source of size 0 has target 0
and rate 0. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import WORD, stored, table

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST_REPEATS = 2.0


def words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(doc_id: Column) -> Column:
    """A number in [0, 1) from the id's digest."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") / F.lit(float(16 ** 12))


def ranked(sources: DataFrame) -> DataFrame:
    """``sources(source, ...)`` with ``rank`` from 0 by code point, null last.

    Sorted by range over many tasks; the counts of the partitions are all that
    the driver sees.
    """
    spark = sources.sparkSession
    dealt = stored(sources.withColumn("missing", F.col("source").isNull())
                   .repartitionByRange("missing", "source").withColumn("part", F.spark_partition_id()), "mix-sources")
    from pyspark.sql import Window

    before, offsets = 0, []
    for part, count in sorted(dealt.groupBy("part").count().collect()):
        offsets.append((part, before))
        before += count
    starts = spark.createDataFrame(offsets, "part int, before long")
    order = Window.partitionBy("part").orderBy("missing", "source")
    return (dealt.withColumn("within", F.row_number().over(order))
            .join(F.broadcast(starts), "part")  # a row per partition
            .withColumn("rank", F.col("before") + F.col("within") - 1)
            .drop("missing", "part", "before", "within"))


def source_targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
                   most: float = MOST_REPEATS) -> DataFrame:
    """``sources(source, source_size)`` with ``target``.

    Targets follow the weights and stop at ``most`` times a source's size; what
    a stopped source cannot take is shared again by weight, until none is above.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.col("rank") % F.lit(len(weights)) + 1).cast("int"))
    rows = stored(ranked(sources).withColumn("weight", weight), "mix-weights")
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:
        stopped = F.col("weight") * F.lit(level) >= F.col("source_size") * F.lit(most)
        taken, rest, count = rows.agg(
            F.sum(F.when(stopped, F.col("source_size")).otherwise(0)),
            F.sum(F.when(stopped, 0.0).otherwise(F.col("weight"))),
            F.sum(F.when(stopped, 1).otherwise(0))).first()
        if count == full or not rest:
            break
        full, level = count, (share * total - most * taken) / rest
    return rows.withColumn("target", F.least(F.col("weight") * F.lit(level), F.col("source_size") * F.lit(most)))


def copies(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
           most: float = MOST_REPEATS) -> DataFrame:
    """``row, doc_id, size, source_size, target, copies`` per row; ``row`` holds all columns of ``docs``.

    The targets may be broadcast by Spark where their table is small; else
    the join shuffles, and adaptive execution splits the rows of a hot source.
    """
    sized = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "source", words(F.col("text")).alias("size"))
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sources, weights, share, most).select(F.col("source").alias("of"), "source_size", "target")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    times = F.floor(rate) + F.when(draw(F.col("doc_id")) < rate - F.floor(rate), 1).otherwise(0)
    return (sized.join(targets, sized["source"].eqNullSafe(targets["of"]), "left")
            .select("row", "doc_id", "size", "source_size", "target", times.cast("int").alias("copies")))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed rows themselves: each row of ``docs`` as often as the mix takes it."""
    return (copies(docs, **options).filter("copies > 0")
            .select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*"))


def query(spark, sf_dir: str) -> DataFrame:
    mixed = copies(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target",
                        (F.col("size") * F.col("copies")).cast("long").alias("taken"))


# Stopped sources are those of least size for their weight, so the level is found along that order.
SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source IS NULL, source) - 1 AS rank
  FROM sized GROUP BY source),
weighted AS (
  SELECT *, CASE rank % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM sources),
running AS (
  SELECT *, source_size * 2.0::DOUBLE / weight AS ratio,
         coalesce(sum(source_size) OVER w, 0) AS before, coalesce(sum(weight) OVER w, 0) AS weight_before
  FROM weighted WINDOW w AS (ORDER BY source_size * 2.0::DOUBLE / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (
  SELECT ratio, rank, (1.5::DOUBLE * (SELECT sum(source_size) FROM sources) - 2.0::DOUBLE * before)
         / ((SELECT sum(weight) FROM weighted) - weight_before) AS level FROM running),
found AS (SELECT level FROM levels WHERE level <= ratio ORDER BY ratio, rank LIMIT 1),
targets AS (
  SELECT source, source_size, least(weight * coalesce((SELECT level FROM found), 0), source_size * 2.0::DOUBLE) AS target
  FROM weighted),
rated AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
         CAST(('0x' || substr(md5(coalesce(CAST(s.doc_id AS VARCHAR), '')), 1, 12)) AS BIGINT) / 281474976710656.0::DOUBLE AS draw
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM rated
"""
