"""Hot keys: results stay whole and the work is spread."""

from pyspark.sql import functions as F

from tallyline.operators import dialing, skew
from tallyline.operators.legs import connection_legs
from tallyline.plans import reports
from tallyline.registry import fixtures as fx


def rows_of(df):
    return sorted(map(repr, df.collect()))


def sides(spark):
    """Half of the right side and a third of the left belong to one key."""
    left = spark.range(90).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), "id")).alias("k"), "id")
    right = spark.range(400).select(
        F.when(F.col("id") % 2 == 0, F.lit("hot")).when(F.col("id") % 7 == 0, F.lit(None))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 150)).alias("k"), F.col("id").alias("leg"))
    return left.union(spark.createDataFrame([(None, -1)], "k string, id bigint")), right


def test_hot_keys_are_few_and_sized(spark):
    _, right = sides(spark)
    hot = skew.hot_keys(right, "k", F.lit(1), floor=0, limit=10).collect()
    assert [(r.k, r._lanes) for r in hot] == [("hot", 5)]
    assert skew.hot_keys(right, "k", F.lit(1)).count() == 0


def test_salted_join_is_the_left_join(spark):
    left, right = sides(spark)
    hot = skew.hot_keys(right, "k", F.lit(1), floor=0, limit=40)
    assert hot.first()._lanes == 20
    for threshold in ("10MB", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            salted = skew.salted_left_join(left, right, "k", "leg", hot).select("k", "id", "leg")
            assert rows_of(salted) == rows_of(left.join(right, "k", "left").select("k", "id", "leg"))
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_hot_key_with_one_leg_and_many_lanes(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2)], "k string, id int")
    right = spark.createDataFrame([("a", 10)], "k string, leg int")
    hot = spark.createDataFrame([("a", 8)], "k string, _lanes int")
    joined = skew.salted_left_join(left, right, "k", "leg", hot).select("k", "id", "leg")
    assert rows_of(joined) == rows_of(left.join(right, "k", "left").select("k", "id", "leg"))


def test_report_does_not_depend_on_salting(spark, sf, monkeypatch):
    contacts, connections = fx.contacts(spark, sf), fx.connections(spark, sf)
    plain = reports.connection_usage(contacts, connections, ordered=False, split_hot=False)
    monkeypatch.setattr(reports, "hot_keys", lambda rows, key, weight: skew.hot_keys(rows, key, weight, 0, 1000))
    salted = reports.connection_usage(contacts, connections, ordered=False)
    assert skew.hot_keys(connection_legs(connections), "contact_id", F.lit(1), 0, 1000).count() > 0
    assert rows_of(salted) == rows_of(plain)


def test_equal_timestamps_still_spread(spark):
    df = spark.range(0, 4000, 1, 8).select(F.lit("t").alias("CTR_Initiation_Timestamp"), F.lit("c").alias("contactid"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [len(p) for p in reports.latest_first(df, "contactid").rdd.glom().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 4000 and max(sizes) <= 2500


def test_large_prefix_table_takes_the_shuffle(spark):
    numbers = spark.createDataFrame(
        [(i, n) for i, n in enumerate(["+12045550000", "+15551234", "+442071234", "+999123", "desk", None, "+15551234"])],
        "id int, number string")
    prefixes = fx.dial_prefixes(spark)
    small = dialing.country_of(numbers, "number", prefixes, small=True)
    large = dialing.country_of(numbers, "number", prefixes, small=False)
    assert rows_of(small) == rows_of(large)
    assert [r.country for r in small.orderBy("id").collect()] == ["CA", "US", "GB", None, None, None, "US"]


def test_size_check(spark):
    assert skew.fits_broadcast(spark.range(5), 5) and not skew.fits_broadcast(spark.range(6), 5)
    small, df = spark.range(3).withColumn("v", F.lit(1)), spark.range(10)
    for rows in (2, 3):
        assert skew.attach_small(df, small, "id", rows).filter("v = 1").count() == 3
