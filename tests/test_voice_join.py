"""The legs of the voice reports move once, and only with what is read of them."""

import re

from pyspark.sql import functions as F

from tallyline.operators import skew
from tallyline.operators.legs import flatten_legs, merge_legs
from tallyline.plans import reports
from tallyline.registry import fixtures as fx
from tallyline.registry import queries


def rows_of(df):
    return sorted(map(repr, df.collect()))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_legs_move_once(spark, sf):
    plan = plan_of(reports.connection_usage(fx.contacts(spark, sf), fx.connections(spark, sf)))
    usual = plan.split("Union")[1].split("Inner")[0]  # the other branch is for hot contacts
    moves = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", usual)
    assert moves and not any("conn_id" in keys for keys in moves)
    assert len(re.findall("Exchange rangepartitioning", plan)) == 1


def test_a_metric_moves_only_what_it_reads(spark, sf):
    every = queries.queries()
    fields = {"MET-10": set(), "MET-13": {"type"}, "MET-12": {"type", "softphoneEnabled"}}
    for name, read in fields.items():
        plan = plan_of(every[name](spark, sf))
        assert {x for x in ("type", "softphoneEnabled", "extension", "endpointCountryISO", "inbound") if f"AS {x}#" in plan} - read == set(), name


def test_merging_in_place_gives_the_same_legs(spark, sf):
    legs = flatten_legs(fx.connections(spark, sf))
    placed = legs.withColumn("_lane", F.pmod(F.xxhash64("conn_id"), F.lit(3))).repartition("contact_id", "_lane")
    columns = merge_legs(legs).columns
    assert rows_of(merge_legs(placed, "contact_id", "_lane").select(columns)) == rows_of(merge_legs(legs))
    ids = flatten_legs(fx.connections(spark, sf), ())
    assert rows_of(merge_legs(ids.select("contact_id", "conn_id"), "contact_id")) == rows_of(merge_legs(legs).select("contact_id", "conn_id"))


def test_a_hot_contact_without_legs_is_kept(spark, sf, monkeypatch):
    contacts, connections = fx.contacts(spark, sf), fx.connections(spark, sf)
    empty = connections.filter("contactId = 'c1'").withColumn("connections", F.filter("connections", lambda c: F.lit(False)))
    times = empty.crossJoin(spark.range(300)).drop("id")
    connections = connections.filter("contactId <> 'c1'").unionByName(times)
    plain = rows_of(reports.voice_legs(contacts, connections, split_hot=False))
    monkeypatch.setattr(reports, "hot_keys", lambda rows, key, weight: skew.hot_keys(rows, key, weight, 0, 1000))
    assert sum("contact_id='c1'" in row for row in plain) == 1
    assert rows_of(reports.voice_legs(contacts, connections)) == plain


def test_packing_keeps_rows_and_order(spark):
    df = spark.createDataFrame([("t2", "b", 1), ("t1", "a", 2), (None, "c", 3), ("t2", "a", None), ("t2", "a", 4)],
                               "CTR_Initiation_Timestamp string, contactid string, n int")
    plain = reports.latest_first(df, "contactid", "n").collect()
    assert reports.latest_first(df, "contactid", "n", packed=["CTR_Initiation_Timestamp", "contactid"]).collect() == plain
