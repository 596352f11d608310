"""The shape of the physical plans."""

import re
import tempfile

import pytest

from tallyline.operators import contact_fold as fold
from tallyline.operators import legs, messages
from tallyline.plans import reports
from tallyline.registry import fixtures as fx
from tallyline.sources import landing


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark, sf):
    root = tempfile.mkdtemp(prefix="tallyline-test-")
    for name in ("contacts", "connections", "transcripts", "call_events"):
        getattr(fx, name)(spark, sf).write.parquet(f"{root}/{name}")
    return lambda name: spark.read.parquet(f"{root}/{name}")


def test_no_python_in_the_batch_plans(spark, sf, tables):
    events = tables("call_events")
    for df in (reports.contact_usage(tables("contacts")),
               reports.connection_usage(tables("contacts"), tables("connections")),
               messages.count_messages(tables("transcripts")),
               fold.fold_contacts(events), fold.fold_connections(events, fx.dial_prefixes(spark)),
               fold.contact_records(events)):
        assert "Python" not in physical(df) and "InPandas" not in physical(df)


def test_contact_report_moves_data_only_to_sort(tables):
    assert "Exchange" not in physical(reports.contact_usage(tables("contacts"), ordered=False))
    assert physical(reports.contact_usage(tables("contacts"))).count("Exchange") == 1


def test_voice_filter_reaches_the_scan(tables):
    plan = physical(reports.connection_usage(tables("contacts"), tables("connections")))
    assert re.search(r"PushedFilters: \[[^]]*EqualTo\(Channel,VOICE\)", plan)


def test_chat_report_is_an_inner_join(spark, sf, tables):
    chats = messages.count_message_items(fx.transcript_items(spark, sf), "instanceId", "contactId")
    plan = physical(reports.chat_report(chats, tables("contacts")))
    assert "Inner" in plan and "LeftOuter" not in plan


def test_transcripts_are_counted_in_place(tables):
    assert "Exchange" not in physical(messages.count_messages(tables("transcripts")))


def test_scan_reads_only_what_the_merge_uses(tables):
    plan = physical(legs.connection_legs(tables("connections")))
    schema = re.search(r"ReadSchema: (.*)", plan).group(1)
    assert "stageConnecting" not in schema
    assert "endpointCountryISO" in tables("connections").schema.simpleString()
    read = tables("connections").select("connections.id", "connections.type")._jdf.queryExecution().toString()
    assert "lastUpdate" not in re.search(r"ReadSchema: (.*)", read).group(1)


def test_merge_combines_before_the_shuffle(tables):
    plan = physical(legs.connection_legs(tables("connections")))
    below = plan.split("Exchange")[1]
    assert "partial_min" in below and plan.count("Exchange hash") == 1


def test_hot_key_check_reuses_the_merged_legs(spark, tables):
    df = reports.connection_usage(tables("contacts"), tables("connections"))
    df.collect()
    final = physical(df).split("Initial Plan")[0]
    assert "ReusedExchange" in final


def test_json_reports_read_a_narrow_schema(spark, sf):
    df = landing.contact_records(spark, fx.landed_contacts(spark, sf), reports.CONTACT_FIELDS)
    schema = re.search(r"ReadSchema: (.*)", physical(reports.contact_usage(df))).group(1)
    assert "AfterContactWorkDuration" not in schema and "MediaStreams" not in schema
    full = fx.contacts(spark, sf)
    columns = [c for c in reports.contact_usage(full).columns if c != "TransferEndpoint"]
    narrow = reports.contact_usage(df).select(columns)
    assert sorted(map(repr, narrow.collect())) == sorted(map(repr, reports.contact_usage(full).select(columns).collect()))


def test_sort_inside_the_merge_is_removed(spark, tables):
    merged = legs.connection_legs(tables("connections"))
    plan = physical(merged.orderBy("initialconnecthistorytimestamp").groupBy("contact_id").count())
    assert "rangepartitioning" not in plan
