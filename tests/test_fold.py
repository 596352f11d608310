"""The contact fold: batch, partial records, and the streaming job agree."""

import os
import random
import tempfile
import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tallyline.operators import contact_fold as fold
from tallyline.registry import fixtures as fx
from tallyline.sources import landing, schemas
from tallyline.streaming.contacts import complete_contacts, pending_contacts, stream_contacts, write_slice

START = datetime(2024, 5, 1, tzinfo=timezone.utc)


def event(contact, number, kind, status="connected", minutes=None, leg="k0", state="connected", **more):
    base = dict(contactId=contact, event_id=number, event_type=kind,
                ts=START + timedelta(minutes=number if minutes is None else minutes), status=status,
                contact_type="voice", inbound=False, initialConnectionId="k0", connId=leg, conn_type="inbound",
                conn_state=state, active=True, phone_number="+15551234", extension=None, soft_phone_enabled=None,
                attributes="{}", queue="q", third_party=[])
    return base | more


def frame(spark, events):
    schema = schemas.struct(schemas.CALL_EVENT)
    return spark.createDataFrame([tuple(e[f] for f in schema.names) for e in events], schema)


def same(left, right):
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    a = sorted(map(repr, (tuple(r) for r in left.select(columns).collect())))
    b = sorted(map(repr, (tuple(r) for r in right.select(columns).collect())))
    assert a == b


def same_fold(records, events, prefixes=None):
    contacts = fold.merge_contacts(records)
    same(contacts, fold.fold_contacts(events).select(contacts.columns))
    connections = fold.merge_connections(records)
    same(connections, fold.fold_connections(events, prefixes).select(connections.columns))


def test_first_last_and_or(spark):
    events = frame(spark, [
        event("a", 1, "Incoming", contact_type="", inbound=None, initialConnectionId=None, conn_type="outbound"),
        event("a", 2, "Connecting", "connecting", state="connecting", contact_type="voice", inbound=True),
        event("a", 3, "Connected", contact_type="chat", inbound=False, initialConnectionId="k9", active=None),
        event("a", 4, "Destroyed", "ended", contact_type="none", conn_type="agent", state="disconnected"),
    ])
    contact = fold.fold_contacts(events).first()
    assert (contact.type, contact.inbound, contact.initialConnectionId) == ("voice", True, "k0")
    assert contact.initialTimestamp == "2024-05-01T00:01:00.000000Z"
    assert (contact.ended_at, contact.record_status) == (None, "pending")
    leg = fold.fold_connections(events).first()
    assert (leg.type, leg.active, leg.status, leg.entries) == ("inbound", None, "connected", 3)
    assert (leg.connectingTimestamp, leg.disconnectedTimestamp) == ("2024-05-01T00:02:00.000000Z", None)


def test_agent_legs_are_dialled_at_the_extension(spark):
    prefixes = fx.dial_prefixes(spark)
    events = frame(spark, [
        event("a", 1, "Connected", leg="x", conn_type="agent", extension="+442071234"),
        event("a", 2, "Connected", leg="y", conn_type="agent", extension="desk 9"),
        event("a", 3, "Connected", leg="z", phone_number="+12045550000"),
        event("a", 4, "Refresh", leg="z", phone_number="anonymous"),
    ])
    legs = {r.connId: (r.phoneNumber, r.endpointCountryISO) for r in fold.fold_connections(events, prefixes).collect()}
    assert legs == {"x": ("+442071234", "GB"), "y": ("+15551234", None), "z": ("anonymous", "CA")}


@pytest.mark.parametrize("events, want", [
    ([("Connected", "connected", 0), ("Refresh", "error", 1)], "error"),
    ([("ACW", "ended", 0), ("Destroyed", "ended", 1)], "destroyed"),
    ([("Destroyed", "ended", 0), ("ACW", "ended", 1)], None),
    ([("Connected", "connected", 0), ("Destroyed", "ended", 1)], None),
    ([("Connected", "connected", 0), ("Ended", "ended", 1)], None),
    ([("Connected", "connected", 0), ("Refresh", "connected", 1440)], None),
    ([("Connected", "connected", 0), ("Refresh", "connected", 1441)], "abandoned"),
])
def test_completion(spark, events, want):
    df = frame(spark, [event("a", i, kind, status, minutes) for i, (kind, status, minutes) in enumerate(events)])
    assert fold.fold_contacts(df).first().completion == want


def test_abandoned_as_of(spark):
    df = frame(spark, [event("a", 0, "Connected")])
    stamp = F.lit(START + timedelta(hours=25)).cast("timestamp")
    assert fold.fold_contacts(df, stamp).first().completion == "abandoned"


def test_terminal_events_alone_make_no_record(spark):
    df = frame(spark, [event("a", 1, "Destroyed", "ended"), event("b", 2, "Ended", "ended"), event("c", 3, "Hello")])
    assert fold.fold_contacts(df).count() == fold.contact_records(df).count() == 0


def test_partial_records_merge_to_one_fold(spark, sf):
    events, prefixes = fx.call_events(spark, sf), fx.dial_prefixes(spark)
    same_fold(fold.contact_records(events, prefixes), events, prefixes)


def test_parts_combine_however_the_events_are_cut(spark):
    rng = random.Random(7)
    kinds = [("Connecting", "connecting"), ("Connected", "connected"), ("ACW", "ended"), ("Destroyed", "ended")]
    rows = [event("hot", i, *rng.choice(kinds), leg=f"k{i % 5}", state=rng.choice(["connecting", "connected", "hold"]))
            for i in range(600)]
    rows += [event(f"u{i}", 1000 + i, "Connected") for i in range(300)]
    rows += [rows[0]] * 300  # copies of one event
    rng.shuffle(rows)
    parts = fold.fold_parts(frame(spark, rows[:500]))
    for at in range(500, len(rows), 400):
        parts = fold.combine_parts(parts.union(fold.fold_parts(frame(spark, rows[at:at + 400]))))
    records = fold.records_of(fold.decide(parts))
    assert records.count() == 301
    same_fold(records, frame(spark, rows))


def folders():
    root = tempfile.mkdtemp(prefix="tallyline-test-")
    return tuple(f"{root}/{n}" for n in ("calls", "records", "submitted", "offsets"))


def lag():
    """So that the clock of a job stands at START."""
    return int(time.time() - START.timestamp())


def replay(spark, slices, where=None, max_files=landing.MAX_FILES_PER_BATCH, behind=None):
    source, records, submitted, offsets = where or folders()
    for rows in slices:
        write_slice(frame(spark, rows).coalesce(1), source)
        events = landing.stream_json(spark, source, schemas.CALL_EVENT, max_files)
        stream_contacts(events, records, submitted, offsets, once=True, lag=lag() if behind is None else behind)
    return complete_contacts(spark, records)


def scenario():
    return [
        event("done", 1, "Connecting", "connecting"), event("done", 2, "ACW", "ended"),
        event("done", 3, "Destroyed", "ended"),
        event("broken", 4, "Refresh", "error"),
        event("gone", 5, "Destroyed", "ended"),
        event("young", 6, "Connected"),
        event("late", 7, "ACW", "ended"), event("late", 8, "Destroyed", "ended"),
        event("late", 9, "Connected"),
        event("split", 10, "ACW", "ended"), event("split", 2000, "Destroyed", "ended"),
    ]


def merging(rows):
    return [r for r in rows if r["event_type"] not in ("Ended", "Destroyed")]


@pytest.mark.parametrize("cuts", [1, 3])
def test_stream_equals_batch_however_it_is_cut(spark, cuts):
    rows, where = scenario(), folders()
    size = -(-len(rows) // cuts)
    slices = [rows[i:i + size] for i in range(0, len(rows), size)]
    records = replay(spark, slices, where)
    waiting = pending_contacts(spark, where[3])
    same_fold(records.unionByName(waiting), frame(spark, merging(rows)))
    reasons = {r.contactId: r.completion for r in records.collect() if r.contactId != "late"}
    assert reasons == {"done": "destroyed", "broken": "error", "split": "destroyed"}
    assert {r.contactId for r in waiting.collect()} - {"late"} == {"young"}


def test_pending_contacts_wait_and_survive_a_restart(spark):
    where = folders()
    rows = scenario()[:-1]
    first = replay(spark, [rows], where)
    assert {r.contactId for r in first.collect()} == {"done", "broken", "late"}
    assert {r.contactId for r in pending_contacts(spark, where[3]).collect()} == {"young", "split"}
    again = replay(spark, [[event("young", 3000, "ACW", "ended", minutes=1500)]], where)
    young = again.filter("contactId = 'young'").collect()
    assert len(young) == 1 and young[0].connections[0].entries == 2
    assert again.count() == 4
    assert [r.contactId for r in pending_contacts(spark, where[3]).collect()] == ["split"]


def test_a_late_start_releases_all_that_is_due(spark):
    """The clock of the machine is long past the events: no event moves it."""
    where = folders()
    records = replay(spark, [scenario()], where, behind=0)
    assert {r.contactId: r.completion for r in records.collect()} == {
        "done": "destroyed", "broken": "error", "young": "abandoned", "late": "destroyed", "split": "destroyed"}
    assert pending_contacts(spark, where[3]).count() == 0


def test_release_in_silence(spark):
    """One arrival, and nothing after it: the contact comes out when its time is up, and not before."""
    source, records, submitted, offsets = folders()
    age = 86_400 - 45
    now = datetime.now(timezone.utc)
    quiet = event("quiet", 1, "Connected") | {"ts": now - timedelta(seconds=age)}
    ends = event("ends only", 2, "Ended", "ended") | {"ts": now - timedelta(seconds=age)}
    write_slice(frame(spark, [quiet, ends]).coalesce(1), source)
    job = stream_contacts(landing.stream_json(spark, source, schemas.CALL_EVENT), records, submitted, offsets, every="1 second")
    try:
        seen, until = None, time.time() + 150
        while time.time() < until and not job.fold.exception():
            if seen is None and job.fold.lastProgress:
                seen = {r.contactId for r in pending_contacts(spark, offsets).collect()}
            if seen is not None and complete_contacts(spark, records).count():
                break
            time.sleep(1)
        released = time.time()
    finally:
        job.stop()
    assert seen == {"quiet"}
    assert [(r.contactId, r.completion) for r in complete_contacts(spark, records).collect()] == [("quiet", "abandoned")]
    assert released - now.timestamp() >= 45 and pending_contacts(spark, offsets).count() == 0


def test_release_after_a_silent_restart(spark):
    """A job that starts again, and finds nothing new, releases what fell due while it was down."""
    where = folders()
    source, records, submitted, offsets = where
    began = datetime.now(timezone.utc)
    rows = [event("quiet", 1, "Connected") | {"ts": began}]
    write_slice(frame(spark, rows).coalesce(1), source)
    for n in range(2):
        events = landing.stream_json(spark, source, schemas.CALL_EVENT)
        stream_contacts(events, records, submitted, offsets, once=True, limit=60)
        if n == 0:
            assert [r.contactId for r in pending_contacts(spark, offsets).collect()] == ["quiet"]
            time.sleep(max(0.0, 61 - (datetime.now(timezone.utc) - began).total_seconds()))
    assert [(r.contactId, r.completion) for r in complete_contacts(spark, records).collect()] == [("quiet", "abandoned")]
    assert pending_contacts(spark, offsets).count() == 0


def test_event_after_completion_opens_another_record(spark):
    where = folders()
    rows = [event("a", 1, "ACW", "ended", state="disconnected"), event("a", 2, "Destroyed", "ended")]
    later = [event("a", 3, "Connected", state="connected")]
    records = replay(spark, [rows, later], where)
    assert [r.completion for r in records.collect()] == ["destroyed"]
    waiting = pending_contacts(spark, where[3])
    assert [r.completion for r in waiting.collect()] == [None]
    same_fold(records.unionByName(waiting), frame(spark, rows + later))


def test_busy_contact_gives_one_complete_record(spark):
    """The state and the record have a row per connection, whatever the number of events."""
    where = folders()
    hot = frame(spark, [event("hot", 0, "Connected")]).drop("event_id", "ts", "connId")
    hot = hot.crossJoin(spark.range(200_000).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.lit(1_714_521_600) + F.col("id") % 40_000).alias("ts"),
        F.concat(F.lit("k"), F.col("id") % 3).alias("connId"))).select(schemas.struct(schemas.CALL_EVENT).names)
    write_slice(hot, where[0])
    records = replay(spark, [[event("hot", 200_000, "Connected", minutes=600)]], where, max_files=1)
    assert records.count() == 0
    state = spark.read.format("statestore").option("path", f"{where[3]}/fold").option("stateVarName", "legs").load()
    assert state.count() == 3
    ends = [event("hot", 200_001, "ACW", "ended", minutes=700), event("hot", 200_002, "Destroyed", "ended", minutes=701)]
    records = replay(spark, [ends], where)
    assert [r.completion for r in records.collect()] == ["destroyed"]
    same_fold(records, hot.union(frame(spark, [event("hot", 200_000, "Connected", minutes=600)] + ends)))


def test_history_of_200000_entries_comes_back(spark):
    """Pages of a bounded size, stored as partial records, read as the connection table."""
    from tallyline.operators.legs import LEG_FIELDS, connection_legs

    n = 200_000
    one = frame(spark, [event("hot", 0, "Connected")]).drop("event_id", "ts", "connId")
    rows = one.crossJoin(spark.range(n).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.lit(1_714_521_600) + F.col("id") % 977).alias("ts"),
        F.when(F.col("id") % 100 == 0, "k1").otherwise("k0").alias("connId"))).select(schemas.struct(schemas.CALL_EVENT).names)
    pages = fold.history_pages(rows.repartition(5)).persist()
    sizes = pages.select("connId", "page", F.size("entries").alias("n")).collect()
    assert max(r.n for r in sizes) <= 1000 and sum(r.n for r in sizes) == n
    assert sorted(r.page for r in sizes if r.connId == "k0") == list(range(sum(r.connId == "k0" for r in sizes)))
    ends = pages.select("connId", "page", F.col("entries")[0].alias("a"), F.element_at("entries", -1).alias("z")).orderBy("connId", "page").collect()
    for a, b in zip(ends, ends[1:]):
        assert a.connId != b.connId or (a.z.timestamp, a.z.sequence) < (b.a.timestamp, b.a.sequence)
    path = folders()[1]
    fold.page_records(pages).write.json(path)
    same(fold.history_of(spark.read.schema(schemas.struct(fold.RECORD)).json(path)).filter("sequence % 50 = 0"),
         fold.history(rows).filter("sequence % 50 = 0"))
    legs = connection_legs(landing.call_connections(spark, path, LEG_FIELDS)).collect()
    assert {(r.conn_id, r.initialconnecthistorytimestamp) for r in legs} == {
        ("k0", "2024-05-01T00:00:00.000000Z"), ("k1", "2024-05-01T00:00:00.000000Z")}
    assert landing.call_connections(spark, path).select(F.explode("connections").alias("c")).agg(
        F.sum(F.size("c.history"))).first()[0] == n


def test_events_are_combined_before_they_move(spark):
    from tallyline.streaming import keyed
    rows = [event("hot", i, "Connected", leg=f"k{i % 2}") for i in range(500)] + [event("b", 900, "Connected")]
    types = keyed.part_types(spark)
    contact, legs = keyed.kinds_of()
    texts = keyed.as_text(fold.single_parts(frame(spark, rows).coalesce(1)), types)
    few = keyed.combined_in_tasks(texts, contact | legs)
    assert texts.count() == 501 and few.count() == 3
    same_fold(fold.records_of(fold.decide(keyed.from_text(few, types))), frame(spark, rows))


def test_state_written_follows_the_batch(spark):
    """A micro-batch with one event writes what one contact takes, whatever is pending."""
    where = folders()

    def written(since=frozenset()):
        files = {os.path.join(d, f) for d, _, names in os.walk(f"{where[3]}/fold/state") for f in names if f.endswith(".changelog")}
        return files, sum(os.path.getsize(f) for f in files - since)

    replay(spark, [[event(f"c{i}", i, "Connected", minutes=0) for i in range(3000)]], where)
    before, all_bytes = written()
    replay(spark, [[event("c7", 5000, "Refresh", minutes=1)]], where)
    _, more = written(before)
    assert pending_contacts(spark, where[3]).count() == 3000
    assert 0 < more < all_bytes / 20


def test_files_in_any_order_and_one_to_a_batch(spark, sf):
    events = fx.call_events(spark, sf)
    source, records, submitted, offsets = folders()
    write_slice(events.repartition(6, F.xxhash64("event_id")), source)
    stream = landing.stream_json(spark, source, schemas.CALL_EVENT, max_files=1)
    stream_contacts(stream, records, submitted, offsets, prefixes=fx.dial_prefixes(spark), once=True)
    same_fold(complete_contacts(spark, records), events, fx.dial_prefixes(spark))
    stored = spark.read.parquet(submitted)
    assert stored.select("batch").distinct().count() > 3
    same(fold.history(stored), fold.history(events))


def test_streamed_records_feed_the_usage_report(spark, sf):
    """Call events to report: the stream's records, read as the table they land in, give what the batch records give.

    The report pins any value to the least, so the contacts compared are those that were not reopened.
    """
    from tallyline.operators.legs import LEG_FIELDS
    from tallyline.plans import reports

    events, prefixes = fx.call_events(spark, sf), fx.dial_prefixes(spark)
    batch = folders()[0]
    fold.contact_records(events, prefixes).write.json(batch)
    streamed = fx.streamed_contacts(spark, sf)["records"]
    contacts = fx.contacts(spark, sf)
    once = spark.read.json(streamed).groupBy("contactId").count().filter("count = 1")
    voice = once.select(F.col("contactId").alias("ContactId")).withColumn("Channel", F.lit("VOICE"))
    contacts = voice.join(contacts.drop("ContactId", "Channel").limit(1), how="cross").select(contacts.columns)
    usage = [reports.connection_usage(contacts, landing.call_connections(spark, path, LEG_FIELDS), ordered=False)
             for path in (batch, streamed)]
    assert usage[0].count() >= contacts.count() > 100
    same(*usage)


def test_a_terminal_event_may_come_first(spark):
    rows = [event("a", 1, "ACW", "ended"), event("a", 2, "Destroyed", "ended")]
    records = replay(spark, [rows[1:], rows[:1]])
    assert [r.completion for r in records.collect()] == ["destroyed"]


def test_a_new_checkpoint_keeps_older_results(spark):
    where = folders()
    first = replay(spark, [scenario()], where)
    before = {tuple(r) for r in first.select("contactId", "completion").collect()}
    replay(spark, [[event("more", 1, "Refresh", "error")]], (folders()[0], *where[1:3], folders()[3]))
    after = [tuple(r) for r in spark.read.schema(schemas.struct(fold.RECORD)).json(where[1])
             .select("contactId", "completion").collect()]
    assert set(after) == before | {("more", "error")} and len(after) == len(set(after))


def test_once_stops_by_itself(spark):
    source, records, submitted, offsets = folders()
    write_slice(frame(spark, [event("a", 1, "Refresh", "error")]), source)
    events = landing.stream_json(spark, source, schemas.CALL_EVENT)
    stream_contacts(events, records, submitted, offsets, once=True).awaitTermination()
    assert complete_contacts(spark, records).count() == 1


def test_stage_names():
    assert fold.stage_name("ended") == "stageEnded"
