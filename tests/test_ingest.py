"""Repair, validation, unwrapping, dead letters, and binding of field names."""

import base64
import json
import os
import tempfile

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyline.functions import text
from tallyline.operators import ingest
from tallyline.plans import reports
from tallyline.registry import fixtures as fx
from tallyline.sources import landing, schemas, sinks
from tallyline.streaming import feeds

RECORD = "contactId string, note string"
FEW = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

plain = st.text(alphabet=st.characters(codec="utf-8", exclude_categories=["Cs", "Cc"]), max_size=12)
tricky = st.one_of(plain, st.sampled_from(["}{", '"}{"', "\\", '\\"}', "{[", "},{"]))
records = st.lists(st.fixed_dictionaries({"contactId": plain, "note": tricky}), min_size=1, max_size=4)


def folder() -> str:
    return tempfile.mkdtemp(prefix="tallyline-test-")


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


@FEW
@given(records)
def test_back_to_back_objects_survive(spark, objects):
    line = "".join(json.dumps(o, ensure_ascii=False) for o in objects)
    good, bad = ingest.repair(lines(spark, [line]), RECORD)
    assert sorted(map(tuple, good.collect())) == sorted((o["contactId"], o["note"]) for o in objects)
    assert bad.count() == 0


@FEW
@given(records)
def test_batches_round_trip(spark, objects):
    payload = json.dumps(objects)[1:-1] + "\n"
    data = base64.b64encode(payload.encode()).decode()
    df = spark.createDataFrame([(data,)], "data string").transform(ingest.unwrap_batch, RECORD)
    assert sorted(map(tuple, ingest.accepted(df).collect())) == sorted((o["contactId"], o["note"]) for o in objects)


def test_wrap_is_the_inverse_of_unwrap(spark):
    df = spark.createDataFrame([('{"contactId":"1"}', '{"contactId":"2","note":"' + "x" * 200 + '"}')], "a string, b string")
    back = df.transform(ingest.wrap_batch, "a", "b").select("data").transform(ingest.unwrap_batch, RECORD)
    assert [r.contactId for r in ingest.accepted(back).collect()] == ["1", "2"]


def test_bad_lines_keep_their_text(spark):
    values = ['{"contactId":"1"}', '{"contactId":"2"} x', '{"contactId":"3"', '{"contactId":"open}{"', "nope", "",
              '{"contactId":"4"}{"contactId":"5"}{bad}']
    parsed = lines(spark, values).transform(ingest.split_records).transform(ingest.parse_records, RECORD)
    assert sorted(r.contactId for r in ingest.accepted(parsed).collect()) == ["1", "4", "5"]
    assert sorted(r.value for r in ingest.rejected(parsed).collect()) == sorted(
        ['{"contactId":"2"} x', '{"contactId":"3"', '{"contactId":"open}{"', "nope", "{bad}"])
    counts = {r["result"]: r.records for r in parsed.transform(ingest.status_counts).collect()}
    assert counts == {"Ok": 3, "ProcessingFailed": 5}


def test_dead_letters_are_written_as_they_came(spark):
    path = folder() + "/errors"
    _, bad = ingest.repair(lines(spark, ['{"contactId":"1"}', "  broken  "]), RECORD)
    sinks.write_dead_letters(bad, path)
    assert [r.value.strip() for r in spark.read.text(path).collect()] == ["broken"]


@pytest.mark.parametrize("body, valid, data", [
    ('{"DeliveryStreamName":"s","Record":{"Data":"YQ=="}}', True, "YQ=="),
    ('{"DeliveryStreamName":"s","Record":{}}', True, None),
    ('{"DeliveryStreamName":"s","Record":{"Data":7}}', False, None),
    ('{"DeliveryStreamName":"s","Record":{"Data":null}}', False, None),
    ('{"DeliveryStreamName":1,"Record":{"Data":"YQ=="}}', False, None),
    ('{"DeliveryStreamName":"s","Record":"YQ=="}', False, None),
    ('{"Record":{"Data":"YQ=="}}', False, None),
    ('{"DeliveryStreamName":"s"}', False, None),
    ("[]", False, None), ("nope", False, None), (None, False, None),
])
def test_envelopes(spark, body, valid, data):
    row = spark.createDataFrame([(body,)], "body string").transform(ingest.check_envelope).first()
    assert (row.valid, row.data) == (valid, data)


def test_broken_base64_is_a_failure(spark):
    df = spark.createDataFrame([("@@@",), (None,)], "data string").transform(ingest.unwrap_batch, RECORD)
    assert {r["result"] for r in df.collect()} == {"ProcessingFailed"}


def test_contact_id_is_required(spark):
    df = spark.createDataFrame([("a",), ("",), (None,)], "contactId string")
    assert [r[0] for r in ingest.with_contact_id(df).collect()] == ["a"]


def test_keys_keep_plus_signs(spark):
    df = spark.createDataFrame([("a+b%2Fc%20d",), ("%zz",)], "key string")
    assert [r[0] for r in ingest.decode_keys(df).collect()] == ["a+b/c d", None]


@pytest.mark.parametrize("phrase, want", [
    ("after_call WORK", "After_call Work"), ("connecting", "Connecting"), ("(foo BAR", "(Foo Bar"),
    ("a  b\tC", "A  B\tC"), ("", ""), ("9LIVES -x", "9lives -X"), (None, None),
])
def test_proper_case(spark, phrase, want):
    assert spark.createDataFrame([(phrase,)], "p string").select(text.proper_case("p")).first()[0] == want


@pytest.mark.parametrize("value, want", [("true", True), ("FALSE", False), ("", None), ("x", None), (None, None)])
def test_loose_boolean(spark, value, want):
    assert spark.createDataFrame([(value,)], "v string").select(text.loose_boolean("v")).first()[0] is want


def test_free_form_objects_stay_text(spark):
    path = folder()
    with open(f"{path}/one.json", "w") as f:
        f.write('{"ContactId":"1","Attributes":{"k":[1,2]},"Recordings":[{"a":1}],"LastUpdateTimestamp":"t"}\n')
    row = landing.contact_records(spark, path).first()
    assert (row.Attributes, row.Recordings, row.LastUpstringTimestamp) == ('{"k":[1,2]}', '[{"a":1}]', "t")


def landed(text):
    path = folder()
    with open(f"{path}/one.json", "w") as f:
        f.write(text)
    return path


def test_mismatched_shape_is_kept(spark):
    good = {"EventId": "1", "PreviousAgentSnapshot": {"Configuration": {"AgentHierarchyGroups": ["a"]}}}
    bad = {"EventId": "2", "PreviousAgentSnapshot": {"Configuration": {"AgentHierarchyGroups": {"a": 1}}}}
    path = landed(json.dumps(good) + "\n" + json.dumps(bad) + "\n")
    rows = {r.EventId: r for r in landing.agent_events(spark, path).collect()}
    aside = [json.loads(r.value) for r in landing.rejects(spark, path, schemas.AGENT_EVENT).collect()]
    assert set(rows) | {a["EventId"] for a in aside} == {"1", "2"} and None not in rows


def test_readers_account_for_every_object(spark):
    path = landed('{"EventId":"1"}{"EventId":"2"}\n{"EventId":"3\n\n{"eventid":"4"}\n{"EventId":"5"}\n{}\n')
    assert sorted(r.EventId for r in landing.agent_events(spark, path).collect()) == ["1", "2", "5"]
    assert sorted(r.value for r in landing.rejects(spark, path, schemas.AGENT_EVENT).collect()) == [
        '{"EventId":"3', '{"eventid":"4"}', "{}"]
    assert sorted(r.EventId for r in landing.agent_events(spark, path, any_spelling=True).collect()) == ["1", "2", "4", "5"]


def test_feeds_keep_every_object(spark):
    source = landed('{"EventId":"1"}{"EventId":"2"}\n{"EventId":"3\n{"EventId":"4"}\nskip\n')
    table, errors, offsets = folder(), folder(), folder()
    feeds.land_feed(spark, source, schemas.AGENT_EVENT, table, errors, offsets, once=True,
                    hook=lambda lines: lines.filter("value <> 'skip'")).awaitTermination()
    assert sorted(r.EventId for r in spark.read.parquet(table).collect()) == ["1", "2", "4"]
    assert [r.value for r in spark.read.text(errors).collect()] == ['{"EventId":"3']


def test_broken_transcripts_go_to_the_errors(spark):
    source, table, errors = folder(), folder(), folder()
    for name, text in (("a", '{"ContactId":"a","InstanceId":"i",\n"Transcript":[{"Type":"MESSAGE","ParticipantRole":"AGENT"}]}'),
                       ("b", '{"ContactId":"b","Trans'), ("c", "")):
        with open(f"{source}/{name}.json", "w") as f:
            f.write(text)
    assert [r.ContactId for r in landing.transcripts(spark, source).collect()] == ["a"]
    feeds.stream_chat_usage(spark, source, table, errors, folder(), once=True).awaitTermination()
    usage = landing.chat_usage(spark, table)
    assert [(r.contactId, r.agent_msg) for r in usage.collect()] == [("a", 1)]
    assert '{"ContactId":"b","Trans' in {r.value for r in spark.read.text(errors).collect()}
    contacts = spark.createDataFrame([("a", "CHAT", "i")], "ContactId string, Channel string, InstanceARN string")
    missing = [f for f in schemas.struct(schemas.CONTACT).fields if f.name not in contacts.columns]
    contacts = contacts.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])
    assert reports.chat_report(usage, contacts).count() == 1


def test_one_bad_object_does_not_void_its_batch(spark):
    payload = '{"contactId":"1","note":"},{"},{"contactId":},{"contactId":"3"},{"contactId":"4"'
    data = base64.b64encode(payload.encode()).decode()
    parsed = spark.createDataFrame([(data,)], "data string").transform(ingest.unwrap_batch, RECORD)
    assert [r.contactId for r in ingest.accepted(parsed).collect()] == ["1", "3"]
    assert [r.value for r in ingest.rejected(parsed).collect()] == ['{"contactId":}', '{"contactId":"4"']


@pytest.mark.parametrize("case", [str.lower, str.upper])
def test_any_case_binds_in_every_table(spark, sf, case):
    def keys(value):
        if isinstance(value, dict):
            return {case(k): keys(v) for k, v in value.items()}
        return [keys(v) for v in value] if isinstance(value, list) else value

    for read, path in ((landing.contact_records, fx.landed_contacts(spark, sf)),
                       (landing.call_connections, fx.landed_connections(spark, sf)),
                       (landing.agent_events, fx.landed_agent_events(spark, sf))):
        lines = [r.value for r in spark.read.text(path).limit(40).collect()]
        free = landed("\n".join(lines))
        other = landed("\n".join(json.dumps(keys(json.loads(x)), separators=(",", ":")) for x in lines))
        want, got = read(spark, free), read(spark, other, any_spelling=True)
        hidden = ["Attributes", "TransferredToEndpoint", "CurrentAgentSnapshot"]  # free-form text is kept as it is
        assert sorted(map(repr, want.drop(*hidden).collect())) == sorted(map(repr, got.drop(*hidden).collect()))
    chat = landed(json.dumps({case("contactId"): "a", case("total_msg"): 3}))
    assert [(r.contactId, r.total_msg) for r in landing.chat_usage(spark, chat, any_spelling=True).collect()] == [("a", 3)]


def test_any_spelling_binds(spark):
    path = folder()
    with open(f"{path}/c.json", "w") as f:
        for name in ("endpointCountryISO", "endpointCountryIso", "ENDPOINTCOUNTRYISO"):
            f.write('{"contactId":"\\"endpointCountryIso\\":","connections":[{"id":"1","%s" : "US"}]}\n' % name)
    exact = landing.call_connections(spark, path).select(F.col("connections.endpointCountryISO"))
    loose = landing.call_connections(spark, path, any_spelling=True)
    assert [r[0][0] for r in exact.collect()] == ["US", None, None]
    assert [r[0][0] for r in loose.select("connections.endpointCountryISO").collect()] == ["US"] * 3
    assert {r.contactId for r in loose.collect()} == {'"endpointCountryIso":'}


def test_free_form_keys_are_not_bound(spark):
    """Keys inside text fields stay as they are, whatever fields have their names; keys are bound object by object."""
    attributes = '{"queue":"vip","Agent":"x","ID":{"CHANNEL":[1,"b\\"c"]},"endpointcountryiso":null}'
    path = landed("\n".join([
        '{"contactid":"1","Attributes":%s,"channel":"VOICE"}{"ContactId":"2","ATTRIBUTES":"plain \\"queue\\":"}' % attributes,
        '{"CONTACTID":"3","Queue":{"name":"q","DURATION":7,"Arn":"5"},"queue":{"Name":"other"},"agent":{"numberofholds":"2"}}',
        '{"contactId":"4","ContactId":"5","mediastreams":[{"type":"AUDIO"},null,{"Type":"CHAT"}],"Agent":{"NUMBEROFHOLDS":2}}',
        '{"contactid":"6","attributes":']))
    rows = {r.ContactId: r for r in landing.contact_records(spark, path, any_spelling=True).collect()}
    assert set(rows) == {"1", "2", "3", "5"}
    assert rows["1"].Attributes == attributes and rows["1"].Channel == "VOICE" and rows["1"].Queue is None
    assert rows["2"].Attributes == 'plain "queue":'
    assert rows["3"].Queue.asDict() == {"ARN": "5", "DequeueTimestamp": None, "Duration": 7, "EnqueueTimestamp": None, "Name": "q"}
    assert rows["3"].Agent.NumberOfHolds is None  # text for a number binds no better than without another case
    assert [m and m.Type for m in rows["5"].MediaStreams] == ["AUDIO", None, "CHAT"] and rows["5"].Agent.NumberOfHolds == 2
    left = landing.read_records(spark, path, schemas.CONTACT, any_spelling=True)[1]
    assert [r.value for r in left.collect()] == ['{"contactid":"6","attributes":']


def test_narrow_schema():
    schema = schemas.narrow(schemas.struct(schemas.CONNECTION), ["contactId", "connections.id", "connections.history.timestamp"])
    assert schema.simpleString() == (
        "struct<contactId:string,connections:array<struct<id:string,history:array<struct<timestamp:string>>>>>")
    with pytest.raises(ValueError):
        schemas.narrow(schema, ["nothing"])


def test_replayed_batch_overwrites(spark):
    path = folder()
    for _ in range(2):
        sinks.write_batch(spark.range(3), path, 7)
    assert os.listdir(path) == ["batch=7"] and spark.read.json(path).count() == 3


def test_chat_upsert_keeps_the_last_version(spark):
    rows = [("i", "c", 1, 0, 0, 1, "2024-01-01", "a"), ("i", "c", 2, 0, 0, 2, "2024-01-02", "a"), ("i", "d", 3, 0, 0, 3, "2024-01-01", "b")]
    df = spark.createDataFrame(rows, "instanceId string, contactId string, system_msg int, customer_msg int, agent_msg int, "
                                     "total_msg int, written string, source_object string")
    df = df.withColumn("written", F.col("written").cast("timestamp"))
    path, versions = folder() + "/usage", folder()
    for _ in range(2):
        sinks.write_chat_usage(df, path)
    sinks.write_json(df, versions)
    for where in (path, versions):
        assert {(r.contactId, r.system_msg) for r in landing.chat_usage(spark, where).collect()} == {("c", 2), ("d", 3)}


def test_columnar_table_prunes_partitions(spark):
    path = folder() + "/table"
    df = spark.createDataFrame([("VOICE", "2024-01-02T00:00:00Z"), ("CHAT", "2024-01-03T00:00:00Z")], "Channel string, at string")
    sinks.write_columnar(sinks.with_partition_day(df, "at"), path, ["Channel", "day"])
    plan = spark.read.parquet(path).filter("Channel = 'VOICE'")
    assert plan.count() == 1
    assert "PartitionFilters: [isnotnull(Channel" in plan._jdf.queryExecution().toString()


def test_published_table(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "contact_id string, n int")
    name = sinks.publish_table(df, "published_usage", buckets=4, key="contact_id")
    assert spark.table(name).count() == 2
    plan = spark.table(name).groupBy("contact_id").count()._jdf.queryExecution().toString()
    assert "Exchange" not in plan.split("== Physical Plan ==")[1]
