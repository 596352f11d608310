"""Keys in another case: renamed where they stand, or lines taken apart; both bind the same."""

import json
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyline.functions.text import _back_to_back, parse_objects, split_objects
from tallyline.operators import legs
from tallyline.registry import fixtures as fx
from tallyline.registry import queries
from tallyline.sources import landing, schemas, spelling

LEGS = "contactId string, connections array<struct<id:string, agentStatus:struct<softPhoneEnabled:boolean>, n:int, tags:array<string>>>"


CASES = [
    ('{"contactId":"1"}', None),
    ('{"contactId":"\\"ID\\":","x":"CONTACTID","y":[{"z":"}{"}]}', None),
    ('{"ContactId":"é","other":"{\\"ID\\":1}"}', '{"contactId":"é","other":"{\\"ID\\":1}"}'),
    ('{"contactId" : "ID","CONNECTIONS" :[{"ID":"2"}, null]}', '{"contactId" : "ID","connections" :[{"id":"2"}, null]}'),
    ('{"CONTACTID":"1"},{"contactid":"2"}', '{"contactId":"1"},{"contactId":"2"}'),
    ('{"connections":[{"AGENTSTATUS":{"softphoneenabled":true},"N":7,"Tags":["ID",""]}]}',
     '{"connections":[{"agentStatus":{"softPhoneEnabled":true},"n":7,"tags":["ID",""]}]}'),
    # Both spellings, keys inside text, objects in strings, numbers in other forms, escapes, single quotes.
    ('{"CONTACTID":"1","contactId":"2"}', ""),
    ('{"CONTACTID":{"ID":1}}', ""),
    ('{"connections":[{"ID":"1","tags":[{"ID":1}]}]}', ""),
    ('{"CONTACTID":"1","connections":"[{}]"}', ""),
    ('{"connections":[{"ID":"1","agentStatus":"{\\"softphoneenabled\\":true}"}]}', ""),
    ('{"connections":[{"ID":"1","n":1.0}]}', ""),
    ('{"CONTACTID":"1","\\u0063onnections":[]}', ""),
    ("{'contactId':'\"ID\":','CONNECTIONS':[],\"CONTACTID\":1}", ""),
]


def test_keys_are_renamed_in_the_text(spark):
    schema = schemas.struct(LEGS)
    lines = [line for line, _ in CASES]
    assert spelling.Names(schema).bind(pa.array([*lines, None])).to_pylist() == [*(bound for _, bound in CASES), None]
    rows = spark.createDataFrame([(line,) for line in lines], "t string").select(
        parse_objects(landing.declared_spelling(F.col("t"), schema), schema).alias("now"),
        parse_objects(landing._taken_apart(F.col("t"), schema), schema).alias("apart")).collect()
    assert [r.now for r in rows] == [r.apart for r in rows]


def test_blocks_and_slices(monkeypatch):
    """Lines are told apart however they are cut into blocks, also where one ends in the middle of a key."""
    lines = ['{"a":"', 'ID":1}', None, "", '{"id":1,"x":"ID"', ':2}', '{"ID"', ':3}', '{"ID":4}', '{"Id" :5}', '{"iD"\t', ':6}'] * 5
    want = [None, None, None, None, None, None, None, None, '{"id":4}', '{"id" :5}', None, None] * 5
    names = spelling.Names(schemas.struct("id string"))
    for block in (1, 40, spelling.BLOCK):
        monkeypatch.setattr(spelling, "BLOCK", block)
        for kind in (pa.string(), pa.large_string()):
            got = names.bind(pa.array(lines, kind)[3:])
            assert got.type == kind and got.to_pylist() == want[3:]
    assert names.bind(pa.array([], pa.string())).to_pylist() == [] and names.bind(pa.array([None], pa.string())).to_pylist() == [None]


@pytest.mark.parametrize("name", ["CONTACT", "CONNECTION", "AGENT_EVENT", "CHAT_USAGE"])
def test_random_case_binds_as_taken_apart(spark, sf, name):
    schema = schemas.struct(getattr(schemas, name))
    path = {"CONTACT": fx.landed_contacts, "CONNECTION": fx.landed_connections, "AGENT_EVENT": fx.landed_agent_events}.get(name)
    lines = ([r.value for r in spark.read.text(path(spark, sf)).limit(20).collect()] if path else
             ['{"instanceId":"i","contactId":"c","system_msg":1,"customer_msg":null,"agent_msg":2.0,"total_msg":3}'] * 20)
    some = random.Random(7)

    def keys(value, share):
        if isinstance(value, dict):
            return {k.swapcase() if some.random() < share else k: keys(v, share) for k, v in value.items()}
        return [keys(v, share) for v in value] if isinstance(value, list) else value

    texts = [(json.dumps(keys(json.loads(x), share), separators=cut),)
             for x in lines for share in (0.02, 1) for cut in ((",", ":"), (", ", ": "), (",", " : "))]
    rows = spark.createDataFrame(texts, "t string").select(
        parse_objects(landing.declared_spelling(F.col("t"), schema), schema).alias("now"),
        parse_objects(landing._taken_apart(F.col("t"), schema), schema).alias("apart")).collect()
    assert all(r.now is not None for r in rows) and [r.now for r in rows] == [r.apart for r in rows]


def test_objects_back_to_back(spark):
    some = random.Random(3)
    cases = ["", "{", "}{", "x} {", "}", "} ", "}\r\n\x0b\f\t {", "}\x1c{", "}\x00{", "}\u00a0{", "{a}b {c} ", None]
    cases += ["".join(some.choice("{{}} \t\nxé\"") for _ in range(some.randrange(12))) for _ in range(500)]
    text = F.col("t")
    rows = spark.createDataFrame([(t,) for t in cases], "t string").select(
        text, _back_to_back(text).alias("now"), text.rlike(r"\}\s*\{").alias("pattern")).collect()
    assert [r.now for r in rows] == [r.pattern for r in rows] and {r.now for r in rows} == {True, False, None}
    one = '{"a":"}{","b":[{"c":1},{"d":{}}]}'
    pieces = spark.createDataFrame([(one,), (f"{one} {one}{one}",)], "t string").select(split_objects("t")).collect()
    assert [r[0] for r in pieces] == [[one], [one] * 3]


def test_a_reader_of_some_leaves_reads_no_others(spark, sf):
    """The legs of SRC-8 are those of a reader of every leaf."""
    assert legs.record_fields(legs._ZIPPED) == legs.LEG_FIELDS
    assert legs.record_fields(["endpointCountryISO", "softphoneEnabled"]) == [
        "contactId", "inbound", "initialConnectionId", "connections.id", "connections.agentStatus.softPhoneEnabled",
        "connections.endpointCountryISO"]
    whole = landing.call_connections(spark, fx.landed_mixed_spelling(spark, sf), legs.LEG_FIELDS, any_spelling=True)
    want = whole.transform(legs.flatten_legs).select(
        "contact_id", "conn_id", "endpointCountryISO", F.col("softphoneEnabled").cast("int").alias("softphone"))
    got = queries.mixed_spelling(spark, sf)
    assert got.columns == want.columns and sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
