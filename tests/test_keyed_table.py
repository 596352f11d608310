"""The keyed table that batches merge into, and the feeds beside it."""

import glob
import json
import os
import tempfile

from pyspark.sql import functions as F

from tallyline.sources import landing, sinks
from tallyline.streaming.feeds import land_submissions, stream_notified_chats

SCHEMA = "instanceId string, contactId string, total_msg int, written long, source_object string"


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/bucket=*/*.parquet")}


def test_one_key_rewrites_one_bucket(spark):
    path = tempfile.mkdtemp(prefix="tallyline-test-") + "/chats"
    rows = [("i", f"c{n}", n, 1, "a") for n in range(500)]
    merge = lambda part: sinks.merge_by_key(spark.createDataFrame(part, SCHEMA), path, ["instanceId", "contactId"], ["written", "source_object"])
    merge(rows)
    before = files(path)
    assert len({os.path.dirname(f) for f in before}) == sinks.BUCKETS
    merge([("i", "c7", 70, 2, "a"), ("i", "c7", 69, 1, "b")])
    after = files(path)
    changed = {os.path.dirname(f) for f, _ in set(before.items()) ^ set(after.items())}
    assert len(changed) == 1
    merge([("i", "c7", 70, 2, "a")])  # the same again
    merge([("i", "c7", 1, 0, "a")])  # an older version
    merge([])
    merge([("i", None, 5, 1, "a"), ("i", None, 6, 2, "a")])
    got = {r.contactId: r.total_msg for r in landing.merged_chat_usage(spark, path).collect()}
    assert got == {f"c{n}": n for n in range(500)} | {"c7": 70, None: 6}
    assert landing.merged_chat_usage(spark, path).count() == 501


def test_every_submission_is_accounted_for(spark):
    root = tempfile.mkdtemp(prefix="tallyline-test-")
    pack = lambda s: __import__("base64").b64encode(s.encode()).decode()
    one, bad, none = '{"contactId":"1","type":"voice"}', '{"contactId":}', '{"type":"x"}'
    lines = ['{"DeliveryStreamName":"s","Record":{"Data":"%s"}}' % pack(f"{one},{bad},{none}\\n".replace("\\n", "\n")),
             '{"DeliveryStreamName":"s","Record":{"Data":"???"}}', '{"DeliveryStreamName":"s","Record":{}}',
             '{"DeliveryStreamName":7,"Record":{"Data":"%s"}}' % pack(one), "no json", '{"DeliveryStreamName":"s"}']
    os.makedirs(f"{root}/in")
    with open(f"{root}/in/a.json", "w") as f:
        f.write("\n".join(lines))
    for _ in range(2):  # the second run finds nothing new
        land_submissions(spark, f"{root}/in", "contactId string, type string", f"{root}/out", f"{root}/envelopes", f"{root}/objects",
                         f"{root}/offsets", once=True).awaitTermination()
    assert [tuple(r)[:2] for r in spark.read.parquet(f"{root}/out").select("contactId", "type").collect()] == [("1", "voice")]
    assert sorted(r.value for r in spark.read.text(f"{root}/envelopes").select("value").collect()) == sorted([lines[3], "no json", lines[5]])
    assert sorted(r.value for r in spark.read.text(f"{root}/objects").select("value").collect()) == sorted([bad, none, "???"])


def test_only_named_objects_are_opened(spark):
    root = tempfile.mkdtemp(prefix="tallyline-test-")
    os.makedirs(f"{root}/objects/old")
    os.makedirs(f"{root}/notices")
    document = lambda c, n: json.dumps({"ContactId": c, "InstanceId": "i", "Transcript": [{"Type": "MESSAGE", "ParticipantRole": "AGENT"}] * n})
    for name, body in [("old/a b+c.json", document("1", 2)), ("old/[x]*{2}.json", document("2", 3)), ("old/bad.json", "{"), ("old/unnamed.json", document("3", 1))]:
        with open(f"{root}/objects/{name}", "w") as f:
            f.write(body)
    notice = lambda *keys: json.dumps({"Records": [{"s3": {"object": {"key": k}}} for k in keys]})

    def run(name, *lines):
        if lines:
            with open(f"{root}/notices/{name}", "w") as f:
                f.write("\n".join(lines))
        stream_notified_chats(spark, f"{root}/notices", f"{root}/objects", f"{root}/table", f"{root}/errors", f"{root}/offsets",
                              once=True).awaitTermination()
        return {r.contactId: r.agent_msg for r in landing.merged_chat_usage(spark, f"{root}/table").collect()}

    assert run("1", notice("old/a%20b+c.json", "old/gone.json"), "no json", notice()) == {"1": 2}
    assert run("2", notice("old/%5Bx%5D%2A%7B2%7D.json"), notice("old/bad.json", "old/a%20b+c.json")) == {"1": 2, "2": 3}
    assert run("3") == {"1": 2, "2": 3}
    with open(f"{root}/objects/old/a b+c.json", "w") as f:
        f.write(document("1", 5))
    assert run("4", notice("old/a%20b+c.json")) == {"1": 5, "2": 3}
    errors = sorted(r.value for r in spark.read.text(f"{root}/errors").select("value").collect())
    assert errors == sorted(["old/gone.json", "no json", notice(), "{"])
