"""Objects that hold many transcripts."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from tallyline.registry import fixtures as fx
from tallyline.sources import landing
from tallyline.streaming.feeds import stream_chat_usage


def document(contact, n):
    return json.dumps({"ContactId": contact, "InstanceId": "i", "Transcript": [{"Type": "MESSAGE", "ParticipantRole": "AGENT"}] * n})


def test_every_transcript_of_an_object_counts(spark):
    root = tempfile.mkdtemp(prefix="tallyline-test-")
    os.makedirs(f"{root}/in")
    pretty = json.dumps(json.loads(document("c", 3)), indent=1)
    for name, body in {"many": f'{document("a", 1)}\n{document("b", 2)}{pretty}\n{{"InstanceId":"}}{{"}}\n', "one": document("d", 4), "blank": " \n"}.items():
        with open(f"{root}/in/{name}", "w") as f:
            f.write(body)
    assert sorted(r.ContactId for r in landing.transcripts(spark, f"{root}/in").collect()) == ["a", "b", "c", "d"]
    stream_chat_usage(spark, f"{root}/in", f"{root}/out", f"{root}/errors", f"{root}/offsets", once=True).awaitTermination()
    assert {r.contactId: r.agent_msg for r in landing.chat_usage(spark, f"{root}/out").collect()} == {"a": 1, "b": 2, "c": 3, "d": 4}
    assert '{"InstanceId":"}{"}' in {r.value for r in spark.read.text(f"{root}/errors").collect()}


def test_objects_are_fewer_than_transcripts(spark):
    path = tempfile.mkdtemp(prefix="tallyline-test-") + "/in"
    documents = spark.range(0, 2500, 1, 2).select(
        F.concat(F.lit("c"), "id").alias("ContactId"), F.lit("i").alias("InstanceId"),
        F.expr("array(named_struct('Type', 'MESSAGE', 'ParticipantRole', 'AGENT'))").alias("Transcript"))
    fx.write_transcripts(documents, path)
    objects = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(objects) <= 8 and landing.transcripts(spark, path).count() == 2500
    assert landing.transcripts(spark, path).groupBy("source_object").count().agg(F.max("count")).first()[0] <= fx.TRANSCRIPTS_PER_OBJECT
