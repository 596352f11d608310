"""What landing folders and feeds put on disk."""

import os
import tempfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.sources import sinks
from tallyline.streaming import feeds


def size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.startswith("part-"))


def test_landed_text_is_compressed_in_files_of_bounded_rows(spark):
    root = tempfile.mkdtemp(prefix="tallyline-test-")
    rows = spark.range(0, 250_000, 1, 1).select("id", F.lit("a long name that every record repeats").alias("name"))
    sinks.write_json(rows, f"{root}/json")
    sinks.write_lines(rows.select(F.to_json(F.struct("*")).alias("value")), f"{root}/lines")
    sinks.write_batch(rows, f"{root}/batch", 0)
    for name in ("json", "lines", "batch"):
        assert size(f"{root}/{name}") < 250_000 * 60 / 5
    counts = spark.read.text(f"{root}/lines").groupBy(F.input_file_name()).count().collect()
    assert sorted(r["count"] for r in counts) == [50_000, 100_000, 100_000]
    assert spark.read.json(f"{root}/json").count() == spark.read.json(f"{root}/batch").count() == 250_000


def test_feeds_cache_nothing(spark, monkeypatch):
    def kept(self, *_):
        raise AssertionError("a micro-batch is cached")

    monkeypatch.setattr(DataFrame, "persist", kept)
    root = tempfile.mkdtemp(prefix="tallyline-test-")
    for batch, line in enumerate(('{"contactId":"1"}{"contactId":"2"}', '{"contactId":"3"}\nbroken')):
        os.makedirs(f"{root}/in", exist_ok=True)
        with open(f"{root}/in/{batch}", "w") as f:
            f.write(line)
        feeds.land_feed(spark, f"{root}/in", "contactId string", f"{root}/out", f"{root}/errors", f"{root}/offsets", once=True).awaitTermination()
    assert sorted(r.contactId for r in spark.read.parquet(f"{root}/out").collect()) == ["1", "2", "3"]
    assert [r.value for r in spark.read.text(f"{root}/errors").collect()] == ["broken"]
