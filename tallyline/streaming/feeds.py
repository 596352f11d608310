"""Streaming jobs for the other feeds: raw records and chat transcripts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyline.operators import ingest
from tallyline.operators.messages import count_messages
from tallyline.sources import landing
from tallyline.sources.sinks import BUFFER_INTERVAL, CHAT_KEYS, each_batch, merge_by_key, staged, write_batch


def land_feed(spark: SparkSession, source: str, schema: str, path: str, errors: str, checkpoint: str,
              fmt: str = "parquet", once: bool = False, hook: Callable[[DataFrame], DataFrame] | None = None,
              max_bytes: int | None = None) -> StreamingQuery:
    """Repair a JSON feed into a table folder as new objects arrive.

    Lines with several objects are split; what cannot be read goes to
    ``errors``, byte for byte. ``hook`` maps the lines (``value``) first. A
    micro-batch is taken each minute, of at most ``max_bytes`` bytes.
    """
    def store(lines: DataFrame, batch_id: int, run: str) -> None:
        lines = lines if hook is None else hook(lines)
        parsed = staged(lines.transform(ingest.split_records).transform(
            ingest.parse_records, schema, options=landing.OPTIONS), checkpoint)
        write_batch(ingest.accepted(parsed), path, batch_id, fmt, run)
        write_batch(ingest.rejected(parsed).select("value"), errors, batch_id, "text", run)

    lines = landing.stream_lines(spark, source, max_bytes=max_bytes)
    return _start(lines, store, checkpoint, once)


def stream_chat_usage(spark: SparkSession, source: str, path: str, errors: str, checkpoint: str,
                      once: bool = False, merge: bool = False) -> StreamingQuery:
    """Count the messages of each new transcript object; objects that hold no transcript go to ``errors``.

    A transcript written again is counted again, in a later batch; readers
    take the last version (``landing.chat_usage``). With ``merge`` the counts are
    a keyed table instead (``landing.merged_chat_usage``), of which a batch
    rewrites the buckets of its chats.
    """
    def store(files: DataFrame, batch_id: int, run: str) -> None:
        counts = count_messages(landing.parse_transcripts(files))
        if merge:
            merge_by_key(counts, path, CHAT_KEYS, ["written", "source_object"])
        else:
            write_batch(counts, path, batch_id, run=run)
        write_batch(landing.broken_transcripts(files).select("value"), errors, batch_id, "text", run)

    return _start(landing.stream_transcripts(spark, source), store, checkpoint, once)


def stream_notified_chats(spark: SparkSession, notices: str, objects: str, path: str, errors: str, checkpoint: str,
                          archive: str | None = None, once: bool = False) -> StreamingQuery:
    """Count the messages of the transcripts that object-created messages under ``notices`` name, in the keyed table ``path``.

    Only named objects under ``objects`` are opened: what lies there besides
    costs nothing. Messages that name none, objects that are gone and objects
    that hold no transcript go to ``errors``. A message may come twice.
    """
    def store(lines: DataFrame, batch_id: int, run: str) -> None:
        session = lines.sparkSession
        keys = [r[0] for r in landing.notified_keys(lines).collect()]  # of a bounded number of messages
        found, missing = landing.objects_at(session, objects, keys) if keys else (None, [])
        bad = landing.unreadable_notices(lines).select("value").unionByName(
            session.createDataFrame([(k,) for k in missing], "value string"))
        if found is not None:
            merge_by_key(count_messages(landing.parse_transcripts(found)), path, CHAT_KEYS, ["written", "source_object"])
            bad = bad.unionByName(landing.broken_transcripts(found).select("value"))
        write_batch(bad, errors, batch_id, "text", run)

    return _start(landing.stream_notices(spark, notices, archive), store, checkpoint, once)


def land_submissions(spark: SparkSession, source: str, schema: str, path: str, bad_envelopes: str, bad_objects: str,
                     checkpoint: str, once: bool = False, max_bytes: int | None = None) -> StreamingQuery:
    """Take submission envelopes, a line each, apart into records as new objects arrive.

    Each micro-batch is read once and written three times: the records that
    name a contact, the envelopes that are not valid, and the objects of valid
    ones that do not parse or name no contact. Every envelope and object ends in one of them.
    """
    def store(lines: DataFrame, batch_id: int, run: str) -> None:
        # One pass over the lines: an envelope that is not valid goes along as a row that fails.
        checked = ingest.check_envelope(lines, "value").filter("NOT valid OR data IS NOT NULL").select(
            "data", "valid", F.when(~F.col("valid"), F.col("value")).alias("envelope"))
        objects = staged(ingest.unwrap_batch(checked, schema), checkpoint)
        valid = objects.filter("valid").drop("valid", "envelope")
        records = ingest.accepted(valid)
        named = ingest.with_contact_id(records)
        nameless = records.filter(F.coalesce("contactId", F.lit("")) == "").select(F.to_json(F.struct("*")).alias("value"))
        write_batch(named, path, batch_id, "parquet", run)
        write_batch(objects.filter("NOT valid").select(F.col("envelope").alias("value")), bad_envelopes, batch_id, "text", run)
        write_batch(ingest.rejected(valid).select("value").unionByName(nameless), bad_objects, batch_id, "text", run)

    return _start(landing.stream_lines(spark, source, max_bytes=max_bytes), store, checkpoint, once)


def _start(stream: DataFrame, store, checkpoint: str, once: bool) -> StreamingQuery:
    writer = (stream.writeStream.foreachBatch(each_batch(store)).outputMode("append")
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=BUFFER_INTERVAL)
    return writer.start()
