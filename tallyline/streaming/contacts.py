"""Streaming fold of call events into contact records.

The state is keyed (``keyed``): a micro-batch touches the contacts that its
events name, and a timer per contact releases it when it is too old, also in a
feed that has fallen silent. Nothing depends on the order that events arrive
in: an event of a contact that is already out opens another record, and the
records of a contact merge. A contact is in the state while it is pending and
among the records once it is complete, in one of the two and never in both.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyline.operators import contact_fold as fold
from tallyline.session import settings
from tallyline.sources import schemas
from tallyline.sources.sinks import each_batch, write_batch, write_json
from tallyline.streaming import keyed

EMIT_INTERVAL = "300 seconds"


@dataclass(frozen=True)
class ContactJob:
    """The two queries of the job: the fold, and the audit trail of what was submitted to it."""

    fold: StreamingQuery
    audit: StreamingQuery

    def awaitTermination(self, timeout: int | None = None) -> None:
        for query in (self.fold, self.audit):
            query.awaitTermination() if timeout is None else query.awaitTermination(timeout)

    def stop(self) -> None:
        for query in (self.fold, self.audit):
            query.stop()


def stream_contacts(events: DataFrame, path: str, submitted: str, checkpoint: str, prefixes: DataFrame | None = None,
                    once: bool = False, every: str = EMIT_INTERVAL, limit: int = fold.PENDING_LIMIT_SECONDS,
                    lag: int = 0, history: str | None = None, partitions: int | None = None) -> ContactJob:
    """Fold a stream of call events into contact records under ``path``, and store the events under ``submitted``.

    With ``history`` the connections' history is stored there too, in pages of
    the events of a micro-batch, as partial records (``contact_fold.history_of``).

    A pending contact is released ``limit`` seconds after its first event, by
    the clock of the machine, at the first micro-batch from then on. ``lag`` is
    how many seconds the feed lies back: a replay of last week's events ages
    them as last week did. ``once`` works off what is there, releases what is
    due and stops. ``partitions`` of the state, each a worker in every
    micro-batch, are fixed by the first start; the session's shuffle partitions by default.

    The folders of records and events are keyed by query and batch and
    overwritten on replay; a replayed micro-batch takes the same events, state
    and time as its first attempt, so it writes the same.
    """
    spark = events.sparkSession
    types = keyed.part_types(spark)

    def emit(batch: DataFrame, batch_id: int, run: str) -> None:
        write_batch(fold.records_of(keyed.completed_parts(batch, types)), path, batch_id, run=run)

    def submit(batch: DataFrame, batch_id: int, run: str) -> None:
        stored = batch.sparkSession.read.schema(batch.schema).parquet(
            write_batch(fold.known_events(batch), submitted, batch_id, "parquet", run))
        if history is not None:
            write_batch(fold.page_records(fold.history_pages(stored)), history, batch_id, run=run)

    done = keyed.completed(events.unionByName(_heartbeat(events)), prefixes, types, limit, lag)
    sized = {} if partitions is None else {"spark.sql.shuffle.partitions": str(partitions)}
    with settings(spark, keyed.STATE_CONF | sized):
        started = [(frame.writeStream.foreachBatch(each_batch(store)).outputMode("append")
                    .option("checkpointLocation", f"{checkpoint}/{name}").trigger(**trigger).start())
                   for name, frame, store, trigger in (
                       ("fold", done, emit, {"processingTime": "0 seconds" if once else every}),
                       ("audit", events, submit, {"availableNow": True} if once else {"processingTime": every}))]
    job = ContactJob(*started)
    if once:
        _catch_up(job.fold)
        job.audit.awaitTermination()
    return job


def _heartbeat(events: DataFrame) -> DataFrame:
    """A row a second that is no event, with the columns of ``events``.

    It gives every trigger a micro-batch, also the first after a restart into a
    silent feed, which would otherwise wait for an event before it looks at timers.
    """
    beat = events.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).load()
    none = {f.name: F.lit(None).cast(f.dataType) for f in events.schema.fields}
    # Never true, but not known to be so: the optimizer would leave the source out.
    none["contactId"] = F.when(F.col("value") < 0, F.lit(""))
    return beat.select(*[column.alias(name) for name, column in none.items()])


def _catch_up(query: StreamingQuery, poll: float = 0.1) -> None:
    """Wait for a micro-batch that found nothing new, which also released what was due, and stop.

    A job with timers by the clock never runs out of micro-batches by itself.
    The first of a run may repeat one that the run before was stopped in. That
    takes what was listed then, so it does not tell that nothing has come since.
    """
    def drained(progress) -> bool:
        return all(s.startOffset == s.endOffset for s in progress.sources if "RateStream" not in s.description)

    first = None
    while query.isActive:
        last = query.lastProgress
        if last is not None and "addBatch" in last.durationMs:
            first = last.batchId if first is None else first
            if last.batchId > first and drained(last):
                break
        time.sleep(poll)
    query.stop()
    if query.exception() is not None:
        raise query.exception()


def pending_contacts(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The records of pending contacts, from the state of a job that may be running: those after its last micro-batch.

    In the form of the complete ones; their completion is NULL.
    """
    types = keyed.part_types(spark)
    parts = keyed.pending_parts(spark, f"{checkpoint}/fold", types)
    return fold.records_of(parts.withColumn("completion", F.lit(None).cast("string")))


def complete_contacts(spark: SparkSession, path: str) -> DataFrame:
    """The records that the job has emitted, one for each time a contact became complete."""
    schema = schemas.struct(fold.RECORD)
    return spark.read.schema(schema).json(path).select(schema.names)


def write_slice(events: DataFrame, path: str) -> None:
    """Append events to a landing folder as JSON lines."""
    write_json(events, path)
