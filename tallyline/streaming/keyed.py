"""Keyed state of the streaming fold: one entry per contact, one per connection, and a timer per contact.

A micro-batch reads and writes only the contacts that its events name; the
state store keeps the rest as it is and logs only what changed. Events are
combined in each task before they move, so a contact with most of the events
moves a row per connection and task. A contact's timer runs by the clock of the
job and fires whether or not events arrive, since a job with such timers runs
its micro-batches in silence too.

State, and what moves, is flat text. A fold's text begins with the time and id
of the event it comes from, in digits of fixed width, so the order of texts is
the order of events and a fold is the least or the greatest text.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from tallyline.operators import contact_fold as fold
from tallyline.sources import schemas

# The processor travels to the executors whole, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Times and ids are written without a sign, from the least that a year or a bigint can hold.
TIME_WIDTH, TIME_BASE = 19, 10**18
ID_WIDTH, ID_BASE = 20, 2**63


def _time_text(ts: Column) -> Column:
    return F.lpad((F.unix_micros(ts) + F.lit(TIME_BASE)).cast("string"), TIME_WIDTH, "0")


def _text_time(text: Column) -> Column:
    return F.timestamp_micros(F.substring(text, 1, TIME_WIDTH).cast("bigint") - F.lit(TIME_BASE))


def _order_text(of: Column) -> Column:
    number = of["event_id"].cast("decimal(20,0)") + F.lit(str(ID_BASE)).cast("decimal(20,0)")
    return F.concat(_time_text(of["ts"]), F.lpad(number.cast("string"), ID_WIDTH, "0"))


def _to_text(name: str, kind: T.DataType) -> Column:
    column = F.col(name)
    if isinstance(kind, T.TimestampType):
        return _time_text(column)
    if isinstance(kind, T.BooleanType):
        return column.cast("int").cast("string")
    if isinstance(kind, T.StructType):
        value = F.to_json(F.struct(column["value"].alias("value"))) if "value" in kind.names else F.lit("")
        return F.when(column.isNotNull(), F.concat(_order_text(column), value))
    return column


def _from_text(name: str, kind: T.DataType) -> Column:
    text = F.col(name)
    if isinstance(kind, T.TimestampType):
        return _text_time(text)
    if isinstance(kind, T.BooleanType):
        return text.cast("int").cast("boolean")
    if isinstance(kind, T.StructType):
        number = (F.substring(text, TIME_WIDTH + 1, ID_WIDTH).cast("decimal(20,0)") - F.lit(str(ID_BASE)).cast("decimal(20,0)")).cast("bigint")
        parts = [_text_time(text).alias("ts"), number.alias("event_id")]
        if "value" in kind.names:
            body = T.StructType([T.StructField("value", kind["value"].dataType)])
            parts.append(F.from_json(F.substr(text, F.lit(TIME_WIDTH + ID_WIDTH + 1)), body)["value"].alias("value"))
        return F.when(text.isNotNull(), F.struct(*parts))
    return text.cast(kind)


def part_types(spark) -> dict[str, T.DataType]:
    """The type of each fold, as ``fold_parts`` has it."""
    none = spark.createDataFrame([], schemas.struct(schemas.CALL_EVENT))
    return {f.name: f.dataType for f in fold.fold_parts(none).schema.fields if f.name not in fold.KEYS}


def as_text(parts: DataFrame, types: dict[str, T.DataType]) -> DataFrame:
    return parts.select(*fold.KEYS, *[_to_text(n, t).alias(n) for n, t in types.items()])


def from_text(rows: DataFrame, types: dict[str, T.DataType]) -> DataFrame:
    kept = [c for c in rows.columns if c not in types]
    return rows.select(*kept, *[_from_text(n, t).alias(n) for n, t in types.items()])


def kinds_of() -> tuple[dict[str, str], dict[str, str]]:
    """How each contact fold and each connection fold comes together as text: the greater of ``0`` and ``1`` is their OR."""
    plain = [{n: "max" if kind == "or" else kind for n, (_, kind) in folds.items()}
             for folds in (fold.contact_folds(), fold.leg_folds())]
    return plain[0], plain[1]


def combined_in_tasks(texts: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Rows of one contact and connection as one, within each Arrow batch; nothing moves and nothing is held."""
    keys = list(fold.KEYS)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                grouped = pa.Table.from_batches([batch]).group_by(keys).aggregate(list(kinds.items()))
                columns = [grouped.column(n if n in keys else f"{n}_{kinds[n]}") for n in batch.schema.names]
                yield from pa.Table.from_arrays(columns, batch.schema.names).to_batches()

    return texts.mapInArrow(run, texts.schema)


def packed(texts: DataFrame, names: list[str]) -> DataFrame:
    """Each row as ``contactId`` and a JSON array of its ``names``.

    Spark hands the rows of a contact to Python, and takes them back, in Arrow
    batches of their own, whose cost goes by the number of columns.
    """
    return texts.select("contactId", F.to_json(F.array(*[F.col(n).cast("string") for n in names])).alias("part"))


def unpacked(rows: DataFrame, column: str, names: list[str]) -> DataFrame:
    """The inverse of ``packed``: the members of the array as columns of text in its place."""
    rest = [c for c in rows.columns if c != column]
    return (rows.withColumn("_members", F.from_json(column, "array<string>"))
            .select(*rest, *[F.get("_members", F.lit(i)).alias(n) for i, n in enumerate(names)]))


def _together(kind: str, a, b):
    if a is None or b is None:
        return b if a is None else a
    return int(a) + int(b) if kind == "sum" else min(a, b) if kind == "min" else max(a, b)


class ContactState(StatefulProcessor):
    """Folds the parts of a contact's events into its state; emits them when the contact is complete."""

    def __init__(self, contact: dict[str, str], legs: dict[str, str], limit: int, lag: int):
        self.names, self.contact_kinds, self.leg_kinds = list(contact), list(contact.values()), list(legs.values())
        self.limit, self.lag = limit, lag

    def init(self, handle) -> None:
        self.handle = handle
        self.contact = handle.getValueState("contact", "folds string, due long")
        self.legs = handle.getMapState("legs", "connId string", "folds string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        # Every call on the state is a message to the JVM and back, so none is made whose answer is known:
        # a contact that is not held has no connections, and one that is due already need not be held.
        held = self.contact.get()
        folds, due = (json.loads(held[0]), held[1]) if held else ([None] * len(self.contact_kinds), None)
        touched = {}
        for row in rows:
            conn, *values = json.loads(row["part"])
            leg = touched.get(conn)
            if leg is None:
                old = self.legs.getValue((conn,)) if held else None
                leg = touched[conn] = json.loads(old[0]) if old else [None] * len(self.leg_kinds)
            self.merge(folds, self.contact_kinds, values)
            self.merge(leg, self.leg_kinds, values[len(folds):])
        contact = dict(zip(self.names, folds))
        reason = self.reason(contact)
        # What only reported terminal events goes without a record once it is as old.
        now_due = self.micros(contact["c_start"] or contact["c_last"]) // 1000 + 1000 * (self.limit + self.lag) + 1
        # A timer fires once its time lies before that of the micro-batch, also in the one that set it.
        if reason or now_due < timerValues.getCurrentProcessingTimeInMs():
            if contact["c_start"] is not None:
                yield from self.emitted(folds, (self.held_legs() if held else {}) | touched, reason or "abandoned", key[0])
            if held:
                self.handle.deleteTimer(due)
                self.legs.clear()
                self.contact.clear()
            return
        for conn, leg in touched.items():
            self.legs.updateValue((conn,), (json.dumps(leg),))
        if now_due != due:
            if due is not None:
                self.handle.deleteTimer(due)
            self.handle.registerTimer(now_due)
        self.contact.update((json.dumps(folds), now_due))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = self.contact.get()
        if held is None:
            return
        folds = json.loads(held[0])
        if folds[self.names.index("c_start")] is not None:
            yield from self.emitted(folds, self.held_legs(), "abandoned", key[0])
        self.legs.clear()
        self.contact.clear()

    @staticmethod
    def merge(into: list, kinds: list[str], values: list) -> None:
        for i, kind in enumerate(kinds):
            if values[i] is not None:
                into[i] = _together(kind, into[i], values[i])

    def held_legs(self) -> dict[str, list]:
        return {conn[0]: json.loads(leg[0]) for conn, leg in self.legs.iterator()}

    @staticmethod
    def micros(text: str) -> int:
        return int(text[:TIME_WIDTH]) - TIME_BASE

    def reason(self, contact: dict) -> str | None:
        """Why the contact is complete whatever the clock says, or None; the rule of the batch job."""
        if contact["c_start"] is None:
            return None
        if contact["c_error"]:
            return "error"
        order = TIME_WIDTH + ID_WIDTH
        if contact["c_ended"] and (contact["c_destroyed"] or "") > contact["c_ended"][:order]:
            return "destroyed"
        if self.micros(contact["c_last"]) > self.micros(contact["c_start"]) + 1_000_000 * self.limit:
            return "abandoned"
        return None

    @staticmethod
    def emitted(folds: list, legs: dict[str, list], reason: str, contact_id: str) -> Iterator[Row]:
        for conn, leg in legs.items():
            yield Row(part=json.dumps([contact_id, conn, *folds, *leg, reason]))

    def close(self) -> None:
        pass


def completed(events: DataFrame, prefixes: DataFrame | None, types: dict[str, T.DataType], limit: int, lag: int) -> DataFrame:
    """A stream of the parts, as text, of the contacts that become complete, with why they are; ``completed_parts`` reads it."""
    contact, legs = kinds_of()
    texts = as_text(fold.single_parts(events, prefixes), types)
    given = packed(combined_in_tasks(texts, contact | legs), ["connId", *contact, *legs])
    return given.groupBy("contactId").transformWithState(
        ContactState(contact, legs, limit, lag), "part string", "append", "processingTime")


def completed_parts(batch: DataFrame, types: dict[str, T.DataType]) -> DataFrame:
    """The parts in a batch of ``completed``."""
    contact, legs = kinds_of()
    return from_text(unpacked(batch, "part", [*fold.KEYS, *contact, *legs, "completion"]), types)


def pending_parts(spark, checkpoint: str, types: dict[str, T.DataType]) -> DataFrame:
    """The parts of the contacts that the state under ``checkpoint`` holds after its last finished micro-batch."""
    def read(name: str) -> DataFrame:
        return spark.read.format("statestore").option("path", checkpoint).option("stateVarName", name).load()

    contact, legs = kinds_of()
    contacts = read("contact").select("key.contactId", F.col("value.folds").alias("folds"))
    connections = read("legs").select("key.contactId", "user_map_key.connId", F.col("user_map_value.folds").alias("folds"))
    return from_text(unpacked(connections, "folds", list(legs)).join(unpacked(contacts, "folds", list(contact)), "contactId"), types)
