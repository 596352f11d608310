"""Fold call events into one record per contact.

Every field of a record is a least, a greatest or an OR over its events, keyed
by the order ``(ts, event_id)``. Such folds can be cut anywhere: parts of any
events combine into what one fold over all of them gives, and a contact that is
reopened comes out as several records, each carrying the order its values were
seen in, which merge the same way. The batch job, the streaming job and the
merge below share these definitions. A part has a row per connection whatever
the number of events; the history of a connection is rows of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions.time import iso_micros
from tallyline.operators.dialing import country_of, dialled_number, digits

# The events a contact can report.
EVENT_TYPES = ["Refresh", "Incoming", "Pending", "Connecting", "Accepted", "Missed", "Connected", "ACW", "Ended",
               "Destroyed"]
TERMINAL_TYPES = ["Ended", "Destroyed"]
STAGES = ["connecting", "connected", "ended", "error"]
LEG_STATES = ["connecting", "connected", "disconnected"]

PENDING_LIMIT_SECONDS = 86_400

KEYS = ("contactId", "connId")
ORDER = ("ts", "event_id")


def merges(event_type: Column | None = None) -> Column:
    """Terminal events trigger evaluation only; their data is not merged."""
    return ~(F.col("event_type") if event_type is None else event_type).isin(TERMINAL_TYPES)


def known_events(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_type").isin(EVENT_TYPES) & F.col("contactId").isNotNull()
                         & (F.col("contactId") != ""))


def _ordered(value: Column) -> Column:
    return F.struct(*ORDER, value.alias("value"))


# How the values of a fold come together.
TOGETHER = {"min": F.min, "max": F.max, "or": F.bool_or, "sum": F.sum}


def _first(value: Column, when: Column) -> tuple[Column, str]:
    return F.when(when, _ordered(value)), "min"


def _last(value: Column, when: Column) -> tuple[Column, str]:
    return F.when(when, _ordered(value)), "max"


def _filled(name: str) -> Column:
    return F.col(name).isNotNull() & (F.col(name) != "")


def contact_folds() -> dict[str, tuple[Column, str]]:
    """Contact-level folds: what one event adds, and how that comes together with what others add."""
    snapshot = F.struct("attributes", "queue", "third_party")
    return {
        "c_type": _first(F.col("contact_type"), merges() & _filled("contact_type")),
        "c_initial": _first(F.col("initialConnectionId"), merges() & _filled("initialConnectionId")),
        "c_start": (F.when(merges(), F.col("ts")), "min"),
        "c_inbound": (F.when(merges(), F.col("inbound")), "or"),
        **{f"c_{stage}": _first(snapshot, merges() & (F.col("status") == stage)) for stage in STAGES},
        "c_destroyed": (F.when(F.col("event_type") == "Destroyed", F.struct(*ORDER)), "max"),
        "c_last": (F.col("ts"), "max"),
    }


def leg_folds() -> dict[str, tuple[Column, str]]:
    """Connection-level folds, likewise."""
    # An agent leg is dialled at the extension, but only a readable extension replaces the endpoint's number.
    reached = (F.col("conn_type") == "agent") & digits(F.col("extension")).isNotNull()
    phone = F.when(reached, F.col("extension")).otherwise(F.col("phone_number")).alias("phone")
    state = F.struct("conn_type", "active", "conn_state", phone)
    agent = F.struct("extension", "soft_phone_enabled")
    has_agent = F.col("extension").isNotNull() | F.col("soft_phone_enabled").isNotNull()
    return {
        **{f"l_{s}": (F.when(merges() & (F.col("conn_state") == s), F.col("ts")), "min") for s in LEG_STATES},
        "l_first": _first(F.struct("conn_state", "active"), merges()),
        "l_last": _last(state, merges()),
        "l_agent": _last(agent, merges() & has_agent),
        "l_country": _last(F.col("country"), merges() & F.col("country").isNotNull()),
        "l_events": (merges().cast("bigint"), "sum"),
    }


def _together(folds: dict[str, tuple[Column, str]]) -> list[Column]:
    return [TOGETHER[kind](value).alias(n) for n, (value, kind) in folds.items()]


def single_parts(events: DataFrame, prefixes: DataFrame | None = None, small: bool | None = None) -> DataFrame:
    """What each event alone comes to: a part per event, in the form that ``combine_parts`` goes on with."""
    folds = contact_folds() | leg_folds()
    return known_events(events).transform(with_country, prefixes, small).select(
        *KEYS, *[value.alias(n) for n, (value, _) in folds.items()])


def fold_parts(events: DataFrame, prefixes: DataFrame | None = None, small: bool | None = None) -> DataFrame:
    """All folds, one row per contact and connection, in the form that ``combine_parts`` goes on with."""
    return (known_events(events).transform(with_country, prefixes, small)
            .groupBy(*KEYS).agg(*_together(contact_folds() | leg_folds())))


def combine_parts(parts: DataFrame) -> DataFrame:
    """The parts of different events as one."""
    folds = contact_folds() | leg_folds()
    return parts.groupBy(*KEYS).agg(*[TOGETHER[kind](n).alias(n) for n, (_, kind) in folds.items()])


def decide(parts: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Parts with ``completion``, why their contact is complete, or NULL.

    Of contacts that reported nothing but terminal events, those past the
    time limit go. A window over parts has a row per connection, not per event.
    """
    of = Window.partitionBy("contactId")
    contact = contact_folds()
    rest = [c for c in parts.columns if c not in contact]
    whole = parts.select(*rest, *[TOGETHER[kind](n).over(of).alias(n) for n, (_, kind) in contact.items()])
    opened = F.col("c_start").isNotNull()
    stale = F.lit(False) if as_of is None else as_of > F.col("c_last") + _limit()
    return whole.withColumn("completion", F.when(opened, _completion(as_of))).filter(opened | ~stale)


def _limit() -> Column:
    return F.expr(f"INTERVAL {PENDING_LIMIT_SECONDS} SECONDS")


def with_country(events: DataFrame, prefixes: DataFrame | None, small: bool | None = None) -> DataFrame:
    """Add the country each event's leg was dialled in; NULL without a prefix table."""
    if prefixes is None:
        return events.withColumn("country", F.lit(None).cast("string"))
    number = dialled_number(F.col("conn_type"), F.col("extension"), F.col("phone_number"))
    return country_of(events.withColumn("_dialled", number), "_dialled", prefixes, small=small).drop("_dialled")


def _completion(as_of: Column | None) -> Column:
    """Why a record is complete, or NULL while it is pending."""
    aged = F.col("c_last") > F.col("c_start") + _limit()
    if as_of is not None:
        aged = aged | (as_of > F.col("c_start") + _limit())
    ended = F.struct("c_ended.ts", "c_ended.event_id")
    return (F.when(F.col("c_error").isNotNull(), "error")
            .when(F.col("c_ended").isNotNull() & (F.col("c_destroyed") > ended), "destroyed")
            .when(aged, "abandoned"))


def fold_contacts(events: DataFrame, as_of: Column | None = None) -> DataFrame:
    """One flat row per contact, over all of its events.

    A contact that only ever reported terminal events has no record.
    """
    folded = known_events(events).groupBy("contactId").agg(*_together(contact_folds())).filter(F.col("c_start").isNotNull())
    completion = _completion(as_of)
    stages = [column.alias(name) for stage in STAGES for name, column in {
        f"{stage}_at": iso_micros(f"c_{stage}.ts"),
        f"{stage}_attributes": F.col(f"c_{stage}.value.attributes"),
        f"{stage}_queue": F.col(f"c_{stage}.value.queue"),
        f"{stage}_third_party": F.array_join(f"c_{stage}.value.third_party", ","),
    }.items()]
    return folded.select(
        "contactId", F.col("c_type.value").alias("type"), F.col("c_inbound").alias("inbound"),
        F.col("c_initial.value").alias("initialConnectionId"), iso_micros("c_start").alias("initialTimestamp"),
        *stages, completion.alias("completion"),
        F.when(completion.isNull(), "pending").otherwise("complete").alias("record_status"))


def fold_connections(events: DataFrame, prefixes: DataFrame | None = None) -> DataFrame:
    """One flat row per contact and connection."""
    folded = (known_events(events).filter(merges()).transform(with_country, prefixes)
              .groupBy(*KEYS).agg(*_together(leg_folds())))
    return folded.select(
        "contactId", "connId", *[iso_micros(f"l_{s}").alias(f"{s}Timestamp") for s in LEG_STATES],
        F.col("l_last.value.conn_type").alias("type"), F.col("l_last.value.active").alias("active"),
        iso_micros("l_last.ts").alias("lastUpdate"), F.col("l_last.value.conn_state").alias("status"),
        F.col("l_last.value.phone").alias("phoneNumber"), F.col("l_agent.value.extension").alias("extension"),
        F.col("l_agent.value.soft_phone_enabled").alias("softPhoneEnabled"),
        F.col("l_country.value").alias("endpointCountryISO"), F.col("l_events").alias("entries"))


def history(events: DataFrame) -> DataFrame:
    """Connection history, one row per entry; no grouping, so its size does not matter."""
    return known_events(events).filter(merges()).select(
        "contactId", "connId", F.col("event_id").alias("sequence"), iso_micros("ts").alias("timestamp"),
        F.col("conn_state").alias("status"), "active")


# Entries of a history page.
HISTORY_PAGE = 1000


def history_pages(events: DataFrame, size: int = HISTORY_PAGE) -> DataFrame:
    """Connection history in pages: ``contactId, connId, page, entries``, of at most ``size`` entries, in order.

    Entries are sorted over all tasks, so a connection with most of them is cut
    into pages by many; a page is grouped by where it lies in its task. Only
    pages are numbered by connection, from 0.
    """
    order = ["contactId", "connId", "ts", "event_id"]
    rows = known_events(events).filter(merges()).select(
        *order, iso_micros("ts").alias("timestamp"), F.col("conn_state").alias("status"), "active")
    # The number of a row within its task: the sort makes it the same on every attempt.
    block = F.floor(F.monotonically_increasing_id() / F.lit(size))
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_block", block)
    entry = F.struct("ts", F.col("event_id").alias("sequence"), F.col("active").cast("string").alias("active"), "status", "timestamp")
    pages = placed.groupBy(*KEYS, "_block").agg(F.sort_array(F.collect_list(entry)).alias("sorted"))
    number = F.row_number().over(Window.partitionBy(*KEYS).orderBy(F.col("sorted")[0]["ts"], F.col("sorted")[0]["sequence"], "_block")) - 1
    return pages.withColumn("page", number).select(*KEYS, "page", F.transform("sorted", lambda e: F.struct(
        e["active"].alias("active"), e["status"].alias("status"), e["timestamp"].alias("timestamp"),
        e["sequence"].alias("sequence"))).alias("entries"))


def page_records(pages: DataFrame) -> DataFrame:
    """Pages as partial records: a record per page, with one connection that holds it as its history.

    Records of a contact merge, so a table of these beside the contact records
    gives each connection its whole history, and no array outgrows a page.
    """
    connection = F.struct(F.col("connId").alias("id"), F.col("entries").alias("history"))
    return pages.select("contactId", F.array(connection).alias("connections"))


def history_of(records: DataFrame) -> DataFrame:
    """``history`` from stored ``page_records``."""
    legs = records.select("contactId", F.explode("connections").alias("c"))
    entries = legs.select("contactId", F.col("c.id").alias("connId"), F.explode("c.history").alias("e"))
    return entries.select("contactId", "connId", F.col("e.sequence").alias("sequence"), F.col("e.timestamp").alias("timestamp"),
                          F.col("e.status").alias("status"), F.col("e.active").cast("boolean").alias("active"))


def _seen(order: str) -> Column:
    return F.when(F.col(order).isNotNull(), F.struct(
        iso_micros(f"{order}.ts").alias("timestamp"), F.col(f"{order}.event_id").alias("sequence")))


def contact_records(events: DataFrame, prefixes: DataFrame | None = None, as_of: Column | None = None) -> DataFrame:
    """Nested contact records, in the shape the call-connection table is read with: one per contact.

    A connection carries its first history entry and the number of entries;
    the whole history is rows (``history``) or pages (``history_pages``).
    """
    return records_of(fold_parts(events, prefixes), as_of)


def records_of(parts: DataFrame, as_of: Column | None = None) -> DataFrame:
    """The records of parts; their completion is what ``decide`` found, or that of all the parts together."""
    contact = contact_folds()
    completion = [F.max("completion").alias("completion")] if "completion" in parts.columns else []
    connection = F.struct(
        F.col("connId").alias("id"),
        *[iso_micros(f"l_{s}").alias(f"{s}Timestamp") for s in LEG_STATES],
        F.when(F.col("l_agent").isNotNull(), F.struct(
            F.col("l_agent.value.soft_phone_enabled").alias("softPhoneEnabled"),
            F.col("l_agent.value.extension").alias("extension"))).alias("agentStatus"),
        F.col("l_last.value.active").cast("string").alias("active"),
        F.struct(F.col("l_last.value.phone").alias("phoneNumber")).alias("endpoint"),
        F.col("l_country.value").alias("endpointCountryISO"),
        F.array(F.struct(
            F.col("l_first.value.active").cast("string").alias("active"),
            F.col("l_first.value.conn_state").alias("status"), iso_micros("l_first.ts").alias("timestamp"),
            F.col("l_first.event_id").alias("sequence"))).alias("history"),
        iso_micros("l_last.ts").alias("lastUpdate"),
        F.col("l_last.value.conn_state").alias("status"),
        F.col("l_last.value.conn_type").alias("type"),
        F.col("l_last.event_id").alias("sequence"),
        _seen("l_agent").alias("agentSeen"), _seen("l_country").alias("countrySeen"),
        F.col("l_events").alias("entries"))
    records = parts.groupBy("contactId").agg(
        *[TOGETHER[kind](n).alias(n) for n, (_, kind) in contact.items()],
        *completion,
        F.sort_array(F.collect_list(F.when(F.col("l_events") > 0, connection))).alias("connections"),
    ).filter(F.col("c_start").isNotNull())
    if not completion:
        records = records.withColumn("completion", _completion(as_of))
    stages = [F.when(F.col(f"c_{stage}").isNotNull(), F.struct(
        F.col(f"c_{stage}.value.attributes").alias("attributes"),
        F.struct(F.col(f"c_{stage}.value.queue").alias("name")).alias("queue"),
        F.col(f"c_{stage}.value.third_party").alias("thirdPartyConnections"),
        iso_micros(f"c_{stage}.ts").alias("timestamp"), F.lit(stage).alias("type"),
        F.col(f"c_{stage}.event_id").alias("sequence"))).alias(stage_name(stage)) for stage in STAGES]
    return records.select(
        "contactId", F.col("c_inbound").alias("inbound"), F.col("c_initial.value").alias("initialConnectionId"),
        iso_micros("c_start").alias("initialTimestamp"), F.col("c_type.value").alias("type"), "connections", *stages,
        "completion", F.struct(
            _seen("c_type").alias("type"), _seen("c_initial").alias("initialConnectionId"),
            _seen("c_destroyed").alias("destroyed")).alias("seen"))


def stage_name(stage: str) -> str:
    """Column that holds a stage's snapshot."""
    return "stage" + stage.capitalize()


# Merging partial records. -------------------------------------------------

_SEEN = "struct<timestamp:string, sequence:bigint>"
_STAGE = ("struct<attributes:string, queue:struct<name:string>, thirdPartyConnections:array<string>, "
          "timestamp:string, type:string, sequence:bigint>")

RECORD = f"""
contactId string, inbound boolean, initialConnectionId string, initialTimestamp string, type string,
connections array<struct<id:string, connectingTimestamp:string, connectedTimestamp:string,
  disconnectedTimestamp:string, agentStatus:struct<softPhoneEnabled:boolean, extension:string>, active:string,
  endpoint:struct<phoneNumber:string>, endpointCountryISO:string,
  history:array<struct<active:string, status:string, timestamp:string, sequence:bigint>>, lastUpdate:string,
  status:string, type:string, sequence:bigint, agentSeen:{_SEEN}, countrySeen:{_SEEN}, entries:bigint>>,
stageConnecting {_STAGE}, stageConnected {_STAGE}, stageEnded {_STAGE}, stageError {_STAGE},
completion string, seen struct<type:{_SEEN}, initialConnectionId:{_SEEN}, destroyed:{_SEEN}>
"""


def merge_contacts(records: DataFrame) -> DataFrame:
    """The contact-level part of ``fold_contacts`` from partial records."""
    merged = records.groupBy("contactId").agg(
        F.min_by("type", "seen.type").alias("type"), F.bool_or("inbound").alias("inbound"),
        F.min_by("initialConnectionId", "seen.initialConnectionId").alias("initialConnectionId"),
        F.min("initialTimestamp").alias("initialTimestamp"),
        *[F.min(F.when(F.col(name).isNotNull(), F.struct(
            f"{name}.timestamp", f"{name}.sequence", f"{name}.attributes", f"{name}.queue",
            f"{name}.thirdPartyConnections"))).alias(f"c_{stage}")
          for stage in STAGES for name in [stage_name(stage)]])
    stages = [column.alias(name) for stage in STAGES for name, column in {
        f"{stage}_at": F.col(f"c_{stage}.timestamp"),
        f"{stage}_attributes": F.col(f"c_{stage}.attributes"),
        f"{stage}_queue": F.col(f"c_{stage}.queue.name"),
        f"{stage}_third_party": F.array_join(f"c_{stage}.thirdPartyConnections", ","),
    }.items()]
    return merged.select("contactId", "type", "inbound", "initialConnectionId", "initialTimestamp", *stages)


def merge_connections(records: DataFrame) -> DataFrame:
    """``fold_connections`` from partial records."""
    c = F.col("c")
    last = F.struct(c["lastUpdate"], c["sequence"])
    return records.select("contactId", F.explode("connections").alias("c")).groupBy(
        "contactId", c["id"].alias("connId")).agg(
        *[F.min(c[f"{s}Timestamp"]).alias(f"{s}Timestamp") for s in LEG_STATES],
        F.max_by(c["type"], last).alias("type"), F.max_by(c["active"], last).cast("boolean").alias("active"),
        F.max(c["lastUpdate"]).alias("lastUpdate"), F.max_by(c["status"], last).alias("status"),
        F.max_by(c["endpoint"]["phoneNumber"], last).alias("phoneNumber"),
        F.max_by(c["agentStatus"]["extension"], c["agentSeen"]).alias("extension"),
        F.max_by(c["agentStatus"]["softPhoneEnabled"], c["agentSeen"]).alias("softPhoneEnabled"),
        F.max_by(c["endpointCountryISO"], c["countrySeen"]).alias("endpointCountryISO"),
        F.sum(c["entries"]).alias("entries"))

