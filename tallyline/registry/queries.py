"""Every inventory item as a named query over the given tables."""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions import text, time
from tallyline.functions.metrics import connection_metrics, contact_metrics
from tallyline.operators import contact_fold as fold
from tallyline.operators import dialing, ingest, legs, messages
from tallyline.operators.latest import latest_by_key
from tallyline.plans import reports
from tallyline.registry import fixtures as fx
from tallyline.session import configure, scratch
from tallyline.sources import landing, schemas, sinks

Query = Callable[[SparkSession, str], DataFrame]


def flag(condition: Column) -> Column:
    return condition.cast("int")


# Sources and sinks. -----------------------------------------------------------

def contact_table(spark: SparkSession, sf: str) -> DataFrame:
    return flat_contacts(landing.contact_records(spark, fx.landed_contacts(spark, sf)))


def flat_contacts(df: DataFrame) -> DataFrame:
    names = {
        "account": "AWSAccountId", "format_version": "AWSContactTraceRecordFormatVersion", "agent": "Agent.ARN",
        "work_seconds": "Agent.AfterContactWorkDuration", "agent_connected": "Agent.ConnectedToAgentTimestamp",
        "holds": "Agent.NumberOfHolds", "profile": "Agent.RoutingProfile.ARN",
        "profile_name": "Agent.RoutingProfile.Name", "username": "Agent.Username",
        "attempts": "AgentConnectionAttempts", "attributes": "Attributes", "channel": "Channel",
        "system_connected": "ConnectedToSystemTimestamp", "contact_id": "ContactId",
        "customer_address": "CustomerEndpoint.Address", "disconnected": "DisconnectTimestamp",
        "initial_contact_id": "InitialContactId", "method": "InitiationMethod", "initiated": "InitiationTimestamp",
        "instance": "InstanceARN", "last_update": "LastUpstringTimestamp", "next_contact_id": "NextContactId",
        "queue_arn": "Queue.ARN", "queue_seconds": "Queue.Duration", "queue": "Queue.Name",
        "recordings": "Recordings", "system_address": "SystemEndpoint.Address",
        "transferred": "TransferCompletedTimestamp", "transferred_to": "TransferredToEndpoint",
    }
    return df.select(*[F.col(path).alias(name) for name, path in names.items()],
                     F.array_join("MediaStreams.Type", ",").alias("media"))


def connection_table(spark: SparkSession, sf: str) -> DataFrame:
    """A row per connection, and one for a record without any; the stages as text."""
    def stage(name: str) -> Column:
        of = F.col(name)
        fields = [of["attributes"], of["queue"]["name"], F.array_join(of["thirdPartyConnections"], ","), of["timestamp"], of["type"]]
        return F.when(of.isNotNull(), F.concat_ws("|", *[F.coalesce(f, F.lit("-")) for f in fields]))

    df = landing.call_connections(spark, fx.landed_connections(spark, sf))
    leg, at = F.col("leg"), F.col("pos")
    return df.select("*", F.posexplode_outer("connections").alias("pos", "leg")).select(
        "contactId", "inbound", "initialConnectionId", "initialTimestamp", "type",
        F.coalesce(F.size("connections"), F.lit(-1)).alias("legs"), at.cast("int").alias("at"),
        leg["id"].alias("leg_id"), leg["type"].alias("leg_type"), leg["status"].alias("status"), leg["lastUpdate"].alias("updated"),
        leg["connectingTimestamp"].alias("connecting"), leg["connectedTimestamp"].alias("connected"),
        leg["disconnectedTimestamp"].alias("disconnected"),
        flag(leg["agentStatus"]["softPhoneEnabled"]).alias("softphone"),
        leg["agentStatus"]["extension"].alias("extension"), leg["endpoint"]["phoneNumber"].alias("number"),
        leg["endpointCountryISO"].alias("country"), F.array_join(leg["history"]["status"], ",").alias("history"),
        *[stage(name).alias(name) for name in ("stageConnecting", "stageConnected", "stageEnded", "stageError")])


def agent_event_table(spark: SparkSession, sf: str) -> DataFrame:
    df = landing.agent_events(spark, fx.landed_agent_events(spark, sf))
    now, then = F.col("CurrentAgentSnapshot"), F.col("PreviousAgentSnapshot")
    profile = now["Configuration"]["RoutingProfile"]
    return df.select(
        "AWSAccountId", "AgentARN", "EventId", "EventTimestamp", "EventType", "InstanceARN", "Version",
        now["AgentStatus"]["Name"].alias("status"), now["AgentStatus"]["StartTimestamp"].alias("status_since"),
        now["Configuration"]["AgentHierarchyGroups"].alias("groups"),
        now["Configuration"]["Username"].alias("username"), profile["ARN"].alias("profile"),
        F.array_join(F.transform(profile["Concurrency"], lambda c: F.concat_ws(
            ":", c["Channel"], c["AvailableSlots"], c["MaximumSlots"])), ",").alias("slots"),
        F.array_join(profile["InboundQueues"]["Name"], ",").alias("inbound_queues"),
        F.array_join(F.flatten(profile["InboundQueues"]["Channels"]), ",").alias("channels"),
        F.array_join(now["Contacts"], ",").alias("contact_json"),
        then["AgentStatus"]["Name"].alias("previous_status"),
        F.array_join(then["Configuration"]["AgentHierarchyGroups"], ",").alias("previous_groups"),
        F.array_join(then["Contacts"]["State"], ",").alias("previous_state"),
        F.array_join(then["Contacts"]["Queue"]["Name"], ",").alias("previous_queue"))


CHAT_COLUMNS = ["instanceId", "contactId", "system_msg", "customer_msg", "agent_msg", "total_msg"]


def chat_usage_table(spark: SparkSession, sf: str) -> DataFrame:
    def build(path: str) -> None:
        documents = landing.transcripts(spark, fx.landed_transcripts(spark, sf))
        sinks.write_chat_usage(messages.count_messages(documents), path)
    return landing.chat_usage(spark, fx.landed(spark, sf, "chat_usage", build)).select(*CHAT_COLUMNS)


def transcript_documents(spark: SparkSession, sf: str) -> DataFrame:
    return landing.transcripts(spark, fx.landed_transcripts(spark, sf)).select(
        "ContactId", "InstanceId", F.size("Transcript").alias("items"),
        F.array_join("Transcript.Type", ",").alias("types"),
        F.array_join("Transcript.ParticipantRole", ",").alias("roles"))


def new_transcripts(spark: SparkSession, sf: str) -> DataFrame:
    return fx.streamed_chat_usage(spark, sf).select(*CHAT_COLUMNS)


def notified_transcripts(spark: SparkSession, sf: str) -> DataFrame:
    return fx.notified_chat_usage(spark, sf).select(*CHAT_COLUMNS)


def agent_event_feed(spark: SparkSession, sf: str) -> DataFrame:
    lines = fx.run_together(fx.agent_events(spark, sf), "EventId")
    feed, _ = fx.streamed_feed(spark, sf, "agents", lines, schemas.AGENT_EVENT, "parquet")
    return feed.select("EventId", "EventTimestamp", "EventType", "AgentARN")


def mixed_spelling(spark: SparkSession, sf: str) -> DataFrame:
    leaves = ["endpointCountryISO", "softphoneEnabled"]
    df = landing.call_connections(spark, fx.landed_mixed_spelling(spark, sf), legs.record_fields(leaves), any_spelling=True)
    return df.transform(legs.flatten_legs, leaves).select(
        "contact_id", "conn_id", "endpointCountryISO", flag(F.col("softphoneEnabled")).alias("softphone"))


def contact_append(spark: SparkSession, sf: str) -> DataFrame:
    lines = fx.run_together(fx.contact_objects(spark, sf), "ContactId")
    feed, _ = fx.streamed_feed(spark, sf, "contacts", lines, schemas.CONTACT, "json")
    return feed.select("ContactId", "Channel", "InitiationTimestamp", "DisconnectTimestamp")


def chat_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """The stream's table after every transcript was written and counted a second time."""
    return fx.rewritten_chat_usage(spark, sf).select(*CHAT_COLUMNS)


def chat_merge(spark: SparkSession, sf: str) -> DataFrame:
    """The same where the stream merges each batch into a keyed table."""
    return fx.merged_chat_usage(spark, sf).select(*CHAT_COLUMNS)


def dead_letters(spark: SparkSession, sf: str) -> DataFrame:
    def build(path: str) -> None:
        _, rejects = ingest.repair(fx.landed_wire(spark, sf), schemas.CONTACT)
        sinks.write_dead_letters(rejects, path)
    return spark.read.text(fx.landed(spark, sf, "rejects", build)).groupBy("value").agg(F.count("*").alias("lines"))


def published_view(spark: SparkSession, sf: str) -> DataFrame:
    name = sinks.publish_view(contact_usage(spark, sf), "contact_usage_report")
    return spark.sql(f"""SELECT channel, Call_Initiation_Method AS method, count(*) AS contacts,
        sum(Connect_Service_Seconds_Rounded) AS service_seconds FROM {name} GROUP BY 1, 2""")


# Ingest. ------------------------------------------------------------------------

WIRE = "ContactId string, Channel string, InitiationTimestamp string, Attributes string"


def split_lines(spark: SparkSession, sf: str) -> DataFrame:
    records, _ = ingest.repair(fx.landed_wire(spark, sf), WIRE)
    return records


def line_status(spark: SparkSession, sf: str) -> DataFrame:
    lines = fx.landed_wire(spark, sf)
    return lines.transform(ingest.split_records).transform(ingest.parse_records, WIRE).transform(ingest.status_counts)


SUBMITTED = "contactId string, inbound string, type string"


def submissions(spark: SparkSession, sf: str) -> DataFrame:
    checked = fx.envelopes(spark, sf).transform(ingest.check_envelope)
    return (checked.select("data").transform(ingest.unwrap_batch, SUBMITTED).transform(ingest.accepted))


def streamed_submissions(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(fx.streamed_submissions(spark, sf, SUBMITTED)["record"]).select("contactId", "inbound", "type")


def submission_sinks(spark: SparkSession, sf: str) -> DataFrame:
    """How many rows each sink of the submission stream holds."""
    folders = fx.streamed_submissions(spark, sf, SUBMITTED)
    counts = [(spark.read.parquet(path) if sink == "record" else spark.read.text(path)).agg(F.count("*").alias("rows"))
              .select(F.lit(sink).alias("sink"), "rows") for sink, path in folders.items()]
    return counts[0].union(counts[1]).union(counts[2])


def decoded_keys(spark: SparkSession, sf: str) -> DataFrame:
    keys = fx.contacts(spark, sf).select(
        "ContactId", F.concat(F.lit("transcripts/2020+01/"), "ContactId", F.lit("%3Apart%20caf%C3%A9.json")).alias("key"))
    return ingest.decode_keys(keys)


def envelope_check(spark: SparkSession, sf: str) -> DataFrame:
    return fx.envelopes(spark, sf).transform(ingest.check_envelope).select(
        "key", flag(F.col("valid")).alias("valid"), flag(F.col("data").isNotNull()).alias("has_data"))


# Reports. --------------------------------------------------------------------------

def contact_usage(spark: SparkSession, sf: str) -> DataFrame:
    return reports.contact_usage(fx.contacts(spark, sf))


def connection_usage(spark: SparkSession, sf: str) -> DataFrame:
    return reports.connection_usage(fx.contacts(spark, sf), fx.connections(spark, sf))


def chat_report(spark: SparkSession, sf: str) -> DataFrame:
    chats = messages.count_message_items(fx.transcript_items(spark, sf), "instanceId", "contactId")
    return reports.chat_report(chats, fx.contacts(spark, sf))


def message_counts(spark: SparkSession, sf: str) -> DataFrame:
    return messages.count_messages(fx.transcripts(spark, sf)).select(*CHAT_COLUMNS)


def contact_fold(spark: SparkSession, sf: str) -> DataFrame:
    """One row per contact, from one pass over its events; its connections as text in order of their ids."""
    def shown(c: Column) -> Column:
        fields = [c["id"], *[c[name] for name in LEG_TIMES], c["type"], flag(c["active"].cast("boolean")), c["lastUpdate"],
                  c["status"], c["endpoint"]["phoneNumber"], c["agentStatus"]["extension"],
                  flag(c["agentStatus"]["softPhoneEnabled"]), c["endpointCountryISO"], c["entries"]]
        return F.concat_ws("|", *[F.coalesce(f.cast("string"), F.lit("-")) for f in fields])

    records = fold.contact_records(fx.call_events(spark, sf), fx.dial_prefixes(spark))
    stages = [column.alias(name) for stage in fold.STAGES for held in [F.col(fold.stage_name(stage))]
              for name, column in {
                  f"{stage}_at": held["timestamp"], f"{stage}_attributes": held["attributes"],
                  f"{stage}_queue": held["queue"]["name"],
                  f"{stage}_third_party": F.array_join(held["thirdPartyConnections"], ",")}.items()]
    return records.select(
        "contactId", F.col("type").alias("contact_type"), flag(F.col("inbound")).alias("inbound"), "initialConnectionId",
        "initialTimestamp", *stages, "completion",
        F.when(F.col("completion").isNull(), "pending").otherwise("complete").alias("record_status"),
        F.array_join(F.transform("connections", shown), ";").alias("connections"))


def base(spark: SparkSession, sf: str) -> DataFrame:
    return reports.contact_base(fx.contacts(spark, sf))


def leg_rows(spark: SparkSession, sf: str) -> DataFrame:
    return legs.flatten_legs(fx.connections(spark, sf))


def merged_legs(spark: SparkSession, sf: str) -> DataFrame:
    return legs.merge_legs(leg_rows(spark, sf))


def voice(spark: SparkSession, sf: str, fields: Collection[str] = reports.REPORT_LEG) -> DataFrame:
    return reports.voice_legs(fx.contacts(spark, sf), fx.connections(spark, sf), fields=fields)


def contact_metric(name: str) -> Query:
    return lambda spark, sf: base(spark, sf).select("contact_id", contact_metrics()[name].alias(name))


def connection_metric(name: str, *fields: str) -> Query:
    """A metric of the connection report; ``fields`` is what it reads of a leg beside its id."""
    return lambda spark, sf: voice(spark, sf, fields).select("contact_id", "leg_id", connection_metrics()[name].alias(name))


# Columns come as a function, because none can be built before a session exists.
Columns = Callable[[], list]


def of_base(columns: Columns) -> Query:
    return lambda spark, sf: base(spark, sf).select("contact_id", *columns())


def of_merged(columns: Columns) -> Query:
    return lambda spark, sf: merged_legs(spark, sf).select("contact_id", "conn_id", *columns())


def nested_with(spark: SparkSession, sf: str) -> DataFrame:
    sinks.publish_view(fx.connections(spark, sf), "call_connections")
    return spark.sql("""
        WITH per_contact AS (
          WITH sized AS (SELECT contactId, coalesce(size(connections), 0) AS n FROM call_connections)
          SELECT contactId, sum(n) AS snapshots, count(*) AS records FROM sized GROUP BY contactId)
        SELECT * FROM per_contact WHERE snapshots > 0""")


def customer_leg(spark: SparkSession, sf: str) -> DataFrame:
    leg_id = F.col("leg_id")
    mine = (F.col("contact_id") == leg_id) | (leg_id.isNull() & F.col("initial_contact_id").isNull())
    return voice(spark, sf, ()).select("contact_id", "leg_id", flag(mine).alias("customer_leg"))


def customer_messages(spark: SparkSession, sf: str) -> DataFrame:
    return fx.transcripts(spark, sf).select("ContactId", F.size(F.filter(
        "Transcript", lambda i: (i["Type"] == "MESSAGE") & (i["ParticipantRole"] == "CUSTOMER"))).alias("found"))


def chat_contacts(spark: SparkSession, sf: str) -> DataFrame:
    return chat_report(spark, sf).select("ContactId", "channel", "ChatUsageTotalMsg")


def leg_numbers(spark: SparkSession, sf: str) -> DataFrame:
    number = dialing.dialled_number(F.col("type"), F.col("extension"), F.col("endpoint_number"))
    return merged_legs(spark, sf).select("contact_id", "conn_id", number.alias("number"))


def leg_countries(spark: SparkSession, sf: str) -> DataFrame:
    return dialing.country_of(leg_numbers(spark, sf), "number", fx.dial_prefixes(spark))


def record_counts(spark: SparkSession, sf: str) -> DataFrame:
    return fold.fold_contacts(fx.call_events(spark, sf)).groupBy("record_status").agg(F.count("*").alias("records"))


def sorted_before_join(spark: SparkSession, sf: str) -> DataFrame:
    ordered = merged_legs(spark, sf).orderBy("initialconnecthistorytimestamp")
    return ordered.groupBy("contact_id").agg(
        F.count("*").alias("legs"), F.min("initialconnecthistorytimestamp").alias("first_seen"))


# Call events. ---------------------------------------------------------------------------

def of_contacts(columns: Columns) -> Query:
    return lambda spark, sf: fold.fold_contacts(fx.call_events(spark, sf)).select("contactId", *columns())


def of_connections(columns: Columns) -> Query:
    return lambda spark, sf: fold.fold_connections(fx.call_events(spark, sf), fx.dial_prefixes(spark)).select(
        "contactId", "connId", *columns())


STAGE_COLUMNS = [f"{stage}_{part}" for stage in fold.STAGES for part in ("at", "attributes", "queue", "third_party")]
LEG_TIMES = [f"{state}Timestamp" for state in fold.LEG_STATES]


def last_values() -> list:
    return ["type", flag(F.col("active")).alias("active"), "lastUpdate", "status", "phoneNumber", "extension",
            flag(F.col("softPhoneEnabled")).alias("softPhoneEnabled")]


def streamed_fold(spark: SparkSession, sf: str) -> DataFrame:
    return fold.merge_contacts(fx.streamed_records(spark, sf)).withColumn("inbound", flag(F.col("inbound")))


def event_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return fold.known_events(fx.call_events(spark, sf)).groupBy("event_type").agg(F.count("*").alias("events"))


def terminal_events(spark: SparkSession, sf: str) -> DataFrame:
    return fold.known_events(fx.call_events(spark, sf)).groupBy("contactId").agg(
        F.count_if(fold.merges()).alias("merged"),
        flag(F.bool_or(F.col("event_type") == "Destroyed")).alias("destroyed"))


def nested_connections(spark: SparkSession, sf: str) -> DataFrame:
    records = fold.contact_records(fx.call_events(spark, sf), fx.dial_prefixes(spark))
    return fold.merge_connections(records).select("contactId", "connId", F.col("entries").cast("bigint").alias("entries"))


def history_rows(spark: SparkSession, sf: str) -> DataFrame:
    """From pages that were stored as partial records and read back."""
    def build(path: str) -> None:
        sinks.write_json(fold.page_records(fold.history_pages(fx.call_events(spark, sf), size=3)), path)
    records = spark.read.schema(schemas.struct(fold.RECORD)).json(fx.landed(spark, sf, "history_pages", build))
    return fold.history_of(records).withColumn("active", flag(F.col("active")))


def only_abandoned(spark: SparkSession, sf: str) -> DataFrame:
    """Contacts that reported neither an end nor an error: only the timeout releases them."""
    return fx.streamed_records(spark, sf).groupBy("contactId").agg(
        F.bool_and(F.col("stageEnded").isNull() & F.col("stageError").isNull()).alias("open"),
        F.bool_and(F.col("completion") == "abandoned").alias("abandoned"),
    ).filter("open").select("contactId", flag(F.col("abandoned")).alias("abandoned"))


def last_event(spark: SparkSession, sf: str) -> DataFrame:
    events = fx.call_events(spark, sf).select("contactId", "ts", "event_id", "event_type", "status")
    return latest_by_key(events, ["contactId"], "ts", "event_id").select("contactId", "event_id", "event_type", "status")


def _entries() -> Column:
    """History entries of a record, over its connections."""
    return F.aggregate("connections", F.lit(0).cast("bigint"), lambda n, c: n + c["entries"])


def emitted(spark: SparkSession, sf: str) -> DataFrame:
    records = fx.streamed_records(spark, sf)
    contacts = records.groupBy("contactId").agg(F.sum(_entries()).alias("entries"))
    return contacts.agg(F.count("*").alias("contacts"), F.sum("entries").cast("bigint").alias("entries"))


def recovered(spark: SparkSession, sf: str) -> DataFrame:
    return fx.streamed_records(spark, sf).groupBy("contactId").agg(F.sum(_entries()).alias("entries"))


def exactly_once(spark: SparkSession, sf: str) -> DataFrame:
    return fold.history(fx.streamed_events(spark, sf)).withColumn("active", flag(F.col("active")))


def streamed_pages(spark: SparkSession, sf: str) -> DataFrame:
    return fold.history_of(fx.streamed_history(spark, sf)).withColumn("active", flag(F.col("active")))


def audit_trail(spark: SparkSession, sf: str) -> DataFrame:
    return fx.streamed_events(spark, sf).groupBy("contactId").agg(F.count("*").alias("submitted"))


def reopened(spark: SparkSession, sf: str) -> DataFrame:
    merged = fold.merge_connections(fx.streamed_records(spark, sf))
    return merged.select("contactId", "connId", *LEG_TIMES, *last_values(), "endpointCountryISO",
                         F.col("entries").cast("bigint").alias("entries"))


# Functions. ------------------------------------------------------------------------------

def of_contact_records(columns: Columns) -> Query:
    return lambda spark, sf: fx.contacts(spark, sf).select("ContactId", *columns())


def snapshots(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.unnest(fx.connections(spark, sf), "connections", "leg", ["contactId"])


def history_times(spark: SparkSession, sf: str) -> DataFrame:
    """Timestamps of the history entries of each snapshot, as one text."""
    times = F.transform("leg.history", lambda h: h["timestamp"])
    return snapshots(spark, sf).select(
        "contactId", F.col("leg.id").alias("conn_id"), F.array_join(times, ",", "-").alias("times"))


def least_times(spark: SparkSession, sf: str) -> DataFrame:
    """Least time of each snapshot's history, with NULL entries passed over and with any of them making it NULL."""
    times = F.col("leg.history.timestamp")
    return snapshots(spark, sf).select("contactId", F.col("leg.id").alias("conn_id"), F.array_min(times).alias("least"),
                                       legs.earliest(times).alias("strict"))


def history_entries(spark: SparkSession, sf: str) -> DataFrame:
    entries = snapshots(spark, sf).select("contactId", F.col("leg.id").alias("conn_id"), F.col("leg.history").alias("h"))
    return ingest.unnest(entries, "h", "entry", ["contactId", "conn_id"]).select(
        "contactId", "conn_id", F.col("entry.timestamp").alias("timestamp"), F.col("entry.status").alias("status"))


def phrases(spark: SparkSession, sf: str) -> DataFrame:
    phrase = F.concat_ws(" ", "Queue.Name", F.lit("after_call WORK"), "Channel")
    return fx.contacts(spark, sf).select("ContactId", text.proper_case(phrase).alias("phrase"))


def encoded_documents(spark: SparkSession, sf: str) -> DataFrame:
    coded = text.to_base64("text")
    return configure(spark).read.parquet(f"{sf}/documents.parquet").select(
        "doc_id", F.md5(coded.cast("binary")).alias("coded"), F.length(coded).alias("size"),
        flag(text.from_base64(coded) == F.col("text")).alias("restored"))


def percent_decoded(spark: SparkSession, sf: str) -> DataFrame:
    """Texts as a key would carry them, with a plus sign that is not a space."""
    coded = F.concat(F.replace(F.url_encode("text"), F.lit("+"), F.lit("%20")), F.lit("+"))
    return configure(spark).read.parquet(f"{sf}/documents.parquet").select(
        "doc_id", F.md5(text.percent_decode(coded).cast("binary")).alias("decoded"))


def hooked_feed(spark: SparkSession, sf: str) -> DataFrame:
    """A feed whose lines pass through a hook of the caller before they are taken apart."""
    def rename(lines: DataFrame) -> DataFrame:
        return lines.withColumn("value", F.replace("value", F.lit('"Channel":"VOICE"'), F.lit('"Channel":"PHONE"')))

    feed, _ = fx.streamed_feed(spark, sf, "hooked", fx.wire_lines(spark, sf), WIRE, "parquet", hook=rename)
    return feed.select("ContactId", "Channel")


def json_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    line = F.to_json(F.struct("ContactId", "Queue", "Agent"))
    back = F.from_json(line, "ContactId string, Queue struct<Name string>, Agent struct<NumberOfHolds int>")
    return fx.contacts(spark, sf).select(back.alias("r")).select(
        F.col("r.ContactId").alias("contact_id"), F.col("r.Queue.Name").alias("queue"),
        F.col("r.Agent.NumberOfHolds").alias("holds"))


def text_parts(spark: SparkSession, sf: str) -> DataFrame:
    address = F.col("CustomerEndpoint.Address")
    return fx.contacts(spark, sf).select(
        "ContactId", F.substring(address, 2, 4).alias("area"), F.regexp_replace(address, r"^\+", "00").alias("dialled"),
        F.instr(F.col("InitiationTimestamp"), "T").alias("at"), F.concat("Channel", F.lit("/"), "ContactId").alias("path"))


def connection_ids(spark: SparkSession, sf: str) -> DataFrame:
    ids = F.transform("connections", lambda c: c["id"])
    return fx.connections(spark, sf).filter(F.col("connections").isNotNull()).select(
        "contactId", F.array_join(ids, ",").alias("ids"),
        F.array_position(ids, F.col("contactId")).cast("bigint").alias("own_at"))


def queries() -> dict[str, Query]:
    connected = ("connectedTimestamp", "disconnectedTimestamp")
    customer, third, service, desk = (
        "CustomerCallLength_Telco_inSeconds", "Thirdparty_Telco_inSeconds", "Connect_Service_Seconds",
        "AgentDeskPhone_Telco_inSeconds")
    return {
        "RPT-1": contact_usage,
        "RPT-2": connection_usage,
        "RPT-3": chat_report,
        "RPT-4": message_counts,
        "RPT-5": contact_fold,
        "SRC-1": contact_table,
        "SRC-2": connection_table,
        "SRC-3": agent_event_table,
        "SRC-4": chat_usage_table,
        "SRC-5": transcript_documents,
        "SRC-6": new_transcripts,
        "SRC-6-notified": notified_transcripts,
        "SRC-7": agent_event_feed,
        "SRC-8": mixed_spelling,
        "SNK-1": contact_append,
        "SNK-2": chat_upsert,
        "SNK-2-merge": chat_merge,
        "SNK-3": dead_letters,
        "SNK-4": published_view,
        "ING-1": split_lines,
        "ING-2": line_status,
        "ING-3": submissions,
        "ING-3-stream": streamed_submissions,
        "ING-4": decoded_keys,
        "ING-5": envelope_check,
        "ING-5-stream": submission_sinks,
        "ING-6": lambda spark, sf: ingest.with_contact_id(submissions(spark, sf)).select("contactId"),
        "PRJ-1": of_contact_records(lambda: [
            F.col("Queue.Name").alias("queue"), F.col("SystemEndpoint.Address").alias("system_address"),
            F.col("Agent.RoutingProfile.ARN").alias("profile")]),
        "PRJ-2": of_contact_records(lambda: [
            F.col("awsaccountid").alias("account"), F.col("INITIATIONMETHOD").alias("Call_Initiation_Method"),
            F.col("agent.connectedtoagenttimestamp").alias("Connected_To_Agent_Timestamp")]),
        "PRJ-3": lambda spark, sf: base(spark, sf).select("*"),
        "PRJ-4": nested_with,
        "PRJ-5": of_merged(lambda: ["extension"]),
        "PRJ-6": of_base(lambda: [*[c.alias(n) for n, c in contact_metrics().items()]]),
        "FLT-1": lambda spark, sf: base(spark, sf).filter(F.col("channel") == "CHAT").select("contact_id", "channel"),
        "FLT-2": of_base(lambda: [flag(F.col("method") == "CALLBACK").alias("is_callback"),
                         flag(F.col("method") != "CALLBACK").alias("not_callback"), flag(F.col("xfer_disc") < 60).alias("short")]),
        "FLT-3": of_base(lambda: [flag(F.col("method").isNull()).alias("no_method"),
                         flag(F.col("transferred").isNotNull()).alias("was_transferred")]),
        "FLT-4": customer_leg,
        "FLT-5": of_base(lambda: [F.when(F.col("method") == "CALLBACK", 1).when(F.col("method") != "CALLBACK", 2).alias("way")]),
        "FLT-6": of_base(lambda: [F.when(F.col("xfer_disc") < 60, F.lit("short")).otherwise(F.lit("other")).alias("kind")]),
        "FLT-7": customer_messages,
        "JON-1": lambda spark, sf: voice(spark, sf, ()).select("contact_id", "leg_id"),
        "JON-2": chat_contacts,
        "JON-3": lambda spark, sf: leg_rows(spark, sf).select("contact_id", "conn_id", "history_start"),
        "JON-4": leg_countries,
        "JON-5": leg_numbers,
        "AGG-1": of_merged(lambda: []),
        "AGG-2": of_merged(lambda: ["connectingTimestamp", "connectedTimestamp", "disconnectedTimestamp"]),
        "AGG-3": of_merged(lambda: ["type", "endpoint_type", "endpoint_number", "initialConnectionId", "endpointCountryISO"]),
        "AGG-4": of_merged(lambda: [flag(F.col("softphoneEnabled")).alias("softphone")]),
        "AGG-5": of_merged(lambda: [flag(F.col("inbound")).alias("inbound")]),
        "AGG-6": of_merged(lambda: ["initialconnecthistorytimestamp"]),
        "AGG-7": lambda spark, sf: message_counts(spark, sf).drop("total_msg"),
        "AGG-8": lambda spark, sf: message_counts(spark, sf).select("contactId", "total_msg"),
        "AGG-9": record_counts,
        "SRT-1": lambda spark, sf: contact_usage(spark, sf).select("contactid", "CTR_Initiation_Timestamp"),
        "SRT-2": sorted_before_join,
        "STR-1": streamed_fold,
        "STR-2": event_vocabulary,
        "STR-3": terminal_events,
        "STR-4": of_contacts(lambda: ["type", "initialConnectionId", "initialTimestamp"]),
        "STR-5": of_contacts(lambda: [flag(F.col("inbound")).alias("inbound")]),
        "STR-6": nested_connections,
        "STR-7": history_rows,
        "STR-7-stream": streamed_pages,
        "STR-8": of_connections(lambda: [*LEG_TIMES]),
        "STR-9": of_connections(last_values),
        "STR-10": of_contacts(lambda: [*STAGE_COLUMNS]),
        "STR-11": of_contacts(lambda: ["completion", "record_status"]),
        "STR-12": only_abandoned,
        "STR-13": fx.contact_stores,
        "STR-13-upsert": last_event,
        "STR-14": emitted,
        "STR-15": recovered,
        "STR-16": exactly_once,
        "STR-17": audit_trail,
        "STR-18": reopened,
        "MET-1": contact_metric(service),
        "MET-2": contact_metric(third),
        "MET-3": contact_metric(customer),
        "MET-4": contact_metric(f"{service}_Rounded"),
        "MET-5": contact_metric(f"{third}_Rounded"),
        "MET-6": contact_metric(f"{customer}_Rounded"),
        "MET-7": connection_metric(service),
        "MET-8": connection_metric(desk, "type", "softphoneEnabled", *connected),
        "MET-9": connection_metric(third, "type", *connected),
        "MET-10": connection_metric(customer),
        "MET-11": connection_metric(f"{service}_Rounded"),
        "MET-12": connection_metric(f"{desk}_Rounded", "type", "softphoneEnabled", *connected),
        "MET-13": connection_metric(f"{third}_Rounded", "type", *connected),
        "MET-14": connection_metric(f"{customer}_Rounded"),
        "FN-1": of_contact_records(lambda: [time.epoch_micros("DisconnectTimestamp").alias("micros")]),
        "FN-2": of_contact_records(lambda: [time.unix_time("DisconnectTimestamp").alias("unixtime")]),
        "FN-3": of_contact_records(lambda: [time.epoch_seconds("DisconnectTimestamp").alias("seconds")]),
        "FN-4": of_contact_records(lambda: [
            time.unix_time("DisconnectTimestamp").cast("decimal(20,0)").cast("bigint").alias("seconds")]),
        "FN-5": of_contact_records(lambda: [(
            time.unix_time("DisconnectTimestamp").cast("decimal(20,0)")
            - time.unix_time("TransferCompletedTimestamp").cast("decimal(20,0)")).cast("int").alias("seconds")]),
        "FN-6": lambda spark, sf: fx.connections(spark, sf).select(
            "contactId", "inbound", flag(text.loose_boolean("inbound")).alias("is_inbound")),
        "FN-7": history_times,
        "FN-8": least_times,
        "FN-9": history_entries,
        "FN-10": of_base(lambda: [time.minimum_charge("xfer_disc", 60).alias("charged")]),
        "FN-11": phrases,
        "FN-12": of_contact_records(lambda: [
            time.epoch_millis("InitiationTimestamp").alias("millis"),
            flag(time.epoch_millis("LastUpdateTimestamp") - time.epoch_millis("InitiationTimestamp") > 120_000).alias("older")]),
        "FN-13": encoded_documents,
        "FN-14": json_round_trip,
        "FN-15": text_parts,
        "FN-16": percent_decoded,
        "FN-17": connection_ids,
        "UDF-1": hooked_feed,
        "UDF-2": lambda spark, sf: landing.transcripts(spark, fx.landed_transcripts(spark, sf)).transform(
            messages.count_messages).select(*CHAT_COLUMNS),
    }
