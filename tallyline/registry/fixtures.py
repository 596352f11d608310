"""Contact-centre inputs derived row by row from the given tables.

No derivation groups or collects anything, so each scales like the table it
reads. The same rules are written in SQL in ``oracle.py``.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.operators.ingest import wrap_batch
from tallyline.session import configure, scratch
from tallyline.sources import sinks
from tallyline.streaming.contacts import complete_contacts, pending_contacts, stream_contacts, write_slice
from tallyline.streaming.feeds import land_feed, land_submissions, stream_chat_usage, stream_notified_chats
from tallyline.sources import landing, schemas

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _iso(micros: str) -> str:
    return f"date_format(timestamp_micros({micros}), \"{ISO}\")"


# Contacts from orders. ------------------------------------------------------

def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contact records, nested as they are landed."""
    configure(spark)
    timed = (table(spark, sf_dir, "orders")
             .selectExpr("*", "unix_micros(cast(o_orderdate as timestamp)) + (o_orderkey % 86400) * 1000000 as i_us")
             .selectExpr("*", "i_us + (o_custkey % 7) * 1000000 as y_us")
             .selectExpr("*", "y_us + (o_orderkey * 7919 % 180) * 1000000 + (o_orderkey % 4) * 250000 as d_us"))
    return timed.selectExpr(
        "concat('account-', o_custkey % 3) as AWSAccountId",
        "'2017-03-10' as AWSContactTraceRecordFormatVersion",
        f"""named_struct('ARN', concat('agent-', o_custkey % 50),
              'AfterContactWorkDuration', cast(o_orderkey % 30 as int),
              'ConnectedToAgentTimestamp', {_iso('y_us + 2000000')},
              'NumberOfHolds', cast(o_custkey % 4 as int),
              'RoutingProfile', named_struct('ARN', concat('profile-', o_custkey % 5), 'Name', 'basic'),
              'Username', concat('user', o_custkey % 50)) as Agent""",
        "cast(1 as int) as AgentConnectionAttempts",
        "concat('{\"tier\":', o_custkey % 5, '}') as Attributes",
        "if(o_orderkey % 4 = 0, 'CHAT', 'VOICE') as Channel",
        f"{_iso('y_us')} as ConnectedToSystemTimestamp",
        "concat('c', o_orderkey) as ContactId",
        "named_struct('Address', concat('+1555', o_custkey), 'Type', 'TELEPHONE_NUMBER') as CustomerEndpoint",
        f"{_iso('d_us')} as DisconnectTimestamp",
        "if(o_orderkey % 3 = 0, null, concat('c', o_orderkey - o_orderkey % 3)) as InitialContactId",
        """case o_orderpriority when '1-URGENT' then 'CALLBACK' when '2-HIGH' then 'OUTBOUND'
             when '3-MEDIUM' then 'TRANSFER' when '4-NOT SPECIFIED' then 'INBOUND' end as InitiationMethod""",
        f"{_iso('i_us')} as InitiationTimestamp",
        "'instance-1' as InstanceARN",
        f"{_iso('d_us + 60000000')} as LastUpdateTimestamp",
        "array(named_struct('Type', 'AUDIO')) as MediaStreams",
        "named_struct('ARN', concat('queue-', substr(o_orderpriority, 1, 1)), 'Duration', "
        "cast(o_custkey % 7 as int), 'Name', o_orderpriority) as Queue",
        "named_struct('Address', concat('+1800', o_custkey % 10), 'Type', 'TELEPHONE_NUMBER') as SystemEndpoint",
        f"if(o_orderstatus = 'P', {_iso('y_us + 30000000')}, null) as TransferCompletedTimestamp",
        "if(o_orderstatus = 'P', concat('{\"Address\":\"+1777', o_custkey, '\"}'), null) as TransferredToEndpoint",
    )


def contact_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records with their free-form parts as JSON objects, as a writer sends them."""
    return contacts(spark, sf_dir).withColumns({
        "Attributes": F.from_json("Attributes", "tier int"),
        "TransferredToEndpoint": F.from_json("TransferredToEndpoint", "Address string"),
    })


# Call connections from lineitem. ---------------------------------------------

def connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Call-connection records: one per line item, so repeated line items of an
    order are partial records of one contact. Every other record also carries
    an earlier snapshot of its leg, and some have no connection at all."""
    configure(spark)
    timed = (table(spark, sf_dir, "lineitem")
             .selectExpr("*", "concat('c', l_orderkey) as contact", "unix_micros(cast(l_shipdate as timestamp)) as k")
             .selectExpr("*", "if(l_linenumber = 1, contact, concat(contact, '-', l_linenumber)) as leg",
                         "if(l_discount = 0, null, k + l_linenumber * 1000000) as con_us",
                         "if(l_tax = 0, null, k + l_linenumber * 1000000 + cast(l_quantity * 2500000 as bigint)) as dis_us")
             .selectExpr("*", f"{_iso('k')} as k_iso", f"{_iso('k + 1000000')} as k1_iso", f"{_iso('con_us')} as con_iso",
                         f"{_iso('dis_us')} as dis_iso"))
    agent = """if(l_returnflag = 'A', named_struct('softPhoneEnabled', l_linestatus = 'O',
                 'extension', concat('+44', 2000000 + l_partkey), 'name', concat('user', l_suppkey % 50)), null)"""
    phone = """case when l_partkey % 13 = 0 then 'anonymous' when l_returnflag = 'R' then concat('+49', 3000000 + l_partkey)
                 when l_linenumber % 2 = 0 then concat('+1204', 1000000 + l_partkey)
                 else concat('+1555', 1000000 + l_partkey) end"""
    # Joined, not filtered: a function of elements would take the whole row out of the generated code.
    history = """concat(
        if(l_linenumber = 5, array(), array(named_struct('active', 'true', 'status', 'connecting', 'timestamp', k_iso))),
        if(con_iso is null, array(), array(named_struct('active', 'true', 'status', 'connected', 'timestamp', con_iso))),
        if(dis_iso is null, array(), array(named_struct('active', 'false', 'status', 'disconnected', 'timestamp', dis_iso))),
        if(l_linenumber = 6 and l_tax = 0, array(named_struct('active', 'false', 'status', 'lost', 'timestamp',
           cast(null as string))), array()))"""
    full = f"""named_struct('id', leg, 'connectingTimestamp', k_iso, 'connectedTimestamp', con_iso,
        'disconnectedTimestamp', dis_iso, 'agentStatus', {agent}, 'active', 'false',
        'endpoint', named_struct('phoneNumber', {phone}, 'type', 'phone_number'),
        'endpointCountryISO', case when l_linenumber = 3 then null when l_returnflag = 'A' then 'GB'
           when l_returnflag = 'R' then 'DE' else 'US' end,
        'history', {history}, 'lastUpdate', coalesce(dis_iso, con_iso, k_iso),
        'status', if(dis_us is null, 'connected', 'disconnected'),
        'type', case l_returnflag when 'A' then 'agent' when 'R' then 'outbound' else 'inbound' end)"""
    earlier = f"""named_struct('id', leg, 'connectingTimestamp', k1_iso,
        'connectedTimestamp', cast(null as string), 'disconnectedTimestamp', cast(null as string),
        'agentStatus', if(true, null, {agent}), 'active', 'true',
        'endpoint', named_struct('phoneNumber', cast(null as string), 'type', 'phone_number'),
        'endpointCountryISO', cast(null as string),
        'history', array(named_struct('active', 'true', 'status', 'connecting', 'timestamp', k_iso)),
        'lastUpdate', k_iso, 'status', 'connecting', 'type', cast(null as string))"""
    return timed.selectExpr(
        "contact as contactId",
        "if(l_linenumber = 7, '', if(l_returnflag = 'N', 'true', 'false')) as inbound",
        "if(l_linenumber % 2 = 0, null, contact) as initialConnectionId",
        "k_iso as initialTimestamp", "'voice' as type",
        f"""case when l_discount = 0 and l_tax = 0 then if(l_suppkey % 2 = 0, array(), null)
             else concat(array({full}), if(l_suppkey % 2 = 1, array({earlier}), array())) end as connections""",
        f"""named_struct('attributes', concat('{{"part":', l_partkey, '}}'),
             'queue', named_struct('name', concat('q', l_suppkey % 10)),
             'thirdPartyConnections', if(l_linenumber > 1, array(leg), array()),
             'timestamp', k_iso, 'type', 'connecting') as stageConnecting""",
        *[f"""if({when}, named_struct('attributes', concat('{{"part":', l_partkey, '}}'),
             'queue', named_struct('name', concat('q', l_suppkey % 10)), 'thirdPartyConnections', cast(array() as array<string>),
             'timestamp', {at}, 'type', '{kind}'), null) as stage{kind.capitalize()}""" for kind, when, at in (
                 ("connected", "con_iso is not null", "con_iso"), ("ended", "dis_iso is not null", "dis_iso"),
                 ("error", "l_linenumber = 6 and l_tax = 0", "k_iso"))],
    )


# Call events from events. -----------------------------------------------------

def call_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat call events; every event reports one connection of its contact."""
    configure(spark)
    base = table(spark, sf_dir, "events").selectExpr(
        "concat('u', user_id, '-', (day(ts) - 1) div 3) as contactId", "event_id", "user_id", "event_id % 2 as leg",
        "cast(ts as timestamp) as ts", "event_type as source", "props")
    return base.selectExpr(
        "contactId", "event_id",
        """case source when 'signup' then 'Connecting' when 'view' then 'Connected' when 'click' then 'ACW'
             when 'purchase' then 'Destroyed' else 'Refresh' end as event_type""",
        "ts",
        """case source when 'signup' then 'connecting' when 'view' then 'connected' when 'click' then 'ended'
             when 'purchase' then 'ended' else if(event_id % 5 = 0, 'error', 'connected') end as status""",
        "case event_id % 4 when 0 then null when 1 then '' when 2 then 'voice' else 'queue_callback' end as contact_type",
        "if(event_id % 11 = 0, null, event_id % 3 = 0) as inbound",
        "if(event_id % 5 = 0, null, concat('k', leg)) as initialConnectionId",
        "concat('k', leg) as connId",
        "case when leg = 0 then 'agent' when event_id % 8 < 4 then 'outbound' else 'inbound' end as conn_type",
        """case source when 'signup' then 'connecting' when 'view' then 'connected' when 'error' then 'hold'
             else 'disconnected' end as conn_state""",
        "source in ('signup', 'view', 'error') as active",
        "concat('+', case user_id % 4 when 0 then '1204' when 1 then '49' when 2 then '353' else '1555' end, "
        "1000000 + event_id) as phone_number",
        "if(leg = 0, if(event_id % 6 = 0, 'desk', concat('+44', 2000000 + user_id)), null) as extension",
        "if(leg = 0, event_id % 3 <> 0, null) as soft_phone_enabled",
        "props as attributes", "concat('q', user_id % 10) as queue",
        "if(event_id % 6 = 0, array('k2', 'k3'), array()) as third_party",
    )


def agent_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agent events with two snapshots that differ in shape."""
    configure(spark)
    base = table(spark, sf_dir, "events").selectExpr("*", "unix_micros(cast(ts as timestamp)) as us")

    def snapshot(shift: int, groups: str, contacts: str) -> str:
        n = f"(event_id + {shift})"
        return f"""named_struct(
            'AgentStatus', named_struct('ARN', concat('status-', {n} % 3), 'Name',
               if({n} % 3 = 0, 'Available', 'Busy'), 'StartTimestamp', {_iso(f'us - {shift} * 60000000')}),
            'Configuration', named_struct('AgentHierarchyGroups', {groups}, 'FirstName', concat('first', user_id),
               'LastName', concat('last', user_id),
               'RoutingProfile', named_struct('ARN', concat('profile-', {n} % 4),
                  'Concurrency', array(named_struct('AvailableSlots', cast({n} % 2 as int), 'Channel', 'VOICE',
                     'MaximumSlots', 1), named_struct('AvailableSlots', cast({n} % 3 as int), 'Channel', 'CHAT',
                     'MaximumSlots', 2)),
                  'DefaultOutboundQueue', named_struct('ARN', 'queue-0', 'Channels', array('VOICE'), 'Name', 'default'),
                  'InboundQueues', array(named_struct('ARN', concat('queue-', {n} % 5), 'Channels',
                     array('VOICE', 'CHAT'), 'Name', concat('q', {n} % 5))), 'Name', 'basic'),
               'Username', concat('user', user_id)),
            'Contacts', {contacts})"""

    current = snapshot(0, "named_struct('Level1', concat('g', user_id % 3))",
                       "array(named_struct('ContactId', concat('c', event_id)))")
    previous = snapshot(1, "array(concat('g', user_id % 3), 'all')", f"""array(named_struct('Channel', 'VOICE',
            'ConnectedToAgentTimestamp', {_iso('us')}, 'ContactId', concat('c', event_id), 'InitiationMethod', 'INBOUND',
            'Queue', named_struct('ARN', 'queue-0', 'Name', 'default'), 'State', if(event_id % 2 = 0, 'CONNECTED',
            'MISSED'), 'StateStartTimestamp', {_iso('us')}))""")
    return base.selectExpr(
        "'account-0' as AWSAccountId", "concat('agent-', user_id) as AgentARN", f"{current} as CurrentAgentSnapshot",
        "concat('e', event_id) as EventId", f"{_iso('us')} as EventTimestamp", "event_type as EventType",
        "'instance-1' as InstanceARN", f"if(event_id % 4 = 0, null, {previous}) as PreviousAgentSnapshot",
        "'2017-10-01' as Version")


# Chat transcripts from conversations. ----------------------------------------

def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transcript document per conversation turn, one item per line of its text."""
    return table(spark, sf_dir, "conversations").selectExpr(
        "concat('c', (conv_id * 8 + turn) * 2) as ContactId", "'instance-1' as InstanceId",
        r"""if(turn % 7 = 6, array(), transform(split(text, '\n'), (line, i) -> named_struct(
             'Type', if((turn + i) % 5 = 4, 'EVENT', 'MESSAGE'),
             'ParticipantRole', case when i % 4 = 3 then 'SUPERVISOR'
                when (i % 4 = 0 and role = 'user') or (i % 4 = 1 and role = 'assistant') then 'CUSTOMER'
                when i % 4 = 2 or role = 'system' then 'SYSTEM' else 'AGENT' end))) as Transcript""")


def transcript_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcript items laid out one per row, one per conversation turn."""
    return table(spark, sf_dir, "conversations").selectExpr(
        "concat('c', conv_id * 2) as contactId", "'instance-1' as instanceId",
        "if(turn % 5 = 4, 'EVENT', 'MESSAGE') as Type",
        "case role when 'user' then 'CUSTOMER' when 'assistant' then 'AGENT' when 'system' then 'SYSTEM' end as ParticipantRole")


# Dialling prefixes: a few entries with nested and single-digit prefixes. -------

DIAL_PREFIXES = [("1", "US"), ("1204", "CA"), ("44", "GB"), ("49", "DE"), ("353", "IE"), ("91", "IN")]


def dial_prefixes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DIAL_PREFIXES, "prefix string, iso string")


# Landed copies. ----------------------------------------------------------------

_landed: dict[tuple, object] = {}


def landed(spark: SparkSession, sf_dir: str, name: str, build: Callable[[str], object]):
    """Write something under the scratch folder once per session and reuse it."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _landed:
        path = scratch(spark, name)
        _landed[key] = build(path) or path
    return _landed[key]


def landed_contacts(spark: SparkSession, sf_dir: str) -> str:
    return landed(spark, sf_dir, "contacts", lambda p: sinks.write_json(contact_objects(spark, sf_dir), p))


def landed_connections(spark: SparkSession, sf_dir: str) -> str:
    return landed(spark, sf_dir, "connections", lambda p: sinks.write_json(connections(spark, sf_dir), p))


def landed_mixed_spelling(spark: SparkSession, sf_dir: str) -> str:
    """Connection records from writers that disagree on the case of field names."""
    def build(path: str) -> None:
        records = connections(spark, sf_dir)
        kind = records.schema["connections"].dataType.simpleString()
        other = kind.replace("endpointCountryISO", "endpointCountryIso").replace("softPhoneEnabled", "softphoneEnabled")
        # The fields are named before the text is made, which takes less than finding the names in it.
        spelt = F.when(F.col("contactId").rlike("[0-4]$"), F.to_json(F.struct(*[
            F.col(c).cast(other).alias(c) if c == "connections" else F.col(c) for c in records.columns]))
        ).otherwise(F.to_json(F.struct("*")))
        # Compressing at the usual level takes longer than all else here.
        records.select(spelt.alias("value")).write.options(
            **sinks.TEXT_OPTIONS, **{"zlib.compress.level": "BEST_SPEED"}).text(path)
    return landed(spark, sf_dir, "spelling", build)


def landed_agent_events(spark: SparkSession, sf_dir: str) -> str:
    return landed(spark, sf_dir, "agent_events", lambda p: sinks.write_json(agent_events(spark, sf_dir), p))


# Transcripts in one object of a landing folder.
TRANSCRIPTS_PER_OBJECT = 1000


def write_transcripts(documents: DataFrame, path: str) -> None:
    """Append transcripts to a landing folder, many to an object, a line each.

    The number of objects goes by the bytes and not by the transcripts. Of the
    rows of one contact in a task the first is its transcript.
    """
    (documents.select(F.col("ContactId").alias("contact"), F.to_json(F.struct("*")).alias("value"),
                      F.spark_partition_id().alias("task"), F.monotonically_increasing_id().alias("row"))
     .groupBy("contact", "task").agg(F.min_by("value", "row").alias("value")).select("value")
     .write.mode("append").option("maxRecordsPerFile", TRANSCRIPTS_PER_OBJECT).text(path))


def landed_transcripts(spark: SparkSession, sf_dir: str) -> str:
    return landed(spark, sf_dir, "transcripts", lambda p: write_transcripts(transcripts(spark, sf_dir), p))


def streamed_chat_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcript counts stored by the streaming job."""
    def build(path: str) -> None:
        source = landed_transcripts(spark, sf_dir)
        stream_chat_usage(spark, source, path, scratch(spark, "errors"), scratch(spark, "offsets"),
                          once=True).awaitTermination()
    return landing.chat_usage(spark, landed(spark, sf_dir, "chat_stream", build))


def rewritten_chat_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same after each transcript arrived twice, first without its items."""
    def build(path: str) -> None:
        source, errors, offsets = (scratch(spark, n) for n in ("transcripts", "errors", "offsets"))
        whole = transcripts(spark, sf_dir)
        for version in (whole.withColumn("Transcript", F.slice("Transcript", 1, 0)), whole):
            write_transcripts(version, source)
            stream_chat_usage(spark, source, path, errors, offsets, once=True).awaitTermination()
    return landing.chat_usage(spark, landed(spark, sf_dir, "chat_rewritten", build))


def merged_chat_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in the keyed table, into which each version was merged."""
    def build(path: str) -> None:
        source, errors, offsets = (scratch(spark, n) for n in ("transcripts", "errors", "offsets"))
        whole = transcripts(spark, sf_dir)
        for version in (whole.withColumn("Transcript", F.slice("Transcript", 1, 0)), whole):
            write_transcripts(version, source)
            stream_chat_usage(spark, source, path, errors, offsets, once=True, merge=True).awaitTermination()
    return landing.merged_chat_usage(spark, landed(spark, sf_dir, "chat_merged", build))


def notified_chat_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message counts of the transcripts in the objects that messages name, every one of them twice."""
    def build(path: str) -> None:
        objects = landed_transcripts(spark, sf_dir)
        notices, errors, offsets = (scratch(spark, n) for n in ("notices", "errors", "offsets"))
        key = F.regexp_extract("file", r"([^/]+)$", 1)
        coded = F.replace(F.url_encode(key), F.lit("+"), F.lit("%20"))
        message = F.to_json(F.struct(F.array(F.struct(F.struct(F.struct(coded.alias("key")).alias("object")).alias("s3"))).alias("Records")))
        for _ in range(2):
            (spark.read.option("recursiveFileLookup", "true").text(objects).select(F.col("_metadata.file_path").alias("file")).distinct()
             .select(message.alias("value")).write.mode("append").text(notices))
            stream_notified_chats(spark, notices, objects, path, errors, offsets, once=True).awaitTermination()
    return landing.merged_chat_usage(spark, landed(spark, sf_dir, "chat_notified", build))


def streamed_submissions(spark: SparkSession, sf_dir: str, schema: str) -> dict[str, str]:
    """Envelopes as a stream's files, and the folders of its three sinks."""
    def build(path: str) -> dict[str, str]:
        source, record, envelope, broken, offsets = (
            scratch(spark, n) for n in ("submissions", "records", "bad-envelopes", "bad-objects", "offsets"))
        sinks.write_lines(envelopes(spark, sf_dir).select(F.col("body").alias("value")), source)
        land_submissions(spark, source, schema, record, envelope, broken, offsets, once=True).awaitTermination()
        return {"record": record, "bad envelope": envelope, "bad object": broken}
    return landed(spark, sf_dir, "submissions_stream", build)


def streamed_feed(spark: SparkSession, sf_dir: str, name: str, lines: DataFrame, schema: str,
                  fmt: str, hook: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """What ``land_feed`` makes of lines that are run together or cut off: (records, rejects)."""
    def build(path: str) -> dict[str, str]:
        source, table_path, errors = (scratch(spark, n) for n in ("wire", "table", "errors"))
        sinks.write_lines(lines, source)
        land_feed(spark, source, schema, table_path, errors, scratch(spark, "offsets"), fmt, once=True,
                  hook=hook).awaitTermination()
        return {"table": table_path, "errors": errors}
    made = landed(spark, sf_dir, f"feed_{name}", build)
    return (spark.read.schema(schemas.struct(schema)).format(fmt).load(made["table"]), spark.read.text(made["errors"]))


def run_together(df: DataFrame, key: str) -> DataFrame:
    """Each row as JSON twice in a line, the copy under another key, after a line of its first 20 bytes."""
    one, two = F.to_json(F.struct("*")), F.to_json(F.struct(*[
        F.concat(F.col(c), F.lit("x")).alias(c) if c == key else F.col(c) for c in df.columns]))
    return df.select(F.concat(F.substring(one, 1, 20), F.lit("\n"), one, two).alias("value"))


# Raw wire forms. -----------------------------------------------------------------

BAD_EVERY = 50


def wire_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of two objects back to back; the second is a copy under another id.
    Some carry braces inside a string, some are cut off in the middle."""
    note = F.when(F.expr("cast(substr(ContactId, 2) as bigint) % 3 = 0"), 'a}{b"').otherwise("plain")
    first = F.to_json(F.struct("ContactId", "Channel", "InitiationTimestamp", note.alias("Attributes")))
    second = F.to_json(F.struct(F.concat("ContactId", F.lit("x")).alias("ContactId"), "Channel"))
    broken = F.expr(f"cast(substr(ContactId, 2) as bigint) % {BAD_EVERY} = 7")
    return contacts(spark, sf_dir).select(
        F.when(broken, F.substring(first, 1, 30)).otherwise(F.concat(first, second)).alias("value"))


def landed_wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = landed(spark, sf_dir, "wire", lambda p: sinks.write_lines(wire_lines(spark, sf_dir), p))
    return spark.read.text(path)


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Submission envelopes, each with a base64 batch of two contact records.
    By key: 0 mod 10 has a number for a stream name, 1 a string for a record, 2 no data, 3 no contact ids."""
    rows = connections(spark, sf_dir).select(
        "contactId", "inbound", "type",
        F.expr("cast(substr(contactId, 2) as bigint)").alias("key"))
    named = F.when(F.col("key") % 10 == 3, F.lit("")).otherwise(F.col("contactId"))
    one = F.to_json(F.struct(named.alias("contactId"), "inbound", "type"))
    two = F.to_json(F.struct(F.concat(named, F.lit("/2")).alias("contactId"), "inbound"))
    batch = wrap_batch(rows.withColumns({"one": one, "two": two}), "one", "two")
    body = (F.when(F.col("key") % 10 == 0, F.concat(F.lit('{"DeliveryStreamName":7,"Record":{"Data":"'), "data", F.lit('"}}')))
            .when(F.col("key") % 10 == 1, F.concat(F.lit('{"DeliveryStreamName":"s","Record":"'), "data", F.lit('"}')))
            .when(F.col("key") % 10 == 2, F.lit('{"DeliveryStreamName":"s","Record":{}}'))
            .otherwise(F.concat(F.lit('{"DeliveryStreamName":"s","Record":{"Data":"'), "data", F.lit('"}}'))))
    return batch.select("key", body.alias("body"))


# Streamed call events. -----------------------------------------------------------

ARRIVALS = 3


def arrivals(events: DataFrame, count: int) -> tuple[list[DataFrame], int]:
    """The events cut into spans of equal time, and the microsecond of the first."""
    us = F.unix_micros("ts")
    first, last = (x or 0 for x in events.agg(F.min(us), F.max(us)).first())
    step = (last - first) // count + 1
    return [events.filter(F.floor((us - first) / step) == n) for n in range(count)], first


def streamed_contacts(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Replay the call events through the streaming fold, in as many arrivals of equal time span.

    Each arrival lands, the job runs until it has caught up, and stops; the next
    run resumes from the checkpoint. The events are long past, so each run also
    releases by its timers what they left pending.
    """
    def build(path: str) -> dict[str, str]:
        configure(spark)
        source, records, submitted, offsets, history = (
            scratch(spark, n) for n in ("calls", "records", "submitted", "offsets", "history"))
        for events in arrivals(call_events(spark, sf_dir), ARRIVALS)[0]:
            write_slice(events, source)
            _run(spark, source, records, submitted, offsets, history=history)
        return {"records": records, "submitted": submitted, "history": history}
    return landed(spark, sf_dir, "contact_stream", build)


def contact_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the pending and the complete side of the streaming fold hold after each of two arrivals.

    The replay lags so far behind that its clock stands at the first event: no timer is due.
    """
    def build(path: str) -> None:
        configure(spark)
        source, records, submitted, offsets = (scratch(spark, n) for n in ("calls", "records", "submitted", "offsets"))
        slices, first = arrivals(call_events(spark, sf_dir), 2)
        for moment, events in enumerate(slices, 1):
            write_slice(events, source)
            _run(spark, source, records, submitted, offsets, lag=int(time.time()) - first // 1_000_000)
            for store, rows in (("pending", pending_contacts(spark, offsets)), ("complete", complete_contacts(spark, records))):
                entries = F.aggregate("connections", F.lit(0).cast("bigint"), lambda n, c: n + c["entries"])
                (rows.groupBy("contactId").agg(F.count("*").alias("records"), F.sum(entries).cast("bigint").alias("entries"))
                 .select(F.lit(moment).alias("moment"), F.lit(store).alias("store"), "*").write.mode("append").parquet(path))
    return spark.read.parquet(landed(spark, sf_dir, "contact_stores", build))


def _run(spark: SparkSession, source: str, records: str, submitted: str, offsets: str, **more) -> None:
    events = landing.stream_json(spark, source, schemas.CALL_EVENT)
    partitions = min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    stream_contacts(events, records, submitted, offsets, prefixes=dial_prefixes(spark), once=True, partitions=partitions, **more)


def streamed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit trail of the streaming fold."""
    return spark.read.parquet(streamed_contacts(spark, sf_dir)["submitted"])


def streamed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return complete_contacts(spark, streamed_contacts(spark, sf_dir)["records"])


def streamed_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history pages that the streaming fold stored, as records."""
    return complete_contacts(spark, streamed_contacts(spark, sf_dir)["history"])
