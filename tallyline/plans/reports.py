"""The three usage reports."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.functions.metrics import connection_metrics, contact_metrics
from tallyline.functions.time import epoch_seconds
from tallyline.operators.legs import flatten_legs, merge_legs
from tallyline.operators.skew import hot_keys, row_bytes, salted_left_join, spread_ties

# What the reports read from a contact record.
CONTACT_FIELDS = [
    "AWSAccountId", "InstanceARN", "Channel", "Queue.Name", "SystemEndpoint.Address", "ContactId",
    "InitialContactId", "CustomerEndpoint.Address", "Agent.ARN", "Agent.ConnectedToAgentTimestamp",
    "TransferredToEndpoint", "InitiationMethod", "InitiationTimestamp", "DisconnectTimestamp",
    "ConnectedToSystemTimestamp", "TransferCompletedTimestamp",
]

# Output columns of the reports in order, with where they come from.
_IDENTITY = {
    "awsaccountid": "account_id",
    "instancearn": "instance",
    "channel": "channel",
    "queue_name": "queue",
    "system_endpoint": "system_address",
    "contactid": "contact_id",
    "initialContactId": "initial_contact_id",
    "customer_endpoint": "customer_address",
}
_LEG = {
    "connection_id": "leg_id",
    "initialConnectionId": "initialConnectionId",
    "type": "leg_type",
    "extension": "extension",
    "softphoneEnabled": "softphone",
    "inbound": "inbound",
    "connectingTimestamp": "connectingTimestamp",
    "connectedTimestamp": "connectedTimestamp",
    "disconnectedTimestamp": "leg_disconnected",
    "endpointCountryISO": "endpointCountryISO",
}
_COURSE = {
    "AgentARN": "agent",
    "TransferEndpoint": "transfer_endpoint",
    "Call_Initiation_Method": "method",
    "CTR_Initiation_Timestamp": "initiated",
    "Connected_To_Agent_Timestamp": "agent_connected",
    "Disconnect_Timestamp": "disconnected",
    "Connected_To_System_Timestamp": "system_connected",
    "Transfer_Completed_Timestamp": "transferred",
}


def _named(columns: dict[str, str]) -> list:
    return [F.col(source).alias(name) for name, source in columns.items()]


def contact_base(contacts: DataFrame) -> DataFrame:
    """Flat working columns of a contact, each timestamp parsed once."""
    flat = contacts.select(
        F.col("AWSAccountId").alias("account_id"),
        F.col("InstanceARN").alias("instance"),
        F.col("Channel").alias("channel"),
        F.col("Queue.Name").alias("queue"),
        F.col("SystemEndpoint.Address").alias("system_address"),
        F.col("ContactId").alias("contact_id"),
        F.col("InitialContactId").alias("initial_contact_id"),
        F.col("CustomerEndpoint.Address").alias("customer_address"),
        F.col("Agent.ARN").alias("agent"),
        F.col("TransferredToEndpoint").alias("transfer_endpoint"),
        F.col("InitiationMethod").alias("method"),
        F.col("InitiationTimestamp").alias("initiated"),
        F.col("Agent.ConnectedToAgentTimestamp").alias("agent_connected"),
        F.col("DisconnectTimestamp").alias("disconnected"),
        F.col("ConnectedToSystemTimestamp").alias("system_connected"),
        F.col("TransferCompletedTimestamp").alias("transferred"),
        epoch_seconds("DisconnectTimestamp").alias("_disc"),
        epoch_seconds("InitiationTimestamp").alias("_init"),
        epoch_seconds("ConnectedToSystemTimestamp").alias("_sys"),
        epoch_seconds("TransferCompletedTimestamp").alias("_xfer"),
    )
    return flat.select(
        "*",
        (F.col("_disc") - F.col("_init")).cast("int").alias("init_disc"),
        (F.col("_disc") - F.col("_sys")).cast("int").alias("sys_disc"),
        (F.col("_disc") - F.col("_xfer")).cast("int").alias("xfer_disc"),
    ).drop("_disc", "_init", "_sys", "_xfer")


def latest_first(report: DataFrame, *ties: str, time: str = "CTR_Initiation_Timestamp",
                 packed: Collection[str] = ()) -> DataFrame:
    """Newest contacts first. Ties are ordered too, so that a timestamp shared
    by very many rows still spreads over several range partitions.

    ``packed`` columns move as one value. Those that the rows of a contact share
    are then the same bytes in each, which the shuffle's compression stores once.
    """
    rest = [name for name in report.columns if name not in packed]
    moved = report.select(F.struct(*packed).alias("_packed"), *rest) if packed else report
    at = {name: F.col("_packed")[name] if name in packed else F.col(name) for name in report.columns}
    return (moved.withColumn("_tie", spread_ties())
            .orderBy(at[time].desc(), *[at[name] for name in ties], "_tie")
            .select(*[at[name].alias(name) for name in report.columns]))


def contact_usage(contacts: DataFrame, ordered: bool = True) -> DataFrame:
    """Contact-only usage: one row per contact record of any channel.

    ``ordered=False`` leaves out the global sort for callers that only store
    the rows; nothing else in the report moves data.
    """
    metrics = [column.alias(name) for name, column in contact_metrics().items()]
    report = contact_base(contacts).select(*_named(_IDENTITY), *_named(_COURSE), *metrics)
    return latest_first(report, "contactid") if ordered else report


# What the voice reports read from a leg.
REPORT_LEG = ("type", "extension", "softphoneEnabled", "inbound", "initialConnectionId", "connectingTimestamp",
              "connectedTimestamp", "disconnectedTimestamp", "endpointCountryISO")
_LEG_NAMES = {"type": "leg_type", "softphoneEnabled": "softphone", "disconnectedTimestamp": "leg_disconnected"}


def _merged(snapshots: DataFrame, fields: Collection[str], *within: str) -> DataFrame:
    """The legs of the reports from their snapshots."""
    seconds = epoch_seconds("disconnectedTimestamp") - epoch_seconds("connectedTimestamp")
    timed = {"connectedTimestamp", "disconnectedTimestamp"} <= set(fields)
    return merge_legs(snapshots, *within).select(
        "contact_id",
        F.col("contact_id").alias("leg_contact_id"),
        F.col("conn_id").alias("leg_id"),
        *[F.col(name).alias(_LEG_NAMES.get(name, name)) for name in REPORT_LEG if name in fields],
        *([seconds.cast("int").alias("leg_seconds")] if timed else []))


def voice_legs(contacts: DataFrame, connections: DataFrame, split_hot: bool = True,
               fields: Collection[str] = REPORT_LEG) -> DataFrame:
    """Voice contacts with their merged connection legs, unmatched contacts kept.

    Snapshots of legs move once: they are placed by contact, then weighed, merged
    and joined there, and no task sorts what it scans. A contact with very many
    snapshots would be one task; such contacts are left out of that join, and
    their legs merged by connection and dealt into lanes instead.
    ``fields``: what the caller reads of a leg, if less.
    """
    voice = contact_base(contacts.filter(F.col("Channel") == "VOICE"))
    snapshots = (flatten_legs(connections.filter(F.col("contactId").isNotNull()), fields)
                 .select("contact_id", "conn_id", *[name for name in REPORT_LEG if name in fields])
                 .repartition("contact_id"))
    if not split_hot:
        return voice.join(_merged(snapshots, fields, "contact_id"), "contact_id", "left")
    hot = hot_keys(snapshots, "contact_id", row_bytes(snapshots))

    # Not by anti and semi joins: those sink below the placing, and then it would be done once for each use.
    def usual(df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(hot), "contact_id", "left").filter(F.col("_lanes").isNull()).drop("_lanes")

    def split(df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(hot), "contact_id").drop("_lanes")

    cold = usual(voice).join(_merged(usual(snapshots), fields, "contact_id"), "contact_id", "left")
    return cold.unionByName(salted_left_join(split(voice), _merged(split(snapshots), fields), "contact_id", "leg_id", hot))


def connection_usage(contacts: DataFrame, connections: DataFrame, ordered: bool = True,
                     split_hot: bool = True) -> DataFrame:
    """Connection-level usage: one row per voice contact and connection."""
    metrics = [column.alias(name) for name, column in connection_metrics().items()]
    rows = voice_legs(contacts, connections, split_hot)
    if ordered:  # before the metrics, which need not move
        of_contact = [*_IDENTITY.values(), *_COURSE.values(), "init_disc", "sys_disc", "xfer_disc"]
        rows = latest_first(rows, "contact_id", "leg_id", time="initiated", packed=of_contact)
    return rows.select(*_named(_IDENTITY), *_named(_LEG), *_named(_COURSE), *metrics)


def chat_report(chats: DataFrame, contacts: DataFrame) -> DataFrame:
    """Chat usage: message counts next to the contact they belong to.

    Written as the left join it is specified as. The channel filter rejects
    unmatched rows, so Catalyst runs it as an inner join, both of whose sides
    adaptive execution can split.
    """
    contact = contacts.select(
        F.col("ContactId").alias("ContactId"), F.col("Channel").alias("channel"), F.col("Queue.Name").alias("name"),
        F.col("InitiationTimestamp").alias("CallInitiationTimestamp"),
        F.col("Agent.ConnectedToAgentTimestamp").alias("ConnectedToAgentTimestamp"),
        F.col("DisconnectTimestamp").alias("DisconnectTimestamp"),
        F.col("ConnectedToSystemTimestamp").alias("ConnectedToSystemTimestamp"))
    chat = chats.select(
        F.col("contactId").alias("_chat_contact"), F.col("instanceId").alias("instanceid"),
        F.col("system_msg").alias("ChatUsageSystemMsg"), F.col("customer_msg").alias("ChatUsageCustomerMsg"),
        F.col("agent_msg").alias("ChatUsageAgentMsg"), F.col("total_msg").alias("ChatUsageTotalMsg"))
    return (chat.join(contact, F.col("_chat_contact") == F.col("ContactId"), "left")
            .filter(F.col("channel") == "CHAT")
            .select("instanceid", "name", "ContactId", "channel", "CallInitiationTimestamp",
                    "ConnectedToAgentTimestamp", "DisconnectTimestamp", "ConnectedToSystemTimestamp",
                    "ChatUsageSystemMsg", "ChatUsageCustomerMsg", "ChatUsageAgentMsg", "ChatUsageTotalMsg"))
