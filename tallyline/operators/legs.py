"""Connection legs: flatten call-connection records and merge repeated snapshots."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.text import loose_boolean
from tallyline.operators.ingest import unnest

# What the merge reads from a call-connection record.
LEG_FIELDS = [
    "contactId", "inbound", "initialConnectionId", "connections.id", "connections.type",
    "connections.agentStatus.extension", "connections.agentStatus.softPhoneEnabled",
    "connections.endpoint.type", "connections.endpoint.phoneNumber", "connections.endpointCountryISO",
    "connections.connectingTimestamp", "connections.connectedTimestamp", "connections.disconnectedTimestamp",
    "connections.history.timestamp",
]

_ZIPPED = {
    "conn_id": "connections.id",
    "type": "connections.type",
    "extension": "connections.agentStatus.extension",
    "softphoneEnabled": "connections.agentStatus.softPhoneEnabled",
    "endpoint_type": "connections.endpoint.type",
    "endpoint_number": "connections.endpoint.phoneNumber",
    "endpointCountryISO": "connections.endpointCountryISO",
    "connectingTimestamp": "connections.connectingTimestamp",
    "connectedTimestamp": "connections.connectedTimestamp",
    "disconnectedTimestamp": "connections.disconnectedTimestamp",
    "history": "connections.history",
}


def record_fields(fields: Collection[str]) -> list[str]:
    """What ``flatten_legs`` with these ``fields`` reads from a call-connection record."""
    leaves = [path for name, path in _ZIPPED.items() if name == "conn_id" or name in fields]
    return [*LEG_FIELDS[:3], *(f for f in LEG_FIELDS if any(f == p or f.startswith(f"{p}.") for p in leaves))]


def earliest(times: Column) -> Column:
    """Least element of an array, or NULL as soon as one element is NULL."""
    return F.when(~F.exists(times, lambda t: t.isNull()), F.array_min(times))


def flatten_legs(records: DataFrame, fields: Collection[str] | None = None) -> DataFrame:
    """One row per element of ``connections``; records without any give none.

    The wanted leaves are zipped before they are exploded, so a columnar scan
    reads only those leaves rather than whole connection structs. ``fields``:
    only these of them beside the ids, where a caller reads no others.
    """
    names = [name for name in _ZIPPED if fields is None or name == "conn_id" or name in fields]
    zipped = F.arrays_zip(*[F.col(_ZIPPED[name]).alias(name) for name in names])
    start = [earliest(F.col("leg.history.timestamp")).alias("history_start")] if "history" in names else []
    return (records.withColumn("_legs", zipped)
            .transform(unnest, "_legs", "leg", ["contactId", "inbound", "initialConnectionId"])
            .select(
                F.col("contactId").alias("contact_id"), "inbound", "initialConnectionId",
                *[F.col("leg").getField(name).alias(name) for name in names if name != "history"], *start))


def merge_legs(legs: DataFrame, *within: str) -> DataFrame:
    """One row per (contact, connection) from any number of snapshots.

    "Any value" is pinned to the least one, which makes the result repeatable.
    Every aggregate combines before the shuffle, so repeated snapshots of one
    connection never travel. Legs that are already placed by ``within``, which
    the contact and connection decide, are merged where they are.
    """
    merged = {
        "initialconnecthistorytimestamp": ("history_start", F.min),
        "type": ("type", F.min),
        "extension": ("extension", F.min),
        "endpoint_type": ("endpoint_type", F.min),
        "endpoint_number": ("endpoint_number", F.min),
        "softphoneEnabled": ("softphoneEnabled", lambda name: F.bool_and(loose_boolean(name))),
        "inbound": ("inbound", lambda name: F.bool_or(loose_boolean(name))),
        "initialConnectionId": ("initialConnectionId", F.min),
        "connectingTimestamp": ("connectingTimestamp", F.min),
        "connectedTimestamp": ("connectedTimestamp", F.min),
        "disconnectedTimestamp": ("disconnectedTimestamp", F.min),
        "endpointCountryISO": ("endpointCountryISO", F.min),
    }
    keys = [*(within or ["contact_id"]), "conn_id"]
    found = [combine(source).alias(name) for name, (source, combine) in merged.items() if source in legs.columns]
    return legs.groupBy(*keys).agg(*found) if found else legs.select(*keys).distinct()


def connection_legs(records: DataFrame) -> DataFrame:
    return records.transform(flatten_legs).transform(merge_legs)
