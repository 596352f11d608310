"""Chat messages counted per participant role."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Output column and the participant role it counts.
ROLES = {"system_msg": "SYSTEM", "customer_msg": "CUSTOMER", "agent_msg": "AGENT"}


def _is_message(kind: Column, speaker: Column, role: str) -> Column:
    return (kind == "MESSAGE") & (speaker == role)


def _messages_of(items: Column, role: str) -> Column:
    return F.filter(items, lambda item: _is_message(item["Type"], item["ParticipantRole"], role))


def _total() -> Column:
    return (F.col("system_msg") + F.col("customer_msg") + F.col("agent_msg")).alias("total_msg")


def count_messages(documents: DataFrame) -> DataFrame:
    """Counts of each transcript document, inside its own row: no shuffle."""
    items = F.col("Transcript")
    counted = documents.withColumns({
        name: F.when(items.isNull(), 0).otherwise(F.size(_messages_of(items, role)))
        for name, role in ROLES.items()
    })
    kept = [c for c in documents.columns if c not in ("ContactId", "InstanceId", "Transcript")]
    return counted.select(
        F.col("InstanceId").alias("instanceId"), F.col("ContactId").alias("contactId"), *ROLES, _total(), *kept)


def count_message_items(items: DataFrame, *keys: str) -> DataFrame:
    """The same counts from items already laid out one per row.

    The counts combine before the shuffle, so a chat of any length travels as
    one row per task. Items with a NULL type or role keep their chat in the
    result with zeros.
    """
    counted = items.groupBy(*keys).agg(*[
        F.count_if(_is_message(F.col("Type"), F.col("ParticipantRole"), role)).cast("int").alias(name) for name, role in ROLES.items()
    ])
    return counted.select(*keys, *ROLES, _total())
