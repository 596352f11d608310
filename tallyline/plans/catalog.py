"""Tables, reports and SQL functions by name, for use from ``spark.sql``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyline.functions.metrics import SERVICE_MINIMUM, TELEPHONY_MINIMUM
from tallyline.functions.time import MICROS, SHORT_ISO
from tallyline.operators.legs import LEG_FIELDS
from tallyline.plans import reports
from tallyline.session import configure
from tallyline.sources import landing
from tallyline.sources.sinks import publish_view

# View names of the landing tables and their readers.
TABLES = {
    "contact_records": landing.contact_records,
    "call_connections": landing.call_connections,
    "agent_events": landing.agent_events,
    "chat_usage": landing.chat_usage,
}


def register_tables(spark: SparkSession, **paths: str) -> None:
    """Expose landing folders as views, such as ``contact_records="s3a://…/contacts"``.

    Names are matched without regard to case, in SQL as the session's default is, and in the records.
    """
    configure(spark)
    for name, path in paths.items():
        publish_view(TABLES[name](spark, path, any_spelling=True), name)


def register_reports(spark: SparkSession, contact_records: str, call_connections: str, chat_usage: str) -> None:
    """Expose the three reports as views over the landing folders.

    Each report reads with a schema of just the fields it uses.
    """
    configure(spark)
    contacts = landing.contact_records(spark, contact_records, reports.CONTACT_FIELDS, any_spelling=True)
    connections = landing.call_connections(spark, call_connections, LEG_FIELDS, any_spelling=True)
    chats = landing.chat_usage(spark, chat_usage, any_spelling=True)
    for name, report in report_frames(contacts, connections, chats).items():
        publish_view(report, name)


def report_frames(contacts: DataFrame, connections: DataFrame, chats: DataFrame) -> dict[str, DataFrame]:
    return {
        "contact_usage_report": reports.contact_usage(contacts),
        "connection_usage_report": reports.connection_usage(contacts, connections),
        "chat_usage_report": reports.chat_report(chats, contacts),
    }


def register_functions(spark: SparkSession) -> None:
    """SQL functions of the report dialect that Spark lacks or treats differently."""
    half = MICROS // 2
    bodies = {
        "from_iso8601_timestamp(value STRING) RETURNS TIMESTAMP": f"""CASE WHEN substring(value, 5, 1) IN ('-', '')
            THEN coalesce(try_to_timestamp(value), try_to_timestamp(value, "{SHORT_ISO}")) END""",
        "to_unixtime(value TIMESTAMP) RETURNS DOUBLE": f"unix_micros(value) / {MICROS}",
        "whole_seconds(value TIMESTAMP) RETURNS BIGINT":
            f"(unix_micros(value) + if(unix_micros(value) < 0, -{half}, {half})) div {MICROS}",
        "service_charge(seconds INT) RETURNS INT":
            f"CASE WHEN seconds < {SERVICE_MINIMUM} THEN {SERVICE_MINIMUM} ELSE seconds END",
        "telephony_charge(seconds INT) RETURNS INT":
            f"CASE WHEN seconds < {TELEPHONY_MINIMUM} THEN {TELEPHONY_MINIMUM} ELSE seconds END",
    }
    for signature, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
