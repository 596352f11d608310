"""Names for use from SQL."""

from tallyline.plans import catalog, reports
from tallyline.registry import fixtures as fx
from tallyline.registry import queries


def test_tables_and_reports(spark, sf):
    queries.chat_usage_table(spark, sf)
    chats = fx.landed(spark, sf, "chat_usage", None)
    contacts, connections = fx.landed_contacts(spark, sf), fx.landed_connections(spark, sf)
    catalog.register_tables(spark, contact_records=contacts, call_connections=connections, chat_usage=chats,
                            agent_events=fx.landed_agent_events(spark, sf))
    assert spark.sql("SELECT queue.name, AGENT.arn FROM contact_records WHERE channel = 'VOICE'").count() > 0
    assert spark.table("agent_events").count() > 0
    catalog.register_reports(spark, contacts, connections, chats)
    assert spark.table("contact_usage_report").count() == spark.table("contact_records").count()
    direct = reports.connection_usage(fx.contacts(spark, sf), fx.connections(spark, sf))
    assert spark.table("connection_usage_report").count() == direct.count()
    assert spark.sql("SELECT DISTINCT channel FROM chat_usage_report").first()[0] == "CHAT"


def test_functions(spark, sf):
    catalog.register_functions(spark)
    spark.createDataFrame([("2020-01-01T00:00Z", "2020-01-01T00:00:09.500Z"), ("", None)], "a string, b string"
                          ).createOrReplaceTempView("stamps")
    rows = spark.sql("""
        SELECT to_unixtime(from_iso8601_timestamp(b)) AS exact,
          CAST(whole_seconds(from_iso8601_timestamp(b)) - whole_seconds(from_iso8601_timestamp(a)) AS INT) AS d,
          service_charge(9) AS s, telephony_charge(NULL) AS t
        FROM stamps ORDER BY exact DESC""").collect()
    assert [tuple(r) for r in rows] == [(1577836809.5, 10, 10, None), (None, None, 10, None)]
