"""Truth table of the billed durations."""

import itertools
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tallyline.functions.time import (
    elapsed, epoch_seconds, iso_timestamp, minimum_charge, timestamp_quality, unix_time)
from tallyline.plans import reports

START = datetime(2024, 3, 1, 12, 0, 0, tzinfo=timezone.utc)


def iso(seconds: float | None) -> str | None:
    if seconds is None:
        return None
    stamp = START + timedelta(seconds=seconds)
    return stamp.strftime("%Y-%m-%dT%H:%M:%S.") + f"{stamp.microsecond // 1000:03d}Z"


def whole(seconds: float) -> int:
    return int((START + timedelta(seconds=seconds)).timestamp() * 1000 + 500) // 1000


def between(a, b):
    return None if a is None or b is None else whole(b) - whole(a)


def charge(d, least):
    return None if d is None else max(d, least)


CONTACT = ("ContactId string, InitialContactId string, Channel string, InitiationMethod string, "
           "InitiationTimestamp string, ConnectedToSystemTimestamp string, DisconnectTimestamp string, "
           "TransferCompletedTimestamp string, AWSAccountId string, InstanceARN string, "
           "Queue struct<Name:string>, SystemEndpoint struct<Address:string>, CustomerEndpoint struct<Address:string>, "
           "Agent struct<ARN:string, ConnectedToAgentTimestamp:string>, TransferredToEndpoint string")
RECORD = ("contactId string, inbound string, initialConnectionId string, connections array<struct<id:string, "
          "type:string, agentStatus:struct<extension:string, softPhoneEnabled:boolean>, "
          "endpoint:struct<type:string, phoneNumber:string>, endpointCountryISO:string, connectingTimestamp:string, "
          "connectedTimestamp:string, disconnectedTimestamp:string, history:array<struct<timestamp:string>>>>")

LENGTHS = [-5, 0, 9, 9.5, 10, 59, 59.5, 60, 61]


def contact_row(key, initial, method, length, transfer=None):
    return (key, initial, "VOICE", method, iso(0), iso(0.5), iso(length), iso(transfer), "a", "i", ("q",), ("s",), ("c",),
            ("agent", None), None)


def test_contact_metrics(spark):
    cases = list(itertools.product([None, "CALLBACK", "INBOUND"], LENGTHS, [None, 0.5]))
    rows = [contact_row(f"c{i}", None, method, length, transfer) for i, (method, length, transfer) in enumerate(cases)]
    report = {r["contactid"]: r for r in reports.contact_usage(spark.createDataFrame(rows, CONTACT)).collect()}
    for i, (method, length, transfer) in enumerate(cases):
        row = report[f"c{i}"]
        service = {None: None, "CALLBACK": between(0.5, length), "INBOUND": between(0, length)}[method]
        third, customer = between(transfer, length), between(0.5, length)
        got = [row[n] for n in row.__fields__ if "econds" in n]
        assert got == [service, third, customer, charge(service, 10), charge(third, 60), charge(customer, 60)]


def test_connection_metrics(spark):
    cases = list(itertools.product(
        [None, "CALLBACK", "INBOUND"], ["none", "own", "other"], [None, "c-first"], ["agent", "outbound", None],
        [True, False, None], [None, -5, 9, 60, 61.5]))
    contacts, records = [], []
    for i, (method, leg, initial, kind, soft, dropped) in enumerate(cases):
        contacts.append(contact_row(f"c{i}", initial, method, 30.25, 10))
        legs = [] if leg == "none" else [(
            f"c{i}" if leg == "own" else f"c{i}-2", kind, (None, soft), (None, None), None, iso(0), iso(0.5),
            iso(dropped), [])]
        records.append((f"c{i}", "true", None, legs))
    report = reports.connection_usage(spark.createDataFrame(contacts, CONTACT), spark.createDataFrame(records, RECORD))
    rows = {r["contactid"]: r for r in report.collect()}
    assert len(rows) == len(cases)
    for i, (method, leg, initial, kind, soft, dropped) in enumerate(cases):
        present = leg != "none"
        mine = leg == "own" or (leg == "none" and initial is None)
        service = desk = third = None
        if method == "INBOUND" and mine:
            service = between(0, 30.25)
        if method == "CALLBACK" and leg == "own":
            service = between(0.5, 30.25)
        if present and kind == "agent" and soft is False:
            desk = between(0.5, dropped)
        if leg == "other" and kind == "outbound":
            third = between(10, 30.25) if dropped is None else between(0.5, dropped)
        customer = between(0.5, 30.25) if mine else None
        want = [service, desk, third, customer,
                charge(service, 10), charge(desk, 60), charge(third, 60), charge(customer, 60)]
        row = rows[f"c{i}"]
        assert [row[n] for n in row.__fields__ if "econds" in n] == want, cases[i]


@pytest.mark.parametrize("text, want", [
    ("2020-01-01T05:00Z", "2020-01-01 05:00:00"),
    ("2020-01-01T05:00:00.25+01:00", "2020-01-01 04:00:00.25"),
    ("2020-01-01T05Z", "2020-01-01 05:00:00"),
    ("2020-01-01", "2020-01-01 00:00:00"),
    ("12:30:00", None), ("T12:30", None), ("", None), ("soon", None), (None, None),
])
def test_iso_text(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string").select(iso_timestamp("t").cast("string"))
    assert df.first()[0] == want


def test_rounding_is_half_away_from_zero(spark):
    rows = [("2020-01-01T00:00:02.500Z", 1577836803), ("2020-01-01T00:00:01.499Z", 1577836801),
            ("1969-12-31T23:59:57.500Z", -3), ("1969-12-31T23:59:57.501Z", -2)]
    df = spark.createDataFrame(rows, "t string, want bigint")
    df = df.select("want", epoch_seconds("t"), unix_time("t").cast("decimal(20,0)").cast("bigint"))
    assert all(row[0] == row[1] == row[2] for row in df.collect())


def test_each_end_is_rounded_before_subtracting(spark):
    df = spark.createDataFrame([("2020-01-01T00:00:00.400Z", "2020-01-01T00:00:01.500Z")], "a string, b string")
    assert df.select(elapsed("a", "b")).first()[0] == 2


def test_minimum_charge_keeps_unknown(spark):
    df = spark.createDataFrame([(None,), (-3,), (59,), (60,), (75,)], "d int")
    assert [r[0] for r in df.select(minimum_charge("d", 60)).collect()] == [None, 60, 60, 60, 75]


def test_timestamp_quality(spark):
    df = spark.createDataFrame([("2020-01-01", None), ("", "x"), (None, "2020-01-01T00:00:00Z")], "a string, b string")
    rows = {r["column"]: tuple(r)[1:] for r in timestamp_quality(df, "a", "b").collect()}
    assert rows == {"a": (2, 1, 1), "b": (2, 1, 1)}
