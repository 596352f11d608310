"""The order of the reports."""

import pytest

from tallyline.plans import reports
from tallyline.registry import fixtures as fx


@pytest.mark.parametrize("name", ["contact_usage", "connection_usage"])
def test_reports_come_newest_first(spark, sf, name):
    """Newest first, without a time last, ties by contact and connection; over several partitions."""
    contacts = fx.contacts(spark, sf)
    gap = contacts.limit(3).withColumn("InitiationTimestamp", contacts["ConnectedToSystemTimestamp"].substr(1, 0))
    some = contacts.withColumn("InitiationTimestamp", contacts["InitiationTimestamp"].substr(1, 10)).unionByName(gap.selectExpr(
        *[c if c != "InitiationTimestamp" else "cast(null as string) as InitiationTimestamp" for c in contacts.columns]))
    report = (reports.contact_usage(some) if name == "contact_usage" else reports.connection_usage(some, fx.connections(spark, sf)))
    keys = ["contactid"] if name == "contact_usage" else ["contactid", "connection_id"]
    rows = [(r.CTR_Initiation_Timestamp, *(r[k] for k in keys)) for r in report.collect()]
    times = [r[0] for r in rows]
    known = [t for t in times if t is not None]
    assert len(set(known)) < len(known) and None in times
    assert times == sorted(known, reverse=True) + [None] * (len(times) - len(known))
    for a, b in zip(rows, rows[1:]):
        if a[0] == b[0]:
            assert [(x is not None, x or "") for x in a[1:]] <= [(x is not None, x or "") for x in b[1:]]
