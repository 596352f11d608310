"""A run that works off what is there, after one that was stopped inside a micro-batch."""

import os

from tallyline.streaming.contacts import pending_contacts
from tests.test_fold import event, folders, replay


def test_a_repeated_batch_does_not_hide_new_events(spark):
    where = folders()
    replay(spark, [[event("a", 1, "Connected")]], where)
    commits = f"{where[3]}/fold/commits"
    last = max((n for n in os.listdir(commits) if n.isdigit()), key=int)
    for name in (last, f".{last}.crc"):
        if os.path.exists(f"{commits}/{name}"):
            os.remove(f"{commits}/{name}")
    records = replay(spark, [[event("b", 2, "Refresh", "error"), event("c", 3, "Connected")]], where)
    assert {r.contactId for r in records.collect()} == {"b"}
    assert {r.contactId for r in pending_contacts(spark, where[3]).collect()} == {"a", "c"}
