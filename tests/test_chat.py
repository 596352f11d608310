"""Chat message counting."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallyline.operators.messages import count_message_items, count_messages
from tallyline.sources import schemas

items = st.lists(st.tuples(st.sampled_from(["MESSAGE", "EVENT", None]),
                           st.sampled_from(["SYSTEM", "CUSTOMER", "AGENT", "SUPERVISOR", None])), max_size=8)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), items), min_size=1, max_size=6))
def test_counts(spark, transcripts):
    rows = [(f"c{i}", "i", t) for i, t in enumerate(transcripts)]
    counted = {r.contactId: r for r in count_messages(spark.createDataFrame(rows, schemas.TRANSCRIPT)).collect()}
    assert len(counted) == len(rows)
    for key, _, transcript in rows:
        roles = [role for kind, role in transcript or [] if kind == "MESSAGE"]
        row = counted[key]
        assert (row.system_msg, row.customer_msg, row.agent_msg) == tuple(map(roles.count, ["SYSTEM", "CUSTOMER", "AGENT"]))
        assert row.total_msg == row.system_msg + row.customer_msg + row.agent_msg


def test_both_layouts_agree(spark):
    rows = [("a", "MESSAGE", "AGENT"), ("a", "MESSAGE", "SYSTEM"), ("a", "EVENT", "AGENT"), ("b", None, None)]
    flat = count_message_items(spark.createDataFrame(rows, "contactId string, Type string, ParticipantRole string"), "contactId")
    docs = spark.createDataFrame([("a", "i", [(k, r) for _, k, r in rows[:3]]), ("b", "i", [])], schemas.TRANSCRIPT)
    assert sorted(map(tuple, flat.collect())) == sorted(tuple(r)[1:] for r in count_messages(docs).collect())
