"""Benchmark: the five products on landed tables. Prints one JSON line.

The derived inputs are landed once, untimed, as Parquet; each query is then
timed from scan to a full write into a no-op sink. ``BENCH_SF_DIR`` names the
tables and ``BENCH_CPUS`` the local cores.
"""

from __future__ import annotations

import json
import os
import time

from tallyline.operators import contact_fold as fold
from tallyline.operators import messages
from tallyline.plans import reports
from tallyline.registry import fixtures as fx
from tallyline.session import local_session, scratch

RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    conf = {}
    if os.environ.get("BENCH_EVENT_LOG"):
        conf = {"spark.eventLog.enabled": "true", "spark.eventLog.compress": "false", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG"]}
    spark = local_session(cpus, "bench", **conf)

    def land(name, df):
        path = scratch(spark, name)
        df.repartition(8).write.parquet(path)
        return spark.read.parquet(path)

    contacts = land("contacts", fx.contacts(spark, sf_dir))
    connections = land("connections", fx.connections(spark, sf_dir))
    documents = land("transcripts", fx.transcripts(spark, sf_dir))
    items = land("items", fx.transcript_items(spark, sf_dir))
    events = land("calls", fx.call_events(spark, sf_dir))
    prefixes = fx.dial_prefixes(spark)

    queries = {
        "RPT-1": (contacts, lambda: reports.contact_usage(contacts)),
        "RPT-2": (connections, lambda: reports.connection_usage(contacts, connections)),
        "RPT-3": (items, lambda: reports.chat_report(
            messages.count_message_items(items, "instanceId", "contactId"), contacts)),
        "RPT-4": (documents, lambda: messages.count_messages(documents)),
        "RPT-5": (events, lambda: fold.contact_records(events, prefixes)),
    }
    seconds, rows = {}, {}
    for name, (source, build) in queries.items():
        best = None
        for run in range(RUNS):
            spark.sparkContext.setJobGroup(f"{name}/{run}", name)
            start = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
        rows[name] = source.count()
    print(json.dumps({
        "metric": "sum of the best of three runs per report", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "rows_per_sec": {name: round(rows[name] / seconds[name]) for name in seconds},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
