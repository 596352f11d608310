"""Conversation repair against a plain search over (turn, automaton state), and full CYK charts against cut ones."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallyline.llm import conversation_repair as repair
from tallyline.llm.common import table

NEXT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}


def cheapest(turns):
    """(cost, audit, lines) of ``turns`` (role, text, must go, truncated): least over all paths of a layered graph."""
    def closed(layer):
        for _ in range(2):
            for state, (cost, audit, lines) in list(layer.items()):
                for letter, to in NEXT[state].items():
                    if letter != "s":
                        name = "user" if letter == "u" else "assistant"
                        new = (cost + 2, audit + "I", lines + (f"{name}:",))
                        if to not in layer or new[:2] < layer[to][:2]:
                            layer[to] = new
        return layer

    layer = closed({0: (0, "", ())})
    for role, text, gone, cut in turns:
        after = {}

        def offer(state, new):
            if state not in after or new[:2] < after[state][:2]:
                after[state] = new

        for state, (cost, audit, lines) in layer.items():
            offer(state, (cost + 3, audit + "D", lines))
            if gone:
                continue
            for letter, to in NEXT[state].items():
                if role[:1] == letter:
                    offer(to, (cost + cut, audit + "K", lines + (f"{role}:{text}",)))
                if letter != "s":
                    name = "user" if letter == "u" else "assistant"
                    offer(to, (cost + 2 + cut, audit + "R", lines + (f"{name}:{text}",)))
        layer = closed(after)
    return min((layer[s] for s in (0, 3) if s in layer), key=lambda x: x[:2])


def expected(rows):
    """The contract on (conv_id, turn, role, text) rows, one conversation at a time."""
    kept, out = defaultdict(list), {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, None)
        harm = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
        role = "user" if harm == 4 else role
        kept[conv] += [(turn, role, text)] * (0 if harm == 0 else 2 if harm == 3 else 1)
    for conv in out:
        turns = sorted(kept[conv], key=lambda t: (t[0] is not None, t[0] or 0, t[1], hashlib.sha256(t[2].encode()).digest()))
        seen, faults, steps = set(), Counter(), []
        for _, role, text in turns:
            visible = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = "blank" if not visible else "duplicate" if (role, text) in seen else "truncated" if visible[-1] not in ".!?" else ""
            seen.add((role, text))
            faults[fault] += 1
            steps.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        numbers = [t[0] for t in turns if t[0] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        cost, audit, lines = cheapest(steps)
        out[conv] = (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def found(spark, rows, tmp_path, schema="conv_id long, turn long, role string, text string"):
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    return {r[0]: tuple(r)[1:] for r in repair.query(spark, str(tmp_path)).collect()}


def test_query(spark, sf):
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()
    got = {r[0]: tuple(r)[1:] for r in repair.query(spark, sf).collect()}
    assert got == expected(rows)
    assert len({r[6] for r in got.values()}) > 10


def test_odd_rows(spark, tmp_path):
    """Nulls, ties, repeated rows, empty roles and texts, and conversations that lose all rows."""
    dice = random.Random(5)
    roles = ["user", "assistant", "system", None, "", "tool", "User", "a", "su"]
    texts = ["Yes.", "no", None, "", " \t", "What?", "Yes. \n", "…", "x" * 70_000 + ".", "Yes.", "Yes."]
    rows = [(dice.choice([None, *range(40)]), dice.choice([None, 0, 1, 2, 3, 7, -4]), dice.choice(roles), dice.choice(texts))
            for _ in range(900)]
    rows += [rows[7]] * 30
    rows += [(1000 + i, i, "user", "Once.") for i in range(60)]  # single turns: some are dropped
    assert found(spark, rows, tmp_path) == expected(rows)


def test_one_conversation_over_many_tasks(spark, tmp_path):
    dice = random.Random(6)
    rows = [(9, turn, dice.choice(["user", "user", "assistant", "system", "tool"]), dice.choice([f"Line {turn}.", f"line {turn}", "Same."]))
            for turn in range(3000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    kept = repair.prepared(repair.damaged(turns), copies=F.col("copies"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ordered = repair.faulted(kept).repartitionByRange(*repair.ORDER)
        assert ordered.select(F.spark_partition_id()).distinct().count() > 2
        assert found(spark, rows, tmp_path) == expected(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_empty_table_and_clashing_columns(spark, tmp_path):
    schema = "conv_id long, turn long, role string, text string, copies string, digest int, audit string, harm int, `at` int"
    assert found(spark, [], tmp_path / "none", schema) == {}
    rows = [(1, t, r, f"Turn {t}.") for t, r in enumerate(["user", "assistant", "user"])]
    got = found(spark, [(*r, "x", 1, "y", 2, 3) for r in rows], tmp_path / "some", schema)
    assert got == expected(rows)


def full_cyk(kinds):
    """Every span, every cut."""
    n = len(kinds)
    charts = {(i, i + 1): repair.leaf(k) for i, k in enumerate(kinds)}
    for size in range(2, n + 1):
        for i in range(n - size + 1):
            best = {}
            for cut in range(i + 1, i + size):
                for symbol, cell in repair.concatenated(charts[i, cut], charts[cut, i + size]).items():
                    best[symbol] = min(cell, best.get(symbol, cell))
            charts[i, i + size] = best
    return charts[0, n]


@pytest.mark.parametrize("seed", range(20))
def test_one_cut_per_span_is_enough(seed):
    dice = random.Random(seed)
    kinds = "".join(dice.choice("uuaasxUASX-") for _ in range(dice.randint(1, 24)))
    assert repair.parse(kinds) == full_cyk(kinds)


def test_repaired_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Still here."), (1, 2, "tool", "Log."), (2, 0, "system", "Be kind.")]
    kept = repair.prepared(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    parsed = repair.parsed(repair.faulted(kept))
    assert {r.conv_id: r.audit for r in parsed.collect()} == {1: "KIKR", 2: "D"}
    out = [tuple(r) for r in repair.repaired(kept, parsed).orderBy("conv_id", "position").collect()]
    assert out == [(1, 0, "K", "user", "Hi."), (1, 1, "I", "assistant", ""), (1, 2, "K", "user", "Still here."),
                   (1, 3, "R", "assistant", "Log.")]
