"""Repair of conversation structure by weighted CYK parsing over spans of turns.

A conversation is a string of turns, and a repair keeps, re-roles or deletes
each and inserts empty turns until the roles read ``(s?(ua)+)?``. The grammar is
in Chomsky normal form over the role strings that a span of turns can become::

    E        nothing                      S        a system turn
    ul..     an alternating string that begins with u and ends with l
    al..     the same from a              sl..     S, then an alternating string from u
    Xl -> Xk ml  (k and m differ)         sl -> S ul      X -> X E | E X
    start: E, ua, sa

A span's chart holds for each symbol its cheapest repair as (cost, audit), equal
costs to the ASCII-least audit. The least cell of a concatenation is made of
least cells, since audits of equal cost and one span are never prefixes of each
other: both have a letter per turn, and one more insertion would cost more. So
min over concatenation is associative, every way of cutting a span gives the same
chart, and one cut per span is enough: charts are combined bottom-up by span
length, in pairs, first within a task, then over the parts of a conversation.
Insertions are closed in at the leaves: the chart of the empty span (E, and u, a,
ua, au at their insertions) is concatenated before and after each turn. It holds
no longer string, for cutting two turns out of a run of insertions leaves its ends.

A hot conversation is split. Turns are dealt by ranges of (conversation, turn,
role, text digest), so a task parses a stretch of it, and only charts meet.
Equal rows are counted before they move. Texts take no part in the parse. Only the
repaired rows of one conversation, in order, pass through one task, a batch at a
time and never held, since the digest of a conversation is sequential.

Nulls and ties: a null role or text is one space, hence no role of the grammar, and
blank. Rows of one turn are ordered by role, then SHA-256 of their text; rows without a
turn come first. Null ids are one conversation. An empty role cannot be kept. Roles
go by their first character, as it is. A blank row is never a duplicate, nor a
duplicate truncated. Extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import stored, table

SYMBOLS = ("E", "S", "uu", "ua", "au", "aa", "su", "sa")
ACCEPTED = ("E", "ua", "sa")
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
VISIBLE, ENDS = r"[^\x20\x09-\x0D]", r"[.!?]"
LEGAL = {"su", "ua", "au"}

Chart = dict[str, tuple[int, str]]  # symbol -> (cost, audit)


def _rules() -> list[tuple[str, str, str]]:
    """(whole, left, right) of every production."""
    rules = [("E", "E", "E")] + [r for x in SYMBOLS[1:] for r in ((x, x, "E"), (x, "E", x))]
    strings = SYMBOLS[2:]
    rules += [(x[0] + y[1], x, y) for x in strings for y in strings if y[0] != "s" and x[1] != y[0]]
    return rules + [("s" + y[1], "S", y) for y in strings if y[0] == "u"]


RULES = _rules()


def concatenated(left: Chart, right: Chart) -> Chart:
    """The chart of two neighbouring spans as one."""
    out: Chart = {}
    for whole, a, b in RULES:
        if a in left and b in right:
            found = (left[a][0] + right[b][0], left[a][1] + right[b][1])
            if whole not in out or found < out[whole]:
                out[whole] = found
    return out


# What insertions alone can give.
EMPTY: Chart = {"E": (0, ""), "uu": (INSERT, "I"), "aa": (INSERT, "I"), "ua": (2 * INSERT, "II"), "au": (2 * INSERT, "II")}


def leaf(kind: str) -> Chart:
    """The chart of one turn. Its kind is the role's letter (``x``: none of the grammar), upper case where truncated; ``-`` must go."""
    chart: Chart = {"E": (DELETE, "D")}
    if kind != "-":
        more = TRUNCATED if kind.isupper() else 0
        chart |= {"uu": (REROLE + more, "R"), "aa": (REROLE + more, "R")}
        own = {"u": "uu", "a": "aa", "s": "S"}.get(kind.lower())
        if own:
            chart[own] = (more, "K")
    return reduce(concatenated, (EMPTY, chart, EMPTY))


@lru_cache(1 << 14)
def _short(kinds: str) -> Chart:
    """Charts of short spans, shared by all conversations that hold them."""
    if len(kinds) < 2:
        return leaf(kinds) if kinds else EMPTY
    cut = 1 << (len(kinds) - 1).bit_length() - 1
    return concatenated(_short(kinds[:cut]), _short(kinds[cut:]))


def paired(charts: list[Chart]) -> Chart:
    """The chart of all spans laid end to end: neighbours are combined in pairs, level by level."""
    while len(charts) > 1:
        charts = [concatenated(*charts[i:i + 2]) if i + 1 < len(charts) else charts[i] for i in range(0, len(charts), 2)]
    return charts[0] if charts else EMPTY


def parse(kinds: str) -> Chart:
    """The chart of a span of turns, given by their kinds."""
    return paired([_short(kinds[i:i + 8]) for i in range(0, len(kinds), 8)])


def answer(chart: Chart) -> tuple[int, str]:
    """Cost and audit of the best repair."""
    return min(chart[x] for x in ACCEPTED if x in chart)


def role_letter(role: str) -> str:
    return role[:1] if role[:1] in ("s", "u", "a") else "x"


def roles_of(rows: Iterator[tuple[str, str]], audit: str) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the repaired turns: ``rows`` are the (role, text) of the damaged ones, in order."""
    last = ""
    for edit in audit:
        if edit == "D":
            next(rows)
            continue
        wanted = "assistant" if last == "u" else "user"
        if edit == "I":
            role, text = wanted, ""
        else:
            own, text = next(rows)
            role = own if edit == "K" else wanted
        last = role[:1]
        yield edit, role, text


# --- over tables

def prepared(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
             copies: Column | None = None) -> DataFrame:
    """``conv_id, turn, role, text, digest, copies``: equal rows not yet counted together."""
    said = F.coalesce(F.col(text), F.lit(" "))
    return rows.select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"), said.alias("text"),
        F.unhex(F.sha2(said.cast("binary"), 256)).alias("digest"), (F.lit(1) if copies is None else copies).cast("long").alias("copies"))


ORDER = ["conv_id", "turn", "role", "digest"]


def faulted(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, digest, copies, blank, open, repeats`` of the different rows of ``prepared`` rows, without their texts.

    ``repeats`` of the copies are duplicates: all that are not the first of
    their role and text in the conversation.
    """
    text = F.col("text")
    blank = ~text.rlike(VISIBLE)
    closed = text.rlike(rf"{ENDS}[\x20\x09-\x0D]*\z")
    counted = stored(rows.select(*ORDER, "copies", blank.alias("blank"), (~closed).alias("open"))
                     .groupBy(*ORDER, "blank", "open").agg(F.sum("copies").alias("copies")), "repair-turns")
    first = counted.groupBy("conv_id", "role", "digest").agg(
        F.min("turn").alias("first"), F.bool_or(F.col("turn").isNull()).alias("none"))
    t, f = counted.alias("t"), first.alias("f")
    same = [F.col(f"t.{c}").eqNullSafe(F.col(f"f.{c}")) for c in ("conv_id", "role", "digest")]
    is_first = F.when(F.col("f.none"), F.col("t.turn").isNull()).otherwise(F.col("t.turn") == F.col("f.first"))
    return t.join(f, reduce(Column.__and__, same)).select("t.*", (F.col("copies") - is_first.cast("long")).alias("repeats"))


PART = ("conv_id long, turn long, role string, digest binary, chart array<struct<symbol: string, cost: long, audit: string>>, "
        "rows long, blank long, duplicate long, truncated long, illegal long, turns long, first string, last string, "
        "least long, most long")
RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_LONG, _TEXT = pa.int64(), pa.string()
_PART = pa.schema(
    [("conv_id", _LONG), ("turn", _LONG), ("role", _TEXT), ("digest", pa.binary()),
     ("chart", pa.list_(pa.struct([("symbol", _TEXT), ("cost", _LONG), ("audit", _TEXT)])))]
    + [(x, _LONG) for x in ("rows", "blank", "duplicate", "truncated", "illegal", "turns")]
    + [("first", _TEXT), ("last", _TEXT), ("least", _LONG), ("most", _LONG)])
_RESULT = pa.schema([(x, _LONG) for x in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [("audit", _TEXT)])


class _Part:
    """What a stretch of a conversation comes to; also sums stretches that follow each other."""

    COUNTS = ("rows", "blank", "duplicate", "truncated", "illegal", "turns")

    def __init__(self, row: dict):
        self.key = {c: row[c] for c in ORDER}
        self.kinds, self.charts = [], []
        self.sums = dict.fromkeys(self.COUNTS, 0)
        self.first = self.last = self.least = self.most = None

    def joint(self, first: str, turn) -> None:
        """What lies between this and what follows."""
        if self.last is not None and self.last + first not in LEGAL:
            self.sums["illegal"] += 1
        if turn is not None and turn == self.most:
            self.sums["turns"] -= 1

    def add(self, row: dict) -> None:
        n, repeats, letter = row["copies"], row["repeats"], row["role"][:1]
        self.joint(letter, row["turn"])
        self.first = letter if self.first is None else self.first
        self.last = letter
        self.sums["illegal"] += n - 1 if letter + letter not in LEGAL else 0
        if row["turn"] is not None:
            self.least = row["turn"] if self.least is None else self.least
            self.most = row["turn"]
            self.sums["turns"] += 1
        kind = role_letter(row["role"])
        self.sums["rows"] += n
        if row["blank"]:
            self.sums["blank"] += n
            kinds = "-" * n
        else:
            own = n - repeats
            self.sums["duplicate"] += repeats
            self.sums["truncated"] += own if row["open"] else 0
            kinds = (kind.upper() if row["open"] else kind) * own + "-" * repeats
        self.kinds.append(kinds)
        if len(self.kinds) >= 4096:
            self.settle()

    def follow(self, row: dict) -> None:
        self.joint(row["first"], row["least"])
        self.first = row["first"] if self.first is None else self.first
        self.last = row["last"]
        for name in self.COUNTS:
            self.sums[name] += row[name]
        self.least = row["least"] if self.least is None else self.least
        self.most = self.most if row["most"] is None else row["most"]
        self.charts.append({c["symbol"]: (c["cost"], c["audit"]) for c in row["chart"]})

    def settle(self) -> None:
        """Parse the turns held so far."""
        if self.kinds:
            self.charts.append(parse("".join(self.kinds)))
            self.kinds = []

    def row(self) -> dict:
        self.settle()
        chart = [{"symbol": x, "cost": c, "audit": a} for x, (c, a) in paired(self.charts).items()]
        return self.key | self.sums | {"chart": chart, "first": self.first, "last": self.last, "least": self.least, "most": self.most}


def _runs(batches, schema: pa.Schema, add, finish):
    """Rows in order of conversation: ``add`` each to its conversation's part, ``finish`` the part into a row."""
    part, out = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if part is None or part.key["conv_id"] != row["conv_id"]:
                if part is not None:
                    out.append(finish(part))
                part = _Part(row)
            add(part, row)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    if part is not None:
        yield pa.RecordBatch.from_pylist([finish(part)], schema)


def parsed(turns: DataFrame) -> DataFrame:
    """A row per conversation of ``faulted`` rows: ``gaps, blank, duplicate, truncated, illegal, cost, audit``."""
    def whole(part: _Part) -> dict:
        cost, audit = answer(paired(part.charts))
        gaps = 0 if part.most is None else part.most - part.least + 1 - part.sums["turns"]
        return {"conv_id": part.key["conv_id"], "gaps": min(gaps, (1 << 63) - 1), "cost": cost, "audit": audit} | {
            x: part.sums[x] for x in ("blank", "duplicate", "truncated", "illegal")}

    # Ranges cut through conversations, so a task has a stretch of the largest one at most.
    parts = (turns.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
             .mapInArrow(lambda b: _runs(b, _PART, _Part.add, _Part.row), PART))
    # A conversation has as many parts as tasks that it is spread over.
    return (parts.repartition("conv_id").sortWithinPartitions(*ORDER)
            .mapInArrow(lambda b: _runs(b, _RESULT, _Part.follow, whole), RESULT))


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``conv_id, position, edit, role, text`` of every conversation after repair; ``rows`` as ``prepared``, ``found`` as ``parsed``.

    The rows of a conversation are next to each other and in order, in one partition.
    """
    audits = found.select("conv_id", F.lit(0).alias("at"), F.lit(None).cast("long").alias("turn"), F.col("audit").alias("role"),
                          F.lit(None).cast("string").alias("text"), F.lit(None).cast("binary").alias("digest"),
                          F.lit(1).cast("long").alias("copies"))
    turns = rows.select("conv_id", F.lit(1).alias("at"), "turn", "role", "text", "digest", "copies")
    schema = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("edit", pa.string()), ("role", pa.string()),
                        ("text", pa.string())])

    def run(batches):
        out, size = [], 0
        feed = (row for batch in batches for part in range(0, batch.num_rows, 256) for row in batch.slice(part, 256).to_pylist())
        held = next(feed, None)
        while held is not None:  # held is a conversation's audit
            conv, audit = held["conv_id"], held["role"]
            held = None

            def said():
                nonlocal held
                for row in feed:
                    if row["at"] == 0:
                        held = row
                        return
                    for _ in range(row["copies"]):
                        yield row["role"], row["text"]

            turns = said()
            for position, (edit, role, text) in enumerate(roles_of(turns, audit)):
                out.append({"conv_id": conv, "position": position, "edit": edit, "role": role, "text": text})
                size += len(text) + 64
                if size > 1 << 22:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out, size = [], 0
            for _ in turns:  # runs on to the next conversation
                pass
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return (audits.unionByName(turns).repartition("conv_id").sortWithinPartitions("conv_id", "at", "turn", "role", "digest")
            .mapInArrow(run, "conv_id long, position long, edit string, role string, text string"))


def digests(lines: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256`` of ``repaired`` rows: of ``role:text`` lines. Reads the rows in the order they come."""
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])

    def run(batches):
        state = conv = None
        for batch in batches:
            done = []
            for c, role, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if state is None or c != conv:
                    if state is not None:
                        done.append({"conv_id": conv, "repaired_sha256": state.hexdigest()})
                    state, conv = hashlib.sha256(), c
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode())
            if done:
                yield pa.RecordBatch.from_pylist(done, schema)
        if state is not None:
            yield pa.RecordBatch.from_pylist([{"conv_id": conv, "repaired_sha256": state.hexdigest()}], schema)

    return lines.select("conv_id", "role", "text").mapInArrow(run, "conv_id long, repaired_sha256 string")


def damaged(rows: DataFrame) -> DataFrame:
    """The contract's damage to ``conv_id, turn, role, text`` rows, with ``copies``."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
                       (F.crc32(key.cast("binary")) % 20).alias("harm"))
    harm = F.col("harm")
    text = F.when(harm == 1, "").when(harm == 2, F.regexp_replace("text", ENDS, "")).otherwise(F.col("text"))
    return rows.filter(harm != 0).select(
        "conv_id", "turn", F.when(harm == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.when(harm == 3, 2).otherwise(1).alias("copies"))


EMPTY_DIGEST = hashlib.sha256(b"").hexdigest()


def query(spark, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    rows = prepared(damaged(given), copies=F.col("copies"))
    found = stored(parsed(faulted(rows)), "repair-parsed")
    hashed = digests(repaired(rows, found))
    ids = given.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()

    def with_own(left: DataFrame, right: DataFrame) -> DataFrame:
        right = right.withColumnRenamed("conv_id", "_conv")
        return left.join(right, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")

    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return with_own(with_own(ids, found), hashed).select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(EMPTY_DIGEST)).alias("repaired_sha256"))
