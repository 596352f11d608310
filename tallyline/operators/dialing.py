"""Country of a phone number, by the longest dialling prefix that matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# An international number has no more digits, so no longer prefix can match.
LONGEST_NUMBER = 15


def dialled_number(kind: Column, extension: Column, phone: Column) -> Column:
    """Agent legs are reached at the agent's extension, all others at the endpoint."""
    return F.when(kind == "agent", extension).otherwise(phone)


def digits(number: Column) -> Column:
    """Digits of an international number; NULL for anything not written as one."""
    plain = F.regexp_replace(number, r"[\s().-]", "")
    return F.when(plain.rlike(r"^\+[0-9]{3,15}$"), F.substr(plain, F.lit(2)))


# What the lookup table may hold, by its own count of bytes.
LOOKUP_BYTES = 8 << 20


def lookup_bytes(prefixes: DataFrame) -> int:
    """Bytes of a lookup table of ``prefix, iso`` rows: two limits of eight bytes a row, and the texts."""
    size = F.octet_length("prefix") + F.coalesce(F.octet_length("iso"), F.lit(0)) + F.lit(32)
    return prefixes.agg(F.sum(size)).first()[0] or 0


def country_of(rows: DataFrame, number: str, prefixes: DataFrame, to: str = "country",
               small: bool | None = None) -> DataFrame:
    """Add the ISO country of ``number`` from a ``prefix, iso`` dimension.

    The dimension is the caller's. Up to ``LOOKUP_BYTES`` of it are cut into
    disjoint ranges of numbers, and each number takes one binary search in
    one array: no join, whatever lengths the prefixes have, and the rows do not
    move. A larger one goes through shuffled joins on the distinct numbers.
    ``small`` passes on the outcome of an earlier size check.
    """
    if small is None:
        small = lookup_bytes(prefixes) <= LOOKUP_BYTES
    dim = prefixes.groupBy("prefix").agg(F.min("iso").alias("iso"))
    if small:
        return _by_ranges(rows, number, dim, to)
    return _by_shuffle(rows, number, dim, to)


def number_ranges(prefixes: list[tuple[str, str]]) -> tuple[list[int], list[str | None]]:
    """Where each range of number keys starts, in order, and its country; a range ends where the next starts.

    Prefixes nest, so a range belongs to the longest of those that cover it.
    """
    starts, isos, open_ends = [], [], []

    def begin(at: int, iso: str | None) -> None:
        if starts and starts[-1] == at:
            isos[-1] = iso
        else:
            starts.append(at)
            isos.append(iso)

    def close(until: int) -> None:
        while open_ends and open_ends[-1][0] <= until:
            end, _ = open_ends.pop()
            begin(end, open_ends[-1][1] if open_ends else None)

    keyed = sorted((_key_of(p), len(p), iso) for p, iso in prefixes)
    for at, length, iso in keyed:
        close(at)
        begin(at, iso)
        open_ends.append((at + BASE ** (LONGEST_NUMBER - length), iso))
    close(BASE ** LONGEST_NUMBER)
    return starts, isos


_BETWEEN, _NONE = "\x1f", "\x1e"

# A number is read in base 11, its digits as 1 to 10 and 0 for what it lacks to the
# longest, so that it comes after its prefixes and numbers that share one are a range.
BASE = 11


def _key_of(digits_text: str) -> int:
    key = 0
    for digit in digits_text.ljust(LONGEST_NUMBER, "/"):  # the character before "0"
        key = key * BASE + ord(digit) - ord("/")
    return key


def number_key(plain: Column) -> Column:
    """The same of a column of digits."""
    return F.conv(F.translate(F.rpad(plain, LONGEST_NUMBER, "/"), "/0123456789", "0123456789a"), BASE, 10).cast("bigint")


def _by_ranges(rows: DataFrame, number: str, dim: DataFrame, to: str) -> DataFrame:
    known = dim.filter(F.col("prefix").rlike(rf"^[0-9]{{1,{LONGEST_NUMBER}}}$"))
    starts, isos = number_ranges([tuple(r) for r in known.select("prefix", "iso").collect()])
    if not starts:
        return rows.withColumn(to, F.lit(None).cast("string"))
    # One text each, which the optimizer folds into an array that travels with the plan.
    starts_at = F.split(F.lit(",".join(map(str, starts))), ",").cast("array<bigint>")
    iso_at = F.split(F.lit(_BETWEEN.join(_NONE if iso is None else iso for iso in isos)), _BETWEEN)
    steps = [1 << n for n in reversed(range(len(starts).bit_length()))]
    key = number_key(digits(F.col(number)))
    # How many ranges start at the number or before it, found by halving.
    passed = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: F.when(
        F.get(starts_at, at + step - 1) <= F.col("_key"), at + step).otherwise(at))
    keep = rows.columns
    return rows.withColumn("_key", key).select(*keep, F.nullif(F.get(iso_at, passed - 1), F.lit(_NONE)).alias(to))


def _by_shuffle(rows: DataFrame, number: str, dim: DataFrame, to: str) -> DataFrame:
    numbers = rows.select(number, digits(F.col(number)).alias("_digits")).dropna().dropDuplicates([number])
    candidates = numbers.select(number, F.explode(F.transform(
        F.sequence(F.lit(1), F.length("_digits")), lambda n: F.substr("_digits", F.lit(1), n))).alias("prefix"))
    best = (candidates.join(dim, "prefix").groupBy(number)
            .agg(F.max_by("iso", F.length("prefix")).alias(to)))
    return rows.join(best, number, "left").select(*rows.columns, to)
