"""Longest dialling prefix, by broadcast and by shuffle."""

import random

import pytest
from pyspark.sql import functions as F

from tallyline.operators import dialing
from tallyline.operators.dialing import country_of
from tallyline.session import configure


@pytest.mark.parametrize("small", [True, False])
def test_longest_prefix_of_any_length(spark, small):
    prefixes = spark.createDataFrame([("1", "US"), ("12345678", "ZZ"), ("123456789012345", "YY")], "prefix string, iso string")
    rows = spark.createDataFrame([("+12345678901",), ("+1 234 567-0000",), ("+123456789012345",), ("+4930123",), (None,)], "number string")
    got = {r.number: r.country for r in country_of(rows, "number", prefixes, small=small).collect()}
    assert got == {"+12345678901": "ZZ", "+1 234 567-0000": "US", "+123456789012345": "YY", "+4930123": None, None: None}
    assert country_of(rows, "number", prefixes.limit(0), small=small).filter("country is not null").count() == 0


def test_shuffles_follow_the_input_without_a_limit(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        configure(spark, 100 * 2**40)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "819200"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def longest(number, prefixes):
    fits = [p for p in prefixes if number.startswith(p)]
    return prefixes[max(fits, key=len)] if fits else None


def test_ranges_against_every_prefix(spark):
    """Nested, neighbouring and very long prefixes, numbers at and around each limit."""
    dice = random.Random(4)
    digits = lambda n: "".join(dice.choice("0129") for _ in range(n))
    prefixes = {digits(dice.choice([1, 2, 2, 3, 3, 4, 6, 9, 15])): f"c{n}" for n in range(400)}
    numbers = {digits(dice.randint(3, 15)) for _ in range(3000)} | {p.ljust(n, d)[:15] for p in prefixes for n in (3, 9, 15) for d in "09"}
    rows = spark.createDataFrame([("+" + n,) for n in numbers if len(n) >= 3], "number string")
    dim = spark.createDataFrame(list(prefixes.items()) + [("12x", "no"), ("", "no"), ("9" * 16, "no")], "prefix string, iso string")
    for small in (True, False):
        got = {r.number: r.country for r in country_of(rows, "number", dim, small=small).collect()}
        assert got == {n: longest(n[1:], prefixes) for n in got}
    starts, isos = dialing.number_ranges(list(prefixes.items()))
    assert starts == sorted(set(starts)) and len(starts) == len(isos)


def test_no_join_for_any_number_of_lengths(spark):
    dim = spark.createDataFrame([("1" * n, f"c{n}") for n in range(1, 16)], "prefix string, iso string")
    rows = spark.range(10).select(F.concat(F.lit("+1111"), "id").alias("number"))
    plan = country_of(rows, "number", dim)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_size_is_counted_in_bytes(spark, monkeypatch):
    dim = spark.range(1000).select(F.col("id").cast("string").alias("prefix"), F.lit("XX").alias("iso"))
    assert dialing.lookup_bytes(dim) == 2890 + 34 * 1000
    monkeypatch.setattr(dialing, "LOOKUP_BYTES", 30_000)
    rows = spark.createDataFrame([("+12345",)], "number string")
    got = country_of(rows, "number", dim)
    assert "Join" in got._jdf.queryExecution().executedPlan().toString() and got.first().country == "XX"
