"""Text, JSON and wire-encoding helpers."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.functions.time import _column

# A run of JSON text up to a closing brace that another object follows. String
# literals are skipped whole, so braces inside them do not count. All loops are
# possessive and therefore safe on long lines.
ONE_OBJECT = r'(?:[^"}]++|"(?:[^"\\]++|\\.)*+"|\}(?!\s*\{))*+\}?'


def loose_boolean(value: Column | str) -> Column:
    """Boolean of a boolean or string column; NULL when the text is neither."""
    return _column(value).try_cast("boolean")


def proper_case(text: Column | str) -> Column:
    """Capital first letter, lower rest, for each word of a phrase.

    A word runs from its first letter, digit or underscore to the next space,
    so leading punctuation is passed over where ``initcap`` would stop at it.
    """
    def one(piece: Column) -> Column:
        lead = F.regexp_extract(piece, r"^[^A-Za-z0-9_]*", 0)
        at = F.length(lead)
        return F.concat(
            lead,
            F.upper(F.substr(piece, at + 1, F.lit(1))),
            F.lower(F.substr(piece, at + 2)),
        )

    return F.array_join(F.transform(F.split(_column(text), r"(?<=\s)"), one), "")


def percent_decode(text: Column | str) -> Column:
    """Decode %XX escapes and leave plus signs alone."""
    return F.try_url_decode(F.replace(_column(text), F.lit("+"), F.lit("%2B")))


def from_base64(text: Column | str) -> Column:
    """Text of a base64 value; NULL when it does not decode."""
    return F.try_to_binary(_column(text), F.lit("base64")).cast("string")


def to_base64(text: Column | str) -> Column:
    """Base64 on one line (the built-in breaks long values into lines)."""
    return F.regexp_replace(F.base64(F.encode(_column(text), "UTF-8")), r"[\r\n]", "")


def split_objects(text: Column | str) -> Column:
    """Pieces of a line that holds several JSON objects back to back.

    A line that does not tokenise, such as one with an unclosed quote, comes
    back as a single piece so that nothing is lost.
    """
    text = _column(text)
    pieces = F.regexp_extract_all(text, F.lit(ONE_OBJECT), F.lit(0))
    whole = F.length(F.array_join(pieces, "")) == F.length(text)
    split = F.when(whole, F.filter(F.transform(pieces, lambda p: F.trim(p)), lambda p: p != "")).otherwise(F.array(text))
    single = ~_back_to_back(text) & (F.trim(text) != "")
    return F.when(single, F.array(text)).otherwise(split)


def _back_to_back(text: Column) -> Column:
    """Whether a closing brace is followed by an opening one, or space and one.

    Cutting at a character takes a fraction of the time of a pattern that is tried at each. What is before the first closing
    brace does not count, so it is made to begin with something else.
    """
    after = F.split(F.concat(F.lit('"'), text), r"\}")
    return F.exists(after, lambda p: p.startswith("{") | (F.ascii(p).between(9, 32) & p.rlike(r"^\s+\{")))


def split_batch(text: Column | str) -> Column:
    """The comma-joined JSON values of a batch, cut where brackets outside string literals are closed.

    What stays open to the end is the last piece, so nothing is lost.
    """
    def closed(piece: Column) -> Column:
        bare = F.regexp_replace(piece, r'"(?:[^"\\]++|\\.)*+"', "")
        return (~bare.contains('"') & (F.regexp_count(bare, F.lit(r"\{")) == F.regexp_count(bare, F.lit(r"\}")))
                & (F.regexp_count(bare, F.lit(r"\[")) == F.regexp_count(bare, F.lit(r"\]"))))

    def add(seen: Column, part: Column) -> Column:
        now = F.concat_ws(",", seen["open"], part)
        return F.when(closed(now), F.struct(
            F.concat(seen["done"], F.array(now)).alias("done"), F.lit(None).cast("string").alias("open"))).otherwise(
            F.struct(seen["done"].alias("done"), now.alias("open")))

    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit(None).cast("string").alias("open"))
    return F.aggregate(F.split(_column(text), ","), start, add,
                       lambda s: F.when(s["open"].isNull(), s["done"]).otherwise(F.concat(s["done"], F.array(s["open"]))))


def parse_objects(text: Column | str, schema: str | T.StructType, options: dict[str, str] | None = None) -> Column:
    """Array of the comma-joined JSON objects in ``text``; NULL if malformed, empty if blank.

    Wrapping in brackets matters: parsed on its own, a line keeps its first
    object and drops the others without a sign. An object with none of the
    declared fields is NULL in the array.
    """
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    found = F.from_json(F.concat(F.lit("["), F.trim(_column(text)), F.lit("]")), T.ArrayType(kind), options)
    return F.transform(found, lambda o: F.when(reduce(or_, [o[f].isNotNull() for f in kind.names]), o))
