"""Repair, validation and unwrapping of raw records on the way in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.functions.text import from_base64, parse_objects, percent_decode, split_batch, split_objects, to_base64

OK = "Ok"
FAILED = "ProcessingFailed"


def unnest(df: DataFrame, array: str, to: str, keep: list[str]) -> DataFrame:
    """Explode a computed array; NULL elements, arrays and empty arrays give no rows.

    For a plain explode the optimizer adds a test that the array is not empty
    and pushes it below the computation, which is then done again for the test.
    """
    return df.select(*keep, F.explode_outer(array).alias(to)).filter(F.col(to).isNotNull())


def split_records(lines: DataFrame, value: str = "value") -> DataFrame:
    """One row per JSON object of a line that may hold several back to back."""
    rest = [c for c in lines.columns if c != value]
    return unnest(lines.withColumn("_pieces", split_objects(value)), "_pieces", value, rest)


def parse_records(lines: DataFrame, schema: str | T.StructType, value: str = "value",
                  options: dict[str, str] | None = None) -> DataFrame:
    """Tag each line ``Ok`` or ``ProcessingFailed``, keeping its text either way.

    ``records`` holds the parsed objects, NULL where parsing failed.
    """
    return lines.withColumn("records", parse_objects(value, schema, options)).withColumn(
        "result", F.when(F.size(F.array_compact("records")) > 0, OK).otherwise(FAILED))


def accepted(parsed: DataFrame, value: str = "value") -> DataFrame:
    """Objects of the good lines, one per row, next to the columns the line came with."""
    rest = [c for c in parsed.columns if c not in (value, "records", "result")]
    return unnest(parsed, "records", "record", rest).select(*rest, "record.*")


def rejected(parsed: DataFrame) -> DataFrame:
    """Lines for the error folder, as they arrived."""
    return parsed.filter(F.col("result") == FAILED).drop("records")


def repair(lines: DataFrame, schema: str | T.StructType, options: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Raw lines to (records, dead letters)."""
    parsed = lines.transform(split_records).transform(parse_records, schema, options=options)
    return accepted(parsed), rejected(parsed)


def status_counts(parsed: DataFrame) -> DataFrame:
    return parsed.groupBy("result").agg(F.count("*").alias("records"))


def check_envelope(lines: DataFrame, body: str = "body") -> DataFrame:
    """Validate submission envelopes.

    Adds ``valid`` and ``data``. The stream name has to be a string and the
    record an object; its data may be absent, but if present is a string.
    """
    def kind(path: str):
        return F.schema_of_variant(F.try_variant_get("_parsed", path, "variant"))

    valid = ((F.col("_name") == "STRING") & F.col("_record").startswith("OBJECT")
             & F.coalesce(F.col("_data") == "STRING", F.lit(True)))
    return (lines.withColumn("_parsed", F.try_parse_json(body))
            .withColumns({
                "_name": kind("$.DeliveryStreamName"),
                "_record": kind("$.Record"),
                "_data": kind("$.Record.Data"),
            })
            .withColumn("valid", F.coalesce(valid, F.lit(False)))
            .withColumn("data", F.when(F.col("valid"), F.try_variant_get("_parsed", "$.Record.Data", "string")))
            .drop("_parsed", "_name", "_record", "_data"))


def unwrap_batch(envelopes: DataFrame, schema: str, data: str = "data") -> DataFrame:
    """Parse the base64 batch of comma-joined objects in each envelope.

    A batch that does not parse as a whole is cut into its objects, so that a
    bad one does not void the others; a batch that does not decode keeps its
    text. ``rejected`` gives what failed.
    """
    text = from_base64(data)
    rows = envelopes.withColumn("_text", F.coalesce(text, F.col(data), F.lit("")))
    broken = text.isNotNull() & parse_objects("_text", schema).isNull()
    rest = [c for c in envelopes.columns if c != data]
    pieces = F.when(broken, split_batch("_text")).otherwise(F.array("_text"))
    cut = unnest(rows.withColumn("_pieces", pieces), "_pieces", "value", rest)
    return cut.transform(parse_records, schema)


def wrap_batch(records: DataFrame, *objects: str) -> DataFrame:
    """The inverse of ``unwrap_batch`` for rows whose ``objects`` are JSON texts."""
    joined = F.concat(F.concat_ws(",", *objects), F.lit("\n"))
    return records.withColumn("data", to_base64(joined))


def with_contact_id(records: DataFrame, key: str = "contactId") -> DataFrame:
    """Drop submissions that name no contact."""
    return records.filter(F.col(key).isNotNull() & (F.col(key) != ""))


def decode_keys(objects: DataFrame, key: str = "key") -> DataFrame:
    """Percent-decode the object keys of notifications."""
    return objects.withColumn(key, percent_decode(key))
