"""Readers for the JSON landing folders, batch and streaming."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.functions.text import percent_decode, split_objects
from tallyline.operators import ingest
from tallyline.operators.latest import latest_by_key
from tallyline.sources import schemas, spelling

# New objects taken into one micro-batch, so that a backlog is worked off in steps.
MAX_FILES_PER_BATCH = 10_000

EVENT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


OPTIONS = {"timestampFormat": EVENT_TIME_FORMAT}


def read_records(spark: SparkSession, path: str, schema: str | T.StructType, fields: list[str] | None = None,
                 any_spelling: bool = False) -> tuple[DataFrame, DataFrame]:
    """JSON lines under a prefix as (records, rejects), with a declared schema.

    A line may hold several objects. What does not parse, or has none of the
    declared fields, is a reject and keeps its text (``value``). ``fields``
    narrows parsing to the named (dotted) fields. With ``any_spelling`` keys
    are bound whatever their case; without it a field in another case is NULL.
    """
    schema = schemas.struct(schema) if isinstance(schema, str) else schema
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    narrowed = schema if fields is None else schemas.narrow(schema, fields)
    if not any_spelling:
        return ingest.repair(lines, narrowed, OPTIONS)
    bound = lines.transform(ingest.split_records).withColumn("_bound", declared_spelling(F.col("value"), narrowed))
    parsed = bound.transform(ingest.parse_records, narrowed, "_bound", OPTIONS).drop("_bound")
    return ingest.accepted(parsed), ingest.rejected(parsed)


def rejects(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """What a reader of the folder leaves out, one ``value`` per object or line."""
    return read_records(spark, path, schema)[1].select("value")


def contact_records(spark: SparkSession, path: str, fields: list[str] | None = None,
                    any_spelling: bool = False) -> DataFrame:
    """Contact records.

    The update time is read under the writer's name; the misspelt name that
    the table definition gives it is exposed next to it.
    """
    df = read_records(spark, path, schemas.CONTACT, fields, any_spelling)[0]
    if "LastUpdateTimestamp" in df.columns:
        df = df.withColumn("LastUpstringTimestamp", F.col("LastUpdateTimestamp"))
    return df


def call_connections(spark: SparkSession, path: str, fields: list[str] | None = None,
                     any_spelling: bool = False) -> DataFrame:
    """Call-connection records."""
    return read_records(spark, path, schemas.CONNECTION, fields, any_spelling)[0]


_RAW, _TYPED = "map<string,string>", "map<string,variant>"


def declared_spelling(text: Column, schema: T.StructType) -> Column:
    """JSON objects, joined by commas, with the keys of the declared fields in their declared spelling.

    Keys are bound object by object along the schema: a key in another case
    stands for a declared field of the object it is in, unless that object has
    the declared spelling too. What a field declared as text holds, such as
    free-form attributes, is what a read without binding gives. Lines without a
    key to bind, and what does not parse, stay as they are. In most others the
    keys are renamed where they stand; a line where that might bind more than
    this, such as one that has a name in both spellings, is taken apart.
    """
    names = schemas.field_names(schema)
    if len({n.lower() for n in names}) < len(names):
        return _taken_apart(text, schema)
    bound = spelling.renamed(schema)(text)
    return F.when(bound.isNull(), text).when(bound == "", _taken_apart(text, schema)).otherwise(bound)


def _taken_apart(text: Column, schema: T.StructType) -> Column:
    """The objects put together anew from their declared fields, where a key is in another case."""
    names = sorted(schemas.field_names(schema))
    keys = F.regexp_extract_all(text, F.lit(r'"(\w+)"\s*:'), F.lit(1))
    lower = F.array(*[F.lit(n.lower()) for n in names])
    odd = F.exists(keys, lambda k: ~k.isin(names) & F.array_contains(lower, F.lower(k)))
    objects = F.from_json(F.concat(F.lit("["), F.trim(text), F.lit("]")), "array<string>")
    bound = F.array_join(F.transform(objects, lambda o: _bound_object(o, schema)), ",")
    return F.when(odd, F.coalesce(bound, text)).otherwise(text)


def _bound_object(text: Column, kind: T.StructType) -> Column:
    """One object as JSON text, of its declared fields only; other text as a JSON value."""
    name_of = F.create_map(*[F.lit(x) for f in kind.fields for x in (f.name.lower(), f.name)])
    raw, typed = F.from_json(text, _RAW), F.from_json(text, _TYPED)
    entries = F.arrays_zip(F.map_keys(raw).alias("key"), F.map_values(raw).alias("raw"), F.map_values(typed).alias("typed"))

    def declared(e: Column) -> Column:
        name = F.try_element_at(name_of, F.lower(e["key"]))
        return name.isNotNull() & ((e["key"] == name) | ~F.array_contains(F.map_keys(raw), name))

    def member(e: Column) -> Column:
        low = F.lower(e["key"])
        value = F.lit("null")
        for f in kind.fields:
            value = F.when((low == f.name.lower()) & e["raw"].isNotNull(), _bound_value(e["raw"], e["typed"], f.dataType)).otherwise(value)
        return F.concat(F.lit('"'), F.element_at(name_of, low), F.lit('":'), value)

    members = F.transform(F.filter(entries, declared), member)
    return F.coalesce(F.concat(F.lit("{"), F.array_join(members, ","), F.lit("}")), _json_text(text))


def _bound_value(raw: Column, typed: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return _json_text(raw)
    as_it_is = F.to_json(typed)
    if isinstance(kind, T.StructType):
        return F.when(F.from_json(raw, _RAW).isNotNull(), _bound_object(raw, kind)).otherwise(as_it_is)
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        items = F.transform(F.from_json(raw, "array<string>"), lambda o: F.coalesce(_bound_object(o, kind.elementType), F.lit("null")))
        return F.coalesce(F.concat(F.lit("["), F.array_join(items, ","), F.lit("]")), as_it_is)
    if isinstance(kind, T.ArrayType):
        return F.when(F.trim(raw).startswith("["), raw).otherwise(as_it_is)
    return as_it_is


def _json_text(text: Column) -> Column:
    """Text as a JSON string."""
    wrapped = F.to_json(F.struct(text.alias("t")))
    return F.when(text.isNotNull(), F.substr(wrapped, F.lit(6), F.length(wrapped) - 6))


def agent_events(spark: SparkSession, path: str, fields: list[str] | None = None,
                 any_spelling: bool = False) -> DataFrame:
    return read_records(spark, path, schemas.AGENT_EVENT, fields, any_spelling)[0]


def chat_usage(spark: SparkSession, path: str, any_spelling: bool = False) -> DataFrame:
    """Message counts, the last written version of each chat; reads what the batch and the streaming job write."""
    rows = read_records(spark, path, schemas.CHAT_USAGE + ", written timestamp, source_object string",
                        any_spelling=any_spelling)[0]
    return latest_by_key(rows, ["instanceId", "contactId"], "written", "source_object").drop("written", "source_object")


def merged_chat_usage(spark: SparkSession, path: str) -> DataFrame:
    """The keyed table of message counts that the streaming job merges into: one row per chat, no versions to sort out."""
    return spark.read.parquet(path).drop("written", "source_object", "bucket")


def transcripts(spark: SparkSession, path: str) -> DataFrame:
    """Transcript documents, one or more JSON objects per file, with the file they came from."""
    return parse_transcripts(transcript_files(spark.read, path))


def transcript_files(reader, path: str | list[str], **options) -> DataFrame:
    """Whole files with where and when they were written; ``reader`` is of either kind."""
    return (reader.options(recursiveFileLookup="true", **options).text(path, wholetext=True)
            .select("value", F.col("_metadata.file_path").alias("source_object"),
                    F.col("_metadata.file_modification_time").alias("written")))


NOTICE = "Records array<struct<s3:struct<object:struct<key:string>>>>"


def notified_keys(lines: DataFrame) -> DataFrame:
    """``key``, each once, of the objects that object-created messages name; a message is a line, its keys percent-encoded."""
    found = F.from_json("value", schemas.struct(NOTICE))["Records"]
    keys = F.transform(found, lambda r: percent_decode(r["s3"]["object"]["key"]))
    return lines.select(F.explode(keys).alias("key")).filter(F.col("key") != "").distinct()


def unreadable_notices(lines: DataFrame) -> DataFrame:
    """The lines that name no object."""
    keys = F.from_json("value", schemas.struct(NOTICE))["Records"]["s3"]["object"]["key"]
    return lines.filter(~F.coalesce(F.exists(keys, lambda k: k != ""), F.lit(False)))


def stream_notices(spark: SparkSession, path: str, archive: str | None = None, max_bytes: int = 8 << 20) -> DataFrame:
    """Object-created messages as an unbounded table of lines.

    Messages that were taken move to ``archive``, or go if none is named, so
    what is listed for a micro-batch is what has come since, however many
    objects there are. ``max_bytes`` of messages make a micro-batch.
    """
    clean = {"cleanSource": "delete"} if archive is None else {"cleanSource": "archive", "sourceArchiveDir": archive}
    return spark.readStream.options(maxBytesPerTrigger=max_bytes, **clean).text(path)


def objects_at(spark: SparkSession, root: str, keys: list[str]) -> tuple[DataFrame, list[str]]:
    """The named objects under ``root``, whole, and the keys that are not there (any more). No folder is listed."""
    def there(key: str) -> bool:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/{key}")
        return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)

    def read(some: list[str]) -> DataFrame:
        # A key is a name and no pattern.
        plain = [re.sub(r"([\\{}\[\]*?,^])", r"\\\1", k) for k in some]
        return transcript_files(spark.read, [f"{root}/{k}" for k in plain])

    try:
        return read(keys), []
    except AnalysisException:
        kept = [k for k in keys if there(k)]
        missing = sorted(set(keys) - set(kept))
        empty = spark.createDataFrame([], "value string, source_object string, written timestamp")
        return (read(kept) if kept else empty), missing


def _document() -> Column:
    return F.from_json("value", schemas.struct(schemas.TRANSCRIPT))


def _documents(files: DataFrame) -> DataFrame:
    """The JSON objects of whole files that may hold several back to back, a row each; a blank file is one blank row."""
    pieces = split_objects("value")
    return ingest.unnest(files.withColumn("_pieces", F.when(F.size(pieces) > 0, pieces).otherwise(F.array("value"))),
                         "_pieces", "value", [c for c in files.columns if c != "value"])


def parse_transcripts(files: DataFrame) -> DataFrame:
    """The transcripts of a contact that the files hold."""
    return (_documents(files).select(_document().alias("d"), "source_object", "written")
            .filter(F.col("d.ContactId").isNotNull()).select("d.*", "source_object", "written"))


def broken_transcripts(files: DataFrame) -> DataFrame:
    """What else the files hold, text and all."""
    return _documents(files).filter(_document()["ContactId"].isNull())


def stream_lines(spark: SparkSession, path: str, max_files: int = MAX_FILES_PER_BATCH,
                 max_bytes: int | None = None) -> DataFrame:
    """Lines of a landing folder as an unbounded table; each new object is read once.

    A micro-batch takes at most ``max_files`` objects, or ``max_bytes`` bytes if given.
    """
    bound = {"maxFilesPerTrigger": max_files} if max_bytes is None else {"maxBytesPerTrigger": max_bytes}
    return spark.readStream.options(recursiveFileLookup="true", **bound).text(path)


def stream_json(spark: SparkSession, path: str, schema: str, max_files: int = MAX_FILES_PER_BATCH) -> DataFrame:
    """Records of a landing folder as an unbounded table. Rejects are left out; ``feeds.land_feed`` keeps them."""
    return ingest.repair(stream_lines(spark, path, max_files), schema, OPTIONS)[0]


def stream_transcripts(spark: SparkSession, path: str, max_files: int = MAX_FILES_PER_BATCH) -> DataFrame:
    """Transcript files as an unbounded table."""
    return transcript_files(spark.readStream, path, maxFilesPerTrigger=max_files)
