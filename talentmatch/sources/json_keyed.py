"""Keyed nested JSON documents (S1): ``{"<id>": {...}, "<id>": {...}}``.

A keyed document cannot be split inside (it is one JSON value), so the unit of
parallelism is the file: a data set is a folder of such documents ("shards"),
each parsed by one task with ``from_json`` into ``map<string, struct>`` and
exploded to one row per id. The writer produces as many shards as the data
needs (``shard_bytes``), so no task ever holds more than one shard. JSON
Lines ``{"id": .., "doc": {..}}`` is accepted as the row-splittable form.

Duplicate ids: a Python ``dict`` keeps the last value of a repeated key. The
reader keeps the value at the highest position with ``max_by`` (a partial
aggregate, so a hot id never lands whole in one task).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType, StructType


def _shards(spark: SparkSession, path: str, value_type, key_name: str) -> DataFrame:
    """(_file, _pos, key_name, doc) of all shards. An empty shard gives no rows; one that is not a whole
    JSON object fails the job and is named: no id is lost silently."""
    raw = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("_file"), "value")
    # the end is looked at, too: a shard cut short may still parse up to the cut
    cut = ~F.trim(F.regexp_replace("value", r"\s+$", "")).endswith("}")
    m = F.from_json("value", MapType(StringType(), value_type), {"mode": "PERMISSIVE"})
    whole = F.when(F.col("value").rlike(r"\S"),
                   F.when(m.isNull() | cut, F.raise_error(F.concat(F.lit("no JSON object: "), "_file"))).otherwise(m))
    return raw.select("_file", whole.alias("m")).select("_file", F.posexplode("m").alias("_pos", key_name, "doc"))


def _last_of_each(rows: DataFrame, key_name: str) -> DataFrame:
    return (rows.groupBy(key_name)
            .agg(F.max_by(F.struct("doc", "_pos"), F.struct("_file", "_pos")).alias("w"))
            .select(key_name, "w.doc", "w._pos"))


def read_keyed_json(spark: SparkSession, path: str, value_schema: StructType,
                    key_name: str = "id", dedupe: bool = True) -> DataFrame:
    """One row per id: ``(key_name, doc struct, _pos)``. An empty shard gives no rows; one that is
    not a whole JSON object fails the job and is named: no id is lost silently."""
    rows = _shards(spark, path, value_schema, key_name)
    return _last_of_each(rows, key_name) if dedupe else rows.drop("_file")


def read_keyed_variant(spark: SparkSession, path: str, key_name: str = "id", dedupe: bool = True) -> DataFrame:
    """S1 without a schema: ``(key_name, doc variant, _pos)``, one row per id.

    The documents need not fit one schema: ``field_as`` reads what is there, and a field that is
    missing or of another type is null. Shards and repeated ids as in ``read_keyed_json``. The id of a
    document that is null or no object, or names a field twice, is kept with a null document.
    """
    rows = _shards(spark, path, StringType(), key_name)
    rows = (_last_of_each(rows, key_name) if dedupe else rows.drop("_file")).withColumn("doc", F.try_parse_json("doc"))
    return rows.withColumn("doc", F.when(F.schema_of_variant("doc").startswith("OBJECT"), F.col("doc")))


def field_as(doc: str, path: str, kind: str = "string"):
    """A field of a variant column, or null where it is missing or cannot be read as ``kind``; objects and
    arrays are no strings."""
    read = F.try_variant_get(F.col(doc), path, kind)
    if kind != "string":
        return read
    return F.when(~F.schema_of_variant(F.try_variant_get(F.col(doc), path, "variant")).rlike("^(OBJECT|ARRAY)"), read)


def read_json_lines(spark: SparkSession, path: str, value_schema: StructType,
                    key_name: str = "id") -> DataFrame:
    """Row-splittable form: one ``{"id": .., "doc": {..}}`` per line."""
    schema = StructType().add(key_name, StringType()).add("doc", value_schema)
    return spark.read.schema(schema).json(path)


def write_keyed_text(df: DataFrame, key: str, json: str, path: str, shard_bytes: int = 32 << 20) -> str:
    """``write_keyed_json`` of documents that are JSON text already, each of any shape."""
    size = df.agg(F.sum(F.octet_length(json).cast("long"))).first()[0] or 0
    shards = max(1, math.ceil(size / shard_bytes))
    # the name as JSON: what stands between {"k": and }
    name = F.to_json(F.struct(F.col(key).cast("string").alias("k")))
    entry = F.concat(F.substring(name, F.lit(6), F.length(name) - 6), F.lit(":"), F.coalesce(F.col(json), F.lit("null")))
    out = (df.where(F.col(key).isNotNull()).select(entry.alias("e"), F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(shards)).alias("shard"))
           .groupBy("shard").agg(F.concat(F.lit("{"), F.array_join(F.collect_list("e"), ","), F.lit("}")).alias("value")).select("value"))
    out.write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)
    return path


def write_keyed_json(df: DataFrame, key: str, doc: str, path: str,
                     shard_bytes: int = 32 << 20) -> str:
    """Write ``(key, doc struct)`` rows as keyed JSON shards under ``path``.

    Rows are hashed into shards of about ``shard_bytes`` of JSON text; each shard is one
    ``collect_list`` of so many bytes turned into one JSON object.
    Null fields are left out, as a missing key in the source documents.
    """
    size = df.agg(F.sum(F.octet_length(F.to_json(F.col(doc))).cast("long"))).first()[0] or 0
    shards = max(1, math.ceil(size / shard_bytes))
    out = (df.select(F.col(key).cast("string").alias("k"), F.col(doc).alias("v"))
           .withColumn("shard", F.pmod(F.xxhash64("k"), F.lit(shards)))
           .groupBy("shard")
           .agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("k", "v")))).alias("value"))
           .select("value"))
    # one shard a file, however many one task writes
    out.write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)
    return path
