"""File sources and sinks (S2-S7, S9): CSV, Parquet and vector tables.

Writers are plain Spark writers with ``overwrite`` (they create folders, S11);
readers always take an explicit schema (no inference pass over the data).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from talentmatch.functions import vectors as V
from talentmatch.operators.curate import na_tokens, sanitize_frame

CSV_OPTIONS = {
    "header": "true", "quote": '"', "escape": '"', "multiLine": "true",
    # keep white space and empty strings as they are
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


#: Bytes of a CSV file, about: a file with quoted line breaks cannot be split, so it is one task's work.
CSV_FILE_BYTES = 64 << 20


def write_csv(df: DataFrame, path: str, file_bytes: int = CSV_FILE_BYTES) -> str:
    """Header, quoted multi-line text, overwrite; in files of about ``file_bytes``, so that reading
    them back is spread over tasks."""
    width = F.octet_length(F.to_csv(F.struct(*[F.col(c).cast("string").alias(c) for c in df.columns])))
    mean = df.agg(F.avg(width)).first()[0] or 1.0           # one number
    (df.write.mode("overwrite").options(**CSV_OPTIONS).option("emptyValue", '""')
     .option("maxRecordsPerFile", max(1, int(file_bytes / max(mean, 1.0)))).csv(path))
    return path


def read_csv(spark: SparkSession, path: str, schema: StructType, reload_nulls: bool = True) -> DataFrame:
    """Header, explicit schema, multi-line quoted text; NA tokens -> null (F16)."""
    df = spark.read.options(**CSV_OPTIONS).schema(schema).csv(path)
    return na_tokens(df) if reload_nulls else df


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """S4."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)


def export_unified(df: DataFrame, path: str) -> str:
    """S6 re-aimed: sanitise every string (P17), whole, and write Parquet."""
    return write_parquet(sanitize_frame(df), path)


def write_vectors(df: DataFrame, key: str, vec: str, path: str) -> str:
    """Vectors keyed by id (never by row position), with their norms."""
    return write_parquet(df.select(key, F.col(vec).cast("array<float>").alias("embedding"),
                                   V.l2_norm(vec).alias("norm")), path)


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
