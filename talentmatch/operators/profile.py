"""Table profiling (A3, A4, O2): counts in one pass, types from the schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile_table(df: DataFrame) -> DataFrame:
    """A4: (column_name, non_null, data_type), one aggregate pass over the table.

    The aggregate yields one row with a count per column; ``stack`` turns it
    into one row per column.
    """
    fields = df.schema.fields
    counts = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(fields)])
    pairs = ", ".join(f"'{f.name}', c{i}, '{f.dataType.simpleString()}'" for i, f in enumerate(fields))
    return counts.selectExpr(f"stack({len(fields)}, {pairs}) as (column_name, non_null, data_type)")


def head_rows(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """O2: the first ``n`` rows by ``key`` (TakeOrderedAndProject, no full sort)."""
    return df.orderBy(key).limit(n)


def shape(df: DataFrame) -> DataFrame:
    """A3: (n_rows, n_columns)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))
