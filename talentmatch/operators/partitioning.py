"""Partitioning helper.

``spread``: CPU-heavy row work (regexes over whole texts, vector scoring)
should use every core. A scan of fewer files than cores yields fewer tasks;
then a round-robin repartition spreads the rows before the heavy expressions
run. With files enough (any cluster-size table) the plan is left as it is.
Only the file listing is consulted: nothing is planned or run for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, key: str | None = None, min_partitions: int | None = None) -> DataFrame:
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if len(df.inputFiles()) >= target:
        return df
    return df.repartition(target, key) if key else df.repartition(target)
