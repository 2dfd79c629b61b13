"""talentmatch: candidate / job matching analytics as Spark DataFrame operators.

Layout
------
sources/    keyed nested JSON, CSV, Parquet, vector and model stores
functions/  column expressions (text rules, NA tokens, cosine, sanitising)
operators/  DataFrame -> DataFrame operators (curation, joins, features,
            sampling, evaluation, training, recommendation, drift, profiling)
plans/      the driver-table stand-ins for the domain tables and the
            registered queries with their SQL oracles
streaming/  Structured Streaming scoring and windowed drift counts
"""

__version__ = "0.1.0"
