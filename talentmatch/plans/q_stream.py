"""Streaming queries (X1, X2): run with availableNow, then read the sink."""

from __future__ import annotations

from pyspark.sql import functions as F

from talentmatch.operators import drift as D
from talentmatch.plans import fixtures as fx
from talentmatch.plans.q_analyze import ANALYZE_SQL, candidate_forms, linear_probability
from talentmatch.plans.q_drift import _SIDES_SQL, sides
from talentmatch.plans.q_recommend import _VECTORS_SQL
from talentmatch.plans.registry import query
from talentmatch.session import scratch_path
from talentmatch.streaming import streams as X


def _events_path(sf):
    return f"{sf.rstrip('/')}/events.parquet"


def _window_sql(width: str, slide: str | None):
    if slide is None:
        starts = f"SELECT time_bucket(INTERVAL '{width}', ts) AS window_start, event_type, value FROM events"
    else:
        # every window of ``width`` starting on a ``slide`` boundary that contains ts
        starts = f"""SELECT unnest(generate_series(time_bucket(INTERVAL '{slide}', ts) - INTERVAL '{width}' + INTERVAL '{slide}',
                                         time_bucket(INTERVAL '{slide}', ts), INTERVAL '{slide}')) AS window_start,
                  event_type, value FROM events"""
    return f"""
WITH b AS ({starts}),
w AS (SELECT window_start, window_start + INTERVAL '{width}' AS window_end, event_type,
             count(*) AS n, sum(value) AS total_value FROM b GROUP BY ALL)
SELECT window_start, window_end, event_type, n, round(total_value, 6) AS total_value FROM w
WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL '1 hour'"""


def _rounded(df):
    return df.withColumn("total_value", F.round("total_value", 6))


@query("stream_window_counts", sql=_window_sql("1 day", None))
def stream_window_counts(spark, sf):
    """Tumbling 1-day event-time counts per event_type, 1-hour watermark, append mode."""
    schema = fx.table(spark, sf, "events").schema
    return _rounded(X.run_window_counts(spark, _events_path(sf), schema))


@query("stream_sliding_counts", sql=_window_sql("1 day", "12 hours"))
def stream_sliding_counts(spark, sf):
    """Sliding 1-day windows every 12 hours, same watermark."""
    schema = fx.table(spark, sf, "events").schema
    return _rounded(X.run_window_counts(spark, _events_path(sf), schema, slide="12 hours"))


@query("stream_drift", sql=f"""
WITH {_SIDES_SQL},
p AS (SELECT event_type AS v, count(*) / sum(count(*)) OVER () AS p FROM ref GROUP BY 1),
w AS (SELECT time_bucket(INTERVAL '1 day', ts) AS window_start, event_type AS v, count(*) AS c FROM cur GROUP BY ALL),
t AS (SELECT window_start, sum(c) AS n FROM w GROUP BY 1
      HAVING window_start + INTERVAL '1 day' <= (SELECT max(ts) FROM cur) - INTERVAL '1 hour'),
j AS (SELECT t.window_start, t.n, coalesce(p.p, 0) AS p, coalesce(w.c, 0) / t.n AS q
      FROM t CROSS JOIN (SELECT v FROM p UNION SELECT v FROM w) a LEFT JOIN p ON p.v = a.v
      LEFT JOIN w ON w.v = a.v AND w.window_start = t.window_start),
s AS (SELECT window_start, any_value(n) AS n,
             sqrt(greatest(0, 0.5 * sum(CASE WHEN p > 0 THEN p * ln(2 * p / (p + q)) ELSE 0 END)
                            + 0.5 * sum(CASE WHEN q > 0 THEN q * ln(2 * q / (p + q)) ELSE 0 END))) AS js FROM j GROUP BY 1)
SELECT window_start, window_start + INTERVAL '1 day' AS window_end, CAST(n AS BIGINT) AS n, round(js, 6) AS statistic, js >= 0.1 AS drifted FROM s""")
def stream_drift(spark, sf):
    """X2 + D5: the second half of the events arrives as a stream; each closed day is held against the
    stored event_type distribution of the first half."""
    ref, cur = sides(spark, sf)
    path = D.reference_profile(ref, ["event_type"]).save(scratch_path(spark, "drift-reference"))
    first = cur.agg(F.min("event_id")).first()[0]
    out = X.run_window_drift(spark, _events_path(sf), fx.table(spark, sf, "events").schema, D.ReferenceProfile.load(spark, path),
                             where=f"event_id >= {first}")
    return out.withColumn("statistic", F.round("statistic", 6))


@query("stream_analyze", sql=ANALYZE_SQL)
def stream_analyze(spark, sf):
    """X1 whole: candidates arrive as a file stream; each micro-batch is validated, scored and matched."""
    job_vectors, details = fx.job_vectors(spark, sf), fx.job_details(spark, sf)
    vectors = fx.table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")

    def prepare(batch):
        return candidate_forms(batch).join(vectors, "doc_id", "left").withColumnRenamed("doc_id", "candidate_id")

    out = X.run_stream_analyze(spark, f"{sf.rstrip('/')}/documents.parquet", fx.table(spark, sf, "documents").schema,
                               prepare, linear_probability, job_vectors, details)
    return out.withColumn("violations", F.array_join("violations", ",")).withColumn("vagas_recomendadas", F.to_json("vagas_recomendadas", {"ignoreNullFields": "false"}))


@query("stream_recommend", sql=f"WITH {_VECTORS_SQL} SELECT * FROM top")
def stream_recommend(spark, sf):
    """Candidates arrive as a file stream; top-3 jobs per micro-batch."""
    schema = fx.table(spark, sf, "embeddings").schema
    return X.run_stream_recommend(spark, f"{sf.rstrip('/')}/embeddings.parquet", schema,
                                  fx.job_vectors(spark, sf))
