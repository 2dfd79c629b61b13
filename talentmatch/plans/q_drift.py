"""Drift and profiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from talentmatch.operators import drift as D
from talentmatch.operators import profile as P
from talentmatch.plans import fixtures as fx
from talentmatch.plans.registry import query
from talentmatch.session import scratch_path

# reference = first half of the event_id range, current = second half
_HALF = "(SELECT min(event_id) + (max(event_id) - min(event_id) + 1) / 2 FROM events)"
_SIDES_SQL = f"""
ref AS (SELECT * FROM events WHERE event_id < {_HALF}),
cur AS (SELECT * FROM events WHERE event_id >= {_HALF})"""


def sides(spark, sf):
    ev = fx.table(spark, sf, "events")
    b = ev.agg(F.min("event_id").alias("lo"), F.max("event_id").alias("hi")).collect()[0]  # two numbers
    half = b["lo"] + (b["hi"] - b["lo"] + 1) / 2
    return ev.where(F.col("event_id") < half), ev.where(F.col("event_id") >= half)


@query("drift_prepare", sql=f"""
WITH {_SIDES_SQL}
SELECT 'reference' AS side, event_id, nullif(event_type, 'error') AS event_type, ts, user_id, value
FROM ref WHERE event_type <> 'error'
UNION ALL SELECT 'current', event_id, event_type, ts, user_id, value FROM cur""")
def drift_prepare(spark, sf):
    """Reference rows with nulls dropped ('error' made null there); shared columns only."""
    ref, cur = sides(spark, sf)
    ref = ref.withColumn("event_type", F.expr("nullif(event_type, 'error')"))
    cur = cur.drop("props")
    r, c = D.prepare(ref, cur)
    return r.select(F.lit("reference").alias("side"), *r.columns).unionByName(
        c.select(F.lit("current").alias("side"), *c.columns))


# every column of events, and whether it is a number
_COLUMNS = {"event_id": True, "ts": False, "user_id": True, "event_type": False, "value": True, "props": False}


def _plan_sql(c: str, numeric: bool) -> str:
    kind = f"CASE WHEN count(DISTINCT {c}) > 5 THEN 'num' ELSE 'cat' END" if numeric else "'cat'"
    return f"""SELECT "column", kind, n_ref, n_unique,
       CASE WHEN n_ref > 1000 THEN (CASE WHEN kind = 'num' THEN 'wasserstein' ELSE 'jensenshannon' END)
            WHEN kind = 'num' THEN 'ks' WHEN n_unique <= 2 THEN 'z' ELSE 'chisquare' END AS test,
       CAST(CASE WHEN n_ref <= 1000 THEN 0.05 ELSE 0.1 END AS DOUBLE) AS threshold
FROM (SELECT '{c}' AS "column", {kind} AS kind, count(*) AS n_ref, count(DISTINCT {c}) AS n_unique FROM ref)"""


@query("drift_plan", sql=f"WITH {_SIDES_SQL} " + " UNION ALL ".join(_plan_sql(c, n) for c, n in _COLUMNS.items()))
def drift_plan(spark, sf):
    """Test per column from type, cardinality and reference size, over every column."""
    ref, _ = sides(spark, sf)
    return D.plan(ref, ref.columns)


_SHARES_SQL = f"""
{_SIDES_SQL},
r AS (SELECT event_type AS v, count(*) AS n_ref FROM ref GROUP BY 1),
c AS (SELECT event_type AS v, count(*) AS n_cur FROM cur GROUP BY 1),
j AS (SELECT coalesce(n_ref, 0) AS n_ref, coalesce(n_cur, 0) AS n_cur FROM r FULL OUTER JOIN c USING (v)),
s AS (SELECT n_ref, n_cur, n_ref / sum(n_ref) OVER () AS p_ref, n_cur / sum(n_cur) OVER () AS p_cur,
             sum(n_cur) OVER () AS tot_cur FROM j)"""


@query("drift_chi2", sql=f"""
WITH {_SHARES_SQL}
SELECT round(sum((n_cur - p_ref * tot_cur) ^ 2 / (p_ref * tot_cur)), 6) AS statistic,
       CAST(count(*) - 1 AS BIGINT) AS dof FROM s""")
def drift_chi2(spark, sf):
    """D3: chi-square of current event_type counts against reference shares."""
    ref, cur = sides(spark, sf)
    return D.chi_square(ref, cur, "event_type").select(F.round("statistic", 6).alias("statistic"),
                                                        F.col("dof").cast("bigint"))


@query("drift_z", sql=f"""
WITH {_SIDES_SQL},
a AS (SELECT (SELECT count(*) FROM ref) AS n1, (SELECT count(*) FROM ref WHERE event_type = 'purchase') AS k1,
             (SELECT count(*) FROM cur) AS n2, (SELECT count(*) FROM cur WHERE event_type = 'purchase') AS k2),
p AS (SELECT *, (k1 + k2) / (n1 + n2) AS pp FROM a)
SELECT round((k2 / n2 - k1 / n1) / sqrt(pp * (1 - pp) * (1 / n1 + 1 / n2)), 6) AS statistic FROM p""")
def drift_z(spark, sf):
    """D3 binary: two-proportion z of 'is purchase'."""
    ref, cur = sides(spark, sf)
    flag = F.col("event_type") == "purchase"
    return D.z_two_proportions(ref, cur, flag).select(F.round("statistic", 6).alias("statistic"))


@query("drift_js", sql=f"""
WITH {_SHARES_SQL},
m AS (SELECT p_ref, p_cur, (p_ref + p_cur) / 2 AS m FROM s)
SELECT round(sqrt(greatest(0, 0.5 * sum(CASE WHEN p_ref > 0 THEN p_ref * ln(p_ref / m) ELSE 0 END)
                            + 0.5 * sum(CASE WHEN p_cur > 0 THEN p_cur * ln(p_cur / m) ELSE 0 END))), 6)
       AS statistic FROM m""")
def drift_js(spark, sf):
    """Jensen-Shannon distance of event_type shares."""
    ref, cur = sides(spark, sf)
    return D.jensen_shannon(ref, cur, "event_type").select(F.round("statistic", 6).alias("statistic"))


_CDF_SQL = f"""
{_SIDES_SQL},
b AS (SELECT value AS x, 1 AS r, 0 AS c FROM ref UNION ALL SELECT value, 0, 1 FROM cur),
g AS (SELECT x, sum(r) AS nr, sum(c) AS nc FROM b WHERE x IS NOT NULL GROUP BY x),
cdf AS (SELECT x, sum(nr) OVER (ORDER BY x) / sum(nr) OVER () AS fr,
               sum(nc) OVER (ORDER BY x) / sum(nc) OVER () AS fc, lead(x) OVER (ORDER BY x) AS nx FROM g)"""


@query("drift_ks", sql=f"WITH {_CDF_SQL} SELECT round(max(abs(fr - fc)), 6) AS statistic FROM cdf")
def drift_ks(spark, sf):
    """Two-sample Kolmogorov-Smirnov statistic of value."""
    ref, cur = sides(spark, sf)
    return D.ks_statistic(ref, cur, "value").select(F.round("statistic", 6).alias("statistic"))


@query("drift_wasserstein", sql=f"""
WITH {_CDF_SQL}
SELECT round(sum(CASE WHEN nx IS NOT NULL THEN abs(fr - fc) * (nx - x) ELSE 0 END)
             / (SELECT stddev_pop(value) FROM ref), 6) AS statistic FROM cdf""")
def drift_wasserstein(spark, sf):
    """Wasserstein-1 distance of value, divided by the reference std."""
    ref, cur = sides(spark, sf)
    return D.wasserstein_normed(ref, cur, "value").select(F.round("statistic", 6).alias("statistic"))


def _distance_sql(c: str, numeric: bool) -> str:
    """(column, test, statistic) of a large reference: normed Wasserstein or Jensen-Shannon."""
    if numeric:
        return f"""SELECT '{c}' AS "column", 'wasserstein' AS test, sum(CASE WHEN nx IS NOT NULL THEN abs(fr - fc) * (nx - x) ELSE 0 END)
         / (SELECT stddev_pop({c}) FROM ref) AS statistic FROM (
  SELECT x, sum(nr) OVER (ORDER BY x) / sum(nr) OVER () AS fr, sum(nc) OVER (ORDER BY x) / sum(nc) OVER () AS fc, lead(x) OVER (ORDER BY x) AS nx
  FROM (SELECT x, sum(r) AS nr, sum(c) AS nc FROM (SELECT CAST({c} AS DOUBLE) AS x, 1 AS r, 0 AS c FROM ref
        UNION ALL SELECT CAST({c} AS DOUBLE), 0, 1 FROM cur) WHERE x IS NOT NULL GROUP BY x))"""
    return f"""SELECT '{c}', 'jensenshannon', sqrt(greatest(0, 0.5 * sum(CASE WHEN p > 0 THEN p * ln(2 * p / (p + q)) ELSE 0 END)
         + 0.5 * sum(CASE WHEN q > 0 THEN q * ln(2 * q / (p + q)) ELSE 0 END))) FROM (
  SELECT sum(r) / sum(sum(r)) OVER () AS p, sum(c) / sum(sum(c)) OVER () AS q
  FROM (SELECT {c} AS v, 1 AS r, 0 AS c FROM ref UNION ALL SELECT {c}, 0, 1 FROM cur) WHERE v IS NOT NULL GROUP BY v)"""


# the SQL knows the distances, which references of over 1,000 rows get
_RESULTS_SQL = f"WITH {_SIDES_SQL}, results AS (" + " UNION ALL ".join(_distance_sql(c, n) for c, n in _COLUMNS.items()) + ")"


@query("drift_dataset", sql=f"""{_RESULTS_SQL}
SELECT count(*) AS n_columns, CAST(count(*) FILTER (WHERE statistic >= 0.1) AS BIGINT) AS n_drifted,
       count(*) FILTER (WHERE statistic >= 0.1) / count(*) AS share_drifted,
       count(*) FILTER (WHERE statistic >= 0.1) / count(*) >= 0.5 AS dataset_drift FROM results""")
def drift_dataset(spark, sf):
    """Per-column tests (chosen by D2) over every column and the share-of-drifted-columns verdict."""
    ref, cur = sides(spark, sf)
    return D.dataset_drift(D.column_results(ref, cur, ref.columns))


@query("drift_columns", sql=f"""{_RESULTS_SQL}
SELECT "column", test, round(statistic, 6) AS statistic, CAST(NULL AS DOUBLE) AS p_value, CAST(0.1 AS DOUBLE) AS threshold,
       statistic >= 0.1 AS drifted FROM results""")
def drift_columns(spark, sf):
    """The drift report as a table: one row for every column with statistic and p-value."""
    ref, cur = sides(spark, sf)
    return D.column_results(ref, cur, ref.columns).withColumn("statistic", F.round("statistic", 6))


@query("drift_history", sql=f"""{_RESULTS_SQL}
SELECT run, "column", test, CASE WHEN run = 'second' THEN round(statistic, 6) ELSE 0.0 END AS statistic,
       run = 'second' AND statistic >= 0.1 AS drifted
FROM results, (VALUES ('first'), ('second')) r(run)""")
def drift_history(spark, sf):
    """D8 as a sink: the reference's profile is stored; the reference itself and the second half are runs
    of a report table, one of them written twice."""
    ref, cur = sides(spark, sf)
    stored = D.reference_profile(ref, ref.columns).save(scratch_path(spark, "drift-reference"))
    path = scratch_path(spark, "drift-report")
    for run, rows in (("first", cur), ("second", cur), ("first", ref)):
        D.write_report(D.results_against(D.ReferenceProfile.load(spark, stored), rows), path, run)
    return spark.read.parquet(path).select("run", "column", "test", F.round("statistic", 6).alias("statistic"), "drifted")


# ---------------------------------------------------------------------------
# Profiling
# ---------------------------------------------------------------------------

@query("profile_table", sql="""
SELECT 'c_custkey' AS column_name, count(c_custkey) AS non_null, 'bigint' AS data_type FROM customer
UNION ALL SELECT 'c_name', count(c_name), 'string' FROM customer
UNION ALL SELECT 'c_nationkey', count(c_nationkey), 'int' FROM customer
UNION ALL SELECT 'c_acctbal', count(c_acctbal), 'double' FROM customer
UNION ALL SELECT 'c_mktsegment', count(c_mktsegment), 'string' FROM customer""")
def profile_table(spark, sf):
    """A4: column, non-null count and type in one pass."""
    return P.profile_table(fx.table(spark, sf, "customer"))


@query("head_rows", sql="SELECT * FROM orders ORDER BY o_orderkey LIMIT 5")
def head_rows(spark, sf):
    """O2: first five rows by key (a limit is the feature here)."""
    return P.head_rows(fx.table(spark, sf, "orders"), "o_orderkey", 5)


@query("table_shape", sql="""
SELECT (SELECT count(*) FROM orders) AS n_rows, 6 AS n_columns""")
def table_shape(spark, sf):
    """A3: shape of a table."""
    return P.shape(fx.table(spark, sf, "orders"))
