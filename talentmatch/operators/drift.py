"""Data drift between a reference and a current frame.

Per column the test is chosen the way the reproduced report does by default:
a column with at most 5 distinct reference values is categorical; with at
most 1000 reference rows a p-value test is used (KS for numbers, chi-square
or two-proportion z for categories, drift when p < 0.05), otherwise a
distance (normed Wasserstein for numbers, Jensen-Shannon for categories,
drift when >= 0.1). The data set drifts when at least half of the columns do.

The values of all columns of a kind are counted in one pass (column, value),
text as text and numbers as doubles; every statistic comes from those tables,
and the reference's can be stored, so that a run reads the current side only.
Numeric tests need the two empirical CDFs on the merged, sorted distinct
values. A column of more than ``RANGE_ROWS`` of them is cut into ranges by
approximate quantiles (a bounded list) and cumulated inside each range, with
per-range offsets taken from a small table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from talentmatch.operators.curate import common_columns

# Fixed defaults of the reproduced drift preset.
CAT_MAX_UNIQUE = 5
SMALL_REFERENCE = 1000
P_THRESHOLD = 0.05
DISTANCE_THRESHOLD = 0.1
DATASET_SHARE = 0.5


def prepare(reference: DataFrame, current: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Drop rows with nulls in the reference only; keep the shared columns."""
    ref = reference.na.drop(how="any")
    return common_columns(ref, current)


def _bounded_distinct(columns: list[str], most: int):
    """Up to ``most`` distinct non-null values of each column of a partition, as text; a column that has
    them is not looked at again, and a partition where all columns do is not read further."""
    def run(batches):
        seen: dict[str, set] = {c: set() for c in columns}
        for batch in batches:
            open_ = [c for c in columns if len(seen[c]) < most]
            if not open_:
                break
            for c in open_:
                for v in batch.column(c).unique().drop_null()[:most].to_pylist():
                    if len(seen[c]) < most:
                        seen[c].add(v)
        rows = [(c, v) for c, values in seen.items() for v in sorted(values)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], ["column", "value"])
    return run


def distinct_up_to(df: DataFrame, columns: list[str], most: int = CAT_MAX_UNIQUE + 1) -> dict[str, int]:
    """min(number of distinct non-null values, ``most``) of each column. A task gives at most ``most``
    values a column, so nothing that grows with a column's values is shuffled."""
    text = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    found = text.mapInArrow(_bounded_distinct(columns, most), "column string, value string").distinct().groupBy("column").count()
    return dict.fromkeys(columns, 0) | {r["column"]: min(r["count"], most) for r in found.collect()}


def _planned(reference: DataFrame, n: int, uniques: dict[str, int]) -> list[tuple]:
    out = []
    for c, u in uniques.items():
        numeric = isinstance(reference.schema[c].dataType, NumericType)
        kind = "num" if numeric and u > CAT_MAX_UNIQUE else "cat"
        if n <= SMALL_REFERENCE:
            test, threshold = "ks" if kind == "num" else ("z" if u <= 2 else "chisquare"), P_THRESHOLD
        else:
            test, threshold = "wasserstein" if kind == "num" else "jensenshannon", DISTANCE_THRESHOLD
        out.append((c, kind, n, u, test, float(threshold)))
    return out


_PLAN = "column string, kind string, n_ref bigint, n_unique bigint, test string, threshold double"


def plan(reference: DataFrame, columns: list[str]) -> DataFrame:
    """(column, kind, n_ref, n_unique, test, threshold); ``n_unique`` is exact, counted by column
    and value. The results below need it up to ``CAT_MAX_UNIQUE + 1`` only (``distinct_up_to``)."""
    values = category_counts(reference, columns).groupBy("column").agg(F.count(F.lit(1)).alias("n"))
    uniques = dict.fromkeys(columns, 0) | {r["column"]: r["n"] for r in values.collect()}      # a row a column
    return reference.sparkSession.createDataFrame(_planned(reference, reference.count(), uniques), _PLAN)


# ---------------------------------------------------------------------------
# Counts of all columns' values, once
# ---------------------------------------------------------------------------

def _pairs(df: DataFrame, columns: list[str], kind: str, name: str) -> DataFrame:
    if not columns:
        return df.sparkSession.createDataFrame([], f"column string, {name} {kind}, n bigint")
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast(kind).alias(name)) for c in columns]))
    return (df.select(pairs.alias("p")).select("p.*").where(F.col(name).isNotNull())
            .groupBy("column", name).agg(F.count(F.lit(1)).alias("n")))


def category_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, n): how often each non-null value stands in each column, in one pass."""
    return _pairs(df, columns, "string", "value")


def number_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, x, n) of numeric columns, as doubles, in one pass."""
    return _pairs(df, columns, "double", "x")


def both_sides(reference: DataFrame, current: DataFrame, by: str) -> DataFrame:
    """(column, by, n_ref, n_cur) of two tables of counts."""
    zero = F.lit(0).cast("bigint")
    both = (reference.select("column", by, F.col("n").alias("r"), zero.alias("c"))
            .unionAll(current.select("column", by, zero.alias("r"), F.col("n").alias("c"))))
    return both.groupBy("column", by).agg(F.sum("r").alias("n_ref"), F.sum("c").alias("n_cur"))


def value_counts(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, n_ref, n_cur): how often each side holds each non-null value of each column."""
    return both_sides(category_counts(reference, columns), category_counts(current, columns), "value")


def _with_totals(counts: DataFrame) -> DataFrame:
    """``counts`` with each column's totals (one row a column, so broadcast)."""
    totals = counts.groupBy("column").agg(F.sum("n_ref").alias("tot_ref"), F.sum("n_cur").alias("tot_cur"))
    return counts.join(F.broadcast(totals), "column")


def categorical_statistics(counts: DataFrame) -> DataFrame:
    """Per column: chi2 and dof (D3), js (D5), tot_ref and tot_cur, and the counts of the least value."""
    p_ref, p_cur = F.col("n_ref") / F.col("tot_ref"), F.col("n_cur") / F.col("tot_cur")
    expected = p_ref * F.col("tot_cur")
    # a category never seen in the reference has expected count 0: statistic +inf
    term = (F.when(expected > 0, F.pow(F.col("n_cur") - expected, 2) / expected)
            .when(F.col("n_cur") > 0, F.lit(float("inf"))).otherwise(F.lit(0.0)))
    middle = (p_ref + p_cur) / 2

    def kl(p):
        return F.when(p > 0, p * F.log(p / middle)).otherwise(F.lit(0.0))

    s = _with_totals(counts).where("tot_ref > 0 AND tot_cur > 0")
    return s.groupBy("column").agg(
        F.sum(term).alias("chi2"), (F.count(F.lit(1)) - 1).alias("dof"),
        F.sqrt(F.greatest(F.lit(0.0), 0.5 * F.sum(kl(p_ref)) + 0.5 * F.sum(kl(p_cur)))).alias("js"),
        F.first("tot_ref").alias("tot_ref"), F.first("tot_cur").alias("tot_cur"),
        F.min_by("n_ref", "value").alias("least_ref"), F.min_by("n_cur", "value").alias("least_cur"))


def chi_square(reference: DataFrame, current: DataFrame, col: str) -> DataFrame:
    """D3: chi-square of current counts against reference shares: (statistic, dof)."""
    s = categorical_statistics(value_counts(reference, current, [col]))
    return s.select(F.col("chi2").alias("statistic"), "dof")


def z_statistic(k1: int, n1: int, k2: int, n2: int) -> float:
    """D3 binary: pooled two-proportion z; 0 where its error is 0."""
    p = (k1 + k2) / (n1 + n2)
    error = math.sqrt(p * (1 - p) * (1 / n1 + 1 / n2))
    return (k2 / n2 - k1 / n1) / error if error else 0.0


def z_two_proportions(reference: DataFrame, current: DataFrame, flag) -> DataFrame:
    """D3 binary: pooled two-proportion z statistic of a boolean column; rows where it is null don't count."""
    both = (reference.select(F.lit(1).alias("__r"), flag.cast("int").alias("__k"))
            .unionByName(current.select(F.lit(0).alias("__r"), flag.cast("int").alias("__k")))).where("__k IS NOT NULL")
    j = both.agg(F.sum("__r").alias("n1"), F.sum(F.col("__k") * F.col("__r")).alias("k1"),
                 F.sum(1 - F.col("__r")).alias("n2"), F.sum(F.col("__k") * (1 - F.col("__r"))).alias("k2"))
    p = (F.col("k1") + F.col("k2")) / (F.col("n1") + F.col("n2"))
    se = F.sqrt(p * (1 - p) * (1 / F.col("n1") + 1 / F.col("n2")))
    z = F.coalesce(F.try_divide(F.col("k2") / F.col("n2") - F.col("k1") / F.col("n1"), se), F.lit(0.0))
    return j.select(z.alias("statistic"))


def jensen_shannon(reference: DataFrame, current: DataFrame, col: str) -> DataFrame:
    """Jensen-Shannon distance (natural log) between category shares."""
    return categorical_statistics(value_counts(reference, current, [col])).select(F.col("js").alias("statistic"))


# ---------------------------------------------------------------------------
# Numeric statistics
# ---------------------------------------------------------------------------

#: Distinct values that one task cumulates.
RANGE_ROWS = 200_000


def range_count(counts: DataFrame, rows: int = RANGE_ROWS) -> int:
    """Ranges that the column of most distinct values is cut into."""
    most = counts.groupBy("column").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    return max(1, math.ceil(most / rows))


def empirical_cdfs(counts: DataFrame, n_buckets: int) -> DataFrame:
    """(column, x, n_ref, mid, fr, fc, nx, tot_ref, tot_cur): both CDFs after each distinct value, the next
    value, and a value amid the column's.

    Computed per value range, cut by approximate quantiles: no window spans more values than a range
    has; the tables of bounds and of ranges have at most ``n_buckets`` rows a column.
    """
    probs = [i / (n_buckets + 1) for i in range(1, n_buckets + 1)]
    bounds = counts.groupBy("column").agg(F.percentile_approx("x", probs, 10000).alias("bounds"))
    inner = F.slice("bounds", 1, n_buckets - 1)
    g = (counts.join(F.broadcast(bounds), "column").withColumn("mid", F.col("bounds")[0])
         .withColumn("bk", F.size(F.filter(F.array_distinct(inner), lambda b: b < F.col("x")))).drop("bounds"))
    per = g.groupBy("column", "bk").agg(F.sum("n_ref").alias("br"), F.sum("n_cur").alias("bc"), F.min("x").alias("bmin"))
    ranges = Window.partitionBy("column").orderBy("bk")
    before = ranges.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy("column")
    per = per.select("column", "bk", F.coalesce(F.sum("br").over(before), F.lit(0)).alias("or"),
                     F.coalesce(F.sum("bc").over(before), F.lit(0)).alias("oc"), F.lead("bmin").over(ranges).alias("next_bmin"),
                     F.sum("br").over(every).alias("tot_ref"), F.sum("bc").over(every).alias("tot_cur"))
    w = Window.partitionBy("column", "bk").orderBy("x")
    cum = (g.join(F.broadcast(per), ["column", "bk"])
           .withColumn("fr", (F.col("or") + F.sum("n_ref").over(w)) / F.col("tot_ref"))
           .withColumn("fc", (F.col("oc") + F.sum("n_cur").over(w)) / F.col("tot_cur"))
           .withColumn("nx", F.coalesce(F.lead("x").over(w), F.col("next_bmin"))))
    return cum.select("column", "x", "n_ref", "mid", "fr", "fc", "nx", "tot_ref", "tot_cur")


def numeric_statistics(counts: DataFrame, n_buckets: int | None = None) -> DataFrame:
    """Per column of (column, x, n_ref, n_cur): ks (D4), w1 (D6 before it is divided), sd (population
    deviation of the reference, taken around a value amid the column's), tot_ref and tot_cur."""
    gap = F.abs(F.col("fr") - F.col("fc"))
    off = F.col("x") - F.col("mid")
    found = empirical_cdfs(counts, n_buckets or range_count(counts)).groupBy("column").agg(
        F.max(gap).alias("ks"), F.sum(F.when(F.col("nx").isNotNull(), gap * (F.col("nx") - F.col("x"))).otherwise(0.0)).alias("w1"),
        F.sum(F.col("n_ref") * off).alias("s"), F.sum(F.col("n_ref") * off * off).alias("q"),
        F.first("tot_ref").alias("tot_ref"), F.first("tot_cur").alias("tot_cur"))
    mean = F.try_divide("s", "tot_ref")
    sd = F.sqrt(F.greatest(F.lit(0.0), F.try_divide("q", "tot_ref") - mean * mean))
    return found.select("column", "ks", "w1", sd.alias("sd"), "tot_ref", "tot_cur")


def _numbers(reference: DataFrame, current: DataFrame, col: str, n_buckets: int | None) -> DataFrame:
    counts = both_sides(number_counts(reference, [col]), number_counts(current, [col]), "x")
    # rows bound the distinct values, and are known without reading any
    return numeric_statistics(counts, n_buckets or max(1, math.ceil((reference.count() + current.count()) / RANGE_ROWS)))


def ks_statistic(reference: DataFrame, current: DataFrame, col: str, n_buckets: int | None = None) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov D = max |Fr - Fc|."""
    return _numbers(reference, current, col, n_buckets).select(F.col("ks").alias("statistic"))


def wasserstein_normed(reference: DataFrame, current: DataFrame, col: str,
                       n_buckets: int | None = None) -> DataFrame:
    """W1(reference, current) / population std of the reference (undivided if that is 0)."""
    s = _numbers(reference, current, col, n_buckets)
    return s.select((F.col("w1") / F.when(F.col("sd") > 0, F.col("sd")).otherwise(1.0)).alias("statistic"))


# ---------------------------------------------------------------------------
# p-values on the few statistics (no SciPy): small pure-Python helpers
# ---------------------------------------------------------------------------

def chi2_sf(x: float, k: int) -> float:
    """P(X > x) for chi-square with k degrees of freedom (regularised gamma Q)."""
    if x is None or k <= 0:
        return float("nan")
    if x <= 0:
        return 1.0
    if math.isinf(x):
        return 0.0
    a, z = k / 2.0, x / 2.0
    if z < a + 1:                                   # series for P, return 1 - P
        term = s = 1.0 / a
        n = a
        for _ in range(1000):
            n += 1
            term *= z / n
            s += term
            if abs(term) < abs(s) * 1e-15:
                break
        return max(0.0, 1.0 - s * math.exp(-z + a * math.log(z) - math.lgamma(a)))
    b, c, d = z + 1 - a, 1e300, 1 / (z + 1 - a)    # continued fraction for Q
    h = d
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = 1e-300 if abs(d) < 1e-300 else d
        c = b + an / c
        c = 1e-300 if abs(c) < 1e-300 else c
        d = 1 / d
        delta = d * c
        h *= delta
        if abs(delta - 1) < 1e-15:
            break
    return math.exp(-z + a * math.log(z) - math.lgamma(a)) * h


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def ks_pvalue(d: float, n: int, m: int) -> float:
    """Asymptotic two-sample Kolmogorov-Smirnov p-value."""
    if n == 0 or m == 0:
        return float("nan")
    en = math.sqrt(n * m / (n + m))
    lam = (en + 0.12 + 0.11 / en) * d
    if lam < 1e-3:
        return 1.0
    s = sum(2 * (-1) ** (j - 1) * math.exp(-2 * j * j * lam * lam) for j in range(1, 101))
    return min(1.0, max(0.0, s))


# ---------------------------------------------------------------------------
# Per-column results and the data set verdict
# ---------------------------------------------------------------------------

@dataclass
class ReferenceProfile:
    """What runs need of the reference: the plan (D2), and its values' counts."""
    plans: list
    categories: DataFrame
    numbers: DataFrame

    def columns(self, kind: str) -> list[str]:
        return [r["column"] for r in self.plans if r["kind"] == kind]

    def save(self, path: str) -> str:
        """Three tables under ``path``; runs then read the current side only."""
        spark = self.categories.sparkSession
        spark.createDataFrame(self.plans, _PLAN).write.mode("overwrite").parquet(f"{path}/plan")
        self.categories.write.mode("overwrite").parquet(f"{path}/categories")
        self.numbers.write.mode("overwrite").parquet(f"{path}/numbers")
        return path

    @staticmethod
    def load(spark: SparkSession, path: str) -> ReferenceProfile:
        plans = spark.read.parquet(f"{path}/plan").collect()                 # one row a column
        return ReferenceProfile(plans, spark.read.parquet(f"{path}/categories"), spark.read.parquet(f"{path}/numbers"))


def reference_profile(reference: DataFrame, columns: list[str]) -> ReferenceProfile:
    plans = [dict(zip(("column", "kind", "n_ref", "n_unique", "test", "threshold"), r, strict=True))
             for r in _planned(reference, reference.count(), distinct_up_to(reference, columns))]
    out = ReferenceProfile(plans, None, None)
    out.categories = category_counts(reference, out.columns("cat"))
    out.numbers = number_counts(reference, out.columns("num"))
    return out


def results_against(profile: ReferenceProfile, current: DataFrame) -> DataFrame:
    """(column, test, statistic, p_value, threshold, drifted) for every column of the profile.

    The current side's values are counted in one pass for categories and one for numbers; the
    statistics of all columns of a kind are one aggregate. A column without rows on one side has no
    statistic and no drift.
    """
    stats = {}
    if profile.columns("cat"):
        counts = both_sides(profile.categories, category_counts(current, profile.columns("cat")), "value").persist()
        stats |= {r["column"]: r.asDict() for r in categorical_statistics(counts).collect()}
        counts.unpersist()
    if profile.columns("num"):
        counts = both_sides(profile.numbers, number_counts(current, profile.columns("num")), "x").persist()
        stats |= {r["column"]: r.asDict() for r in numeric_statistics(counts).collect()}
        counts.unpersist()
    rows = []
    for r in profile.plans:
        c, test = r["column"], r["test"]
        s, pv, stat = stats.get(c), None, None
        if s and s["tot_ref"] and s["tot_cur"]:
            if test == "wasserstein":
                stat = s["w1"] / (s["sd"] or 1.0)
            elif test == "jensenshannon":
                stat = s["js"]
            elif test == "ks":
                stat = s["ks"]
                pv = ks_pvalue(stat, s["tot_ref"], s["tot_cur"])
            elif test == "chisquare":
                stat, pv = s["chi2"], chi2_sf(s["chi2"], int(s["dof"]))
            else:
                # the smaller level, so that the sign does not hang on the order of rows
                stat = z_statistic(s["least_ref"], s["tot_ref"], s["least_cur"], s["tot_cur"])
                pv = normal_two_sided(stat)
        drifted = stat is not None and (pv < r["threshold"] if pv is not None else stat >= r["threshold"])
        rows.append((c, test, None if stat is None else float(stat), pv, float(r["threshold"]), bool(drifted)))
    return current.sparkSession.createDataFrame(
        rows, "column string, test string, statistic double, p_value double, threshold double, drifted boolean")


def column_results(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """``results_against`` the profile of ``reference``."""
    return results_against(reference_profile(reference, columns), current)


def write_report(results: DataFrame, path: str, run: str) -> str:
    """D8 sink: the report of a run as partition ``run`` of a table. A run written again replaces its
    own partition, and no other."""
    (results.withColumn("run", F.lit(run)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run").parquet(path))
    return path


def dataset_drift(results: DataFrame) -> DataFrame:
    """(n_columns, n_drifted, share_drifted, dataset_drift)."""
    agg = results.agg(F.count(F.lit(1)).alias("n_columns"),
                      F.sum(F.when(F.col("drifted"), 1).otherwise(0)).alias("n_drifted"))
    share = F.col("n_drifted") / F.col("n_columns")
    return agg.select("n_columns", "n_drifted", share.alias("share_drifted"),
                      (share >= DATASET_SHARE).alias("dataset_drift"))

