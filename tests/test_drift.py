import numpy as np
from pyspark.sql import functions as F

from talentmatch.operators import drift as D


def frames(spark, seed=3):
    rng = np.random.default_rng(seed)
    a = np.round(rng.normal(size=400), 2)
    b = np.round(rng.normal(0.3, 1.2, size=300), 2)
    ra = spark.createDataFrame([(float(x), "c" + str(int(abs(x) * 2) % 4)) for x in a], "value double, cat string")
    rb = spark.createDataFrame([(float(x), "c" + str(int(abs(x) * 3) % 5)) for x in b], "value double, cat string")
    return a, b, ra, rb


def ecdf(sample, xs):
    s = np.sort(sample)
    return np.searchsorted(s, xs, side="right") / len(s)


def test_ks_and_wasserstein_match_numpy(spark):
    a, b, ra, rb = frames(spark)
    xs = np.unique(np.concatenate([a, b]))
    fa, fb = ecdf(a, xs), ecdf(b, xs)
    ks = np.max(np.abs(fa - fb))
    w1 = np.sum(np.abs(fa - fb)[:-1] * np.diff(xs)) / np.std(a)
    for buckets in (1, 4, 64):
        got = D.ks_statistic(ra, rb, "value", n_buckets=buckets).first()[0]
        assert abs(got - ks) < 1e-12
        got_w = D.wasserstein_normed(ra, rb, "value", n_buckets=buckets).first()[0]
        assert abs(got_w - w1) < 1e-9


def test_chi_square_and_js(spark):
    _, _, ra, rb = frames(spark)
    ref = {r.cat: r.n for r in ra.groupBy("cat").count().withColumnRenamed("count", "n").collect()}
    cur = {r.cat: r.n for r in rb.groupBy("cat").count().withColumnRenamed("count", "n").collect()}
    cats = sorted(set(ref) | set(cur))
    nr, nc = sum(ref.values()), sum(cur.values())
    p = np.array([ref.get(c, 0) / nr for c in cats])
    q = np.array([cur.get(c, 0) / nc for c in cats])
    m = (p + q) / 2
    kl = lambda x: np.sum(np.where(x > 0, x * np.log(np.where(x > 0, x, 1) / m), 0))
    js = np.sqrt(0.5 * kl(p) + 0.5 * kl(q))
    assert abs(D.jensen_shannon(ra, rb, "cat").first()[0] - js) < 1e-12


def test_p_values():
    assert abs(D.chi2_sf(3.841458820694124, 1) - 0.05) < 1e-6
    assert abs(D.chi2_sf(11.070497693516351, 5) - 0.05) < 1e-6
    assert abs(D.chi2_sf(0.5, 3) - 0.9188914117) < 1e-6
    assert abs(D.normal_two_sided(1.959963984540054) - 0.05) < 1e-9
    assert D.ks_pvalue(0.0, 100, 100) == 1.0
    assert D.ks_pvalue(0.5, 100, 100) < 1e-5


def test_plan_and_dataset_verdict(spark):
    _, _, ra, rb = frames(spark)
    plan = {r.column: r.test for r in D.plan(ra, ["value", "cat"]).collect()}
    assert plan == {"value": "ks", "cat": "chisquare"}
    res = D.column_results(ra, rb, ["value", "cat"])
    verdict = D.dataset_drift(res).first()
    assert verdict.n_columns == 2 and verdict.dataset_drift == (verdict.n_drifted >= 1)


def test_category_unseen_in_the_reference_is_drift(spark):
    ref = spark.createDataFrame([(c,) for c in "aabbbcc" * 3], "cat string")
    cur = spark.createDataFrame([(c,) for c in "aabbbcd" * 3], "cat string")
    r = D.column_results(ref, cur, ["cat"]).first()
    assert r.test == "chisquare" and r.statistic == float("inf") and r.p_value == 0.0 and r.drifted


def test_nulls_do_not_count_as_observations(spark):
    ref = [float(i) for i in range(10)] + [None] * 10
    cur = [float(i) + 2 for i in range(10)]
    a = D.column_results(spark.createDataFrame([(x,) for x in ref], "v double"), spark.createDataFrame([(x,) for x in cur], "v double"), ["v"]).first()
    b = D.column_results(spark.createDataFrame([(x,) for x in ref[:10]], "v double"), spark.createDataFrame([(x,) for x in cur], "v double"), ["v"]).first()
    assert a.test == "ks" and (a.statistic, a.p_value) == (b.statistic, b.p_value) == (b.statistic, D.ks_pvalue(b.statistic, 10, 10))


def test_z_takes_the_smaller_level(spark):
    ref = spark.createDataFrame([(c,) for c in "yyyyn" * 4], "flag string")
    cur = spark.createDataFrame([(c,) for c in "yynnn" * 4], "flag string")
    for r in (ref, ref.orderBy(F.desc("flag")), ref.orderBy("flag")):
        got = D.column_results(r, cur, ["flag"]).first()
        assert got.test == "z" and got.statistic > 2.5


def test_no_window_over_a_whole_column(spark):
    _, _, ra, rb = frames(spark)
    s = D.categorical_statistics(D.value_counts(ra, rb, ["value", "cat"]))
    assert "SinglePartition" not in s._jdf.queryExecution().executedPlan().toString()
    assert {r["column"] for r in s.collect()} == {"value", "cat"}


def test_column_without_rows_on_one_side(spark):
    ref = spark.createDataFrame([(1.0,), (2.0,)], "v double")
    cur = spark.createDataFrame([(None,)], "v double")
    r = D.column_results(ref, cur, ["v"]).first()
    assert r.statistic is None and not r.drifted


def test_distinct_values_are_counted_up_to_a_bound(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("a"), F.col("id").alias("b"), F.lit(None).cast("string").alias("c"),
                                  F.when(F.col("id") % 7 > 0, F.col("id") % 7).alias("d"))
    assert D.distinct_up_to(df.repartition(5), df.columns) == {"a": 3, "b": 6, "c": 0, "d": 6}
    assert D.distinct_up_to(df.where("false"), df.columns) == dict.fromkeys("abcd", 0)
    plan = df.selectExpr("cast(a as string) a").mapInArrow(D._bounded_distinct(["a"], 6), "column string, value string").distinct()
    assert "Expand" not in plan._jdf.queryExecution().executedPlan().toString()


def test_stored_reference_and_report_runs(spark, tmp_path):
    _, _, ra, rb = frames(spark)
    want = sorted(map(tuple, D.column_results(ra, rb, ["value", "cat"]).collect()))
    stored = D.ReferenceProfile.load(spark, D.reference_profile(ra, ["value", "cat"]).save(str(tmp_path / "reference")))
    assert sorted(map(tuple, D.results_against(stored, rb).collect())) == want
    path = str(tmp_path / "report")
    for run, rows in (("a", ra), ("b", rb), ("a", rb), ("a", ra)):
        D.write_report(D.results_against(stored, rows), path, run)
    got = spark.read.parquet(path)
    assert got.groupBy("run").count().collect() and sorted((r["run"], r["count"]) for r in got.groupBy("run").count().collect()) == [("a", 2), ("b", 2)]
    assert sorted(map(tuple, got.where("run = 'b'").drop("run").collect())) == want
    assert got.where("run = 'a' AND drifted").count() == 0


def test_deviation_of_values_far_from_zero(spark):
    x = [1.7e9 + i / 8 for i in range(2000)]
    ref, cur = (spark.createDataFrame([(v + d,) for v in x], "v double") for d in (0.0, 1.0))
    got = D.wasserstein_normed(ref, cur, "v").first()[0]
    assert abs(got - 1 / np.std(x)) < 1e-6
