import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from talentmatch.operators import forest as FO
from talentmatch.operators import models as M


def frame(spark, n=400, seed=1):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 6)), 2)
    y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(0, 0.3, n) > 0).astype(int)
    rows = [(i, [float(v) for v in x[i]], float(y[i]), 1.0 + i % 2) for i in range(n)]
    return spark.createDataFrame(rows, "id long, v array<double>, label double, weight double").withColumn("features", array_to_vector("v"))


def refuse():
    raise AssertionError("grown otherwise")


def probs(model, df):
    return {r[0]: r[1] for r in model.transform(df).select("id", vector_to_array("probability")[1]).collect()}


def test_split_is_the_best_of_all_cuts():
    rng = np.random.default_rng(2)
    x, y, w = rng.integers(0, 8, (200, 4)).astype(np.uint8), rng.integers(0, 2, 200), rng.integers(1, 4, 200).astype(float)
    feature, bin_, left, shares = FO.grow_tree(x, y, w, 2, 1, 4, rng)

    def drop(f, b):
        out = 0.0
        for side in (x[:, f] <= b, x[:, f] > b):
            c = np.bincount(y[side], w[side], 2)
            out -= c.sum() - (c * c).sum() / c.sum() if c.sum() else 0
        return out

    best = max(((f, b) for f in range(4) for b in range(7)), key=lambda s: drop(*s))
    if feature[0] >= 0:             # merged where both sides say the same
        assert (feature[0], bin_[0]) == best
        assert np.allclose(shares[left[0]], np.bincount(y[x[:, best[0]] <= best[1]], w[x[:, best[0]] <= best[1]], 2) / w[x[:, best[0]] <= best[1]].sum())


def test_deep_trees_tell_all_rows_apart_and_merge_equal_children():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 32, (500, 5)).astype(np.uint8)
    x = np.unique(x, axis=0)
    y = rng.integers(0, 2, len(x))
    tree = FO.grow_tree(x, y, np.ones(len(x)), 2, 30, 5, rng)
    assert (FO.tree_shares(x, tree).argmax(axis=1) == y).all()
    feature, _, left, shares = tree
    says, leaf = shares.argmax(axis=1), feature < 0
    assert not any(leaf[c] and leaf[c + 1] and says[c] == says[c + 1] for c in left[~leaf])
    assert sorted(np.concatenate([left[~leaf], left[~leaf] + 1, [0]])) == list(range(len(feature)))


def test_cuts_are_midpoints_of_few_values_and_quantiles_of_many():
    assert FO._cuts(*FO._points(np.array([3.0, 1.0, 1.0, 2.0]), np.ones(4))).tolist() == [1.5, 2.5]
    values, weights = FO._points(np.arange(100_000.0), np.ones(100_000))
    assert len(values) <= FO.POINTS and weights.sum() == 100_000
    cuts = FO._cuts(values, weights)
    assert len(cuts) == FO.BINS - 1 and np.abs(cuts - np.arange(1, 32) * 100_000 / 32).max() < 200
    assert (FO._bins(np.array([[1.5], [1.6], [9.0]]), [np.array([1.5, 2.5])]).ravel() == [0, 1, 2]).all()


def test_forest_is_the_same_however_rows_are_dealt_out(spark, tmp_path):
    df = frame(spark)
    a, b = (FO.grow(df.repartition(n), "label", "weight", 7, 12, 42, refuse) for n in (1, 5))
    pa_, pb = probs(a, df), probs(b, df.repartition(3))
    assert pa_ == pb and len(pa_) == 400
    right = sum((pa_[r.id] > 0.5) == (r.label == 1) for r in df.collect())
    assert right > 380
    # the probability is the mean of the trees'
    singles = [probs(a.first(n), df) for n in (1, 2)]
    trees = {r["tree"]: r for r in spark.read.parquet(a.path).collect()}
    assert sorted(trees) == list(range(7)) and a.first(3).getNumTrees == 3
    x = FO._bins(np.array([r.v for r in df.orderBy("id").collect()]), a.cuts)
    shares = [FO.tree_shares(x, tuple(np.frombuffer(trees[t][c], k) for c, k in zip(("feature", "bin", "left"), (np.int16, np.uint8, np.int32)))
                             + (np.frombuffer(trees[t]["share"]).reshape(-1, 2),))[:, 1] for t in range(2)]
    assert np.allclose([singles[0][i] for i in range(400)], shares[0]) and np.allclose([singles[1][i] for i in range(400)], (shares[0] + shares[1]) / 2)
    a.first(5).write().save(str(tmp_path / "forest"))
    again = FO.RandomForestClassificationTrees.load(str(tmp_path / "forest"))
    assert again.getNumTrees == 5 and probs(again, df) == probs(a.first(5), df) and spark.read.parquet(again.path).count() == 5


def test_repeated_and_null_keys_keep_their_rows(spark):
    df = frame(spark, 60)
    model = FO.grow(df, "label", "weight", 3, 5, 42, refuse)
    odd = df.unionAll(df.limit(5)).withColumn("id", F.when(F.col("id") != 3, F.col("id")))
    out = model.transform(odd)
    assert out.count() == 65 and out.where("id is null").count() >= 1 and out.columns == [*df.columns, "rawPrediction", "probability", "prediction"]
    p = out.select(vector_to_array("probability")[1].alias("p"), "prediction").collect()
    assert all(r.prediction == float(r.p > 0.5) and 0 <= r.p <= 1 for r in p)


def test_trained_forests_stay_off_the_driver(spark, monkeypatch):
    from pyspark.ml.classification import RandomForestClassificationModel
    rows = [(i, [float(i % 5), float(i % 3)], "ab"[i % 2], int(i % 4 == 0)) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, emb array<double>, cat string, label int")
    spec = M.ModelSpec(trees=4, depth=4)
    model = M.fit_model(df, "RandomForest", "label", ["cat"], spec)
    assert isinstance(model.stages[-1], FO.RandomForestClassificationTrees) and model.stages[-1].getNumTrees == 4
    assert not any(isinstance(s, RandomForestClassificationModel) for s in model.stages)
    assert M.predict(model, df.unionAll(df), "id", ["label"]).count() == 120
    part = M.fit_part(M.shared_folds(df, "id", "label", ["cat"], 2, [2]).frame(2), "RandomForest", "label", spec)
    assert M.first_trees(part, 2).getNumTrees == 2
    # rows beyond what a task may hold
    monkeypatch.setattr(FO, "TASK_BYTES", 100)
    assert isinstance(M.fit_model(df, "RandomForest", "label", ["cat"], spec).stages[-1], RandomForestClassificationModel)


@pytest.mark.parametrize("n", [1, 5, 16])
def test_keys_fall_on_partitions_of_their_own(spark, n):
    keys = FO._keys(spark, n)
    at = spark.createDataFrame([(k,) for k in keys], "k int").repartition(n, "k").select(F.spark_partition_id()).collect()
    assert len({r[0] for r in at}) == n == len(set(keys))


def test_boosted_trees_are_those_of_the_library(spark, tmp_path):
    df = frame(spark, 300).select("id", "label", "weight", F.transform("v", lambda x: F.round(x)).alias("v")).withColumn("features", array_to_vector("v"))
    est = M.estimators("label", M.ModelSpec(gbt_rounds=8, gbt_depth=3))["GradientBoostedTrees"]
    for rows in (df, df.unionAll(df.where("id % 5 = 0"))):
        mine, theirs = FO.grow_boosted(rows, "label", "weight", 8, 3, 0.3, refuse), est.fit(rows)
        a, b = probs(mine, df), probs(theirs, df)
        assert max(abs(a[i] - b[i]) for i in a) < 1e-6 and len(a) == 300
    c, d = probs(mine.first(3), df), probs(M.first_trees(theirs, 3), df)
    assert max(abs(c[i] - d[i]) for i in c) < 1e-6
    mine.write().save(str(tmp_path / "boosted"))
    assert probs(FO.GBTClassificationTrees.load(str(tmp_path / "boosted")), df) == a


def test_parts_are_boosted_in_tasks(spark, monkeypatch):
    rows = [(i, [float(i % 5), float(i % 3)], "ab"[i % 2], int(i % 4 == 0)) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, emb array<double>, cat string, label int")
    spec, part = M.ModelSpec(gbt_rounds=3, gbt_depth=2), M.shared_folds(df, "id", "label", ["cat"], 2, [2]).frame(2)
    fitted = M.fit_part(part, "GradientBoostedTrees", "label", spec)
    assert isinstance(fitted, FO.GBTClassificationTrees) and M.first_trees(fitted, 2).getNumTrees == 2
    monkeypatch.setattr(FO, "TASK_BYTES", 100)
    assert type(M.fit_part(part, "GradientBoostedTrees", "label", spec)).__name__ == "GBTClassificationModel"
