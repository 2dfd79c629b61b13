import math

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from talentmatch.operators import evaluate as E
from talentmatch.operators import features as FE


def preds(spark):
    rows = [(1, 1)] * 5 + [(1, 0)] * 2 + [(0, 1)] * 3 + [(0, 0)] * 10
    return spark.createDataFrame(rows, "label int, prediction int")


def test_f1_and_report(spark):
    p = preds(spark)
    assert abs(E.f1_binary(p).first().f1 - 2 * 5 / (2 * 5 + 3 + 2)) < 1e-12
    rep = {r.row: r for r in E.classification_report(p).collect()}
    assert abs(rep["1"].precision - 5 / 8) < 1e-12 and abs(rep["1"].recall - 5 / 7) < 1e-12
    assert abs(rep["0"].precision - 10 / 12) < 1e-12 and rep["0"].support == 13
    assert abs(rep["accuracy"].f1 - 15 / 20) < 1e-12
    f1_0, f1_1 = 2 * 10 / (12 + 13), 2 * 5 / (8 + 7)
    assert abs(rep["macro avg"].f1 - (f1_0 + f1_1) / 2) < 1e-12
    assert abs(rep["weighted avg"].f1 - (f1_0 * 13 + f1_1 * 7) / 20) < 1e-12


def test_f1_undefined_is_zero_and_best_model(spark):
    p = spark.createDataFrame([(0, 0), (0, 0)], "label int, prediction int")
    assert E.f1_binary(p).first().f1 == 0.0
    board = spark.createDataFrame([("a", 0, 0.0), ("b", 1, 0.0)], "model string, model_order int, f1 double")
    assert E.best_model(board).count() == 0
    board = spark.createDataFrame([("a", 0, 0.5), ("b", 1, 0.5), ("c", 2, 0.4)],
                                  "model string, model_order int, f1 double")
    assert E.best_model(board).first().model == "a"


def test_soft_vote_tie_is_zero(spark):
    df = spark.createDataFrame([(1, 0.5, 0.5, 0.5), (2, 0.9, 0.4, 0.3)], "id int, a double, b double, c double")
    out = {r.id: r.prediction for r in E.soft_vote(df, ["a", "b", "c"]).collect()}
    assert out == {1: 0, 2: 1}


def test_tfidf_matches_numpy(spark):
    docs = [(1, "aa bb aa cc"), (2, "bb cc dd"), (3, "aa ee"), (4, "")]
    df = spark.createDataFrame(docs, "doc_id int, text string").select(
        "doc_id", F.regexp_extract_all("text", F.lit(r"\w{2,}"), F.lit(0)).alias("t"))
    got = {(r.doc_id, r.term): r.weight for r in FE.tfidf_long(df, "doc_id", "t", 3).collect()}
    # vocabulary: counts aa 3, bb 2, cc 2, dd 1, ee 1 -> top 3 = aa, bb, cc
    vocab = ["aa", "bb", "cc"]
    n = 4
    dfreq = {"aa": 2, "bb": 2, "cc": 2}
    for d, text in docs:
        toks = text.split()
        w = np.array([toks.count(t) * (math.log((1 + n) / (1 + dfreq[t])) + 1) for t in vocab])
        if w.sum() == 0:
            continue
        w = w / np.linalg.norm(w)
        for t, x in zip(vocab, w):
            if x:
                assert abs(got[(d, t)] - x) < 1e-12
    assert all(t in vocab for _, t in got)


def test_one_hot_unseen_and_null_are_zero(spark):
    train = spark.createDataFrame([("b",), ("a",), (None,)], "c string")
    test = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "c string")
    out = FE.one_hot(train, test, ["c"]).select("c", vector_to_array("oh_c").alias("v")).collect()
    got = {r.c: list(r.v) for r in out}
    assert got == {"a": [1.0, 0.0], "b": [0.0, 1.0], "z": [0.0, 0.0], None: [0.0, 0.0]}


def test_mode_ties_to_smallest(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "x"), ("b", None), ("a", None), (None, None)], "p string, q string")
    got = {r.column: r.mode for r in FE.mode_per_column(df, ["p", "q"]).collect()}
    assert got == {"p": "a", "q": "x"}


def test_embedding_is_row_local_and_unit(spark):
    from talentmatch.operators.embed import embed_hash
    df = spark.createDataFrame([(1, "um dois dois tr\u00eas"), (2, ""), (3, None)], "id int, t string")
    e = embed_hash(df, "id", "t", 16)
    assert "Exchange" not in e._jdf.queryExecution().executedPlan().toString()
    got = {r["id"]: r["embedding"] for r in e.collect()}
    assert abs(sum(x * x for x in got[1]) - 1) < 1e-12 and got[2] == got[3] == [0.0] * 16


def test_leaky_folds_keep_one_prediction_a_row(spark):
    from talentmatch.operators import models as M
    rows = [(i, [float(i % 5), float(i % 3)], "ab"[i % 2], int(i % 4 == 0)) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, emb array<double>, cat string, label int")
    spec = M.ModelSpec(lr_iter=5)
    model = M.fit_model(df, "LogisticRegression", "label", ["cat"], spec)
    assert M.predict(model, df.unionAll(df), "id", ["label"]).count() == 120
    vote = {"a": model, "b": model}
    one = {r["id"]: r["prob"] for r in M.predict(model, df, "id").collect()}
    both = M.predict_vote(vote, df.unionAll(df), "id", ["label"]).collect()
    assert len(both) == 120 and all(abs(r["prob"] - one[r["id"]]) < 1e-12 for r in both)
    folds = M.cross_val_f1(df, "LogisticRegression", "id", "label", ["cat"], spec, k=3, leaky=True).collect()
    assert len(folds) == 3 and all(0 <= r["f1"] <= 1 for r in folds)


def test_plugged_in_encoder(spark):
    from talentmatch.operators.embed import embed_with

    def make():
        import numpy as np
        return lambda texts: np.array([[float(len(t)), 1.0] for t in texts], dtype=np.float32)

    df = spark.createDataFrame([(1, "ab"), (2, "abc"), (3, "ab"), (4, None)], "id int, t string")
    got = {r["id"]: r["embedding"] for r in embed_with(df, "id", "t", make, 2).collect()}
    assert got == {1: [2.0, 1.0], 2: [3.0, 1.0], 3: [2.0, 1.0], 4: None}


def test_winner_is_stored_with_its_report(spark, tmp_path):
    from talentmatch.operators import models as M
    rows = [(i, [float(i % 5), float(i % 3)], "ab"[i % 2], int(i % 5 == 0)) for i in range(90)]
    df = spark.createDataFrame(rows, "id long, emb array<double>, cat string, label int")
    spec = M.ModelSpec(lr_iter=20, trees=3, depth=3)
    board = M.leaderboard(df.where("id % 3 > 0"), df.where("id % 3 = 0"), "id", "label", ["cat"], spec,
                          names=M.MODEL_ORDER[:2], k=2, store=str(tmp_path / "w")).collect()
    best = max(board, key=lambda r: (r["f1"], -r["model_order"]))
    model = M.load_model(str(tmp_path / "w" / "model"))
    assert type(model.stages[-1]).__name__.startswith(best["model"].replace("RandomForest", "RandomForestClassification"))
    report = {r["row"]: r for r in spark.read.parquet(str(tmp_path / "w" / "report")).collect()}
    assert abs(report["1"]["f1"] - best["f1"]) < 1e-9


def test_policies_of_training(spark, tmp_path):
    import pytest

    from talentmatch.operators import features as FE
    from talentmatch.operators import models as M
    train = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "id long, cat string")
    assert [r.cat for r in FE.with_null_policy(train, train, ["cat"], "impute").orderBy("id").collect()] == ["a", "a", "b", "a"]
    assert FE.with_null_policy(train, train, ["cat"], "drop").count() == 3 and FE.with_null_policy(train, train, ["cat"], "keep").count() == 4
    with pytest.raises(ValueError):
        FE.with_null_policy(train, train, ["cat"], "other")
    docs = spark.createDataFrame([(1, "Gatos, para CASAS!", 0), (2, "gatos casas", 1)], "id long, t string, label int")
    clean = [r.emb for r in M.feature_frame(docs, "id", "t", [], 16, "clean").collect()]
    raw = [r.emb for r in M.feature_frame(docs, "id", "t", [], 16).collect()]
    assert clean[0] == clean[1] and raw[0] != raw[1]


def test_no_winner_is_stored_where_every_f1_is_zero(spark, tmp_path):
    import os

    from talentmatch.operators import models as M
    rows = [(i, [1.0, 2.0], "a", int(i % 9 == 0)) for i in range(45)]
    df = spark.createDataFrame(rows, "id long, emb array<double>, cat string, label int")
    spec = M.ModelSpec(lr_iter=3, trees=2, depth=2)
    # the hold-out has no row of class 1, so every F1 on it is 0
    board = M.leaderboard(df, df.where("label = 0"), "id", "label", ["cat"], spec, names=M.MODEL_ORDER[:2], k=2, store=str(tmp_path / "w"))
    assert {r.f1 for r in board.collect()} == {0.0} and not os.path.exists(tmp_path / "w")


def test_first_trees_are_the_smaller_ensemble(spark, tmp_path):
    from pyspark.ml.functions import array_to_vector

    from talentmatch.operators import models as M
    rows = [(float(i % 3 == 0), [float(i % 7), float(i % 5), float(i % 3)]) for i in range(80)]
    df = spark.createDataFrame(rows, "label double, v array<double>").select("label", array_to_vector("v").alias("features"))
    for rounds in (3, 6):
        spec = M.ModelSpec(gbt_rounds=6, gbt_depth=3, trees=6, depth=3)
        gbt = M.estimators("label", spec, None)["GradientBoostedTrees"].fit(df)
        less = M.estimators("label", M.ModelSpec(gbt_rounds=rounds, gbt_depth=3), None)["GradientBoostedTrees"].fit(df)
        a, b = (sorted(r.probability[1] for r in m.transform(df).collect()) for m in (M.first_trees(gbt, rounds), less))
        assert all(abs(x - y) < 1e-12 for x, y in zip(a, b))
        forest = M.first_trees(M.estimators("label", spec, None)["RandomForest"].fit(df), rounds)
        assert forest.getNumTrees == rounds and forest.transform(df).count() == 80
        for model in (forest, M.first_trees(gbt, rounds)):
            path = str(tmp_path / f"{model.uid}")
            model.write().save(path)
            again = type(model).load(path)
            assert [r.probability for r in again.transform(df).collect()] == [r.probability for r in model.transform(df).collect()]


def test_models_can_be_sent_once_the_session_has_observed_rows(spark):
    from pyspark.sql import Observation

    from talentmatch.operators import models as M
    seen = Observation("rows")
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 3}
    rows = [(i, [float(i % 5), float(i % 3)], "ab"[i % 2], int(i % 4 == 0)) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, emb array<double>, cat string, label int")
    spec = M.ModelSpec(lr_iter=5, vote_trees=2, depth=2, gbt_depth=2)
    vote = M.fit_vote(df, "label", ["cat"], spec)
    assert not any(getattr(m.stages[-1], "hasSummary", False) for m in vote.values())
    assert all(M.predict(m, df, "id", ["label"]).count() == 60 for m in vote.values())
    assert len(M.predict_vote(vote, df, "id", ["label"]).collect()) == 60
    frame = M.shared_folds(df, "id", "label", ["cat"], 2, [2]).frame(2)
    for name in M.MODEL_ORDER[:2]:
        assert M.fit_part(frame, name, "label", spec).transform(frame).select("probability").distinct().count() > 0


def test_embedding_takes_one_pass_over_the_tokens(spark):
    import hashlib

    from talentmatch.operators.embed import embed_hash
    texts = [(1, "um dois dois três \U0001d4d0\U0001d4d0 um"), (2, None), (3, "um " * 500), (4, "a")]
    e = embed_hash(spark.createDataFrame(texts, "id int, t string"), "id", "t", 8)
    plan = e._jdf.queryExecution().optimizedPlan().toString()
    assert "array_remove" not in plan and "sequence" not in plan
    got = {r["id"]: r["embedding"] for r in e.collect()}
    for i, tokens in [(1, ["um", "dois", "dois", "três", "um"]), (3, ["um"] * 500)]:
        want = [0.0] * 8
        for t in tokens:
            h = hashlib.md5(t.encode()).hexdigest()
            want[int(h[:8], 16) % 8] += 1 if int(h[8], 16) < 8 else -1
        n = math.sqrt(max(sum(x * x for x in want), 1))
        if i == 3:
            assert got[i] == [x / n for x in want]
    assert got[2] == got[4] == [0.0] * 8


def test_training_frames_have_no_more_partitions_than_cores(spark):
    from talentmatch.operators import models as M
    cores = spark.sparkContext.defaultParallelism
    frame = spark.range(1)
    assert [M._training_partitions(frame, n) for n in (0, 1, 4001, 4000 * cores, 4000 * cores * 50)] == [1, 1, 2, cores, cores]


def test_forests_grow_in_slices_side_by_side(spark, monkeypatch):
    from pyspark.ml.functions import array_to_vector

    from talentmatch.operators import models as M
    monkeypatch.setattr(M, "TREES_A_FIT", 4)
    rows = [(float((i * 7) % 3 == 0), [float(i % 7), float(i % 5), float(i % 11)]) for i in range(200)]
    df = spark.createDataFrame(rows, "label double, v array<double>").select("label", array_to_vector("v").alias("features"))
    fitted = lambda n: M._fit(M.estimators("label", M.ModelSpec(trees=n, depth=4), None)["RandomForest"], df, 3)
    forest, slice_ = fitted(10), fitted(4)
    assert forest.getNumTrees == 10 and len({t.toDebugString.split(")", 1)[1] for t in forest.trees}) > 4
    assert [t.toDebugString.split(")", 1)[1] for t in forest.trees[:4]] == [t.toDebugString.split(")", 1)[1] for t in slice_.trees]
    cores = spark.sparkContext.defaultParallelism
    assert [M._training_partitions(df, n, cores) for n in (0, 4001, 100_000, 100_001, 10 ** 9)] == [1, 1, 1, 2, cores]
