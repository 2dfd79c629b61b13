"""Training, comparison and scoring of hire classifiers.

All fitting is ``pyspark.ml`` on executors; the driver only loops over the
few candidate models and folds and keeps their metric rows.

Defaults follow the reproduced scripts where Spark has the same knob: logistic
regression with balanced class weights and an L2 penalty equal to C = 1
(``regParam = 1 / sum(weights)``, no standardisation), a random forest with
``sqrt`` feature subsets, gradient-boosted trees standing in for the boosting
library, and a soft vote of the three. Upsampling (M9) happens inside each
training fold; its copies are integer weights of one shared frame, and a fold
is weight 0, so no fold joins, shuffles or copies rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassificationModel, GBTClassifier, LogisticRegression, RandomForestClassificationModel,
                                       RandomForestClassifier)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talentmatch.operators import evaluate as E
from talentmatch.operators import features as FE
from talentmatch.operators import forest as FO
from talentmatch.operators import sampling as S
from talentmatch.operators.embed import with_hash

MODEL_ORDER = ["LogisticRegression", "RandomForest", "GradientBoostedTrees", "VotingClassifier"]


#: Training rows that are worth a task of their own.
ROWS_PER_PARTITION = 4000


#: Training rows that are too many for a task, if there are cores for more.
ROWS_A_TASK = 100_000
#: Trees of a forest that one fit grows.
TREES_A_FIT = 10


def _training_partitions(df: DataFrame, rows: int, side_by_side: int = 1) -> int:
    """No more than the rows fill, and no more than the cores of each of the fits ``side_by_side`` (of all,
    if a task would have to hold more than ``ROWS_A_TASK``): each solver iteration and each level of a
    tree is a job over all of them, whose tasks each send a result (of a forest a table of all its
    nodes, so that more partitions are more work, not less time)."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(1, min(-(-rows // ROWS_PER_PARTITION), cores, max(-(-cores // side_by_side), -(-rows // ROWS_A_TASK))))


@dataclass
class ModelSpec:
    """Sizes of the candidate models: those of the reproduced scripts. Their trees grow without a
    bound; 30 levels are the most that Spark's have."""
    lr_iter: int = 1000
    trees: int = 150
    depth: int = 30
    gbt_rounds: int = 150
    gbt_depth: int = 6
    vote_trees: int = 100
    seed: int = 42
    extra: dict = field(default_factory=dict)


def feature_frame(docs: DataFrame, key: str, text: str, cats: list[str], dim: int = 64, text_mode: str = "raw") -> DataFrame:
    """Text embedding (M10) next to the other columns (J6), row by row. ``text_mode`` ``clean`` embeds the
    cleaned text (T1) instead of the raw one; training and scoring take the same."""
    if text_mode not in ("raw", "clean"):
        raise ValueError(f"text mode must be raw or clean, got {text_mode!r}")
    if text_mode == "clean":
        docs = FE.preprocess_frame(docs, text, "__words").withColumn(text, F.array_join("__words", " ")).drop("__words")
    return with_hash(docs, text, dim, "emb").drop(text)


def feature_stages(cats: list[str]) -> list:
    """M5: one-hot routing for the categories (if there are any) + assembly with the embedding (M7)."""
    from pyspark.ml.feature import VectorAssembler
    return (FE.one_hot_stages(cats) if cats else []) + [VectorAssembler(
        inputCols=["emb_vec"] + [f"oh_{c}" for c in cats], outputCol="features")]


def with_emb_vector(df: DataFrame) -> DataFrame:
    from pyspark.ml.functions import array_to_vector
    return df.withColumn("emb_vec", array_to_vector("emb"))


def estimators(label: str, spec: ModelSpec, weight: str | None = "weight") -> dict:
    # tol 1e-4 is the convergence tolerance of the reproduced solver's default
    lr = LogisticRegression(featuresCol="features", labelCol=label, maxIter=spec.lr_iter,
                            elasticNetParam=0.0, standardization=False, tol=1e-4)
    if weight:
        lr.setWeightCol(weight)
    rf = RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=spec.trees,
                                maxDepth=spec.depth, featureSubsetStrategy="sqrt", seed=spec.seed,
                                cacheNodeIds=True)      # deep trees: a row keeps its nodes, and is not sent down every tree each level
    gbt = GBTClassifier(featuresCol="features", labelCol=label, maxIter=spec.gbt_rounds,
                        maxDepth=spec.gbt_depth, stepSize=0.3, lossType="logistic", seed=spec.seed)
    if weight:
        rf.setWeightCol(weight)
        gbt.setWeightCol(weight)
    return {"LogisticRegression": lr, "RandomForest": rf, "GradientBoostedTrees": gbt}


def _prob1(df: DataFrame, col: str = "probability") -> F.Column:
    return vector_to_array(F.col(col))[1]


def without_summary(model):
    """``model`` (a pipeline's last stage, too) without its training summary, which holds the training rows'
    DataFrame and the session. Tasks that score are sent the model, and a session cannot always be sent."""
    last = model.stages[-1] if isinstance(model, PipelineModel) else model
    if getattr(last, "hasSummary", False):
        last._java_obj.setSummary(SparkSession.active().sparkContext._jvm.scala.Option.empty())
    return model


def _slices(est) -> list[tuple[int, int]]:
    """(first tree, number of trees) of the fits that grow a forest; one for any other model."""
    if not isinstance(est, RandomForestClassifier):
        return [(0, 1)]
    return [(i, min(TREES_A_FIT, est.getNumTrees() - i)) for i in range(0, est.getNumTrees(), TREES_A_FIT)]


def _fit(est, train: DataFrame, threads: int = 1):
    """``est`` fitted on ``train``. The trees of a forest know nothing of each other: fits of a few trees,
    each with a seed of its own, run side by side, and their trees make one forest."""
    slices = _slices(est)
    if len(slices) == 1:
        return est.fit(train)
    grown = _in_threads(lambda s: est.copy({est.numTrees: s[1], est.seed: est.getSeed() + s[0]}).fit(train), slices, threads)
    first = grown[0]._java_obj
    return _forest(first.uid(), [t for m in grown for t in m._java_obj.trees()], first.numFeatures(), first.numClasses())


def _fit_bounded(est, train: DataFrame):
    """``_fit``, but a forest grows in tasks and stays off the driver (``forest``), unless its rows are more than
    a task may hold; then it grows as slices on a frame of as few partitions as its fits need."""
    if not isinstance(est, RandomForestClassifier):
        return _fit(est, train)

    def in_slices():
        fits = len(_slices(est))
        few = train.coalesce(_training_partitions(train, train.count(), fits))
        return _fit(est, few, min(fits, train.sparkSession.sparkContext.defaultParallelism))

    return FO.grow(train, est.getLabelCol(), est.getWeightCol(), est.getNumTrees(), est.getMaxDepth(), est.getSeed(), in_slices)


def _forest(uid: str, trees: list, n_features: int, n_classes: int) -> RandomForestClassificationModel:
    """The forest of these (JVM) trees."""
    jvm = SparkSession.active().sparkContext._gateway
    package = jvm.jvm.org.apache.spark.ml.classification
    some = jvm.new_array(package.DecisionTreeClassificationModel, len(trees))
    for i, t in enumerate(trees):
        some[i] = t
    forest = package.RandomForestClassificationModel(uid, some, n_features, n_classes)
    forest.set(forest.getParam("numTrees"), len(trees))       # what a stored forest is checked against
    return RandomForestClassificationModel(forest)


def fit_model(train: DataFrame, name: str, label: str, cats: list[str], spec: ModelSpec) -> PipelineModel:
    """Fit feature stages + one estimator (LR gets regParam = 1 / sum(weights))."""
    w = with_emb_vector(S.class_weights(train, label).withColumn(label, F.col(label).cast("double")))
    est = estimators(label, spec)[name]
    # every stage fit and every solver pass reads it: keep it
    w = w.coalesce(_training_partitions(w, train.count())).persist()
    try:
        if name == "LogisticRegression":
            total = w.agg(F.sum("weight")).collect()[0][0] or 1.0     # one number
            est = est.setRegParam(1.0 / float(total))
        made = Pipeline(stages=feature_stages(cats)).fit(w)
        model = _fit_bounded(est, made.transform(w))
        return without_summary(PipelineModel(stages=[*made.stages, model]))
    finally:
        w.unpersist()


def fit_tfidf(train: DataFrame, name: str, key: str, label: str, tokens: str, cats: list[str], spec: ModelSpec,
              max_features: int = 3000) -> PipelineModel:
    """M2/L1-L3: TF-IDF, imputed categories and one estimator, all fitted on ``train`` (balanced weights)."""
    w = S.class_weights(train, label).withColumn(label, F.col(label).cast("double"))
    w = w.coalesce(_training_partitions(w, train.count())).persist()
    try:
        est = estimators(label, spec)[name]
        if name == "LogisticRegression":
            est = est.setRegParam(1.0 / float(w.agg(F.sum("weight")).first()[0] or 1.0))
        return without_summary(Pipeline(stages=FE.tabular_stages(w, key, tokens, cats, max_features) + [est]).fit(w))
    finally:
        w.unpersist()


def predict(model: PipelineModel, df: DataFrame, key: str, keep: list[str] | None = None) -> DataFrame:
    """(key, *keep, prob, prediction) of class 1; ``keep`` carries columns (the label) along."""
    p = model.transform(with_emb_vector(df) if "emb" in df.columns else df)
    return p.select(key, *(keep or []), _prob1(p).alias("prob"), F.col("prediction").cast("int").alias("prediction"))


def gradient_norm(model: PipelineModel, train: DataFrame, label: str) -> float:
    """Length of the gradient of the balanced, penalised log loss at a logistic regression that
    ``fit_model`` fitted on ``train``: near 0 at the optimum, which is the only one."""
    w = with_emb_vector(S.class_weights(train, label).withColumn(label, F.col(label).cast("double")))
    scored = model.transform(w)
    off = (_prob1(scored) - F.col(label)) * F.col("weight")
    each = scored.select(off.alias("off"), "weight", F.posexplode(vector_to_array("features")).alias("i", "x"))
    sums = each.groupBy("i").agg(F.sum(F.col("off") * F.col("x")).alias("g"), F.sum("off").alias("b"), F.sum("weight").alias("w")).collect()
    coef = model.stages[-1].coefficients       # as many as features
    total = sums[0]["w"]
    return (sum(((r["g"] + coef[r["i"]]) / total) ** 2 for r in sums) + (sums[0]["b"] / total) ** 2) ** 0.5


def fit_vote(train: DataFrame, label: str, cats: list[str], spec: ModelSpec) -> dict:
    small = ModelSpec(lr_iter=spec.lr_iter, trees=spec.vote_trees, depth=spec.depth,
                      gbt_rounds=spec.vote_trees, gbt_depth=spec.gbt_depth, seed=spec.seed)
    names = MODEL_ORDER[:3]
    return {n: fit_model(train, n, label, cats, small) for n in names}


def predict_vote(members: dict, df: DataFrame, key: str, keep: list[str] | None = None) -> DataFrame:
    """L4 soft vote: mean of member probabilities, > 0.5 -> 1. The members score the same rows one
    after the other; no row is joined back."""
    rows, probs = with_emb_vector(df), []
    made = ["features", "rawPrediction", "probability", "prediction"]
    for i, model in enumerate(members.values()):
        known = rows.columns
        out = model.transform(rows)
        probs.append(f"p{i}")
        rows = out.withColumn(f"p{i}", _prob1(out)).select(*known, f"p{i}").drop(*made)
    v = E.soft_vote(rows, probs)
    return v.select(key, *(keep or []), "prob", "prediction")


def fit_any(train: DataFrame, name: str, label: str, cats: list[str], spec: ModelSpec):
    if name == "VotingClassifier":
        return fit_vote(train, label, cats, spec)
    return fit_model(train, name, label, cats, spec)


def predict_any(model, df: DataFrame, key: str, keep: list[str] | None = None) -> DataFrame:
    return predict_vote(model, df, key, keep) if isinstance(model, dict) else predict(model, df, key, keep)


@dataclass
class Folds:
    """Training rows with their folds and weights (``sampling.fold_weights``), and the feature stages of
    every training part: part ``k`` is all rows."""
    rows: DataFrame
    k: int
    label: str
    stages: dict

    def frame(self, part: int) -> DataFrame:
        """(fold, label, features, w): the rows as part ``part`` sees them."""
        out = self.stages[part].transform(self.rows)
        return out.select("fold", self.label, "features", F.col("weights")[part].cast("double").alias("w"))


def shared_folds(df: DataFrame, key: str, label: str, cats: list[str], k: int = 5, parts: list[int] | None = None,
                 leaky: bool = False, side_by_side: int = 1) -> Folds:
    """One cached, vectorised frame for all folds. The feature stages are fitted once for each training part.

    ``leaky`` upsamples before folding, as the scripts do: copies are rows of their own, and may stand
    on both sides of a fold.

    The frame has no more partitions than its rows, or the cores of one of the fits ``side_by_side``, fill."""
    if leaky:
        copies = S.stratified_folds(S.upsample_minority(df, label, key).drop("slot"), label, key, k)
        weighted = copies.withColumn("weights", F.array(*[(F.col("fold") != f).cast("int") for f in range(k)], F.lit(1)))
    else:
        weighted = S.fold_weights(df, label, key, k)
    rows = with_emb_vector(weighted).withColumn(label, F.col(label).cast("double"))
    rows = rows.select(key, label, "emb_vec", *cats, "fold", "weights")
    rows = rows.coalesce(_training_partitions(rows, df.count(), side_by_side)).persist()
    fit = lambda part: Pipeline(stages=feature_stages(cats)).fit(rows.where(F.col("weights")[part] > 0))
    wanted = list(range(k + 1)) if parts is None else parts
    return Folds(rows, k, label, dict(zip(wanted, _in_threads(fit, wanted, 4))))


def fit_part(frame: DataFrame, name: str, label: str, spec: ModelSpec):
    """One model on the rows of a part that have a weight (after M9 the classes weigh alike)."""
    est = estimators(label, spec)[name].setWeightCol("w")
    train = frame.where("w > 0")
    if name == "LogisticRegression":
        est = est.setRegParam(1.0 / float(train.agg(F.sum("w")).first()[0] or 1.0))
    if name == "GradientBoostedTrees":      # parts are boosted side by side, each in a task
        return FO.grow_boosted(train, label, "w", est.getMaxIter(), est.getMaxDepth(), est.getStepSize(), lambda: _fit(est, train))
    return without_summary(_fit_bounded(est, train))


def first_trees(model, n: int):
    """The ensemble of a fitted ensemble's first ``n`` trees: what boosting of ``n`` rounds gives, and a
    forest of ``n`` trees."""
    if isinstance(model, (FO.RandomForestClassificationTrees, FO.GBTClassificationTrees)):
        return model.first(n)
    trees = model._java_obj.trees()
    if n >= len(trees):
        return without_summary(model)
    gateway = model._java_obj
    if not isinstance(model, GBTClassificationModel):
        return _forest(f"{model.uid}_{n}", list(trees[:n]), gateway.numFeatures(), gateway.numClasses())
    jvm = SparkSession.active().sparkContext._gateway
    some = jvm.new_array(jvm.jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n)
    weights = jvm.new_array(jvm.jvm.double, n)
    for i, w in enumerate(gateway.treeWeights()[:n]):
        some[i], weights[i] = trees[i], float(w)
    package = jvm.jvm.org.apache.spark.ml.classification
    return GBTClassificationModel(package.GBTClassificationModel(f"{model.uid}_{n}", some, weights, gateway.numFeatures(), gateway.numClasses()))


def _scored(models: dict, frame: DataFrame, spec: ModelSpec, names: list[str]) -> DataFrame:
    """``frame`` plus, for each name, (prob, prediction) as columns p_<i>, y_<i>; models score one after the other."""
    made = ["rawPrediction", "probability", "prediction"]

    def prob(df, model, out):
        scored = model.transform(df.drop(*made))
        return scored.withColumn(out, _prob1(scored))

    members = []
    for i, name in enumerate(names):
        if name == "VotingClassifier":
            for j, n in enumerate(MODEL_ORDER[:3]):
                small = models[n] if n == "LogisticRegression" else first_trees(models[n], spec.vote_trees)
                frame = prob(frame, small, f"m_{j}")
                members.append(f"m_{j}")
            frame = frame.withColumn(f"p_{i}", sum(F.col(c) for c in members) / float(len(members)))
        else:
            frame = prob(frame, models[name], f"p_{i}")
        frame = frame.withColumn(f"y_{i}", (F.col(f"p_{i}") > 0.5).cast("int"))
    return frame.drop(*made)


def _f1s(scored: DataFrame, label: str, names: list[str]) -> list[float]:
    """F1 of class 1 for each model, in one pass."""
    hit, true = [F.col(f"y_{i}") == 1 for i in range(len(names))], F.col(label) == 1
    count = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    row = scored.agg(*[c for i, h in enumerate(hit) for c in (count(h & true).alias(f"tp{i}"), count(h).alias(f"pp{i}"))], count(true).alias("t")).first()
    return [2 * row[f"tp{i}"] / (row[f"pp{i}"] + row["t"]) if row[f"pp{i}"] + row["t"] else 0.0 for i in range(len(names))]


def _fitted(folds: Folds, parts: list[int], names: list[str], spec: ModelSpec, threads: int) -> tuple[dict, dict]:
    """(models, frames): every needed model of every part, fitted side by side. Frames are made of the cached rows
    anew: a fit reads its frame a few times and then holds it in a form of its own."""
    needed = [n for n in MODEL_ORDER[:3] if n in names or "VotingClassifier" in names]
    frames = {part: folds.frame(part) for part in parts}
    # the later models are the dearer ones: they start first
    tasks = [(part, n) for n in reversed(needed) for part in reversed(parts)]
    models = dict(zip(tasks, _in_threads(lambda t: fit_part(frames[t[0]], t[1], folds.label, spec), tasks, threads)))
    return {part: {n: models[part, n] for n in needed} for part in parts}, frames


def cross_val_f1(df: DataFrame, name: str, key: str, label: str, cats: list[str], spec: ModelSpec,
                 k: int = 5, leaky: bool = False, threads: int = 8) -> DataFrame:
    """F1 of class 1 on each of ``k`` stratified folds (M11), the training part upsampled (M9)
    inside each fold, as weights of one shared frame. Returns (model, fold, f1).

    Folds are fitted side by side from ``threads`` driver threads (what ``CrossValidator`` does): each
    fit is a series of small Spark jobs.
    """
    folds = shared_folds(df, key, label, cats, k, list(range(k)), leaky, min(k, threads))
    models, frames = _fitted(folds, list(range(k)), [name], spec, threads)
    try:
        rows = [(name, f, _f1s(_scored(models[f], frames[f].where(F.col("fold") == f), spec, [name]), label, [name])[0]) for f in range(k)]
    finally:
        folds.rows.unpersist()
    return df.sparkSession.createDataFrame(rows, "model string, fold int, f1 double")


def _in_threads(fn, items, workers: int) -> list:
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=max(1, workers)) as pool:
        return list(pool.map(fn, items))


def leaderboard(train: DataFrame, test: DataFrame, key: str, label: str, cats: list[str],
                spec: ModelSpec, names: list[str] = MODEL_ORDER, k: int = 5, store: str | None = None,
                threads: int = 8, evaluate_on: str = "holdout") -> DataFrame:
    """(model, model_order, cv_f1, f1) for each candidate model; ``f1`` is that of ``test``, or of the
    training rows themselves where ``evaluate_on`` is ``all`` (as one of the scripts does).

    All parts (the folds, and all training rows) share one cached frame with weights; the vote
    (L4) is made of the fitted members, of the tree ensembles the first ``spec.vote_trees``. With
    ``store`` the model of the best hold-out F1 (the first of equals) is saved there, its feature
    stages and its classification report (a table, ``<store>/report``) with it; where no F1 is
    above 0 there is no winner, and nothing is stored.
    """
    spark = train.sparkSession
    folds = shared_folds(train, key, label, cats, k, side_by_side=threads)
    models, frames = _fitted(folds, list(range(k + 1)), names, spec, threads)
    try:
        cv = [_f1s(_scored(models[f], frames[f].where(F.col("fold") == f), spec, names), label, names) for f in range(k)]
        held = folds.stages[k].transform(with_emb_vector(train if evaluate_on == "all" else test).withColumn(label, F.col(label).cast("double"))).select(key, label, "features")
        scored = _scored(models[k], held, spec, names).persist()
        f1 = _f1s(scored, label, names)
        best = max(range(len(names)), key=lambda i: (f1[i], -i))
        if store and f1[best] > 0:
            members = {n: m if n == "LogisticRegression" else first_trees(m, spec.vote_trees) for n, m in models[k].items()}
            chosen = members if names[best] == "VotingClassifier" else {"": models[k][names[best]]}
            for n, m in chosen.items():
                PipelineModel(stages=[*folds.stages[k].stages, m]).write().overwrite().save(f"{store}/model/{n}".rstrip("/"))
            report = scored.select(F.col(label).cast("int").alias(label), F.col(f"y_{best}").alias("prediction"))
            E.classification_report(report, label=label).write.mode("overwrite").parquet(f"{store}/report")
    finally:
        folds.rows.unpersist()
    rows = [(n, i, sum(c[i] for c in cv) / k, f1[i]) for i, n in enumerate(names)]
    return spark.createDataFrame(rows, "model string, model_order int, cv_f1 double, f1 double")


def save_model(model: PipelineModel, path: str) -> str:
    """S8."""
    model.write().overwrite().save(path)
    return path


def save_any(model, path: str) -> str:
    """S8 of a single model, or of every member of a vote (in a folder of its name)."""
    for name, m in model.items() if isinstance(model, dict) else [("", model)]:
        save_model(m, f"{path}/{name}".rstrip("/"))
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
