"""Evaluation tables.

All metrics start from the confusion counts (one partial aggregate over the
predictions); everything after that works on a handful of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _div(a, b):
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def confusion_counts(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                     by: list[str] = ()) -> DataFrame:
    """(by..., label, prediction, n)."""
    return pred.groupBy(*by, label, prediction).agg(F.count(F.lit(1)).alias("n"))


def _binary_counts(pred: DataFrame, label: str, prediction: str, by: list[str], pos=1):
    y, p = F.col(label) == pos, F.col(prediction) == pos
    return pred.groupBy(*by).agg(
        F.sum(F.when(y & p, 1).otherwise(0)).alias("tp"),
        F.sum(F.when(~y & p, 1).otherwise(0)).alias("fp"),
        F.sum(F.when(y & ~p, 1).otherwise(0)).alias("fn"),
        F.count(F.lit(1)).alias("n"))


def f1_binary(pred: DataFrame, label: str = "label", prediction: str = "prediction",
              by: list[str] = (), pos=1) -> DataFrame:
    """F1 of the positive class, 0 when undefined (no positives at all)."""
    c = _binary_counts(pred, label, prediction, list(by), pos)
    f1 = _div(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))
    return c.select(*by, f1.cast("double").alias("f1"))


def classification_report(pred: DataFrame, label: str = "label",
                          prediction: str = "prediction") -> DataFrame:
    """(row, precision, recall, f1, support) per class plus accuracy,
    macro avg and weighted avg. Classes are the labels present in truth or
    prediction; undefined ratios are 0."""
    cc = confusion_counts(pred, label, prediction)
    # each confusion cell counts towards its true class (tp, support) and its
    # predicted class (predicted positives); no join needed
    same = F.col(label).cast("string") == F.col(prediction).cast("string")
    contrib = cc.select(F.explode(F.array(
        F.struct(F.col(label).cast("string").alias("cls"),
                 F.when(same, F.col("n")).otherwise(0).alias("tp"),
                 F.lit(0).cast("bigint").alias("pp"), F.col("n").alias("support")),
        F.struct(F.col(prediction).cast("string").alias("cls"), F.lit(0).cast("bigint").alias("tp"),
                 F.col("n").alias("pp"), F.lit(0).cast("bigint").alias("support")))).alias("c"))
    per = (contrib.select("c.*").groupBy("cls")
           .agg(F.sum("tp").alias("tp"), F.sum("pp").alias("pp"), F.sum("support").alias("support")))
    per = per.select(
        F.col("cls").alias("row"),
        _div(F.col("tp"), F.col("pp")).alias("precision"),
        _div(F.col("tp"), F.col("support")).alias("recall"),
        _div(2 * F.col("tp"), F.col("pp") + F.col("support")).alias("f1"),
        F.col("support").cast("bigint").alias("support"),
        F.col("tp"))
    summary = per.agg(
        F.sum("tp").alias("tp_all"), F.sum("support").alias("n_all"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("wp"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("wr"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("wf"))
    acc = summary.select(F.lit("accuracy").alias("row"), F.lit(None).cast("double").alias("precision"),
                         F.lit(None).cast("double").alias("recall"),
                         (F.col("tp_all") / F.col("n_all")).alias("f1"),
                         F.col("n_all").cast("bigint").alias("support"))
    macro = summary.select(F.lit("macro avg").alias("row"), F.col("mp").alias("precision"),
                           F.col("mr").alias("recall"), F.col("mf").alias("f1"),
                           F.col("n_all").cast("bigint").alias("support"))
    weighted = summary.select(F.lit("weighted avg").alias("row"), F.col("wp").alias("precision"),
                              F.col("wr").alias("recall"), F.col("wf").alias("f1"),
                              F.col("n_all").cast("bigint").alias("support"))
    return per.drop("tp").unionByName(acc).unionByName(macro).unionByName(weighted)


def best_model(board: DataFrame, score: str = "f1", order: str = "model_order") -> DataFrame:
    """Strict '>' from 0 over the board in order: the first model with the
    highest positive score wins; no row when every score is 0."""
    return board.where(F.col(score) > 0).orderBy(F.desc(score), F.asc(order)).limit(1)


def cv_mean(fold_scores: DataFrame, score: str = "f1", by: list[str] = ()) -> DataFrame:
    """A2: mean of the fold scores."""
    return fold_scores.groupBy(*by).agg(F.avg(score).alias(f"mean_{score}"))


def soft_vote(probs: DataFrame, member_cols: list[str], out_prob: str = "prob",
              out_pred: str = "prediction") -> DataFrame:
    """L4: mean of the members' class-1 probabilities; predict 1 iff > 0.5."""
    mean = sum(F.col(c) for c in member_cols) / F.lit(float(len(member_cols)))
    return probs.withColumn(out_prob, mean).withColumn(
        out_pred, F.when(F.col(out_prob) > 0.5, 1).otherwise(0))


def linear_score(df: DataFrame, vec: str, coef: list[float], intercept: float,
                 out: str = "probabilidade_contratacao", digits: int | None = 4) -> DataFrame:
    """P(class 1) of a fitted linear model, sigmoid(b + w.x), as column math.

    ``coef`` is the model's coefficient vector (bounded by the feature width).
    """
    w = F.array(*[F.lit(float(c)) for c in coef])
    z = F.aggregate(F.zip_with(F.col(vec).cast("array<double>"), w, lambda a, b: a * b),
                    F.lit(float(intercept)), lambda s, x: s + x)
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
    return df.withColumn(out, F.round(p, digits) if digits is not None else p)
