"""Sampling and evaluation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from talentmatch.operators import evaluate as E
from talentmatch.operators import sampling as S
from talentmatch.plans import fixtures as fx
from talentmatch.plans.registry import query

SQL_MD5 = "md5('42-' || CAST({k} AS VARCHAR))"
SQL_LONG = "('0x' || substr({h}, 1, 15))::BIGINT"


def _labels(spark, sf):
    return fx.table(spark, sf, "labels")


def _rn_sql(part):
    p = f"PARTITION BY {part} " if part else ""
    return f"row_number() OVER ({p}ORDER BY {SQL_MD5.format(k='doc_id')}, doc_id)"


@query("seeded_order", sql=f"SELECT doc_id, {SQL_MD5.format(k='doc_id')} AS shuffle_key FROM labels")
def seeded_order(spark, sf):
    """O3: the seeded shuffle order key (sort by it for the shuffled order)."""
    return _labels(spark, sf).select("doc_id", S.seed_hash("doc_id").alias("shuffle_key"))


@query("stratified_folds", sql=f"""
SELECT doc_id, toxic, CAST(({_rn_sql('toxic')} - 1) % 5 AS INTEGER) AS fold FROM labels""")
def stratified_folds(spark, sf):
    """Stratified, shuffled 5 folds (seed 42)."""
    return S.stratified_folds(_labels(spark, sf).select("doc_id", "toxic"), "toxic", "doc_id")


@query("stratified_split", sql=f"""
SELECT doc_id, toxic, {_rn_sql('toxic')} <= round(0.2 * count(*) OVER (PARTITION BY toxic)) AS is_test
FROM labels""")
def stratified_split(spark, sf):
    """M8 exact: per class the first round(20 %) in seeded order are test rows."""
    return S.stratified_split(_labels(spark, sf).select("doc_id", "toxic"), "toxic", "doc_id")


@query("hash_split", sql=f"""
SELECT doc_id, {SQL_LONG.format(h=SQL_MD5.format(k='doc_id'))} % 10000 < 2000 AS is_test FROM labels""")
def hash_split(spark, sf):
    """M8 scalable: md5 bucket split, no shuffle."""
    return S.hash_split(_labels(spark, sf).select("doc_id"), "doc_id")


@query("upsample_minority", sql=f"""
WITH one AS (SELECT doc_id, toxic, {_rn_sql(None)} - 1 AS r FROM labels WHERE toxic = 1),
m AS (SELECT count(*) AS m FROM one),
n0 AS (SELECT count(*) AS n0 FROM labels WHERE toxic = 0),
slots AS (SELECT s.range AS slot, {SQL_LONG.format(h=SQL_MD5.format(k='s.range'))} % m.m AS r
          FROM range((SELECT n0 FROM n0)) s, m)
SELECT doc_id, toxic, CAST(NULL AS BIGINT) AS slot FROM labels WHERE toxic = 0
UNION ALL
SELECT one.doc_id, one.toxic, slots.slot FROM slots JOIN one USING (r)""")
def upsample_minority(spark, sf):
    """M9: class 1 drawn with replacement to the size of class 0, appended to it."""
    return S.upsample_minority(_labels(spark, sf).select("doc_id", "toxic"), "toxic", "doc_id")


@query("class_weights", sql="""
SELECT doc_id, toxic, count(*) OVER () / (count(DISTINCT toxic) OVER () * count(*) OVER (PARTITION BY toxic))
  AS weight FROM labels""")
def class_weights(spark, sf):
    """A10: balanced class weights n / (k * n_c) per row."""
    return S.class_weights(_labels(spark, sf).select("doc_id", "toxic"), "toxic").select("doc_id", "toxic", "weight")


@query("class_counts", sql="SELECT toxic, count(*) AS n FROM labels GROUP BY toxic")
def class_counts(spark, sf):
    """A3: rows per class."""
    return _labels(spark, sf).groupBy("toxic").agg(F.count(F.lit(1)).alias("n"))


# predictions: truth = quality, prediction = toxic
@query("confusion_counts", sql="""
SELECT quality AS label, toxic AS prediction, count(*) AS n FROM labels GROUP BY ALL""")
def confusion_counts(spark, sf):
    """A8."""
    p = _labels(spark, sf).select(F.col("quality").alias("label"), F.col("toxic").alias("prediction"))
    return E.confusion_counts(p)


@query("f1_binary", sql="""
SELECT round(coalesce(2.0 * sum(CASE WHEN quality = 1 AND toxic = 1 THEN 1 ELSE 0 END) /
       nullif(2 * sum(CASE WHEN quality = 1 AND toxic = 1 THEN 1 ELSE 0 END)
              + sum(CASE WHEN quality = 0 AND toxic = 1 THEN 1 ELSE 0 END)
              + sum(CASE WHEN quality = 1 AND toxic = 0 THEN 1 ELSE 0 END), 0), 0), 6) AS f1
FROM labels""")
def f1_binary(spark, sf):
    """F1 of class 1."""
    p = _labels(spark, sf).select(F.col("quality").alias("label"), F.col("toxic").alias("prediction"))
    return E.f1_binary(p).select(F.round("f1", 6).alias("f1"))


@query("classification_report", sql="""
WITH cc AS (SELECT quality AS y, toxic AS p, count(*) AS n FROM labels GROUP BY ALL),
cls AS (SELECT DISTINCT CAST(y AS VARCHAR) AS c FROM cc UNION SELECT DISTINCT CAST(p AS VARCHAR) FROM cc),
per AS (SELECT c,
          coalesce((SELECT sum(n) FROM cc WHERE CAST(y AS VARCHAR) = c AND CAST(p AS VARCHAR) = c), 0) AS tp,
          coalesce((SELECT sum(n) FROM cc WHERE CAST(p AS VARCHAR) = c), 0) AS pp,
          coalesce((SELECT sum(n) FROM cc WHERE CAST(y AS VARCHAR) = c), 0) AS support FROM cls),
m AS (SELECT c AS "row", coalesce(tp / nullif(pp, 0), 0) AS precision, coalesce(tp / nullif(support, 0), 0) AS recall,
             coalesce(2 * tp / nullif(pp + support, 0), 0) AS f1, CAST(support AS BIGINT) AS support, tp FROM per),
allr AS (
  SELECT "row", precision, recall, f1, support FROM m
  UNION ALL SELECT 'accuracy', NULL, NULL, sum(tp) / sum(support), CAST(sum(support) AS BIGINT) FROM m
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM m
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                   sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM m)
SELECT "row", round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM allr""")
def classification_report(spark, sf):
    """Per-class precision / recall / F1 / support plus accuracy, macro and weighted rows."""
    p = _labels(spark, sf).select(F.col("quality").alias("label"), F.col("toxic").alias("prediction"))
    r = E.classification_report(p)
    return r.select("row", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


_BOARD_SQL = """
b AS (SELECT d.source AS model, d.source AS model_order,
        coalesce(2.0 * sum(CASE WHEN l.quality = 1 AND l.toxic = 1 THEN 1 ELSE 0 END) /
          nullif(2 * sum(CASE WHEN l.quality = 1 AND l.toxic = 1 THEN 1 ELSE 0 END)
                 + sum(CASE WHEN l.quality = 0 AND l.toxic = 1 THEN 1 ELSE 0 END)
                 + sum(CASE WHEN l.quality = 1 AND l.toxic = 0 THEN 1 ELSE 0 END), 0), 0) AS f1
      FROM labels l JOIN documents d USING (doc_id) GROUP BY d.source)"""


def _board(spark, sf):
    lab = _labels(spark, sf).join(fx.table(spark, sf, "documents").select("doc_id", "source"), "doc_id")
    p = lab.select(F.col("source").alias("model"), F.col("quality").alias("label"),
                   F.col("toxic").alias("prediction"))
    return E.f1_binary(p, by=["model"]).withColumn("model_order", F.col("model"))


@query("best_model", sql=f"""
WITH {_BOARD_SQL}
SELECT model, round(f1, 6) AS f1 FROM b WHERE f1 > 0 ORDER BY f1 DESC, model_order LIMIT 1""")
def best_model(spark, sf):
    """The first board entry with the highest positive F1 (board: one 'model' per source)."""
    return E.best_model(_board(spark, sf)).select("model", F.round("f1", 6).alias("f1"))


_PROBS_SQL = """
pr AS (SELECT doc_id, quality,
         ((doc_id * 37) % 101) / 100.0 AS p_lr, ((doc_id * 53) % 97) / 96.0 AS p_rf,
         ((doc_id * 71) % 89) / 88.0 AS p_gb FROM labels)"""


def _probs(spark, sf):
    d = F.col("doc_id")
    return _labels(spark, sf).select(
        "doc_id", "quality", (((d * 37) % 101) / 100.0).alias("p_lr"),
        (((d * 53) % 97) / 96.0).alias("p_rf"), (((d * 71) % 89) / 88.0).alias("p_gb"))


@query("soft_vote", sql=f"""
WITH {_PROBS_SQL}
SELECT doc_id, round((p_lr + p_rf + p_gb) / 3.0, 6) AS prob,
       CASE WHEN (p_lr + p_rf + p_gb) / 3.0 > 0.5 THEN 1 ELSE 0 END AS prediction FROM pr""")
def soft_vote(spark, sf):
    """L4: mean of member probabilities (given by a formula on doc_id), > 0.5 -> 1."""
    v = E.soft_vote(_probs(spark, sf), ["p_lr", "p_rf", "p_gb"])
    return v.select("doc_id", F.round("prob", 6).alias("prob"), "prediction")


# a fixed linear scorer: w_i = ((i mod 7) - 3) / 10, intercept -0.1 (64 inputs)
LINEAR_COEF = [((i % 7) - 3) / 10 for i in range(64)]
LINEAR_INTERCEPT = -0.1


@query("linear_score", sql=f"""
WITH c AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
z AS (SELECT vec_id, {LINEAR_INTERCEPT} + list_sum(list_transform(range(1, len(e) + 1),
        lambda i: e[i] * (((i - 1) % 7) - 3) / 10.0)) AS z FROM c)
SELECT vec_id AS candidate_id, round(1 / (1 + exp(-z)), 4) AS probabilidade_contratacao FROM z""")
def linear_score(spark, sf):
    """P(hire) of a linear model from its coefficient vector, as column math."""
    c = fx.candidate_vectors(spark, sf)
    return E.linear_score(c, "embedding", LINEAR_COEF, LINEAR_INTERCEPT).select(
        "candidate_id", "probabilidade_contratacao")


@query("cv_mean", sql=f"""
WITH f AS (SELECT doc_id, quality, toxic, ({_rn_sql('toxic')} - 1) % 5 AS fold FROM labels),
s AS (SELECT fold, coalesce(2.0 * sum(CASE WHEN quality = 1 AND toxic = 1 THEN 1 ELSE 0 END) /
        nullif(2 * sum(CASE WHEN quality = 1 AND toxic = 1 THEN 1 ELSE 0 END)
               + sum(CASE WHEN quality = 0 AND toxic = 1 THEN 1 ELSE 0 END)
               + sum(CASE WHEN quality = 1 AND toxic = 0 THEN 1 ELSE 0 END), 0), 0) AS f1 FROM f GROUP BY fold)
SELECT round(avg(f1), 6) AS mean_f1 FROM s""")
def cv_mean(spark, sf):
    """A2: mean F1 over the 5 stratified folds."""
    f = S.stratified_folds(_labels(spark, sf), "toxic", "doc_id")
    p = f.select("fold", F.col("quality").alias("label"), F.col("toxic").alias("prediction"))
    return E.cv_mean(E.f1_binary(p, by=["fold"])).select(F.round("mean_f1", 6).alias("mean_f1"))
