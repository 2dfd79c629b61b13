"""The whole analysis (R5) as a batch: validation, L7's linear scorer and the top-3 jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from talentmatch.operators import analyze as A
from talentmatch.operators import evaluate as E
from talentmatch.plans import fixtures as fx
from talentmatch.plans.q_curate import _VALIDATE_SQL, candidate_forms
from talentmatch.plans.q_eval import LINEAR_COEF, LINEAR_INTERCEPT
from talentmatch.plans.q_recommend import _DETAILS_SQL, _VECTORS_SQL
from talentmatch.plans.registry import query

ANALYZE_SQL = f"""
WITH {_VECTORS_SQL}, {_DETAILS_SQL}, {_VALIDATE_SQL.replace("c AS (", "forms AS (").replace("FROM c)", "FROM forms)")},
z AS (SELECT candidate_id, {LINEAR_INTERCEPT} + list_sum(list_transform(range(1, len(e) + 1),
        lambda i: e[i] * (((i - 1) % 7) - 3) / 10.0)) AS z FROM c),
recs AS (SELECT t.candidate_id,
                to_json(list({{'codigo': t.codigo_vaga, 'titulo': d.titulo_vaga, 'similaridade': t.similaridade,
                               'atividades': d.principais_atividades, 'competencias': d.competencias}}
                             ORDER BY t.rank)) AS vagas_recomendadas
         FROM top t LEFT JOIN details d USING (codigo_vaga) GROUP BY t.candidate_id)
SELECT v.doc_id AS candidate_id, len(violations) = 0 AS valid, array_to_string(violations, ',') AS violations,
       CASE WHEN len(violations) = 0 THEN round(1 / (1 + exp(-z.z)), 4) END AS probabilidade_contratacao,
       CASE WHEN len(violations) = 0 THEN coalesce(CAST(recs.vagas_recomendadas AS VARCHAR), '[]') END AS vagas_recomendadas
FROM v LEFT JOIN z ON z.candidate_id = v.doc_id LEFT JOIN recs ON recs.candidate_id = v.doc_id"""


def linear_probability(candidates):
    return E.linear_score(candidates.where(F.col("embedding").isNotNull()), "embedding", LINEAR_COEF, LINEAR_INTERCEPT).select(
        "candidate_id", "probabilidade_contratacao")


@query("analyze_validated", sql=ANALYZE_SQL)
def analyze_validated(spark, sf):
    """R5 whole: forms made of documents, vectors of the same id; rejected forms are listed, not scored."""
    vectors = fx.table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    forms = candidate_forms(fx.table(spark, sf, "documents")).join(vectors, "doc_id", "left").withColumnRenamed("doc_id", "candidate_id")
    out = A.analyze_candidates(forms, linear_probability, fx.job_vectors(spark, sf), fx.job_details(spark, sf))
    return out.withColumn("violations", F.array_join("violations", ",")).withColumn("vagas_recomendadas", F.to_json("vagas_recomendadas", {"ignoreNullFields": "false"}))
