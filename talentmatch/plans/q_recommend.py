"""Recommendation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from talentmatch.operators import recommend as R
from talentmatch.plans import fixtures as fx
from talentmatch.plans.registry import query

# linear scorer shared with L7 (linear_score)
from talentmatch.plans.q_eval import LINEAR_COEF, LINEAR_INTERCEPT  # noqa: E402

_VECTORS_SQL = """
j AS (SELECT vec_id AS codigo_vaga, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
c AS (SELECT vec_id AS candidate_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
s AS (SELECT c.candidate_id, j.codigo_vaga, list_cosine_similarity(c.e, j.e) AS sim FROM c, j),
r AS (SELECT *, row_number() OVER (PARTITION BY candidate_id ORDER BY sim DESC, codigo_vaga) AS rk FROM s),
top AS (SELECT candidate_id, CAST(rk AS INTEGER) AS rank, codigo_vaga, round(sim, 4) AS similaridade
        FROM r WHERE rk <= 3)"""

_DETAILS_SQL = """
details AS (SELECT p_partkey AS codigo_vaga, p_name AS titulo_vaga, p_type AS principais_atividades,
                   p_brand AS competencias FROM part)"""


def topk(spark, sf, k=3):
    return R.recommend_topk(fx.candidate_vectors(spark, sf), fx.job_vectors(spark, sf), k=k)


@query("recommend_topk", sql=f"WITH {_VECTORS_SQL} SELECT * FROM top")
def recommend_topk(spark, sf):
    """Flagship: top-3 jobs per candidate by cosine similarity."""
    return topk(spark, sf)


@query("recommend_details", sql=f"""
WITH {_VECTORS_SQL}, {_DETAILS_SQL}
SELECT t.candidate_id, t.rank, t.codigo_vaga, d.titulo_vaga, t.similaridade,
       d.principais_atividades, d.competencias
FROM top t LEFT JOIN details d USING (codigo_vaga)""")
def recommend_details(spark, sf):
    """R3 flat: top-3 with job details."""
    t = R.attach_details(topk(spark, sf), fx.job_details(spark, sf))
    return t.select("candidate_id", "rank", "codigo_vaga", "titulo_vaga", "similaridade",
                    "principais_atividades", "competencias")


@query("recommend_one", sql=f"""
WITH {_VECTORS_SQL}
SELECT rank, codigo_vaga, similaridade FROM top WHERE candidate_id = (SELECT min(vec_id) FROM embeddings)""")
def recommend_one(spark, sf):
    """S10 + O1: the top-3 of one candidate, by a scan of all jobs."""
    jobs = fx.job_vectors(spark, sf)
    one = fx.candidate_vectors(spark, sf).orderBy("candidate_id").first()
    return R.recommend_one(list(one["embedding"]), jobs, k=3)


@query("recommend_nested", sql=f"""
WITH {_VECTORS_SQL}, {_DETAILS_SQL}
SELECT t.candidate_id,
       to_json(list({{'codigo': t.codigo_vaga, 'titulo': d.titulo_vaga, 'similaridade': t.similaridade,
                      'atividades': d.principais_atividades, 'competencias': d.competencias}}
                    ORDER BY t.rank)) AS vagas_recomendadas
FROM top t LEFT JOIN details d USING (codigo_vaga)
GROUP BY t.candidate_id""")
def recommend_nested(spark, sf):
    """R3 nested: one row per candidate, recommendations as a JSON array (API shape)."""
    t = R.attach_details(topk(spark, sf), fx.job_details(spark, sf))
    n = R.recommend_nested(t)
    return n.select("candidate_id", F.to_json("vagas_recomendadas", {"ignoreNullFields": "false"}).alias("vagas_recomendadas"))


@query("job_catalog", sql="""
SELECT codigo_vaga, titulo_vaga, principais_atividades, competencias,
       coalesce(titulo_vaga, '') || ' ' || coalesce(principais_atividades, '') || ' ' ||
       coalesce(competencias, '') AS texto_vaga
FROM (SELECT p_partkey AS codigo_vaga, p_name AS titulo_vaga, p_type AS principais_atividades,
             p_brand AS competencias FROM part)""")
def job_catalog(spark, sf):
    """Distinct jobs with the filled combined text."""
    part = fx.table(spark, sf, "part").select(
        F.col("p_partkey").alias("codigo_vaga"), F.col("p_name").alias("titulo_vaga"),
        F.col("p_type").alias("principais_atividades"), F.col("p_brand").alias("competencias"))
    return R.job_catalog(part, fill_all=True)


@query("recommend_empty", sql="SELECT vec_id AS candidate_id, '[]' AS vagas_recomendadas FROM embeddings")
def recommend_empty(spark, sf):
    """Against an empty catalogue every candidate has an empty list."""
    cands = fx.candidate_vectors(spark, sf)
    top = R.recommend_topk(cands, fx.job_vectors(spark, sf).where("false"))
    n = R.recommend_nested(R.attach_details(top, fx.job_details(spark, sf)), candidates=cands)
    return n.select("candidate_id", F.to_json("vagas_recomendadas", {"ignoreNullFields": "false"}).alias("vagas_recomendadas"))


@query("recommend_invalid", sql="""
SELECT vec_id AS candidate_id FROM embeddings WHERE label = 3 OR embedding IS NULL OR len(embedding) = 0""")
def recommend_invalid(spark, sf):
    """Candidates that cannot be scored (null or empty vector, made so for a label) are reported."""
    cands = fx.candidate_vectors(spark, sf).withColumn("embedding", F.when(F.col("label") != 3, F.col("embedding")))
    return R.reject_invalid_vectors(cands).select("candidate_id")


@query("recommend_blocks", sql=f"WITH {_VECTORS_SQL} SELECT * FROM top")
def recommend_blocks(spark, sf):
    """R3 past the broadcast limit: many job blocks, met by packs of candidates in two rounds."""
    return R.recommend_topk(fx.candidate_vectors(spark, sf), fx.job_vectors(spark, sf), k=3,
                            block_size=64, broadcast_bytes=0, part_rows=128, clusters=16)


@query("recommend_pruned", sql=f"""
WITH {_VECTORS_SQL}
SELECT *, true AS within FROM top""")
def recommend_pruned(spark, sf):
    """R3 by the cluster index: blocks that cannot hold one of the best are skipped; ``within``: the
    candidate met at least one block and at most all of them."""
    index = R.prepare_jobs(fx.job_vectors(spark, sf), block_size=32, clusters=32)
    top = R.recommend_topk(fx.candidate_vectors(spark, sf), fx.job_vectors(spark, sf), k=3, prepared=index, met="met")
    return top.withColumn("within", F.col("met").between(1, index.n_blocks)).drop("met")


@query("topk_per_group", sql="""
WITH s AS (SELECT l_suppkey, l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS revenue
           FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey
                                   ORDER BY revenue DESC NULLS LAST, l_orderkey, l_linenumber) AS rk FROM s)
SELECT l_suppkey, CAST(rk AS INTEGER) AS rank, l_orderkey, l_linenumber, round(revenue, 4) AS revenue
FROM r WHERE rk <= 3""")
def topk_per_group(spark, sf):
    """O1 as a general operator: the 3 highest-revenue lines of every supplier."""
    li = fx.table(spark, sf, "lineitem").select(
        "l_suppkey", "l_orderkey", "l_linenumber",
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"))
    top = R.topk_per_group(li, "l_suppkey", "revenue", k=3, tie=["l_orderkey", "l_linenumber"])
    return top.select("l_suppkey", F.col("rank").cast("int"), "l_orderkey", "l_linenumber",
                      F.round("revenue", 4).alias("revenue"))


@query("analyze_linear", sql=f"""
WITH {_VECTORS_SQL}, {_DETAILS_SQL},
z AS (SELECT candidate_id, {LINEAR_INTERCEPT} + list_sum(list_transform(range(1, len(e) + 1),
        lambda i: e[i] * (((i - 1) % 7) - 3) / 10.0)) AS z FROM c),
recs AS (SELECT t.candidate_id,
                to_json(list({{'codigo': t.codigo_vaga, 'titulo': d.titulo_vaga, 'similaridade': t.similaridade,
                               'atividades': d.principais_atividades, 'competencias': d.competencias}}
                             ORDER BY t.rank)) AS vagas_recomendadas
         FROM top t LEFT JOIN details d USING (codigo_vaga) GROUP BY t.candidate_id)
SELECT z.candidate_id, round(1 / (1 + exp(-z.z)), 4) AS probabilidade_contratacao, recs.vagas_recomendadas
FROM z LEFT JOIN recs USING (candidate_id)""")
def analyze_linear(spark, sf):
    """R5 with L7's linear scorer: P(hire) and the top-3 jobs of every candidate."""
    from talentmatch.operators import evaluate as E
    cands = fx.candidate_vectors(spark, sf)
    prob = E.linear_score(cands, "embedding", LINEAR_COEF, LINEAR_INTERCEPT).select(
        "candidate_id", "probabilidade_contratacao")
    nested = R.recommend_nested(R.attach_details(topk(spark, sf), fx.job_details(spark, sf)))
    return prob.join(nested, "candidate_id", "left").select(
        "candidate_id", "probabilidade_contratacao",
        F.to_json("vagas_recomendadas", {"ignoreNullFields": "false"}).alias("vagas_recomendadas"))
