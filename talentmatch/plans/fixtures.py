"""Driver tables standing in for the domain tables (see FIXTURES.md section 3).

Every function reads the given parquet tables lazily; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark, sf_dir) -> DataFrame:
    """The documents table spread over the cores (text rules are CPU-bound).

    Round-robin, not by key: a later (doc, term) aggregation then shuffles
    after the text rules ran once, and that shuffle is reused by every branch.
    """
    from talentmatch.operators.partitioning import spread
    return spread(table(spark, sf_dir, "documents"))


def job_vectors(spark, sf_dir) -> DataFrame:
    """Every embedding is a job, and every one a candidate, so both sides grow with the data."""
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("codigo_vaga"), "embedding")


def candidate_vectors(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("candidate_id"), "embedding", "label")


def job_details(spark, sf_dir) -> DataFrame:
    """Job title / activities / skills from ``part`` (p_partkey = vec_id)."""
    return (table(spark, sf_dir, "part")
            .select(F.col("p_partkey").alias("codigo_vaga"),
                    F.col("p_name").alias("titulo_vaga"),
                    F.col("p_type").alias("principais_atividades"),
                    F.col("p_brand").alias("competencias")))


# ---------------------------------------------------------------------------
# Unified application table stand-in (base_tratada before curation)
# ---------------------------------------------------------------------------
# documents -> applicant side (cv_pt = text; categories from lang / source),
# labels -> status text (toxic plays "hired"), part -> job side (documents in
# Spanish name no job, so some applications have no job columns).
# NA tokens and nulls are made on both sides: nullif(lang, 'de') and
# source 'src0' -> 'N/A'.

HIRED_TEXT = "  Contratado pela Decision "
OTHER_TEXT = "Encaminhado ao Requisitante"


def documents_with_gaps(spark, sf_dir) -> DataFrame:
    return with_gaps(documents(spark, sf_dir))


def with_gaps(d: DataFrame) -> DataFrame:
    return d.select(
        "doc_id", "text",
        F.expr("nullif(lang, 'de')").alias("lang"),
        F.when(F.col("source") == "src0", F.lit("N/A")).otherwise(F.col("source")).alias("source"),
        "n_chars")


def unified(spark, sf_dir) -> DataFrame:
    d = documents_with_gaps(spark, sf_dir)
    lab = table(spark, sf_dir, "labels")
    jobs = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("jk"), "p_name", "p_type", "p_brand")
    named = F.when(~d["lang"].eqNullSafe("es"), d["doc_id"])
    status = F.when(F.col("toxic") == 1, F.lit(HIRED_TEXT)).when(F.col("toxic") == 0, F.lit(OTHER_TEXT))
    return (d.join(lab, "doc_id", "left").join(jobs, named == jobs["jk"], "left")
            .select(
                F.col("doc_id").cast("string").alias("codigo_profissional"),
                F.col("text").alias("cv_pt"),
                F.col("lang").alias("nivel_academico"),
                F.col("source").alias("nivel_ingles_x"),
                F.col("lang").alias("nivel_espanhol_x"),
                F.col("source").alias("area_atuacao"),
                F.col("lang").alias("objetivo_profissional"),
                F.col("source").alias("conhecimentos_tecnicos"),
                F.col("jk").cast("string").alias("codigo_vaga"),
                F.col("p_name").alias("titulo_vaga"),
                F.col("p_type").alias("nivel_profissional"),
                F.col("p_brand").alias("tipo_contratacao"),
                F.col("p_type").alias("areas_atuacao"),
                F.col("p_type").alias("principais_atividades"),
                F.col("p_brand").alias("competencias"),
                F.col("source").alias("nivel_ingles_y"),
                F.col("lang").alias("nivel_espanhol_y"),
                status.alias("situacao_candidato")))


UNIFIED_SQL = f"""
unified AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS codigo_profissional, d.text AS cv_pt,
         nullif(d.lang, 'de') AS nivel_academico,
         CASE WHEN d.source = 'src0' THEN 'N/A' ELSE d.source END AS nivel_ingles_x,
         nullif(d.lang, 'de') AS nivel_espanhol_x,
         CASE WHEN d.source = 'src0' THEN 'N/A' ELSE d.source END AS area_atuacao,
         nullif(d.lang, 'de') AS objetivo_profissional,
         CASE WHEN d.source = 'src0' THEN 'N/A' ELSE d.source END AS conhecimentos_tecnicos,
         CAST(p.p_partkey AS VARCHAR) AS codigo_vaga, p.p_name AS titulo_vaga,
         p.p_type AS nivel_profissional, p.p_brand AS tipo_contratacao, p.p_type AS areas_atuacao,
         p.p_type AS principais_atividades, p.p_brand AS competencias,
         CASE WHEN d.source = 'src0' THEN 'N/A' ELSE d.source END AS nivel_ingles_y,
         nullif(d.lang, 'de') AS nivel_espanhol_y,
         CASE WHEN l.toxic = 1 THEN '{HIRED_TEXT}' WHEN l.toxic = 0 THEN '{OTHER_TEXT}' END
           AS situacao_candidato
  FROM documents d
  LEFT JOIN labels l ON l.doc_id = d.doc_id
  LEFT JOIN part p ON p.p_partkey = CASE WHEN d.lang IS DISTINCT FROM 'es' THEN d.doc_id END
)"""



def sql_str_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def sql_na(col: str) -> str:
    """F16 in SQL: NA tokens become NULL."""
    from talentmatch.functions.text import NA_TOKENS
    return f"CASE WHEN {col} IN ({sql_str_list(NA_TOKENS)}) THEN NULL ELSE {col} END"


_NA_COLS = ["cv_pt", "nivel_academico", "nivel_ingles_x", "nivel_espanhol_x", "area_atuacao",
            "objetivo_profissional", "conhecimentos_tecnicos", "codigo_vaga", "titulo_vaga",
            "nivel_profissional", "tipo_contratacao", "areas_atuacao", "principais_atividades",
            "competencias", "situacao_candidato"]

# The curated base (V7) in SQL: NA tokens -> label -> projection -> dropna.
CURATED_SQL = UNIFIED_SQL + ",\nreloaded AS (SELECT codigo_profissional, " + ", ".join(
    f"{sql_na(c)} AS {c}" for c in _NA_COLS) + """ FROM unified),
curated AS (
  SELECT codigo_profissional, cv_pt, nivel_academico, nivel_ingles_x AS nivel_ingles,
         nivel_espanhol_x AS nivel_espanhol, area_atuacao, objetivo_profissional,
         conhecimentos_tecnicos, codigo_vaga, titulo_vaga, nivel_profissional, tipo_contratacao,
         areas_atuacao, principais_atividades, competencias,
         CASE WHEN lower(trim(situacao_candidato)) = 'contratado pela decision' THEN 1 ELSE 0 END
           AS foi_contratado
  FROM reloaded
  WHERE cv_pt IS NOT NULL AND titulo_vaga IS NOT NULL AND principais_atividades IS NOT NULL
    AND competencias IS NOT NULL
)"""
