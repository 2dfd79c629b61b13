"""Top-k job recommendation by cosine similarity.

The scripts score one candidate against every job and sort all scores. Here the catalogue is an index
of blocks (``vector_index``): candidates meet blocks as matrix products, blocks whose best possible
cosine is below a candidate's k-th are skipped, and only the k best of a block leave a task. No
candidate x job row is ever made: the output has ``k`` rows per candidate.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talentmatch.functions import vectors as V
from talentmatch.operators import vector_index as VI
from talentmatch.operators.partitioning import spread
from talentmatch.operators.vector_index import JobIndex, prepare_jobs  # noqa: F401 - part of this interface
from talentmatch.session import scratch_path


def _check_k(k: int) -> None:
    if k is None or int(k) <= 0:
        raise ValueError(f"top_k must be a positive integer, got {k!r}")


def recommend_topk(candidates: DataFrame, jobs: DataFrame, k: int = 3,
                   cand_key: str = "candidate_id", job_key: str = "codigo_vaga",
                   vec: str = "embedding", digits: int | None = 4,
                   block_size: int = 4096, broadcast_bytes: int = 64 << 20, clusters: int | None = None,
                   part_rows: int = VI.PACK_ROWS, prepared: JobIndex | None = None, met: str | None = None) -> DataFrame:
    """(cand_key, rank, job_key, similaridade): the ``k`` most similar jobs, exact.

    ``clusters`` (or ``prepared``, see ``prepare_jobs``, which also spares the work on the jobs' side
    where several calls meet one catalogue) cuts the catalogue by centroids, so that far blocks are
    skipped. A catalogue of up to ``broadcast_bytes`` is broadcast; a larger one is met block by
    block, in packs of ``part_rows`` candidates. Ties go to the lower job key. Candidates whose
    vector is null, empty or not finite are left out (see :func:`reject_invalid_vectors`).
    Candidate keys are unique. ``met`` adds the number of blocks that each candidate met.
    """
    _check_k(k)
    spark = candidates.sparkSession
    index = prepared or prepare_jobs(jobs, job_key, vec, block_size, clusters)
    if not candidates.isStreaming:
        # scoring is compute-bound: spread a narrow input over the cores first
        candidates = spread(candidates.select(cand_key, vec), cand_key)

    def written(df, name):
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.parquet(path)

    top = VI.search(candidates, index, int(k), cand_key, job_key, jobs.schema[job_key].dataType, vec, broadcast_bytes, part_rows, written, met)
    sim = F.round("sim", digits) if digits is not None else F.col("sim")
    return top.select(cand_key, "rank", job_key, sim.alias("similaridade"), *([met] if met else []))


def recommend_one(vector: list[float], jobs: DataFrame, k: int = 3, job_key: str = "codigo_vaga", vec: str = "embedding",
                  digits: int | None = 4) -> DataFrame:
    """S10 + O1: (rank, job_key, similaridade) of one candidate, whose vector is part of the plan.

    One scan of the jobs; every task keeps its ``k`` best (``TakeOrderedAndProject``): no join, no
    index, no window over jobs. A vector that cannot be scored gives no rows.
    """
    _check_k(k)
    numbers = [float(x) for x in vector] if vector and all(x is not None for x in vector) else []
    length = math.sqrt(sum(x * x for x in numbers))
    if not numbers or not math.isfinite(length):
        jobs, numbers, length = jobs.where("false"), [0.0], 0.0
    unit = F.array(*[F.lit(x / length if length else 0.0) for x in numbers])
    scored = V.with_unit(jobs.where(VI.scorable(vec)), vec, "__u")
    dot = F.aggregate(F.zip_with("__u", unit, lambda a, b: F.coalesce(a * b, F.lit(0.0))), F.lit(0.0), lambda s, x: s + x)
    top = scored.select(job_key, dot.alias("sim")).orderBy(F.desc("sim"), job_key).limit(int(k))
    # k rows: their place is their rank
    found = top.agg(F.array_sort(F.collect_list(F.struct((-F.col("sim")).alias("neg"), F.col(job_key).alias("job")))).alias("r"))
    rows = found.select(F.posexplode("r").alias("pos", "t"))
    sim = F.round(-F.col("t.neg"), digits) if digits is not None else -F.col("t.neg")
    return rows.select((F.col("pos") + 1).cast("int").alias("rank"), F.col("t.job").alias(job_key), sim.alias("similaridade"))


def topk_per_group(df: DataFrame, group: str | list[str], score: str, k: int = 3,
                   tie: str | list[str] | None = None, rank: str = "rank") -> DataFrame:
    """O1: the ``k`` highest ``score`` rows of every group, ranked from 1.

    A ``row_number`` filter, which Catalyst plans as a ``WindowGroupLimit``
    both before and after the shuffle: every map task keeps at most ``k`` rows
    per group, so a hot group reaches its reducer pre-trimmed. Ties go to the
    lower ``tie`` columns; null scores rank last.
    """
    _check_k(k)
    groups = [group] if isinstance(group, str) else list(group)
    ties = [] if tie is None else ([tie] if isinstance(tie, str) else list(tie))
    w = Window.partitionBy(*groups).orderBy(F.col(score).desc_nulls_last(), *[F.col(t).asc() for t in ties])
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= int(k))


def reject_invalid_vectors(candidates: DataFrame, vec: str = "embedding") -> DataFrame:
    """Candidates that cannot be scored (null or empty vector, or an entry that is not finite)."""
    return candidates.where(~F.coalesce(VI.scorable(vec), F.lit(False)))


def attach_details(topk: DataFrame, catalog: DataFrame, job_key: str = "codigo_vaga") -> DataFrame:
    """Join job details (title, activities, skills) onto the top-k rows."""
    return topk.join(catalog, job_key, "left")


def recommend_nested(topk_with_details: DataFrame, cand_key: str = "candidate_id",
                     job_key: str = "codigo_vaga", candidates: DataFrame | None = None) -> DataFrame:
    """One row per candidate with ``vagas_recomendadas`` sorted by rank; with ``candidates``
    given, those without any recommendation have an empty list (R4).

    The group per candidate holds exactly ``k`` rows, so collect_list is bounded.
    """
    item = F.struct(
        F.col("rank"),
        F.col(job_key).cast("bigint").alias("codigo"),
        F.col("titulo_vaga").alias("titulo"),
        F.col("similaridade"),
        F.col("principais_atividades").alias("atividades"),
        F.col("competencias"))
    nested = (topk_with_details.groupBy(cand_key)
              .agg(F.array_sort(F.collect_list(item)).alias("recs"))
              .select(cand_key, F.transform("recs", lambda r: r.dropFields("rank")).alias("vagas_recomendadas")))
    if candidates is None:
        return nested
    empty = F.array().cast(nested.schema["vagas_recomendadas"].dataType)
    return (candidates.select(cand_key).join(nested, cand_key, "left")
            .select(cand_key, F.coalesce("vagas_recomendadas", empty).alias("vagas_recomendadas")))


def job_catalog(base: DataFrame, key: str = "codigo_vaga", fill_all: bool = True) -> DataFrame:
    """Distinct jobs with their combined text.

    ``fill_all`` (P9) fills every part with ''; otherwise (P8) a null title
    gives a null text and only the other two parts are filled.
    """
    from talentmatch.operators.curate import distinct_on

    jobs = distinct_on(base.select(key, "titulo_vaga", "principais_atividades", "competencias"), [key])
    title = F.coalesce("titulo_vaga", F.lit("")) if fill_all else F.col("titulo_vaga")
    text = F.concat(title, F.lit(" "), F.coalesce("principais_atividades", F.lit("")),
                    F.lit(" "), F.coalesce("competencias", F.lit("")))
    return jobs.withColumn("texto_vaga", text)
