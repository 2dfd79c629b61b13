"""Whole analysis of candidates (R5): validation, P(hire) and the most similar jobs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from talentmatch.operators import recommend as R
from talentmatch.operators.curate import validate_candidates


def analyze_candidates(candidates: DataFrame, score: Callable[[DataFrame], DataFrame], jobs: DataFrame, details: DataFrame,
                       key: str = "candidate_id", vec: str = "embedding", k: int = 3,
                       prepared: R.JobIndex | None = None) -> DataFrame:
    """One row per candidate: key, valid, violations, probabilidade_contratacao and vagas_recomendadas.

    ``candidates`` holds the form's fields and the vector ``vec``; ``score`` gives (key,
    probabilidade_contratacao) of valid candidates. A rejected candidate has neither a probability
    nor recommendations; a valid one without a vector, or against an empty catalogue, has an empty
    list. Keys are unique.
    """
    checked = validate_candidates(candidates)
    valid = checked.where("valid")
    top = R.recommend_topk(valid, jobs, k=k, cand_key=key, vec=vec, prepared=prepared)
    nested = R.recommend_nested(R.attach_details(top, details), cand_key=key, candidates=valid)
    return (checked.select(key, "valid", "violations").join(score(valid), key, "left").join(nested, key, "left")
            .select(key, "valid", "violations", "probabilidade_contratacao", "vagas_recomendadas"))
