"""All registered queries (importing the query modules fills the registry)."""

from __future__ import annotations

from talentmatch.plans import q_analyze, q_curate, q_drift, q_eval, q_models, q_recommend, q_stream, q_text  # noqa: F401
from talentmatch.plans.registry import ORACLES, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
