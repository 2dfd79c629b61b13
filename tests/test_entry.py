import os
import sys

import __spark_entry__ as E

from conftest import SF


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["candidate_id", "rank", "codigo_vaga", "similaridade"]
    assert len(rows) == 3 * 500


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 80


def test_stream_equals_batch(spark):
    q = E.queries()
    a = sorted(tuple(r) for r in q["stream_recommend"](spark, SF).collect())
    b = sorted(tuple(r) for r in q["recommend_topk"](spark, SF).collect())
    assert a == b


def test_new_queries_match_their_oracles(spark):
    import duckdb
    import os
    import sys
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
    from check_oracle import TABLES, rows_of

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    q, sql = E.queries(), E.oracle_sql()
    for name in ["job_text_filled", "topk_per_group", "embedding_roundtrip", "analyze_linear", "recommend_blocks", "recommend_empty",
                 "json_lines_scan", "drift_plan", "validate_candidates"]:
        df = q[name](spark, SF)
        res = con.execute(sql[name])
        ocols = [d[0] for d in res.description]
        assert sorted(df.columns) == sorted(ocols), name
        assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(ocols, res.fetchall()), name


def test_entry_works_without_the_training_data_operators(tmp_path):
    """Deleted wholly, or with an empty folder (or its compiled files) left behind."""
    import shutil
    import subprocess

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for left in ("", "talentmatch/llm", "talentmatch/llm/__pycache__"):
        at = tmp_path / (left.replace("/", "-") or "none")
        shutil.copytree(root, at, ignore=lambda d, names: [n for n in names if n in (".git", "tests", "llm", "corpus_pipeline.py", "__pycache__")])
        if left:
            (at / left).mkdir(parents=True)
        code = "import __spark_entry__ as E; q = E.queries(); assert len(q) > 90 and 'pipeline' not in q; E.oracle_sql()"
        subprocess.run([sys.executable, "-c", code], cwd=at, check=True, env={**os.environ, "PYTHONPATH": str(at)})
