import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def run(code, env=None, cwd="/"):
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=cwd, timeout=300, env=os.environ | (env or {}))
    assert done.returncode == 0, done.stderr[-2000:]
    return done.stdout


def test_entry_imports_from_pyspark_zip():
    import pyspark
    lib = os.path.join(os.path.dirname(pyspark.__file__), "python", "lib")
    if not os.path.isdir(lib):
        pytest.skip("PySpark itself is not installed as a folder")
    path = ":".join(os.path.join(lib, f) for f in sorted(os.listdir(lib)) if f.endswith(".zip"))
    out = run(f"import sys; sys.path.insert(0, {ROOT!r})\nimport __spark_entry__ as e\nimport pyspark\n"
              "print(len(e.queries()), len(e.oracle_sql()), pyspark.__file__)", {"PYTHONPATH": path})
    n, m, where = out.split()
    assert int(n) > int(m) > 80 and "pyspark.zip" in where


def test_launch_settings_are_kept():
    code = (f"import sys; sys.path.insert(0, {ROOT!r})\nfrom talentmatch.session import get_session\ns = get_session()\n"
            "print(s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'), s.conf.get('spark.sql.session.timeZone'))")
    args = "--master local[2] --conf spark.sql.shuffle.partitions=7 --conf spark.ui.enabled=false pyspark-shell"
    assert run(code, {"PYSPARK_SUBMIT_ARGS": args}).split() == ["local[2]", "7", "UTC"]


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from talentmatch import session as S

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://elsewhere:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        S.checkpoint_root(Session())


def test_scratch_is_released(spark):
    from talentmatch import session as S
    path = S.scratch_path(spark, "test")
    spark.range(3).write.parquet(path)
    kept, S._SCRATCH[:] = list(S._SCRATCH), [path]
    S.release_scratch(spark)
    S._SCRATCH[:] = [p for p in kept if p != path]
    assert not os.path.exists(path)


def test_shipped_package_reaches_workers_from_another_folder():
    code = (f"import sys; sys.path.insert(0, {ROOT!r})\nfrom talentmatch.session import get_session, ship_package\n"
            "s = get_session(master='local[1]')\nship_package(s)\n"
            "def f(batches):\n    from talentmatch.functions.text import stop_words\n    import pyarrow as pa\n"
            "    for b in batches:\n        yield pa.RecordBatch.from_arrays([pa.array([len(stop_words())] * b.num_rows)], ['n'])\n"
            "print(s.range(1).mapInArrow(f, 'n long').first()[0])")
    assert run(code, cwd="/tmp").split()[-1] == "203"


def test_scratch_scope_removes_what_it_named_only(spark):
    from talentmatch.session import release_path, scratch_path, scratch_scope

    kept = scratch_path(spark, "kept")
    with scratch_scope(spark):
        inner = scratch_path(spark, "inner")
        spark.range(5).write.parquet(inner)
        with scratch_scope(spark):
            deep = scratch_path(spark, "deep")
            spark.range(2).write.parquet(deep)
        assert os.path.exists(inner) and not os.path.exists(deep)
        spark.read.parquet(inner).write.parquet(kept)
    assert not os.path.exists(inner)
    assert spark.read.parquet(kept).count() == 5
    release_path(spark, kept)
    release_path(spark, kept)
    assert not os.path.exists(kept)


def test_package_is_shipped_once_from_many_threads(spark, monkeypatch):
    import time
    from concurrent.futures import ThreadPoolExecutor
    from types import SimpleNamespace

    from talentmatch import session
    sent = []
    slow = SimpleNamespace(sparkContext=SimpleNamespace(applicationId="app", addPyFile=lambda p: (time.sleep(0.2), sent.append(p))))
    monkeypatch.setattr(session, "_SHIPPED", {})
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(session.ship_package, [slow] * 4))
    assert len(sent) == 1
