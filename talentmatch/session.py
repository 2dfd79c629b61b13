"""SparkSession defaults and the shared scratch location.

Intermediate tables (JSON shards, stream sinks, model stores written by the
registered queries) go under ``spark.checkpoint.dir``: on a cluster that is the
shared folder the cluster names; only when it is unset (tests, local runs) do
we create one under the local temp folder.
"""

from __future__ import annotations

import atexit
import contextlib
import os
import re
import shutil
import tempfile
import threading
import uuid
import zipfile

from pyspark.sql import SparkSession

_LOCAL_FALLBACK: str | None = None


#: Options of this package's queries, set where the launch leaves them open.
RUNTIME_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

#: Whole documents are long rows. By Spark's own numbers a task holds 4,096 of them as a Parquet batch
#: and up to 10,000 or 64 MB as an Arrow batch, in the JVM and again in its Python worker.
DOCUMENT_DEFAULTS = {
    "spark.sql.parquet.columnarReaderBatchSize": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}


def _launched() -> bool:
    """Whether spark-submit or PYSPARK_SUBMIT_ARGS has chosen the master."""
    return "PYSPARK_GATEWAY_PORT" in os.environ or "--master" in os.environ.get("PYSPARK_SUBMIT_ARGS", "")


def get_session(master: str | None = None, app: str = "talentmatch",
                shuffle_partitions: int | None = None,
                driver_memory: str | None = None) -> SparkSession:
    """The running session, or a new one.

    A launch by spark-submit keeps its master, memory, partitions and folders:
    only SQL options that it leaves open are set, on the running session. A
    plain Python process (tests, the bench) gets a local master.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if not _launched() and SparkSession.getActiveSession() is None:
        cpus = os.environ.get("BENCH_CPUS", "8")
        builder = (builder.master(master or f"local[{cpus}]")
                   .config("spark.driver.memory", driver_memory or os.environ.get("TM_DRIVER_MEMORY", "8g"))
                   .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus) * 2))
                   .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false"))
    spark = builder.getOrCreate()
    launch = spark.sparkContext.getConf()
    for key, value in RUNTIME_DEFAULTS.items():
        if not launch.contains(key):
            spark.conf.set(key, value)
    if shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def bounded_batches(spark: SparkSession) -> None:
    """Small batches for tables of whole documents, unless the session has sizes of its own. They hold
    from now on: Spark reads them when a query runs, which for a result is after its operator has returned."""
    own = spark.conf.getAll
    for key, value in DOCUMENT_DEFAULTS.items():
        if key not in own:
            spark.conf.set(key, value)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for written intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session (or the context's
    checkpoint dir). Without one, a local master gets a temporary folder of
    this process, removed at its end; any other master is an error, as its
    executors would write where nobody else can read.
    """
    global _LOCAL_FALLBACK
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if _LOCAL_FALLBACK is None:
            _LOCAL_FALLBACK = tempfile.mkdtemp(prefix="talentmatch-ckpt-")
            atexit.register(shutil.rmtree, _LOCAL_FALLBACK, ignore_errors=True)
        root = _LOCAL_FALLBACK
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder."""
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def release_scratch(spark: SparkSession, since: int = 0) -> None:
    """Remove all that ``scratch_path`` has named so far (but for the first ``since`` paths); call it
    when no result is read any more."""
    while len(_SCRATCH) > since:
        _delete(spark, _SCRATCH.pop())


def release_path(spark: SparkSession, path: str) -> None:
    """Remove one folder that ``scratch_path`` has named."""
    if path in _SCRATCH:
        _SCRATCH.remove(path)
        _delete(spark, path)


def _delete(spark: SparkSession, name: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """What ``scratch_path`` names inside is removed at the end. A result that leaves the scope must
    have been written to a path named before it."""
    since = len(_SCRATCH)
    try:
        yield
    finally:
        release_scratch(spark, since)


_SHIPPED: dict[str, str] = {}
_SHIPPING = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers (``addPyFile``), once per application.

    Tasks that run Python code import it by name; the workers' path need not
    hold the repository. Executors that start later fetch the file as well.
    """
    with _SHIPPING:     # fits run from several threads
        sc = spark.sparkContext
        if sc.applicationId in _SHIPPED:
            return
        here = os.path.dirname(os.path.abspath(__file__))
        folder = tempfile.mkdtemp(prefix="talentmatch-ship-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        path = os.path.join(folder, "talentmatch_src.zip")
        with zipfile.ZipFile(path, "w") as z:
            for root, _, files in os.walk(here):
                for f in sorted(files):
                    if f.endswith(".py"):
                        full = os.path.join(root, f)
                        z.write(full, os.path.join("talentmatch", os.path.relpath(full, here)))
        sc.addPyFile(path)
        _SHIPPED[sc.applicationId] = path
