"""The corpus pipeline: documents through toxicity, near duplicates, benchmark passages, personal
data and mixing. Every stage works on all its predecessor kept, written as Parquet in the shared
folder and read again, so a lost executor costs at most one stage's work. All stages but the last
return the columns of documents; the last gives each kept document its part of the mix. What a stage
itself writes to the shared folder is removed with it, but for tables of ids, and a stage's output
once its successor's is written.

Rows are told apart by id and text, so repeated ids are no trouble; rows with a null id are judged
by their text alone and are never near duplicates of others. Further columns, whatever their names,
are carried along by all stages but the last. An empty table passes all stages and gives no rows;
texts are taken whole, in batches of bounded size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talentmatch.llm import decontaminate, mixing, near_dedup, pii, toxicity
from talentmatch.llm.membership import only, without
from talentmatch.session import bounded_batches, release_path, scratch_path, scratch_scope


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _unused(docs: DataFrame, name: str) -> str:
    """``name``, lengthened until no column has it (in any case)."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.3; learned from the labels that op8_toxicity learns from."""
    bounded_batches(spark)
    labels = _table(spark, sf_dir, "labels").where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2)
    return toxicity.without_toxic(docs, toxicity.train(docs, labels), 0.3)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group alike by 0.8 in 5-word shingles: that of the smallest id, once."""
    bounded_batches(spark)
    path = scratch_path(spark, "components")
    with scratch_scope(spark):
        near_dedup.near_duplicates(docs, size=5, percent=80).write.parquet(path)
    found = spark.read.parquet(path)
    others = found.where("id IS NOT NULL AND id != component_id").select("id").distinct()
    repeated = found.where("id IS NOT NULL").groupBy("id").count().where("count > 1").select("id")
    kept = without(docs, "doc_id", others)
    if repeated.isEmpty():
        return kept
    once = only(kept, "doc_id", repeated).dropDuplicates(["doc_id", "text"])
    return without(kept, "doc_id", repeated).unionAll(once)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any 10-word window of a benchmark item (of shorter items: all their words)."""
    bounded_batches(spark)
    key, name = F.xxhash64("doc_id", "text"), _unused(docs, "key")
    path = scratch_path(spark, "contaminated")
    with scratch_scope(spark):
        found = decontaminate.decontaminate(docs.select(key.alias("key"), "text"), _table(spark, sf_dir, "benchmark"), size=10, id_col="key")
        found.where("contaminated").select(F.col("id").alias(name)).distinct().write.parquet(path)
    return without(docs.withColumn(name, key), name, spark.read.parquet(path)).select(docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked by its kind in brackets; n_chars counts the new text."""
    bounded_batches(spark)
    return pii.redact(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target and taken (words, repeats counted)."""
    bounded_batches(spark)
    rows, sources = mixing.mix(docs)
    return mixing.taken(rows, sources).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark_passages),
    ("personal data", mask_personal_data),
    ("mixing", mix_sources),
]

#: A learned filter and similarity components have no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, in order, from ``documents``."""
    docs, last = _table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        with scratch_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if last:
            release_path(spark, last)
        docs, last = spark.read.parquet(path), path
    return docs
