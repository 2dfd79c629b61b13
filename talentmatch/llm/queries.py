"""The registered queries of the operators, over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talentmatch.llm import decontaminate as DC
from talentmatch.llm import language as LG
from talentmatch.llm import licenses as LI
from talentmatch.llm import mixing as MX
from talentmatch.llm import near_dedup as ND
from talentmatch.llm import order_minhash as OM
from talentmatch.llm import pii as PI
from talentmatch.llm import prefix_tree as PT
from talentmatch.llm import pseudo_likelihood as PL
from talentmatch.llm import structure_repair as SR
from talentmatch.llm import toxicity as TX
from talentmatch.llm import warc as WA
from talentmatch.llm import whitening as WH


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its sequence of licence sentences and the licences that rules find in it."""
    found = LI.scan(_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "sequence", F.array_join("licences", ",").alias("licences"), "n_known", "n_unmatched")


def op2_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page: what its WARC record, read back from the archives, says; in capture order."""
    found = WA.archive_pages(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "timestamp")


def op3_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: fingerprints of its text and of its edited text, and how alike they are."""
    return OM.compare_edited(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op4_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the summed log probability of every word given the words around it."""
    return PL.pseudo_likelihood(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def _joined_spans(spans) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: personal data as written (counts, digest) and all spans, the disguised ones added."""
    found = PI.find(_table(spark, sf_dir, "documents"))
    rank = {k: i for i, k in enumerate(PI.KINDS)}

    def place(s):
        order = F.coalesce(*[F.when(s["kind"] == k, F.lit(i)) for k, i in rank.items()])
        return F.struct(s["start"].alias("start"), order.alias("order"), s["end"].alias("end"), s["kind"].alias("kind"))

    every = F.array_sort(F.transform(F.concat("base", "added"), place))

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in PI.KINDS]
    return found.select(F.col("id").alias("doc_id"), *counts, F.sha2(_joined_spans("base"), 256).alias("base_sha256"),
                        _joined_spans(every).alias("spans"), F.size("added").cast("long").alias("n_added"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its words inside any 10-word window of a benchmark item, and those items."""
    found = DC.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), size=10)
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its words, its source's words and target, and the words that the mix takes of it."""
    rows, sources = MX.mix(_table(spark, sf_dir, "documents"))
    return MX.taken(rows, sources).withColumnRenamed("id", "doc_id").select("doc_id", "size", "source_size", "target", "taken")


def _remainder(id_col: str, of: int) -> Column:
    return F.crc32(F.col(id_col).cast("string")) % of


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: a toxicity score, learned from the labels of documents that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    labels = _table(spark, sf_dir, "labels").where(_remainder("doc_id", 4) != 2)
    found = TX.score(docs, TX.train(docs, labels))
    return found.select(F.col("id").alias("doc_id"), (_remainder("id", 4) == 2).alias("held_out"), "score",
                        (F.col("score") >= 0.3).cast("int").alias("predicted"), F.size("passages").cast("long").alias("n_passages"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the component of documents whose 4-word shingles are alike by 0.8 or more."""
    found = ND.near_duplicates(_table(spark, sf_dir, "documents"), size=4, percent=80)
    return found.withColumnRenamed("id", "doc_id")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its language, learned from documents that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    model = LG.train(docs.where(_remainder("doc_id", 5) != 0))
    found = LG.identify(docs, model)
    return found.select(F.col("id").alias("doc_id"), (_remainder("id", 5) == 0).alias("held_out"), "lang_pred", "score")


def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per conversation, after damage: its faults, the cheapest repair's cost and edits, the repaired text's hash."""
    return SR.repair(SR.damage(_table(spark, sf_dir, "conversations")))


#: A conversation whose texts hold the template's own control strings.
CONTROL = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def op12_prefix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per conversation: its turns and the text under its loss mask, read back from the packed prefix trees."""
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame(CONTROL, "conv_id long, turn long, role string, text string")
    return PT.read_back(PT.prefix_trees(rows.unionAll(added)))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per vector and component: its whitened coordinate, fitted on all vectors."""
    found = WH.whiten(_table(spark, sf_dir, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "component", "n", F.col("deviation").try_cast("long").alias("deviation"),
                        "whitened", "explained", "identity_error")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_licenses, op2_warc_index, op3_order_minhash, op4_pseudo_likelihood, op5_pii, op6_decontamination, op7_mixing,
        op8_toxicity, op9_near_dedup, op10_language, op11_structure_repair,
        op12_prefix_tree, op13_whitening)}
