"""Corpus statistics and feature builders.

TF-IDF follows the smoothed, L2-normalised definition with a vocabulary of
the ``max_features`` most frequent terms (ties: term ascending):

    idf(t) = ln((1 + n_docs) / (1 + df(t))) + 1,   w = tf * idf / ||tf * idf||

The vocabulary is the only thing that reaches the driver and it is bounded by
``max_features``. Per-document weights are produced in long form
``(doc, term, weight)`` by joins and aggregations, or as ``pyspark.ml``
sparse vectors for model training.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.feature import (CountVectorizerModel, ElementwiseProduct, Normalizer,
                                OneHotEncoder, SQLTransformer, StopWordsRemover, StringIndexer, VectorAssembler)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talentmatch.functions import text as T


def term_stats(df: DataFrame, doc: str, tokens: str, among: DataFrame | None = None) -> DataFrame:
    """(term, cnt = corpus count, df = documents containing it); with ``among``, of its terms only.

    Counted per (doc, term) first, so both aggregates combine map-side and a
    term that appears everywhere never sits whole in one task.
    """
    per_doc = term_frequencies(df, doc, tokens, among)
    return per_doc.groupBy("term").agg(F.sum("tf").alias("cnt"), F.count(F.lit(1)).alias("df"))


@dataclass
class TfidfModel:
    """Fitted vocabulary: ``vocab`` is (index, term, idf) with at most max_features rows."""
    vocab: DataFrame
    terms: list[str]
    idf: list[float]
    n_docs: int


def tfidf_fit(df: DataFrame, doc: str, tokens: str, max_features: int = 1000) -> TfidfModel:
    """M1 fit: top terms by corpus count, smoothed idf."""
    n_docs = df.select(doc).count()
    stats = term_stats(df, doc, tokens, leading_hashes(df, tokens, max_features))
    top = (stats.orderBy(F.desc("cnt"), F.asc("term")).limit(max_features)
           .withColumn("idf", F.log((F.lit(1.0) + F.lit(n_docs)) / (F.lit(1.0) + F.col("df"))) + 1.0))
    rows = top.select("term", "idf").collect()          # bounded by max_features
    terms = [r["term"] for r in rows]
    idf = [float(r["idf"]) for r in rows]
    spark = df.sparkSession
    vocab = spark.createDataFrame(list(zip(range(len(terms)), terms, idf)),
                                  "index int, term string, idf double")
    return TfidfModel(vocab, terms, idf, n_docs)


def _occurrences(df: DataFrame, tokens: str, *keep: str) -> DataFrame:
    """(*keep, term): a row for each token.

    ``explode_outer`` + a null filter instead of ``explode``: with the inner
    form Catalyst infers ``size(tokens) > 0`` and pushes it to the scan, which
    would evaluate the whole text rule chain twice.
    """
    return df.select(*keep, F.explode_outer(tokens).alias("term")).where(F.col("term").isNotNull())


def term_frequencies(df: DataFrame, doc: str, tokens: str, among: DataFrame | None = None) -> DataFrame:
    """(doc, term, tf): raw counts per document; with ``among`` (``leading_hashes``), of terms with its hashes only."""
    each = _occurrences(df, tokens, doc)
    if among is not None:
        each = each.withColumn(_HASH, F.xxhash64("term")).join(F.broadcast(among), _HASH)
    return each.groupBy(doc, "term").agg(F.count(F.lit(1)).alias("tf"))


_HASH = "__term_hash"
#: Hashes beyond the terms that are asked for: as many terms may share a hash with others.
SPARE_HASHES = 64


def leading_hashes(df: DataFrame, tokens: str, n: int) -> DataFrame | None:
    """The hashes of all terms that can be among the ``n`` most frequent, in one action; None where more
    than ``4 * n`` are as frequent as the last (then all terms have to be looked at).

    A pass over the tokens counts 64-bit hashes: a long for each term leaves a task, no term of a
    document. A hash counts as often as its terms or more, so the ``n + SPARE_HASHES`` leading
    ones hold ``n`` terms at least, and a term left out is rarer than all of these.
    """
    counts = _occurrences(df, tokens).select(F.xxhash64("term").alias(_HASH)).groupBy(_HASH).agg(F.count(F.lit(1)).alias("cnt"))
    most = 4 * n + SPARE_HASHES
    rows = counts.orderBy(F.desc("cnt")).limit(most).collect()          # bounded by n
    if not rows:
        return None
    cut = rows[min(len(rows), n + SPARE_HASHES) - 1]["cnt"]
    if len(rows) == most and rows[-1]["cnt"] >= cut:
        return None
    return df.sparkSession.createDataFrame(pa.table({_HASH: pa.array([r[_HASH] for r in rows if r["cnt"] >= cut], pa.int64())}))


def tfidf_long(df: DataFrame, doc: str, tokens: str, max_features: int = 1000) -> DataFrame:
    """M1 fit + transform in one plan, long form: (doc, term, weight).

    Two passes over the tokens: the first finds the hashes of the terms that can be in the
    vocabulary (``leading_hashes``), the second counts these by document. The vocabulary (top
    terms of the aggregated counts, at most ``max_features`` rows, so broadcast is bounded) and
    the weights both read the second's shuffle, which Spark reuses. The document count (it
    reads the key column only) and the first pass are actions.
    """
    n_docs = df.select(doc).count()
    tf = term_frequencies(df, doc, tokens, leading_hashes(df, tokens, max_features))
    stats = tf.groupBy("term").agg(F.sum("tf").alias("cnt"), F.count(F.lit(1)).alias("df"))
    vocab = (stats.orderBy(F.desc("cnt"), F.asc("term")).limit(max_features)
             .select("term", (F.log(F.lit(1.0 + n_docs) / (F.lit(1.0) + F.col("df"))) + 1.0).alias("idf")))
    w = tf.join(F.broadcast(vocab), "term").withColumn("w", F.col("tf") * F.col("idf"))
    # the L2 norm over a document's (at most max_features) weights: one window,
    # one shuffle of the weights by document, no second pass over the terms
    per_doc = Window.partitionBy(doc)
    return w.select(doc, "term", (F.col("w") / F.sqrt(F.sum(F.col("w") * F.col("w")).over(per_doc)))
                    .alias("weight"))


def tabular_stages(train: DataFrame, doc: str, tokens: str, cats: list[str], max_features: int = 1000,
                   out: str = "features") -> list:
    """M5: stages fitted on ``train`` alone: TF-IDF of ``tokens`` (M1), the train's modes for null
    categories (M3), one-hot (M4; unseen levels are all zeros) and one vector of all (M7).

    All are ml stages, so a pipeline of them can be stored whole (S8)."""
    tfidf = tfidf_fit(train, doc, tokens, max_features)
    modes = {r["column"]: r["mode"] for r in mode_per_column(train, cats).collect()}
    filled = []
    for c in cats:
        mode = "NULL" if modes.get(c) is None else "'" + modes[c].replace("\\", "\\\\").replace("'", "\\'") + "'"
        filled.append(f"coalesce(`{c}`, {mode}) AS `{c}_filled`")
    stages = [SQLTransformer(statement=f"SELECT *, {', '.join(filled)} FROM __THIS__"),
              CountVectorizerModel.from_vocabulary(tfidf.terms, inputCol=tokens, outputCol="tfidf_tf"),
              ElementwiseProduct(scalingVec=Vectors.dense(tfidf.idf), inputCol="tfidf_tf", outputCol="tfidf_w"),
              Normalizer(p=2.0, inputCol="tfidf_w", outputCol="tfidf")]
    names = [f"{c}_filled" for c in cats]
    return stages + one_hot_stages(names) + [VectorAssembler(inputCols=["tfidf"] + [f"oh_{c}" for c in names], outputCol=out)]


def preprocess_tokens(c, stop=True) -> "F.Column":
    """T1 without stemming as one column expression: clean -> split -> drop stop words."""
    toks = T.split_ws(T.clean_text(c))
    return T.drop_stop_words(toks) if stop else toks


def preprocess_frame(df: DataFrame, text: str, out: str, stop: bool = True,
                     words=None) -> DataFrame:
    """T1 without stemming over a frame: the stop-word step runs in the JVM
    ``StopWordsRemover`` (hash-set lookups, order and repeats kept)."""
    toks = df.withColumn(f"__{out}", T.split_ws(T.clean_text(text)))
    if not stop:
        return toks.withColumnRenamed(f"__{out}", out)
    rm = StopWordsRemover(inputCol=f"__{out}", outputCol=out, caseSensitive=True,
                          stopWords=list(words if words is not None else T.stop_words()))
    return rm.transform(toks).drop(f"__{out}")


# ---------------------------------------------------------------------------
# Categorical features
# ---------------------------------------------------------------------------

def mode_per_column(df: DataFrame, cols: list[str]) -> DataFrame:
    """A5: most frequent non-null value per column; ties -> smallest.

    One row (column, mode). Each mode is a count per (column, value) -- a
    partial aggregate -- then a max_by over a bounded per-column table.
    """
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"),
                                                  F.col(c).cast("string").alias("value"))
                                         for c in cols])).alias("kv")).select("kv.*")
    counts = long.where(F.col("value").isNotNull()).groupBy("column", "value").count()
    # highest count, then smallest value: max over (count, -rank of value) via struct ordering
    return (counts.groupBy("column")
            .agg(F.min_by("value", F.struct(-F.col("count"), F.col("value"))).alias("mode")))


def impute_mode(train: DataFrame, apply_to: DataFrame, cols: list[str]) -> DataFrame:
    """M3: fill nulls with the train-set mode of each column."""
    modes = {r["column"]: r["mode"] for r in mode_per_column(train, cols).collect()}
    return apply_to.na.fill({c: modes[c] for c in cols if modes.get(c) is not None})


def with_null_policy(train: DataFrame, apply_to: DataFrame, cols: list[str], policy: str) -> DataFrame:
    """What becomes of rows with null categories: ``drop`` leaves them out, ``impute`` fills the train-set
    mode (M3), ``keep`` leaves them as they are (all zeros after one-hot)."""
    if policy == "drop":
        return apply_to.na.drop(subset=cols)
    if policy == "impute":
        return impute_mode(train, apply_to, cols)
    if policy == "keep":
        return apply_to
    raise ValueError(f"null policy must be drop, impute or keep, got {policy!r}")


def category_levels(df: DataFrame, cols: list[str]) -> DataFrame:
    """The distinct (column, level) pairs, nulls left out."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"),
                                                  F.col(c).cast("string").alias("level"))
                                         for c in cols])).alias("kv")).select("kv.*")
    return long.where(F.col("level").isNotNull()).distinct()


def one_hot_stages(cols: list[str], prefix: str = "oh_") -> list:
    """M4: sorted categories, unseen or null -> all zeros.

    StringIndexer(alphabetAsc, keep) puts the unknown slot last; dropLast
    removes it, so every real level keeps its own slot.
    """
    idx = StringIndexer(inputCols=cols, outputCols=[f"{prefix}idx_{c}" for c in cols],
                        stringOrderType="alphabetAsc", handleInvalid="keep")
    enc = OneHotEncoder(inputCols=[f"{prefix}idx_{c}" for c in cols],
                        outputCols=[f"{prefix}{c}" for c in cols], dropLast=True)
    return [idx, enc]


def one_hot(train: DataFrame, apply_to: DataFrame, cols: list[str]) -> DataFrame:
    """M4 fit on ``train`` and apply: adds ``oh_<col>`` vectors."""
    stages = one_hot_stages(cols)
    # nulls are 'invalid' for the indexer: keep them as unknown (all zeros)
    model = Pipeline(stages=stages).fit(train)
    return model.transform(apply_to)


def assemble_features(df: DataFrame, vector_cols: list[str], array_cols: list[str] = (),
                      out: str = "features") -> DataFrame:
    """M7: concatenate dense array blocks and ml vector blocks into one vector."""
    tmp = []
    for c in array_cols:
        df = df.withColumn(f"__v_{c}", array_to_vector(F.col(c).cast("array<double>")))
        tmp.append(f"__v_{c}")
    asm = VectorAssembler(inputCols=tmp + list(vector_cols), outputCol=out)
    return asm.transform(df).drop(*tmp)


def vector_as_array(c: str):
    return vector_to_array(F.col(c))
