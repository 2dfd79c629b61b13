"""TF-IDF in two passes: candidates by hash, then counts by document."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from talentmatch.functions import text as T
from talentmatch.operators import features as FE
from talentmatch.plans import q_models

DOCS = [(1, ["a", "a", "b", "c"]), (2, ["a", "b", "d"]), (2, ["a", "e"]), (None, ["b", "f"]), (None, ["g"]), (3, []), (4, None), (5, ["a", "h"])]


def _expected(n):
    tf = Counter((d, t) for d, ts in DOCS for t in ts or [])
    cnt, df = Counter(), Counter()
    for (_, t), c in tf.items():
        cnt[t] += c
        df[t] += 1
    vocab = sorted(cnt, key=lambda t: (-cnt[t], t))[:n]
    w = {k: c * (math.log((1 + len(DOCS)) / (1 + df[k[1]])) + 1) for k, c in tf.items() if k[1] in vocab}
    norm = Counter()
    for (d, _), x in w.items():
        norm[d] += x * x
    return {k: x / math.sqrt(norm[k[0]]) for k, x in w.items()}


@pytest.mark.parametrize("n, spare", [(1, 0), (2, 0), (2, 64), (3, 0), (100, 64)])
def test_weights_are_those_of_all_terms(spark, monkeypatch, n, spare):
    monkeypatch.setattr(FE, "SPARE_HASHES", spare)
    got = FE.tfidf_long(spark.createDataFrame(DOCS, "doc long, t array<string>"), "doc", "t", n).collect()
    want = _expected(n)
    assert len(got) == len(want) and all(abs(r.weight - want[r.doc, r.term]) < 1e-9 for r in got)


def test_only_leading_terms_are_counted_by_document(spark, monkeypatch):
    monkeypatch.setattr(FE, "SPARE_HASHES", 0)
    df = spark.createDataFrame(DOCS, "doc long, t array<string>")
    assert {r.term for r in FE.term_frequencies(df, "doc", "t", FE.leading_hashes(df, "t", 2)).collect()} == {"a", "b"}
    assert FE.leading_hashes(df, "t", 1).count() == 1
    # six terms stand once: more than fit beside the two that are asked for
    assert FE.leading_hashes(df.select("doc", F.array_except("t", F.array(F.lit("a"), F.lit("b"))).alias("t")), "t", 1) is None
    assert FE.leading_hashes(df.where("false"), "t", 2) is None


def test_ngrams_evaluate_their_tokens_once(spark):
    plan = spark.range(1).select(T.ngrams_1_2(T.bow_tokens(F.col("id").cast("string"))).alias("g"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("regexp_extract_all") == 1


def test_only_labelled_texts_are_cleaned(spark, monkeypatch, tmp_path):
    spark.createDataFrame([(1, "a text", "en", "s", 6)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 0)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    seen = []

    def stop(df, *_):
        seen.append(df.columns)
        raise RuntimeError

    monkeypatch.setattr(q_models.FE, "preprocess_frame", stop)
    with pytest.raises(RuntimeError):
        q_models.tfidf_train(spark, str(tmp_path))
    assert "label" in seen[0]
