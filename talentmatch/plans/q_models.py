"""Embedding, file round trips, training and scoring queries."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from talentmatch.functions import text as T
from talentmatch.operators import analyze as A
from talentmatch.operators import curate as C
from talentmatch.operators import evaluate as E
from talentmatch.operators import features as FE
from talentmatch.operators import models as M
from talentmatch.operators import recommend as R
from talentmatch.operators import sampling as S
from talentmatch.operators.embed import embed_hash, embed_with
from talentmatch.plans import fixtures as fx
from talentmatch.plans.q_analyze import ANALYZE_SQL
from talentmatch.plans.q_curate import candidate_forms
from talentmatch.plans.q_eval import _rn_sql
from talentmatch.plans.registry import query
from talentmatch.session import scratch_path
from talentmatch.sources import files as IO

DIM = 64
CATS = ["lang", "source"]
# the scripts' model sizes
SPEC = M.ModelSpec()


def _sql_embed(table, key, text):
    return f"""
t AS (SELECT {key}, unnest(regexp_extract_all(lower({text}), '{T.BOW_TOKEN}')) AS tok FROM {table}),
h AS (SELECT {key}, md5(tok) AS h FROM t),
s AS (SELECT {key}, CAST(('0x' || substr(h, 1, 8))::BIGINT % {DIM} AS INTEGER) AS slot,
             CASE WHEN ('0x' || substr(h, 9, 1))::INTEGER < 8 THEN 1.0 ELSE -1.0 END AS s FROM h),
c AS (SELECT {key}, slot, sum(s) AS v FROM s GROUP BY ALL),
n AS (SELECT {key}, sqrt(sum(v * v)) AS n FROM c GROUP BY {key}),
e AS (SELECT {key}, slot, v / CASE WHEN n > 0 THEN n ELSE 1 END AS value FROM c JOIN n USING ({key}))"""


def _long(df, key, vec="embedding"):
    return (df.select(key, F.posexplode(vec).alias("slot", "value"))
            .where(F.col("value") != 0)
            .select(key, F.col("slot").cast("int"), F.round("value", 6).alias("value")))


@query("embed_hash", sql=f"""
WITH {_sql_embed('benchmark', 'item_id', 'text')}
SELECT item_id, slot, round(value, 6) AS value FROM e WHERE value <> 0""")
def embed_hash_q(spark, sf):
    """Built-in hashed bag-of-words encoder (unit vectors), non-zero entries."""
    b = fx.table(spark, sf, "benchmark")
    return _long(embed_hash(b, "item_id", "text", DIM), "item_id")


@query("embed_plugin", sql="""
SELECT doc_id, CAST(slot AS INTEGER) AS slot, CAST(v[slot + 1] AS DOUBLE) AS value
FROM (SELECT doc_id, [length(text), length(text) - length(replace(text, ' ', '')), length(text) - length(replace(text, 'e', ''))] AS v FROM documents),
     (SELECT unnest(range(0, 3)) AS slot)""")
def embed_plugin(spark, sf):
    """A plugged-in encoder (here one that counts characters), loaded once per worker; a
    repeated text is encoded once."""
    def make():
        import numpy as np
        return lambda texts: np.array([[len(t), t.count(" "), t.count("e")] for t in texts], dtype=np.float32)

    found = embed_with(fx.table(spark, sf, "documents"), "doc_id", "text", make, 3)
    return found.select("doc_id", F.posexplode("embedding").alias("slot", "value")).select("doc_id", "slot", F.col("value").cast("double").alias("value"))


_JOB_TEXT = "(coalesce(p_name, '') || ' ' || coalesce(p_type, '') || ' ' || coalesce(p_brand, ''))"


@query("job_embeddings", sql=f"""
WITH jt AS (SELECT p_partkey AS codigo_vaga, {_JOB_TEXT} AS texto_vaga FROM part),
{_sql_embed('jt', 'codigo_vaga', 'texto_vaga')}
SELECT codigo_vaga, slot, round(value, 6) AS value FROM e WHERE value <> 0""")
def job_embeddings(spark, sf):
    """R2 + S7: job texts embedded once, stored keyed by job, read back."""
    part = fx.table(spark, sf, "part").select(
        F.col("p_partkey").alias("codigo_vaga"), F.col("p_name").alias("titulo_vaga"),
        F.col("p_type").alias("principais_atividades"), F.col("p_brand").alias("competencias"))
    cat = R.job_catalog(part, fill_all=True)
    path = IO.write_vectors(embed_hash(cat, "codigo_vaga", "texto_vaga", DIM), "codigo_vaga", "embedding",
                            scratch_path(spark, "job-vectors"))
    return _long(IO.read_vectors(spark, path), "codigo_vaga")


@query("embedding_roundtrip", sql="""
WITH x AS (SELECT vec_id, embedding AS e, unnest(range(len(embedding))) AS i FROM embeddings)
SELECT vec_id, CAST(i AS INTEGER) AS slot, round(CAST(e[i + 1] AS DOUBLE), 6) AS value,
       round(sqrt(list_sum(list_transform(e, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))), 6) AS norm
FROM x""")
def embedding_roundtrip(spark, sf):
    """The vector table written keyed by id (with norms) and read back."""
    e = fx.table(spark, sf, "embeddings").select("vec_id", "embedding")
    path = IO.write_vectors(e, "vec_id", "embedding", scratch_path(spark, "vectors"))
    back = IO.read_vectors(spark, path)
    return back.select("vec_id", F.posexplode("embedding").alias("slot", "value"), "norm").select(
        "vec_id", F.col("slot").cast("int"), F.round(F.col("value").cast("double"), 6).alias("value"),
        F.round("norm", 6).alias("norm"))


@query("csv_roundtrip", sql="SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_roundtrip(spark, sf):
    """S5 + S2: documents (multi-line, quoted text) written as CSV and read back."""
    d = fx.table(spark, sf, "documents")
    path = IO.write_csv(d, scratch_path(spark, "documents-csv"))
    return IO.read_csv(spark, path, d.schema)


@query("parquet_roundtrip", sql=f"WITH {fx.CURATED_SQL} SELECT * FROM curated")
def parquet_roundtrip(spark, sf):
    """The curated base written as Parquet and read back."""
    path = IO.write_parquet(C.curate(fx.unified(spark, sf)), scratch_path(spark, "base-parquet"))
    return IO.read_parquet(spark, path)


@query("unified_export", sql=f"""
WITH {fx.UNIFIED_SQL}
SELECT * REPLACE (regexp_replace(cv_pt || chr(7), '[\\x01-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F-\\x{{9F}}]', '', 'g') AS cv_pt)
FROM unified""")
def unified_export(spark, sf):
    """S6 re-aimed: sanitised unified table (P17) written as Parquet and read back."""
    u = fx.unified(spark, sf).withColumn("cv_pt", F.concat("cv_pt", F.lit("\x07")))
    path = IO.export_unified(u, scratch_path(spark, "unified-export"))
    return IO.read_parquet(spark, path)


# ---------------------------------------------------------------------------
# Features and models: documents joined to labels, toxic plays "hired"
# ---------------------------------------------------------------------------

def labelled(spark, sf):
    d = fx.documents_with_gaps(spark, sf).select("doc_id", "text", *CATS)
    lab = fx.table(spark, sf, "labels").select("doc_id", F.col("toxic").alias("label"))
    return M.feature_frame(d.join(lab, "doc_id"), "doc_id", "text", CATS, DIM)


def split(spark, sf):
    """Train / test by the exact stratified split. The feature frame is
    checkpointed (shared checkpoint folder): every model fit, fold and count
    below reads it instead of re-running text embedding and the split."""
    df = S.stratified_split(labelled(spark, sf), "label", "doc_id").checkpoint(eager=True)
    return df.where(~F.col("is_test")).drop("is_test"), df.where(F.col("is_test")).drop("is_test")


@query("assemble_features", sql=f"""
WITH g AS (SELECT doc_id, text, nullif(lang, 'de') AS lang FROM documents),
{_sql_embed('g', 'doc_id', 'text')},
lv AS (SELECT list_sort(list(DISTINCT lang)) AS levels FROM g WHERE lang IS NOT NULL),
oh AS (SELECT doc_id, {DIM} + list_position(levels, lang) - 1 AS idx FROM g CROSS JOIN lv WHERE lang IS NOT NULL)
SELECT doc_id, CAST(slot AS INTEGER) AS idx, round(value, 6) AS value FROM e WHERE value <> 0
UNION ALL SELECT doc_id, CAST(idx AS INTEGER), 1.0 FROM oh""")
def assemble_features(spark, sf):
    """M7: embedding block + one-hot block in one vector (non-zero entries)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler

    from talentmatch.operators.features import one_hot_stages
    g = fx.documents_with_gaps(spark, sf).select("doc_id", "text", "lang")
    emb = embed_hash(g, "doc_id", "text", DIM, out="emb")
    df = M.with_emb_vector(g.join(emb, "doc_id"))
    stages = one_hot_stages(["lang"]) + [VectorAssembler(inputCols=["emb_vec", "oh_lang"],
                                                         outputCol="features")]
    out = Pipeline(stages=stages).fit(df).transform(df)
    return (out.select("doc_id", F.posexplode(vector_to_array("features")).alias("idx", "value"))
            .where(F.col("value") != 0)
            .select("doc_id", F.col("idx").cast("int"), F.round("value", 6).alias("value")))


# the exact stratified split of labelled documents, and the levels of the training rows
_SPLIT_SQL = f"""
lab AS (SELECT l.doc_id, l.toxic AS label, nullif(d.lang, 'de') AS lang,
               CASE WHEN d.source = 'src0' THEN 'N/A' ELSE d.source END AS source FROM labels l JOIN documents d USING (doc_id)),
sp AS (SELECT *, {_rn_sql('label')} <= round(0.2 * count(*) OVER (PARTITION BY label)) AS is_test FROM lab),
lv AS (SELECT list_sort(list(DISTINCT lang) FILTER (lang IS NOT NULL)) AS langs,
              list_sort(list(DISTINCT source) FILTER (source IS NOT NULL)) AS sources FROM sp WHERE NOT is_test)"""


@query("feature_pipeline", sql=f"""
WITH g AS (SELECT doc_id, text FROM documents), {_sql_embed('g', 'doc_id', 'text')}, {_SPLIT_SQL}
SELECT doc_id, label, CAST(slot AS INTEGER) AS idx, round(value, 6) AS value FROM e JOIN sp USING (doc_id) WHERE is_test AND value <> 0
UNION ALL SELECT doc_id, label, CAST({DIM} + list_position(langs, lang) - 1 AS INTEGER), 1.0 FROM sp, lv
          WHERE is_test AND list_position(langs, lang) > 0
UNION ALL SELECT doc_id, label, CAST({DIM} + len(langs) + list_position(sources, source) - 1 AS INTEGER), 1.0 FROM sp, lv
          WHERE is_test AND list_position(sources, source) > 0""")
def feature_pipeline(spark, sf):
    """M5/M6: feature stages fitted on the training split, applied to the test split: the non-zero features."""
    from pyspark.ml import Pipeline
    train, test = split(spark, sf)
    model = Pipeline(stages=M.feature_stages(CATS)).fit(M.with_emb_vector(train))
    out = model.transform(M.with_emb_vector(test)).select("doc_id", "label", F.posexplode(vector_to_array("features")).alias("idx", "value"))
    return out.where(F.col("value") != 0).select("doc_id", "label", F.col("idx").cast("int").alias("idx"), F.round("value", 6).alias("value"))


_TRAIN = "NOT (('0x' || substr(md5('42-' || CAST(doc_id AS VARCHAR)), 1, 15))::BIGINT % 10000 < 2000)"


@query("tfidf_features", sql=f"""
WITH g AS (SELECT doc_id, text, nullif(lang, 'de') AS lang, {_TRAIN} AS is_train FROM documents),
tok AS (SELECT doc_id, is_train, unnest(regexp_extract_all(lower(text), '{T.BOW_TOKEN}')) AS term FROM g),
tf AS (SELECT doc_id, is_train, term, count(*) AS tf FROM tok GROUP BY ALL),
n AS (SELECT count(*) AS n FROM g WHERE is_train),
vocab AS (SELECT term, count(*) AS df FROM tf WHERE is_train GROUP BY term ORDER BY sum(tf) DESC, term LIMIT 1000),
w AS (SELECT doc_id, term, tf * (ln((1 + n.n) / (1 + v.df)) + 1) AS w FROM tf JOIN vocab v USING (term), n WHERE NOT is_train),
nn AS (SELECT doc_id, sqrt(sum(w * w)) AS nrm FROM w GROUP BY doc_id),
m AS (SELECT arg_min(lang, (-c, lang)) AS mode FROM (SELECT lang, count(*) AS c FROM g WHERE is_train AND lang IS NOT NULL GROUP BY lang))
SELECT doc_id, term AS feature, round(w / nrm, 6) AS value FROM w JOIN nn USING (doc_id)
UNION ALL SELECT doc_id, 'lang=' || coalesce(lang, (SELECT mode FROM m)), 1.0 FROM g WHERE NOT is_train""")
def tfidf_features(spark, sf):
    """M5: TF-IDF(1000) + most frequent value + one-hot, fitted on the training rows, applied to the
    others: the non-zero features by name."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StringIndexerModel
    d = S.hash_split(fx.documents_with_gaps(spark, sf).select("doc_id", "text", "lang"), "doc_id")
    d = d.withColumn("toks", T.bow_tokens("text"))
    train = d.where(~F.col("is_test"))
    model = Pipeline(stages=FE.tabular_stages(train, "doc_id", "toks", ["lang"], 1000)).fit(train)
    terms = model.stages[1].vocabulary
    levels = next(s for s in model.stages if isinstance(s, StringIndexerModel)).labelsArray[0]
    names = F.array(*[F.lit(x) for x in [*terms, *[f"lang={x}" for x in levels]]])
    out = model.transform(d.where("is_test")).select("doc_id", F.posexplode(vector_to_array("features")).alias("idx", "value"))
    return out.where(F.col("value") != 0).select("doc_id", F.get(names, F.col("idx")).alias("feature"), F.round("value", 6).alias("value"))


# What SQL can say of a fitted model: which rows it scores, that its scores are probabilities and its
# classes follow from them; and of a logistic regression that it is the optimum.

def _test_sql(*flags):
    return f"WITH {_SPLIT_SQL} SELECT doc_id, label, {', '.join(f'true AS {f}' for f in flags)} FROM sp WHERE is_test"


def _checked(pred, keep=("doc_id", "label")):
    return pred.select(*keep, F.col("prob").between(0, 1).alias("prob_ok"), (F.col("prediction") == (F.col("prob") > 0.5).cast("int")).alias("class_ok"))


@query("tfidf_train", sql=_test_sql("prob_ok", "class_ok"))
def tfidf_train(spark, sf):
    """M2 + L1 on the cleaned text (T1): balanced logistic regression on 3000 TF-IDF terms of one and two
    words and imputed categories; the hold-out's predictions, from the pipeline stored and loaded again."""
    lab = fx.table(spark, sf, "labels").select("doc_id", F.col("toxic").alias("label"))
    # only labelled texts are cleaned
    d = FE.preprocess_frame(fx.documents_with_gaps(spark, sf).select("doc_id", "text", *CATS).join(lab, "doc_id"), "text", "words")
    d = d.select("doc_id", T.ngrams_1_2(F.col("words")).alias("toks"), *CATS, "label")
    df = S.stratified_split(d, "label", "doc_id").checkpoint(eager=True)
    train, test = (df.where(F.col("is_test") == t).drop("is_test") for t in (False, True))
    bal = S.upsample_minority(train, "label", "doc_id").drop("slot")
    model = M.fit_tfidf(bal, "LogisticRegression", "doc_id", "label", "toks", CATS, SPEC)
    loaded = M.load_model(M.save_model(model, scratch_path(spark, "tfidf-model")))
    return _checked(M.predict(loaded, test, "doc_id", ["label"]))


@query("embedding_train", sql=f"""
WITH lab AS (SELECT l.doc_id, l.toxic AS label FROM labels l JOIN documents d USING (doc_id)),
sp AS (SELECT *, {_rn_sql('label')} <= round(0.2 * count(*) OVER (PARTITION BY label)) AS is_test FROM lab)
SELECT doc_id, label, true AS prob_ok, true AS class_ok, true AS optimal FROM sp WHERE is_test""")
def embedding_train(spark, sf):
    """L1 on embeddings alone: the cleaned text's vector, no categories; the hold-out's predictions."""
    lab = fx.table(spark, sf, "labels").select("doc_id", F.col("toxic").alias("label"))
    docs = fx.table(spark, sf, "documents").select("doc_id", "text").join(lab, "doc_id")
    rows = M.feature_frame(docs, "doc_id", "text", [], DIM, text_mode="clean")
    df = S.stratified_split(rows, "label", "doc_id").checkpoint(eager=True)
    train, test = (df.where(F.col("is_test") == t).drop("is_test") for t in (False, True))
    bal = _balanced(train)
    model = M.fit_model(bal, "LogisticRegression", "label", [], SPEC)
    return _checked(M.predict(model, test, "doc_id", ["label"])).withColumn("optimal", F.lit(M.gradient_norm(model, bal, "label") < 0.01))


def _balanced(train):
    return S.upsample_minority(train, "label", "doc_id").drop("slot")


def _train_predict(spark, sf, name):
    train, test = split(spark, sf)
    model = M.fit_any(_balanced(train), name, "label", CATS, SPEC)
    return _checked(M.predict_any(model, test, "doc_id", ["label"]))


@query("lr_train", sql=_test_sql("prob_ok", "class_ok", "optimal"))
def lr_train(spark, sf):
    """Balanced logistic regression on the hold-out split; ``optimal``: its penalised loss has
    (almost) no gradient on the training rows."""
    train, test = split(spark, sf)
    bal = _balanced(train)
    model = M.fit_model(bal, "LogisticRegression", "label", CATS, SPEC)
    return _checked(M.predict(model, test, "doc_id", ["label"])).withColumn("optimal", F.lit(M.gradient_norm(model, bal, "label") < 0.01))


@query("train_predict", sql="SELECT doc_id, true AS prob_ok, true AS class_ok FROM documents")
def train_predict(spark, sf):
    """Fit the pipeline once, then predict the class of every document
    (labelled or not) in one batch transform."""
    train, _ = split(spark, sf)
    model = M.fit_model(_balanced(train), "LogisticRegression", "label", CATS, SPEC)
    docs = M.feature_frame(fx.documents_with_gaps(spark, sf).select("doc_id", "text", *CATS),
                           "doc_id", "text", CATS, DIM)
    return _checked(M.predict(model, docs, "doc_id"), ["doc_id"])


@query("rf_train", sql=_test_sql("prob_ok", "class_ok"))
def rf_train(spark, sf):
    """L2: random forest (sqrt feature subsets)."""
    return _train_predict(spark, sf, "RandomForest")


@query("gbt_train", sql=_test_sql("prob_ok", "class_ok"))
def gbt_train(spark, sf):
    """L3: gradient-boosted trees, log loss."""
    return _train_predict(spark, sf, "GradientBoostedTrees")


@query("vote_train", sql=_test_sql("prob_ok", "class_ok"))
def vote_train(spark, sf):
    """L4: soft vote of the three members."""
    return _train_predict(spark, sf, "VotingClassifier")


@query("fold_weights", sql=f"""
WITH {_SPLIT_SQL},
r AS (SELECT doc_id, label, {_rn_sql('label')} - 1 AS r, count(*) OVER (PARTITION BY label) AS n FROM sp WHERE NOT is_test),
parts AS (SELECT unnest(range(0, 6)) AS f),
t AS (SELECT doc_id, label, f, {_rn_sql('f, label')} - 1 AS row, count(*) OVER (PARTITION BY f, label) AS m
      FROM r, parts WHERE f = 5 OR r % 5 <> f),
n0 AS (SELECT f, any_value(m) AS n0 FROM t WHERE label = 0 GROUP BY f),
m1 AS (SELECT f, any_value(m) AS m FROM t WHERE label = 1 GROUP BY f),
drawn AS (SELECT f, ('0x' || substr(md5('42-' || CAST(s.slot AS VARCHAR)), 1, 15))::BIGINT % m AS row, count(*) AS n
          FROM n0 JOIN m1 USING (f), LATERAL (SELECT unnest(range(0, n0.n0)) AS slot) s GROUP BY ALL)
SELECT r.doc_id, r.label, CAST(r.r % 5 AS INTEGER) AS fold, p.f AS part,
       CAST(CASE WHEN t.doc_id IS NULL THEN 0 WHEN r.label = 0 THEN 1 ELSE coalesce(drawn.n, 0) END AS INTEGER) AS weight
FROM r CROSS JOIN parts p LEFT JOIN t ON t.doc_id = r.doc_id AND t.f = p.f LEFT JOIN drawn ON drawn.f = t.f AND drawn.row = t.row AND r.label = 1""")
def fold_weights(spark, sf):
    """M9 inside M11 as weights: how often each training row stands in each training part (part 5: all rows)."""
    train, _ = split(spark, sf)
    w = S.fold_weights(train.select("doc_id", "label"), "label", "doc_id")
    return w.select("doc_id", "label", "fold", F.posexplode("weights").alias("part", "weight")).withColumn("part", F.col("part").cast("long"))


@query("cv_f1", sql=f"""
WITH {_SPLIT_SQL}, r AS (SELECT ({_rn_sql('label')} - 1) % 5 AS fold FROM sp WHERE NOT is_test)
SELECT 'LogisticRegression' AS model, CAST(fold AS INTEGER) AS fold, count(*) AS rows, true AS f1_ok FROM r GROUP BY ALL""")
def cv_f1(spark, sf):
    """5-fold stratified F1 of the logistic regression (upsampled inside folds); the folds' rows."""
    train, _ = split(spark, sf)
    rows = S.stratified_folds(train.select("doc_id", "label"), "label", "doc_id").groupBy("fold").agg(F.count("*").alias("rows"))
    found = M.cross_val_f1(train, "LogisticRegression", "doc_id", "label", CATS, SPEC)
    return found.join(rows, "fold").select("model", "fold", "rows", F.col("f1").between(0, 1).alias("f1_ok"))


@query("model_leaderboard", sql="""
SELECT model, CAST(i AS INTEGER) AS model_order, true AS cv_f1_ok, true AS f1_ok, true AS winner_ok, true AS report_ok
FROM (VALUES ('LogisticRegression', 0), ('RandomForest', 1), ('GradientBoostedTrees', 2), ('VotingClassifier', 3)) v(model, i)""")
def model_leaderboard(spark, sf):
    """L8 + A9: four models compared by CV and hold-out F1. ``winner_ok``: the stored model is the first
    of the highest F1 above 0 (none, if there is no such); ``report_ok``: so says its report."""
    train, test = split(spark, sf)
    store = scratch_path(spark, "winner")
    board = M.leaderboard(train, test, "doc_id", "label", CATS, SPEC, store=store)
    best = E.best_model(board).select(F.col("model").alias("best"), F.col("f1").alias("best_f1")).first()
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(store)
    stored = there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(there)
    right = (best is None) == (not stored)
    report = right
    if best is not None and stored:
        if best["best"] != "VotingClassifier":
            # trees grown in tasks, or by Spark beyond what a task may hold
            kinds = {"LogisticRegression": ("LogisticRegressionModel",), "RandomForest": ("RandomForestClassificationTrees", "RandomForestClassificationModel"),
                     "GradientBoostedTrees": ("GBTClassificationTrees", "GBTClassificationModel")}[best["best"]]
            right = type(M.load_model(f"{store}/model").stages[-1]).__name__ in kinds
        f1 = spark.read.parquet(f"{store}/report").where("row = '1'").first()["f1"]
        report = abs(f1 - best["best_f1"]) < 1e-9
    return board.select("model", "model_order", F.col("cv_f1").between(0, 1).alias("cv_f1_ok"), F.col("f1").between(0, 1).alias("f1_ok"),
                        F.lit(right).alias("winner_ok"), F.lit(report).alias("report_ok"))


@query("model_roundtrip", sql=_test_sql("same"))
def model_roundtrip(spark, sf):
    """A fitted pipeline saved and loaded gives the same predictions."""
    train, test = split(spark, sf)
    model = M.fit_model(_balanced(train), "LogisticRegression", "label", CATS, SPEC)
    loaded = M.load_model(M.save_model(model, scratch_path(spark, "model")))
    a = M.predict(model, test, "doc_id", ["label"]).select("doc_id", "label", F.col("prob").alias("p_before"))
    b = M.predict(loaded, test, "doc_id").select("doc_id", F.col("prob").alias("p_after"))
    return a.join(b, "doc_id").select("doc_id", "label", (F.abs(F.col("p_before") - F.col("p_after")) < 1e-12).alias("same"))


@query("features_roundtrip", sql=f"""
WITH {_SPLIT_SQL}
SELECT doc_id, CASE WHEN is_test THEN 'test' ELSE 'train' END AS split, CAST({DIM} + len(langs) + len(sources) AS INTEGER) AS width, label
FROM sp, lv""")
def features_roundtrip(spark, sf):
    """(key, split, features, label) stored as one Parquet table and read back."""
    from pyspark.ml import Pipeline
    train, test = split(spark, sf)
    model = Pipeline(stages=M.feature_stages(CATS)).fit(M.with_emb_vector(train))
    both = (model.transform(M.with_emb_vector(train)).withColumn("split", F.lit("train"))
            .unionByName(model.transform(M.with_emb_vector(test)).withColumn("split", F.lit("test"))))
    path = IO.write_parquet(both.select("doc_id", "split", "features", "label"),
                            scratch_path(spark, "features"), partition_by=["split"])
    back = IO.read_parquet(spark, path)
    return back.select("doc_id", "split", F.size(vector_to_array("features")).alias("width"), "label")


@query("analyze_candidates", sql=f"""
SELECT candidate_id, valid, violations, CASE WHEN valid THEN true END AS prob_ok, vagas_recomendadas FROM ({ANALYZE_SQL}) a""")
def analyze_candidates(spark, sf):
    """R5 with a trained model: forms validated, P(hire) of the logistic regression on their text, and the
    top-3 jobs; rejected forms are listed, not scored."""
    train, _ = split(spark, sf)
    model = M.fit_model(_balanced(train), "LogisticRegression", "label", CATS, SPEC)
    docs = fx.documents_with_gaps(spark, sf).select(F.col("doc_id").alias("candidate_id"), "text", *CATS)

    def probability(valid):
        rows = M.feature_frame(docs.join(valid.select("candidate_id"), "candidate_id"), "candidate_id", "text", CATS, DIM)
        return M.predict(model, rows, "candidate_id").select("candidate_id", F.round("prob", 4).alias("probabilidade_contratacao"))

    vectors = fx.table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    forms = candidate_forms(fx.table(spark, sf, "documents")).join(vectors, "doc_id", "left").withColumnRenamed("doc_id", "candidate_id")
    out = A.analyze_candidates(forms, probability, fx.job_vectors(spark, sf), fx.job_details(spark, sf))
    return out.select("candidate_id", "valid", F.array_join("violations", ",").alias("violations"),
                      F.col("probabilidade_contratacao").between(0, 1).alias("prob_ok"),
                      F.to_json("vagas_recomendadas", {"ignoreNullFields": "false"}).alias("vagas_recomendadas"))
