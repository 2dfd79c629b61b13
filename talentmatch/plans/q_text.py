"""Text and feature queries."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from talentmatch.functions import text as T
from talentmatch.operators import features as FE
from talentmatch.operators import sampling as S
from talentmatch.plans import fixtures as fx
from talentmatch.plans.registry import query


def _sql_stop():
    return "[" + fx.sql_str_list(T.stop_words()) + "]"


# DuckDB spellings of the same rules (RE2 with the explicit classes).
SQL_CLEAN = (f"regexp_replace(regexp_replace(lower(text), '{T.DIGITS}', '', 'g'), "
             f"'{T.PUNCT}', '', 'g')")
SQL_SPLIT = f"list_filter(regexp_split_to_array(__X__, '{T.WS_CLASS}+'), lambda t: t <> '')"
SQL_BOW = f"regexp_extract_all(lower(__X__), '{T.BOW_TOKEN}')"


def sql_bow(x="text"):
    return SQL_BOW.replace("__X__", x)


def sql_tokens(x="text", stop=True):
    toks = SQL_SPLIT.replace("__X__", SQL_CLEAN.replace("text", x))
    if stop:
        toks = f"list_filter({toks}, lambda t: NOT list_contains({_sql_stop()}, t))"
    return toks


def sql_ngrams(toks):
    return (f"list_concat({toks}, list_transform(range(1, len({toks})), "
            f"lambda i: {toks}[i] || ' ' || {toks}[i + 1]))")


def _docs(spark, sf):
    return fx.documents(spark, sf)


@query("text_clean", sql=f"SELECT doc_id, array_to_string({sql_tokens()}, ' ') AS text_clean FROM documents")
def text_clean(spark, sf):
    """T1 without stemming: lower, digits, punctuation, split, stop words, join."""
    d = FE.preprocess_frame(_docs(spark, sf), "text", "toks")
    return d.select("doc_id", T.join_tokens("toks").alias("text_clean"))


@query("tokens", sql=f"""
SELECT doc_id, CAST(len({sql_tokens(stop=False)}) AS INTEGER) AS n_tokens,
       array_to_string({sql_tokens(stop=False)}, ' ') AS joined FROM documents""")
def tokens(spark, sf):
    """white-space tokens of the cleaned text."""
    t = FE.preprocess_tokens("text", stop=False)
    return _docs(spark, sf).select("doc_id", F.size(t).alias("n_tokens"), T.join_tokens(t).alias("joined"))


@query("tokens_no_stop", sql=f"""
SELECT doc_id, CAST(len({sql_tokens()}) AS INTEGER) AS n_tokens FROM documents""")
def tokens_no_stop(spark, sf):
    """tokens left after the stop-word filter (order and repeats kept)."""
    d = FE.preprocess_frame(_docs(spark, sf), "text", "toks")
    return d.select("doc_id", F.size("toks").alias("n_tokens"))


@query("bow_tokens", sql=f"""
SELECT doc_id, CAST(len({sql_bow()}) AS INTEGER) AS n_bow,
       array_to_string({sql_bow()}, ' ') AS bow FROM documents""")
def bow_tokens(spark, sf):
    """The TF-IDF tokenizer (runs of >= 2 word characters, lower case)."""
    b = T.bow_tokens("text")
    return _docs(spark, sf).select("doc_id", F.size(b).alias("n_bow"), F.array_join(b, " ").alias("bow"))


@query("ngrams_1_2", sql=f"""
WITH t AS (SELECT doc_id, {sql_bow()} AS b FROM documents),
g AS (SELECT doc_id, {sql_ngrams('b')} AS g FROM t)
SELECT doc_id, CAST(len(g) AS INTEGER) AS n_grams, CAST(len(list_distinct(g)) AS INTEGER) AS n_distinct,
       array_to_string(g, '|') AS grams FROM g""")
def ngrams_1_2(spark, sf):
    """T4: unigrams then bigrams."""
    g = T.ngrams_1_2(T.bow_tokens("text"))
    return _docs(spark, sf).select("doc_id", F.size(g).alias("n_grams"),
                                   F.size(F.array_distinct(g)).alias("n_distinct"),
                                   F.array_join(g, "|").alias("grams"))


_TERMS_SQL = f"""
tok AS (SELECT doc_id, unnest({sql_bow()}) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY doc_id, term),
st AS (SELECT term, sum(tf) AS cnt, count(*) AS df FROM tf GROUP BY term)"""


@query("term_stats", sql=f"WITH {_TERMS_SQL} SELECT term, CAST(cnt AS BIGINT) AS cnt, df FROM st")
def term_stats(spark, sf):
    """Corpus count and document frequency per term."""
    d = _docs(spark, sf).select("doc_id", T.bow_tokens("text").alias("t"))
    return FE.term_stats(d, "doc_id", "t")


def _tfidf_sql(tokens_sql, max_features, pre=""):
    return f"""
WITH {pre}tok AS (SELECT doc_id, unnest({tokens_sql}) AS term FROM {"g" if pre else "documents"}),
tf AS (SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY doc_id, term),
st AS (SELECT term, sum(tf) AS cnt, count(*) AS df FROM tf GROUP BY term),
n AS (SELECT count(*) AS n FROM documents),
vocab AS (SELECT term, df FROM st ORDER BY cnt DESC, term LIMIT {max_features}),
w AS (SELECT tf.doc_id, tf.term, tf.tf * (ln((1 + n.n) / (1 + v.df)) + 1) AS w
      FROM tf JOIN vocab v USING (term) CROSS JOIN n),
nn AS (SELECT doc_id, sqrt(sum(w * w)) AS nrm FROM w GROUP BY doc_id)
SELECT doc_id, term, round(w / nrm, 6) AS weight FROM w JOIN nn USING (doc_id)"""


@query("tfidf_1000", sql=_tfidf_sql(sql_bow(), 1000))
def tfidf_1000(spark, sf):
    """M1: TF-IDF over the 1000 most frequent terms, long form (doc, term, weight)."""
    d = _docs(spark, sf).select("doc_id", T.bow_tokens("text").alias("t"))
    return FE.tfidf_long(d, "doc_id", "t", 1000).select("doc_id", "term", F.round("weight", 6).alias("weight"))


@query("tfidf_bigrams", sql=_tfidf_sql("t", 3000, pre=f"""
c AS (SELECT doc_id, {sql_bow(f"array_to_string({sql_tokens()}, ' ')")} AS b FROM documents),
g AS (SELECT doc_id, {sql_ngrams('b')} AS t FROM c),
"""))
def tfidf_bigrams(spark, sf):
    """M2: TF-IDF over the 3000 most frequent 1- and 2-grams of the cleaned text."""
    d = FE.preprocess_frame(_docs(spark, sf), "text", "toks")
    d = d.select("doc_id", T.ngrams_1_2(T.bow_tokens(T.join_tokens("toks"))).alias("t"))
    return FE.tfidf_long(d, "doc_id", "t", 3000).select("doc_id", "term", F.round("weight", 6).alias("weight"))


_GAPS_SQL = """
g AS (SELECT doc_id, nullif(lang, 'de') AS lang, CASE WHEN source = 'src0' THEN 'N/A' ELSE source END AS source
      FROM documents)"""


@query("mode_per_column", sql=f"""
WITH {_GAPS_SQL},
kv AS (SELECT 'lang' AS "column", lang AS value FROM g UNION ALL SELECT 'source', source FROM g),
c AS (SELECT "column", value, count(*) AS n FROM kv WHERE value IS NOT NULL GROUP BY ALL)
SELECT "column", arg_min(value, (-n, value)) AS mode FROM c GROUP BY "column" """)
def mode_per_column(spark, sf):
    """A5: most frequent value per column, ties to the smallest."""
    return FE.mode_per_column(fx.documents_with_gaps(spark, sf), ["lang", "source"])


@query("impute_mode", sql=f"""
WITH {_GAPS_SQL},
tr AS (SELECT * FROM g WHERE NOT (('0x' || substr(md5('42-' || CAST(doc_id AS VARCHAR)), 1, 15))::BIGINT % 10000 < 2000)),
m AS (SELECT arg_min(lang, (-n, lang)) AS mode FROM (SELECT lang, count(*) AS n FROM tr WHERE lang IS NOT NULL GROUP BY lang))
SELECT doc_id, coalesce(lang, (SELECT mode FROM m)) AS lang FROM g""")
def impute_mode(spark, sf):
    """M3: nulls filled with the mode of the training rows only."""
    g = fx.documents_with_gaps(spark, sf).select("doc_id", "lang")
    train = S.hash_split(g, "doc_id").where(~F.col("is_test"))
    return FE.impute_mode(train, g, ["lang"])


@query("category_levels", sql=f"""
WITH {_GAPS_SQL}
SELECT DISTINCT 'lang' AS "column", lang AS level FROM g WHERE lang IS NOT NULL
UNION ALL SELECT DISTINCT 'source', source FROM g WHERE source IS NOT NULL""")
def category_levels(spark, sf):
    """The sorted category sets of the one-hot fit."""
    return FE.category_levels(fx.documents_with_gaps(spark, sf), ["lang", "source"])


@query("one_hot", sql=f"""
WITH {_GAPS_SQL},
lv AS (SELECT list_sort(list(DISTINCT lang)) AS levels FROM g WHERE lang IS NOT NULL AND lang <> 'es')
SELECT doc_id, CAST(coalesce(list_position(levels, lang), 0) - 1 AS INTEGER) AS lang_slot,
       CAST(len(levels) AS INTEGER) AS lang_width
FROM g CROSS JOIN lv""")
def one_hot(spark, sf):
    """M4: sorted levels, unseen ('es' is left out of the fit) and null -> all zeros.

    Reported as the hot slot (-1 for all zeros) and the vector width.
    """
    g = fx.documents_with_gaps(spark, sf).select("doc_id", "lang")
    out = FE.one_hot(g.where((F.col("lang") != "es") | F.col("lang").isNull()), g, ["lang"])
    arr = vector_to_array(F.col("oh_lang"))
    return out.select("doc_id", (F.array_position(arr, 1.0) - 1).cast("int").alias("lang_slot"),
                      F.size(arr).alias("lang_width"))
