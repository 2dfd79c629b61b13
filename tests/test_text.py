from pyspark.sql import functions as F

from talentmatch.functions import text as T


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "s string").select(expr(F.col("s")).alias("r")).first()["r"]


def test_strip_unicode_whitespace(spark):
    assert one(spark, T.strip_ws, " \t  Contratado pela Decision  \n") == "Contratado pela Decision"
    assert one(spark, T.strip_ws, "   ") == ""


def test_clean_keeps_accents_and_underscore(spark):
    # digits go, punctuation goes (joining São-Paulo), accents, '_' and '½' stay
    assert one(spark, T.clean_text, "Éléphant_2024, São-Paulo! 42 ½") == "éléphant_ sãopaulo  ½"


def test_split_and_stop_words(spark):
    toks = one(spark, lambda c: T.drop_stop_words(T.split_ws(T.clean_text(c))), "O gato e o cão de Maria correm")
    assert toks == ["gato", "cão", "maria", "correm"]


def test_stop_words_list():
    words = T.stop_words()
    assert len(words) == 203 and "de" in words and "não" in words


def test_na_tokens_and_control(spark):
    assert one(spark, T.na_to_null, "N/A") is None
    assert one(spark, T.na_to_null, "") is None
    assert one(spark, T.na_to_null, "ok") == "ok"
    assert one(spark, T.remove_control, "a\x07b\tc\x85d\x1fe") == "ab\tcde"


def test_bow_and_ngrams(spark):
    assert one(spark, T.bow_tokens, "A bb, CC-dd e") == ["bb", "cc", "dd"]
    assert one(spark, lambda c: T.ngrams_1_2(T.bow_tokens(c)), "aa bb cc") == ["aa", "bb", "cc", "aa bb", "bb cc"]
    assert one(spark, lambda c: T.ngrams_1_2(T.bow_tokens(c)), "aa") == ["aa"]
    assert one(spark, lambda c: T.ngrams_1_2(T.bow_tokens(c)), "") == []
