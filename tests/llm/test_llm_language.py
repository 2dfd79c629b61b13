import math
import random
import re

import numpy as np
import pyarrow as pa

from talentmatch.llm import language as LG
from talentmatch.llm.words import chunks


def text_of(*texts):
    return [LG.read(d, o) for _, _, d, o in chunks(LG._lowered(pa.array(list(texts))))][0]


def corpus(n=300, seed=2):
    rng = random.Random(seed)
    parts = {"aa": ["ba", "lo", "mi", "ta"], "bb": ["che", "ñu", "xo", "ré"], "cc": ["ба", "ло", "ми", "жу"]}
    rows = []
    for i in range(n):
        lang = "aabbcc"[2 * (i % 3):2 * (i % 3) + 2]
        words = ["".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 4))).capitalize() for _ in range(rng.randint(3, 40))]
        rows.append((i, ", ".join(words) + ".", lang, "s", None))
    return rows


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def brute(model_docs, text):
    """Word-first back-off with plain counters; the hash of a feature is the feature."""
    letters = lambda t: re.findall(r"[^\W\d_]+", t.lower())
    langs = sorted({x for _, x in model_docs}, key=lambda x: (-sum(y == x for _, y in model_docs), x))
    counts = {(n, x): {} for n in (0, *LG.LENGTHS) for x in langs}
    for t, x in model_docs:
        for w in letters(t):
            w = f" {w} "
            counts[0, x][w] = counts[0, x].get(w, 0) + 1
            for n in LG.LENGTHS:
                for k in range(len(w) - n + 1):
                    counts[n, x][w[k:k + n]] = counts[n, x].get(w[k:k + n], 0) + 1
    total = {k: sum(v.values()) for k, v in counts.items()}
    known = {n: {f for x in langs for f in counts[n, x] if sum(counts[n, y].get(f, 0) for y in langs) >= LG.LEAST} for n in (0, *LG.LENGTHS)}

    def cost(n, f):
        return np.array([min(-math.log10(counts[n, x][f] / total[n, x]), LG.PENALTY) if f in counts[n, x] else LG.PENALTY for x in langs])

    def word(w):
        w = f" {w} "
        if w in known[0]:
            return cost(0, w)
        for n in LG.LENGTHS:
            found = [cost(n, w[k:k + n]) for k in range(len(w) - n + 1) if w[k:k + n] in known[n]]
            if found:
                return np.mean(found, axis=0)
        return np.full(len(langs), LG.PENALTY)

    found = [word(w) for w in letters(text)]
    return (langs, np.mean(found, axis=0)) if found else (langs, None)


def test_words_and_windows():
    t = text_of("Hello wörld, x", "", "123", "É la")
    assert np.diff(t.first).tolist() == [3, 0, 0, 2]
    assert text_of("la hello").words().tolist() == [t.words()[4], t.words()[0]]
    h, owner = t.windows(np.arange(5), 3)
    assert np.bincount(owner).tolist() == [5, 5, 1, 1, 2] and h[-2] == text_of("laz").windows(np.arange(1), 3)[0][0]


def test_costs_match_brute_force(spark):
    rows = corpus(60)
    model = LG.train(spark.createDataFrame(rows, DOCS))
    docs = [(r[1], r[2]) for r in rows]
    for text in ("Balo mita, chexo!", "unseen zzz ba", "бажу x", "ñuñuñuré q7q"):
        langs, want = brute(docs, text)
        assert model.languages == langs
        assert np.allclose(model.word_costs(text_of(text)).mean(axis=0), want, atol=1e-4)


def test_held_out_accuracy_and_edge_rows(spark):
    rows = corpus()
    df = spark.createDataFrame(rows + [(900, None, "aa", None, None), (901, "12 34!", "aa", None, None), (902, "ba", None, None, None),
                                       (None, "chexo ñuré", "bb", None, None), (903, "中文", "aa", None, None), (5, "ба", "cc", "s", 1)], DOCS)
    from pyspark.sql import functions as F
    for c in ("id", "level", "number", "f", "n", "score"):
        df = df.withColumn(c, F.lit("x"))
    model = LG.train(df.where("doc_id % 5 != 0"))
    got = {}
    for r in LG.identify(df, model).collect():
        got.setdefault(r["id"], set()).add((r["lang_pred"], r["score"]))
    assert all({x for x, _ in got[i]} == {lang} for i, _, lang, _, _ in rows if i % 5 == 0 and i != 5)
    assert {x for x, _ in got[5]} == {"aa" if rows[5][2] == "aa" else rows[5][2], "cc"}
    assert got[900] == got[901] == {("und", 0.0)} and next(iter(got[None]))[0] == "bb"
    assert next(iter(got[903]))[0] in ("aa", "bb", "cc")
    assert all(0 <= s <= 1 for v in got.values() for _, s in v)


def test_nothing_to_learn(spark):
    df = spark.createDataFrame([(1, "text", None, None, None)], DOCS)
    model = LG.train(df)
    assert [tuple(r) for r in LG.identify(df, model).collect()] == [(1, "und", 0.0)]
    assert LG.identify(df.where("false"), model).count() == 0


def test_sample_is_bounded(spark):
    rows = corpus(300)
    model = LG.train(spark.createDataFrame(rows, DOCS), max_docs=60, max_features=50)
    assert all(len(k) <= 50 for k in model.known) and len(model.languages) == 3


def test_small_languages_are_learned_whole_next_to_a_hot_one(spark):
    assert LG.quotas({"a": 1000, "b": 10, "c": 400}, 300) == {"b": 10, "c": 145, "a": 145}
    assert LG.quotas({"a": 3, "b": 2}, 300) == {"a": 3, "b": 2}
    hot = [(i, t, "aa", "s", None) for i, t, lang, _, _ in corpus(3000, seed=3) if lang == "aa"]
    rare = [(10_000 + i, t, lang, "s", None) for i, t, lang, _, _ in corpus(60, seed=4) if lang != "aa"]
    df = spark.createDataFrame(hot + rare, DOCS)
    model = LG.train(df, max_docs=100, max_features=300)
    assert all(len(k) <= 300 for k in model.known) and model.languages[0] == "aa"
    tests = [r for r in corpus(90, seed=5)]
    got = {r["id"]: r["lang_pred"] for r in LG.identify(spark.createDataFrame(tests, DOCS), model).collect()}
    assert all(got[r[0]] == r[2] for r in tests)
    # rare languages keep words of their own under the cut by features
    small = LG.train(df, max_docs=100, max_features=60)
    assert all((small.cost[0][:, k] < LG.PENALTY).sum() >= 10 for k in range(3))
