"""Language identification, word first with back-off to character n-grams.

A word that the model knows scores, by language, its negative log frequency there (a fixed penalty
where it is unseen). An unseen word backs off to its n-grams, blanks at its ends included: to the
longest n of which the model knows any, the mean of those. The language of the smallest mean over
all words is the prediction.

Defined results: ``und`` with score 0 for a null text, one without letters, or a model without
languages; equal means go to the language of more learned documents, then the first by name;
rows are judged one by one, so repeated rows and ids don't matter; null languages aren't learned.
"""

from __future__ import annotations

import functools
import sys
import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talentmatch.llm.words import _powers, _room, chunks, mix64, slices
from talentmatch.session import ship_package

#: Documents learned from, at most (about; the sample is by hash of the id and text, with a rate
#: for each language: those with fewer documents than an even share are learned whole).
MAX_DOCS = 20_000
#: Words, and n-grams of each length, that the model keeps: those of the largest share of any language.
MAX_FEATURES = 200_000
LENGTHS = (5, 4, 3, 2, 1)
PENALTY = 7.0     # as if seen once in ten million
LEAST = 2         # times that a feature must be seen
UNKNOWN = "und"


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(sys.maxunicode + 1)), dtype=bool, count=sys.maxunicode + 1)


@dataclass
class Text:
    """Lower-cased documents as letters with single blanks around every word."""

    start: np.ndarray   # of each word, in ``sums``
    end: np.ndarray
    first: np.ndarray   # word offsets by document
    sums: np.ndarray

    def grams(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        _, down = _powers(_room(len(self.sums)))
        return mix64((self.sums[end] - self.sums[start]) * down[start] + (end - start).astype(np.uint64))

    def words(self) -> np.ndarray:
        return self.grams(self.start - 1, self.end + 1)

    def windows(self, words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, owner): all n-grams of the given words, blanks included; owner counts within ``words``."""
        number = np.maximum(self.end[words] - self.start[words] + 3 - n, 0)
        owner = np.repeat(np.arange(len(words)), number)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number) + (self.start[words] - 1)[owner]
        return self.grams(at, at + n), owner


def read(data: np.ndarray, offsets: np.ndarray) -> Text:
    """The words of lower-cased UTF-8 documents."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32)
    before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    # a blank before the first document and after each
    points = np.insert(points, before, 32)
    bounds = before + np.arange(len(before))
    letter = _letters()[points]
    kept = letter.copy()
    kept[1:] |= letter[:-1]
    kept[0] = True
    at = np.flatnonzero(kept)
    sign, value = letter[at], np.where(letter[at], points[at], 32).astype(np.uint64)
    up, _ = _powers(_room(len(at) + 1))
    sums = np.zeros(len(at) + 1, dtype=np.uint64)
    np.cumsum((mix64(value + np.uint64(1)) | np.uint64(1)) * up[:len(at)], out=sums[1:])
    edge = np.diff(sign.astype(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return Text(start, end, np.searchsorted(at[start], bounds), sums)


@dataclass
class Model:
    languages: list[str]                            # of more documents first, then by name
    known: list[np.ndarray]                         # words, then n-grams by LENGTHS: uint64, ascending
    cost: list[np.ndarray]                          # (feature, language)

    def lookup(self, level: int, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which, costs) of the hashes that the level knows."""
        known = self.known[level]
        if not len(known):
            return np.zeros(0, np.int64), np.zeros((0, len(self.languages)), np.float32)
        k = np.minimum(np.searchsorted(known, h), len(known) - 1)
        which = np.flatnonzero(known[k] == h)
        return which, self.cost[level][k[which]]

    def word_costs(self, text: Text) -> np.ndarray:
        out = np.full((len(text.start), len(self.languages)), PENALTY, dtype=np.float32)
        which, cost = self.lookup(0, text.words())
        out[which] = cost
        open_ = np.ones(len(out), dtype=bool)
        open_[which] = False
        for level, n in enumerate(LENGTHS, 1):
            words = np.flatnonzero(open_)
            if not len(words):
                break
            h, owner = text.windows(words, n)
            which, cost = self.lookup(level, h)
            if len(which):
                mine = owner[which]
                first = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1]]))
                own = words[mine[first]]
                out[own] = np.add.reduceat(cost, first, axis=0) / np.diff(np.append(first, len(mine)))[:, None]
                open_[own] = False
        return out

    def predict(self, text: Text) -> tuple[list[str], np.ndarray]:
        """By document: the language and its share of the evidence."""
        n = np.diff(text.first)
        if not self.languages:
            return [UNKNOWN] * len(n), np.zeros(len(n))
        total = np.concatenate([np.zeros((1, len(self.languages))), np.cumsum(self.word_costs(text), axis=0, dtype=np.float64)])
        mean = (total[text.first[1:]] - total[text.first[:-1]]) / np.maximum(n, 1)[:, None]
        mean = np.round(mean, 9)
        best = mean.argmin(axis=1)
        # evidence of more than ten words adds nothing to a share
        odds = np.exp(-np.minimum((mean - mean.min(axis=1, keepdims=True)) * np.minimum(n, 10)[:, None], 50))
        share = np.where(n > 0, 1 / odds.sum(axis=1), 0.0)
        return [self.languages[b] if k else UNKNOWN for b, k in zip(best.tolist(), n.tolist(), strict=True)], share


def _lowered(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(column.fill_null(""))


def _counts(languages: list[str]):
    """(level, language, feature, n) over each task's documents."""
    def run(batches):
        held: dict[tuple[int, int], list] = {}
        for batch in (part for whole in batches for part in slices(whole)):
            langs = batch.column("lang").to_pylist()
            for number, name in enumerate(languages):
                texts = batch.column("text").filter(pa.array([x == name for x in langs]))
                for _, _, data, offsets in chunks(_lowered(texts)):
                    text = read(data, offsets)
                    every = np.arange(len(text.start))
                    for level, h in enumerate([text.words(), *(text.windows(every, n)[0] for n in LENGTHS)]):
                        held.setdefault((level, number), []).append(np.unique(h, return_counts=True))
        for (level, number), parts in held.items():
            h, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            n = np.bincount(inverse, np.concatenate([p[1] for p in parts]), len(h)).astype(np.int64)
            for at in range(0, len(h), 100_000):
                part = slice(at, at + 100_000)
                size = len(h[part])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(size, level, np.int32)), pa.array(np.full(size, number, np.int32)),
                                                  pa.array(h[part].view(np.int64)), pa.array(n[part])], ["level", "number", "f", "n"])
    return run


def quotas(sizes: dict[str, int], max_docs: int) -> dict[str, float]:
    """Documents to learn by language: ``max_docs`` in even shares; what a language lacks goes to the larger ones."""
    out, left = {}, float(max_docs)
    for done, lang in enumerate(sorted(sizes, key=lambda x: (sizes[x], x))):
        out[lang] = min(float(sizes[lang]), left / (len(sizes) - done))
        left -= out[lang]
    return out


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          max_docs: int = MAX_DOCS, max_features: int = MAX_FEATURES) -> Model:
    """Learn from (a bounded sample of) the rows of ``docs`` that name a language. What comes to the
    driver is bounded by ``max_features`` and the number of languages."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if sum(sizes.values()) > max_docs:
        below = [(x, int((1 << 32) * q / sizes[x])) for x, q in quotas(sizes, max_docs).items()]
        rates = docs.sparkSession.createDataFrame(below, "lang string, below long")
        rows = rows.join(F.broadcast(rates), "lang").where(F.pmod(F.xxhash64("id", "text"), F.lit(1 << 32)) < F.col("below"))
    languages = sorted(sizes, key=lambda x: (-sizes[x], x))
    counted = rows.select("text", "lang").mapInArrow(_counts(languages), "level int, number int, f long, n long")
    counted = counted.groupBy("level", "number", "f").agg(F.sum("n").alias("n")).persist()
    try:
        all_ = {(r["level"], r["number"]): r["n"] for r in counted.groupBy("level", "number").agg(F.sum("n").alias("n")).collect()}
        known, cost = [], []
        sums = docs.sparkSession.createDataFrame([(*k, n) for k, n in all_.items()], "level int, number int, total long")
        shares = counted.join(F.broadcast(sums), ["level", "number"]).withColumn("share", F.col("n") / F.col("total"))
        for level in range(len(LENGTHS) + 1):
            top = (shares.where(F.col("level") == level).groupBy("f").agg(F.sum("n").alias("n"), F.max("share").alias("share"), F.map_from_entries(
                F.collect_list(F.struct("number", "n"))).alias("by")).where(F.col("n") >= LEAST)
                .orderBy(F.desc("share"), "f").limit(max_features).select("f", F.map_keys("by").alias("number"), F.map_values("by").alias("n")))
            table = top.toArrow()
            f = table["f"].to_numpy().view(np.uint64)
            place = np.repeat(np.arange(len(f)), pc.list_value_length(table["n"]).to_numpy()) if len(f) else np.zeros(0, int)
            number, n = (pc.list_flatten(table[c]).to_numpy() for c in ("number", "n"))
            totals = np.array([all_.get((level, k), 1) for k in range(len(languages))], dtype=float)
            costs = np.full((len(f), len(languages)), PENALTY, dtype=np.float32)
            costs[place, number] = np.minimum(-np.log10(n / totals[number]), PENALTY)
            order = np.argsort(f)
            known.append(f[order])
            cost.append(costs[order])
        return Model(languages, known, cost)
    finally:
        counted.unpersist()


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, lang_pred and score (0 to 1)."""
    spark = docs.sparkSession
    ship_package(spark)
    sent = spark.sparkContext.broadcast(model)
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])

    def run(batches):
        for batch in (part for whole in batches for part in slices(whole)):
            for low, high, data, offsets in chunks(_lowered(batch.column(1))):
                names, share = sent.value.predict(read(data, offsets))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), pa.array(names, pa.string()), pa.array(share)],
                                                 ["id", "lang_pred", "score"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)
