"""Toxic passages by maximum-scoring segment search over token log-odds.

Learning (on labelled documents, a bounded sample of them): the log-odds of the label given a word,
with Dirichlet (two classes: Beta) priors that shrink a word towards its first five bytes, those
towards its first four, and those towards the base rate. A word's score is its log-odds less a
drift, so that clean text runs downhill; a word that only repeats the one before it scores nothing
but the drift.

Scoring: one linear scan (Ruzzo and Tompa's) finds all maximal segments of a document. A segment's
raw score S becomes an expected number of chance segments, E = K * words * exp(-lambda * S), with
lambda from the scores of clean labelled text (Karlin and Altschul). Segments with E <= ``max_e``
are passages. The evidence -ln E of all segments with E < 1 is summed, so that several weak ones add
up, and becomes a probability by a logistic curve fitted to the labels.

Defined results: an empty or null text has no passages and the score of no evidence; repeated rows
score alike; without a toxic (or without a clean) labelled document every score is the share of
toxic labels, 0 without labels; null labels and null ids are not learned from.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talentmatch.llm.words import ALNUM, Words, chunks, mix64, words_of
from talentmatch.session import ship_package

#: Labelled documents learned from, at most (about; the sample is by hash of the id).
MAX_LABELLED = 200_000
#: Word and prefix features kept of those that support the label most often.
MAX_FEATURES = 300_000
PRIOR = 10.0      # pseudo-documents behind a prior
DRIFT = 1.0       # what a word of no information takes from a segment
SUPPORT = 2       # toxic documents that a feature needs
MAX_E = 0.01
K = 0.1
_LEVELS = (None, 5, 4)
_SALT = (np.uint64(0), np.uint64(0x9D3F1A5C77E2B461), np.uint64(0x5B8E02D96F43C817))
_BITS = 22


def features(words: Words) -> list[np.ndarray]:
    """By level (word, first 5 bytes, first 4): each word's feature; 0 if it is no longer than that."""
    out = [words.hash]
    size = words.end - words.start
    for level, salt in zip(_LEVELS[1:], _SALT[1:], strict=True):
        f = np.zeros(len(size), dtype=np.uint64)
        long = size > level
        f[long] = words.span_hash(words.start[long], words.start[long] + level) ^ salt
        out.append(f)
    return out


@dataclass
class Model:
    """Scores of the features that matter; any other word scores ``-drift``."""

    known: np.ndarray      # uint64, ascending
    value: np.ndarray      # log-odds less drift
    drift: float = DRIFT
    decay: float = 1.0     # lambda
    curve: tuple[float, float] = (0.0, 0.0)
    base: float | None = None   # the score of everything, where nothing could be learned

    def __post_init__(self):
        self.maybe = np.zeros(1 << _BITS, dtype=bool)
        self.maybe[(self.known >> np.uint64(64 - _BITS)).astype(np.int64)] = True

    def lookup(self, f: np.ndarray) -> np.ndarray:
        """The place of each feature in ``known``, or -1."""
        out = np.full(len(f), -1, dtype=np.int64)
        at = np.flatnonzero(self.maybe[(f >> np.uint64(64 - _BITS)).astype(np.int64)])
        if len(at) and len(self.known):
            k = np.minimum(np.searchsorted(self.known, f[at]), len(self.known) - 1)
            hit = self.known[k] == f[at]
            out[at[hit]] = k[hit]
        return out

    def token_scores(self, words: Words) -> np.ndarray:
        levels = features(words)
        scores = np.full(len(words.hash), -self.drift)
        open_ = np.arange(len(scores))
        for f in levels:
            place = self.lookup(f[open_])
            found = place >= 0
            scores[open_[found]] = self.value[place[found]]
            open_ = open_[~found]
        again = np.zeros(len(scores) + 1, dtype=bool)
        again[1:-1] = words.hash[1:] == words.hash[:-1]
        again[words.first] = False
        scores[again[:-1]] = -self.drift
        return scores

    def evidence(self, s: float, n: int) -> float:
        """-ln E of a segment of raw score ``s`` among ``n`` words."""
        return self.decay * s - np.log(K * max(n, 1))

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        if self.base is not None:
            return np.full(len(evidence), self.base)
        a, b = self.curve
        return 1 / (1 + np.exp(-np.clip(a + b * np.log1p(np.maximum(evidence, 0)), -30, 30)))


def segments(place: np.ndarray, score: np.ndarray, total: np.ndarray) -> list[tuple[float, int, int]]:
    """All maximal scoring segments (score, first, last) in one scan over the positive words:
    ``place`` and ``score``, with ``total`` the running sum of all words up to and with each.

    Linear (Ruzzo and Tompa): each held segment knows its nearest predecessor of a smaller ``low``,
    and where there is none, no later segment reaches back, so all held ones are done."""
    done: list[list] = []
    held: list[list] = []  # low, high, first, last, predecessor
    for p, high, low in zip(place.tolist(), total.tolist(), (total - score).tolist(), strict=True):
        new = [low, high, p, p, -1]
        j = len(held) - 1
        while True:
            while j >= 0 and held[j][0] >= new[0]:
                j = held[j][4]
            if j < 0:
                done += held
                held = [new]
                break
            if held[j][1] >= new[1]:
                new[4] = j
                held.append(new)
                break
            new[0], new[2] = held[j][0], held[j][2]
            last, j = j, held[j][4]
            del held[last:]
    return [(high - low, first, last) for low, high, first, last, _ in done + held]


def passages(model: Model, words: Words, max_e: float = MAX_E):
    """(evidence by document, by document the list of (first word, last word, score, E))."""
    n = len(words.first) - 1
    scores = model.token_scores(words)
    total = np.cumsum(scores)
    positive = np.flatnonzero(scores > 0)
    cut = np.searchsorted(positive, words.first)
    counts = words.counts()
    evidence, found = np.zeros(n), {}
    for d in np.flatnonzero(np.diff(cut)).tolist():
        p = positive[cut[d]:cut[d + 1]]
        kept = []
        for s, first, last in segments(p, scores[p], total[p]):
            e = model.evidence(s, int(counts[d]))
            evidence[d] += max(e, 0.0)
            if e >= -np.log(max_e):
                kept.append((first, last, s, float(np.exp(-min(e, 700)))))
        if kept:
            found[d] = kept
    return evidence, found


# ---------------------------------------------------------------------------
# Learning
# ---------------------------------------------------------------------------

def _sampled_labels(labels: DataFrame, id_col: str, label_col: str, max_labelled: int) -> DataFrame:
    rows = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
            .where("id IS NOT NULL AND label IS NOT NULL"))
    n = rows.count()
    if n > max_labelled:
        rows = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 32)) < int((1 << 32) * max_labelled / n))
    return rows.groupBy("id").agg(F.max("label").alias("label"))


def _count_features(wanted: int, candidates: np.ndarray | None):
    """(feature, parent, documents of the class ``wanted`` that have it) of each batch."""
    def run(batches):
        for batch in batches:
            label = batch.column("label").to_numpy()
            texts = batch.column("text").filter(pa.array(label == wanted))
            for _, _, data, offsets in chunks(texts):
                words = words_of(data, offsets, ALNUM)
                docs, levels = words.docs().astype(np.uint64), features(words)
                for level, f in enumerate(levels):
                    there = np.flatnonzero(f)
                    if candidates is not None:
                        k = np.minimum(np.searchsorted(candidates, f[there]), len(candidates) - 1)
                        there = there[candidates[k] == f[there]]
                    # a feature's parent is the next shorter prefix of its words
                    up = levels[level + 1] if level + 1 < len(levels) else np.zeros(len(f), np.uint64)
                    if level == 0:
                        up = np.where(up == 0, levels[2], up)
                    _, one = np.unique(mix64(f[there] + mix64(docs[there] + np.uint64(1))), return_index=True)
                    kind, at, n = np.unique(f[there][one], return_index=True, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(kind.view(np.int64)), pa.array(up[there][one][at].view(np.int64)), pa.array(n)], ["f", "up", "n"])
    return run


def _log_odds(f, up, toxic, clean, base: float, prior: float) -> np.ndarray:
    """Log-odds of the label, given each feature, over the base rate; parents come first."""
    place = {x: i for i, x in enumerate(f.tolist())}
    share = np.full(len(f), -1.0)

    def of(i):
        if share[i] < 0:
            parent = place.get(int(up[i])) if up[i] else None
            mean = base if parent is None else of(parent)
            share[i] = (toxic[i] + prior * mean) / (toxic[i] + clean[i] + prior)
        return share[i]

    for i in range(len(f)):
        of(i)
    share = np.clip(share, 1e-9, 1 - 1e-9)
    return np.log(share / (1 - share)) - np.log(base / (1 - base))


def _decay(values: np.ndarray, counts: np.ndarray, top: float) -> float:
    """lambda > 0 with sum p exp(lambda s) = 1; one more word of the highest score keeps it finite."""
    values, counts = np.append(values, max(top, 0.1)), np.append(counts, 1).astype(float)
    p = counts / counts.sum()
    low, high = 0.0, 1.0
    excess = lambda x: np.logaddexp.reduce(np.log(p) + x * values)
    if (p * values).sum() >= 0:
        return 0.05
    while excess(high) < 0 and high < 200:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    return max(low, 0.05)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(a, b) of the curve 1 / (1 + exp(-(a + b x))), lightly held towards 0, by Newton steps."""
    w, z = np.zeros(2), np.stack([np.ones(len(x)), x], axis=1)
    hold = np.array([1e-3, 1e-1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(hold), z.T @ (y - p) - hold * w)
        w = w + step * min(1.0, 4 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          max_labelled: int = MAX_LABELLED, max_features: int = MAX_FEATURES) -> Model:
    """Learn from the documents whose ids ``labels`` (columns id_col, label_col) names; equal texts
    count once. What comes to the driver is bounded by ``max_labelled`` and ``max_features``."""
    spark = docs.sparkSession
    ship_package(spark)
    sample = F.broadcast(_sampled_labels(labels, id_col, label_col, max_labelled))
    texts = (docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
             .join(sample, "id").groupBy(F.xxhash64("text").alias("h")).agg(F.first("text").alias("text"), F.max("label").alias("label"))
             .select("text", "label").persist())
    try:
        sizes = {r["label"] > 0: r["n"] for r in texts.groupBy("label").agg(F.count("*").alias("n")).collect()}
        ones, zeros = sizes.get(True, 0), sizes.get(False, 0)
        empty = Model(np.zeros(0, np.uint64), np.zeros(0), base=float(ones > 0 and not zeros))
        if not ones or not zeros:
            return empty
        texts = texts.withColumn("label", (F.col("label") > 0).cast("int"))
        schema = "f long, up long, n long"
        counted = (texts.mapInArrow(_count_features(1, None), schema).groupBy("f").agg(F.max("up").alias("up"), F.sum("n").alias("n"))
                   .where(F.col("n") >= SUPPORT).orderBy(F.desc("n"), "f").limit(max_features).toPandas())
        if not len(counted):
            return Model(np.zeros(0, np.uint64), np.zeros(0), base=ones / (ones + zeros))
        f = counted["f"].to_numpy(np.int64).view(np.uint64)
        up, toxic = counted["up"].to_numpy(np.int64).view(np.uint64), counted["n"].to_numpy(float)
        order = np.argsort(f)
        f, up, toxic = f[order], up[order], toxic[order]
        against = texts.mapInArrow(_count_features(0, f), schema).groupBy("f").agg(F.sum("n").alias("n")).toPandas()
        clean = np.zeros(len(f))
        clean[np.searchsorted(f, against["f"].to_numpy(np.int64).view(np.uint64))] = against["n"].to_numpy(float)
        odds = _log_odds(f, up, toxic, clean, ones / (ones + zeros), PRIOR)
        good = dict(zip(f.tolist(), (odds > DRIFT).tolist(), strict=True))
        # words that score below zero matter only where they stand before a prefix that would not
        kept = np.array([o > DRIFT or good.get(int(u), False) for o, u in zip(odds, up, strict=True)])
        model = Model(f[kept], odds[kept] - DRIFT)

        spread = texts.where("label = 0").mapInArrow(_score_counts(model), "value double, n long")
        spread = spread.groupBy("value").agg(F.sum("n").alias("n")).toPandas()
        model.decay = _decay(spread["value"].to_numpy(), spread["n"].to_numpy(), float(model.value.max(initial=0.0)))
        pairs = texts.mapInArrow(_evidence_rows(model), "evidence double, label int")
        pairs = pairs.groupBy(F.round("evidence", 1).alias("evidence"), "label").agg(F.count("*").alias("n")).toPandas()
        x, y = np.repeat(np.log1p(pairs["evidence"].to_numpy()), pairs["n"]), np.repeat(pairs["label"].to_numpy(float), pairs["n"])
        model.curve = _logistic(x, y)
        return model
    finally:
        texts.unpersist()


def _score_counts(model: Model):
    def run(batches):
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column("text")):
                value, n = np.unique(np.round(model.token_scores(words_of(data, offsets, ALNUM)), 1), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(value), pa.array(n)], ["value", "n"])
    return run


def _evidence_rows(model: Model):
    def run(batches):
        for batch in batches:
            for low, high, data, offsets in chunks(batch.column("text")):
                evidence, _ = passages(model, words_of(data, offsets, ALNUM))
                yield pa.RecordBatch.from_arrays([pa.array(evidence), batch.column("label").slice(low, high - low)], ["evidence", "label"])
    return run


# ---------------------------------------------------------------------------
# Scoring
# ---------------------------------------------------------------------------

PASSAGE = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                        T.StructField("score", T.DoubleType()), T.StructField("e_value", T.DoubleType())])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", max_e: float = MAX_E) -> DataFrame:
    """Per row: id, score (0 to 1) and the significant passages (start, end in code points, score, e_value)."""
    spark = docs.sparkSession
    ship_package(spark)
    sent = spark.sparkContext.broadcast(model)
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("score", T.DoubleType()),
                           T.StructField("passages", T.ArrayType(PASSAGE))])
    arrow = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("e_value", pa.float64())]))

    def run(batches):
        for batch in batches:
            for low, high, data, offsets in chunks(batch.column(1)):
                words = words_of(data, offsets, ALNUM)
                evidence, found = passages(sent.value, words, max_e)
                listed: list[list[dict]] = [[] for _ in range(high - low)]
                for d, kept in found.items():
                    # code points before a byte: the bytes that do not continue one
                    points = np.concatenate([[0], np.cumsum((data[offsets[d]:offsets[d + 1]] & 0xC0) != 0x80)])
                    listed[d] = [{"start": int(points[words.start[a] - offsets[d]]), "end": int(points[words.end[b] - offsets[d]]),
                                  "score": float(s), "e_value": e} for a, b, s, e in kept]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), pa.array(sent.value.probability(evidence)),
                                                  pa.array(listed, arrow)], ["id", "score", "passages"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose score is below ``threshold``; nothing is shuffled."""
    ship_package(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for low, high, data, offsets in chunks(batch.column(at)):
                evidence, _ = passages(sent.value, words_of(data, offsets, ALNUM))
                kept = batch.slice(low, high - low).filter(pa.array(sent.value.probability(evidence) < threshold))
                if kept.num_rows:
                    yield kept

    return docs.mapInArrow(run, docs.schema)
