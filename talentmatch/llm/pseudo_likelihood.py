"""Masked pseudo-likelihood: a bidirectional window network scores documents.

Every word is predicted from the two words before and the two after it; the sum of the log
probabilities is the document's score. The network knows the corpus's most frequent words (counted
over all of it) and hash buckets for the others. Its softmax has two steps, a class and a word of
the class, so a prediction costs the square root of the network's words.

A bucket's word has the probability of the bucket times its own share of the bucket's words, so the
vocabulary is every word of the corpus, however many there are: the counts of all words are a table,
the words above a frequency floor are sent to the tasks and the others are joined by hash.

Training goes over all documents: in each round every task takes its share of that round's
documents through numpy's minibatch steps from the common weights, and the tasks' weights are averaged
by Spark, weighted by words. Only a bounded number of the most frequent words and one set of weights
reach the driver.

Defined results: an empty or null text has no words, log_prob 0 and a null mean; without any word
nothing is trained and no document has words; repeated rows score alike and count as often as they
stand there. A word that was not counted takes one count's share of its bucket, spread evenly over
the bucket's hashes (without counts: all of it).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talentmatch.llm.words import ALNUM, chunks, slices, words_of
from talentmatch.session import scratch_path, ship_package

CLASSES, IN_CLASS = 32, 32
VOCABULARY = CLASSES * IN_CLASS
#: Of the vocabulary, hash buckets for words that are not among the most frequent.
BUCKETS = 256
OFFSETS = (-2, -1, 1, 2)
EMBEDDING, HIDDEN = 8, 24
BATCH, RATE = 4096, 0.05
ROUNDS = 2
_PAD = VOCABULARY
_PIECE = 4096          # weights in one row while they are averaged
_GATHERED = 2_000_000  # distinct words that a counting task holds before it passes them on
#: Words whose counts are sent to the tasks, at most; those of fewer occurrences are joined.
SENT = 500_000
#: ln of a single hash's part of its bucket.
UNCOUNTED = float(np.log(BUCKETS) - 64 * np.log(2))


# ---------------------------------------------------------------------------
# The network
# ---------------------------------------------------------------------------

SHAPES = {"embedding": (VOCABULARY + 1, EMBEDDING), "hidden": (len(OFFSETS) * EMBEDDING, HIDDEN), "hidden_bias": (HIDDEN,),
          "class": (HIDDEN, CLASSES), "class_bias": (CLASSES,), "word": (CLASSES, HIDDEN, IN_CLASS), "word_bias": (CLASSES, IN_CLASS)}
SIZE = sum(int(np.prod(s)) for s in SHAPES.values())


def views(flat: np.ndarray) -> dict[str, np.ndarray]:
    """The parameters by name, as views of one flat array."""
    out, at = {}, 0
    for name, shape in SHAPES.items():
        n = int(np.prod(shape))
        out[name] = flat[at:at + n].reshape(shape)
        at += n
    return out


def initial(seed: int = 7) -> np.ndarray:
    flat = np.zeros(SIZE, dtype=np.float32)
    rng, p = np.random.default_rng(seed), views(flat)
    for name in ("embedding", "hidden", "class", "word"):
        p[name][...] = rng.normal(0, 0.3 if name == "embedding" else 1 / np.sqrt(p[name].shape[-2]), p[name].shape)
    return flat


def _exp(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(exp(x), its sums by row); hidden units lie in [-1, 1], so a sane net never meets the bound."""
    if x.size and x.max() > 80:
        np.minimum(x, 80, out=x)
    e = np.exp(x)
    return e, e @ np.ones(e.shape[1], dtype=e.dtype)


def _softmax(x: np.ndarray) -> np.ndarray:
    e, total = _exp(x)
    e /= total[:, None]
    return e


def _by_class(target: np.ndarray):
    """(order, bounds): places of the targets, class by class."""
    group = (target // IN_CLASS).astype(np.uint8)
    order = np.argsort(group, kind="stable")
    return order, np.concatenate([[0], np.cumsum(np.bincount(group, minlength=CLASSES))])


def _hidden(p: dict[str, np.ndarray], context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = np.take(p["embedding"], context, axis=0).reshape(len(context), -1)
    h = x @ p["hidden"]
    h += p["hidden_bias"]
    return x, np.tanh(h, out=h)


def _word_logits(p: dict[str, np.ndarray], h: np.ndarray, group: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Of each row the logits of the words of its class; rows are in order of class."""
    z = np.empty((len(h), IN_CLASS), dtype=h.dtype)
    for c in range(CLASSES):
        a, b = bounds[c], bounds[c + 1]
        if a < b:
            np.matmul(h[a:b], p["word"][c], out=z[a:b])
    z += np.take(p["word_bias"], group, axis=0)
    return z


def log_probs(p: dict[str, np.ndarray], context: np.ndarray, target: np.ndarray) -> np.ndarray:
    """ln P(target | context) of each row of ``context`` (word ids around the target)."""
    n = len(target)
    order, bounds = _by_class(target)
    context, target = context[order], target[order]
    _, h = _hidden(p, context)
    group, rows = target // IN_CLASS, np.arange(n)
    z = h @ p["class"] + p["class_bias"]
    w = _word_logits(p, h, group, bounds)
    own = z[rows, group] + w[rows, target % IN_CLASS] - np.log(_exp(z)[1]) - np.log(_exp(w)[1])
    out = np.empty(n, dtype=np.float64)
    out[order] = own
    return out


def gradients(p: dict[str, np.ndarray], context: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The flat gradient of the mean negative log probability."""
    n = len(target)
    flat = np.zeros(SIZE, dtype=np.float32)
    g = views(flat)
    order, bounds = _by_class(target)
    context, target = context[order], target[order]
    x, h = _hidden(p, context)
    group, rows = target // IN_CLASS, np.arange(n)
    q = _softmax(h @ p["class"] + p["class_bias"])
    q[rows, group] -= 1
    q /= n
    g["class"][...], g["class_bias"][...] = h.T @ q, q.sum(axis=0)
    dh = q @ p["class"].T
    q = _softmax(_word_logits(p, h, group, bounds))
    q[rows, target % IN_CLASS] -= 1
    q /= n
    for c in range(CLASSES):
        a, b = bounds[c], bounds[c + 1]
        if a < b:
            g["word"][c], g["word_bias"][c] = h[a:b].T @ q[a:b], q[a:b].sum(axis=0)
            dh[a:b] += q[a:b] @ p["word"][c].T
    dh *= 1 - h * h
    g["hidden"][...], g["hidden_bias"][...] = x.T @ dh, dh.sum(axis=0)
    dx = np.ascontiguousarray((dh @ p["hidden"].T).reshape(-1, EMBEDDING).T)
    ids = context.ravel()
    for k in range(EMBEDDING):
        g["embedding"][:, k] = np.bincount(ids, dx[k], VOCABULARY + 1)
    return flat


def windows(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, target, document) of every word of some documents given by word ids."""
    reach = max(OFFSETS)
    n = np.array([len(t) for t in texts])
    gap = np.full(reach, _PAD, dtype=np.int64)
    row = np.concatenate([gap, *(x for t in texts for x in (t, gap))]).astype(np.int64)
    doc = np.repeat(np.arange(len(texts)), n)
    at = np.arange(n.sum()) + reach * (doc + 1)
    return np.stack([row[at + o] for o in OFFSETS], axis=1), row[at], doc


# ---------------------------------------------------------------------------
# Vocabulary
# ---------------------------------------------------------------------------

def _count(batches):
    """(word's hash, n): each task's words, joined as long as they fit."""
    held, waiting = [], 0

    def joined():
        h, inverse = np.unique(np.concatenate([x[0] for x in held]), return_inverse=True)
        return h, np.bincount(inverse, np.concatenate([x[1] for x in held]), len(h)).astype(np.int64)

    def out(h, n):
        for at in range(0, len(h), 200_000):
            yield pa.RecordBatch.from_arrays([pa.array(h[at:at + 200_000].view(np.int64)), pa.array(n[at:at + 200_000])], ["h", "n"])

    for batch in batches:
        for _, _, data, offsets in chunks(batch.column(0)):
            held.append(np.unique(words_of(data, offsets, ALNUM).hash, return_counts=True))
            waiting += len(held[-1][0])
            if waiting > _GATHERED:
                h, n = joined()
                held, waiting = [(h, n)], len(h)
                if waiting > _GATHERED // 2:
                    yield from out(h, n)
                    held, waiting = [], 0
    if held:
        yield from out(*joined())


def count_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(h, n): every word's hash and occurrences in all documents."""
    ship_package(docs.sparkSession)
    counted = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(_count, "h long, n long")
    return counted.groupBy("h").agg(F.sum("n").alias("n"))


def most_frequent(counted: DataFrame, size: int = VOCABULARY - BUCKETS) -> np.ndarray:
    """Hashes of the ``size`` most frequent words of ``count_words``, the most frequent first."""
    top = counted.orderBy(F.desc("n"), "h").limit(size).select("h").toArrow()
    return top["h"].to_numpy().view(np.uint64)


def vocabulary(docs: DataFrame, text_col: str = "text", size: int = VOCABULARY - BUCKETS) -> np.ndarray:
    """Hashes of the ``size`` most frequent words of all documents, the most frequent first."""
    return most_frequent(count_words(docs, text_col), size)


class Encoder:
    """Word hashes to word ids: a frequent word's rank, or a bucket."""

    def __init__(self, words: np.ndarray):
        self.rank = np.argsort(words)
        self.words = words[self.rank]

    def __call__(self, h: np.ndarray) -> np.ndarray:
        out = (VOCABULARY - BUCKETS + (h >> np.uint64(32)) % np.uint64(BUCKETS)).astype(np.int64)
        if len(self.words):
            k = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
            hit = self.words[k] == h
            out[hit] = self.rank[k[hit]]
        return out


@dataclass
class Shares:
    """What is sent of the counts of the buckets' words."""

    words: np.ndarray      # uint64, ascending: every word above the floor
    log_n: np.ndarray
    log_total: np.ndarray  # by bucket: ln of its occurrences and one for words that were not counted

    def __call__(self, h: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(shares, found) of words: ln P(word | bucket), without ln n of a word that isn't here."""
        out, found = -self.log_total[bucket], np.zeros(len(h), dtype=bool)
        if len(self.words):
            k = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
            found = self.words[k] == h
            out[found] += self.log_n[k[found]]
        return out, found


@dataclass
class Unigrams:
    sent: Shares
    rest: DataFrame | None  # (h, n) of the words that aren't sent


def unigrams(counted: DataFrame, words: np.ndarray, sent: int = SENT) -> Unigrams:
    """The counts of all words but the network's own, ``words``. ``counted`` is read several times."""
    of_buckets = counted.where(~F.col("h").isin(words.view(np.int64).tolist()))
    bucket = F.shiftrightunsigned("h", 32) % BUCKETS
    total = np.ones(BUCKETS)
    for r in of_buckets.groupBy(bucket.alias("bucket")).agg(F.sum("n").alias("n")).collect():
        total[r["bucket"]] += r["n"]
    # the floor is the least power of two above which there are few enough words
    by_bits = {r["bits"]: r["words"] for r in of_buckets.groupBy(F.length(F.bin("n")).alias("bits")).agg(F.count("*").alias("words")).collect()}
    floor, above = 64, 0
    while floor > 0 and above + by_bits.get(floor, 0) <= sent:
        above += by_bits.get(floor, 0)
        floor -= 1
    table = of_buckets.where(F.length(F.bin("n")) > floor).toArrow()
    h, n = table["h"].to_numpy().view(np.uint64), table["n"].to_numpy()
    order = np.argsort(h)
    shares = Shares(h[order], np.log(n[order].astype(np.float64)), np.log(total))
    return Unigrams(shares, of_buckets.where(F.length(F.bin("n")) <= floor) if floor else None)


@dataclass
class Encoded:
    rows: DataFrame           # id, fold, ids, row (a number), share (summed, of the words that were sent)
    tails: DataFrame | None   # (row, share): the same of joined words


def _tails(batches):
    """(row, h) of every word that has to be joined."""
    for batch in (part for whole in batches for part in slices(whole)):
        blobs = [np.frombuffer(x.as_buffer(), dtype=np.int64) for x in batch.column("tail")]
        rows = np.repeat(batch.column("row").to_numpy(), [len(x) for x in blobs])
        yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(np.concatenate([np.zeros(0, np.int64), *blobs]))], ["row", "h"])


def encode(docs: DataFrame, words: np.ndarray, id_col: str = "doc_id", text_col: str = "text", counts: Unigrams | None = None) -> Encoded:
    """Each document's word ids (uint16), its round and its words' shares of their buckets, written
    to the shared folder. Without ``counts`` no word was counted."""
    spark = docs.sparkSession
    joined = counts is not None and counts.rest is not None
    shares = Shares(np.zeros(0, np.uint64), np.zeros(0), np.zeros(BUCKETS)) if counts is None else counts.sent
    sent = spark.sparkContext.broadcast((words, shares))
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("fold", T.IntegerType()),
                           T.StructField("row", T.LongType()), T.StructField("ids", T.BinaryType()),
                           T.StructField("share", T.DoubleType()), T.StructField("tail", T.BinaryType())])

    def run(batches):
        encoder, shares = Encoder(sent.value[0]), sent.value[1]
        for batch in batches:
            for low, high, data, offsets in chunks(batch.column("text")):
                w = words_of(data, offsets, ALNUM)
                ids = encoder(w.hash)
                at = np.flatnonzero(ids >= VOCABULARY - BUCKETS)
                share, found = shares(w.hash[at], ids[at] - (VOCABULARY - BUCKETS))
                tail = at[~found] if joined else at[:0]
                if not joined:
                    share[~found] += UNCOUNTED
                total = np.bincount(w.docs()[at], share, high - low).astype(np.float64)
                ids, hashes, cut = ids.astype(np.uint16), w.hash[tail], np.searchsorted(tail, w.first)
                blobs = [ids[a:b].tobytes() for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
                tails = [hashes[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
                given = [batch.column(c).slice(low, high - low) for c in ("id", "fold", "row")]
                yield pa.RecordBatch.from_arrays([*given, pa.array(blobs, pa.binary()), pa.array(total), pa.array(tails, pa.binary())], schema.names)

    path = scratch_path(spark, "word-ids")
    text = F.col(text_col).cast("string")
    (docs.select(F.col(id_col).alias("id"), F.pmod(F.xxhash64(text), F.lit(ROUNDS)).cast("int").alias("fold"), text.alias("text"),
                 F.monotonically_increasing_id().alias("row"))
     .mapInArrow(run, schema).write.parquet(path))
    rows = spark.read.parquet(path)
    if not joined:
        return Encoded(rows, None)
    tails = rows.select("row", "tail").where(F.length("tail") > 0).mapInArrow(_tails, "row long, h long").join(counts.rest, "h", "left")
    return Encoded(rows, tails.groupBy("row").agg(F.sum(F.coalesce(F.log("n"), F.lit(UNCOUNTED))).alias("tail_share")))


# ---------------------------------------------------------------------------
# Training and scoring
# ---------------------------------------------------------------------------

def _read(batches, words: int):
    """Runs of whole documents of about so many words, as (rows, word ids)."""
    for batch in batches:
        blobs = batch.column("ids")
        texts, start, total = [], 0, 0
        for i in range(batch.num_rows):
            texts.append(np.frombuffer(blobs[i].as_buffer(), dtype=np.uint16))
            total += len(texts[-1])
            if total >= words or i == batch.num_rows - 1:
                yield batch.slice(start, i + 1 - start), texts
                texts, start, total = [], i + 1, 0


def _trained(weights, seed: int):
    """Each task's weights after its documents, in pieces, with the words they saw."""
    def run(batches):
        flat = weights.value.copy()
        p, seen, squares = views(flat), 0, np.full(SIZE, 1e-6, dtype=np.float32)
        rng = np.random.default_rng(seed)
        for _, texts in _read(batches, 16 * BATCH):
            context, target, _ = windows(texts)
            order = rng.permutation(len(target))
            for at in range(0, len(order), BATCH):
                part = order[at:at + BATCH]
                g = gradients(p, context[part], target[part])
                squares += g * g
                flat -= RATE * g / np.sqrt(squares)
            seen += len(target)
        if seen:
            pieces = [flat[a:a + _PIECE].astype(np.float64) for a in range(0, SIZE, _PIECE)]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(pieces), dtype=np.int32)), pa.array([x.tolist() for x in pieces], pa.list_(pa.float64())),
                                              pa.array(np.full(len(pieces), float(seen)))], ["piece", "values", "words"])
    return run


def train(encoded: Encoded, rounds: int = ROUNDS, seed: int = 7) -> np.ndarray:
    """The weights after ``rounds`` rounds over the documents of ``encode``, each in one round."""
    spark = encoded.rows.sparkSession
    flat = initial(seed)
    for r in range(rounds):
        weights = spark.sparkContext.broadcast(flat)
        made = encoded.rows.where(F.col("fold") == r).select("ids").mapInArrow(_trained(weights, seed + r), "piece int, values array<double>, words double")
        mean = Summarizer.mean(array_to_vector("values"), F.col("words"))
        rows = made.groupBy("piece").agg(vector_to_array(mean).alias("values")).orderBy("piece").collect()
        if rows:
            flat = np.concatenate([r["values"] for r in rows]).astype(np.float32)
    return flat


def score(encoded: Encoded, flat: np.ndarray) -> DataFrame:
    """Per row: id, n_words, log_prob (summed, natural) and mean_log_prob."""
    spark = encoded.rows.sparkSession
    sent = spark.sparkContext.broadcast(flat)
    schema = T.StructType([T.StructField("row", T.LongType()), T.StructField("id", encoded.rows.schema["id"].dataType),
                           T.StructField("n_words", T.LongType()), T.StructField("log_prob", T.DoubleType())])

    def run(batches):
        p = views(sent.value)
        for batch, texts in _read(batches, 4 * BATCH):
            context, target, doc = windows(texts)
            total = batch.column("share").to_numpy().copy()
            for at in range(0, len(target), 4 * BATCH):
                part = slice(at, at + 4 * BATCH)
                total += np.bincount(doc[part], log_probs(p, context[part], target[part]), len(texts))
            n = np.array([len(t) for t in texts], dtype=np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("id"), pa.array(n), pa.array(total)], schema.names)

    found = encoded.rows.select("row", "id", "ids", "share").mapInArrow(run, schema)
    if encoded.tails is not None:
        found = found.join(encoded.tails, "row", "left").withColumn("log_prob", F.col("log_prob") + F.coalesce("tail_share", F.lit(0.0)))
    return found.select("id", "n_words", "log_prob", F.when(F.col("n_words") > 0, F.col("log_prob") / F.col("n_words")).alias("mean_log_prob"))


def pseudo_likelihood(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on ``docs`` and score them (see ``score``)."""
    spark = docs.sparkSession
    path = scratch_path(spark, "unigrams")
    count_words(docs, text_col).write.parquet(path)
    counted = spark.read.parquet(path)
    words = most_frequent(counted)
    encoded = encode(docs, words, id_col, text_col, unigrams(counted, words))
    return score(encoded, train(encoded))
