"""Mixing sources to target weights in fixed-length blocks of words.

1. A source's documents stand in a pseudorandom order (by hash of the id); their words, end to end,
   are cut into blocks of ``block_words``. Places in that order are prefix sums in two steps
   (chunks, then documents of a chunk), so no source meets in one task.
2. Each output shard draws how many of its slots each source gets: the multinomial, given that all
   shards together give every source its target. A shard finds its own draw by halving the shards
   again and again, with a seed for each half; no shard needs another.
3. A source's slots run through pseudorandom permutations of its block indices, one permutation for
   each time round, so a block comes back only after all others.
4. Slots and blocks are joined by (source, index).

Defined results: null and empty texts have size 0 and are in no block; a null source is a source of
its own, last in order; null and repeated ids and repeated rows are documents of their own; an empty
table gives no rows. Equal inputs give equal mixes, whatever the partitions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from talentmatch.session import scratch_path, ship_package

BLOCK_WORDS = 64
SHARD_SLOTS = 8192
#: Documents of a source that one window sorts (about).
CHUNK_DOCS = 2000
#: A recipe names every source; more than this are no recipe.
MAX_SOURCES = 100_000
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: list[int], weights: list[float], share: float, cap: float) -> list[float]:
    """``share`` times all sizes, dealt by weight; no more than ``cap`` times a source's size, what is
    above dealt again to the others by weight until none is above."""
    out, left, open_ = [0.0] * len(sizes), share * sum(sizes), [i for i, s in enumerate(sizes) if s > 0]
    while open_:
        unit = left / sum(weights[i] for i in open_)
        above = [i for i in open_ if unit * weights[i] > cap * sizes[i]]
        for i in above or open_:
            out[i] = cap * sizes[i] if above else unit * weights[i]
        if not above:
            break
        left -= sum(out[i] for i in above)
        open_ = [i for i in open_ if i not in set(above)]
    return out


def split_counts(rng: np.random.Generator, counts: np.ndarray, n: int) -> np.ndarray:
    """How many of ``n`` draws without return from ``counts`` things of each kind fall on each kind."""
    if counts.sum() < 10**9:
        return rng.multivariate_hypergeometric(counts, n, method="marginals")
    out, left, rest = np.zeros_like(counts), n, int(counts.sum())
    for i, c in enumerate(counts.tolist()):
        rest -= c
        low, high = max(0, left - rest), min(c, left)
        if c + rest < 10**9:
            k = int(rng.hypergeometric(c, rest, left)) if left else 0
        else:  # beyond numpy's range: the normal curve of the same mean and variance
            p, total = c / (c + rest), c + rest
            k = round(rng.normal(left * p, math.sqrt(left * p * (1 - p) * max(total - left, 0) / max(total - 1, 1))))
        out[i] = min(max(k, low), high)
        left -= int(out[i])
    return out


def shard_draw(shard: int, shards: int, slots: int, counts: np.ndarray, seed: int, per: int = SHARD_SLOTS) -> tuple[np.ndarray, np.ndarray]:
    """(first, number): by source, the slots of ``counts`` (``slots`` in all) that the shard gets."""
    low, high, counts, first = 0, shards, counts.astype(np.int64), np.zeros(len(counts), dtype=np.int64)
    while high - low > 1:
        mid = (low + high) // 2
        n = min(slots, mid * per) - min(slots, low * per)
        left = split_counts(np.random.default_rng([seed, low, high]), counts, n)
        if shard < mid:
            high, counts = mid, left
        else:
            low, counts, first = mid, counts - left, first + left
    return first, counts


def permuted(index: np.ndarray, n: int, key: list[int]) -> np.ndarray:
    """A keyed permutation of 0..n-1: four Feistel rounds, walked until the result is below n."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = np.random.default_rng(key).integers(1, 1 << 63, size=(4, 2), dtype=np.uint64) | np.uint64(1)
    out, todo = index.astype(np.uint64), np.arange(len(index))
    while len(todo):
        x = out[todo]
        a, b = x >> shift, x & mask
        for k, m in keys:
            f = (b + k) * m
            a, b = b, a ^ ((f ^ (f >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - half))
        out[todo] = (a << shift) | b
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


@dataclass
class Source:
    name: str | None
    size: int       # words
    target: float   # words
    blocks: int
    slots: int


def recipe(sized: DataFrame, weights: list[float], share: float, cap: int, block_words: int) -> list[Source]:
    """The sources of ``sized`` (source, size), in code-point order, null last, with their targets."""
    rows = sized.groupBy("source").agg(F.sum("size").alias("size")).limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources: name coarser ones")
    rows = sorted(rows, key=lambda r: (r["source"] is None, r["source"] or ""))
    wanted = targets([r["size"] for r in rows], [weights[i % len(weights)] for i in range(len(rows))], share, cap)
    out = []
    for r, t in zip(rows, wanted, strict=True):
        blocks = -(-r["size"] // block_words)
        out.append(Source(r["source"], r["size"], t, blocks, min(cap * blocks, round(t * blocks / r["size"])) if blocks else 0))
    return out


def slots(spark, sources: list[Source], seed: int, per: int = SHARD_SLOTS) -> DataFrame:
    """(shard, position, sid, block): every slot of every output shard."""
    ship_package(spark)
    counts = np.array([s.slots for s in sources], dtype=np.int64)
    total = int(counts.sum())
    shards = -(-total // per)
    blocks = [s.blocks for s in sources]

    def run(batches):
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                first, number = shard_draw(shard, shards, total, counts, seed, per)
                sid = np.repeat(np.arange(len(counts)), number)
                block = np.empty(len(sid), dtype=np.int64)
                done = 0
                for s in np.flatnonzero(number).tolist():
                    slot = first[s] + np.arange(number[s])
                    for lap in range(int(slot[0]) // blocks[s], int(slot[-1]) // blocks[s] + 1):
                        own = np.flatnonzero(slot // blocks[s] == lap)
                        block[done + own] = permuted(slot[own] % blocks[s], blocks[s], [seed, s, lap])
                    done += int(number[s])
                order = np.random.default_rng([seed, shard]).permutation(len(sid))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(sid), shard)), pa.array(np.arange(len(sid), dtype=np.int64)), pa.array(sid[order].astype(np.int32)),
                     pa.array(block[order])], ["shard", "position", "sid", "block"])

    parts = max(1, min(shards, 4 * spark.sparkContext.defaultParallelism))
    return spark.range(0, shards, 1, parts).mapInArrow(run, "shard long, position long, sid int, block long")


def placed(sized: DataFrame, sources: list[Source], n_docs: int) -> DataFrame:
    """``sized`` with sid, chunk and rank (the row's number in its chunk), first and last: its words'
    places in its source's order, last exclusive."""
    spark = sized.sparkSession
    names = spark.createDataFrame([(s.name, i) for i, s in enumerate(sources)], "name string, sid int")
    chunks = max(1, n_docs // CHUNK_DOCS)
    rows = (sized.join(F.broadcast(names), sized["source"].eqNullSafe(names["name"])).drop("name")
            .withColumn("chunk", F.pmod(F.xxhash64(F.col("id").cast("string"), "h"), F.lit(chunks)).cast("int")))
    before = (rows.groupBy("sid", "chunk").agg(F.sum("size").alias("words"))
              .withColumn("before", F.sum("words").over(W.partitionBy("sid").orderBy("chunk")) - F.col("words")).drop("words"))
    order = W.partitionBy("sid", "chunk").orderBy("id", "h", "size")
    return (rows.join(before, ["sid", "chunk"])
            .withColumn("rank", F.row_number().over(order))
            .withColumn("last", F.col("before") + F.sum("size").over(order.rowsBetween(W.unboundedPreceding, 0)))
            .withColumn("first", F.col("last") - F.col("size")).drop("before"))


def mix(docs: DataFrame, weights: list[float] | None = None, share: float = 1.5, cap: int = 2, block_words: int = BLOCK_WORDS,
        seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> tuple[DataFrame, list[Source]]:
    """(rows, sources). A row for each part of a document that a block holds and each slot the block
    fills: id, size, sid, chunk and rank (which name the document), words [start, end) of the document,
    shard and position; a part that no slot takes, and a document without words, has null there.

    Sources weigh as ``weights`` (3, 1, 2 if None), taken in turn in code-point order, and share
    ``share`` times all words, none more than ``cap`` times its own.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "sized")
    (docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("text"))
     .select("id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), F.xxhash64("text").alias("h"))
     .write.parquet(path))
    sized = spark.read.parquet(path)
    sources = recipe(sized, weights or [3, 1, 2], share, cap, block_words)
    at = placed(sized, sources, sized.count())
    parts = at.withColumn("block", F.explode_outer(F.when(
        F.col("size") > 0, F.sequence(F.floor(F.col("first") / block_words), F.floor((F.col("last") - 1) / block_words)))))
    parts = parts.withColumn("start", F.greatest(F.col("first"), F.col("block") * block_words) - F.col("first")).withColumn(
        "end", F.least(F.col("last"), (F.col("block") + 1) * block_words) - F.col("first"))
    # Spark sees a short range behind the slots and would broadcast them; they grow with the words
    rows = parts.join(slots(spark, sources, seed).hint("merge"), ["sid", "block"], "left")
    return rows.select("id", "size", "sid", "chunk", "rank", "start", "end", "shard", "position"), sources


def taken(rows: DataFrame, sources: list[Source]) -> DataFrame:
    """Of ``mix``, per document: id, source, size, source_size, target and taken (words, repeats counted)."""
    spark = rows.sparkSession
    each = rows.groupBy("sid", "chunk", "rank", "id", "size").agg(
        F.sum(F.when(F.col("shard").isNotNull(), F.col("end") - F.col("start")).otherwise(0)).cast("long").alias("taken"))
    named = spark.createDataFrame([(i, s.name, s.size, float(s.target)) for i, s in enumerate(sources)],
                                  "sid int, source string, source_size long, target double")
    return each.join(F.broadcast(named), "sid").select("id", "source", "size", "source_size", "target", "taken")
