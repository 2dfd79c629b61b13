"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

1. Rows of one word set are one *class*, named by its smallest id: exact copies, however many, meet
   in a partial aggregate and go no further.
2. A class's signature takes two permutations of the 64-bit integers: the first scatters the set
   once, the second gives every coordinate by shifting its argument circularly.
3. Each band of the signature is a bucket key. A bucket of several classes links each to its
   smallest (a star, not all pairs). Links are confirmed on whole sets. Linked classes form
   components.
4. A bucket whose classes are in one component is done. In the others, pairs of different
   components are compared inside the tasks: a bucket is cut into blocks of bounded size, a task
   takes two blocks, a pair is looked at in the first bucket it shares only, signatures that are
   far apart are passed over (at a likeness so low that a true pair falls below it with a
   probability under one in a million), the rest is confirmed on whole sets. No bucket is capped,
   and only confirmed links leave the tasks.

A pair at the threshold of 0.8 shares no band of 32 bands of 4 with a probability of 5e-8.

Defined results: a document without words (or with a null text) has an empty set and is linked with
nothing; a null id has no component and is not kept; rows that repeat an id are one node of the
graph; of the input only the id and text columns are read; texts of any length are read whole; an
empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talentmatch.llm.components import components
from talentmatch.llm.membership import only
from talentmatch.llm.words import NON_SPACE, chunks, mix64, shingles, words_of
from talentmatch.session import bounded_batches, scratch_path, scratch_scope, ship_package

BANDS, ROWS = 32, 4
#: Classes of one block in the comparison of what stars left open.
BLOCK = 512
#: Standard errors below the threshold at which a signature is too far to be a link.
PASS_OVER = 5.0
_SCATTER, _SHIFT = np.uint64(0x51ED270B35C5A6E1), 0x632BE59BD9B4E019
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


# ---------------------------------------------------------------------------
# Signatures
# ---------------------------------------------------------------------------

def circulant_minhash(values: np.ndarray, first: np.ndarray, coordinates: int) -> np.ndarray:
    """(documents, coordinates): minima over ``values[first[d]:first[d+1]]`` (never none) of one
    permutation of the scattered values, its argument shifted circularly by coordinate."""
    out = np.empty((len(first) - 1, coordinates), dtype=np.uint64)
    if not len(out):
        return out
    scattered = mix64(values ^ _SCATTER)
    x, y = np.empty_like(scattered), np.empty_like(scattered)
    for k in range(coordinates):
        np.add(scattered, np.uint64(k * _SHIFT % (1 << 64)), out=x)
        x *= _M1
        np.right_shift(x, np.uint64(33), out=y)
        x ^= y
        x *= _M2
        out[:, k] = np.minimum.reduceat(x, first[:-1])
    return out


def band_keys(signatures: np.ndarray, rows: int) -> np.ndarray:
    """(documents, bands) hashes of runs of ``rows`` coordinates, the band's number included."""
    bands = signatures.shape[1] // rows
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(signatures), bands)).copy()
    for j in range(rows):
        keys = mix64(keys * np.uint64(0x9E3779B97F4A7C15) + signatures[:, j::rows][:, :bands])
    return keys


def jaccard_at_least(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether 100 * shared >= percent * union of two sorted sets; two empty sets are not alike."""
    a, b = len(x), len(y)
    if not a or not b or 100 * min(a, b) < percent * max(a, b):
        return False
    small, large = (x, y) if a <= b else (y, x)
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    shared = int(np.count_nonzero(large[at] == small))
    return 100 * shared >= percent * (a + b - shared)


def _set_rows(size: int, signed: bool, bands: int, rows: int):
    """The mapInArrow function that gives each document's set: its digest and signature, or the set itself."""
    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for low, high, data, offsets in chunks(batch.column(1)):
                values, first = shingles(words_of(data, offsets, NON_SPACE), size)
                sets = [np.unique(values[first[d]:first[d + 1]]) for d in range(high - low)]
                counts = np.array([len(s) for s in sets], dtype=np.int64)
                own = ids.slice(low, high - low)
                if not signed:
                    yield pa.RecordBatch.from_arrays([own, pa.array([s.tobytes() for s in sets], pa.binary())], ["id", "set"])
                    continue
                held = np.flatnonzero(counts)
                flat = np.concatenate([np.zeros(0, np.uint64), *(sets[d] for d in held)])
                starts = np.concatenate([[0], np.cumsum(counts[held])])
                sig = circulant_minhash(flat, starts, bands * rows)
                sums = [np.add.reduceat(mix64(flat + np.uint64(c)), starts[:-1]) if len(held) else np.zeros(0, np.uint64) for c in (1, 2)]
                digest, packed = np.zeros((high - low, 2), np.int64), [b""] * (high - low)
                digest[held] = np.stack(sums, axis=1).view(np.int64) if len(held) else digest[held]
                keys, short = band_keys(sig, rows), (sig >> np.uint64(56)).astype(np.uint8)
                for i, d in enumerate(held):
                    packed[d] = keys[i].tobytes() + short[i].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [own, pa.array(counts), pa.array(digest[:, 0]), pa.array(digest[:, 1]), pa.array(packed, pa.binary())],
                    ["id", "n_shingles", "h1", "h2", "sig"])
    return run


def _unpack(bands: int):
    def run(batches):
        for batch in batches:
            n = batch.num_rows
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(n, -1)
            keys = sig[:, :8 * bands].copy().view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(batch.column(0).to_numpy(zero_copy_only=False), bands)), pa.array(keys.ravel())], ["id", "key"])
    return run


# ---------------------------------------------------------------------------
# Links
# ---------------------------------------------------------------------------

def _confirm(percent: int):
    def run(batches):
        for batch in batches:
            pairs = zip(batch.column("set_a"), batch.column("set_b"), strict=True)
            ok = [jaccard_at_least(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent) for x, y in pairs]
            kept = batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))
            if kept.num_rows:
                yield kept
    return run


def _groups(batches, key: str):
    """Runs of rows of one key of a partition sorted by it, as tables."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
        for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            part = batch.slice(low, high - low)
            if held and held[-1].column(key)[0].as_py() != part.column(key)[0].as_py():
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def _open_pairs(table: pa.Table, bands: int, rows: int, percent: int, pass_over: float | None):
    """(i, j) of a group's rows that may still be links: of different components, in the two
    blocks that meet here, first sharing this bucket, not compared as a star, of like sizes."""
    n = table.num_rows
    raw = np.frombuffer(b"".join(table["sig"].to_pylist()), np.uint8).reshape(n, -1)
    keys, short = raw[:, :8 * bands].copy().view(np.int64), raw[:, 8 * bands:]
    own, number, root, size, block = (table[c].to_numpy() for c in ("key", "id", "root", "n_shingles", "block"))
    least, one, two = int(table["center"][0].as_py()), int(table["one"][0].as_py()), int(table["two"][0].as_py())
    p = percent / 100
    cut = 0 if pass_over is None else bands * rows * (p + (1 - p) / 256) - pass_over * np.sqrt(bands * rows * p * (1 - p))
    this = int(np.flatnonzero((keys == own[0]).all(axis=0))[0])
    for i in range(n):
        if block[i] != one:
            continue
        j = np.flatnonzero((block == two) & (root != root[i]) & ((number > number[i]) if one == two else (number != number[i]))
                           & (number != least) & (100 * np.minimum(size, size[i]) >= percent * np.maximum(size, size[i])))
        if number[i] == least or not len(j):
            continue
        j = j[(short[j] == short[i]).sum(axis=1) >= cut]
        if len(j) and this:
            j = j[~(keys[j, :this] == keys[i, :this]).any(axis=1)]
        if len(j):
            yield i, j


def _needed(bands: int, rows: int, percent: int, pass_over: float | None):
    """The rows of each group that ``_open_pairs`` names."""
    def run(batches):
        for table in _groups(batches, "pair"):
            named: set[int] = set()
            for i, j in _open_pairs(table, bands, rows, percent, pass_over):
                named.add(i)
                named.update(j.tolist())
            if named:
                yield from table.take(pa.array(sorted(named))).combine_chunks().to_batches()
    return run


def _compared(bands: int, rows: int, percent: int, pass_over: float | None):
    """Confirmed links (a, b) of each group; once a row is linked with a component, its other pairs
    with that component are not needed."""
    def run(batches):
        for table in _groups(batches, "pair"):
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["set"]]
            number, root = table["id"].to_numpy(), table["root"].to_numpy()
            up: dict[int, int] = {}

            def top(x):
                while x in up:
                    x = up[x]
                return x

            a, b = [], []
            for i, js in _open_pairs(table, bands, rows, percent, pass_over):
                for j in js.tolist():
                    x, y = top(int(root[i])), top(int(root[j]))
                    if x != y and jaccard_at_least(sets[i], sets[j], percent):
                        up[max(x, y)] = min(x, y)
                        a.append(int(min(number[i], number[j])))
                        b.append(int(max(number[i], number[j])))
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80,
                    bands: int = BANDS, rows: int = ROWS, pass_over: float | None = PASS_OVER) -> DataFrame:
    """Per row of ``docs``: id, n_shingles, component_id and kept (id = component_id).

    Words are lower-cased (A-Z) runs of non-space; a document's set holds its distinct runs of
    ``size`` words, or all its words as one run if they are fewer. Documents are linked if
    100 * shared >= percent * union. Ids are whole numbers. ``pass_over`` None compares every pair
    of an open bucket on whole sets.

    Three tables of hashes and ids stay in the shared folder for the result to read; all others are
    removed as soon as they have been used.
    """
    spark = docs.sparkSession
    ship_package(spark)
    bounded_batches(spark)

    def written(df, name, path=None):
        path = path or scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.parquet(path)

    rows_in = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    signed = written(rows_in.mapInArrow(_set_rows(size, True, bands, rows), "id long, n_shingles long, h1 long, h2 long, sig binary"), "signed")
    held = signed.where("n_shingles > 0 AND id IS NOT NULL")
    classes = written(held.groupBy("n_shingles", "h1", "h2").agg(F.min("id").alias("id"), F.min("sig").alias("sig")), "classes")

    path = scratch_path(spark, "roots")
    with scratch_scope(spark):
        found = written(_roots(rows_in, classes, written, size, percent, bands, rows, pass_over), "roots", path)

    # a class reaches what its documents' ids reach
    named = classes.select("n_shingles", "h1", "h2", F.col("id").alias("class"))
    out = (signed.select("id", "n_shingles", "h1", "h2")
           .join(named, ["n_shingles", "h1", "h2"], "left")
           .join(found.select(F.col("id").alias("class"), "root"), "class", "left")
           .withColumn("component_id", F.when(F.col("id").isNotNull(), F.coalesce("root", "class", "id"))))
    return out.select("id", "n_shingles", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


def _roots(rows_in: DataFrame, classes: DataFrame, written, size: int, percent: int, bands: int, rows: int, pass_over: float | None) -> DataFrame:
    """(id, root) of the classes that are linked with others.

    Aggregates by bucket are written before they are joined: both sides of the join are then plain
    shuffles, whose hot keys adaptive execution splits."""
    banded = classes.select("id", "sig").mapInArrow(_unpack(bands), "id long, key long")
    buckets = written(banded.groupBy("key").agg(F.min("id").alias("center"), F.count("*").alias("members")).where("members > 1"), "buckets")
    members = written(banded.join(buckets, "key"), "members")
    stars = members.where("id != center").select(F.col("center").alias("a"), F.col("id").alias("b")).distinct()

    wanted = written(members.select("id").distinct(), "wanted")
    sets = written(only(rows_in, "id", wanted).mapInArrow(_set_rows(size, False, bands, rows), "id long, set binary").distinct(), "sets")
    with_b = stars.join(sets.select(F.col("id").alias("b"), F.col("set").alias("set_b")), "b")
    with_both = with_b.join(sets.select(F.col("id").alias("a"), F.col("set").alias("set_a")), "a")
    found = components(with_both.mapInArrow(_confirm(percent), "a long, b long"))

    rooted = written(members.where("members > 2").join(found, "id", "left").withColumn("root", F.coalesce("root", "id")), "rooted")
    split = written(rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high").select("key"), "split")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    still = (written(rooted.join(split, "key"), "open")
             .join(classes.groupBy("id").agg(F.min("n_shingles").alias("n_shingles"), F.min("sig").alias("sig")), "id")
             .withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
             .withColumn("one", F.least("block", "other")).withColumn("two", F.greatest("block", "other"))
             .withColumn("pair", F.xxhash64("key", "one", "two"))
             .select("pair", "key", "center", "id", "root", "n_shingles", "sig", "block", "one", "two"))
    grouped = still.repartition("pair").sortWithinPartitions("pair", "id")
    needed = written(grouped.mapInArrow(_needed(bands, rows, percent, pass_over), still.schema), "needed")
    compared = (needed.join(sets, "id").repartition("pair").sortWithinPartitions("pair", "id")
                .mapInArrow(_compared(bands, rows, percent, pass_over), "a long, b long"))
    more = written(compared, "links")
    if more.isEmpty():
        return found
    return components(found.select(F.col("id").alias("a"), F.col("root").alias("b")).unionAll(more))
