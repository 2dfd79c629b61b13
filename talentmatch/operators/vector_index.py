"""Exact top-k by cosine over blocks of unit vectors, as matrix products.

The catalogue is cut into blocks of bounded size: by hash, or (``clusters``) by the nearest of some
centroids, big clusters in several blocks. A block is one row: its keys in order, its unit vectors as
one matrix of doubles, its centre and the widest angle between the centre and a member. No member is
nearer to a query than the angle to the centre less that widest angle, which bounds the best cosine
of the whole block.

Every query first meets the block of the best bound. Its k-th cosine so far is a threshold: blocks
whose bound lies below it are skipped, all others are met. So the result is exact, and nothing but
the k best of a block leaves a task.

* A catalogue within ``local_bytes`` (counted first) is broadcast whole; queries are answered row by
  row of Arrow batches, without a shuffle, also on a stream.
* Beyond that only the blocks' centres are broadcast (their number is held to ``broadcast_bytes`` by
  larger blocks). Blocks of neighbouring numbers form groups of about ``GROUP_BYTES``. Queries travel in
  packs to the groups whose blocks they have to meet, first that of the best bound, then the others:
  once for each group, not for each block. A task reads a group's blocks, then the packs one by one.

Cosines that decide are computed anew, row by row in one fixed order, so equal vectors have equal
cosines and ties go to the lower key.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talentmatch.session import ship_package

#: Cosines closer than this may be equal.
SLACK = 1e-9
PACK_ROWS = 1024
#: Vectors that choose the centroids; they decide how much is skipped, never a result.
SAMPLE_ROWS = 20_000
#: Vectors that travel together and that a task holds at a time.
GROUP_BYTES = 32 << 20
#: Blocks are multiplied in slabs of about so many vectors.
SLAB_ROWS = 4096
_PAIRS = 1 << 18
#: Cosines that a product holds at a time.
_PRODUCT = 1 << 20
_BOUNDS = 1 << 21


# ---------------------------------------------------------------------------
# Arrays
# ---------------------------------------------------------------------------

def matrix(column: pa.Array, width: int) -> np.ndarray:
    """(rows, width) doubles of a list column; missing places are 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False).astype(np.float64)).astype(np.int64)
    flat = np.nan_to_num(column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False))
    if (lengths == width).all():
        return flat.reshape(len(lengths), width).copy()
    out = np.zeros((len(lengths), width))
    ends = np.cumsum(lengths)
    for i, (n, end) in enumerate(zip(lengths.tolist(), ends.tolist(), strict=True)):
        out[i, :min(n, width)] = flat[end - n:end - n + min(n, width)]
    return out


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows over their length; a zero row stays zero."""
    length = np.sqrt((x * x).sum(axis=1))
    return x / np.where(length > 0, length, 1)[:, None]


def best_of(q: np.ndarray, u: np.ndarray, k: int, floor: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of q, row of u, cosine) of what can be among the k best of each row of q, those below ``floor`` left out."""
    n, many = len(u), max(1, _PRODUCT // max(1, len(u)))
    if len(q) > many:
        parts = [best_of(q[at:at + many], u, k, None if floor is None else floor[at:at + many]) for at in range(0, len(q), many)]
        return np.concatenate([r + i * many for i, (r, _, _) in enumerate(parts)]), *[np.concatenate([p[j] for p in parts]) for j in (1, 2)]
    rough = q @ u.T
    near = None if floor is None else rough >= (floor - SLACK)[:, None]
    if n > k and (near is None or np.count_nonzero(near) > 8 * k * len(q)):
        kth = rough >= np.partition(rough, n - k, axis=1)[:, n - k, None] - SLACK
        near = kth if near is None else near & kth
    rows, cols = np.divmod(np.arange(len(q) * n), max(n, 1)) if near is None else np.nonzero(near)
    sims = np.empty(len(rows))
    step = max(1, _PAIRS // max(1, q.shape[1]))
    for at in range(0, len(rows), step):
        sims[at:at + step] = (q[rows[at:at + step]] * u[cols[at:at + step]]).sum(axis=1)
    return rows, cols, sims


def leading(rows: np.ndarray, names: np.ndarray, sims: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of each row, best first, ties by name."""
    order = np.lexsort((names, -sims, rows))
    rows = rows[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    kept = place < k
    order = order[kept]
    return rows[kept], names[order], sims[order]


@dataclass
class Centres:
    """What is known of blocks without their vectors."""
    centre: np.ndarray       # unit vectors; a zero row for a block of zero vectors alone
    angle: np.ndarray        # widest angle between the centre and a member; pi if a zero vector is among others

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """(queries, blocks): no member of a block has a higher cosine."""
        apart = np.arccos(np.clip(q @ self.centre.T, -1, 1)) - self.angle
        top = np.cos(np.maximum(apart, 0))
        top[:, ~self.centre.any(axis=1)] = 0
        return top + 1e-7


def centre_of(u: np.ndarray) -> tuple[np.ndarray, float]:
    live = u.any(axis=1)
    if not live.any():
        return np.zeros(u.shape[1]), 0.0
    centre = unit_rows(u[live].mean(axis=0)[None, :])[0]
    if not live.all() or not centre.any():
        return centre if centre.any() else u[live][0], math.pi
    return centre, float(np.arccos(np.clip((u @ centre).min(), -1, 1)))


# ---------------------------------------------------------------------------
# The index
# ---------------------------------------------------------------------------

@dataclass
class JobIndex:
    """The catalogue as blocks (block, ids, vectors, centre, angle), their number and size in bytes."""
    blocks: DataFrame
    n_blocks: int
    bytes: int
    width: int
    centres: Centres | None = None
    held: object = None
    numbers: list = field(default_factory=list)


def scorable(vec: str):
    """Whether a vector can be scored: not null, not empty, all entries finite."""
    finite = F.forall(F.col(vec), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    return F.col(vec).isNotNull() & (F.size(vec) > 0) & finite


def catalogue_size(jobs: DataFrame, vec: str = "embedding") -> tuple[int, int]:
    """(number of scorable jobs, widest vector) in one small aggregate job."""
    row = jobs.where(scorable(vec)).agg(F.count(F.lit(1)).alias("n"), F.max(F.size(vec)).alias("d")).first()
    return int(row["n"]), int(row["d"] or 0)


def centroids_of(jobs: DataFrame, key: str, vec: str, width: int, count: int, sample_rows: int = SAMPLE_ROWS) -> np.ndarray:
    """``count`` unit vectors by a few rounds of spherical k-means on the ``sample_rows`` vectors of least key hash."""
    rows = jobs.where(scorable(vec)).orderBy(F.xxhash64(key)).limit(sample_rows).select(F.col(vec).cast("array<double>").alias("v")).toArrow()
    x = unit_rows(matrix(rows.column("v"), width))
    x = x[x.any(axis=1)]
    if not len(x):
        return np.zeros((1, width))
    rng = np.random.default_rng(7)
    c = x[rng.choice(len(x), min(count, len(x)), replace=False)]
    for _ in range(6):
        near = (x @ c.T).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        c = np.where(sums.any(axis=1)[:, None], unit_rows(sums), c)
    return c


def _assigned(centroids: np.ndarray, width: int):
    def run(batches):
        for batch in batches:
            u = unit_rows(matrix(batch.column("v"), width))
            near = np.where(u.any(axis=1), (u @ centroids.T).argmax(axis=1), len(centroids))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(near.astype(np.int32))], ["id", "v", "cluster"])
    return run


def _packed(width: int):
    """One row a block; members in order of key."""
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                jobs = batch.column("jobs")[i].values
                ids, vectors = jobs.field("id"), unit_rows(matrix(jobs.field("v"), width))
                centre, angle = centre_of(vectors)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("block").slice(i, 1), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                     pa.array([vectors.tobytes()], pa.binary()), pa.array([centre.tobytes()], pa.binary()), pa.array([angle])],
                    ["block", "ids", "vectors", "centre", "angle"])
    return run


def prepare_jobs(jobs: DataFrame, job_key: str = "codigo_vaga", vec: str = "embedding", block_size: int = 4096,
                 clusters: int | None = None, broadcast_bytes: int = 256 << 20) -> JobIndex:
    """The index of ``jobs``. ``clusters`` cuts by so many centroids, which lets searches skip blocks."""
    spark = jobs.sparkSession
    ship_package(spark)
    n, width = catalogue_size(jobs, vec)
    key_type = jobs.schema[job_key].dataType
    schema = T.StructType([T.StructField("block", T.IntegerType()), T.StructField("ids", T.ArrayType(key_type)), T.StructField("vectors", T.BinaryType()),
                           T.StructField("centre", T.BinaryType()), T.StructField("angle", T.DoubleType())])
    if not n:
        return JobIndex(spark.createDataFrame([], schema), 0, 0, 0)
    # centres are broadcast: a larger catalogue gets larger blocks, not more bytes
    block_size = max(block_size, math.ceil(n * (width + 1) * 8 / broadcast_bytes))
    live = jobs.where(scorable(vec)).select(F.col(job_key).alias("id"), F.col(vec).cast("array<double>").alias("v"))
    if clusters:
        near = live.mapInArrow(_assigned(centroids_of(jobs, job_key, vec, width, clusters), width),
                               T.StructType([*live.schema.fields, T.StructField("cluster", T.IntegerType())]))
        sizes = sorted((r["cluster"], r["count"]) for r in near.groupBy("cluster").count().collect())     # a row for each centroid
        parts = [(c, math.ceil(m / block_size)) for c, m in sizes]
        starts = np.concatenate([[0], np.cumsum([p for _, p in parts])]).tolist()
        table = spark.createDataFrame([(c, s, p) for (c, p), s in zip(parts, starts)], "cluster int, first int, parts int")
        dealt = near.join(F.broadcast(table), "cluster").withColumn("block", (F.col("first") + F.pmod(F.xxhash64("id"), F.col("parts"))).cast("int"))
        n_blocks = starts[-1]
    else:
        n_blocks = math.ceil(n / block_size)
        dealt = live.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n_blocks)).cast("int"))
    blocks = (dealt.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("id", "v"))).alias("jobs"))
              .select("block", "jobs").mapInArrow(_packed(width), schema))
    return JobIndex(blocks, n_blocks, n * (width * 8 + 64), width)


# ---------------------------------------------------------------------------
# Blocks that one process holds
# ---------------------------------------------------------------------------

class Catalogue:
    """Blocks of an index, all or a group of them, their vectors one below the other."""

    def __init__(self, ids: list, vectors: list, centres: list, angles: list, width: int):
        self.starts = np.cumsum([0] + [len(i) for i in ids])
        names = pa.concat_arrays(ids)
        order = pc.array_sort_indices(names, null_placement="at_start").to_numpy()
        self.places = np.empty(len(names), dtype=np.int64)       # of each vector: its job's place in ``names``
        self.places[order] = np.arange(len(names))
        self.names = names.take(pa.array(order))
        self.u = np.empty((len(names), width))
        for start, v in zip(self.starts, vectors, strict=False):
            block = np.frombuffer(v, np.float64).reshape(-1, width)
            self.u[start:start + len(block)] = block
        self.centres = Centres(np.array([np.frombuffer(c, np.float64) for c in centres]), np.array(angles))
        slab = self.starts[:-1] // SLAB_ROWS
        self.slabs = np.concatenate([np.flatnonzero(np.diff(slab, prepend=-1)), [len(slab)]])

    def search(self, q: np.ndarray, k: int, floor: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, place of the job in ``names``, cosine) of the k best of each row, and how many blocks each row
        met. With ``floor``, cosines below a row's need not be found."""
        step = max(1, _BOUNDS // len(self.centres.angle))
        parts = [self._search(q[at:at + step], k, None if floor is None else floor[at:at + step]) for at in range(0, len(q), step)]
        rows = np.concatenate([r + i * step for i, (r, *_) in enumerate(parts)])
        return rows, *[np.concatenate([p[j] for p in parts]) for j in (1, 2, 3)]

    def _search(self, q, k, floor):
        bounds = self.centres.bounds(q)
        threshold = np.full(len(q), -np.inf) if floor is None else floor.copy()
        first = bounds.argmax(axis=1)
        first[bounds.max(axis=1) < threshold] = -1
        met = (first >= 0).astype(np.int64)
        found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))

        def keep(more: list) -> None:
            nonlocal found
            found = leading(*[np.concatenate([found[j], *[m[j] for m in more]]) for j in range(3)], k)
            full = found[0][k - 1:] == found[0][:len(found[0]) - k + 1] if len(found[0]) >= k else np.zeros(0, bool)
            last = np.flatnonzero(full) + k - 1
            threshold[found[0][last]] = np.maximum(threshold[found[0][last]], found[2][last])

        def meet(cols, rows: np.ndarray) -> tuple:
            r, c, s = best_of(q[rows], self.u[cols], k, threshold[rows] if np.isfinite(threshold[rows]).any() else None)
            return rows[r], c + cols.start if isinstance(cols, slice) else cols[c], s

        def placed(r, at, s):
            return r, self.places[at], s

        best = [placed(*meet(slice(self.starts[b], self.starts[b + 1]), np.flatnonzero(first == b))) for b in np.unique(first[first >= 0])]
        if best:
            keep(best)
        peaks = np.maximum.reduceat(bounds.max(axis=0), self.slabs[:-1])
        for i in np.argsort(-peaks):
            a, b = self.slabs[i], self.slabs[i + 1]
            open_ = (bounds[:, a:b] >= threshold[:, None]) & (np.arange(a, b) != first[:, None])
            met += open_.sum(axis=1)
            rows, blocks = np.flatnonzero(open_.any(axis=1)), a + np.flatnonzero(open_.any(axis=0))
            if not len(rows):
                continue
            whole = len(blocks) == b - a
            cols = slice(self.starts[a], self.starts[b]) if whole else np.concatenate([np.arange(self.starts[x], self.starts[x + 1]) for x in blocks])
            r, at, s = meet(cols, rows)
            # the block that a row has met already stands in the slab if others have to meet it
            new = (at < self.starts[first[r]]) | (at >= self.starts[first[r] + 1]) | (first[r] < 0)
            keep([placed(r[new], at[new], s[new])])
        return *found, met


def _answered(sent, width: int, k: int, key_type: pa.DataType, job_type: pa.DataType, counted: bool):
    def run(batches):
        names = sent.value.names.cast(job_type)
        for batch in batches:
            for at in range(0, batch.num_rows, PACK_ROWS):
                part = batch.slice(at, PACK_ROWS)
                rows, places, sims, met = sent.value.search(unit_rows(matrix(part.column("v"), width)), k)
                rank = np.arange(len(rows)) - np.searchsorted(rows, rows) + 1
                columns = [part.column("key").take(pa.array(rows)), pa.array(rank.astype(np.int32)), names.take(pa.array(places)), pa.array(sims)]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(met[rows])] * counted, ["key", "rank", "job", "sim"] + ["met"] * counted)
    return run


# ---------------------------------------------------------------------------
# A catalogue of many blocks
# ---------------------------------------------------------------------------

def _first_packs(centres: Centres, width: int, group: np.ndarray, pack_rows: int):
    """Queries in packs by the group of the block of their best bound."""
    step = max(1, _BOUNDS // len(group))

    def run(batches):
        for batch in batches:
            q = unit_rows(matrix(batch.column("v"), width))
            near = group[np.concatenate([np.zeros(0, np.int64)] + [centres.bounds(q[at:at + step]).argmax(axis=1) for at in range(0, len(q), step)])]
            for g in np.unique(near):
                rows = np.flatnonzero(near == g)
                for at in range(0, len(rows), pack_rows):
                    part = rows[at:at + pack_rows]
                    yield _pack(g, batch.column("key"), q, part, np.full(len(part), -np.inf))
    return run


def _further_packs(centres: Centres, width: int, k: int, group: np.ndarray, pack_rows: int):
    """Queries in packs by every other group with a block whose bound reaches their k-th cosine."""
    starts = np.flatnonzero(np.diff(group, prepend=-1))      # blocks of a group stand together
    step = max(1, min(pack_rows, _BOUNDS // len(group)))

    def run(batches):
        for batch in batches:
            q = np.frombuffer(b"".join(batch.column("query").to_pylist()), np.float64).reshape(-1, width)
            floor = np.array([s[k - 1] if len(s) >= k else -np.inf for s in batch.column("sims").to_pylist()])
            own = batch.column("group").to_numpy()
            for lo in range(0, len(q), 16 * step):
                open_ = np.concatenate([np.logical_or.reduceat(centres.bounds(q[at:at + step]) >= floor[at:at + step, None], starts, axis=1)
                                        for at in range(lo, min(lo + 16 * step, len(q)), step)])
                for i, g in enumerate(group[starts]):
                    rows = lo + np.flatnonzero(open_[:, i] & (own[lo:lo + len(open_)] != g))
                    for at in range(0, len(rows), pack_rows):
                        yield _pack(g, batch.column("key"), q, rows[at:at + pack_rows], floor[rows[at:at + pack_rows]])
    return run


def _pack(group: int, keys: pa.Array, q: np.ndarray, rows: np.ndarray, floor: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([group], pa.int32()), pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), keys.take(pa.array(rows))),
               pa.array([q[rows].tobytes()], pa.binary()), pa.array([floor.tobytes()], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["group", "keys", "queries", "floor"])


def _met(width: int, k: int):
    """The k best of a group for each query of a pack, a row for each query. A group's blocks come before its packs."""
    def run(batches):
        current, blocks, held = None, [], None
        for batch in batches:
            column = batch.column
            groups, shards, kinds = (column(c).to_numpy() for c in ("group", "shard", "kind"))
            for i in range(batch.num_rows):
                if (groups[i], shards[i]) != current:
                    current, blocks, held = (groups[i], shards[i]), [], None
                if kinds[i] == 0:
                    blocks.append((column("ids")[i].values, column("vectors")[i].as_buffer(), column("centre")[i].as_py(), column("angle")[i].as_py()))
                    continue
                if held is None:
                    held, blocks = Catalogue(*zip(*blocks, strict=True), width), []
                q = np.frombuffer(column("queries")[i].as_buffer(), np.float64).reshape(-1, width)
                rows, places, sims, met = held.search(q, k, np.frombuffer(column("floor")[i].as_buffer(), np.float64))
                offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(q)))]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(q), groups[i], np.int32)), column("keys")[i].values,
                     pa.FixedSizeBinaryArray.from_buffers(pa.binary(8 * width), len(q), [None, pa.py_buffer(q.tobytes())]).cast(pa.binary()),
                     pa.ListArray.from_arrays(offsets, held.names.take(pa.array(places))), pa.ListArray.from_arrays(offsets, pa.array(sims)), pa.array(met)],
                    ["group", "key", "query", "jobs", "sims", "met"])
    return run


def _centres(index: JobIndex, blocks: DataFrame) -> None:
    """Collects the blocks' centres: as many rows as blocks, held to a bound by ``prepare_jobs``."""
    if index.centres is None:
        rows = sorted(blocks.select("block", "centre", "angle").collect(), key=lambda r: r["block"])
        index.numbers = [r["block"] for r in rows]
        index.centres = Centres(np.array([np.frombuffer(r["centre"], np.float64) for r in rows]), np.array([r["angle"] for r in rows]))


def _whole(index: JobIndex) -> Catalogue:
    """All blocks of an index in this process."""
    rows = index.blocks.toArrow()
    return Catalogue([x.values for x in rows.column("ids")], [x.as_buffer() for x in rows.column("vectors")], rows.column("centre").to_pylist(),
                     rows.column("angle").to_pylist(), index.width)


def search(candidates: DataFrame, index: JobIndex, k: int, cand_key: str, job_key: str, job_type: T.DataType, vec: str = "embedding",
           local_bytes: int = 64 << 20, pack_rows: int = PACK_ROWS, written=None, met: str | None = None) -> DataFrame:
    """(cand_key, rank, job_key, sim): the k best of each scorable candidate.

    ``written`` writes a table and reads it back (needed beyond ``local_bytes``: the blocks and the first
    round are used several times). ``met`` names a further column: how many blocks the candidate met.
    """
    spark = candidates.sparkSession
    ship_package(spark)
    from pyspark.sql.pandas.types import to_arrow_type
    key_type = candidates.schema[cand_key].dataType
    asked = candidates.where(scorable(vec)).select(F.col(cand_key).alias("key"), F.col(vec).cast("array<double>").alias("v"))
    ranked = T.StructType([T.StructField(cand_key, key_type), T.StructField("rank", T.IntegerType()), T.StructField(job_key, job_type),
                           T.StructField("sim", T.DoubleType())] + ([T.StructField(met, T.LongType())] if met else []))
    if not index.n_blocks:
        return asked.where("false").select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in ranked])
    if index.bytes <= local_bytes:
        if index.held is None:
            index.held = spark.sparkContext.broadcast(_whole(index))
        inside = T.StructType([T.StructField(n, f.dataType) for n, f in zip(["key", "rank", "job", "sim", "met"], ranked)])
        found = asked.mapInArrow(_answered(index.held, index.width, k, to_arrow_type(key_type), to_arrow_type(job_type), bool(met)), inside)
        return found.toDF(*ranked.names)

    if met:     # blocks are counted for each candidate, also where keys repeat
        asked = asked.select(F.struct(F.monotonically_increasing_id().alias("row"), "key").alias("key"), "v")
        key_type = asked.schema["key"].dataType
    # every block is used once for each round and for the centres
    blocks = written(index.blocks, "blocks")
    _centres(index, blocks)
    in_group = max(1, GROUP_BYTES * index.n_blocks // index.bytes)
    group = np.array(index.numbers) // in_group
    # a group goes to several tasks, each of which meets a part of its packs
    tasks = 2 * spark.sparkContext.defaultParallelism
    shards = -(-2 * tasks // len(np.unique(group)))
    packs = T.StructType([T.StructField("group", T.IntegerType()), T.StructField("keys", T.ArrayType(key_type)), T.StructField("queries", T.BinaryType()),
                          T.StructField("floor", T.BinaryType())])
    round_ = T.StructType([T.StructField("group", T.IntegerType()), T.StructField("key", key_type), T.StructField("query", T.BinaryType()),
                           T.StructField("jobs", T.ArrayType(job_type)), T.StructField("sims", T.ArrayType(T.DoubleType())), T.StructField("met", T.LongType())])
    stored = blocks.select(F.floor(F.col("block") / in_group).cast("int").alias("group"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
                                 F.lit(0).alias("kind"), "block", "ids", "vectors", "centre", "angle")

    def answered(sent: DataFrame) -> DataFrame:
        sent = sent.withColumn("shard", F.pmod(F.xxhash64("keys", "queries"), F.lit(shards)).cast("int")).withColumn("kind", F.lit(1))
        dealt = stored.unionByName(sent, allowMissingColumns=True).repartition(tasks, "group", "shard")
        return dealt.sortWithinPartitions("group", "shard", "kind", "block").mapInArrow(_met(index.width, k), round_)

    first = written(answered(asked.mapInArrow(_first_packs(index.centres, index.width, group, pack_rows), packs)), "first-round")
    further = answered(first.select("group", "key", "query", "sims").mapInArrow(_further_packs(index.centres, index.width, k, group, pack_rows), packs))
    each = first.select("key", "jobs", "sims", "met").unionAll(further.select("key", "jobs", "sims", "met"))
    found = F.arrays_zip("jobs", "sims")
    if met:     # a group where a query finds nothing has been met as well
        each = each.select("key", "met", F.posexplode_outer(found).alias("at", "x"))
        counted = F.sum(F.when(F.coalesce("at", F.lit(0)) == 0, F.col("met"))).over(Window.partitionBy("key"))
        each = each.withColumn("met", counted).where(F.col("x").isNotNull())
    else:
        each = each.select("key", F.explode(found).alias("x"))
    each = each.select("key", F.col("x.jobs").alias("job"), F.col("x.sims").alias("sim"), *["met"] * bool(met))
    order = Window.partitionBy("key").orderBy(F.desc("sim"), "job")
    top = each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= int(k))
    return top.select(F.col("key.key" if met else "key").alias(cand_key), F.col("rank").cast("int").alias("rank"), F.col("job").alias(job_key), "sim",
                      *([F.col("met").alias(met)] if met else []))
