"""Document fingerprints by Order MinHash, sensitive to edit distance.

A text's k-mers (runs of k code points) are numbered by occurrence, so a repeated k-mer counts as
often as it stands there. For each coordinate a hash picks the two least numbered k-mers; they are
put back into their order in the text and hashed as a pair. Two texts agree in a coordinate if they
share the k-mers and their order, so moving text lowers the likeness as replacing it does.

``compare_edited`` sets each document against an edited copy, whose tail is taken from the next
document by id, and against that next document. Documents are dealt out by ranges of ids; within a
range each meets its successor as the rows stream by, and only the ends of the ranges are joined.

Defined results: a null text is empty; all empty texts share one fingerprint; a text shorter than k
is one k-mer; rows that repeat an id stand next to each other by hash of their text; null ids come
first; a single document is its own successor; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talentmatch.llm.words import mix64
from talentmatch.session import scratch_path, ship_package

KMER, COORDINATES = 6, 64
_TILE = 4096
_POSITION_BITS = 22
_OCCURRENCE = np.uint64(0xA24BAED4963EE407)
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: A random value for each code point of the first plane.
_VALUES = mix64(np.arange(1 << 16, dtype=np.uint64))
_FACTORS = (mix64(np.arange(1, 4097, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_OFFSETS = (mix64(np.arange(5001, 9097, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def kmers(points: np.ndarray, k: int = KMER) -> np.ndarray:
    """Hashes of the k-mers, by place; of all the text, if it is shorter."""
    n = len(points)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    size = min(k, n)
    values = _VALUES.take(points, mode="clip")
    beyond = points >= len(_VALUES)
    if beyond.any():
        values[beyond] = mix64(points[beyond].astype(np.uint64))
    # Horner's rule over the k columns: the same for every place
    out = values[:n + 1 - size] + np.uint64(size)
    for j in range(1, size):
        out *= _BASE
        out += values[j:n + 1 - size + j]
    out ^= out >> np.uint64(32)
    out *= _BASE
    out ^= out >> np.uint64(29)
    return out


def numbered(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, hash): every k-mer's place and the hash of it and of its number among its equals.

    Equals are told by the hash's upper bits, which leave room for the place in one sorted word."""
    n = len(h)
    if n < 1 << _POSITION_BITS:
        low = np.uint64((1 << _POSITION_BITS) - 1)
        key = np.sort((h & ~low) | np.arange(n, dtype=np.uint64))
        place, group = (key & low).astype(np.int64), key >> np.uint64(_POSITION_BITS)
    else:
        group = h >> np.uint64(_POSITION_BITS)
        place = np.argsort(group, kind="stable")
        group = group[place]
    value = h[place]
    again = np.flatnonzero(group[1:] == group[:-1]) + 1
    if len(again):
        # a run of equals is numbered by its distance from the place before the run's second
        run = np.flatnonzero(np.concatenate([[True], again[1:] != again[:-1] + 1]))
        first = np.repeat(again[run], np.diff(np.append(run, len(again))))
        value[again] += (again - first + 1).astype(np.uint64) * _OCCURRENCE
    return place, mix64(value)


def fingerprint(points: np.ndarray, k: int = KMER, coordinates: int = COORDINATES) -> np.ndarray:
    """The coordinates (uint16) of a text given by its code points."""
    h = kmers(points, k)
    if not len(h):
        return np.zeros(coordinates, dtype=np.uint16)
    place, value = numbered(h)
    x = (value >> np.uint64(32)).astype(np.uint32)
    a, b = _FACTORS[:coordinates, None], _OFFSETS[:coordinates, None]
    rows = np.arange(coordinates)
    best, at = np.full((coordinates, 0), 0, dtype=np.uint32), np.full((coordinates, 0), 0, dtype=np.int64)
    for low in range(0, len(x), _TILE):
        tile = x[None, low:low + _TILE] * a
        tile += b
        one = tile.argmin(axis=1)
        least = tile[rows, one]
        values, places = [best, least[:, None]], [at, one[:, None] + low]
        if tile.shape[1] > 1:
            tile[rows, one] = np.uint32(0xFFFFFFFF)
            two = tile.argmin(axis=1)
            values.append(tile[rows, two][:, None])
            places.append(two[:, None] + low)
        best, at = np.concatenate(values, axis=1), np.concatenate(places, axis=1)
        if best.shape[1] > 2:
            order = np.argsort(best, axis=1, kind="stable")[:, :2]
            best, at = np.take_along_axis(best, order, 1), np.take_along_axis(at, order, 1)
    chosen = h[np.sort(place[at], axis=1)]
    out = chosen[:, 0]
    if chosen.shape[1] > 1:
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + chosen[:, 1])
    return (mix64(out) >> np.uint64(48)).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = KMER, coordinates: int = COORDINATES) -> DataFrame:
    """Per row: id and fingerprint (hex)."""
    ship_package(docs.sparkSession)
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("fingerprint", T.StringType())])

    def run(batches):
        for batch in batches:
            prints = [fingerprint(code_points(x.as_py() or ""), k, coordinates).tobytes().hex() for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.string())], ["id", "fingerprint"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


# ---------------------------------------------------------------------------
# Against edited copies
# ---------------------------------------------------------------------------

def edited(text: str, following: str) -> str:
    """The last half of the text (rounded down) replaced by as much of the following one's start."""
    cut = len(text) // 2
    return text[:len(text) - cut] + following[:cut]


def _fields(id_type) -> T.StructType:
    return T.StructType([
        T.StructField("id", id_type), T.StructField("n_chars", T.LongType()), T.StructField("edited_sha256", T.BinaryType()),
        T.StructField("fingerprint", T.BinaryType()), T.StructField("edited_fingerprint", T.BinaryType()),
        T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType())])


def _against(text: str, own: np.ndarray, following: str, other: np.ndarray, k: int, coordinates: int) -> tuple:
    new = edited(text, following)
    changed = own if new == text else fingerprint(code_points(new), k, coordinates)
    return (len(text), hashlib.sha256(new.encode("utf-8", "surrogatepass")).digest(), own.tobytes(), changed.tobytes(),
            likeness(own, changed), likeness(own, other))


def _columns(rows: list[tuple]) -> list[pa.Array]:
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]
    return [pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)]


def compare_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = KMER, coordinates: int = COORDINATES) -> DataFrame:
    """Per row: id, n_chars, edited_sha256, fingerprint and edited_fingerprint (hex), near_edited and near_next."""
    spark = docs.sparkSession
    ship_package(spark)
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([*_fields(id_type).fields, T.StructField("part", T.IntegerType()), T.StructField("end", T.StringType()),
                           T.StructField("text", T.StringType())])

    def pack(batches):
        """Texts go through the shuffle compressed one by one; it costs less than half the disk."""
        codec = pa.Codec("zstd", compression_level=1)
        for batch in batches:
            texts = [x.as_buffer() for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([x.size for x in texts], pa.int64()),
                 pa.array([codec.compress(x, asbytes=True) for x in texts], pa.binary())], ["id", "h", "bytes", "packed"])

    def stream(batches):
        """Complete rows; besides, the first row's text and the last row's, which await a neighbour."""
        part, before, id_arrow, codec = TaskContext.get().partitionId(), None, None, pa.Codec("zstd")

        def out(ids, rows, end=None, texts=None):
            n = len(rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, id_arrow), *_columns(rows), pa.array([part] * n, pa.int32()), pa.array([end] * n, pa.string()),
                 pa.array(texts or [None] * n, pa.string())], schema.names)

        for batch in batches:
            id_arrow = batch.schema.field(0).type
            ids, rows = [], []
            for i, n, x in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2), strict=True):
                text = codec.decompress(x.as_buffer(), n, asbytes=True).decode("utf-8")
                own = fingerprint(code_points(text), k, coordinates)
                if before is None:
                    yield out([i.as_py()], [(len(text), None, own.tobytes(), None, None, None)], "first", [text])
                else:
                    ids.append(before[0])
                    rows.append(_against(before[1], before[2], text, own, k, coordinates))
                before = (i.as_py(), text, own)
            if rows:
                yield out(ids, rows)
        if before is not None:
            yield out([before[0]], [(len(before[1]), None, before[2].tobytes(), None, None, None)], "last", [before[1]])

    def finish(batches):
        for batch in batches:
            col = {c: batch.column(c).to_pylist() for c in ("text", "fingerprint", "next_text", "next_fingerprint")}
            rows = [_against(t, np.frombuffer(f, np.uint16), n, np.frombuffer(g, np.uint16), k, coordinates) for t, f, n, g in zip(*col.values(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *_columns(rows)], _fields(id_type).names)

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text")).withColumn("h", F.xxhash64("text"))
    path = scratch_path(spark, "fingerprints")
    packed = rows.mapInArrow(pack, T.StructType([T.StructField("id", id_type), T.StructField("h", T.LongType()),
                                                 T.StructField("bytes", T.LongType()), T.StructField("packed", T.BinaryType())]))
    (packed.repartitionByRange("id", "h").sortWithinPartitions("id", "h").select("id", "bytes", "packed")
     .mapInArrow(stream, schema).write.parquet(path))
    made = spark.read.parquet(path)

    first = made.where("end = 'first'").select("part", F.col("text").alias("next_text"), F.col("fingerprint").alias("next_fingerprint"))
    # one row a range: which range follows which, the first after the last
    order = W.orderBy("part")
    ranges = first.select("part")
    following = ranges.select(F.col("part").alias("own"), F.lead("part").over(order).alias("part"))
    start = ranges.agg(F.min("part").alias("start"))
    following = following.join(F.broadcast(start)).select("own", F.coalesce("part", "start").alias("part"))
    last = made.where("end = 'last'").select("id", "text", "fingerprint", F.col("part").alias("own"))
    ends = last.join(following, "own").join(first, "part").select("id", "text", "fingerprint", "next_text", "next_fingerprint")
    complete = made.where("end IS NULL").select(*_fields(id_type).names)
    whole = complete.unionByName(ends.mapInArrow(finish, _fields(id_type)))
    for c in ("edited_sha256", "fingerprint", "edited_fingerprint"):
        whole = whole.withColumn(c, F.lower(F.hex(c)))
    return whole
