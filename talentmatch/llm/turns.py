"""Conversations as blocks of consecutive turns, each in order of turn.

The rows are dealt out by ranges of (conversation, turn, role, text), so a conversation with a third
of all rows spreads over many tasks; repeated rows are told apart by their place in the input. As a
range streams by, its turns are cut into blocks of bounded size, one row each. A conversation that
lies within one block is ``whole``; only the others ever need a second look across blocks.

Defined order: by conversation and turn, nulls first; rows of equal turn by role, then by the first
64 characters of the text, then by its hash.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talentmatch.session import scratch_path, ship_package

#: A block ends at so many turns, or characters of text (a longer text is a block of its own).
BLOCK_TURNS, BLOCK_CHARS = 1024, 1 << 18
SCHEMA = "conv_id long, seq long, whole boolean, turns array<long>, roles array<string>, texts array<string>"
_ARROW = pa.schema([("conv_id", pa.int64()), ("seq", pa.int64()), ("whole", pa.bool_()), ("turns", pa.list_(pa.int64())),
                    ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))])
_NONE = object()


def rows_of(batch: pa.RecordBatch, size: int = 500):
    """The rows of a batch as tuples; few are objects at a time."""
    for at in range(0, batch.num_rows, size):
        yield from zip(*(c.to_pylist() for c in batch.slice(at, size).columns), strict=True)


def record_batches(rows, schema: pa.Schema, size: int = 64):
    """Arrow batches of an iterator of tuples."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema, strict=True)], schema=schema)


def _packed(block_turns: int, block_chars: int):
    def cut(batches):
        place = TaskContext.get().partitionId() << 32
        conv, held, chars, made, opening = _NONE, [], 0, 0, True
        known = 0     # blocks of this conversation so far

        def block(ends: bool):
            nonlocal held, chars, made, known
            whole = ends and not known and not opening
            row = (conv, place + made, whole, [r[0] for r in held], [r[1] for r in held], [r[2] for r in held])
            held, chars, made, known = [], 0, made + 1, known + 1
            return row

        for batch in batches:
            for conv_id, turn, role, text, copies in rows_of(batch):
                if conv is _NONE or conv_id != conv:
                    if conv is not _NONE:
                        if held or not known:
                            yield block(True)
                        opening = False
                    conv, known = conv_id, 0
                for _ in range(copies):
                    if held and (len(held) >= block_turns or chars + len(text) > block_chars):
                        yield block(False)
                    held.append((turn, role, text))
                    chars += len(text)
        if conv is not _NONE and (held or not known):
            yield block(False)

    def run(batches):
        yield from record_batches(cut(batches), _ARROW)
    return run


def blocks(rows: DataFrame, block_turns: int = BLOCK_TURNS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The blocks of ``rows`` (conv_id long, turn long, role string, text string, copies int; role and
    text never null), written to the shared folder. ``copies`` is how often a row stands there; a
    conversation whose rows have none is one empty block. ``seq`` grows in the order of turns."""
    spark = rows.sparkSession
    ship_package(spark)
    keyed = rows.select("conv_id", "turn", "role", "text", "copies", F.left("text", F.lit(64)).alias("lead"),
                        F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("place"))
    order = ["conv_id", "turn", "role", "lead", "h", "place"]
    dealt = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", "copies")
    path = scratch_path(spark, "turns")
    dealt.mapInArrow(_packed(block_turns, block_chars), SCHEMA).write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)
