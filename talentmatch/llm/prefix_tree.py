"""Chat formatting as prefix trees: conversations that start alike share the tokens of their start.

Template: a turn reads ``### role: text</turn>`` and a line end. Within role and text a backslash
is doubled, ``</turn>`` becomes ``<\\/turn>`` and a third ``#`` in a row gets a backslash (in roles a
colon as well), so no text can open or close a turn, and a backslash simply guards the next
character on the way back.

1. Turns are put in order (``turns``) and made into tokens: code points, or the ids of a public
   vocabulary file. Each turn has a hash of all turns up to it, composed block by block, so a
   conversation of any length is hashed in parallel. Equal hashes are one node of a tree.
2. Of the conversations through a node the longest (then the first) owns it. The nodes that a
   conversation owns are then the end of its path, its *branch*, and its path names the branches
   before it. Depth first order follows from the path: branches off a branch come after it, those
   from deeper nodes first. Places in a tree are running sums over that order, by ranges.
3. Each branch is emitted once, in pieces of whole turns: tokens, place in the tree, position id of
   its first token, intervals of the tree that it may attend to (its ancestors', and its own pieces
   before), and the token intervals under the loss mask (texts of role ``assistant``).

A node with a third of all conversations is combined before the shuffle; joins on it are left to
adaptive execution, which splits them. What is kept per conversation is a list of the branches on
its path. Choosing the longest conversation as owner keeps it short: a chat logged after each turn
adds no branch at all.

Defined results: rows of equal turn are ordered as in ``turns``; null roles and texts are empty; a
null id is a conversation; one that equals another, or starts it, is a branch without tokens;
an empty table gives no rows; only the four named columns are read; texts are taken whole.
"""

from __future__ import annotations

import functools
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark import TaskContext

from talentmatch.llm import turns as TU
from talentmatch.session import scratch_path, ship_package

_END = "</turn>\n"
_LEARNED = "assistant"
_MOD, _FACTOR = (1 << 127) - 1, 0x5851F42D4C957F2D14057B7EF767814F
_GUARDED = re.compile(r"\\(.)", re.S)
_HEAD = re.compile(r"### ((?:[^\\:]|\\.)*): ", re.S)


# ---------------------------------------------------------------------------
# Template and tokens
# ---------------------------------------------------------------------------

def escape(text: str) -> str:
    if "\\" in text:
        text = text.replace("\\", "\\\\")
    if "</turn>" in text:
        text = text.replace("</turn>", "<\\/turn>")
    return re.sub("##(?=#)", r"##\\", text) if "###" in text else text


def unescape(text: str) -> str:
    return _GUARDED.sub(r"\1", text) if "\\" in text else text


def parts(role: str, text: str) -> tuple[str, str, str]:
    """A turn's head, text and end."""
    return f"### {escape(role).replace(':', chr(92) + ':')}: ", escape(text), _END


def turns_in(formatted: str):
    """The (role, text) of formatted turns."""
    at = 0
    while at < len(formatted):
        head = _HEAD.match(formatted, at)
        end = formatted.index(_END, head.end())
        yield unescape(head[1]), unescape(formatted[head.end():end])
        at = end + len(_END)


#: Tokens are 32-bit integers, four bytes each, the lowest first.
WIDTH = 4


class CodePoints:
    """A token is a code point."""

    @staticmethod
    def encode(text: str) -> bytes:
        return text.encode("utf-32-le")

    @staticmethod
    def decode(ids: bytes) -> str:
        return ids.decode("utf-32-le")


class Subwords:
    """Tokens of a public vocabulary file that gives texts back exactly (byte-level)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.inner = Tokenizer.from_file(path)
        self.inner.encode_special_tokens = True

    def encode(self, text: str) -> bytes:
        return np.array(self.inner.encode(text, add_special_tokens=False).ids, "<i4").tobytes()

    def decode(self, ids: bytes) -> str:
        return self.inner.decode(np.frombuffer(ids, "<i4").tolist(), skip_special_tokens=False)


@functools.lru_cache(maxsize=4)
def codec(tokenizer: str | None):
    return Subwords(tokenizer) if tokenizer else CodePoints()


# ---------------------------------------------------------------------------
# Tokens and hashes of paths
# ---------------------------------------------------------------------------

_SPAN = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
SPANS = "array<struct<start:int,end:int>>"
_ENCODED = pa.schema([("conv_id", pa.int64()), ("seq", pa.int64()), ("whole", pa.bool_()), ("digests", pa.binary()),
                      ("sizes", pa.list_(pa.int32())), ("tokens", pa.binary()), ("loss", _SPAN)])
ENCODED = f"conv_id long, seq long, whole boolean, digests binary, sizes array<int>, tokens binary, loss {SPANS}"


def _digest(role: str, text: str) -> bytes:
    made = int.from_bytes(hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16], "big")
    return (made % _MOD).to_bytes(16, "big")


def _encoded(tokenizer: str | None):
    def rows(batch):
        own = codec(tokenizer)
        for conv_id, seq, whole, roles, texts in TU.rows_of(batch, 20):
            digests, sizes, pieces, loss, at = [], [], [], [], 0
            for role, text in zip(roles, texts, strict=True):
                made = [own.encode(p) for p in parts(role, text)]
                head, body, end = (len(m) // WIDTH for m in made)
                if role == _LEARNED:
                    loss.append({"start": at + head, "end": at + head + body})
                sizes.append(head + body + end)
                at += sizes[-1]
                pieces += made
                digests.append(_digest(role, text))
            yield conv_id, seq, whole, b"".join(digests), sizes, b"".join(pieces), loss

    def run(batches):
        for batch in batches:
            yield from TU.record_batches(rows(batch), _ENCODED)
    return run


def _path_hashes(digests: bytes, before: int) -> list[int]:
    out = []
    for i in range(0, len(digests), 16):
        before = (before * _FACTOR + int.from_bytes(digests[i:i + 16], "big")) % _MOD
        out.append(before)
    return out


_PLACED = pa.schema([("seq", pa.int64()), ("head", pa.int64()), ("depth", pa.int64()), ("position", pa.int64()), ("before", pa.binary()), ("tree", pa.binary())])
PLACED = "seq long, head long, depth long, position long, before binary, tree binary"


def _placed(batches):
    """Blocks of whole conversations in order: what lies before each (turns, tokens, hash)."""
    def rows():
        conv, head, depth, position, before, tree = TU._NONE, 0, 0, 0, 0, b""
        for batch in batches:
            for conv_id, seq, digests, size in TU.rows_of(batch):
                if conv is TU._NONE or conv_id != conv:
                    conv, head, depth, position, before, tree = conv_id, seq, 0, 0, 0, digests[:16]
                yield seq, head, depth, position, before.to_bytes(16, "big"), tree
                for h in _path_hashes(digests, before)[-1:]:
                    before = h
                depth += len(digests) // 16
                position += size
    yield from TU.record_batches(rows(), _PLACED, 1024)


_NODES = pa.schema([("node", pa.binary()), ("head", pa.int64()), ("length", pa.int64()), ("depth", pa.int64()), ("size", pa.int32())])
NODES = "node binary, head long, length long, depth long, size int"


def _nodes(batches):
    def rows(batch):
        for head, length, depth, before, digests, sizes in TU.rows_of(batch):
            for i, (h, size) in enumerate(zip(_path_hashes(digests, int.from_bytes(before, "big")), sizes, strict=True)):
                yield h.to_bytes(16, "big"), head, length, depth + i + 1, size
    for batch in batches:
        yield from TU.record_batches(rows(batch), _NODES, 4096)


# ---------------------------------------------------------------------------
# Places in the trees
# ---------------------------------------------------------------------------

_RUNNING = pa.schema([("head", pa.int64()), ("tree", pa.int64()), ("part", pa.int32()), ("size", pa.int64()), ("local", pa.int64())])
RUNNING = "head long, tree long, part int, size long, local long"


def _running(batches):
    """Running sums of the tokens of a tree's branches within a range."""
    part, tree, total = TaskContext.get().partitionId(), TU._NONE, 0

    def rows():
        nonlocal tree, total
        for batch in batches:
            for head, own, size in TU.rows_of(batch):
                if own != tree:
                    tree, total = own, 0
                yield head, own, part, size, total
                total += size
    yield from TU.record_batches(rows(), _RUNNING, 4096)


_INTERVALS = pa.list_(pa.struct([("branch", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("position", pa.int64())]))
INTERVALS = "array<struct<branch:bigint,start:bigint,end:bigint,position:bigint>>"
_PACKED = pa.schema([("tree", pa.int64()), ("branch", pa.int64()), ("conv_id", pa.int64()), ("piece", pa.int64()), ("first", pa.bool_()), ("whole", pa.bool_()),
                     ("start", pa.int64()), ("position", pa.int64()), ("tokens", pa.binary()), ("loss", _SPAN), ("ancestors", _INTERVALS)])
PACKED = (f"tree long, branch long, conv_id long, piece long, first boolean, whole boolean, start long, position long, tokens binary, loss {SPANS}, "
          f"ancestors {INTERVALS}")


def _emitted(batches):
    """The pieces of each conversation's branch: its turns beyond those of the branches before."""
    def rows(batch):
        for conv_id, seq, whole, head, depth, position, sizes, tokens, loss, tree, start, owned_from, at, ancestors in TU.rows_of(batch, 20):
            skip = min(len(sizes), max(0, (owned_from or 0) - depth))
            if skip == len(sizes) and depth:
                continue
            cut = sum(sizes[:skip])
            first_token, own = position + cut, b"" if skip == len(sizes) else tokens[WIDTH * cut:]
            spans = [{"start": s["start"] - cut, "end": s["end"] - cut} for s in loss if s["start"] >= cut] if own else []
            begins, comes = start or 0, at or 0      # of the whole branch: place in the tree, position id
            attends = list(ancestors or ())
            if first_token > comes and own:
                attends.append({"branch": head, "start": begins, "end": begins + first_token - comes, "position": comes})
            yield (head if tree is None else tree, head, conv_id, seq, depth == 0, whole, begins + max(0, first_token - comes),
                   max(first_token, comes), own, spans, attends)

    for batch in batches:
        yield from TU.record_batches(rows(batch), _PACKED)


def token_ids(tokens: bytes) -> np.ndarray:
    """The integers of a ``tokens`` cell."""
    return np.frombuffer(tokens, "<i4")


def prefix_trees(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                 tokenizer: str | None = None, **sizes) -> DataFrame:
    """The packed branches, written to the shared folder, a row per piece:

    tree, branch (numbers of conversations), conv_id, piece (in order of turns), first (of its
    conversation), whole (the only piece), start (of its first token in the tree's depth first
    sequence), position (position id of its first token, those after it count on), tokens (four bytes
    each; see ``token_ids``), loss
    (intervals of ``tokens``) and ancestors (intervals of the tree that its tokens attend to besides
    those before them in the piece; each with the branch it lies in and its first position id).

    ``tokenizer`` is the path of a byte-level vocabulary file that all executors can read; without
    one, tokens are code points.
    """
    spark = rows.sparkSession
    ship_package(spark)

    def written(df, name):
        path = scratch_path(spark, name)
        df.write.option("compression", "zstd").parquet(path)
        return spark.read.parquet(path)

    clean = rows.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.lit(1).alias("copies"))
    blocks = TU.blocks(clean, **sizes).select("conv_id", "seq", "whole", "roles", "texts")
    encoded = written(blocks.mapInArrow(_encoded(tokenizer), ENCODED), "encoded")

    # what lies before each block: nothing, if its conversation is whole
    total = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)
    cut = encoded.where("NOT whole").select("conv_id", "seq", "digests", total.alias("size"))
    placed = written(cut.repartition("conv_id").sortWithinPartitions("conv_id", "seq").mapInArrow(_placed, PLACED), "placed")
    lengths = (encoded.where("NOT whole").select("seq", F.size("sizes").alias("n")).join(placed.select("seq", "head"), "seq")
               .groupBy("head").agg(F.sum("n").alias("length")))
    zero = F.lit(0).cast("long")
    alone = encoded.where("whole").select(
        "seq", F.col("seq").alias("head"), zero.alias("depth"), zero.alias("position"), F.lit(bytes(16)).alias("before"),
        F.substring("digests", 1, 16).alias("tree"), F.size("sizes").cast("long").alias("length"), "digests", "sizes")
    many = (encoded.where("NOT whole").select("seq", "digests", "sizes").join(placed, "seq").join(lengths, "head")
            .select(*alone.columns))
    paths = alone.unionAll(many)

    # nodes of conversations whose first turn is another's as well
    shared = written(paths.where("depth = 0").groupBy("tree").count().where("count > 1").select("tree"), "shared")
    nodes = written(paths.join(shared, "tree", "left_semi").select("head", "length", "depth", "before", "digests", "sizes").mapInArrow(_nodes, NODES), "nodes")
    owners = written(nodes.groupBy("node").agg(F.count("*").alias("n"), F.min(F.struct(-F.col("length"), "head")).alias("o"))
                     .where("n > 1").select("node", F.col("o.head").alias("owner")), "owners")
    steps = (nodes.join(owners, "node", "left").withColumn("owner", F.coalesce("owner", "head")).groupBy("head", "owner")
             .agg(F.min("depth").alias("low"), F.max("depth").alias("high"), F.sum("size").alias("size")))
    path = steps.groupBy("head").agg(F.sort_array(F.collect_list(F.struct("low", "high", "owner", "size"))).alias("path"))
    before = F.filter("path", lambda s: s["owner"] != F.col("head"))
    branches = path.select(
        "head", F.get("path", F.lit(0))["owner"].alias("tree"), before.alias("before"),
        F.coalesce(F.get(F.filter("path", lambda s: s["owner"] == F.col("head")), F.lit(0))["size"], zero).alias("size")).select(
        "head", "tree", "before", "size",
        # one step for each branching: deeper ones first, then by number
        F.transform("before", lambda s, i: F.struct((-s["high"]).alias("from"), F.coalesce(F.try_element_at("before", i + 2)["owner"], F.col("head")).alias("to"))).alias("order"),
        F.aggregate("before", zero, lambda a, s: a + s["size"]).alias("at"),
        F.coalesce(F.try_element_at("before", F.lit(-1))["high"], zero).alias("owned_from"))
    branches = written(branches, "branches")
    running = written(branches.select("tree", "order", "head", "size").repartitionByRange("tree", "order").sortWithinPartitions("tree", "order")
                      .select("head", "tree", "size").mapInArrow(_running, RUNNING), "running")
    # a tree has one row for each range that it reaches into
    upto = W.partitionBy("tree").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = running.groupBy("tree", "part").agg(F.sum("size").alias("n")).select("tree", "part", F.coalesce(F.sum("n").over(upto), zero).alias("offset"))
    starts = written(running.join(offsets, ["tree", "part"]).select("head", (F.col("local") + F.col("offset")).alias("start")), "starts")

    asked = branches.select("head", F.posexplode("before").alias("i", "s")).select("head", "i", F.col("s.owner").alias("owner"), F.col("s.size").alias("size"))
    found = (asked.join(starts.withColumnRenamed("head", "owner"), "owner").groupBy("head")
             .agg(F.sort_array(F.collect_list(F.struct("i", "owner", "start", "size"))).alias("found")))
    upto_i = lambda i: F.aggregate(F.slice("found", 1, i), zero, lambda a, s: a + s["size"])
    ancestors = F.transform("found", lambda s, i: F.struct(s["owner"].alias("branch"), s["start"].alias("start"), (s["start"] + s["size"]).alias("end"),
                                                           upto_i(i).alias("position")))
    facts = (branches.select("head", "tree", "owned_from", "at").join(starts, "head")
             .join(found.select("head", ancestors.alias("ancestors")), "head", "left"))

    body = encoded.select("conv_id", "seq", "whole", "sizes", "tokens", "loss")
    whole = body.where("whole").withColumns({"head": F.col("seq"), "depth": zero, "position": zero})
    open_ = body.where("NOT whole").join(placed.select("seq", "head", "depth", "position"), "seq").select(*whole.columns)
    out = whole.unionAll(open_).join(facts, "head", "left").select(
        "conv_id", "seq", "whole", "head", "depth", "position", "sizes", "tokens", "loss", "tree", "start", "owned_from", "at", "ancestors")
    return written(out.mapInArrow(_emitted, PACKED), "packed")


# ---------------------------------------------------------------------------
# Reading back
# ---------------------------------------------------------------------------

_READ = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                   ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


class _Reader:
    """Sums up one conversation, piece by piece."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.loss, self.n, self.learned, self.chars = conv_id, hashlib.sha256(), hashlib.sha256(), 0, 0, 0

    def take(self, own, tokens, loss) -> None:
        formatted = own.decode(tokens)
        self.chars += len(formatted)
        for role, text in turns_in(formatted):
            self.n += 1
            self.turns.update(f"{role}\n{text}\n".encode())
        for s in loss:
            text = unescape(own.decode(tokens[WIDTH * s["start"]:WIDTH * s["end"]]))
            self.learned += len(text)
            self.loss.update(text.encode())

    def row(self) -> tuple:
        return self.conv_id, self.n, self.turns.hexdigest(), self.learned, self.loss.hexdigest(), self.chars


def _read(tokenizer: str | None):
    """Pieces in order of (head, position)."""
    def rows(batches):
        own, head, reader = codec(tokenizer), None, None
        for batch in batches:
            for conv, conv_id, tokens, loss in TU.rows_of(batch, 20):
                if reader is None or conv != head:
                    if reader is not None:
                        yield reader.row()
                    head, reader = conv, _Reader(conv_id)
                reader.take(own, tokens, loss)
        if reader is not None:
            yield reader.row()

    def run(batches):
        yield from TU.record_batches(rows(batches), _READ)
    return run


def read_back(packed: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Per conversation, from the packed branches alone, its own tokens and those its ancestors'
    intervals name: n_turns, the hash of its turns, the characters under the loss mask and their
    hash, the characters of its formatted text. Conversations stream through their task in pieces."""
    ship_package(packed.sparkSession)
    alone = packed.where("whole AND size(ancestors) = 0").select("branch", "conv_id", "tokens", "loss")
    rest = packed.where("NOT (whole AND size(ancestors) = 0)")
    own = rest.select("branch", "conv_id", "position", "tokens", "loss")
    asked = rest.where("first").select("branch", "conv_id", F.explode("ancestors").alias("a")).where("a.branch != branch")
    pieces = packed.where("octet_length(tokens) > 0").select(F.col("branch").alias("other"), F.col("start").alias("p_start"), "tokens", "loss")
    n = (F.octet_length("tokens") / WIDTH).cast("int")
    meets = (F.col("a.branch") == F.col("other")) & (F.col("p_start") < F.col("a.end")) & (F.col("a.start") < F.col("p_start") + n)
    low = F.greatest(F.col("a.start") - F.col("p_start"), F.lit(0)).cast("int")
    high = F.least(F.col("a.end") - F.col("p_start"), n).cast("int")
    kept = F.transform(F.filter("loss", lambda s: (s["start"] >= F.col("low")) & (s["end"] <= F.col("high"))),
                       lambda s: F.struct((s["start"] - F.col("low")).alias("start"), (s["end"] - F.col("low")).alias("end")))
    taken = (asked.join(pieces, meets).withColumn("low", low).withColumn("high", high)
             .select("branch", "conv_id", (F.col("a.position") + F.col("p_start") + F.col("low") - F.col("a.start")).alias("position"),
                     F.substring("tokens", WIDTH * F.col("low") + 1, WIDTH * (F.col("high") - F.col("low"))).alias("tokens"), kept.alias("loss")))
    streamed = own.unionAll(taken).repartition("branch").sortWithinPartitions("branch", "position").select("branch", "conv_id", "tokens", "loss")
    return alone.mapInArrow(_read(tokenizer), READ).unionAll(streamed.mapInArrow(_read(tokenizer), READ))
