"""Benchmark decontamination by a distributed positional inverted index.

The documents are indexed once: every task turns its documents into segments, each with the
sorted terms of some whole documents and, by term, the ascending places of its words (the
postings). The segments are written to the shared folder, so a lost executor costs reading one
again, and no term's postings meet in one task: a word of every document has a list in every
segment. A search takes the phrases in blocks of bounded size to all segments and, in each,
intersects offset-adjusted postings from the rarest term on.

Terms are 64-bit hashes of words; a phrase match compares all its words' hashes.

Defined results: a null text has no words; an item without words, or with a null text, matches
nothing; a null id is kept as it is (of an item: listed as the empty string); repeated rows are
documents of their own; of the inputs only the id and text columns are read; texts of any length are
read whole; an empty table of documents gives no rows, one of items no matches.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talentmatch.llm.words import ALNUM, chunks, hash_words, mix64, words_of
from talentmatch.session import scratch_path, ship_package

#: Bytes of text in a segment, unless one document is longer.
SEGMENT_BYTES = 1 << 21
#: Characters of phrases searched for in one pass over the index.
BLOCK_CHARS = 4_000_000


# ---------------------------------------------------------------------------
# Index
# ---------------------------------------------------------------------------

def segment(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(terms, bounds, places): the places of term i are ``places[bounds[i]:bounds[i+1]]``, ascending."""
    places = np.argsort(hashes, kind="stable").astype(np.int32)
    ordered = hashes[places]
    new = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, int)
    return ordered[new], np.append(new, len(ordered)).astype(np.int32), places


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Write the positional index of ``docs`` and return it: one row per segment.

    ``ids`` by document; ``first`` (word offsets by document, one more), ``terms``, ``bounds``
    and ``places`` are little-endian numbers; ``segment`` numbers the rows.
    """
    spark = docs.sparkSession
    ship_package(spark)
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("ids", T.ArrayType(id_type))]
                          + [T.StructField(c, T.BinaryType()) for c in ("first", "terms", "bounds", "places")])

    def index(batches):
        for batch in batches:
            ids = batch.column(0)
            for low, high, data, offsets in chunks(batch.column(1), SEGMENT_BYTES):
                words = words_of(data, offsets, ALNUM)
                terms, bounds, places = segment(words.hash)
                listed = pa.ListArray.from_arrays(pa.array([0, high - low], pa.int32()), ids.slice(low, high - low))
                blobs = [pa.array([x.tobytes()], pa.binary()) for x in (words.first.astype(np.int64), terms, bounds, places)]
                yield pa.RecordBatch.from_arrays([listed, *blobs], ["ids", "first", "terms", "bounds", "places"])

    path = path or scratch_path(spark, "postings")
    (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
     .mapInArrow(index, schema).withColumn("segment", F.monotonically_increasing_id())
     .write.mode("overwrite").option("compression", "zstd").option("parquet.enable.dictionary", "false").parquet(path))
    return spark.read.parquet(path)


# ---------------------------------------------------------------------------
# Phrases
# ---------------------------------------------------------------------------

class Phrases:
    """Distinct word sequences and the items that hold them, as flat arrays: about 40 bytes a word of
    the items.

    Phrase p is the words ``flat[start[p]:start[p] + length[p]]`` (numbers of ``terms``, the items' words
    one after the other); its items are ``held[bounds[p]:bounds[p + 1]]``, ascending. Sequences are
    told apart by a 64-bit hash of their words' hashes.
    """

    def __init__(self, items: list[tuple[str, str | None]], size: int | None):
        """``size``: the words of a window; None: an item's whole text is its phrase."""
        self.names = [name for name, _ in items]
        words = hash_words([text or "" for _, text in items], ALNUM)
        n = np.array([len(w) for w in words], dtype=np.int64)
        first = np.concatenate([[0], np.cumsum(n)])
        flat = np.concatenate([np.zeros(0, np.uint64), *words])
        length = np.minimum(n, size) if size else n
        windows = np.where(n > 0, n - length + 1, 0)
        item = np.repeat(np.arange(len(items), dtype=np.int32), windows)
        start = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows) + np.repeat(first[:-1], windows)
        length = np.repeat(length, windows)
        # a polynomial over the words of each window, from one running sum over all words
        key = _window_keys(flat, start, length)
        order = np.lexsort((item, key))
        key, item, start, length = key[order], item[order], start[order], length[order]
        fresh = np.concatenate([[True], key[1:] != key[:-1]])[:len(key)]
        once = fresh | np.concatenate([[True], item[1:] != item[:-1]])[:len(key)]
        self.held = item[once]
        self.bounds = np.append(np.flatnonzero(fresh[once]), len(self.held))
        self.start, self.length = start[fresh], length[fresh]
        self.terms, self.flat = np.unique(flat, return_inverse=True)
        self.flat = self.flat.astype(np.int32)

    def items(self, p: int) -> np.ndarray:
        return self.held[self.bounds[p]:self.bounds[p + 1]]

    def words(self, p: int) -> np.ndarray:
        return self.flat[self.start[p]:self.start[p] + self.length[p]]


_RING, _RING_INVERSE = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _window_keys(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    n = len(flat)
    up = np.full(n + 1, _RING)
    down = np.full(n + 1, _RING_INVERSE)
    up[0] = down[0] = 1
    up, down = np.multiply.accumulate(up), np.multiply.accumulate(down)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(flat) * up[:n], dtype=np.uint64)])
    return mix64((sums[start + length] - sums[start]) * down[start] + length.astype(np.uint64))


def _windows(lists: list[np.ndarray], first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the smallest window, the leftmost of them, around each place in ``lists[0]`` that
    holds a place of each list, in one document; windows of more than ``size`` words are left out."""
    base = lists[0]
    doc = np.searchsorted(first, base, side="right")
    low, high = np.maximum(first[doc - 1], base - size + 1), np.minimum(first[doc], base + size)
    near = np.ones(len(base), dtype=bool)
    for places in lists[1:]:
        near &= np.append(places, first[-1])[np.searchsorted(places, low)] < high
    base, low = base[near], low[near]
    if not len(base):
        return base, base
    # windows may start at the terms' places not after a base; ``to`` is where one from there holds every term
    behind = [base[np.minimum(np.searchsorted(base, x), len(base) - 1)] - x for x in lists]
    begin = np.unique(np.concatenate([x[(d >= 0) & (d < size)] for x, d in zip(lists, behind, strict=True)]))
    out = int(first[-1]) + 1
    to = np.full(len(begin), 0)
    for places in lists:
        to = np.maximum(to, np.append(places + 1, out)[np.searchsorted(places, begin)])
    far = first[np.searchsorted(first, begin, side="right")]
    # those complete at the base: the last of them, up to the base; the others: the shortest
    a, b = np.searchsorted(begin, low), np.searchsorted(begin, base, side="right")
    cut = np.searchsorted(to, base + 1, side="right")
    k = np.minimum(cut, b) - 1
    start, length = base.copy(), np.full(len(base), size + 1)
    whole = k >= a
    start[whole], length[whole] = begin[k[whole]], (base + 1 - begin[k])[whole]
    a = np.maximum(a, cut)
    open_ = np.flatnonzero(a < b)
    if len(open_):
        # length and place in one number, so that the least is the leftmost of the shortest
        key = np.append(np.where(to <= far, to - begin, size + 1) * len(begin) + np.arange(len(begin)), 0)
        least = np.minimum.reduceat(key, np.stack([a[open_], b[open_]], axis=1).ravel())[::2]
        at, shortest = least % len(begin), least // len(begin)
        better = shortest < length[open_]
        start[open_[better]], length[open_[better]] = begin[at[better]], shortest[better]
    within = length <= size
    return start[within], (start + length)[within]


def phrase_hits(phrases: Phrases, first, terms, bounds, places, slop: int | None = None):
    """(phrase, start, end) of all matches in one segment, in words of the segment.

    ``slop`` None: exact phrases. Otherwise proximity: by occurrence of the phrase's rarest term, the
    smallest window of its document that holds it and every other term, if it has at most the
    phrase's length plus ``slop`` words.
    """
    if not len(terms) or not len(phrases.terms):
        return
    at = np.minimum(np.searchsorted(terms, phrases.terms), len(terms) - 1)
    there = terms[at] == phrases.terms
    known = np.concatenate([[0], np.cumsum(there[phrases.flat])])
    alive = np.flatnonzero(known[phrases.start + phrases.length] - known[phrases.start] == phrases.length)
    for p in alive:
        own = at[phrases.words(p)]
        n = len(own)
        order = np.argsort(bounds[own + 1] - bounds[own], kind="stable")
        rarest = order[0]
        base = places[bounds[own[rarest]]:bounds[own[rarest] + 1]].astype(np.int64)
        if slop is None:
            start = base - rarest
            for j in order[1:]:
                lists = places[bounds[own[j]]:bounds[own[j] + 1]]
                k = np.minimum(np.searchsorted(lists, start + j), len(lists) - 1)
                start = start[lists[k] == start + j]
                if not len(start):
                    break
            end = start + n
        else:
            lists = [places[bounds[term]:bounds[term + 1]].astype(np.int64) for term in dict.fromkeys(own[order])]
            start, end = _windows(lists, first, n + slop)
        if len(start):
            same = (start >= 0) & (np.searchsorted(first, start, side="right") == np.searchsorted(first, end - 1, side="right"))
            for s, e in zip(start[same].tolist(), end[same].tolist(), strict=True):
                yield int(p), s, e


def _blocks(items: DataFrame, id_col: str, text_col: str, block_chars: int):
    """The items in blocks of at most ``block_chars`` characters, unless one item has more."""
    block, chars = [], 0
    rows = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(text_col).cast("string"))
    for name, text in rows.toLocalIterator():
        if block and chars + len(text or "") > block_chars:
            yield block
            block, chars = [], 0
        block.append((name, text))
        chars += len(text or "")
    yield block


def search(index: DataFrame, items: DataFrame, size: int | None = 10, slop: int | None = None,
           id_col: str = "item_id", text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Per indexed document: id, n_words and its matches (item_id, start, end in words, end exclusive).

    ``size``: search for every window of so many words of an item (all its words, if fewer); None
    for whole items. ``slop``: see ``phrase_hits``. Overlapping matches of an item are joined.
    Items stream through the driver in blocks of ``block_chars``, of which one is held at a time, on
    the driver and in the tasks (about 40 bytes a word).
    """
    spark = index.sparkSession
    ship_package(spark)
    id_type = index.schema["ids"].dataType.elementType
    match = T.StructType([T.StructField("item_id", T.StringType()), T.StructField("start", T.LongType()),
                          T.StructField("end", T.LongType())])
    schema = T.StructType([T.StructField("segment", T.LongType()), T.StructField("place", T.LongType()),
                           T.StructField("id", id_type), T.StructField("n_words", T.LongType()),
                           T.StructField("matches", T.ArrayType(match))])

    def one_pass(block):
        """(matches of a block of items, the broadcast to release when they have been read)."""
        sent = spark.sparkContext.broadcast(Phrases(block, size))

        def find(batches):
            phrases = sent.value
            arrow = pa.list_(pa.struct([("item_id", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            for batch in batches:
                ids, number = batch.column("ids"), batch.column("segment")
                for row in range(batch.num_rows):
                    first = np.frombuffer(batch.column("first")[row].as_buffer(), np.int64)
                    terms = np.frombuffer(batch.column("terms")[row].as_buffer(), np.uint64)
                    bounds, places = (np.frombuffer(batch.column(c)[row].as_buffer(), np.int32) for c in ("bounds", "places"))
                    found: dict[tuple[int, int], list[list[int]]] = {}
                    hits = sorted(phrase_hits(phrases, first, terms, bounds, places, slop), key=lambda x: x[1:])
                    for p, start, end in hits:
                        doc = int(np.searchsorted(first, start, side="right")) - 1
                        for item in phrases.items(p).tolist():
                            spans = found.setdefault((doc, item), [])
                            if spans and start <= spans[-1][1]:
                                spans[-1][1] = max(spans[-1][1], end)
                            else:
                                spans.append([start, end])
                    n = len(first) - 1
                    matches: list[list[dict]] = [[] for _ in range(n)]
                    for (doc, item), spans in sorted(found.items()):
                        matches[doc] += [{"item_id": phrases.names[item], "start": s - int(first[doc]), "end": e - int(first[doc])}
                                         for s, e in spans]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([number[row].as_py()] * n, pa.int64()), pa.array(range(n), pa.int64()), ids[row].values,
                         pa.array(np.diff(first)), pa.array(matches, arrow)], ["segment", "place", "id", "n_words", "matches"])

        return index.mapInArrow(find, schema), sent

    blocks = _blocks(items, id_col, text_col, block_chars)
    first, second = next(blocks), next(blocks, None)
    if second is None:
        return one_pass(first)[0].select("id", "n_words", "matches")
    # one block is held at a time: its matches are written, then its broadcast is released
    path, documents = scratch_path(spark, "matches"), None
    for block in itertools.chain([first, second], blocks):
        found, sent = one_pass(block)
        if documents is None:
            documents = scratch_path(spark, "searched")
            found.write.parquet(documents)
        else:
            found.where("size(matches) > 0").select("segment", "place", "matches").write.mode("append").parquet(path)
        sent.destroy()
    base = spark.read.parquet(documents)
    more = spark.read.schema(schema).parquet(path).groupBy("segment", "place").agg(F.flatten(F.collect_list("matches")).alias("more"))
    return (base.join(more, ["segment", "place"], "left")
            .select("id", "n_words", F.concat("matches", F.coalesce("more", F.array().cast(base.schema["matches"].dataType))).alias("matches")))


def contamination(found: DataFrame) -> DataFrame:
    """Of ``search``: id, n_words, n_hit (words inside any match), the sorted item ids and contaminated."""
    spans = F.array_sort(F.transform("matches", lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"))))
    hit = F.aggregate(
        spans, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to")),
        lambda a, s: F.struct((a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], a["to"]))).alias("n"),
                              F.greatest(a["to"], s["end"]).alias("to")), lambda a: a["n"])
    items = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item_id"])))
    return (found.select("id", "n_words", hit.alias("n_hit"), items.alias("items"))
            .withColumn("contaminated", F.col("n_hit") > 0))


def decontaminate(docs: DataFrame, items: DataFrame, size: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Per document of ``docs``: id, n_words, n_hit, items, contaminated (see the module)."""
    index = build_index(docs, id_col, text_col)
    return contamination(search(index, items, size, id_col=item_col, text_col=item_text_col))
