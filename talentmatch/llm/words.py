"""Words of Arrow text columns as flat numpy arrays.

A word is a maximal run of word bytes; both word rules used here (ASCII letters, digits and
everything beyond ASCII; or anything but white space) can be decided byte by byte in UTF-8.
Each word gets a 64-bit hash: a polynomial over random values of its bytes, taken from one
running sum over the whole batch, so no Python loop runs over words or documents.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of the 64-bit integers that scatters its input."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def _byte_values(is_word, lower: bool) -> np.ndarray:
    """Per byte: a random odd value, equal for A-Z and a-z if ``lower``; 0 for separators."""
    values = mix64(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)
    out = np.zeros(256, dtype=np.uint64)
    for b in range(256):
        if is_word(b):
            out[b] = values[b + 32 if lower and 65 <= b <= 90 else b]
    return out


#: Lower-cased runs of a-z, 0-9 and everything beyond ASCII.
ALNUM = _byte_values(lambda b: 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128, True)
#: Lower-cased runs of anything but space and the controls 9 to 13.
NON_SPACE = _byte_values(lambda b: b != 32 and not 9 <= b <= 13, True)


@functools.lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE, dtype=np.uint64), np.full(n, _BASE_INV, dtype=np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


@dataclass
class Words:
    """Words of some documents: ``first[d]:first[d+1]`` are those of document ``d``."""

    data: np.ndarray    # the bytes of all documents
    start: np.ndarray   # byte offsets
    end: np.ndarray
    hash: np.ndarray    # uint64
    first: np.ndarray   # word offsets by document, one more than documents
    sums: np.ndarray    # running sums of byte values, for hashes of parts of words

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def docs(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def span_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of byte spans inside words; the hash of a whole word's span is the word's."""
        _, down = _powers(_room(len(self.data)))
        return mix64((self.sums[end] - self.sums[start]) * down[start] + (end - start).astype(np.uint64))


def _room(n: int) -> int:
    return max(CHUNK_BYTES, 1 << max(0, int(n)).bit_length())


def slices(batch: pa.RecordBatch, rows: int = 500):
    """A batch in parts of a few rows, where work makes objects of them."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def chunks(texts: pa.Array, max_bytes: int = CHUNK_BYTES):
    """(low, high, bytes, offsets) of runs of whole documents of about ``max_bytes`` together;
    a null is an empty text, a longer document is a run of its own."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if not n:
        return
    # the bytes are read where they lie, without a copy
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], dtype=width)[texts.offset:texts.offset + n + 1].astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    low = 0
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + max_bytes, side="right")) - 1)
        yield low, high, data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low]
        low = high


def words_of(data: np.ndarray, offsets: np.ndarray, values: np.ndarray = ALNUM) -> Words:
    """The words of the documents ``data[offsets[d]:offsets[d+1]]``."""
    n = len(data)
    val = values[data]
    inside = val != 0
    before = np.empty(n, dtype=bool)
    after = np.empty(n, dtype=bool)
    if n:
        before[0], before[1:] = False, inside[:-1]
        after[-1], after[:-1] = False, inside[1:]
        edges = offsets[1:-1]
        edges = edges[(edges > 0) & (edges < n)]
        before[edges] = False
        after[edges - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    up, _ = _powers(_room(n))
    val *= up[:n]
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(val, out=sums[1:])
    out = Words(data, start, end, start, np.searchsorted(start, offsets), sums)
    out.hash = out.span_hash(start, end)
    return out


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): hashes of all runs of ``size`` words, by document; a document of fewer
    words, but not none, has its whole sequence as one."""
    h, n = words.hash, words.counts()
    made = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    first = np.concatenate([[0], np.cumsum(made)])
    at = np.arange(first[-1]) - np.repeat(first[:-1], made) + np.repeat(words.first[:-1], made)
    long = np.repeat(np.minimum(n, size), made)
    short = bool((long < size).any())
    total = long.astype(np.uint64)
    factors = _powers(CHUNK_BYTES)[0]
    for j in range(size):
        if short:
            there = long > j
            total[there] += h[at[there] + j] * factors[j]
        else:
            total += h[at + j] * factors[j]
    return mix64(total), first


def hash_words(texts: list[str], values: np.ndarray = ALNUM) -> list[np.ndarray]:
    """Word hashes of a few texts."""
    out = []
    for _, _, data, offsets in chunks(pa.array(texts, type=pa.large_string())):
        w = words_of(data, offsets, values)
        out += np.split(w.hash, w.first[1:-1])
    return out
