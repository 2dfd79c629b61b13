"""Text -> vector (M10) and job embeddings (R2).

``embed_hash`` is the built-in offline encoder: a signed hashed bag of words
projected to ``dim`` dimensions and L2-normalised. Token -> (slot, sign) comes
from the token's md5; a row's tokens are counted by slot inside the row, so no
row leaves its partition and no word is a hot key.

``embed_with`` plugs in any batch encoder (e.g. a sentence model loaded once
per worker) through ``predict_batch_udf``; distinct texts are encoded once and
joined back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talentmatch.functions import text as T


def _unit_counts(dim: int):
    """Arrow batches of token lists to unit vectors; a token's hash is taken once for each batch."""
    import hashlib

    import numpy as np
    import pyarrow as pa

    def run(tokens):
        lengths = tokens.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        coded = tokens.flatten().dictionary_encode()
        hashes = [hashlib.md5(t.encode()).hexdigest() for t in coded.dictionary.to_pylist()]
        slots = np.array([int(h[:8], 16) % dim for h in hashes], dtype=np.int64)
        signs = np.array([1.0 if int(h[8], 16) < 8 else -1.0 for h in hashes])
        codes = coded.indices.to_numpy(zero_copy_only=False)
        rows = np.repeat(np.arange(len(lengths)), lengths)
        counts = np.bincount(rows * dim + slots[codes], weights=signs[codes], minlength=len(lengths) * dim).reshape(-1, dim)
        unit = counts / np.sqrt(np.maximum((counts * counts).sum(axis=1), 1))[:, None] + 0.0
        return pa.ListArray.from_arrays(pa.array(np.arange(len(lengths) + 1, dtype=np.int32) * dim), pa.array(unit.ravel()))

    return run


def with_hash(df: DataFrame, text: str, dim: int = 64, out: str = "embedding") -> DataFrame:
    """M10 built-in encoder: ``df`` with ``out``, an array<double> of unit length (all zeros for a
    text without tokens). A token's md5 gives its slot (first 8 digits) and sign (the ninth). Row by row:
    nothing is shuffled or joined."""
    unit = F.arrow_udf(_unit_counts(dim), "array<double>")
    return df.withColumn(out, unit(F.coalesce(T.bow_tokens(text), F.array().cast("array<string>"))))


def embed_hash(df: DataFrame, key: str, text: str, dim: int = 64, out: str = "embedding") -> DataFrame:
    """(key, embedding) by ``with_hash``."""
    return with_hash(df.select(key, text), text, dim, out).select(key, out)


def embed_with(df: DataFrame, key: str, text: str, make_predict_fn, dim: int,
               batch_size: int = 32, out: str = "embedding") -> DataFrame:
    """M10 with a plugged-in encoder: distinct texts -> encoder -> join back.

    ``make_predict_fn`` returns ``fn(texts: np.ndarray) -> np.ndarray[n, dim]``
    and is called once per Python worker.
    """
    from pyspark.ml.functions import predict_batch_udf
    from pyspark.sql.types import ArrayType, FloatType

    enc = predict_batch_udf(make_predict_fn, return_type=ArrayType(FloatType()),
                            batch_size=batch_size)
    texts = df.select(text).where(F.col(text).isNotNull()).distinct()
    encoded = texts.withColumn(out, enc(F.col(text)))
    return df.select(key, text).join(encoded, text, "left").select(key, out)
