"""Joins of whole documents with a table of keys, without a shuffle of most documents.

A Bloom filter of the keys, of bounded size, goes to all tasks as one row: an array of words. A
document whose key it does not hold is certainly not in the table; only the others are shuffled and
joined, which decides exactly. Where the keys outgrow the filter it holds more by mistake and more
documents are shuffled: the result stays the same. All of it is column math in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits a key, keys' hash functions, and the most bits of a filter (16 MB).
BITS_A_KEY, HASHES, MOST_BITS = 12, 4, 1 << 27
_WORDS, _ONE, _HELD = "__filter_words", "__filter_one", "__filter_held"


def _places(key: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(bits)) for i in range(HASHES)]


def may_hold(keys: DataFrame, most_bits: int = MOST_BITS):
    """A function (rows, key column, wanted) that gives the rows whose key the filter of ``keys`` (its only
    column) holds, or, if not ``wanted``, those it does not: these are certainly not in ``keys``."""
    spark = keys.sparkSession
    keys = keys.toDF("key").where("key IS NOT NULL").select(F.col("key").cast("long").alias("key"))
    bits = min(most_bits, max(1 << 12, 1 << (BITS_A_KEY * keys.count()).bit_length()))
    place = keys.select(F.explode(F.array(*_places(F.col("key"), bits))).alias("p"))
    held = place.groupBy(F.floor(F.col("p") / 64).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("held"))
    # bits / 64 rows make one array
    every = spark.range(bits // 64).withColumnRenamed("id", "word").join(held, "word", "left")
    words = every.agg(F.sort_array(F.collect_list(F.struct("word", F.coalesce("held", F.lit(0).cast("long")).alias("held")))).alias("w"))
    table = spark.createDataFrame(words.select(F.lit(1).alias(_ONE), F.transform("w", lambda s: s["held"]).alias(_WORDS)).collect(), f"{_ONE} int, {_WORDS} array<long>")

    def part(rows: DataFrame, key: str, wanted: bool) -> DataFrame:
        own = F.col(key).cast("long")
        inside = own.isNotNull()
        for p in _places(own, bits):
            word = F.get(F.col(_WORDS), F.floor(p / 64).cast("int"))
            inside &= word.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), (p % 64).cast("int"))) != 0
        met = rows.withColumn(_ONE, F.lit(1)).join(F.broadcast(table), _ONE)
        return met.where(inside if wanted else ~inside).select(rows.columns)

    return part


def _met(rows: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """``rows`` with ``_HELD``: true where ``keys`` has the key, else null. An outer join: Spark moves a semi or
    anti join below the filter's, where it shuffles every document. Only ids are hashed and no document is
    sorted; as the join stays a shuffle by key, no task gets the documents of whole map tasks, which are
    most of them where the keys' documents lie together."""
    return rows.join(keys.toDF(key).distinct().withColumn(_HELD, F.lit(True)).hint("shuffle_hash"), key, "left")


def only(rows: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The rows whose ``key`` (long) is in the only column of ``keys``."""
    return _met(may_hold(keys)(rows, key, True), key, keys).where(F.col(_HELD)).select(rows.columns)


def without(rows: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The rows whose ``key`` (long) is null or not in the only column of ``keys``."""
    part = may_hold(keys)
    return part(rows, key, False).unionAll(_met(part(rows, key, True), key, keys).where(F.col(_HELD).isNull()).select(rows.columns))
