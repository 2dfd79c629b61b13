"""Seeded order, stratified split / folds and exact upsampling.

Every random choice is a function of ``md5('<seed>-<key>')`` so results do not
depend on partitioning, survive task retries, and can be reproduced in SQL.

Ranking inside a class: a single window over ``partitionBy(label)`` would put
a whole class in one task. ``rank_within`` numbers rows in two levels: the
first ``prefix_len`` hex digits of the md5 cut each class into up to
16**prefix_len buckets; bucket sizes are counted (partial aggregate), turned
into offsets over that small table, and rows are ranked inside their own
bucket only. The result equals ``row_number() over (partition by label order
by md5, key)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def seed_hash(key, seed: int = 42):
    """md5 of '<seed>-<key>' (hex string); the seeded shuffle order (O3)."""
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}-"), k.cast("string")))


def hash_to_long(h):
    """First 15 hex digits of an md5 as a non-negative bigint."""
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("bigint")


def rank_within(df: DataFrame, part: str | None, key: str, seed: int = 42,
                prefix_len: int = 4, out: str = "rn") -> DataFrame:
    """``df`` plus ``out`` = 1-based rank inside ``part`` by (md5(seed-key), key)."""
    parts = [part] if part else []
    h = df.withColumn("__h", seed_hash(key, seed)).withColumn("__b", F.substring("__h", 1, prefix_len))
    sizes = h.groupBy(*parts, "__b").agg(F.count(F.lit(1)).alias("__n"))
    # offsets over the (labels x 16**prefix_len) table; its size, which grows with the labels, decides
    # how it is joined: the rows are dealt out by label and bucket for the ranking anyway
    wb = Window.partitionBy(*parts).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("__off", F.coalesce(F.sum("__n").over(wb), F.lit(0))).drop("__n")
    wr = Window.partitionBy(*parts, "__b").orderBy("__h", key)
    ranked = h.join(offsets, parts + ["__b"]) \
        .withColumn(out, F.col("__off") + F.row_number().over(wr))
    return ranked.drop("__h", "__b", "__off")


def stratified_folds(df: DataFrame, label: str, key: str, k: int = 5, seed: int = 42,
                     out: str = "fold") -> DataFrame:
    """fold = (rank inside the class - 1) mod k."""
    r = rank_within(df, label, key, seed)
    return r.withColumn(out, ((F.col("rn") - 1) % k).cast("int")).drop("rn")


def stratified_split(df: DataFrame, label: str, key: str, test_size: float = 0.2,
                     seed: int = 42, out: str = "is_test") -> DataFrame:
    """M8 exact: the first round(test_size * n_class) rows of each class in
    seeded order are the test set (class sizes come from a small aggregate)."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("__nc"))
    r = rank_within(df, label, key, seed).join(F.broadcast(sizes), label)
    return r.withColumn(out, F.col("rn") <= F.round(F.col("__nc") * F.lit(test_size))) \
        .drop("rn", "__nc")


def hash_split(df: DataFrame, key: str, test_size: float = 0.2, seed: int = 42,
               out: str = "is_test") -> DataFrame:
    """M8 scalable: test iff md5 bucket (0..9999) < test_size * 10000. No shuffle."""
    bucket = hash_to_long(seed_hash(key, seed)) % 10000
    return df.withColumn(out, bucket < F.lit(int(round(test_size * 10000))))


def upsample_minority(df: DataFrame, label: str, key: str, seed: int = 42,
                      minority: int = 1, majority: int = 0) -> DataFrame:
    """M9: draw len(majority) rows of the minority class with replacement.

    Minority rows are numbered 0..m-1 in seeded order; slot s in 0..n0-1 takes
    row pmod(md5('<seed>-s'), m). Slots come from ``spark.range`` sized by a
    count of the data, and meet the rows through an equi-join. Result: the
    majority rows (slot null) plus one row per slot.
    """
    maj = df.where(F.col(label) == majority)
    mino = df.where(F.col(label) == minority)
    counts = {r[0]: r[1] for r in df.groupBy(label).count().collect()}   # two numbers
    n0, m = int(counts.get(majority, 0)), int(counts.get(minority, 0))
    base = maj.withColumn("slot", F.lit(None).cast("bigint"))
    if n0 == 0 or m == 0:
        return base
    numbered = rank_within(mino, None, key, seed).withColumn("__row", F.col("rn") - 1).drop("rn")
    spark = df.sparkSession
    slots = (spark.range(n0).withColumnRenamed("id", "slot")
             .withColumn("__row", F.pmod(hash_to_long(seed_hash("slot", seed)), F.lit(m))))
    drawn = slots.join(numbered, "__row").drop("__row")
    return base.unionByName(drawn.select(*base.columns))


def fold_weights(df: DataFrame, label: str, key: str, k: int = 5, seed: int = 42,
                 minority: int = 1, majority: int = 0) -> DataFrame:
    """M9 inside M11 without copies: ``df`` plus ``fold`` and ``weights``, an array of ``k + 1`` counts.

    ``weights[f]`` is how often the row stands in the training part of fold ``f`` after
    ``upsample_minority``: 0 for rows of the fold itself, 1 for other majority rows, the number of
    slots drawn for a minority row. ``weights[k]`` is the same for all rows as training part.
    Folds are numbered round-robin in seeded order, so a row's rank within every training part
    follows from its rank in its class: one ranking and one join of the minority serve all folds.
    """
    counts = {r[0]: r[1] for r in df.groupBy(label).count().collect()}   # a number for each class
    n0, m = int(counts.get(majority, 0)), int(counts.get(minority, 0))
    inside = [max(0, -(-(n - f) // k)) for n in (n0, m) for f in range(k)]
    sizes = [(f, n0 - inside[f], m - inside[k + f]) for f in range(k)] + [(k, n0, m)]
    ranked = rank_within(df, label, key, seed).withColumn("__r", F.col("rn") - 1).drop("rn")
    spark = df.sparkSession
    slots = spark.range(n0).withColumnRenamed("id", "slot").select("slot", hash_to_long(seed_hash("slot", seed)).alias("h"))
    parts = F.array(*[F.struct(F.lit(f).alias("f"), F.lit(a).alias("n0"), F.lit(b).alias("m")) for f, a, b in sizes])
    drawn = (slots.select("slot", "h", F.explode(parts).alias("p")).where((F.col("slot") < F.col("p.n0")) & (F.col("p.m") > 0))
             .groupBy(F.col("p.f").alias("f"), F.pmod("h", "p.m").alias("row")).agg(F.count(F.lit(1)).alias("n")))
    # rows of the fold that stand before rank r: those q < r with q mod k = f
    before = F.when(F.col("f") == k, 0).otherwise(F.greatest(F.lit(0), F.floor((F.col("__r") - F.col("f") + k - 1) / k)))
    places = (ranked.where(F.col(label) == minority).select("__r", F.explode(F.sequence(F.lit(0), F.lit(k))).alias("f"))
              .where((F.col("f") == k) | (F.col("__r") % k != F.col("f"))).select("__r", "f", (F.col("__r") - before).alias("row")))
    counted = places.join(drawn, ["f", "row"]).groupBy("__r").agg(
        F.array(*[F.coalesce(F.sum(F.when(F.col("f") == f, F.col("n"))), F.lit(0)).cast("int") for f in range(k + 1)]).alias("__w"))
    none = F.array(*[F.lit(0)] * (k + 1))
    once = F.array(*[F.when(F.col("__r") % k == f, 0).otherwise(1) for f in range(k)], F.lit(1))
    mine = F.when(F.col(label) == minority, F.col("__r"))
    return (ranked.withColumn("__m", mine).join(counted.withColumnRenamed("__r", "__m"), "__m", "left")
            .withColumn("fold", (F.col("__r") % k).cast("int"))
            .withColumn("weights", F.when(F.col(label) == majority, once).otherwise(F.coalesce("__w", none)))
            .drop("__m", "__w", "__r"))


def class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """A10: balanced weights n / (k * n_c) joined back as a weight column."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("__nc"))
    everything = Window.partitionBy()        # over the k-row class table only
    w = sizes.select(label, (F.sum("__nc").over(everything)
                             / (F.count(F.lit(1)).over(everything) * F.col("__nc"))).alias(out))
    return df.join(F.broadcast(w), label)
