import hashlib

from pyspark.sql import Window
from pyspark.sql import functions as F

from talentmatch.operators import sampling as S


def labelled(spark, n=500, parts=3):
    rows = [(i, 1 if i % 7 == 0 else 0) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id bigint, label int").repartition(parts)


def test_two_level_rank_equals_single_window(spark):
    df = labelled(spark)
    w = Window.partitionBy("label").orderBy(S.seed_hash("doc_id"), "doc_id")
    ref = {r.doc_id: r.rn for r in df.withColumn("rn", F.row_number().over(w)).collect()}
    got = {r.doc_id: r.rn for r in S.rank_within(df, "label", "doc_id", prefix_len=1).collect()}
    assert got == ref


def test_folds_balanced_and_stable_across_partitionings(spark):
    a = {r.doc_id: r.fold for r in S.stratified_folds(labelled(spark, parts=1), "label", "doc_id").collect()}
    b = {r.doc_id: r.fold for r in S.stratified_folds(labelled(spark, parts=7), "label", "doc_id").collect()}
    assert a == b
    sizes = {}
    for d, f in a.items():
        key = (1 if d % 7 == 0 else 0, f)
        sizes[key] = sizes.get(key, 0) + 1
    for lab in (0, 1):
        counts = [sizes[(lab, f)] for f in range(5)]
        assert max(counts) - min(counts) <= 1


def test_split_sizes(spark):
    out = S.stratified_split(labelled(spark), "label", "doc_id").collect()
    n1 = sum(1 for r in out if r.label == 1)
    t1 = sum(1 for r in out if r.label == 1 and r.is_test)
    t0 = sum(1 for r in out if r.label == 0 and r.is_test)
    assert t1 == round(0.2 * n1) and t0 == round(0.2 * (500 - n1))


def test_upsample_exact_size_and_draws(spark):
    df = labelled(spark)
    out = S.upsample_minority(df, "label", "doc_id").collect()
    n0 = sum(1 for r in out if r.label == 0)
    n1 = sum(1 for r in out if r.label == 1)
    assert n0 == n1 == 500 - 72
    # slot s draws minority row pmod(md5('42-s'), m) in seeded order
    minority = sorted((hashlib.md5(f"42-{i}".encode()).hexdigest(), i) for i in range(0, 500, 7))
    drawn = {r.slot: r.doc_id for r in out if r.label == 1}
    for s in (0, 1, 100):
        idx = int(hashlib.md5(f"42-{s}".encode()).hexdigest()[:15], 16) % len(minority)
        assert drawn[s] == minority[idx][1]


def test_class_weights(spark):
    w = {r.label: r.weight for r in S.class_weights(labelled(spark), "label").select("label", "weight").distinct().collect()}
    assert abs(w[1] - 500 / (2 * 72)) < 1e-12 and abs(w[0] - 500 / (2 * 428)) < 1e-12


def test_fold_weights_are_the_copies_of_upsampling(spark):
    from pyspark.sql import functions as F

    from talentmatch.operators import sampling as S
    for n, rate, k in ((97, 5, 5), (40, 2, 3), (12, 11, 4), (9, 100, 3)):
        df = spark.createDataFrame([(i, int(i % rate == rate - 1)) for i in range(n)], "id long, label int")
        rows = S.fold_weights(df, "label", "id", k).collect()
        folded = S.stratified_folds(df, "label", "id", k)
        assert {r.id: r.fold for r in rows} == {r.id: r.fold for r in folded.collect()}
        for f in range(k + 1):
            part = folded if f == k else folded.where(F.col("fold") != f)
            copies = {r["id"]: r["count"] for r in S.upsample_minority(part, "label", "id").groupBy("id").count().collect()}
            assert {r.id: r.weights[f] for r in rows if r.weights[f]} == copies
