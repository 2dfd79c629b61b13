import pytest
from pyspark.sql import functions as F

from talentmatch.llm import membership as MB


@pytest.mark.parametrize("bits", [MB.MOST_BITS, 64])
def test_joins_are_exact_whatever_the_filter_holds(spark, monkeypatch, bits):
    monkeypatch.setattr(MB, "may_hold", lambda keys, f=MB.may_hold: f(keys, bits))
    rows = spark.createDataFrame([(i, f"t{i}") for i in [*range(-50, 250), 2 ** 62, -2 ** 63]] + [(None, "n"), (7, "again")], "doc_id long, text string")
    keys = spark.createDataFrame([(i,) for i in [*range(0, 200, 3), -2 ** 63, 1000]] + [(None,)], "k long")
    listed = {r.k for r in keys.collect()} - {None}
    got = sorted(map(tuple, MB.only(rows, "doc_id", keys).collect()), key=str)
    assert got == sorted((tuple(r) for r in rows.collect() if r.doc_id in listed), key=str)
    got = sorted(map(tuple, MB.without(rows, "doc_id", keys).collect()), key=str)
    assert got == sorted((tuple(r) for r in rows.collect() if r.doc_id not in listed), key=str)


def test_empty_tables(spark):
    rows = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    none = spark.createDataFrame([], "k long")
    assert MB.only(rows, "doc_id", none).count() == 0 and MB.without(rows, "doc_id", none).count() == 1
    assert MB.without(rows.where("false"), "doc_id", none).count() == 0


def test_few_others_are_held_by_mistake(spark):
    keys = spark.range(20_000)
    part = MB.may_hold(keys)
    assert part(spark.range(20_000), "id", True).count() == 20_000
    assert part(spark.range(100_000, 200_000), "id", True).count() < 2_000


@pytest.mark.parametrize("join", [MB.only, MB.without])
def test_rows_are_filtered_before_they_are_shuffled(spark, join):
    rows, keys = spark.range(1000).selectExpr("id", "string(id) AS text"), spark.range(0, 100, 7).toDF("k")
    plan = join(rows, "id", keys)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    deep = [(line.index("Join "), "__filter_words" in line.split("Join ")[1]) for line in plan if "Join " in line]
    assert max(d for d, words in deep if not words) < max(d for d, words in deep if words)


@pytest.mark.parametrize("join", [MB.only, MB.without])
def test_documents_that_lie_together_are_dealt_out(spark, monkeypatch, join):
    monkeypatch.setattr(MB, "may_hold", lambda keys, f=MB.may_hold: f(keys, 64))  # holds every key
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        rows = spark.range(0, 4000, 1, 8).selectExpr("id", "string(id) AS text").where("id < 500")  # all of one map task
        keys = spark.range(0, 500, 2).toDF("k")
        out = join(rows, "id", keys).withColumn("task", F.spark_partition_id())
        sizes = [r["count"] for r in out.groupBy("task").count().collect()]
        assert sum(sizes) == 250 and max(sizes) < 125
    finally:
        spark.conf.unset(key)
