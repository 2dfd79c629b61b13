import numpy as np
import pytest

from talentmatch.operators import recommend as R


def brute(cands, jobs, k):
    out = []
    for cid, cv in cands:
        scores = []
        for jid, jv in jobs:
            a, b = np.array(cv, float), np.array(jv, float)
            den = np.linalg.norm(a) * np.linalg.norm(b)
            scores.append((-(a @ b / den if den > 0 else 0.0), jid))
        for r, (neg, jid) in enumerate(sorted(scores)[:k], 1):
            out.append((cid, r, jid, round(-neg, 4)))
    return sorted(out)


def frames(spark, n_c=30, n_j=25, d=8, seed=1):
    rng = np.random.default_rng(seed)
    cands = [(i, [float(x) for x in rng.normal(size=d)]) for i in range(n_c)]
    jobs = [(1000 + j, [float(x) for x in rng.normal(size=d)]) for j in range(n_j)]
    jobs.append((2000, [0.0] * d))                       # zero vector scores 0
    jobs.append((2001, list(jobs[0][1])))                 # exact tie with job 1000
    c = spark.createDataFrame(cands, "candidate_id bigint, embedding array<float>")
    j = spark.createDataFrame(jobs, "codigo_vaga bigint, embedding array<float>")
    # compare with the float32 values Spark holds
    cands = [(i, list(np.float32(v))) for i, v in cands]
    jobs = [(i, list(np.float32(v))) for i, v in jobs]
    return c, j, cands, jobs


@pytest.mark.parametrize("block_size", [4096, 5])
def test_topk_matches_brute_force(spark, block_size):
    c, j, cands, jobs = frames(spark)
    got = sorted(tuple(r) for r in R.recommend_topk(c, j, k=3, block_size=block_size).collect())
    assert got == brute(cands, jobs, 3)


def test_grid_of_blocks_and_parts_matches_brute_force(spark):
    c, j, cands, jobs = frames(spark)
    got = sorted(tuple(r) for r in R.recommend_topk(c, j, k=3, block_size=4, broadcast_bytes=0, part_rows=7).collect())
    assert got == brute(cands, jobs, 3)


def test_topk_rejects_bad_k(spark):
    c, j, _, _ = frames(spark)
    with pytest.raises(ValueError):
        R.recommend_topk(c, j, k=0)


def test_null_vectors_not_scored(spark):
    c = spark.createDataFrame([(1, None), (2, [1.0, 0.0])], "candidate_id bigint, embedding array<float>")
    j = spark.createDataFrame([(10, [1.0, 0.0])], "codigo_vaga bigint, embedding array<float>")
    assert [r.candidate_id for r in R.recommend_topk(c, j, k=3).collect()] == [2]
    assert [r.candidate_id for r in R.reject_invalid_vectors(c).collect()] == [1]


def test_empty_catalogue(spark):
    c = spark.createDataFrame([(1, [1.0])], "candidate_id bigint, embedding array<float>")
    j = spark.createDataFrame([], "codigo_vaga bigint, embedding array<float>")
    assert R.recommend_topk(c, j).count() == 0


def test_topk_per_group_matches_sorted_slice(spark):
    rng = np.random.default_rng(7)
    rows = [(int(g), int(i), float(rng.integers(0, 5))) for i, g in enumerate(rng.integers(0, 6, 200))]
    rows.append((9, 1000, None))                       # a null score ranks last
    df = spark.createDataFrame(rows, "g int, id int, s double")
    got = sorted(tuple(r) for r in R.topk_per_group(df, "g", "s", k=3, tie="id")
                 .select("g", "rank", "id").collect())
    want = []
    for g in sorted({r[0] for r in rows}):
        grp = sorted((r for r in rows if r[0] == g),
                     key=lambda r: (r[2] is None, -(r[2] or 0), r[1]))[:3]
        want += [(g, i + 1, r[1]) for i, r in enumerate(grp)]
    assert got == sorted(want)


def test_topk_per_group_rejects_bad_k(spark):
    df = spark.createDataFrame([(1, 1.0)], "g int, s double")
    with pytest.raises(ValueError):
        R.topk_per_group(df, "g", "s", k=0)


def test_topk_per_group_hot_group_is_trimmed_before_the_shuffle(spark):
    from pyspark.sql import functions as F
    # group 0 holds a third of all rows
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50 + 1).alias("g"),
        F.col("id"), ((F.col("id") * 7919) % 1000).cast("double").alias("s"))
    top = R.topk_per_group(df, "g", "s", k=2, tie="id")
    hot = [tuple(r) for r in top.where("g = 0").orderBy("rank").select("rank", "id", "s").collect()]
    rows = sorted(((-(i * 7919 % 1000), i) for i in range(0, 3000, 3)))[:2]
    assert hot == [(r + 1, i, float(-neg)) for r, (neg, i) in enumerate(rows)]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def clustered(spark, n=600, d=16, groups=12, seed=3):
    rng = np.random.default_rng(seed)
    hubs = rng.normal(size=(groups, d))
    rows = [(i, [float(np.float32(x)) for x in hubs[i % groups] + 0.15 * rng.normal(size=d)]) for i in range(n)]
    rows += [(n, [0.0] * d), (n + 1, rows[5][1]), (n + 2, rows[5][1])]
    return rows


@pytest.mark.parametrize("broadcast_bytes", [64 << 20, 0])
def test_pruned_search_is_exact(spark, broadcast_bytes):
    jobs = clustered(spark)
    cands = clustered(spark, n=90, seed=4) + [(500, [0.0] * 16), (501, None), (502, [float("nan")] * 16), (503, [])]
    j = spark.createDataFrame(jobs, "codigo_vaga bigint, embedding array<float>")
    c = spark.createDataFrame(cands, "candidate_id bigint, embedding array<float>")
    got = R.recommend_topk(c, j, k=4, block_size=20, clusters=12, broadcast_bytes=broadcast_bytes, part_rows=16)
    assert sorted(tuple(r) for r in got.collect()) == brute(cands[:-3], jobs, 4)


def test_blocks_are_skipped_and_big_clusters_split(spark):
    jobs = clustered(spark)
    j = spark.createDataFrame(jobs, "codigo_vaga bigint, embedding array<float>")
    c = spark.createDataFrame(jobs[:90], "candidate_id bigint, embedding array<float>")
    index = R.prepare_jobs(j, block_size=20, clusters=12)
    assert index.n_blocks >= 600 / 20
    assert max(len(r.ids) for r in index.blocks.select("ids").collect()) <= 2 * 20
    met = R.recommend_topk(c, j, k=3, prepared=index, met="met").agg({"met": "avg"}).first()[0]
    assert met < index.n_blocks / 3


def test_text_keys_and_short_vectors(spark):
    j = spark.createDataFrame([("b", [1.0, 0.0]), ("a", [1.0]), ("c", [0.0, 1.0])], "codigo_vaga string, embedding array<double>")
    c = spark.createDataFrame([("x", [2.0, 0.0])], "candidate_id string, embedding array<double>")
    for limit in (64 << 20, 0):
        got = [tuple(r) for r in R.recommend_topk(c, j, k=2, broadcast_bytes=limit).collect()]
        assert sorted(got) == [("x", 1, "a", 1.0), ("x", 2, "b", 1.0)]


def test_one_candidate_needs_no_join_and_no_window(spark):
    c, j, cands, jobs = frames(spark)
    for cid, v in cands[:4]:
        found = R.recommend_one([float(x) for x in v], j, k=3)
        assert [(cid, *r) for r in map(tuple, found.collect())] == brute([(cid, v)], jobs, 3)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in text and "Join" not in text and "Window" not in text
    assert R.recommend_one([0.0] * 8, j, k=2).collect()[0]["similaridade"] == 0.0
    for bad in ([], None, [float("nan")] * 8, [None] * 8):
        assert R.recommend_one(bad, j, k=2).count() == 0


def test_small_blocks_are_met_in_few_products(spark, monkeypatch):
    import numpy as np
    import pyarrow as pa

    from talentmatch.operators import vector_index as VI
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2000, 6))
    jobs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "codigo_vaga long, embedding array<double>")
    index = VI.prepare_jobs(jobs, block_size=4, clusters=8)
    held, calls, real = VI._whole(index), [], VI.best_of
    monkeypatch.setattr(VI, "best_of", lambda q, *a: calls.append(len(q)) or real(q, *a))
    u = VI.unit_rows(x)
    rows, places, sims, met = held.search(u[:50], 3)
    right = np.argsort(-(u[:50] @ u.T), axis=1, kind="stable")[:, :3]
    assert held.names.take(pa.array(places)).to_pylist() == right.ravel().tolist()
    assert 1 <= met.min() and met.max() <= index.n_blocks and index.n_blocks >= 500
    # one for each block that is some row's best, one for all others
    assert len(calls) <= 50 + 1


def test_queries_travel_once_for_each_group_of_blocks(spark, monkeypatch):
    import numpy as np

    from talentmatch.operators import vector_index as VI
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 8))
    jobs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "codigo_vaga long, embedding array<double>")
    cands = jobs.withColumnRenamed("codigo_vaga", "candidate_id")
    seen = []
    real = type(jobs).mapInArrow
    monkeypatch.setattr(type(jobs), "mapInArrow", lambda df, *a, **k: (lambda out: seen.append(out) or out)(real(df, *a, **k)))
    monkeypatch.setattr(VI, "GROUP_BYTES", 20_000)
    got = R.recommend_topk(cands, jobs, k=3, block_size=8, clusters=4, broadcast_bytes=0, part_rows=16)
    found = {(r["candidate_id"], r["rank"]): r["codigo_vaga"] for r in got.collect()}
    u = VI.unit_rows(x)
    right = np.argsort(-(u @ u.T), axis=1, kind="stable")[:, :3]
    assert found == {(i, n + 1): int(j) for i, row in enumerate(right) for n, j in enumerate(row)}
    packs = [d for d in seen if "keys" in d.columns]
    groups = len({r["group"] for p in packs for r in p.select("group").collect()})
    assert 2 <= groups <= 6
    # both rounds: as many as queries times groups at most, though there are some 75 blocks
    assert sum(len(r["keys"]) for p in packs for r in p.collect()) <= 600 * groups


def test_products_of_a_pack_are_small(monkeypatch):
    import tracemalloc

    from talentmatch.operators import vector_index as VI
    rng = np.random.default_rng(5)
    q, u = VI.unit_rows(rng.normal(size=(1000, 8))), VI.unit_rows(rng.normal(size=(4096, 8)))
    tracemalloc.start()
    found = VI.leading(*VI.best_of(q, u, 3), 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 32 << 20
    right = np.argsort(-(q @ u.T), axis=1, kind="stable")[:, :3]
    assert found[1].tolist() == right.ravel().tolist()
    floor = np.full(len(q), 0.9)
    rows, cols, _ = VI.best_of(q, u, 3, floor)
    assert set(zip(*np.nonzero(q @ u.T >= 0.9), strict=True)) >= set(zip(rows.tolist(), cols.tolist(), strict=True)) >= {
        (i, int(j)) for i, row in enumerate(right) for j in row if q[i] @ u[j] >= 0.9}


def test_met_blocks_are_counted_past_the_broadcast_limit(spark):
    c, j, cands, jobs = frames(spark, n_c=40, n_j=60)
    c = c.unionAll(c.limit(2))                      # keys may repeat: each row is a candidate
    index = R.prepare_jobs(j, block_size=4, clusters=6)
    sent, held = (R.recommend_topk(c, j, k=3, prepared=index, met="met", broadcast_bytes=b, part_rows=7) for b in (0, 64 << 20))
    assert sent.columns == held.columns
    rows = lambda df: sorted(tuple(r)[:4] for r in df.collect())
    assert rows(sent) == rows(held) and len(rows(sent)) == 42 * 3
    met = [r.met for r in sent.where("rank = 1").collect()]
    assert all(1 <= m <= index.n_blocks for m in met) and len(met) == 42
    # with no threshold to skip by, every block of every group is met
    all_ = R.recommend_topk(c, j, k=len(jobs), prepared=index, met="met", broadcast_bytes=0)
    assert {r.met for r in all_.collect()} == {index.n_blocks} and all_.count() == 42 * len(jobs)
