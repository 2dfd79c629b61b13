import collections
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from talentmatch.llm import mixing as MX


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 10_000), min_size=1, max_size=30))
def test_targets_share_by_weight_up_to_the_cap(sizes):
    weights = [[3, 1, 2][i % 3] for i in range(len(sizes))]
    t = MX.targets(sizes, weights, 1.5, 2)
    assert abs(sum(t) - 1.5 * sum(sizes)) < 1e-6 * (1 + sum(sizes))
    assert all(x <= 2 * s + 1e-6 for x, s in zip(t, sizes, strict=True))
    open_ = [x / w for x, w, s in zip(t, weights, sizes, strict=True) if s and x < 2 * s - 1e-6]
    assert not open_ or max(open_) - min(open_) < 1e-6 * max(open_)
    full = [x / w for x, w, s in zip(t, weights, sizes, strict=True) if s and x >= 2 * s - 1e-6]
    assert not open_ or not full or max(full) <= min(open_) * (1 + 1e-9)


def test_shards_draw_all_slots_once():
    counts = np.array([1000, 0, 313, 7])
    shards = -(-int(counts.sum()) // 50)
    seen = [set() for _ in counts]
    for k in range(shards):
        first, number = MX.shard_draw(k, shards, int(counts.sum()), counts, 5, per=50)
        assert number.sum() == min(50, counts.sum() - 50 * k)
        for s, (a, n) in enumerate(zip(first, number, strict=True)):
            own = set(range(a, a + n))
            assert not seen[s] & own
            seen[s] |= own
    assert [len(x) for x in seen] == counts.tolist()


def test_draws_beyond_numpys_range_keep_the_totals():
    rng = np.random.default_rng(1)
    counts = np.array([3 * 10**9, 10**9, 5, 0])
    half = MX.split_counts(rng, counts, 2 * 10**9)
    assert half.sum() == 2 * 10**9 and (half <= counts).all() and (half >= 0).all()
    assert abs(half[0] / half[1] - 3) < 0.01


def test_permutations_are_permutations():
    for n in (1, 2, 3, 17, 64, 1000, 4097):
        p = MX.permuted(np.arange(n), n, [1, 2, n])
        assert sorted(p.tolist()) == list(range(n))
        assert (p == np.concatenate([MX.permuted(np.array([i]), n, [1, 2, n]) for i in range(n)])).all()
    assert MX.permuted(np.arange(1000), 1000, [1]).tolist() != MX.permuted(np.arange(1000), 1000, [2]).tolist()


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def corpus():
    rows = [(i, "w " * (i % 400), f"s{i % 4}") for i in range(300)]
    return rows + [(7, "w " * 50, "s1"), (None, "a b c", "s2"), (900, None, "s3"), (901, "", None), (902, "x " * 700, None), (902, "x " * 700, None),
                   (903, "q " * 5, "zz"), (904, "q " * 5000, "\U0001d518"), (905, "q", "￿")]


def test_mix_meets_its_targets(documents):
    rows = corpus()
    mixed, sources = MX.mix(documents(rows, extra=True), block_words=8)
    got = MX.taken(mixed, sources).collect()
    assert len(got) == len(rows)
    assert sorted((r["id"] or -1, r["size"]) for r in got) == sorted((i or -1, size(t)) for i, t, _ in rows)
    assert [s.name for s in sources] == ["s0", "s1", "s2", "s3", "zz", "￿", "\U0001d518", None]
    by = collections.Counter()
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        by[r["source"]] += r["taken"]
    for s in sources:
        assert s.size == sum(size(t) for _, t, name in rows if name == s.name)
        assert abs(by[s.name] - s.target) <= 8 + 0.01 * s.target


def test_slots_hold_the_words_of_their_blocks_and_reruns_agree(documents):
    df = documents(corpus())
    mixed, sources = MX.mix(df, block_words=8)
    rows = mixed.where("shard IS NOT NULL").collect()
    slots = collections.defaultdict(int)
    for r in rows:
        slots[r["shard"], r["position"]] += r["end"] - r["start"]
    assert len(slots) == sum(s.slots for s in sources) and max(slots.values()) == 8
    key = lambda df_: sorted((str(r["id"]), r["sid"], r["start"], r["end"], r["shard"], r["position"]) for r in df_.where("shard IS NOT NULL").collect())
    assert key(mixed) == key(MX.mix(df.repartition(7), block_words=8)[0])


def test_no_broadcast_of_slots(documents):
    mixed, _ = MX.mix(documents(corpus()))
    assert "SortMergeJoin" in mixed._jdf.queryExecution().executedPlan().toString()


def test_empty_tables(documents):
    for rows in ([], [(1, "", "a"), (2, None, None)]):
        mixed, sources = MX.mix(documents(rows))
        assert [r["taken"] for r in MX.taken(mixed, sources).collect()] == [0] * len(rows)
