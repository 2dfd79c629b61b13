import random
import re

import numpy as np

from talentmatch.llm import near_dedup as ND
from talentmatch.llm.components import components


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(rows, size, percent=80):
    sets = {}
    for i, t in rows:
        w = words(t)
        sets[i] = {tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    up = {i: i for i in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                shared = len(sets[a] & sets[b])
                if 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                    x, y = top(a), top(b)
                    up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), top(i), top(i) == i) for i in ids}


def corpus(seed=3, groups=6, copies=9):
    """Copies of some texts with a few words changed, so that likeness lies on both sides of 0.8."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(30, 120))]
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randint(0, 5)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            rows.append((n, " ".join(text)))
            n += 1
    return rows + [(n, ""), (n + 1, None), (n + 2, "one"), (n + 3, "ONE"), (n + 4, "two words"), (n + 5, " \t ")]


def result(df):
    return {r["id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def test_components_match_brute_force(documents):
    rows = corpus()
    for size in (4, 5):
        assert result(ND.near_duplicates(documents(rows, extra=True), size=size)) == brute(rows, size)


def test_blocks_of_large_buckets_lose_no_link(documents, monkeypatch):
    monkeypatch.setattr(ND, "BLOCK", 4)
    rows = corpus(seed=5, groups=2, copies=40)
    assert result(ND.near_duplicates(documents(rows), size=4)) == brute(rows, 4)


def test_null_ids_repeated_rows_and_empty_tables(documents):
    text = "a b c d e f g h"
    got = ND.near_duplicates(documents([(5, text), (5, text), (None, text), (9, text)]), size=4).collect()
    assert sorted((r["id"] or -1, r["component_id"] or -1, r["kept"]) for r in got) == [(-1, -1, False), (5, 5, True), (5, 5, True), (9, 5, False)]
    assert ND.near_duplicates(documents([]), size=4).count() == 0


def test_chain_of_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 101), (None, 3)]
    got = {r["id"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100}


def test_stars_need_no_round(spark, monkeypatch):
    """What is stars already is returned as it is; every other shape takes rounds, but none after it is stars."""
    from talentmatch.llm import components as C
    rounds = []
    monkeypatch.setattr(C, "_large_star", lambda edges, f=C._large_star: rounds.append(1) or f(edges))
    shapes = [
        ([(1, 2), (3, 1), (2, 1), (1, 3), (1, 1), (None, 1), (2, None), (7, 8)], {2: 1, 3: 1, 8: 7}, 0),  # reversed, repeated, loops, nulls
        ([], {}, 0),
        ([(1, 3), (2, 3)], {2: 1, 3: 1}, 1),  # one node with two smaller ends
        ([(1, 2), (2, 3)], {2: 1, 3: 1}, 1),  # a node that is a smaller and a larger end
    ]
    for edges, want, most in shapes:
        rounds.clear()
        got = [tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()]
        assert sorted(got) == sorted(want.items()) and len(rounds) == most


def test_confirmed_links_are_written_once(documents, monkeypatch):
    names = []
    monkeypatch.setattr(ND, "scratch_path", lambda spark, name, f=ND.scratch_path: names.append(name) or f(spark, name))
    assert result(ND.near_duplicates(documents(corpus()), size=4)) == brute(corpus(), 4)
    assert names.count("links") == 1


def test_signature_agreement_estimates_jaccard():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    a, b = pool[:2000], pool[1000:]
    sig = ND.circulant_minhash(np.concatenate([a, b]), np.array([0, 2000, 4000]), 1024)
    assert abs((sig[0] == sig[1]).mean() - 1000 / 3000) < 0.06


def test_passing_over_loses_nothing_that_the_exact_mode_finds(documents, monkeypatch):
    """Signatures of pairs at the threshold, and both modes on buckets that stars leave open."""
    rng = np.random.default_rng(8)
    bands, rows, trials, lost = ND.BANDS, ND.ROWS, 400, 0
    cut = bands * rows * (0.8 + 0.2 / 256) - ND.PASS_OVER * np.sqrt(bands * rows * 0.8 * 0.2)
    for _ in range(trials):
        union = rng.integers(0, 2 ** 63, 100, dtype=np.uint64)
        a, b = np.unique(union[:90]), np.unique(union[10:])      # 80 of 100 are shared
        sig = ND.circulant_minhash(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), bands * rows) >> np.uint64(56)
        lost += (sig[0] == sig[1]).sum() < cut
    assert lost == 0
    monkeypatch.setattr(ND, "BLOCK", 4)
    corpus_rows = corpus(seed=9, groups=3, copies=30)
    want = brute(corpus_rows, 4)
    assert result(ND.near_duplicates(documents(corpus_rows), size=4, pass_over=None)) == want
    assert result(ND.near_duplicates(documents(corpus_rows), size=4)) == want


def test_scratch_tables_are_removed(spark, documents):
    import os

    from talentmatch import session as S
    since = len(S._SCRATCH)
    out = ND.near_duplicates(documents(corpus()), size=4)
    left = [os.path.basename(p).rsplit("-", 1)[0] for p in S._SCRATCH[since:]]
    assert sorted(left) == ["classes", "roots", "signed"] and out.count() == len(corpus())
