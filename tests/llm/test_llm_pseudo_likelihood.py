import collections
import random

import numpy as np
import pytest

from talentmatch.llm import pseudo_likelihood as PL
from talentmatch.llm.words import hash_words


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    flat = PL.initial(1).astype(np.float64)
    context, target = rng.integers(0, PL.VOCABULARY + 1, (50, 4)), rng.integers(0, PL.VOCABULARY, 50)
    loss = lambda f: -PL.log_probs(PL.views(f), context, target).mean()
    g = PL.gradients(PL.views(flat), context, target)
    used = np.flatnonzero(np.abs(g) > 1e-3)
    for i in rng.choice(used, 25, replace=False):
        a, b = flat.copy(), flat.copy()
        a[i] += 1e-5
        b[i] -= 1e-5
        assert abs((loss(a) - loss(b)) / 2e-5 - g[i]) < 1e-4


def test_probabilities_sum_to_one():
    flat = PL.initial(2)
    every = np.arange(PL.VOCABULARY)
    context = np.tile([1, 2, PL.VOCABULARY, 700], (len(every), 1))
    assert abs(np.exp(PL.log_probs(PL.views(flat), context, every)).sum() - 1) < 1e-5


def test_windows_stay_in_their_documents():
    context, target, doc = PL.windows([np.array([5, 6, 7]), np.array([], int), np.array([9])])
    p = PL.VOCABULARY
    assert context.tolist() == [[p, p, 6, 7], [p, 5, 7, p], [5, 6, p, p], [p, p, p, p]]
    assert target.tolist() == [5, 6, 7, 9] and doc.tolist() == [0, 0, 0, 2]


def corpus(n=400, seed=1):
    rng = random.Random(seed)
    pairs = [(f"left{i}", f"mid{i}", f"right{i}") for i in range(30)]
    return [(i, " ".join(w for _ in range(40) for w in rng.choice(pairs))) for i in range(n)]


def test_vocabulary_counts_all_documents(documents, monkeypatch):
    rows = corpus(50) + [(100, None), (101, "LEFT1 left1")]
    counted = collections.Counter(w for _, t in rows for w in (t or "").lower().split())
    monkeypatch.setattr(PL, "_GATHERED", 10)
    got = PL.vocabulary(documents(rows), size=20).tolist()
    by = {int(hash_words([w])[0][0]): n for w, n in counted.items()}
    assert len(got) == 20 and [by[h] for h in got] == sorted(by.values(), reverse=True)[:20]


def test_order_is_worth_more_than_its_shuffle(documents):
    rng = random.Random(3)
    rows = corpus()
    tests = []
    for i, t in corpus(20, seed=9):
        words = t.split()
        rng.shuffle(words)
        tests += [(1000 + i, t), (2000 + i, " ".join(words))]
    docs = documents(rows, extra=True)
    encoded = PL.encode(docs, words := PL.vocabulary(docs))
    flat = PL.train(encoded, rounds=2)
    got = {r["id"]: r["mean_log_prob"] for r in PL.score(PL.encode(documents(tests), words), flat).collect()}
    assert all(got[1000 + i] > got[2000 + i] for i in range(20))


def test_edge_rows_and_empty_table(documents):
    rows = corpus(20) + [(None, "left1 mid1"), (50, None), (51, ""), (7, "left1 mid1"), (7, "left1 mid1")]
    got = collections.defaultdict(list)
    for r in PL.pseudo_likelihood(documents(rows)).collect():
        got[r["id"]].append((r["n_words"], r["log_prob"], r["mean_log_prob"]))
    assert got[50] == got[51] == [(0, 0.0, None)]
    assert len({x for x in got[7] if x[0] == 2}) == 1 and got[None][0][1] < 0
    assert PL.pseudo_likelihood(documents([])).count() == 0
    assert [r["n_words"] for r in PL.pseudo_likelihood(documents([(1, ""), (2, None)])).collect()] == [0, 0]


@pytest.mark.parametrize("sent", [0, 1, 1000])
def test_every_word_is_predicted_not_only_its_bucket(documents, sent):
    rng = random.Random(5)
    rare = [f"rare{i}" for i in range(300)]
    rows = [(i, " ".join([*rng.choices(rare[:40], k=6), rare[i], "the", "and"])) for i in range(300)] + [(900, None), (901, "the")]
    docs = documents(rows)
    counted = PL.count_words(docs)
    n = {w: k for t in (t or "" for _, t in rows) for w, k in [(w, 0) for w in t.split()]}
    for _, t in rows:
        for w in (t or "").split():
            n[w] += 1
    words, hashed = PL.most_frequent(counted, 20), {w: h[0] for w, h in zip(n, hash_words(list(n)), strict=True)}
    counts = PL.unigrams(counted, words, sent)
    assert len(counts.sent.words) <= sent and (counts.rest is None) == (sent == 1000)
    encoder, flat = PL.Encoder(words), PL.initial(3)
    number = {w: int(encoder(np.array([h]))[0]) for w, h in hashed.items()}
    total = collections.Counter()
    for w, k in n.items():
        total[number[w]] += k
    tests = [(r[0], r[1]) for r in rows] + [(1000, "the neverseen")]
    got = {r["id"]: r["log_prob"] for r in PL.score(PL.encode(documents(tests), words, counts=counts), flat).collect()}
    for i, t in rows:
        of = (t or "").split()
        want = 0.0
        if of:
            context, target, _ = PL.windows([np.array([number[w] for w in of])])
            want = PL.log_probs(PL.views(flat), context, target).sum()
            want += sum(np.log(n[w] / (total[number[w]] + 1)) for w in of if number[w] >= PL.VOCABULARY - PL.BUCKETS)
        assert abs(got[i] - want) < 1e-3, (i, got[i], want)
    assert got[1000] < -38
    # the counted words of a bucket and one count for all others make up the bucket
    for b in set(number.values()):
        if b >= PL.VOCABULARY - PL.BUCKETS:
            assert abs(sum(k / (total[b] + 1) for w, k in n.items() if number[w] == b) + 1 / (total[b] + 1) - 1) < 1e-12
