import random

import numpy as np

from talentmatch.llm import toxicity as TX
from talentmatch.llm.words import ALNUM, chunks, words_of


def brute_segments(scores):
    """Ruzzo and Tompa's definition: the maximal-scoring segment, then the same left and right of it."""
    best = max(((sum(scores[a:b]), -(b - a), -a) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)), default=(0, 0, 0))
    if best[0] <= 0:
        return []
    a = -best[2]
    b = a - best[1]
    left, right = brute_segments(scores[:a]), brute_segments(scores[b:])
    return left + [(best[0], a, b - 1)] + [(s, x + b, y + b) for s, x, y in right]


def test_segments_match_the_definition():
    rng = random.Random(3)
    for _ in range(400):
        scores = [rng.choice([-3, -2, -1, -1, 2, 5]) + rng.random() / 97 for _ in range(rng.randint(0, 12))]
        total, place = np.cumsum(scores), np.flatnonzero(np.array(scores) > 0)
        got = TX.segments(place, np.array(scores)[place], total[place])
        want = brute_segments(scores)
        assert [(a, b) for _, a, b in got] == [(a, b) for _, a, b in want]
        assert np.allclose([s for s, *_ in got], [s for s, *_ in want])


def corpus(n=600, seed=1):
    rng = random.Random(seed)
    clean = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(500)]
    bad = ["zorgul", "xukking"]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 6 == 0
        words = [rng.choice(clean) for _ in range(rng.randint(5, 120))]
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice([rng.choice(bad), "vequ" + rng.choice(clean)]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_accuracy_and_passages(spark, documents):
    rows, labels = corpus()
    frame = spark.createDataFrame([x for x in labels if x[0] % 4], "doc_id long, toxic int")
    docs = documents(rows + [(None, "zorgul"), (1000, None), (1001, ""), (1002, "aa bb zorgul vequnew ." + " c" * 3000), (1002, "hello")], extra=True)
    got = {}
    for r in TX.score(docs, TX.train(docs, frame)).collect():
        got.setdefault(r["id"], []).append(r)
    wrong = [i for i, t in labels if (got[i][0]["score"] >= 0.3) != bool(t)]
    assert len([i for i in wrong if i % 4 == 0]) <= 2 and len(wrong) <= 6
    assert got[None][0]["score"] >= 0.3 and got[1000][0]["score"] == got[1001][0]["score"] < 0.3
    long = max(got[1002], key=lambda r: r["score"])
    assert [(p["start"], p["end"]) for p in long["passages"]] == [(6, 20)]
    assert all(0 <= r["score"] <= 1 for rs in got.values() for r in rs)
    texts = dict(rows)
    for i, rs in got.items():
        for p in rs[0]["passages"]:
            if i in texts:
                assert any(w in texts[i][p["start"]:p["end"]] for w in ("zorgul", "xukking", "vequ"))


def test_filter_keeps_all_columns_and_clean_rows(spark, documents):
    rows, labels = corpus()
    docs = documents(rows, extra=True)
    model = TX.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    kept = TX.without_toxic(docs, model)
    assert kept.schema == docs.schema
    scores = {r["id"]: r["score"] for r in TX.score(docs, model).collect()}
    assert sorted(r["doc_id"] for r in kept.select("doc_id").collect()) == sorted(i for i, s in scores.items() if s < 0.3)


def test_labels_that_teach_nothing(spark, documents):
    docs = documents([(1, "a b"), (2, "c"), (None, None)])
    schema = "doc_id long, toxic int"
    for labels, score in (([], 0.0), ([(1, 0), (2, 0)], 0.0), ([(1, 1), (2, 1)], 1.0), ([(1, None), (None, 1)], 0.0), ([(1, 1), (2, 0)], 0.5)):
        model = TX.train(docs, spark.createDataFrame(labels, schema))
        assert {r["score"] for r in TX.score(docs, model).collect()} == {score}
    assert TX.score(documents([]), model).count() == 0


def test_repeats_and_neighbours_bring_no_evidence():
    model = TX.Model(np.sort(words_hash("bad")), np.array([4.0]), decay=2.0, curve=(-3.0, 2.0))
    scores = [model.token_scores(w) for w in (words("bad bad bad x bad"), words("x"))]
    assert scores[0].tolist() == [4, -1, -1, -1, 4] and scores[1].tolist() == [-1]
    two = list(chunks(__import__("pyarrow").array(["x bad", "bad"])))[0]
    assert model.token_scores(words_of(two[2], two[3], ALNUM)).tolist() == [-1, 4, 4]


def words(text):
    _, _, data, offsets = next(iter(chunks(__import__("pyarrow").array([text]))))
    return words_of(data, offsets, ALNUM)


def words_hash(text):
    return words(text).hash


def test_decay_solves_its_equation():
    values, counts = np.array([-1.0, 2.0]), np.array([900, 100])
    x = TX._decay(values, counts, 2.0)
    assert abs(900 / 1001 * np.exp(-x) + 101 / 1001 * np.exp(2 * x) - 1) < 1e-6


def test_segments_of_long_texts_are_linear():
    import time
    n = 20_000
    place, score = np.arange(n) * 5, np.full(n, 1.0)
    # every left sum is smaller than the one before; then rising ones that never merge
    for total in (-2.0 * np.arange(n), 1e-3 * np.arange(n) + 1.0 - (np.arange(n) % 2) * 1e-2, np.abs(np.arange(n) - n // 2) * -0.5):
        started = time.monotonic()
        found = TX.segments(place, score, total)
        assert time.monotonic() - started < 3 and found == sorted(found, key=lambda x: x[1])


def test_longer_segments_match_the_definition():
    rng = random.Random(8)
    for _ in range(300):
        scores = [rng.choice([-4, -3, -1, -1, 2, 3]) + rng.random() / 97 for _ in range(rng.randint(20, 60))]
        total, place = np.cumsum(scores), np.flatnonzero(np.array(scores) > 0)
        got = TX.segments(place, np.array(scores)[place], total[place])
        assert [(a, b) for _, a, b in got] == [(a, b) for _, a, b in brute_segments(scores)]
