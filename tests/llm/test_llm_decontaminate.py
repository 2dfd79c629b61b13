import numpy as np
import hashlib
import random
import re

from talentmatch.llm import decontaminate as DC

LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items, size=10):
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for name, phrase in items:
            p = words(phrase)
            n = min(len(p), size)
            windows = {tuple(p[k:k + n]) for k in range(len(p) - n + 1)} if n else set()
            for k in range(len(w) - n + 1 if n else 0):
                if tuple(w[k:k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found.add(str(name) if name is not None else "")
        out.append((i, len(w), len(hit), sorted(found), bool(hit)))
    return sorted(out, key=str)


def cases():
    rng = random.Random(4)
    v = "the of and Éa x1 zu λόγος a b c d e f".split()
    items = [(k, " ".join(rng.choice(v) for _ in range(n))) for k, n in enumerate((25, 12, 10, 9, 3, 1, 0))] + [(None, "Rare, phrase!"), (8, None)]
    docs = []
    for i in range(30):
        parts = [" ".join(rng.choice(v) for _ in range(rng.randint(0, 40))), rng.choice(items)[1] or "", "RARE\tphrase", rng.choice(v)]
        docs.append((i, " . ".join(rng.sample(parts, rng.randint(0, 4)))))
    return docs + [(None, items[0][1]), (3, items[0][1]), (77, None), (78, ""), (79, " ".join([items[1][1]] * 300))], items


def rows(df):
    return sorted([(r["id"], r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in df.collect()], key=str)


def frame(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_matches_brute_force(spark, documents):
    docs, items = cases()
    assert rows(DC.decontaminate(documents(docs, extra=True), frame(spark, items))) == brute(docs, items)


def test_blocks_of_items_and_small_segments_change_nothing(spark, documents, monkeypatch):
    docs, items = cases()
    monkeypatch.setattr(DC, "SEGMENT_BYTES", 200)
    index = DC.build_index(documents(docs))
    whole = DC.contamination(DC.search(index, frame(spark, items)))
    blocks = DC.contamination(DC.search(index, frame(spark, items), block_chars=40))
    assert rows(whole) == rows(blocks) == brute(docs, items)


def test_whole_items_and_proximity(spark, documents):
    docs = documents([(1, "red x green y blue"), (2, "red green blue"), (3, "blue and green and much much later red"), (4, "green red")])
    items = frame(spark, [(1, "red green blue")])
    index = DC.build_index(docs)
    exact = {r["id"]: [tuple(m) for m in r["matches"]] for r in DC.search(index, items, size=None).collect()}
    assert exact == {1: [], 2: [("1", 0, 3)], 3: [], 4: []}
    near = {r["id"]: [tuple(m) for m in r["matches"]] for r in DC.search(index, items, size=None, slop=2).collect()}
    assert near == {1: [("1", 0, 5)], 2: [("1", 0, 3)], 3: [], 4: []}


def test_empty_tables(spark, documents):
    assert DC.decontaminate(documents([]), frame(spark, [(1, "a")])).count() == 0
    got = DC.decontaminate(documents([(1, "a b")]), frame(spark, [])).collect()
    assert [(r["n_words"], r["n_hit"], r["contaminated"]) for r in got] == [(2, 0, False)]


def test_query_digest(spark):
    from conftest import SF
    from talentmatch.llm.queries import op6_decontamination
    rows_ = op6_decontamination(spark, SF).collect()
    clean = [r for r in rows_ if not r["contaminated"]]
    assert clean and all(r["items_sha256"] == hashlib.sha256(b"").hexdigest() for r in clean)


def brute_near(text, phrase, slop):
    """Words inside the smallest windows around the places of the rarest term."""
    w, p, hit = words(text), words(phrase), set()
    terms = set(p)
    for k in range(len(w)):
        for s, e in sorted(((s, e) for s in range(k + 1) for e in range(k + 1, min(len(w), s + len(p) + slop) + 1) if terms <= set(w[s:e])),
                           key=lambda x: (x[1] - x[0], x[0]))[:1]:
            hit.add((k, s, e))
    return hit


def test_proximity_matches_brute_force_with_neighbours(spark, documents):
    rng = random.Random(11)
    texts = [" ".join(rng.choice("a b c d e f g h".split()) for _ in range(rng.randint(0, 25))) for _ in range(150)]
    # the nearer "b" stands in the next document; the nearest of each term are not the smallest window
    texts += ["x1 o o x2", "x2 x3", "o o o o o o o o y2 o y1 o o y2 y3", ""]
    phrases = ["a b c", "c a", "a b c d", "b b a", "h", "x1 x2", "y1 y2 y3", "z a", "a b c d e f"]
    index = DC.build_index(documents(list(enumerate(texts))).coalesce(1))
    assert index.count() == 1
    count = {t: sum(words(x).count(t) for x in texts) for p in phrases for t in words(p)}
    for slop in (0, 2, 5):
        got = {r["id"]: r["matches"] for r in DC.search(index, frame(spark, list(enumerate(phrases))), size=None, slop=slop).collect()}
        for i, text in enumerate(texts):
            for j, phrase in enumerate(phrases):
                p = words(phrase)
                rarest = min(p, key=lambda t: count[t])
                want = {x for k, s, e in brute_near(text, phrase, slop) if words(text)[k] == rarest for x in range(s, e)}
                assert {x for m in got[i] if m["item_id"] == str(j) for x in range(m["start"], m["end"])} == want, (text, phrase, slop)


def test_phrases_take_little_memory():
    import random
    import tracemalloc
    rng = random.Random(2)
    vocabulary = [f"word{i}" for i in range(50_000)]
    items = [(str(i), " ".join(rng.choice(vocabulary) for _ in range(500))) for i in range(500)]     # 2.4 MB
    tracemalloc.start()
    phrases = DC.Phrases(items, 10)
    held, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(phrases.start) == 500 * 491 and held < 20e6 and peak < 100e6
    p = int(np.flatnonzero(phrases.start == 3)[0])
    want = [int(h) for h in DC.hash_words([" ".join(items[0][1].split()[3:13])], DC.ALNUM)[0]]
    assert phrases.terms[phrases.words(p)].tolist() == want and phrases.items(p).tolist() == [0]


def test_phrases_of_several_items_and_short_ones():
    items = [("a", "one two three"), ("b", "two three"), ("c", None), ("d", "One Two THREE four"), ("e", "x"), ("f", "two three two three")]
    phrases = DC.Phrases(items, 2)
    named = {tuple(phrases.terms[phrases.words(p)].tolist()): phrases.items(p).tolist() for p in range(len(phrases.start))}
    word = {w: int(DC.hash_words([w], DC.ALNUM)[0][0]) for w in "one two three four x".split()}
    pairs = {("one", "two"): [0, 3], ("two", "three"): [0, 1, 3, 5], ("three", "four"): [3], ("x",): [4], ("three", "two"): [5]}
    assert named == {tuple(word[w] for w in k): v for k, v in pairs.items()}
