import hashlib

import numpy as np

from talentmatch.llm import order_minhash as OM


def test_kmers_and_occurrences_match_brute_force():
    text = "abcabcabc déjà vu 𝔘𝔫 abcabc"
    k = 3
    h = OM.kmers(OM.code_points(text), k)
    grams = [text[i:i + k] for i in range(len(text) - k + 1)]
    assert len(h) == len(grams) and len(set(h.tolist())) == len(set(grams))
    assert all((h[i] == h[j]) == (grams[i] == grams[j]) for i in range(len(grams)) for j in range(len(grams)))
    place, value = OM.numbered(h)
    assert sorted(place.tolist()) == list(range(len(grams)))
    # equal hashes only for one k-mer of one number; a k-mer's first has the number 0
    assert len(set(value.tolist())) == len(grams)
    again = OM.numbered(OM.kmers(OM.code_points("abcabc"), k))
    first = dict(zip(place.tolist(), value.tolist(), strict=True))
    assert dict(zip(again[0].tolist(), again[1].tolist(), strict=True))[0] == first[0]


def test_tiles_change_nothing(monkeypatch):
    text = OM.code_points("the quick brown fox jumps over the lazy dog " * 20)
    whole = OM.fingerprint(text)
    monkeypatch.setattr(OM, "_TILE", 7)
    assert (OM.fingerprint(text) == whole).all()


def test_order_matters_and_edits_lower_the_likeness():
    rng = np.random.default_rng(2)
    words = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(300)]
    text = " ".join(words)
    same = OM.fingerprint(OM.code_points(text))
    few = " ".join(words[:100] + ["xxxxxx"] + words[101:])
    half = " ".join(words[150:] + words[:150])
    other = " ".join("".join(rng.choice(list("abcdefgh"), 6)) for _ in range(300))
    near = [OM.likeness(same, OM.fingerprint(OM.code_points(t))) for t in (text, few, half, other)]
    assert near[0] == 1 and near[0] > near[1] > near[2] > near[3] and near[1] > 0.9


def test_edited_neighbours_over_many_ranges(spark, documents):
    rows = [(i, f"document {i} " * (i % 7) + "é𝔘" * (i % 3)) for i in range(200)] + [(500, None), (501, ""), (502, "x"), (700, "x")]
    got = {r["id"]: r for r in OM.compare_edited(documents(rows, extra=True)).collect()}
    assert len(got) == len(rows)
    texts = [t or "" for _, t in rows]
    for n, (i, _) in enumerate(rows):
        own, following = texts[n], texts[(n + 1) % len(rows)]
        cut = len(own) // 2
        changed = own[:len(own) - cut] + following[:cut]
        r = got[i]
        assert r["n_chars"] == len(own)
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        a, b, c = (OM.fingerprint(OM.code_points(t)) for t in (own, changed, following))
        assert (r["fingerprint"], r["edited_fingerprint"]) == (a.tobytes().hex(), b.tobytes().hex())
        assert (r["near_edited"], r["near_next"]) == (OM.likeness(a, b), OM.likeness(a, c))


def test_edge_tables(documents):
    assert OM.compare_edited(documents([])).count() == 0
    one = OM.compare_edited(documents([(1, "abcd")])).collect()
    assert [(r["n_chars"], r["near_next"], r["edited_sha256"]) for r in one] == [(4, 1.0, hashlib.sha256(b"abab").hexdigest())]
    same = OM.compare_edited(documents([(1, "abcdefgh"), (1, "abcdefgh"), (None, "abcdefgh")])).collect()
    assert len(same) == 3 and len({r["fingerprint"] for r in same}) == 1


def test_fingerprints_operator(documents):
    got = {r["id"]: r["fingerprint"] for r in OM.fingerprints(documents([(1, "same text"), (2, "same text"), (3, None)])).collect()}
    assert got[1] == got[2] != got[3] and got[3] == "0000" * OM.COORDINATES
