import random
import re

import pytest

from talentmatch.llm import pii as PI

RULES = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    out = []
    for kind, rule in enumerate(RULES):
        for m in re.finditer(rule, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == 1 and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == 2:
                doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
                if not 12 <= len(digits) <= 19 or sum(d - 9 * (d > 9) for d in doubled) % 10:
                    continue
            if kind == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return sorted(out, key=lambda x: (x[1], x[0]))


def test_base_rules_match_plain_regexes():
    rng = random.Random(1)
    for signs in ("ab1.2+-@@.. ()9%_", "0123456789 -+.", "4111 1111-+("):
        for _ in range(20_000):
            text = "".join(rng.choice(signs) for _ in range(rng.randint(0, 40)))
            assert PI.base_spans(text) == brute(text), text


@pytest.mark.parametrize("text, kind, source", [
    ("write john (at) example (dot) com now", "email", "john (at) example (dot) com"),
    ("write john[at]example[dot]com.", "email", "john[at]example[dot]com"),
    ("john at example dot com", "email", "john at example dot com"),
    ("juan arroba correo punto es", "email", "juan arroba correo punto es"),
    ("jоhn@exаmple.com", "email", "jоhn@exаmple.com"),
    ("jo​hn@example.com", "email", "jo​hn@example.com"),
    ("call plus one two zero two five five five zero one two three!", "phone", "plus one two zero two five five five zero one two three"),
    ("card " + "four " + "one " * 15 + "ok", "card", "four " + " ".join(["one"] * 15)),
    ("card four-" + "-".join(["one"] * 15), "card", "four-" + "-".join(["one"] * 15)),
    ("ip one nine two dot one six eight dot zero dot one", "ip", "one nine two dot one six eight dot zero dot one"),
    ("１９２.１６８.0.1", "ip", "１９２.１６８.0.1"),
])
def test_disguises_are_found_at_their_source(text, kind, source):
    base = PI.base_spans(text)
    added = [(PI.KINDS[k], text[a:b]) for k, a, b in PI.disguised_spans(text, base)]
    assert added == [(kind, source)]


@pytest.mark.parametrize("text", ["one two three dogs at home", "meet at noon. dot", "un deux trois", "the point at issue", "", "@", "a @ b"])
def test_clean_texts_stay_clean(text):
    assert PI.base_spans(text) == [] and PI.disguised_spans(text, []) == []


def test_plain_spans_stay_as_they_are():
    text = "a@b.com and c (at) d (dot) org, 10.0.0.1"
    base = PI.base_spans(text)
    assert [(PI.KINDS[k], text[a:b]) for k, a, b in base] == [("email", "a@b.com"), ("ip", "10.0.0.1")]
    assert [text[a:b] for _, a, b in PI.disguised_spans(text, base)] == ["c (at) d (dot) org"]
    assert PI.masked(text) == "[EMAIL] and [EMAIL], [IP]"


def test_long_texts_are_linear():
    for text in ("1" * 300_000, "a" * 300_000, "1." * 150_000, "@" * 100_000, "+1" * 100_000, "one " * 50_000, "a@" * 50_000, "(" * 100_000):
        PI.disguised_spans(text, PI.base_spans(text))


def test_frames(documents):
    rows = [(1, "x a@b.com"), (1, "x a@b.com"), (None, "10.0.0.1"), (3, None), (4, "")]
    got = sorted((r["id"] or 0, [tuple(s) for s in r["base"]], r["added"]) for r in PI.find(documents(rows, extra=True)).collect())
    assert got == [(0, [("ip", 0, 8)], []), (1, [("email", 2, 9)], []), (1, [("email", 2, 9)], []), (3, [], []), (4, [], [])]
    assert sorted((r["text"] is None, r["text"] or "") for r in PI.redact(documents(rows, extra=True)).collect()) == [
        (False, ""), (False, "[IP]"), (False, "x [EMAIL]"), (False, "x [EMAIL]"), (True, "")]
    assert PI.find(documents([])).count() == 0


def test_query_digest(spark):
    import hashlib

    from conftest import SF
    from talentmatch.llm.queries import op5_pii
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in op5_pii(spark, SF).collect():
        spans = brute(docs[r["doc_id"]])
        listed = ",".join(f"{PI.KINDS[k]}:{a}:{b}" for k, a, b in spans)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in PI.KINDS] == [sum(s[0] == i for s in spans) for i in range(4)]
        assert set(listed.split(",")) <= set(r["spans"].split(","))


@pytest.mark.parametrize("text, kind, source", [
    ("call plus 1 202 555 0123", "phone", "plus 1 202 555 0123"),
    ("call +1 (four one five) 555-2671", "phone", "+1 (four one five) 555-2671"),
    ("card 4111 1111 1111 111 one", "card", "4111 1111 1111 111 one"),
    ("card 4111 1111 1111 111-one,", "card", "4111 1111 1111 111-one"),
    ("call +1 202 555 01 two 3", "phone", "+1 202 555 01 two 3"),
    ("call +1 202 555 01 \u017fix 3", "phone", "+1 202 555 01 \u017fix 3"),
])
def test_single_words_among_digits_are_found(text, kind, source):
    base = PI.base_spans(text)
    assert [(PI.KINDS[k], text[a:b]) for k, a, b in PI.disguised_spans(text, base)] == [(kind, source)]
    assert PI.masked(text) == text.replace(source, f"[{kind.upper()}]")


def unfiltered(text, base, monkeypatch):
    with monkeypatch.context() as m:
        m.setattr(PI, "_hinted", lambda _: True)
        return PI.disguised_spans(text, base)


def test_the_filter_hides_nothing_that_the_transducers_find(monkeypatch):
    rng = random.Random(6)
    parts = ["plus", "+1", "+", "one", "One", "\u017fix", "s\u0130x", "zéro", "FÜNF", "two", "(four", "five)", "555", "0123", "2671", "4111", "1111", "10", ".", "-", "(", ")",
             "[at]", "( At )", "at", "@", "dot", "(dot)", "{.}", "punto", "john", "example", "com", "_one", "one_", "uno,", "x"]
    for _ in range(30_000):
        text = "".join(rng.choice(parts) + rng.choice([" ", " ", " ", "", "-", "\n", "\u2003"]) for _ in range(rng.randint(1, 12)))
        assert PI._hinted(text) or not PI._WORDS.search(text), text
        base = PI.base_spans(text)
        assert PI.disguised_spans(text, base) == unfiltered(text, base, monkeypatch), text


def test_the_filter_hides_nothing_in_the_given_texts(spark, monkeypatch):
    from conftest import SF
    for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect():
        base = PI.base_spans(r["text"] or "")
        assert PI.disguised_spans(r["text"] or "", base) == unfiltered(r["text"] or "", base, monkeypatch)


def test_long_runs_of_digits(spark):
    zeros, nines = "0" * 5000, "9" * 5000
    texts = [".".join(zeros + "1" if i == k else "2" for i in range(4)) for k in range(4)]
    texts += [zeros + ".1.2.3", f"{zeros}.{zeros}.{zeros}.{zeros}"]
    bad = [".".join(nines if i == k else "2" for i in range(4)) for k in range(4)] + [f"{zeros}256.1.2.3"]
    df = spark.createDataFrame([(i, f"at {t} x") for i, t in enumerate(texts + bad)], "doc_id long, text string")
    base = {r.id: [(s.kind, s.start, s.end) for s in r.base if s.kind == "ip"] for r in PI.find(df).collect()}
    assert base == {i: [("ip", 3, 3 + len(t))] if i < len(texts) else [] for i, t in enumerate(texts + bad)}
    masked = {r.doc_id: r.text for r in PI.redact(df).collect()}
    assert all(masked[i] == "at [IP] x" for i in range(len(texts)))
    # the same under a disguise
    disguised = f"at {zeros}1 dot 2 dot 3 dot 4 x"
    assert PI.masked(disguised) == "at [IP] x"
