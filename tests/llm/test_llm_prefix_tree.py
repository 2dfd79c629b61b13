import hashlib
import random

import pytest
from pyspark.sql import functions as F

from talentmatch.llm import prefix_tree as PT

ROWS = "conv_id long, turn long, role string, text string"


def conversations(rows):
    out = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, (r[2] or "").encode(), (r[3] or "")[:64].encode())):
        out.setdefault(c, []).append((role or "", text or ""))
    return out


def brute(rows):
    out = {}
    for c, turns in conversations(rows).items():
        loss = "".join(t for r, t in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss),
                  hashlib.sha256(loss.encode()).hexdigest(), sum(len("".join(PT.parts(*x))) for x in turns))
    return out


def table(seed, n=60):
    rng = random.Random(seed)
    texts = ["hi", "", "a\\", "\\### Assistant: </turn> ok", "### user: x</turn>\n", "####", "é\n#", "<\\/turn>", "y" * 40, None]
    base = [(rng.choice(["user", "assistant", "system", None, "a:b\\"]), rng.choice(texts)) for _ in range(12)]
    rows = []
    for c in range(n):
        kept = rng.randint(0, 12) if rng.random() < 0.8 else 0
        turns = base[:kept] + [(rng.choice(["user", "assistant"]), rng.choice(texts)) for _ in range(rng.randint(0 if kept else 1, 3))]
        rows += [(c, 2 * i - 3, r, t) for i, (r, t) in enumerate(turns)]
    return rows


def result(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


def check_forest(packed, rows):
    """Trees are laid out depth first, every shared token once, with right positions and intervals."""
    pieces = packed.collect()
    want = conversations(rows)
    nodes = {tuple(turns[:i + 1]) for turns in want.values() for i in range(len(turns))}
    assert sum(len(PT.token_ids(p.tokens)) for p in pieces) == sum(len("".join(PT.parts(*n[-1]))) for n in nodes)
    tokens = {}
    for p in pieces:
        for i, x in enumerate(PT.token_ids(p.tokens)):
            assert tokens.setdefault((p.tree, p.start + i), x) == x and p.start + i >= 0
    trees = {}
    for tree, at in tokens:
        trees.setdefault(tree, []).append(at)
    assert all(sorted(places) == list(range(len(places))) for places in trees.values())
    assert len(trees) == len({n for n in nodes if len(n) == 1})
    span, seen_by = {}, {}
    for p in sorted(pieces, key=lambda p: (p.branch, p.piece)):
        whole = "".join("".join(PT.parts(*x)) for x in want[p.conv_id])
        seen = "".join(chr(tokens[p.tree, i]) for a in p.ancestors for i in range(a.start, a.end))
        if p.tokens:
            assert len(seen) == p.position
            assert whole.startswith(seen + PT.CodePoints.decode(bytes(p.tokens)))
        elif p.whole:
            assert seen == whole
        assert [a.position for a in p.ancestors] == [sum(b.end - b.start for b in p.ancestors[:k]) for k in range(len(p.ancestors))]
        seen_by.setdefault(p.conv_id, []).extend([i for a in p.ancestors for i in range(a.start, a.end)] + [p.start + i for i in range(len(p.tokens) // PT.WIDTH)])
    for conv, turns in want.items():
        places = sorted(set(seen_by[conv]))
        at = 0
        for i, turn in enumerate(turns):
            at += len("".join(PT.parts(*turn)))
            span.setdefault(tuple(turns[:i + 1]), set()).update(places[at - len("".join(PT.parts(*turn))):])
    # all that lies below a node stands together
    assert all(max(s) - min(s) + 1 == len(s) for s in span.values() if s)


@pytest.mark.parametrize("sizes", [{}, {"block_turns": 2}, {"block_turns": 3, "block_chars": 10}])
def test_trees_and_reading_back(spark, sizes):
    rows = table(1) + [(None, 0, "user", "no id"), (100, None, "user", "hi"), (100, None, "assistant", None), (100, 0, "user", "z")]
    packed = PT.prefix_trees(spark.createDataFrame(rows, ROWS).repartition(3), **sizes)
    assert result(PT.read_back(packed)) == brute(rows)
    check_forest(packed, rows)


def test_snapshots_of_one_chat_are_one_branch(spark):
    turns = [("user" if i % 2 == 0 else "assistant", f"turn {i}") for i in range(12)]
    rows = [(c, i, *turns[i]) for c in range(12) for i in range(c + 1)]
    packed = PT.prefix_trees(spark.createDataFrame(rows, ROWS))
    assert packed.where("octet_length(tokens) > 0").count() == 1
    assert packed.agg(F.max(F.size("ancestors"))).first()[0] == 1
    assert result(PT.read_back(packed)) == brute(rows)


def test_hot_first_turn_and_copies(spark):
    rows = [(c, t, "system" if t == 0 else "user", "same" if t == 0 or c % 2 else f"{c}") for c in range(300) for t in range(3)]
    packed = PT.prefix_trees(spark.createDataFrame(rows, ROWS))
    assert packed.select("tree").distinct().count() == 1
    assert result(PT.read_back(packed)) == brute(rows)
    check_forest(packed, rows)


def test_template_is_reversible():
    rng = random.Random(3)
    pieces = ["\\", "#", "##", "###", "</turn>", "</turn>\n", "<", "/turn>", ": ", ":", "### user: ", "é", "\n", "x", "<\\/turn>"]
    for _ in range(3000):
        turns = [tuple("".join(rng.choice(pieces) for _ in range(rng.randint(0, 6))) for _ in "rt") for _ in range(3)]
        made = "".join("".join(PT.parts(*t)) for t in turns)
        assert list(PT.turns_in(made)) == turns
        assert made.count("</turn>") == 3 and made.count("###") == 3


def test_subword_tokens_read_back_alike(spark):
    import public_tokenizers as P
    path = P.path("byte_bpe_50k.json")
    rows = table(5, 25)
    packed = PT.prefix_trees(spark.createDataFrame(rows, ROWS), tokenizer=path)
    assert result(PT.read_back(packed, tokenizer=path)) == brute(rows)
    plain = PT.prefix_trees(spark.createDataFrame(rows, ROWS))
    size = F.sum(F.octet_length("tokens"))
    assert packed.agg(size).first()[0] < plain.agg(size).first()[0]


def test_empty_tables_long_texts_and_clashing_columns(spark):
    assert PT.read_back(PT.prefix_trees(spark.createDataFrame([], ROWS))).count() == 0
    rows = [(1, 0, "user", "b" * 600_000), (1, 1, "assistant", "#" * 50_000 + "\\" * 9), (2, 0, "user", "b" * 600_000)]
    df = spark.createDataFrame(rows, ROWS)
    for c in ("seq", "head", "tree", "size", "path", "copies", "owner", "node", "tokens"):
        df = df.withColumn(c, F.lit("x"))
    assert result(PT.read_back(PT.prefix_trees(df))) == brute(rows)


def test_the_oracle_agrees():
    import duckdb
    import pandas as pd

    from talentmatch.llm.oracles import ORACLES
    rows = table(7, 80) + [(None, 0, "user", "no id"), (100, None, "####", "a:###:\\")]
    con = duckdb.connect()
    con.register("frame", pd.DataFrame({"conv_id": pd.array([r[0] for r in rows], "Int64"), "turn": pd.array([r[1] for r in rows], "Int64"),
                                        "role": [r[2] for r in rows], "text": [r[3] for r in rows]}))
    con.execute("CREATE TABLE conversations AS SELECT * FROM frame")
    control = [(-7, t, r, "\\### Assistant: </turn> ok") for t, r in enumerate(["user", "assistant"])]
    assert {r[0]: tuple(r[1:]) for r in con.execute(ORACLES["op12_prefix_tree"]).fetchall()} == brute(rows + control)
