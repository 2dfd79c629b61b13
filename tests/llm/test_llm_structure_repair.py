import hashlib
import random
import re
import zlib

import pytest

from talentmatch.llm import structure_repair as SR

ROWS = "conv_id long, turn long, role string, text string"


def damaged(rows):
    out = []
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        code = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if code == 0:
            continue
        if code == 1:
            text = ""
        if code == 2:
            text = re.sub("[.!?]", "", text)
        if code == 4:
            role = "user"
        out += [(c, t, role, text)] * (2 if code == 3 else 1)
    return out


def best(turns):
    """(cost, edits) of the cheapest edits, ASCII-least: whole edit strings by (turn, last initial), from the end."""
    shape = {"": "su", "s": "u", "u": "a", "a": "u"}     # initials allowed behind the last one

    # inserts make cycles; relaxing from the end over a bounded number of inserts a gap settles them
    table = {}
    states = ["", "s", "u", "a"]
    for i in range(len(turns), -1, -1):
        now = {}
        for last in states:
            found = [(0, "")] if i == len(turns) and last in ("", "a") else []
            if i < len(turns):
                initial, fault = turns[i]
                c, e = table[i + 1, last]
                found.append((c + 4, "D" + e))
                if fault not in ("blank", "duplicate"):
                    more = 3 * (fault == "truncated")
                    if initial and initial in shape[last]:
                        c, e = table[i + 1, initial]
                        found.append((c + more, "K" + e))
                    for r in "ua":
                        if r in shape[last]:
                            c, e = table[i + 1, r]
                            found.append((c + 3 + more, "R" + e))
            now[last] = min(found, default=(10 ** 9, "~"))
        for _ in range(5):
            for last in states:
                for r in "ua":
                    if r in shape[last]:
                        c, e = now[r]
                        now[last] = min(now[last], (c + 3, "I" + e))
        for last in states:
            table[i, last] = now[last]
    return table[0, ""]


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in damaged(rows) if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3][:64].encode()))
        seen, turns = set(), []
        for _, _, role, text in mine:
            end = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
            fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else ""
            seen.add((role, text))
            turns.append((role[:1] if role[:1] in "sua" else "", fault))
        cost, edits = best(turns)
        made, at, last = [], 0, ""
        for e in edits:
            role = {"": "user", "s": "user", "u": "assistant", "a": "user"}[last]
            if e == "I":
                made.append((role, ""))
            else:
                if e != "D":
                    made.append((role if e == "R" else mine[at][2], mine[at][3]))
                at += 1
            last = made[-1][0][:1] if made else ""
        known = [r[1] for r in mine if r[1] is not None]
        initials = [r[2][:1] for r in mine]
        faults = [f for _, f in turns]
        out[conv] = (max(known) - min(known) + 1 - len(set(known)) if known else 0, faults.count("blank"), faults.count("duplicate"),
                     faults.count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, edits,
                     hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest())
    return out


def table(seed, conversations=60, turns=9):
    rng = random.Random(seed)
    rows = []
    for c in range(conversations):
        for t in range(rng.randint(1, turns)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Yes.", "No", "Hm?", "", " \t\n", None, f"text {c} {t}.", "line\n! ", "é.", " "])
            rows.append((c, t if rng.random() < 0.9 else rng.choice([None, t + 5]), role, text))
    return rows


def result(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


@pytest.mark.parametrize("sizes", [{}, {"block_turns": 2}, {"block_turns": 3, "block_chars": 8}])
def test_repair_matches_brute_force(spark, sizes):
    rows = table(1) + [(None, 0, "user", "null id."), (None, 1, "user", "again.")]
    got = result(SR.repair(SR.damage(spark.createDataFrame(rows, ROWS).repartition(3)), **sizes))
    assert got == brute(rows)


def test_a_hot_conversation_is_cut_into_blocks(spark):
    rng = random.Random(4)
    rows = [(7, t, rng.choice(["user", "assistant"]), rng.choice(["a.", "b.", "c", f"{t}."])) for t in range(700)] + table(2, 20)
    got = result(SR.repair(SR.damage(spark.createDataFrame(rows, ROWS)), block_turns=16))
    assert got == brute(rows)


def test_ties_take_the_ascii_least_edits_and_dropped_conversations_stay(spark):
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    plain = [c for c in range(1000) if all(zlib.crc32(f"{c}:{t}".encode()) % 20 > 4 for t in range(4))][:2]
    rows = [(dropped, 0, "user", "x.")]
    rows += [(plain[0], t, r, f"{t}.") for t, r in enumerate(["user", "user", "assistant", "assistant"])]
    rows += [(plain[1], 0, "assistant", "alone.")]
    got = result(SR.repair(SR.damage(spark.createDataFrame(rows, ROWS))))
    assert got[dropped] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got[plain[0]][5:7] == (6, "KIKKIK")
    assert got[plain[1]][5:7] == (3, "IK")


def test_repaired_turns_are_what_the_hash_says(spark):
    rows = table(3)
    damaged_rows = SR.damage(spark.createDataFrame(rows, ROWS))
    for sizes in ({}, {"block_turns": 2}):
        texts = {}
        for c, position, _, role, text in SR.repaired_turns(damaged_rows, **sizes).collect():
            texts.setdefault(c, {})[position] = f"{role}:{text}"
        for c, r in result(SR.repair(damaged_rows, **sizes)).items():
            made = texts.get(c, {})
            assert sorted(made) == list(range(len(made)))
            assert hashlib.sha256("\n".join(made[k] for k in sorted(made)).encode()).hexdigest() == r[7]


def test_checkpoints_change_nothing():
    rng = random.Random(5)
    for n in (0, 1, 2, 3, 5, 17, 200):
        kinds = bytes(rng.randrange(16) for _ in range(n))
        turns = [("sua"[k % 4] if k % 4 < 3 else "", ["", "truncated", "blank", "duplicate"][k // 4]) for k in kinds]
        edits = SR.tight_edits(kinds)
        assert best(turns)[1].startswith(edits)
        assert set(best(turns)[1][len(edits):]) <= {"I"}
        assert SR.applied(SR.table_of(kinds), SR._END)[0] == best(turns)[0]


def test_empty_extreme_and_clashing(spark):
    assert SR.repair(SR.damage(spark.createDataFrame([], ROWS))).count() == 0
    rows = [(1, -2 ** 63, "user", "a."), (1, 2 ** 63 - 1, "assistant", "b" * 300_000 + ".")]
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, ROWS)
    for c in ("seq", "kinds", "copies", "h", "place", "__code", "whole"):
        df = df.withColumn(c, F.lit("x"))
    got = result(SR.repair(SR.damage(df)))
    want = brute(rows)[1]
    assert got[1][1:] == want[1:] and (got[1][0] - want[0]) % 2 ** 64 == 0


def test_the_oracle_agrees(spark):
    import duckdb
    import pandas as pd

    from talentmatch.llm.oracles import ORACLES
    rows = table(6, 80) + [(None, 0, "user", "null id."), (None, None, None, None)]
    con = duckdb.connect()
    con.register("frame", pd.DataFrame({"conv_id": pd.array([r[0] for r in rows], "Int64"), "turn": pd.array([r[1] for r in rows], "Int64"),
                                        "role": [r[2] for r in rows], "text": [r[3] for r in rows]}))
    con.execute("CREATE TABLE conversations AS SELECT * FROM frame")
    assert {r[0]: tuple(r[1:]) for r in con.execute(ORACLES["op11_structure_repair"]).fetchall()} == brute(rows)
