"""Conversation structure repair by a checkpointed dynamic program.

A conversation is in shape if its role initials read ``(s?(ua)+)?``. Edits keep a turn (0), give it
the role that is due (3), delete it (4) or insert an empty turn of the role that is due (3); blank
and repeated turns must go, and a truncated turn that stays costs 3 more. Of all cheapest edit
lists the one with the ASCII-least initials (D, I, K, R) is taken; as each state allows one role
only, the initials fix the repaired conversation.

The program has four states (nothing yet, after s, after u, after a) and runs backward: a vector
holds what the rest costs from each state. Vectors are stored at every sqrt(n)-th turn only; the
forward walk recomputes one stretch at a time from its checkpoint, so n turns need sqrt(n) vectors.
A block of turns maps the vector behind it to that before it in (min, +) algebra, by a 4 x 4 table.
A conversation of many blocks is therefore repaired block by block: tables and walks are made by the
blocks' tasks, and only the tables, a few numbers a block, are put together in order.

Defined results: rows are ordered as in ``turns``; null roles and texts are one space; a null id is
a conversation; one without rows (all were dropped) has zeros, an empty audit and the hash of an
empty string; turn numbers of extreme spread give gaps modulo 2^64; an empty table gives no rows;
only the four named columns are read. Texts of any length are read whole. The hash of a conversation
is sequential by nature: its blocks stream through one task, a block in memory at a time.
"""

from __future__ import annotations

import hashlib
import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talentmatch.llm import turns as TU
from talentmatch.session import scratch_path, ship_package

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: States: nothing yet, after s, after u, after a. What an inserted or given role leads to from each.
_DUE = (2, 2, 3, 2)
_ROLE = ("user", "user", "assistant", "user")
#: The cost behind the last turn: inserts that complete the shape.
_END = (0, 2 * INSERT, INSERT, 0)
_FAR = 1 << 60
_SPACE = " \t\n\v\f\r"
#: A turn's kind is its initial's place here plus 4 times its fault.
_INITIALS = {"s": 0, "u": 1, "a": 2}
_FINE, _CUT, _BLANK, _REPEATED = 0, 1, 2, 3


def _moves(kind: int) -> tuple[tuple[tuple[str, int, int], ...], ...]:
    """By state: (edit, cost, next state) of one turn, in ASCII order of the edits."""
    initial, fault = kind % 4, kind // 4
    out = []
    for state in range(4):
        found = [("D", DELETE, state)]
        if fault in (_FINE, _CUT):
            more = TRUNCATED * (fault == _CUT)
            if initial == 0 and state == 0:
                found.append(("K", KEEP + more, 1))
            elif initial == 1 and state != 2:
                found.append(("K", KEEP + more, 2))
            elif initial == 2 and state == 2:
                found.append(("K", KEEP + more, 3))
            found.append(("R", REROLE + more, _DUE[state]))
        out.append(tuple(found))
    return tuple(out)


_MOVES = tuple(_moves(kind) for kind in range(16))


def _before(kind: int, after) -> tuple[int, ...]:
    """The vector before a turn, from that behind it; inserts before the turn are part of it."""
    v = [min(cost + after[t] for _, cost, t in moves) for moves in _MOVES[kind]]
    for _ in range(2):
        v = [min(v[s], INSERT + v[_DUE[s]]) for s in range(4)]
    return tuple(v)


def table_of(kinds: bytes) -> list[int]:
    """The 16 costs of a block, from each state to each state behind its last turn."""
    columns = []
    for t in range(4):
        v = tuple(0 if s == t else _FAR for s in range(4))
        for kind in reversed(kinds):
            v = _before(kind, v)
        columns.append(v)
    return [min(_FAR, columns[t][s]) for s in range(4) for t in range(4)]


def applied(table, after) -> tuple[int, ...]:
    return tuple(min(table[4 * s + t] + after[t] for t in range(4)) for s in range(4))


def tight_edits(kinds: bytes, state: int = 0, behind=_END) -> str:
    """The ASCII-least cheapest walk from ``state``, given the vector behind the last turn. Inserts
    behind the last turn are not part of it."""
    n = len(kinds)
    step = math.isqrt(max(0, n - 1)) + 1
    held = {n: tuple(behind)}
    v = held[n]
    for i in range(n - 1, -1, -1):
        v = _before(kinds[i], v)
        if i % step == 0:
            held[i] = v
    edits = []
    for low in range(0, n, step):
        high = min(low + step, n)
        vectors = [held[high]]
        for i in range(high - 1, low - 1, -1):
            vectors.append(_before(kinds[i], vectors[-1]))
        vectors.reverse()
        for i in range(low, high):
            here, then = vectors[i - low], vectors[i - low + 1]
            while True:
                edit, to = _choice(kinds[i], state, here, then)
                edits.append(edit)
                state = to
                if edit != "I":
                    break
    return "".join(edits)


def _choice(kind: int, state: int, here, then) -> tuple[str, int]:
    for edit, cost, to in _MOVES[kind][state]:
        if edit > "I" and here[state] == INSERT + here[_DUE[state]]:
            return "I", _DUE[state]
        if here[state] == cost + then[to]:
            return edit, to
    return "I", _DUE[state]


def closing(state: int) -> int:
    """How many turns are inserted behind the last one."""
    return _END[state] // INSERT


# ---------------------------------------------------------------------------
# Faults
# ---------------------------------------------------------------------------

def _plain_kind(role: str, text: str) -> int:
    """A turn's kind, repeats not looked at."""
    initial = _INITIALS.get(role[:1], 3)
    end = text.rstrip(_SPACE)
    return initial + 4 * (_BLANK if not end else _CUT if end[-1] not in ".!?" else _FINE)


def _digest(role: str, text: str) -> bytes:
    """Told by 128 bits; the role's length keeps it apart from the text."""
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]


def _illegal(before: int, kinds: bytes) -> int:
    """Neighbours whose initials are not su, ua or au; ``before`` is the initial in front (or -1)."""
    bad = 0
    for kind in kinds:
        initial = kind % 4
        bad += before >= 0 and (before, initial) not in ((0, 1), (1, 2), (2, 1))
        before = initial
    return bad


def _gaps(least, most, distinct: int) -> int:
    if least is None:
        return 0
    return (most - least + 1 - distinct + (1 << 63)) % (1 << 64) - (1 << 63)


class _Repaired:
    """What a walk makes of turns: the repaired conversation's hash and, if wanted, its turns."""

    def __init__(self):
        self.sha, self.any, self.state, self.audit = hashlib.sha256(), False, 0, []

    def put(self, role: str, text: str) -> None:
        if self.any:
            self.sha.update(b"\n")
        self.any = True
        self.sha.update(f"{role}:{text}".encode())

    def walk(self, edits: str, roles, texts):
        """Yields (edit, role, text) of each edit, in order; a deleted turn is as it was."""
        at = 0
        for edit in edits:
            if edit == "I":
                made = _ROLE[self.state], ""
            else:
                made = (_ROLE[self.state] if edit == "R" else roles[at]), texts[at]
                at += 1
            if edit != "D":
                initial = _INITIALS.get(made[0][:1], 3)
                self.put(*made)
                self.state = 1 if initial == 0 else 2 if initial == 1 else 3
            yield edit, *made
        self.audit.append(edits)

    def close(self):
        return self.walk("I" * closing(self.state), (), ())


_REPORT = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
                     ("audit", pa.string()), ("repaired_sha256", pa.string())])
REPORT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_TURNS = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
TURNS = "conv_id long, position long, edit string, role string, text string"


def _counts(kinds: bytes) -> list[int]:
    fault = [k // 4 for k in kinds]
    return [fault.count(_BLANK), fault.count(_REPEATED), fault.count(_CUT)]


def _marked(kinds: list[int], first) -> bytes:
    """Kinds with repeats: turns that are not blank and not the first of their digest."""
    return bytes(k if k // 4 == _BLANK or is_first else k % 4 + 4 * _REPEATED for k, is_first in zip(kinds, first, strict=True))


def _whole(report: bool):
    """Conversations that lie within one block each."""
    def solved(batches):
        for batch in batches:
            for conv_id, turns, roles, texts in TU.rows_of(batch, 50):
                seen, first = set(), []
                for row in zip(roles, texts, strict=True):
                    first.append(row not in seen)
                    seen.add(row)
                kinds = _marked([_plain_kind(r, t) for r, t in zip(roles, texts, strict=True)], first)
                edits = tight_edits(kinds)
                out = _Repaired()
                made = [*out.walk(edits, roles, texts), *out.close()]
                if not report:
                    yield from ((conv_id, i, *m) for i, m in enumerate(m for m in made if m[0] != "D"))
                    continue
                known = [t for t in turns if t is not None]
                v = _END
                for kind in reversed(kinds):
                    v = _before(kind, v)
                yield (conv_id, _gaps(min(known, default=None), max(known, default=None), len(set(known))), *_counts(kinds),
                       _illegal(-1, kinds), v[0], "".join(out.audit), out.sha.hexdigest())

    def run(batches):
        yield from TU.record_batches(solved(batches), _REPORT if report else _TURNS)
    return run


# ---------------------------------------------------------------------------
# Conversations of many blocks
# ---------------------------------------------------------------------------

_SEEN = pa.schema([("conv_id", pa.int64()), ("digest", pa.binary()), ("seq", pa.int64()), ("at", pa.int32())])


def _first_seen(batches):
    """Each block's first turn of every digest; blank turns are left out."""
    def rows(batch):
        for conv_id, seq, roles, texts in TU.rows_of(batch, 20):
            seen = set()
            for at, (r, t) in enumerate(zip(roles, texts, strict=True)):
                if _plain_kind(r, t) // 4 != _BLANK and (d := _digest(r, t)) not in seen:
                    seen.add(d)
                    yield conv_id, d, seq, at
    for batch in batches:
        yield from TU.record_batches(rows(batch), _SEEN, 4096)


_FACTS = pa.schema([("conv_id", pa.int64()), ("seq", pa.int64()), ("kinds", pa.binary()), ("costs", pa.list_(pa.int64())),
                    ("first_turn", pa.int64()), ("last_turn", pa.int64()), ("distinct_turns", pa.int64())])
FACTS = "conv_id long, seq long, kinds binary, costs array<long>, first_turn long, last_turn long, distinct_turns long"


def _facts(batches):
    """A block's kinds, its table of costs and its turn numbers (which are in order, nulls first)."""
    def rows(batch):
        for conv_id, seq, turns, roles, texts, first in TU.rows_of(batch, 20):
            there = set(first or ())
            kinds = _marked([_plain_kind(r, t) for r, t in zip(roles, texts, strict=True)], [i in there for i in range(len(roles))])
            known = [t for t in turns if t is not None]
            yield conv_id, seq, kinds, table_of(kinds), min(known, default=None), max(known, default=None), len(set(known))
    for batch in batches:
        yield from TU.record_batches(rows(batch), _FACTS)


_BEHIND = pa.schema([("seq", pa.int64()), ("behind", pa.list_(pa.int64()))])


def _backward(batches):
    """Blocks of whole conversations, last first: the vector behind each."""
    def rows():
        conv, v = TU._NONE, _END
        for batch in batches:
            for conv_id, seq, costs in TU.rows_of(batch):
                if conv is TU._NONE or conv_id != conv:
                    conv, v = conv_id, _END
                yield seq, list(v)
                v = applied(costs, v)
    yield from TU.record_batches(rows(), _BEHIND, 4096)


_WALKS = pa.schema([("seq", pa.int64()), ("walks", pa.list_(pa.string()))])


def _walked(batches):
    """A block's edits from each of the four states."""
    def rows(batch):
        for seq, kinds, behind in TU.rows_of(batch, 20):
            yield seq, [tight_edits(kinds, state, behind) for state in range(4)]
    for batch in batches:
        yield from TU.record_batches(rows(batch), _WALKS)


def _joined(report: bool):
    """Blocks of whole conversations, first first: the walk through all of them."""
    def rows(batches):
        conv, out = TU._NONE, None
        total, position, before, least, most, distinct = [0, 0, 0, 0, 0], 0, -1, None, None, 0

        def ended():
            nonlocal position
            closed = list(out.close())
            if not report:
                for m in closed:
                    yield conv, position, *m
                    position += 1
            else:
                audit = "".join(out.audit)
                yield conv, _gaps(least, most, distinct), *total[:4], total[4] + INSERT * len(closed), audit, out.sha.hexdigest()

        for batch in batches:
            for conv_id, _, roles, texts, kinds, first_turn, last_turn, number, walks in TU.rows_of(batch, 20):
                if conv is TU._NONE or conv_id != conv:
                    if conv is not TU._NONE:
                        yield from ended()
                    conv, out = conv_id, _Repaired()
                    total, position, before, least, most, distinct = [0, 0, 0, 0, 0], 0, -1, None, None, 0
                edits, at = walks[out.state], 0
                for m in out.walk(edits, roles, texts):
                    total[4] += {"D": DELETE, "I": INSERT, "K": KEEP, "R": REROLE}[m[0]]
                    if m[0] in "KR":
                        total[4] += TRUNCATED * (kinds[at] // 4 == _CUT)
                    at += m[0] != "I"
                    if not report and m[0] != "D":
                        yield conv, position, *m
                        position += 1
                for i, c in enumerate(_counts(kinds)):
                    total[i] += c
                total[3] += _illegal(before, kinds)
                before = kinds[-1] % 4 if kinds else before
                if first_turn is not None:
                    distinct += number - (first_turn == most)
                    least, most = first_turn if least is None else least, last_turn
        if conv is not TU._NONE:
            yield from ended()

    def run(batches):
        yield from TU.record_batches(rows(batches), _REPORT if report else _TURNS)
    return run


def _over_blocks(blocks: DataFrame, report: bool) -> DataFrame:
    spark = blocks.sparkSession
    cut = blocks.where("NOT whole")
    seen = cut.select("conv_id", "seq", "roles", "texts").mapInArrow(_first_seen, "conv_id long, digest binary, seq long, at int")
    # the first of equal turns of a conversation; a block then gets the places of its own
    first = (seen.groupBy("conv_id", "digest").agg(F.min(F.struct("seq", "at")).alias("f"))
             .groupBy("f.seq").agg(F.collect_list("f.at").alias("first")))
    path = scratch_path(spark, "repair")
    (cut.select("conv_id", "seq", "turns", "roles", "texts").join(first, "seq", "left")
        .select("conv_id", "seq", "turns", "roles", "texts", "first").mapInArrow(_facts, FACTS).write.parquet(path))
    facts = spark.read.parquet(path)
    behind = (facts.select("conv_id", "seq", "costs").repartition("conv_id").sortWithinPartitions("conv_id", F.desc("seq"))
              .select("conv_id", "seq", "costs").mapInArrow(_backward, "seq long, behind array<long>"))
    walks = (facts.select("seq", "kinds").join(behind, "seq").select("seq", "kinds", "behind")
             .mapInArrow(_walked, "seq long, walks array<string>"))
    rows = (cut.select("conv_id", "seq", "roles", "texts").join(facts.drop("conv_id", "costs"), "seq").join(walks, "seq")
            .repartition("conv_id").sortWithinPartitions("conv_id", "seq"))
    named = rows.select("conv_id", "seq", "roles", "texts", "kinds", "first_turn", "last_turn", "distinct_turns", "walks")
    return named.mapInArrow(_joined(report), REPORT if report else TURNS)


# ---------------------------------------------------------------------------
# The operator
# ---------------------------------------------------------------------------

def _clean(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    return rows.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                       F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"), F.lit(1).alias("copies"))


def damage(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows (conv_id, turn, role, text, copies) with faults put in by crc32 of ``conv_id:turn`` modulo
    20: dropped (0; copies 0), emptied (1), without sentence ends (2), repeated (3), role user (4)."""
    clean = _clean(rows, conv_col, turn_col, role_col, text_col)
    name = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    code = F.crc32(F.concat(name[0], F.lit(":"), name[1]).cast("binary")) % 20
    return clean.withColumn("__code", code).select(
        "conv_id", "turn", F.when(F.col("__code") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("__code").isin(0, 1), "").when(F.col("__code") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("__code") == 0, 0).when(F.col("__code") == 3, 2).otherwise(1).alias("copies"))


def _solve(rows: DataFrame, report: bool, **sizes) -> DataFrame:
    ship_package(rows.sparkSession)
    blocks = TU.blocks(rows, **sizes)
    columns = ["conv_id", "turns", "roles", "texts"]
    whole = blocks.where("whole").select(*columns).mapInArrow(_whole(report), REPORT if report else TURNS)
    return whole.unionAll(_over_blocks(blocks, report))


def repair(rows: DataFrame, **sizes) -> DataFrame:
    """Per conversation of ``rows`` (as ``damage`` or ``turns_of`` gives them): its faults (each row
    counts under its first: blank, duplicate, truncated), gaps in its turn numbers, illegal
    neighbours, the cost of the cheapest edits, their initials and the repaired text's hash."""
    return _solve(rows, True, **sizes)


def repaired_turns(rows: DataFrame, **sizes) -> DataFrame:
    """The repaired conversations, a row per turn: conv_id, position, edit (K, R or I), role, text."""
    return _solve(rows, False, **sizes)


turns_of = _clean
