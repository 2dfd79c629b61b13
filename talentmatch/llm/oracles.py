"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from talentmatch.llm import licenses as LI

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP6 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all({_LOWER.format("text")}, '{_ALNUM}'), []) AS w FROM documents),
b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id,
         coalesce(regexp_extract_all({_LOWER.format("text")}, '{_ALNUM}'), []) AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS phrase
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
        FROM b WHERE len(w) > 0)),
places AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS phrase
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM windows)
        WHERE len(w) >= n)),
hits AS (SELECT p.r, p.i, p.n, x.item_id FROM places p JOIN windows x USING (n, phrase)),
words AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM hits) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, item_id FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""



def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _map(entries: dict[str, str]) -> str:
    return "MAP {" + ", ".join(f"{_quoted(k)}: {_quoted(v)}" for k, v in entries.items()) + "}"


def _op1() -> str:
    """The licence scan: identifiers by sentence, by line where a sentence is unknown, then the rules in order.
    Every text is cut: the operator's gate is not part of it."""
    def normalised(x):
        return f"trim(regexp_replace({x}, '[^a-z0-9]+', ' ', 'g'))"

    def identifier(x):
        return (f"coalesce((SELECT m.s FROM maps m)[{x}], 'REF-' || (SELECT m.n FROM maps m)[regexp_extract({x}, {_quoted(LI.REFERENCE)}, 1)], "
                f"'REF-' || (SELECT m.n FROM maps m)[regexp_extract({x}, {_quoted(LI.TITLE)}, 1)], "
                f"CASE WHEN regexp_matches({x}, {_quoted(LI.COPYRIGHT)}) THEN 'COPYRIGHT' END, "
                f"CASE WHEN regexp_matches({x}, '^[0-9]*$|^[a-z]$') THEN '' ELSE '?' END)")

    matched = "sequence"
    for licence, ids in LI.RULES:
        matched = f"replace({matched}, {_quoted(''.join(f'[{i}]' for i in ids))}, {_quoted('{' + licence + '}')})"
    cut = f"regexp_replace(t, {_quoted(LI.END)}, '\\1\\2' || chr(1), 'g')"
    return rf"""
WITH maps AS MATERIALIZED (SELECT {_map(LI.SENTENCES)} AS s, {_map(LI.NAMES)} AS n),
d AS (SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), '{LI.UPPER}', '{LI.LOWER}') AS t FROM documents),
sentences AS (SELECT r, i, p[i] AS s FROM (SELECT r, p, unnest(range(1, len(p) + 1)) AS i
              FROM (SELECT r, string_split({cut}, chr(1)) AS p FROM d))),
whole AS (SELECT r, i, s, {identifier("n")} AS id FROM (SELECT r, i, s, {normalised("s")} AS n FROM sentences)),
lines AS (SELECT r, i, j, {identifier("n")} AS id
          FROM (SELECT r, i, j, {normalised("p[j]")} AS n
                FROM (SELECT r, i, p, unnest(range(1, len(p) + 1)) AS j FROM (SELECT r, i, string_split(s, chr(10)) AS p FROM whole WHERE id = '?')))),
ids AS (SELECT r, i, 0 AS j, id FROM whole WHERE id <> '?' UNION ALL SELECT r, i, j, id FROM lines),
joined AS (SELECT r, regexp_replace(string_agg('[' || id || ']', '' ORDER BY i, j), '(\[\?\])+', '[?]', 'g') AS q
           FROM ids WHERE id <> '' GROUP BY r),
q AS (SELECT doc_id, CASE WHEN regexp_matches(q, '\[[^?]') THEN q ELSE '' END AS sequence FROM d LEFT JOIN joined USING (r)),
m AS (SELECT doc_id, sequence, {matched} AS matched FROM q)
SELECT doc_id, sequence, array_to_string(regexp_extract_all(matched, '\{{([^}}]+)\}}', 1), ',') AS licences,
       CAST(len(regexp_extract_all(sequence, '\[[^?\]]')) AS BIGINT) AS n_known,
       CAST(len(regexp_extract_all(matched, '\[[^?\]]')) AS BIGINT) AS n_unmatched
FROM m
"""


def _op11() -> str:
    """Damage by a CRC-32 folded over the bytes of ``conv_id:turn``; the cheapest edits by a recursion from
    the last turn on, which holds cost and edits of the rest for each of the four states."""
    table = "list_transform(range(256), lambda i: list_reduce([i] || range(8), lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"
    crc = ("xor(list_reduce([4294967295] || list_transform(string_split(k, ''), lambda x: ord(x)::BIGINT), "
           "lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295)")
    due, keep = (3, 3, 4, 3), ({0: 2, 1: 3}, {1: 3}, {2: 4}, {1: 3})

    def turn(state: int) -> str:
        to = due[state - 1]
        kept = " ".join(f"WHEN f < 2 AND ini = {i} THEN {{'c': v[{t}].c + 3 * f, 's': 'K' || v[{t}].s}}" for i, t in keep[state - 1].items())
        return (f"list_sort(list_filter([{{'c': v[{state}].c + 4, 's': 'D' || v[{state}].s}}, CASE {kept} END, "
                f"CASE WHEN f < 2 THEN {{'c': v[{to}].c + 3 + 3 * f, 's': 'R' || v[{to}].s}} END], lambda x: x IS NOT NULL))[1]")

    def inserted(b: str) -> str:
        return "[" + ", ".join(f"list_sort([{b}[{s}], {{'c': {b}[{d}].c + 3, 's': 'I' || {b}[{d}].s}}])[1]" for s, d in enumerate(due, 1)) + "]"

    return f"""
WITH RECURSIVE tab AS (SELECT {table} AS t),
raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
coded AS (SELECT conv_id, turn, role, text, {crc} % 20 AS code FROM raw, tab),
damaged AS (SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
                   CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(range(0, CASE code WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM coded),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM damaged),
faced AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS seen,
                 rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS ended FROM placed),
kinds AS (SELECT conv_id, i, turn, role, text, CASE left(role, 1) WHEN 's' THEN 0 WHEN 'u' THEN 1 WHEN 'a' THEN 2 ELSE 3 END AS ini,
                 CASE WHEN ended = '' THEN 2 WHEN seen > 1 THEN 3 WHEN right(ended, 1) NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS f FROM faced),
lists AS (SELECT conv_id, count(*) AS n, list(ini ORDER BY i) AS inis, list(f ORDER BY i) AS faults FROM kinds GROUP BY conv_id),
dp AS (
  SELECT conv_id, n AS pos, inis, faults, [{{'c': 0, 's': ''}}, {{'c': 6, 's': 'II'}}, {{'c': 3, 's': 'I'}}, {{'c': 0, 's': ''}}] AS v FROM lists
  UNION ALL
  SELECT conv_id, pos - 1, inis, faults, {inserted("w")}
  FROM (SELECT conv_id, pos, inis, faults, {inserted("b")} AS w
        FROM (SELECT conv_id, pos, inis, faults, [{", ".join(turn(s) for s in (1, 2, 3, 4))}] AS b
              FROM (SELECT *, inis[pos] AS ini, faults[pos] AS f FROM dp WHERE pos > 0)))),
best AS (SELECT conv_id, v[1].c AS cost, v[1].s AS audit FROM dp WHERE pos = 0),
edits AS (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS e FROM best),
walked AS (SELECT conv_id, e, audit[e] AS ch, sum(CASE WHEN audit[e] <> 'I' THEN 1 ELSE 0 END) OVER w AS i,
                  sum(CASE WHEN audit[e] <> 'D' THEN 1 ELSE 0 END) OVER w AS m FROM edits WINDOW w AS (PARTITION BY conv_id ORDER BY e)),
made AS (SELECT x.conv_id, e, ch, m, role, text,
                max(CASE WHEN m = 1 AND ch = 'K' AND ini = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY x.conv_id) AS headed
         FROM walked x LEFT JOIN kinds k ON k.conv_id IS NOT DISTINCT FROM x.conv_id AND k.i = x.i AND ch <> 'I' WHERE ch <> 'D'),
fixed AS (SELECT conv_id, string_agg(CASE WHEN ch = 'K' THEN role WHEN (m - headed) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
                                     CASE WHEN ch = 'I' THEN '' ELSE text END, chr(10) ORDER BY e) AS repaired FROM made GROUP BY conv_id),
pairs AS (SELECT conv_id, lag(ini) OVER (PARTITION BY conv_id ORDER BY i) AS a, ini AS b FROM kinds),
wrong AS (SELECT conv_id, count(*) FILTER (a IS NOT NULL AND (a, b) NOT IN ((0, 1), (1, 2), (2, 1))) AS illegal FROM pairs GROUP BY conv_id),
facts AS (SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (f = 2) AS blank,
                 count(*) FILTER (f = 3) AS duplicate, count(*) FILTER (f = 1) AS truncated FROM kinds GROUP BY conv_id)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN facts ON facts.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN wrong ON wrong.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN fixed ON fixed.conv_id IS NOT DISTINCT FROM c.conv_id
"""


def _op12() -> str:
    """What every conversation's own rows say; the length of its formatted text by counting what is escaped."""
    def escaped(x: str) -> str:
        hashes = f"coalesce(list_sum(list_transform(regexp_extract_all({x}, '#+'), lambda r: (length(r) - 1) // 2)), 0)"
        return f"length({x}) + length({x}) - length(replace({x}, '\\', '')) + (length({x}) - length(replace({x}, '</turn>', ''))) // 7 + {hashes}"

    return rf"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
s AS (SELECT *, length('### : </turn>') + 1 + {escaped("role")} + length(role) - length(replace(role, ':', '')) + {escaped("text")} AS chars FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM s GROUP BY conv_id
"""


ORACLES: dict[str, str] = {"op1_licenses": _op1().strip(), "op6_decontamination": OP6.strip(), "op11_structure_repair": _op11().strip(),
                           "op12_prefix_tree": _op12().strip()}
