"""Check SQL of the conversation operators, for DuckDB."""

from __future__ import annotations

SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def crc32(text: str) -> str:
    """The CRC-32 of an expression of ASCII characters, bit by bit."""
    values = f"list_transform(range(1, length({text}) + 1), lambda i: ascii(substr({text}, i, 1))::BIGINT)"
    byte = "list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {values}), lambda c, b: {byte}), 4294967295)"


def _path(cost: str, letter: str, line: str, state: str) -> str:
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'o': {state}.o || {line}}}"


def _insert(role: str, state: str) -> str:
    return _path("5", "I", f"chr(10) || '{role}:'", state)


def _drop(state: str) -> str:
    return _path("2", "D", "''", state)


def _keep(initial: str, state: str) -> str:
    kept = _path("late", "K", "chr(10) || r.role || ':' || r.text", state)
    return f"CASE WHEN NOT gone AND left(r.role, 1) = '{initial}' THEN {kept} ELSE never END"


def _rerole(role: str, state: str) -> str:
    changed = _path("1 + late", "R", f"chr(10) || '{role}:' || r.text", state)
    return f"CASE WHEN NOT gone THEN {changed} ELSE never END"


NEVER = "{'c': 1000000000::BIGINT, 'a': '', 'o': ''}"
#: Costs with their letters and lines are carried forward per state, the least first.
CLOSED = f"""SELECT conv_id, pos, s0 AS t0, s1 AS t1, t2, least(s3, {_insert('assistant', 't2')}) AS t3 FROM (
    SELECT *, least(s2, {_insert('user', 's0')}, {_insert('user', 's1')}, {_insert('user', 's3')}) AS t2 FROM steps)"""

REPAIR = rf"""WITH RECURSIVE known AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations
),
fates AS (SELECT *, {crc32('key')} % 20 AS fate FROM known),
hurt AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN fate = 3 THEN [1, 2] ELSE [1] END) AS nth
  FROM fates WHERE fate <> 0
),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), nth) AS pos FROM hurt),
flagged AS (
  SELECT *, rtrim(text, {SPACES}) AS trimmed, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS again,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) || left(role, 1) AS pair
  FROM placed
),
rows AS MATERIALIZED (
  SELECT conv_id, pos, turn, role, text, pair, trimmed = '' AS blank, trimmed <> '' AND again AS duplicate,
    trimmed <> '' AND NOT again AND right(trimmed, 1) NOT IN ('.', '!', '?') AS truncated, trimmed = '' OR again AS gone,
    CASE WHEN right(trimmed, 1) IN ('.', '!', '?') THEN 0 ELSE 5 END AS late
  FROM flagged
),
steps AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS pos, {{'c': 0::BIGINT, 'a': '', 'o': ''}} AS s0, {NEVER} AS s1, {NEVER} AS s2, {NEVER} AS s3 FROM rows
  UNION ALL
  SELECT r.conv_id, r.pos, {_drop('t0')}, least({_drop('t1')}, {_keep('s', 't0')}),
    least({_drop('t2')}, {', '.join([_keep('u', t) for t in ('t0', 't1', 't3')] + [_rerole('user', t) for t in ('t0', 't1', 't3')])}),
    least({_drop('t3')}, {_keep('a', 't2')}, {_rerole('assistant', 't2')})
  FROM ({CLOSED}) t JOIN (SELECT *, {NEVER} AS never FROM rows) r
    ON r.conv_id IS NOT DISTINCT FROM t.conv_id AND r.pos = t.pos + 1
),
last AS (SELECT conv_id, max(pos) AS pos FROM rows GROUP BY conv_id),
ended AS (
  SELECT t.conv_id, least(t0, t3) AS best FROM ({CLOSED}) t
  JOIN last ON last.conv_id IS NOT DISTINCT FROM t.conv_id AND last.pos = t.pos
),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows GROUP BY conv_id
)
SELECT every.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost,
  coalesce(best.a, '') AS audit, sha256(coalesce(substr(best.o, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) every
LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM every.conv_id
LEFT JOIN ended ON ended.conv_id IS NOT DISTINCT FROM every.conv_id"""

TRIE = rf"""WITH known AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS pos,
    {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS said
  FROM conversations WHERE conv_id IS NOT NULL
),
lists AS (SELECT conv_id, list(said ORDER BY pos) AS turns FROM known GROUP BY conv_id),
shared AS (SELECT *, ({crc32('conv_id::VARCHAR')} % 4)::BIGINT AS h FROM lists),
built AS MATERIALIZED (
  SELECT c.conv_id, list_concat(coalesce(b.turns, [])[1:c.h], c.turns[c.h + 1:]) AS turns
  FROM shared c LEFT JOIN lists b ON b.conv_id = c.conv_id - c.conv_id % 20
),
paths AS (SELECT conv_id, d AS depth, turns[1:d] AS prefix, len(turns) AS length FROM built, unnest(range(len(turns) + 1)) AS u(d)),
nodes AS MATERIALIZED (
  SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    len(regexp_extract_all(coalesce(prefix[depth].text, ''), '[^\x20\x09-\x0D]+')) AS words,
    coalesce(string_agg(CASE WHEN length = depth THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '') AS ends
  FROM paths GROUP BY prefix, depth
),
below AS (
  SELECT n.prefix, n.depth, count(*) FILTER (u.leaf) AS n_leaves, sum((u.n_convs - 1) * u.words) AS saved_tokens
  FROM nodes n JOIN (
    SELECT m.*, NOT EXISTS (SELECT 1 FROM nodes k WHERE k.depth = m.depth + 1 AND k.prefix[1:m.depth] = m.prefix) AS leaf FROM nodes m
  ) u ON u.depth >= n.depth AND u.prefix[1:n.depth] = n.prefix
  GROUP BY n.prefix, n.depth
)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
  (SELECT count(*) FROM nodes k WHERE k.depth = n.depth + 1 AND k.prefix[1:n.depth] = n.prefix)::BIGINT AS n_children,
  b.n_leaves::BIGINT AS n_leaves, b.saved_tokens::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n JOIN below b ON b.depth = n.depth AND b.prefix = n.prefix
LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.prefix = n.prefix[1:p.depth]"""
