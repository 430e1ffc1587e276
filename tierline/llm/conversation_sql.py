"""Conversation repair in SQL: a walk forward through each conversation, row by row, that keeps the cheapest way into
each state with its whole audit and text. Another method than the operator's, to compare it with."""

from __future__ import annotations

_SQL = r"""
WITH RECURSIVE crc_table AS (SELECT list(list_reduce(list_concat([i], range(8)), lambda c, x: CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)),
named AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
hashed AS (SELECT named.*, xor(4294967295, list_reduce(list_concat([4294967295], list_transform(range(1, length(name) + 1), lambda k: unicode(substr(name, k, 1))::BIGINT)),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))) % 20 AS how FROM named, crc_table),
damaged AS (SELECT conv_id, turn, CASE WHEN how = 4 THEN 'user' ELSE role END AS role,
    CASE how WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE how WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM hashed),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM damaged),
marked AS (SELECT *, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
         WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault FROM placed),
counted AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM marked GROUP BY conv_id),
convs AS (SELECT DISTINCT conv_id FROM conversations),
-- the cheapest way into each state (nothing yet, after system, after user, after assistant), with its audit and what it leaves
walk AS (
  SELECT conv_id, 0::BIGINT AS i, {'c': 0::BIGINT, 'a': '', 'o': NULL::VARCHAR} AS s0, NULL::STRUCT(c BIGINT, a VARCHAR, o VARCHAR) AS s1,
    NULL::STRUCT(c BIGINT, a VARCHAR, o VARCHAR) AS s2, NULL::STRUCT(c BIGINT, a VARCHAR, o VARCHAR) AS s3 FROM convs
  UNION ALL
  SELECT w.conv_id, m.i, {D0}, {BEST1}, {BEST2}, {BEST3}
  FROM ({INSERTED}) w JOIN marked m ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.i = w.i + 1),
last AS (SELECT walk.* FROM walk LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM walk.conv_id WHERE walk.i = coalesce(counted.n, 0)),
done AS (SELECT conv_id, {END} AS s FROM ({INSERTED_LAST}) w)
SELECT done.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, s.c AS cost, s.a AS audit, sha256(coalesce(s.o, '')) AS repaired_sha256
FROM done LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM done.conv_id
"""


def _best(*ways: str) -> str:
    return f"list_sort(list_filter([{', '.join(ways)}], lambda x: x.c IS NOT NULL))[1]"


def _step(s: str, letter: str, cost: str | int, line: str, when: str = "true") -> str:
    left = f"coalesce({s}.o || chr(10), '') || {line}" if line else f"{s}.o"
    return f"CASE WHEN {when} THEN {{'c': {s}.c + {cost}, 'a': {s}.a || '{letter}', 'o': {left}}} END"


def _insert(s: str, role: str) -> str:
    return _step(s, "I", 5, f"'{role}:'")


def _once(source: str) -> str:
    two, three = _best("s2", *(_insert(s, "user") for s in ("s0", "s1", "s3"))), _best("s3", _insert("s2", "assistant"))
    return f"SELECT conv_id, i, s0, s1, {two} AS s2, {three} AS s3 FROM {source}"


def _inserted(source: str) -> str:
    """Up to two rows put in before the next one."""
    return _once(f"({_once(source)})")


_FREE, _BROKEN = "m.fault NOT IN ('blank', 'duplicate')", "CASE m.fault WHEN 'truncated' THEN 5 ELSE 0 END"


def _delete(s: str) -> str:
    return _step(s, "D", 2, "")


def _keep(s: str, initial: str) -> str:
    return _step(s, "K", _BROKEN, "m.role || ':' || m.text", f"{_FREE} AND m.initial = '{initial}'")


def _rename(s: str, role: str) -> str:
    return _step(s, "R", f"1 + {_BROKEN}", f"'{role}:' || m.text", _FREE)


SQL = (
    _SQL.replace("{D0}", _delete("s0"))
    .replace("{BEST1}", _best(_delete("s1"), _keep("s0", "s")))
    .replace("{BEST2}", _best(_delete("s2"), *(way for s in ("s0", "s1", "s3") for way in (_keep(s, "u"), _rename(s, "user")))))
    .replace("{BEST3}", _best(_delete("s3"), _keep("s2", "a"), _rename("s2", "assistant")))
    .replace("{INSERTED}", _inserted("walk"))
    .replace("{INSERTED_LAST}", _inserted("last"))
    .replace("{END}", _best("s0", "s3"))
)
