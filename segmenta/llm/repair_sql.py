"""DuckDB SQL for operator 12: damage by a checksum, faults by windows, the programme as a recursion over rows with whole audits."""

from __future__ import annotations

_BLANKS = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"


def _option(state: str, cost: str, initial: str) -> str:
    return f"{{'c': {state}.c + {cost}, 'x': {state}.x || '{initial}'}}"


def _step() -> str:
    """Columns e, s, u, a (start, after s, after u, after a) after one row, before insertions."""
    never = "{'c': 1000000, 'x': ''}"
    more, keep = "5 * r.truncated::INTEGER", "CASE WHEN NOT r.gone AND r.initial = '{}' THEN {} ELSE {} END"
    free = "CASE WHEN r.gone THEN {} ELSE {} END"

    def reroled(state):
        return free.format(never, _option(state, f"1 + {more}", "R"))

    def kept(initial, state):
        return keep.format(initial, _option(state, more, "K"), never)

    return ", ".join([
        f"{_option('e', '2', 'D')} AS e",
        f"least({_option('s', '2', 'D')}, {kept('s', 'e')}) AS s",
        f"least({', '.join([_option('u', '2', 'D'), *(reroled(x) for x in 'esa'), *(kept('u', x) for x in 'esa')])}) AS u",
        f"least({_option('a', '2', 'D')}, {reroled('u')}, {kept('a', 'u')}) AS a"])


def _filled(source: str, *more: str) -> str:
    """``source`` with insertions; ``more`` are columns that stay."""
    keep = "".join(f"{c}, " for c in more)
    inner = f"SELECT {keep}e, s, a, least(u, {', '.join(_option(x, '5', 'I') for x in 'esa')}) AS u FROM ({source})"
    return f"SELECT {keep}e, s, u, least(a, {_option('u', '5', 'I')}) AS a FROM ({inner})"


_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(key, ''), lambda z: ascii(z)::BIGINT)),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)), lambda h, i: CASE WHEN h % 2 = 1 THEN xor(h // 2, 3988292384) ELSE h // 2 END)), 4294967295)"""

_START = "SELECT conv_id, 0::BIGINT AS i, {'c': 0, 'x': ''} AS e, {'c': 1000000, 'x': ''} AS s, {'c': 1000000, 'x': ''} AS u, {'c': 1000000, 'x': ''} AS a FROM convs"

SQL = f"""WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
  FROM conversations)
, hit AS (SELECT *, {_CRC} % 20 AS k FROM given)
, damaged AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN k = 1 THEN '' WHEN k = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN k = 0 THEN 0 WHEN k = 3 THEN 2 ELSE 1 END)) AS copy FROM hit)
, placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text), copy) AS i FROM damaged)
, faults AS (SELECT *, substr(role, 1, 1) AS initial, rtrim(text, {_BLANKS}) AS body, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen FROM placed)
, rows AS (SELECT conv_id, turn, role, text, i, initial, body = '' AS blank, body <> '' AND seen AS duplicate, body = '' OR seen AS gone,
    body <> '' AND NOT seen AND right(body, 1) NOT IN ('.', '!', '?') AS truncated FROM faults)
, convs AS (SELECT DISTINCT conv_id FROM conversations)
, best AS (
  {_filled(_START, 'conv_id', 'i')}
  UNION ALL
  {_filled(f"SELECT b.conv_id, r.i, {_step()} FROM best b JOIN rows r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.i = b.i + 1", 'conv_id', 'i')})
, ended AS (SELECT conv_id, arg_max(least(e, a), i) AS z FROM best GROUP BY conv_id)
, audits AS (SELECT conv_id, z.c AS cost, z.x AS audit FROM ended)
, letters AS (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS p FROM audits)
, edits AS (SELECT conv_id, p, substr(audit, p, 1) AS edit, length(replace(substr(audit, 1, p), 'I', '')) AS i FROM letters)
, lines AS (SELECT d.conv_id, d.edit, r.role, r.text, row_number() OVER (PARTITION BY d.conv_id ORDER BY p) AS j
    FROM edits d LEFT JOIN rows r ON r.conv_id IS NOT DISTINCT FROM d.conv_id AND r.i = d.i AND d.edit <> 'I' WHERE d.edit <> 'D')
, led AS (SELECT *, max(CASE WHEN j = 1 AND edit = 'K' AND role LIKE 's%' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS by_system FROM lines)
, repaired AS (SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (j - by_system) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
    CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY j) AS whole FROM led GROUP BY conv_id)
, pairs AS (SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM rows)
, figures AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank, count_if(duplicate) AS duplicate,
    count_if(truncated) AS truncated, count_if(pair NOT IN ('su', 'ua', 'au')) AS illegal FROM pairs GROUP BY conv_id)
SELECT c.conv_id, {', '.join(f'CAST(coalesce(f.{x}, 0) AS BIGINT) AS {x}' for x in ('gaps', 'blank', 'duplicate', 'truncated', 'illegal'))},
  CAST(t.cost AS BIGINT) AS cost, t.audit, sha256(coalesce(p.whole, '')) AS repaired_sha256
FROM convs c JOIN audits t ON t.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN figures f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN repaired p ON p.conv_id IS NOT DISTINCT FROM c.conv_id"""
