from __future__ import annotations

from .book import query, table
from .conversation_repair import damage, report

# The SQL walks each conversation with the least (cost, audit, lines) of the four places in the grammar:
# z nothing yet, s behind system, u behind a user, a behind an assistant.
_NEVER = 1000000000


def _way(x: str, cost: int | str, letter: str, line: str = "''") -> str:
    return f"{{'c': {x}.c + {cost}, 'e': {x}.e || '{letter}', 'o': {x}.o || {line}}}"


def _least(*ways: str) -> str:
    return f"list_min([{', '.join(ways)}])"


def _inserted() -> str:
    user = _least("p.u", *(_way(f"p.{x}", 2, "I", "chr(10) || 'user:'") for x in "zsa"))
    pair = _least("p.a", _way(user, 2, "I", "chr(10) || 'assistant:'"))
    return f"{{'z': p.z, 's': p.s, 'u': {user}, 'a': {pair}}}"


def _row() -> str:
    own = "chr(10) || x.role || ':' || x.text"
    stay = {"s": "z", "u": "zsa", "a": "u"}
    places = [f"'z': {_way('p.z', 3, 'D')}"]
    for place, before in stay.items():
        ways = [_way(f"p.{place}", 3, "D")]
        ways += [_way(f"p.{b}", f"(CASE WHEN x.forced OR x.initial <> '{place}' THEN {_NEVER} ELSE x.cut END)", "K", own) for b in before]
        if place != "s":
            name = "user" if place == "u" else "assistant"
            ways += [_way(f"p.{b}", f"(CASE WHEN x.forced THEN {_NEVER} ELSE 2 + x.cut END)", "R", f"chr(10) || '{name}:' || x.text") for b in before]
        places.append(f"'{place}': {_least(*ways)}")
    return "{" + ", ".join(places) + "}"


def _start(cost: int) -> str:
    return f"{{'c': CAST({cost} AS BIGINT), 'e': '', 'o': ''}}"


SQL = rf"""
WITH codes AS (
  SELECT list(list_reduce(range(8), lambda c, k: xor(c >> 1, 3988292384 * (c & 1)), n) ORDER BY n) AS tab FROM (SELECT unnest(range(256)) AS n)),
named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda ch: CAST(ord(ch) AS BIGINT)) AS bytes
  FROM conversations),
part AS (
  SELECT conv_id, turn, role, text,
    xor(list_reduce(bytes, lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) % 20 AS part FROM named, codes),
damaged AS (
  SELECT conv_id, turn, CASE WHEN part = 4 THEN 'user' ELSE role END AS role,
    CASE part WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE part WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM part),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS nr FROM damaged),
marked AS (
  SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY nr) AS seen,
    left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY nr) AS before FROM numbered),
faults AS (
  SELECT *, CASE WHEN body = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM marked),
listed AS (
  SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal,
    list({{'step': 1, 'forced': fault IN ('blank', 'duplicate'), 'cut': CAST(fault = 'truncated' AS BIGINT), 'initial': initial, 'role': role, 'text': text}} ORDER BY nr) AS rows
  FROM faults GROUP BY conv_id),
steps AS (
  SELECT *, flatten(list_transform(list_append(rows, {{'step': 0, 'forced': FALSE, 'cut': CAST(0 AS BIGINT), 'initial': '', 'role': '', 'text': ''}}),
    lambda x: [{{'step': 2, 'forced': FALSE, 'cut': CAST(0 AS BIGINT), 'initial': '', 'role': '', 'text': ''}}, x])) AS todo FROM listed),
walked AS (
  SELECT *, list_reduce(todo, lambda p, x: CASE x.step WHEN 0 THEN p WHEN 2 THEN {_inserted()} ELSE {_row()} END,
    {{'z': {_start(0)}, 's': {_start(_NEVER)}, 'u': {_start(_NEVER)}, 'a': {_start(_NEVER)}}}) AS p FROM steps),
repaired AS (SELECT *, list_min([p.z, p.a]) AS best FROM walked)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.e, '') AS audit, sha256(coalesce(substr(best.o, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN repaired r ON c.conv_id IS NOT DISTINCT FROM r.conv_id
"""


@query("op13_conversation_repair", SQL)
def op13_conversation_repair(spark, sf_dir):
    """Faults, cheapest repair and digest of every conversation, after damage."""
    return report(damage(table(spark, sf_dir, "conversations")))
