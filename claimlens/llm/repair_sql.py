"""The repair of damaged conversations as SQL: the same dynamic programme, one row of all conversations per recursion step.

CRC-32 is computed bit by bit, because the other engine lacks it; states carry cost, edits and the repaired lines.
"""

SPACE = r"\x20\x09-\x0D"


def least(*ways):
    return f"list_sort([{', '.join(ways)}])[1]"


def way(source, cost, letters, line):
    return f"{{'c': {source}.c + {cost}, 'a': {source}.a || '{letters}', 'r': {source}.r || {line}}}"


USER, ASSISTANT = r"chr(10) || 'user:'", r"chr(10) || 'assistant:'"
GIVEN = "chr(10) || d.role || ':' || d.text"
R_USER, R_ASSISTANT = f"{USER} || d.text", f"{ASSISTANT} || d.text"
FAR = "{'c': 100000, 'a': '', 'r': ''}"


def kept(sources, initial):
    return [f"CASE WHEN NOT must_go AND initial = '{initial}' THEN {way(s, 'cut', 'K', GIVEN)} ELSE {FAR} END" for s in sources]


def given(sources, line):
    return [f"CASE WHEN NOT must_go THEN {way(s, '2 + cut', 'R', line)} ELSE {FAR} END" for s in sources]


def gone(s):
    return way(s, "3", "D", "''")


SQL = f"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY b) AS steps
  FROM range(256) AS t(b)
), named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda ch: CAST(ascii(ch) AS BIGINT)) AS bytes
  FROM conversations
), hashed AS (
  SELECT conv_id, turn, role, text,
         xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bytes), lambda c, x: xor(c >> 8, steps[(xor(c, x) & 255) + 1])), 4294967295) % 20 AS way
  FROM named, crc
), damaged AS (
  SELECT conv_id, CAST(turn AS BIGINT) AS turn, CASE WHEN way = 4 THEN 'user' ELSE role END AS role,
         CASE way WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN way = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM hashed WHERE way <> 0
), numbered AS (
  SELECT conv_id, turn, role, text, left(role, 1) AS initial,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || text), copy) AS n
  FROM damaged
), judged AS (
  SELECT *, NOT regexp_matches(text, '[^{SPACE}]') AS is_blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS again,
         NOT regexp_matches(text, '[.!?][{SPACE}]*\\z') AS is_cut, lag(initial) OVER (PARTITION BY conv_id ORDER BY n) || initial AS pair
  FROM numbered
), d AS (
  SELECT *, is_blank OR again AS must_go, CAST(is_cut AND NOT is_blank AND NOT again AS INTEGER) AS cut FROM judged
), facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(CASE WHEN is_blank THEN 1 END) AS blank,
         count(CASE WHEN again AND NOT is_blank THEN 1 END) AS duplicate, CAST(sum(cut) AS BIGINT) AS truncated,
         count(CASE WHEN pair NOT IN ('su', 'ua', 'au') THEN 1 END) AS illegal, max(n) AS n
  FROM d GROUP BY conv_id
), go AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS n, {{'c': 0, 'a': '', 'r': ''}} AS e, {FAR} AS s, {FAR} AS u, {FAR} AS a FROM facts
  UNION ALL
  SELECT conv_id, n, {gone('e')} AS e,
         {least(gone('s'), *kept(['e'], 's'))} AS s,
         {least(gone('u'), *kept(['e', 's', 'a'], 'u'), *given(['e', 's', 'a'], R_USER))} AS u,
         {least(gone('a'), *kept(['u'], 'a'), *given(['u'], R_ASSISTANT))} AS a
  FROM (
    SELECT d.*, g.e, g.s, {least('g.u', way('g.e', 2, 'I', USER), way('g.s', 2, 'I', USER), way('g.a', 2, 'I', USER))} AS u,
           {least('g.a', way('g.u', 2, 'I', ASSISTANT), way('g.e', 4, 'II', USER + ' || ' + ASSISTANT), way('g.s', 4, 'II', USER + ' || ' + ASSISTANT))} AS a
    FROM go AS g JOIN d ON g.conv_id IS NOT DISTINCT FROM d.conv_id AND d.n = g.n + 1
  ) AS d
), ended AS (
  SELECT go.conv_id, {least('e', 'a', way('u', 2, 'I', ASSISTANT), way('s', 4, 'II', USER + ' || ' + ASSISTANT))} AS best
  FROM go JOIN facts ON go.conv_id IS NOT DISTINCT FROM facts.conv_id AND go.n = facts.n
)
SELECT CAST(c.conv_id AS BIGINT) AS conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(coalesce(best.c, 0) AS BIGINT) AS cost, coalesce(best.a, '') AS audit, sha256(substr(coalesce(best.r, ''), 2)) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS c
LEFT JOIN facts ON c.conv_id IS NOT DISTINCT FROM facts.conv_id LEFT JOIN ended ON c.conv_id IS NOT DISTINCT FROM ended.conv_id
"""
