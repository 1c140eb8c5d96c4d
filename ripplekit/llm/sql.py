"""Checking SQL of the queries that SQL can say, for DuckDB."""

from __future__ import annotations

from ripplekit.llm import conversations as C
from ripplekit.llm.phrases import LEAST, LONGEST, TOP


def phrases_sql() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    grams = "\n      UNION ALL ".join(
        f"SELECT lang, {m} AS m, unnest(list_transform(range(1, len(w) - {m - 2}), lambda i: array_to_string(w[i:i + {m - 1}], ' '))) AS phrase "
        f"FROM pieces WHERE len(w) >= {m}"
        for m in range(1, LONGEST + 1)
    )
    return f"""
    WITH cut AS (
      SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{upper}', '{lower}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
      FROM documents),
    pieces AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM cut),
    totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
    grams AS ({grams}),
    f AS (SELECT lang, m, phrase, count(*) AS f, string_split(phrase, ' ') AS w FROM grams GROUP BY lang, m, phrase HAVING count(*) >= {LEAST}),
    inside AS (
      SELECT lang, f, unnest(flatten(list_transform(range(2, m), lambda k: list_transform(range(1, m - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))))) AS phrase
      FROM f WHERE m > 2),
    hidden AS (SELECT lang, phrase, max(f) AS longer FROM inside GROUP BY lang, phrase),
    candidates AS (
      SELECT f.lang, f.phrase, f.f AS a, unnest(range(1, m)) AS k, w FROM f LEFT JOIN hidden h ON h.lang = f.lang AND h.phrase = f.phrase
      WHERE m > 1 AND coalesce(h.longer, 0) < f.f),
    scored AS (
      SELECT c.lang, c.phrase, c.a, c.k, one.f AS l, two.f AS r, n,
             CAST((1000::HUGEINT * c.a * n) // (one.f::HUGEINT * two.f) AS BIGINT) AS score
      FROM candidates c JOIN totals t ON t.lang = c.lang
      JOIN f one ON one.lang = c.lang AND one.phrase = array_to_string(c.w[1:c.k], ' ')
      JOIN f two ON two.lang = c.lang AND two.phrase = array_to_string(c.w[c.k + 1:], ' ')),
    weakest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS nth FROM scored),
    ranked AS (
      SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
      FROM weakest WHERE nth = 1)
    SELECT * FROM ranked WHERE rank <= {TOP}"""


def conversations_sql() -> str:
    """Every conversation row by row, with the best (cost, audit, text) for each of the four states."""
    ways: dict[int, list[str]] = {e: [] for e in range(4)}
    newline = "chr(10)"
    for begin in range(4):
        state, alive = f"s{begin}", f"s{begin} IS NOT NULL"
        ways[begin].append(
            f"CASE WHEN {alive} THEN {{'c': {state}.c + 4, 'a': {state}.a || 'D', 't': {state}.t}} END"
        )
        at, cost, letters, text = begin, 0, "", ""
        for _ in range(3):
            for sign, end in C.NEXT[at].items():
                to = lambda more, letter, role: (
                    f"{{'c': {state}.c + {cost + more} + CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END, "
                    f"'a': {state}.a || '{letters}{letter}', 't': {state}.t{text} || {newline} || {role} || ':' || text}}"
                )
                able = f"{alive} AND fault NOT IN ('blank', 'duplicate')"
                ways[end].append(f"CASE WHEN {able} AND left(role, 1) = '{sign}' THEN {to(0, 'K', 'role')} END")
                if sign in "ua":
                    named = "'user'" if sign == "u" else "'assistant'"
                    ways[end].append(f"CASE WHEN {able} THEN {to(3, 'R', named)} END")
            sign = "a" if "a" in C.NEXT[at] else "u"
            at, cost, letters = C.NEXT[at][sign], cost + 3, letters + "I"
            text += f" || {newline} || '{'user' if sign == 'u' else 'assistant'}:'"
    best = lambda found: "list_sort(list_filter([" + ", ".join(found) + "], lambda x: x IS NOT NULL))[1]"
    steps = ",\n      ".join(f"{best(ways[e])} AS s{e}" for e in range(4))
    ends = [
        "s0",
        f"CASE WHEN s1 IS NOT NULL THEN {{'c': s1.c + 6, 'a': s1.a || 'II', 't': s1.t || {newline} || 'user:' || {newline} || 'assistant:'}} END",
        f"CASE WHEN s2 IS NOT NULL THEN {{'c': s2.c + 3, 'a': s2.a || 'I', 't': s2.t || {newline} || 'assistant:'}} END",
        "s3",
    ]
    none = "CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, t VARCHAR))"
    spaces = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
    WITH RECURSIVE given AS (
      SELECT conv_id AS conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS mark FROM conversations),
    summed AS (
      SELECT *, xor(list_reduce(list_concat([4294967295], flatten(list_transform(range(1, length(mark) + 1), lambda i:
        list_transform(range(8), lambda b: (CAST(ascii(substr(mark, i, 1)) AS BIGINT) >> b) & 1)))),
        lambda x, y: xor(x >> 1, 3988292384 * (xor(x, y) & 1))), 4294967295) % 20 AS kind FROM given),
    once AS (
      SELECT conv, turn, kind, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
             CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text FROM summed WHERE kind <> 0),
    hurt AS (SELECT * FROM once UNION ALL SELECT * FROM once WHERE kind = 3),
    placed AS (
      SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, sha256(text)) AS pos,
             right(rtrim(text, {spaces}), 1) AS final FROM hurt),
    again AS (SELECT *, row_number() OVER (PARTITION BY conv, role, text ORDER BY pos) AS nth FROM placed),
    numbered AS (
      SELECT *, CASE WHEN final = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN final NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault,
             lag(left(role, 1)) OVER (PARTITION BY conv ORDER BY pos) || left(role, 1) AS pair FROM again),
    counted AS (
      SELECT conv, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps, count(*) AS size,
             count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
             count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
      FROM numbered GROUP BY conv),
    walk AS (
      SELECT conv, CAST(0 AS BIGINT) AS pos, CAST({{'c': 0, 'a': '', 't': ''}} AS STRUCT(c BIGINT, a VARCHAR, t VARCHAR)) AS s0,
             {none} AS s1, {none} AS s2, {none} AS s3 FROM counted
      UNION ALL
      SELECT w.conv, n.pos,
      {steps}
      FROM walk w JOIN numbered n ON n.conv IS NOT DISTINCT FROM w.conv AND n.pos = w.pos + 1),
    done AS (
      SELECT c.*, {best(ends)} AS best FROM counted c JOIN walk w ON w.conv IS NOT DISTINCT FROM c.conv AND w.pos = c.size)
    SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
           coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(best.c, 0) AS BIGINT) AS cost,
           coalesce(best.a, '') AS audit, sha256(coalesce(substr(best.t, 2), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN done d ON d.conv IS NOT DISTINCT FROM o.conv_id"""
