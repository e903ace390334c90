"""DuckDB SQL for the operators' queries that SQL can express."""

from __future__ import annotations

from covtab.llm import audit, chat, licenses, quality

_STOP = ", ".join("'" + w + "'" for w in sorted(
    {w for words in quality.STOP_WORDS.values() for w in words.split()}))


def _rule(r: quality.Rule) -> str:
    parts = []
    if r.low is not None:
        parts.append(f"100 * {r.numerator} >= {r.low} * {r.denominator}")
    if r.high is not None:
        parts.append(f"100 * {r.numerator} <= {r.high} * {r.denominator}")
    return " AND ".join(parts)


def quality_ctes(source: str) -> str:
    """Common table expressions ending in ``judged``: the counts and verdict
    of every row of ``source`` (a relation with ``rid``, ``doc_id``, ``text``)."""
    n = quality.REPEAT_WINDOW
    return f"""
split AS (
  SELECT rid, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM {source}),
windows AS (
  SELECT rid, i, words[i:i + {n - 1}] AS w
  FROM (SELECT rid, words, unnest(range(1, len(words) - {n - 2})) AS i FROM split
        WHERE len(words) >= {n})),
repeated AS (
  SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) - i AS step
  FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, w) AS times FROM windows)
  WHERE times > 1),
covered AS (
  SELECT rid, CAST(sum(least({n}, coalesce(step, {n}))) AS BIGINT) AS n FROM repeated GROUP BY rid),
counted AS (
  SELECT s.rid, doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT)
           AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         coalesce(c.n, 0) AS n_repeat_words, CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(list_filter(words, lambda w: trim(lower(w), '{quality.STOP_PUNCTUATION}')
                              IN ({_STOP}))) AS BIGINT) AS n_stop_words
  FROM split s LEFT JOIN covered c ON s.rid = c.rid),
based AS (
  SELECT *, n_words < {quality.MIN_WORDS}
            OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM counted),
judged AS (
  SELECT *, NOT base_failed AND {" AND ".join(_rule(r) for r in quality.RULES)} AS kept FROM based)
"""

_FAILS = {"A": f"len(words) < {audit.MIN_WORDS}",
          "B": f"100 * len(list_distinct(words)) < {audit.MIN_DISTINCT_PERCENT} * len(words)",
          "C": "100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > "
               f"{audit.MAX_CAPITAL_PERCENT} * length(text)",
          "D": f"regexp_matches(text, '[{audit.MARKS.decode()}]')",
          "E": "doc_id > first_id"}
_MASK = " + ".join(f"CASE WHEN {_FAILS[f]} THEN {1 << k} ELSE 0 END"
                   for k, f in enumerate(audit.FILTERS))
_STEP = ", ".join(f"CASE WHEN mask & {1 << k} > 0 THEN strpos(filter_order, '{f}') ELSE 9 END"
                  for k, f in enumerate(audit.FILTERS))


def _rows(pairs: tuple[tuple[str, str], ...]) -> str:
    return "VALUES " + ", ".join(f"({k}, '{a}', '{b}')" for k, (a, b) in enumerate(pairs))


_HALF = licenses.BLOCK_WORDS // 2


def _text(s: str) -> str:
    return "'" + s.replace("\n", "' || chr(10) || '") + "'"


_USER_BEFORE, _USER_AFTER = (_text(x) for x in chat.USER_HEAD.split("{}"))


ORACLE: dict[str, str] = {
    "op4_perspective_rotation": f"""
WITH turns AS (
  SELECT row_number() OVER () AS rid, conv_id, turn, coalesce(text, '') AS words,
         CASE WHEN length(trim(role)) > 0 THEN trim(role) ELSE '{chat.UNNAMED}' END AS speaker
  FROM conversations),
people AS (SELECT DISTINCT conv_id, speaker AS perspective FROM turns WHERE speaker <> 'system'),
rendered AS (
  SELECT rid, t.conv_id, perspective, turn, speaker, words, speaker = perspective AS mine,
         CASE WHEN speaker = perspective THEN {_text(chat.ASSISTANT_HEAD)}
              WHEN speaker = 'system' THEN {_text(chat.SYSTEM_HEAD)}
              ELSE {_USER_BEFORE} || speaker || {_USER_AFTER} END || words || {_text(chat.END)}
           AS segment
  FROM turns t JOIN people p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
placed AS (
  SELECT *, row_number() OVER w - 1 AS position,
         CAST(sum(length(segment)) OVER w AS BIGINT) AS stop
  FROM rendered
  WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, words, rid
               ROWS UNBOUNDED PRECEDING))
SELECT conv_id, perspective, position, turn, speaker, segment,
       CAST(stop - length(segment) AS BIGINT) AS "start", stop AS "end",
       CAST(CASE WHEN mine THEN stop - length(words) - {len(chat.END)} ELSE stop END AS BIGINT)
         AS mask_start, stop AS mask_end
FROM placed
""",
    "op10_quality_rules": f"""
WITH numbered AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
{quality_ctes("numbered")}
SELECT doc_id, {", ".join(quality.COUNTS)}, base_failed, kept FROM judged
""",
    "op11_filter_interaction_audit": f"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents),
firsts AS (SELECT text AS same, min(doc_id) AS first_id FROM docs GROUP BY text),
marks AS (
  SELECT doc_id AS id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
         max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
flagged AS (
  SELECT part, {_MASK} AS mask, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
  FROM docs JOIN firsts ON text = same LEFT JOIN marks ON doc_id = id),
weights AS (
  SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
  FROM flagged GROUP BY part, mask),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
fates AS (
  SELECT part, filter_order, mask, n, good, toxic, least({_STEP}) AS gone FROM weights, orders),
steps AS (
  SELECT part, filter_order, step, substr(filter_order, step, 1) AS filter,
         1 << k AS bit, mask, n, good, toxic, gone
  FROM fates, (SELECT unnest([1, 2, 3, 4, 5]) AS step),
       LATERAL (SELECT CAST(strpos('{audit.FILTERS}', substr(filter_order, step, 1)) - 1 AS INTEGER)
                       AS k) step_mask),
counted AS (
  SELECT part, filter_order, step, filter,
         CAST(sum(CASE WHEN gone > step THEN n ELSE 0 END) AS BIGINT) AS kept,
         CAST(sum(CASE WHEN gone = step THEN n ELSE 0 END) AS BIGINT) AS removed,
         CAST(sum(CASE WHEN mask & bit > 0 AND gone < step THEN n ELSE 0 END) AS BIGINT)
           AS redundant,
         CAST(sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
         CAST(sum(CASE WHEN gone = step THEN good ELSE 0 END) AS BIGINT) AS good_lost,
         CAST(sum(CASE WHEN gone = step THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM steps GROUP BY part, filter_order, step, filter)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
FROM counted
""",
    "op12_license_scan": f"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM documents),
phrases AS (
  SELECT string_split(phrase, ' ') AS phrase, label
  FROM ({_rows(licenses.PHRASES)}) p(k, phrase, label)),
templates AS (
  SELECT t, label, unnest(list_distinct(string_split(template, ' '))) AS word,
         len(list_distinct(string_split(template, ' '))) AS size
  FROM ({_rows(licenses.TEMPLATES)}) p(t, label, template)),
placed AS (
  SELECT rid, words, unnest(range(len(words))) AS i FROM docs),
bases AS (
  SELECT rid, i, label FROM placed, phrases
  WHERE words[i + 1] = phrase[1] AND words[i + 1:i + len(phrase)] = phrase),
base AS (
  SELECT rid, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
         list(DISTINCT label) AS labels
  FROM bases GROUP BY rid),
blocks AS (
  SELECT rid, word, unnest(CASE WHEN i < {_HALF} THEN [0]
                                ELSE [i // {_HALF} - 1, i // {_HALF}] END) AS block
  FROM (SELECT rid, i, words[i + 1] AS word FROM placed)
  WHERE word IN (SELECT word FROM templates)),
matches AS (
  SELECT rid, label, count(DISTINCT b.word) AS shared, any_value(size) AS size
  FROM blocks b JOIN templates t ON b.word = t.word GROUP BY rid, block, t, label
  HAVING 100 * count(DISTINCT b.word) >= {licenses.MIN_PERCENT} * any_value(size)),
method AS (
  SELECT rid, max(CAST(shared AS DOUBLE) / size) AS share, list(DISTINCT label) AS labels
  FROM matches GROUP BY rid)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
       CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       first_word, last_word,
       array_to_string(list_sort(coalesce(b.labels, [])), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []),
                                                           coalesce(m.labels, [])))), ',') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0::DOUBLE) END AS score
FROM docs d LEFT JOIN base b ON d.rid = b.rid LEFT JOIN method m ON d.rid = m.rid
""",
}
