"""SQL that says what the queries of this subpackage return."""

from __future__ import annotations

import string

from promptloom.llm.licences import BLANK, NOTICE, PARAGRAPH_END, RULES, SENTENCE_END, SENTENCES
from promptloom.llm.repetition import LENGTHS, MOST_LINE_PERCENT, MOST_PERCENT, SYMBOLS

WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def _repeated_windows(n: int) -> str:
    return f"""
windows_{n} AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY doc_id, words[i : i + {n - 1}] ORDER BY i) AS turn,
         count(*) OVER (PARTITION BY doc_id, words[i : i + {n - 1}]) AS times
  FROM (SELECT doc_id, words, unnest(generate_series(1, n_words - {n - 1})) AS i FROM texts)),
later_{n} AS (SELECT DISTINCT doc_id, i + k AS i FROM windows_{n}, (SELECT unnest(range({n})) AS k) WHERE turn > 1),
dup_{n} AS (
  SELECT doc_id, CAST(sum(length(words[i])) AS BIGINT) AS dup_chars_{n} FROM later_{n} JOIN texts USING (doc_id)
  GROUP BY doc_id)"""


BASE_SQL = f"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD_PATTERN}') AS words,
         len(words) AS n_words
  FROM documents),
{",".join(map(_repeated_windows, LENGTHS))},
repeats AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM windows_{LENGTHS[0]}, (SELECT unnest(range({LENGTHS[0]})) AS k) WHERE times > 1 GROUP BY doc_id),
lines AS (
  SELECT doc_id, line, count(*) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts)
  WHERE regexp_matches(line, '{WORD_PATTERN}') GROUP BY doc_id, line),
line_sums AS (
  SELECT doc_id, CAST(sum(n - 1) AS BIGINT) AS n_dup_lines, CAST(sum(n * length(line)) AS BIGINT) AS line_chars,
         CAST(sum((n - 1) * length(line)) AS BIGINT) AS dup_line_chars
  FROM lines GROUP BY doc_id),
measured AS (
  SELECT doc_id, CAST(n_words AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^{SYMBOLS}]', '', 'g')) AS BIGINT) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    coalesce(line_chars, 0) AS line_chars, coalesce(dup_line_chars, 0) AS dup_line_chars,
    {", ".join(f"coalesce(dup_chars_{n}, 0) AS dup_chars_{n}" for n in LENGTHS)}
  FROM texts LEFT JOIN repeats USING (doc_id) LEFT JOIN line_sums USING (doc_id)
    {" ".join(f"LEFT JOIN dup_{n} USING (doc_id)" for n in LENGTHS)})
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT base_failed AND dup_line_chars * 100 <= line_chars * {MOST_LINE_PERCENT}
    {" ".join(f"AND dup_chars_{n} * 100 <= word_chars * {most}" for n, most in zip(LENGTHS, MOST_PERCENT, strict=True))}
    AS kept
FROM measured"""

MIXING_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD_PATTERN}')) AS BIGINT) AS size FROM documents),
by_source AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight, source_size * 2 AS most
  FROM by_source),
summed AS (
  SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE AS wanted, CAST(sum(weight) OVER () AS BIGINT) AS weight_all,
    CAST(coalesce(sum(most) OVER before, 0) AS BIGINT) AS most_before,
    CAST(coalesce(sum(weight) OVER before, 0) AS BIGINT) AS weight_before
  FROM weighed
  WINDOW before AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
marked AS (SELECT *, most / weight <= (wanted - most_before) / (weight_all - weight_before) AS is_full FROM summed),
levelled AS (
  SELECT *, wanted - CAST(coalesce(sum(most) FILTER (is_full) OVER (), 0) AS BIGINT) AS rest,
    weight_all - CAST(coalesce(sum(weight) FILTER (is_full) OVER (), 0) AS BIGINT) AS rest_weight
  FROM marked),
targets AS (
  SELECT source, source_size,
    CASE WHEN is_full THEN CAST(most AS DOUBLE) ELSE weight * rest / rest_weight END AS target
  FROM levelled),
rates AS (
  SELECT doc_id, size, source_size, target,
    CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate,
    CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE AS u
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size, source_size, target,
  size * (CAST(floor(rate) AS BIGINT) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS taken
FROM rates"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _licence_sql() -> str:
    forms = ", ".join(f"{_quoted(form)}: {_quoted(name)}" for name, all_forms in SENTENCES.items() for form in all_forms)
    hits = ", ".join(
        f"CASE WHEN contains('|' || sentences || '|', '|{'|'.join(names)}|') "
        f"OR contains('|' || joined_sentences || '|', '|{'|'.join(names)}|') THEN '{licence}' END"
        for licence, names in RULES
    )
    lines = f"regexp_replace(regexp_replace({{}}, '{SENTENCE_END}', chr(10), 'g'), '[^a-z0-9\\n]+', ' ', 'g')"
    known = (
        f"list_filter(list_transform(string_split({lines}, chr(10)), "
        f"lambda x: MAP {{{{{forms}}}}}[regexp_replace(trim(x), '{NOTICE.replace('{', '{{').replace('}', '}}')}', 'under ')]), "
        "lambda x: x IS NOT NULL)"
    )
    joined = f"regexp_replace(regexp_replace(text, '{PARAGRAPH_END}', '.' || chr(10), 'g'), '{BLANK}', ' ', 'g')"
    return f"""
WITH lowered AS (SELECT doc_id, translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS text
  FROM documents),
found AS (
  SELECT doc_id, array_to_string({known.format("text")}, '|') AS sentences,
    array_to_string({known.format(joined)}, '|') AS joined_sentences
  FROM lowered)
SELECT doc_id, sentences, joined_sentences,
  array_to_string(list_sort(list_distinct(list_filter([{hits}], lambda x: x IS NOT NULL))), ';') AS licences,
  CAST(CASE WHEN sentences = '' THEN 0 ELSE length(sentences) - length(replace(sentences, '|', '')) + 1 END AS BIGINT) AS n_known
FROM found"""


LICENCE_SQL = _licence_sql()


def near_duplicate_sql(words: int, percent: int) -> str:
    """Exact links over all pairs of different sets that share a shingle, and their components."""
    return f"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
    '{WORD_PATTERN}') AS w
  FROM documents),
shingled AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {words} THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct(list_transform(generate_series(1, len(w) - {words - 1}),
      lambda i: array_to_string(w[i : i + {words - 1}], ' ')))) END AS s
  FROM texts),
classes AS (SELECT min(doc_id) AS node, md5(array_to_string(s, chr(10))) AS key, any_value(s) AS s, len(any_value(s)) AS n
  FROM shingled WHERE len(s) > 0 GROUP BY array_to_string(s, chr(10))),
items AS (SELECT node, n, unnest(s) AS item FROM classes),
pairs AS (
  SELECT a.node AS a, b.node AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS shared
  FROM items a JOIN items b ON a.item = b.item AND a.node < b.node
    AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * {percent}
  GROUP BY a.node, b.node),
links AS (SELECT a, b FROM pairs WHERE shared * 100 >= (na + nb - shared) * {percent}),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(node, root) AS (
  SELECT node, node FROM classes
  UNION SELECT ways.b, reached.root FROM reached JOIN ways ON reached.node = ways.a WHERE reached.root < ways.b),
roots AS (SELECT node, min(root) AS root FROM reached GROUP BY node)
SELECT doc_id, CAST(len(shingled.s) AS BIGINT) AS n_shingles,
  CASE WHEN len(shingled.s) = 0 THEN doc_id ELSE root END AS component_id, doc_id = component_id AS kept
FROM shingled LEFT JOIN classes ON classes.key = md5(array_to_string(shingled.s, chr(10))) AND len(shingled.s) > 0
  LEFT JOIN roots USING (node)"""


NEAR_DUPLICATE_SQL = near_duplicate_sql(4, 80)


def repeated_span_sql(length: int) -> str:
    """Every string of the length, by its first place; bytes are written as two hexadecimal digits."""
    return f"""
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(length(h) // 2 AS BIGINT) AS n_bytes FROM documents),
strings AS (
  SELECT doc_id, unnest(list_transform(range(n_bytes - {length - 1}),
    lambda p: {{'p': p, 'key': md5(substr(h, 2 * p + 1, {2 * length}))}})) AS s
  FROM texts WHERE n_bytes >= {length}),
later AS (
  SELECT doc_id, p FROM (
    SELECT doc_id, s.p AS p, row_number() OVER (PARTITION BY s.key ORDER BY doc_id, s.p) AS turn FROM strings)
  WHERE turn > 1),
marked AS (
  SELECT doc_id, p, CASE WHEN p - lag(p) OVER w <= {length} THEN 0 ELSE 1 END AS new
  FROM later WINDOW w AS (PARTITION BY doc_id ORDER BY p)),
numbered AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS span FROM marked),
spans AS (SELECT doc_id, span, min(p) AS a, max(p) + {length} AS b FROM numbered GROUP BY doc_id, span),
pieces AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans),
removed AS (
  SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans,
    string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS kept
  FROM pieces JOIN texts USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM texts LEFT JOIN removed USING (doc_id)"""


REPEATED_SPAN_SQL = repeated_span_sql(100)


def _repair_sql() -> str:
    """Damage, faults, then a table of cheapest edits that grows from each conversation's last row."""
    follow = {0: 2, 1: 2, 2: 3, 3: 2}
    other = {0: "user", 1: "user", 2: "assistant", 3: "user"}
    kept = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}

    def edit(cost: str, letter: str, then: str, line: str) -> str:
        text = f"'{chr(10)}' || {line} || {then}.t" if line else f"{then}.t"
        return f"{{'c': {cost} + {then}.c, 'a': '{letter}' || {then}.a, 't': {text}}}"

    def base(state: int) -> str:
        keep = " ".join(
            f"WHEN NOT gone AND initial = '{role}' THEN {edit('extra', 'K', f's{then}', 'line')}" for role, then in kept[state].items()
        )
        rerole = edit("3 + extra", "R", f"s{follow[state]}", f"'{other[state]}:' || text")
        return f"list_min([{edit('4', 'D', f's{state}', '')}, CASE WHEN NOT gone THEN {rerole} END, CASE {keep} END]) AS b{state}"

    def inserted(state: int, source: str) -> str:
        return f"least(b{state}, {edit('3', 'I', source, f"'{other[state]}:'")}) AS s{state}"

    end = [
        "{'c': 0, 'a': '', 't': ''}", f"{{'c': 6, 'a': 'II', 't': '{chr(10)}user:{chr(10)}assistant:'}}",
        f"{{'c': 3, 'a': 'I', 't': '{chr(10)}assistant:'}}", "{'c': 0, 'a': '', 't': ''}",
    ]
    bit = "lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    return rf"""
WITH RECURSIVE crc AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], {bit}) ORDER BY i) AS t FROM range(256) AS r(i)),
given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    hex(encode(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))) AS h
  FROM conversations),
keyed AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(list_concat([4294967295],
    list_transform(range(length(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS rule
  FROM given, crc),
damaged AS (
  SELECT conv_id, turn, CASE WHEN rule = 4 THEN 'user' ELSE role END AS role,
    CASE rule WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM keyed, range(2) AS r(copy) WHERE rule <> 0 AND (copy = 0 OR rule = 3)),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body
  FROM damaged),
faults AS (
  SELECT *, body = '' AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen,
    body = '' OR seen AS gone, NOT gone AND right(body, 1) NOT IN ('.', '!', '?') AS cut, left(role, 1) AS initial,
    lead(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS next_initial
  FROM ordered),
counts AS (
  SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (seen AND NOT blank) AS duplicate, count(*) FILTER (cut) AS truncated,
    count(*) FILTER (next_initial IS NOT NULL AND initial || next_initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM faults GROUP BY conv_id),
steps AS (
  SELECT conv_id, n AS i, {", ".join(f"{value} AS s{state}" for state, value in enumerate(end))} FROM counts
  UNION ALL
  SELECT conv_id, i, {inserted(0, "s2")}, {inserted(1, "s2")}, s2, s3 FROM (
    SELECT conv_id, i, b0, b1, {inserted(2, "b3")}, {inserted(3, "b2")} FROM (
      SELECT conv_id, s.i - 1 AS i, {", ".join(map(base, range(4)))}
      FROM steps s JOIN (
        SELECT conv_id, i, gone, initial, text, role || ':' || text AS line, CASE WHEN cut THEN 3 ELSE 0 END AS extra
        FROM faults) USING (conv_id, i)))),
ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(s0.c, 0) AS BIGINT) AS cost,
  coalesce(s0.a, '') AS audit, sha256(substr(coalesce(s0.t, ''), 2)) AS repaired_sha256
FROM ids LEFT JOIN counts USING (conv_id) LEFT JOIN (SELECT conv_id, s0 FROM steps WHERE i = 0) USING (conv_id)"""


REPAIR_SQL = _repair_sql()
