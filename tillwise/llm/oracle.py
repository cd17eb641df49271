"""DuckDB SQL for the queries that SQL can express, written from their
contracts; only parameter values are taken from the operators' settings."""

from __future__ import annotations

from . import mixing, quality_rules

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP1 = r"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, 24 + length(regexp_replace(role, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g'))
              + length(regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g')) AS n,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS no,
         count(*) OVER (PARTITION BY conv_id) AS n_turns
  FROM given),
ends AS (SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY no ROWS UNBOUNDED PRECEDING) AS stop FROM sized)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY no)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY no) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(stop) FILTER (role = 'assistant' OR no = n_turns) AS BIGINT) AS formatted_chars
FROM ends GROUP BY conv_id
"""


def op4(p: quality_rules.Params = quality_rules.Params()) -> str:
    cutoffs = ", ".join(f"('{r.name}', {j}, CAST({c!r} AS DOUBLE))" for r in p.rules for j, c in enumerate(r.cutoffs))
    pairs = " UNION ALL ".join(f"SELECT row, '{r.name}' AS rule, {r.top} AS top, {r.bottom} AS bottom FROM m" for r in p.rules)
    alpha, tests = p.limit / len(p.rules), len(p.rules)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, lang, coalesce(text, '') AS text FROM documents),
w AS (SELECT row, {WORDS} AS w FROM d),
win AS (SELECT row, i, array_to_string(w[i:i + 7], ' ') AS x FROM (SELECT row, w, unnest(range(1, len(w) - 6)) AS i FROM w WHERE len(w) >= 8)),
rep AS (SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, x) AS c FROM win) WHERE c > 1),
cov AS (SELECT row, count(DISTINCT p) AS n FROM (SELECT row, unnest(range(i, i + 8)) AS p FROM rep) GROUP BY row),
lines AS (SELECT row, count(*) - count(DISTINCT line) AS n FROM (SELECT row, unnest(string_split(text, chr(10))) AS line FROM d)
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY row),
m AS (SELECT d.row, d.doc_id, d.lang, CAST(len(w.w) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        coalesce(lines.n, 0) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words
      FROM d JOIN w USING (row) LEFT JOIN cov USING (row) LEFT JOIN lines USING (row)),
b AS (SELECT *, n_words < {p.min_words} OR 100 * n_repeat_words > {p.max_repeat_pct} * n_words AS base_failed FROM m),
pairs AS ({pairs}),
y AS (SELECT doc_id, max(quality) AS quality FROM labels WHERE doc_id IS NOT NULL AND quality IN (0, 1) GROUP BY doc_id),
cut(rule, j, cutoff) AS (VALUES {cutoffs}),
k AS (SELECT lang, rule, j, cutoff, count(*) FILTER (quality = 1) AS n, count(*) FILTER (quality = 0) AS n_bad,
        count(*) FILTER (quality = 1 AND top > cutoff * bottom) AS k, count(*) FILTER (quality = 0 AND top > cutoff * bottom) AS k_bad
      FROM b JOIN y USING (doc_id) JOIN pairs USING (row) JOIN cut USING (rule) WHERE NOT base_failed GROUP BY lang, rule, j, cutoff),
ok AS (SELECT *, list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
             + i * ln({alpha!r}) + (n - i) * ln(1 - {alpha!r})))) AS cdf FROM k WHERE n > 0 AND k + k_bad > 0),
best AS (SELECT lang, rule, arg_max(cutoff, j) AS cutoff FROM ok
         WHERE cdf <= {p.error!r} / ({tests} * (SELECT count(*) FROM (SELECT DISTINCT lang FROM k)))
           AND k_bad * n > {p.gain!r} * k * n_bad GROUP BY lang, rule),
bad AS (SELECT DISTINCT row FROM b JOIN pairs USING (row) JOIN best ON best.rule = pairs.rule AND best.lang IS NOT DISTINCT FROM b.lang
        WHERE top > cutoff * bottom)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND row NOT IN (SELECT row FROM bad) AS kept FROM b
"""


def _inverse(knots) -> str:
    area = [0.0]
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        area.append(area[-1] + (t1 - t0) * (w0 + w1) / 2)
    out = ""
    for i, ((t0, w0), (t1, w1)) in enumerate(zip(knots, knots[1:])):
        rest = f"(x * {area[-1]!r} - {area[i]!r})"
        t = f"{t0!r} + 2.0 * {rest} / ({w0!r} + sqrt({w0 * w0!r} + {2.0 * ((w1 - w0) / (t1 - t0))!r} * {rest}))"
        out += f" WHEN x * {area[-1]!r} < {area[i + 1]!r} THEN {t}" if i + 2 < len(knots) else f" ELSE {t}"
    return f"CASE{out} END" if len(knots) > 2 else out.removeprefix(" ELSE ")


def op9(p: mixing.Params = mixing.Params()) -> str:
    n = len(p.schedules)
    place = " ".join(f"WHEN source_no % {n} = {k} THEN {_inverse(s)}" for k, s in enumerate(p.schedules))
    weights = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(p.weights))
    parts = ", ".join(f"greatest(0, least(size, aim - upto - {c} * source_size))" for c in range(p.max_repeat))
    return rf"""
WITH d AS (SELECT doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS key FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS source_no FROM s0),
s2 AS (SELECT *, CASE source_no % {len(p.weights)} {weights} END AS w, {p.max_repeat} * source_size AS cap FROM s1),
s3 AS (SELECT a.*, (SELECT sum(source_size) FROM s2) - coalesce((SELECT sum(cap) FROM s2 b WHERE b.cap / b.w < a.cap / a.w), 0) AS rest,
              (SELECT sum(w) FROM s2 b WHERE b.cap / b.w >= a.cap / a.w) AS ws FROM s2 a),
lv AS (SELECT coalesce(max(CAST(rest AS DOUBLE) / ws) FILTER (CAST(rest AS DOUBLE) / ws <= cap / w), 0) AS level FROM s3),
s AS (SELECT source, source_no, source_size, least(CAST(cap AS DOUBLE), level * w) AS target FROM s2, lv),
r AS (SELECT d.*, s.source_no, s.source_size, s.target, CAST(round(s.target) AS BIGINT) AS aim,
        CAST(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS upto
      FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
c AS (SELECT *, list_filter([{parts}], lambda v: v > 0) AS copies FROM r),
x AS (SELECT *, (upto + copies[1] / 2) / aim AS x FROM c)
SELECT doc_id, size, source_size, target, CAST(coalesce(list_sum(copies), 0) AS BIGINT) AS taken, CAST(len(copies) AS INTEGER) AS n_copies,
       CASE WHEN len(copies) > 0 THEN CASE {place} END END AS position FROM x
"""
