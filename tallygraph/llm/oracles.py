"""DuckDB SQL for the queries that SQL can express."""

from tallygraph.llm.licenses import LicenseParams, needed, notice_words
from tallygraph.llm.licenses import PHRASES as LICENSE_PHRASES
from tallygraph.llm.quality import PHRASES

WORD = r"[^\x20\x09-\x0D]+"
WHITE = r"[\x20\x09-\x0D]"

QUALITY = rf"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i
  FROM (SELECT doc_id, regexp_extract_all(text, '{WORD}') AS ws FROM docs)
),
triples AS (
  SELECT doc_id, i, word AS a, lead(word) OVER w AS b, lead(word, 2) OVER w AS c
  FROM words WINDOW w AS (PARTITION BY doc_id ORDER BY i)
),
again AS (
  SELECT doc_id, i FROM triples WHERE c IS NOT NULL
  QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1
),
repeats AS (
  SELECT doc_id, count(DISTINCT i + d) AS n FROM again, (VALUES (0), (1), (2)) AS shift(d) GROUP BY doc_id
),
line_list AS (
  SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM docs)
),
lines AS (
  SELECT *, regexp_replace(line, '^{WHITE}+|{WHITE}+$', '', 'g') AS bare,
    row_number() OVER (PARTITION BY doc_id, line ORDER BY i) AS nth
  FROM line_list
),
measured AS (
  SELECT *, regexp_extract_all(bare, '{WORD}') AS ws, length(regexp_replace(bare, '[^|»›·•]', '', 'g')) AS seps,
    length(regexp_replace(bare, '[^#*$%&|<>]', '', 'g')) AS syms
  FROM lines WHERE bare <> ''
),
judged AS (
  SELECT *, seps >= 3 AND seps * 5 >= len(ws)
    OR {" OR ".join(f"contains(lower(bare), '{p}')" for p in PHRASES)}
    OR len(ws) >= 3 AND (syms * 2 > len(ws)
      OR regexp_matches(bare, '\p{{Lu}}') AND NOT regexp_matches(bare, '\p{{Ll}}'))
    OR len(ws) >= 10 AND len(list_distinct(ws)) < 0.2 * len(ws)
    OR NOT (regexp_matches(bare, '[.!?…:;]["''”’»)\]]*$')
      OR len(ws) >= 20 AND regexp_matches(bare, '[.!?…]["''”’»)\]]* ')) AS fails
  FROM measured
),
per_doc AS (
  SELECT doc_id, count(*) FILTER (nth > 1) AS dup, count(*) FILTER (fails) AS dropped,
    sum(length(bare)) AS chars, coalesce(sum(length(bare)) FILTER (NOT fails), 0) AS kept_chars
  FROM judged GROUP BY doc_id
),
base AS (
  SELECT doc_id, len(regexp_extract_all(text, '{WORD}')) AS n_words,
    length(regexp_replace(text, '{WHITE}', '', 'g')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(r.n, 0) AS n_repeat_words, coalesce(p.dup, 0) AS n_dup_lines, coalesce(p.dropped, 0) AS n_lines_dropped,
    coalesce(p.kept_chars / p.chars, 1.0) AS kept_share
  FROM docs LEFT JOIN repeats r USING (doc_id) LEFT JOIN per_doc p USING (doc_id)
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND kept_share >= 0.5 AS kept,
  n_lines_dropped::BIGINT AS n_lines_dropped, kept_share::DOUBLE AS kept_share
FROM base
"""

EXACT = rf"""
WITH docs AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
    regexp_replace(coalesce(text, ''), '{WHITE}', '', 'g') AS bare
  FROM documents
)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY bare) AS group_size,
  first_value(doc_id) OVER best = doc_id AS kept, sha256(bare) AS text_sha256
FROM docs WINDOW best AS (PARTITION BY bare ORDER BY chars DESC, doc_id)
"""

CHAT = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
),
sized AS (
  SELECT *, length(replace(replace(replace(text, '\', '\\'), '#', '\h'), '</turn>', '\t'))
    + length(replace(replace(replace(replace(role, '\', '\\'), '#', '\h'), '</turn>', '\t'), ':', '\c'))
    + length('### : </turn>') + 1 AS chars
  FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

LINES = rf"""
WITH lines AS (
  SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
),
keyed AS (
  SELECT *, translate(
    regexp_replace(line, '^{WHITE}+|{WHITE}+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'
  ) AS key
  FROM lines
),
shared AS (
  SELECT key, max(doc_id) AS last_id FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
),
marked AS (
  SELECT k.doc_id, k.i, k.line, s.key IS NOT NULL AND k.doc_id <> s.last_id AS gone
  FROM keyed k LEFT JOIN shared s USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

LETTERS_DIGITS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(text: str) -> str:
    return f"translate({text}, '{UPPER}', '{LOWER}')"


# The remainders of all bytes by the reversed polynomial of CRC-32, from which a string's checksum is folded.
CRC_TABLE = """
crc_steps AS (
  SELECT i::BIGINT AS i, 0 AS step, i::BIGINT AS c FROM range(256) AS bytes(i)
  UNION ALL
  SELECT i, step + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END FROM crc_steps WHERE step < 8
),
crc_table AS (SELECT list(c ORDER BY i) AS tab FROM crc_steps WHERE step = 8)
"""


def checksum(text: str) -> str:
    """The unsigned CRC-32 of the UTF-8 of a text, where ``tab`` is in scope."""
    octets = f"list_transform(range(0, length(hex({text})), 2), lambda k: ('0x' || substr(hex({text}), k + 1, 2))::BIGINT)"
    step = "xor(tab[1 + (xor(a, b) & 255)], a // 256)"
    return f"xor(list_reduce(list_prepend(4294967295, {octets}), lambda a, b: {step}), 4294967295)"


def features(source: str, columns: str) -> str:
    """One row per occurrence of a run of one or two words, by whole texts."""
    words = f"regexp_extract_all({lowered("coalesce(text, '')")}, '{LETTERS_DIGITS}')"
    return f"""
    SELECT {columns} unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda k: ws[k] || ' ' || ws[k + 1]))) AS feature
    FROM (SELECT *, {words} AS ws FROM {source})
    """


RESAMPLING = f"""
WITH RECURSIVE {CRC_TABLE},
docs AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS row_no FROM documents),
of_docs AS MATERIALIZED ({features("docs", "row_no,")}),
of_target AS MATERIALIZED ({features("benchmark", "")}),
buckets AS MATERIALIZED (
  SELECT feature, {checksum("feature")} % 10000 AS bucket
  FROM (SELECT feature FROM of_docs UNION SELECT feature FROM of_target), crc_table
),
corpus AS (SELECT bucket, count(*) AS s FROM of_docs JOIN buckets USING (feature) GROUP BY bucket),
target AS (SELECT bucket, count(*) AS t FROM of_target JOIN buckets USING (feature) GROUP BY bucket),
sizes AS (SELECT (SELECT count(*) FROM of_docs)::DOUBLE AS all_s, (SELECT count(*) FROM of_target)::DOUBLE AS all_t),
gains AS MATERIALIZED (
  SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * (all_s + 10000)) / ((s + 1)::DOUBLE * (all_t + 10000))))::BIGINT AS gain
  FROM corpus LEFT JOIN target USING (bucket), sizes
),
sums AS (
  SELECT row_no, count(*) AS n_features, sum(gain)::BIGINT AS gain
  FROM of_docs JOIN buckets USING (feature) JOIN gains USING (bucket) GROUP BY row_no
),
weighed AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, len(regexp_extract_all({lowered("text")}, '{LETTERS_DIGITS}')) AS n_words,
    coalesce((gain - (gain % n_features + n_features) % n_features) // n_features, 0)::BIGINT AS weight,
    ('0x' || substr(sha256('7:' || doc_id), 1, 8))::BIGINT AS h
  FROM docs LEFT JOIN sums USING (row_no)
),
scored AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM weighed),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place,
    count(*) FILTER (n_words >= 20) OVER () AS eligible
  FROM scored
)
SELECT doc_id, n_features, weight, score,
  CASE WHEN n_words >= 20 AND place <= 25 * eligible // 100 THEN place END AS rank
FROM placed
"""


def _phrase(label: str, phrase: str) -> str:
    parts = phrase.split()
    here = " AND ".join(f"ws[k + {i}] = '{part}'" for i, part in enumerate(parts, 1))
    return f"list_filter(range(0, len(ws) - {len(parts) - 1}), lambda k: {here}) AS at_{label}"


def _notices(params: LicenseParams) -> str:
    rows = [(label, notice_words(text)) for label, text in params.notices]
    return ", ".join(f"('{label}', {words}, {needed(len(words), params.percent)})" for label, words in rows)


AT = " || ".join(f"at_{label}" for label in LICENSE_PHRASES)
BASE_LABELS = " || ".join(f"CASE WHEN len(at_{label}) > 0 THEN ['{label}'] ELSE [] END" for label in sorted(LICENSE_PHRASES))

LICENSES = f"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS row_no, {lowered("coalesce(text, '')")} AS text FROM documents),
notices(label, own, need) AS (VALUES {_notices(LicenseParams())}),
lines AS (
  SELECT row_no, i, regexp_extract_all(line, '{LETTERS_DIGITS}') AS ws
  FROM (SELECT row_no, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM (SELECT row_no, string_split(text, chr(10)) AS ls FROM docs))
),
runs AS (SELECT row_no, i, ws, i - row_number() OVER (PARTITION BY row_no ORDER BY i) AS run FROM lines WHERE len(ws) > 0),
blocks AS (
  SELECT row_no, ws FROM lines UNION ALL SELECT row_no, flatten(list(ws)) FROM runs GROUP BY row_no, run HAVING count(*) > 1
),
matches AS (
  SELECT row_no, label, len(list_intersect(own, list_distinct(ws))) / len(own) AS containment
  FROM blocks JOIN notices ON len(list_intersect(own, list_distinct(ws))) >= need
),
found AS (SELECT row_no, list(DISTINCT label) AS found, max(containment) AS score FROM matches GROUP BY row_no),
words AS (
  SELECT *, {", ".join(_phrase(label, phrase) for label, phrase in LICENSE_PHRASES.items())}
  FROM (SELECT doc_id, row_no, regexp_extract_all(text, '{LETTERS_DIGITS}') AS ws FROM docs)
),
based AS (SELECT *, {AT} AS places, {BASE_LABELS} AS base FROM words)
SELECT doc_id, len(ws)::BIGINT AS n_words, len(places)::BIGINT AS n_base, list_min(places)::BIGINT AS first_word,
  list_max(places)::BIGINT AS last_word, array_to_string(base, ',') AS base_labels,
  array_to_string(list_sort(list_distinct(base || coalesce(found, []))), ',') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM based LEFT JOIN found USING (row_no)
"""

VARIANTS = f"""
WITH RECURSIVE {CRC_TABLE},
runs AS (
  SELECT doc_id, run, count(*) AS n
  FROM (SELECT doc_id, {lowered("unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+'))")} AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY doc_id, run
),
hashed AS MATERIALIZED (SELECT run, n, {checksum("(doc_id || ':' || run)")} AS h FROM runs, crc_table),
typed AS (
  SELECT n, CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed
),
words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM typed WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
),
cuts AS MATERIALIZED (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)
),
pairs AS (
  SELECT x.word, y.word AS near FROM cuts x JOIN cuts y ON x.i = y.i AND x.rest = y.rest AND x.word <> y.word
  UNION SELECT cuts.word, words.word FROM cuts JOIN words ON rest = words.word
  UNION SELECT words.word, cuts.word FROM cuts JOIN words ON rest = words.word
),
ranked AS (
  SELECT pairs.word, near, words.n AS near_n, count(*) OVER (PARTITION BY pairs.word) AS n_near,
    row_number() OVER (PARTITION BY pairs.word ORDER BY words.n DESC, near) AS place
  FROM pairs JOIN words ON near = words.word
),
judged AS MATERIALIZED (
  SELECT words.word, n, coalesce(n_near, 0) AS n_near,
    CASE WHEN near_n >= 5 * n THEN near END AS form, CASE WHEN near_n >= 5 * n THEN near_n END AS form_n
  FROM words LEFT JOIN ranked ON words.word = ranked.word AND place = 1
),
ways AS (
  SELECT word, word AS root, form AS next FROM judged
  UNION ALL SELECT ways.word, judged.word, judged.form FROM ways JOIN judged ON judged.word = next
)
SELECT judged.word, form, root, n, n_near, form_n FROM judged JOIN ways ON ways.word = judged.word AND next IS NULL
"""

ORACLES = {
    "op1_quality_rules": QUALITY,
    "op2_exact_dedup": EXACT,
    "op6_chat_formatting": CHAT,
    "op9_line_dedup": LINES,
    "op11_importance_resampling": RESAMPLING,
    "op12_license_scan": LICENSES,
    "op13_spelling_variants": VARIANTS,
}
