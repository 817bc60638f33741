"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from shiftlens.llm.quality_rules import STOP_WORDS

CHAT = """
WITH logs AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
said AS (
  SELECT *, length(role) + length(text) + 9
    + 4 * len(regexp_extract_all(role || text, '[&\\[\\]]'))
    + 3 * len(regexp_extract_all(role || text, '<')) AS chars
  FROM logs)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM said GROUP BY conv_id
"""

QUALITY_RULES = """
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM split)),
twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(5) AS r(k) GROUP BY doc_id),
lines AS (
  SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM split),
counted AS (
  SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g')) AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, length(t) - length(replace(t, '!', '')) AS n_shouts,
    len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
    len(list_filter(w, lambda x, i: i > 1 AND x = w[i - 1])) AS n_doubled_words,
    len(list_filter(w, lambda x: list_contains({stop_words}, x))) AS n_stop_words,
    coalesce(n, 0) AS n_repeat_words
  FROM split JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted)
SELECT *, NOT base_failed
    AND word_chars / n_words BETWEEN 2.0 AND 14.0
    AND n_symbols / n_words <= 0.15 AND n_shouts / n_words <= 0.15
    AND (n_stop_words + 1) / (n_words + 1) >= 0.06
    AND n_dup_lines / n_lines <= 0.35 AND n_doubled_words / n_words <= 0.15 AS kept
FROM judged
""".replace("{stop_words}", "[" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]")


NEAR_DEDUP = """
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) >= 2
      THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])
      ELSE w END) AS s
    FROM split)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * common >= 80 * (x.n + y.n - common)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT doc_id, doc_id AS root FROM documents
  UNION SELECT b, root FROM reached JOIN both_ways ON doc_id = a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, min(root) AS component_id, d.doc_id = min(root) AS kept
FROM documents d JOIN reached USING (doc_id) LEFT JOIN sizes USING (doc_id) GROUP BY d.doc_id, n
"""


DECONTAMINATION = """
WITH docs AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w
  FROM documents WHERE doc_id IS NOT NULL),
items AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w
  FROM benchmark),
doc_runs AS (
  SELECT doc_id, i, array_to_string(w[i + 1:i + 5], ' ') AS s, len(w) AS size
  FROM (SELECT *, unnest(range(greatest(len(w) - 4, 1))) AS i FROM docs WHERE len(w) > 0)),
item_runs AS (
  SELECT item_id, i, array_to_string(w[i + 1:i + 5], ' ') AS s, len(w) AS n
  FROM (SELECT *, unnest(range(greatest(len(w) - 4, 1))) AS i FROM items WHERE len(w) > 0)),
item_counts AS (SELECT item_id, n, s, count(*) AS times FROM item_runs GROUP BY ALL),
windows AS (
  SELECT DISTINCT doc_id, n, greatest(least(d.i - b.i, size - n), 0) AS start
  FROM doc_runs d JOIN item_runs b USING (s)),
window_counts AS (
  SELECT doc_id, n, start, s, count(*) AS times
  FROM windows JOIN doc_runs USING (doc_id) WHERE i BETWEEN start AND start + greatest(n - 5, 0) GROUP BY ALL),
sizes AS (SELECT doc_id, n, start, sum(times) AS size FROM window_counts GROUP BY ALL),
common AS (
  SELECT doc_id, n, start, item_id, sum(least(w.times, b.times)) AS common
  FROM window_counts w JOIN item_counts b USING (n, s) GROUP BY ALL),
alike AS (
  SELECT doc_id, item_id, n, start, common / (greatest(n - 4, 1) + size - common) AS similarity
  FROM common JOIN sizes USING (doc_id, n, start)
  WHERE 100 * common >= 80 * (greatest(n - 4, 1) + size - common))
SELECT doc_id, item_id, max(similarity) AS similarity, CAST(arg_max(start, (similarity, -start)) AS INTEGER) AS start, CAST(n AS INTEGER) AS n_words
FROM alike GROUP BY doc_id, item_id, n
"""


SUBSTRING_DEDUP = """
WITH split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM split)),
copies AS (SELECT doc_id, i FROM windows QUALIFY doc_id > min(doc_id) OVER (PARTITION BY s)),
lost AS (SELECT doc_id, list(DISTINCT i + k) AS places FROM copies, range(50) AS r(k) GROUP BY doc_id),
marked AS (
  SELECT doc_id, w, coalesce(len(places), 0) AS n_removed,
    list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda x: places IS NULL OR NOT list_contains(places, x[2])), lambda x: x[1]) AS left_words
  FROM split LEFT JOIN lost USING (doc_id))
SELECT doc_id, len(w) AS n_words, n_removed, sha256(array_to_string(left_words, ' ')) AS kept_sha256, array_to_string(left_words, ' ') AS kept
FROM marked
"""


#: Rows with a usable vector, as whole steps of 1/256.
_VECTORS = """
SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
FROM embeddings
WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
"""

_BOOK = """
nearest{next} AS (
  SELECT vec_id, p.part, arg_min(entry, (
      (p.a - b.a) * (p.a - b.a) + (p.b - b.b) * (p.b - b.b) + (p.c - b.c) * (p.c - b.c) + (p.d - b.d) * (p.d - b.d), entry)) AS entry
  FROM parts p JOIN book{last} b USING (part) GROUP BY ALL),
book{next} AS (
  SELECT part, entry, coalesce(m.a, o.a) AS a, coalesce(m.b, o.b) AS b, coalesce(m.c, o.c) AS c, coalesce(m.d, o.d) AS d
  FROM book{last} o LEFT JOIN (
    SELECT part, entry, CAST(floor(sum(a) / count(*)) AS BIGINT) AS a, CAST(floor(sum(b) / count(*)) AS BIGINT) AS b,
      CAST(floor(sum(c) / count(*)) AS BIGINT) AS c, CAST(floor(sum(d) / count(*)) AS BIGINT) AS d
    FROM nearest{next} JOIN parts USING (vec_id, part) GROUP BY ALL) m USING (part, entry))
"""

VECTOR_CODES = f"""
WITH kept AS ({_VECTORS}),
parts AS (
  SELECT vec_id, label, part, v[4 * part + 1] AS a, v[4 * part + 2] AS b, v[4 * part + 3] AS c, v[4 * part + 4] AS d
  FROM kept, (SELECT unnest(range(16)) AS part)),
book0 AS (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, a, b, c, d
  FROM parts QUALIFY entry < 64),
{_BOOK.format(last=0, next=1)}, {_BOOK.format(last=1, next=2)},
measured AS (
  SELECT vec_id, label, p.part, entry,
    (p.a - b.a) * (p.a - b.a) + (p.b - b.b) * (p.b - b.b) + (p.c - b.c) * (p.c - b.c) + (p.d - b.d) * (p.d - b.d) AS distance
  FROM parts p JOIN book2 b USING (part)),
final AS (SELECT vec_id, label, part, arg_min(entry, (distance, entry)) AS entry, min(distance) AS distance FROM measured GROUP BY ALL),
coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(distance) AS BIGINT) AS error
  FROM final GROUP BY ALL)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(concat_ws(',', a, b, c, d), ',' ORDER BY part, entry)) FROM book2) AS codebooks_sha256
FROM coded
"""

HARD_NEGATIVES = f"""
WITH kept AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, v
  FROM ({_VECTORS}) WHERE vec_id IS NOT NULL AND label IS NOT NULL),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS alike,
    CAST(list_inner_product(CAST(a.v AS DOUBLE[]), CAST(r.v AS DOUBLE[])) AS BIGINT) AS score
  FROM kept a JOIN kept r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, id, score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.id AS positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS INTEGER) AS rank,
  n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.alike
  AND 80 * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY rank <= 5
"""


def statements() -> dict[str, str]:
    return {
        "op1_chat_formatting": CHAT, "op3_decontamination": DECONTAMINATION,
        "op8_quality_rules": QUALITY_RULES, "op10_minhash_near_dedup": NEAR_DEDUP,
        "op11_substring_dedup": SUBSTRING_DEDUP,
        "op12_vector_code_compression": VECTOR_CODES, "op13_hard_negatives": HARD_NEGATIVES,
    }
