"""DuckDB SQL for the queries of this package."""

from __future__ import annotations

NEAR_DUPLICATES = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM words),
shingles AS (SELECT doc_id, unnest(s) AS g FROM sets),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM shared JOIN sets a ON x = a.doc_id JOIN sets b ON y = b.doc_id
  WHERE 100 * k >= 75 * (len(a.s) + len(b.s) - k)),
reach AS (
  SELECT doc_id, doc_id AS other FROM sets UNION SELECT reach.doc_id, links.y FROM reach JOIN links ON reach.other = links.x),
groups AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY ALL)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN groups USING (doc_id)
"""

DECONTAMINATION = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: array_to_string(w[i:i + 9], ' '))) AS g
  FROM items WHERE len(w) > 0),
places AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n),
hits AS (
  SELECT doc_id, item_id, p.i, p.n FROM (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM places) p
  JOIN windows x ON x.g = p.g AND x.n = p.n),
covered AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hits) GROUP BY ALL),
found AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hits GROUP BY ALL)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""

CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
rows AS (
  SELECT *, length(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g')) + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g'))
    + length('<|im_start|><|im_sep|><|im_end|>') AS chars
  FROM turns),
joined AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
    sum(chars)::BIGINT AS formatted_chars
  FROM rows GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars
FROM joined
"""

QUALITY_MEASURES = r"""
words AS (
  SELECT *, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) AS g
  FROM words WHERE len(w) > 2),
again AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows),
repeats AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM again WHERE n > 1) GROUP BY ALL),
measures AS (
  SELECT words.* EXCLUDE (w, lines), len(w)::BIGINT AS n_words, length(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(repeats.n, 0)::BIGINT AS n_repeat_words
  FROM words LEFT JOIN repeats USING (doc_id)),
verdicts AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    word_chars < 2 * n_words OR word_chars > 20 * n_words OR 10 * n_symbols > 3 * n_words
      OR (n_dup_lines >= 5 AND 15 * n_dup_lines > n_words) AS more_failed
  FROM measures)
"""

QUALITY = f"""
WITH {QUALITY_MEASURES}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT (base_failed OR more_failed) AS kept FROM verdicts
"""

MIXING = r"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, md5('7:' || coalesce(doc_id::VARCHAR, 'text:' || md5(coalesce(text, '')))) AS k
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS size, [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM sizes GROUP BY source),
levels AS (
  SELECT *, 2 * size AS cap, (sum(size) OVER ())::BIGINT * 3.0::DOUBLE / 2 - coalesce(sum(2 * size) OVER held, 0)::BIGINT AS remains,
    (sum(weight) OVER rest)::BIGINT AS weights, row_number() OVER need AS place
  FROM sources WINDOW need AS (ORDER BY 2 * size::DOUBLE / weight, source NULLS LAST),
    held AS (ORDER BY 2 * size::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    rest AS (ORDER BY 2 * size::DOUBLE / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
level AS (SELECT remains, weights FROM levels WHERE remains * weight < cap * weights ORDER BY place LIMIT 1),
targets AS (
  SELECT l.source, l.size AS source_size,
    CASE WHEN l.remains * l.weight >= l.cap * l.weights THEN l.cap::DOUBLE ELSE l.weight * level.remains / level.weights END AS target
  FROM levels l LEFT JOIN level ON true),
passes AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM targets),
places AS (
  SELECT doc_id, size, source_size, target, whole, target - whole * source_size AS remains,
    (sum(size) OVER (PARTITION BY s.source ORDER BY k RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS upto
  FROM sizes s JOIN passes p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, size * (whole + CASE WHEN 2 * upto - size <= 2 * remains THEN 1 ELSE 0 END) AS taken FROM places
"""

LINES = r"""
WITH lines AS (
  SELECT doc_id, unnest(range(len(l))) AS i, unnest(l) AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
hashed AS (SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT AS h FROM lines),
rolled AS (
  SELECT *, h + 31 * coalesce(lag(h) OVER w, 0) + 961 * coalesce(lag(h, 2) OVER w, 0) AS r FROM hashed WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
numbered AS (
  SELECT doc_id, i, line, coalesce(sum(CASE WHEN (r // 1024) % 4 = 0 THEN 1 ELSE 0 END)
    OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS place FROM rolled),
chunks AS (SELECT doc_id, place, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS body FROM numbered GROUP BY ALL),
flagged AS (
  SELECT *, n > 1 AND body <> '' AND row_number() OVER (PARTITION BY body, n > 1 ORDER BY doc_id, place) > 1 AS gone FROM chunks)
SELECT doc_id, sum(n)::BIGINT AS n_lines, count(*) AS n_chunks, coalesce(sum(n) FILTER (WHERE gone), 0)::BIGINT AS n_removed_lines,
  count(*) FILTER (WHERE gone) AS n_removed_chunks, sha256(coalesce(string_agg(body, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM flagged GROUP BY doc_id
"""

FILL_MIDDLE = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents),
dealt AS (
  SELECT *, len(u)::BIGINT AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
    ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4
  FROM units),
cuts AS (
  SELECT doc_id, text, n, u, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN n = 0 OR regexp_matches(text, '<[PSM]>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM dealt),
parts AS (
  SELECT doc_id, text, n, form, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:n], '') AS s FROM cuts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""

HARD_NEGATIVES = r"""
WITH usable AS (
  SELECT vec_id::BIGINT AS vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END) AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM usable a JOIN usable b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
negatives AS (
  SELECT p.*, other_id AS negative_id, score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank
  FROM positives p JOIN scores s ON p.anchor_id = s.anchor_id AND NOT s.same
    AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 10
"""

SQL = {
    "op1_near_duplicates": NEAR_DUPLICATES,
    "op2_line_dedup": LINES,
    "op3_decontamination": DECONTAMINATION,
    "op5_chat_format": CHAT,
    "op6_quality": QUALITY,
    "op7_mixing": MIXING,
    "op12_fill_middle": FILL_MIDDLE,
    "op13_hard_negatives": HARD_NEGATIVES,
}
