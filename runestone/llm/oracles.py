"""The same results in DuckDB SQL, where SQL can say them."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+')"

QUALITY_RULES = r"""
WITH words AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text, """ + WORDS.format("text") + r""" AS w FROM documents
), pairs AS (
  SELECT *, list_transform(range(1, greatest(len(w) - 1, 1)), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) AS windows FROM words
), windows AS (
  SELECT row_id, unnest(windows) AS win, generate_subscripts(windows, 1) AS i FROM pairs WHERE len(w) >= 3
), again AS (
  SELECT row_id, i FROM (SELECT row_id, i, count(*) OVER (PARTITION BY row_id, win) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT row_id, count(DISTINCT i + k) AS n_repeat_words FROM again, range(3) AS s(k) GROUP BY 1
), lines AS (
  SELECT row_id, unnest(string_split(text, E'\n')) AS line, generate_subscripts(string_split(text, E'\n'), 1) AS n FROM words
), parts AS (
  SELECT *, """ + WORDS.format("line") + r""" AS w, row_number() OVER (PARTITION BY row_id, line ORDER BY n) AS nth FROM lines
), rules AS (
  SELECT row_id, len(w) AS words, nth > 1 AS duplicate,
    10 * length(regexp_replace(line, '[^!?#*$%&|<>=_~^@\\/{}\[\]+"]', '', 'g')) >= list_sum(list_transform(w, lambda x: strlen(x)))
    OR (len(string_split(line, ' | ')) >= 3 AND len(w) - len(string_split(line, ' | ')) + 1 <= 3 * len(string_split(line, ' | ')))
    OR (len(w) >= 4 AND NOT regexp_matches(line, '[a-z]') AND length(regexp_replace(line, '[^A-Z]', '', 'g')) >= 4)
    OR len(list_filter(range(1, greatest(len(w) - 3, 1)), lambda i: w[i] = w[i+1] AND w[i] = w[i+2] AND w[i] = w[i+3] AND w[i] = w[i+4])) > 0
    OR regexp_matches(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), 'licensed under|all rights reserved|released under the|general public license|copyright \(c\)|terms of service|terms of use|privacy policy|cookie policy|we use cookies') AS fails
  FROM parts WHERE len(w) > 0
), by_doc AS (
  SELECT row_id, sum(duplicate::int) AS n_dup_lines, sum(CASE WHEN fails THEN words ELSE 0 END) AS lost, sum(fails::int) AS lost_lines
  FROM rules GROUP BY 1
), figures AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(lost, 0)::BIGINT AS n_lost_words, coalesce(lost_lines, 0)::BIGINT AS n_lost_lines
  FROM words LEFT JOIN covered USING (row_id) LEFT JOIN by_doc USING (row_id)
)
SELECT *, base_failed = false AND 100 * n_lost_words <= 50 * n_words AS kept
FROM (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM figures)
"""

LINE_BITMAPS = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row_id, coalesce(doc_id, -9223372036854775808) AS doc, doc_id, string_split(coalesce(text, ''), E'\n') AS lines FROM documents
), lines AS (
  SELECT row_id, doc, unnest(lines) AS line, generate_subscripts(lines, 1) AS n FROM docs
), keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), frequent AS (
  SELECT key, max(doc) AS keeper FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc) >= 5
), judged AS (
  SELECT row_id, n, line, doc < keeper AS gone FROM keyed LEFT JOIN frequent USING (key)
), kept AS (
  SELECT row_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
    coalesce(string_agg(line, E'\n' ORDER BY n) FILTER (NOT coalesce(gone, false)), '') AS text FROM judged GROUP BY 1
)
SELECT doc_id, n_lines, n_dropped, sha256(kept.text) AS kept_sha256 FROM docs JOIN kept USING (row_id)
"""

SOURCE_MIX = r"""
WITH sized AS (
  SELECT doc_id, source, len(""" + WORDS.format("text") + r""")::BIGINT AS size, md5(concat_ws(':', 'mix', doc_id::VARCHAR)) AS digest FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS rank FROM sized GROUP BY source
), levels AS (
  SELECT *, [5, 2, 1][rank % 3 + 1] AS weight, 3 * source_size AS most, 3 * source_size / [5, 2, 1][rank % 3 + 1] AS level FROM sources
), running AS (
  SELECT *, ((SELECT sum(source_size) FROM sources) - coalesce(sum(most) OVER before, 0))::DOUBLE
    / ((SELECT sum(weight) FROM levels) - coalesce(sum(weight) OVER before, 0)) AS even
  FROM levels WINDOW before AS (ORDER BY level, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), line AS (SELECT arg_min(even, level) AS line FROM running WHERE level >= even
), targets AS (
  SELECT source, source_size, rank, least(most::DOUBLE, weight * coalesce(line, 0)) AS target FROM running, line
), placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.rank, t.target,
    coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY digest, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), taken AS (
  SELECT *, len(list_filter([0, 1, 2], lambda k: size > 0 AND 2 * (before + k * source_size) + size <= 2 * target)) AS copies,
    (2 * before + size) / (2 * target) AS share FROM placed
)
SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken, copies::INTEGER AS copies,
  CASE WHEN copies = 0 THEN NULL ELSE round(CASE rank % 3
    WHEN 0 THEN CASE WHEN share <= 0.375 THEN share / 0.375 * 0.25 WHEN share <= 0.6875 THEN 0.25 + (share - 0.375) / 0.3125 * 0.25
      WHEN share <= 0.875 THEN 0.5 + (share - 0.6875) / 0.1875 * 0.25 ELSE 0.75 + (share - 0.875) / 0.125 * 0.25 END
    WHEN 1 THEN share
    ELSE CASE WHEN share <= 0.125 THEN share / 0.125 * 0.25 WHEN share <= 0.3125 THEN 0.25 + (share - 0.125) / 0.1875 * 0.25
      WHEN share <= 0.625 THEN 0.5 + (share - 0.3125) / 0.3125 * 0.25 ELSE 0.75 + (share - 0.625) / 0.375 * 0.25 END END, 9) END AS first_time
FROM taken
"""

NEAR_DEDUP = r"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS row_id, doc_id,
    """ + WORDS.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')") + r""" AS w FROM documents
), shingles AS (
  SELECT DISTINCT row_id, unnest(CASE WHEN len(w) = 1 THEN [w[1]] ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM docs WHERE len(w) > 0
), sizes AS (SELECT row_id, count(*) AS n FROM shingles GROUP BY 1
), pairs AS (
  SELECT a.row_id AS x, b.row_id AS y, count(*) AS common FROM shingles a JOIN shingles b ON a.s = b.s AND a.row_id <> b.row_id GROUP BY ALL
), links AS (
  SELECT x, y FROM pairs JOIN sizes p ON p.row_id = x JOIN sizes q ON q.row_id = y
  WHERE 100 * common >= 80 * (p.n + q.n - common)
), reach(x, y) AS (
  SELECT row_id, row_id FROM docs UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
), smallest AS (SELECT x AS row_id, min(doc_id) AS component_id FROM reach JOIN docs ON docs.row_id = reach.y GROUP BY 1
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM docs LEFT JOIN sizes USING (row_id) JOIN smallest USING (row_id)
"""

WINDOW_DEDUP = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row_id, doc_id, """ + WORDS.format("text") + r""" AS w FROM documents
), starts AS (
  SELECT row_id, w, unnest(range(1, len(w) - 33)) AS i FROM docs WHERE len(w) >= 35
), windows AS (SELECT row_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS win FROM starts
), again AS (SELECT row_id, i FROM (SELECT row_id, i, count(*) OVER (PARTITION BY win) AS n FROM windows) WHERE n > 1
), gone AS (SELECT DISTINCT row_id, i + k AS i FROM again, range(35) AS r(k)
), words AS (SELECT row_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM docs
), kept AS (
  SELECT row_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n FROM words ANTI JOIN gone USING (row_id, i) GROUP BY 1
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (row_id)
"""

SORTED_LIST_SEARCH = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS c FROM embeddings
  WHERE len(embedding) > 0 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
), scores AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.c, v.c)::BIGINT AS score
  FROM (SELECT DISTINCT vec_id, c FROM v WHERE vec_id % 50 = 0) q JOIN v ON v.vec_id IS DISTINCT FROM q.vec_id AND len(v.c) = len(q.c)
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM scores QUALIFY rank <= 5
"""

SPELLING_VARIANTS = r"""
WITH RECURSIVE bits(i, k, v) AS (
  SELECT i, 0, i FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM bits WHERE k < 8
), steps AS (SELECT i, v FROM bits WHERE k = 8
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS w FROM documents
), named AS (
  SELECT doc_id, w, count(*) AS n, hex(encode(doc_id || ':' || w)) AS h FROM runs WHERE length(w) >= 6 GROUP BY 1, 2
), digest(doc_id, w, n, h, k, c) AS (
  SELECT doc_id, w, n, h, 1, 4294967295 FROM named
  UNION ALL
  SELECT doc_id, w, n, h, k + 2, xor(c // 256, v) FROM digest JOIN steps
    ON i = xor(c % 256, 16 * (instr('0123456789ABCDEF', h[k]) - 1) + instr('0123456789ABCDEF', h[k + 1]) - 1) WHERE k < length(h)
), hashed AS (SELECT w, n, xor(c, 4294967295) AS c, length(w) AS chars FROM digest WHERE k > length(h)
), damaged AS (
  SELECT n, CASE WHEN c % 199 = 0 THEN substr(w, 1, (c % chars)::INTEGER) || substr(w, (c % chars)::INTEGER + 2) ELSE w END AS word FROM hashed
  UNION ALL SELECT count(*), w FROM runs WHERE doc_id IS NULL GROUP BY w
), words AS (SELECT word, sum(n)::BIGINT AS n FROM damaged WHERE length(word) >= 6 GROUP BY 1 HAVING sum(n) >= 5
), skipped AS (
  SELECT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT x.word, y.word AS other, y.n FROM skipped x JOIN skipped y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT s.word, w.word, w.n FROM skipped s JOIN words w ON s.a || s.b = w.word
  UNION SELECT w.word, s.word, s.n FROM skipped s JOIN words w ON s.a || s.b = w.word
), best AS (
  SELECT word, count(*) AS n_near, arg_min(other, (-n, other)) AS other, max(n) AS most FROM near GROUP BY 1
), formed AS (
  SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN most >= 5 * n THEN other END AS form, CASE WHEN most >= 5 * n THEN most END AS form_n
  FROM words LEFT JOIN best USING (word)
), followed(word, last, further) AS (
  SELECT word, word, form FROM formed
  UNION ALL SELECT followed.word, formed.word, formed.form FROM followed JOIN formed ON formed.word = followed.further
)
SELECT word, form, last AS root, n, n_near, form_n FROM formed JOIN followed USING (word) WHERE further IS NULL
"""

ORACLES = {
    "op1_quality_rules": QUALITY_RULES,
    "op6_line_bitmaps": LINE_BITMAPS,
    "op8_source_mix": SOURCE_MIX,
    "op9_minhash_near_dedup": NEAR_DEDUP,
    "op10_window_dedup": WINDOW_DEDUP,
    "op11_sorted_list_search": SORTED_LIST_SEARCH,
    "op12_spelling_variants": SPELLING_VARIANTS,
}
