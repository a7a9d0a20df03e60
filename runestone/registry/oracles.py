r"""The same results in plain SQL, for the row-by-row check of every query.

Written apart from the Spark code: regular expressions are in RE2's dialect, and
only parameters (stop words, tags, seed, limits) are shared.
"""

from __future__ import annotations

from runestone import settings

ORACLES: dict[str, str] = {}

# White space as str.isspace() has it.
WS = (
    r"\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
LANGS = ["de", "en", "es", "fr"]
SEED = settings.SEED


def q(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def strings(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def sub(text: str, pattern: str, by: str = " ") -> str:
    return f"regexp_replace({text}, {q(pattern)}, {q(by)}, 'g')"


def words(text: str) -> str:
    return f"len(regexp_extract_all({text}, {q(f'[^{WS}]+')}))"


def strip(text: str) -> str:
    return sub(text, f"^[{WS}]+|[{WS}]+$", "")


DOCS = "(SELECT doc_id, text, lang AS language, source AS label_text FROM documents)"

# --- cleaning ----------------------------------------------------------------

HEADERS = (
    r"(?m)^(?:From|Subject|Date|Organization|Lines|Newsgroups|Message-ID|References|Sender|Reply-To|"
    r"NNTP-Posting-Host|Distribution|Path|Xref|In-Reply-To|Followup-To|Keywords|Summary|Expires|Originator|"
    r"Article-I\.D\.|X-[\p{L}\p{N}_-]+):.*$"
)


def tags_sql(t):
    return sub(t, "<[^>]+>")


def urls_sql(t):
    return sub(t, rf"http[s]?://[^{WS}]+|www\.[^{WS}]+")


def emails_sql(t):
    return sub(t, r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b")


def signature_sql(t):
    return sub(t, r"(?ms)^-- ?$.*")


def headers_sql(t):
    return sub(t, HEADERS)


def attribution_sql(t):
    return sub(t, rf"(?m)^(?:In article\b.*|.*\b(?:writes|wrote):)[{WS}]*$")


def quotes_sql(t):
    return sub(t, rf"(?m)^[{WS}]*(?:>|\||[A-Za-z]{{1,4}}>|:[{WS}]*>?).*$")


def collapse_sql(t):
    return strip(sub(t, rf"[{WS}]{{2,}}"))


def sanitize_sql(t):
    # NFKC changes nothing in these tables.
    for step in (tags_sql, signature_sql, headers_sql, attribution_sql, quotes_sql, urls_sql, emails_sql, collapse_sql):
        t = step(t)
    return t


POSTS = """(SELECT conv_id, turn, concat('From: ', role, chr(10), 'X-Turn: ', turn::VARCHAR, chr(10), chr(10),
  'In article <', conv_id::VARCHAR, '@news>', chr(10), role, ' writes:', chr(10), chr(10), '> ', text, chr(10),
  'AB> quoted', chr(10), ': colon', chr(10), text, chr(10), 'Subject: tail', chr(10), '-- ', chr(10), role, chr(10),
  'sig') AS text FROM conversations)"""

ORACLES["clean_html"] = f"SELECT page_id, {tags_sql('html')} AS clean_text FROM pages"
ORACLES["clean_urls"] = f"SELECT page_id, {urls_sql('html')} AS clean_text FROM pages"
ORACLES["clean_emails"] = f"SELECT doc_id, {emails_sql('text')} AS clean_text FROM documents"
ORACLES["clean_nfkc"] = "SELECT doc_id, concat(text, ' fin ', chr(233)) AS clean_text FROM documents"
ORACLES["clean_nfc"] = (
    "SELECT doc_id, nfc_normalize(concat(text, ' ', chr(64257), 'n e', chr(769))) AS clean_text FROM documents"
)
ORACLES["non_ascii_count"] = (
    r"SELECT doc_id, len(regexp_extract_all(text, '[^\x{0}-\x{7F}]')) AS non_ascii FROM documents"
)
ORACLES["collapse_whitespace"] = (
    "SELECT doc_id, " + collapse_sql(r"concat(chr(9), ' ', replace(text, '. ', concat('. ', chr(10), '  ')), ' ', chr(10))")
    + " AS clean_text FROM documents"
)
ORACLES["strip_edges"] = (
    "SELECT doc_id, " + strip("concat(chr(9), ' ', chr(12288), text, ' ', chr(10))") + " AS clean_text FROM documents"
)
ORACLES["clean_signature"] = f"SELECT conv_id, turn, {signature_sql('text')} AS clean_text FROM {POSTS}"
ORACLES["clean_headers"] = f"SELECT conv_id, turn, {headers_sql('text')} AS clean_text FROM {POSTS}"
ORACLES["clean_attribution"] = f"SELECT conv_id, turn, {attribution_sql('text')} AS clean_text FROM {POSTS}"
ORACLES["clean_quotes"] = f"SELECT conv_id, turn, {quotes_sql('text')} AS clean_text FROM {POSTS}"
ORACLES["clean_composite"] = (
    f"SELECT page_id, {collapse_sql(emails_sql(urls_sql(tags_sql('html'))))} AS clean_text FROM pages"
)
ORACLES["sanitize"] = f"SELECT doc_id, {sanitize_sql('text')} AS clean_text FROM documents"
ORACLES["sanitize_posts"] = f"SELECT conv_id, turn, {sanitize_sql('text')} AS clean_text FROM {POSTS}"
ORACLES["clean_corpus"] = f"SELECT doc_id, lang AS language, {sanitize_sql('text')} AS text FROM documents"
ORACLES["clean_and_drop"] = (
    f"SELECT doc_id, clean_text FROM (SELECT doc_id, {sanitize_sql('text')} AS clean_text FROM documents) "
    f"WHERE {words('clean_text')} >= 1"
)
ORACLES["cleaning_impact"] = f"""
SELECT language, count(*) AS documents, sum(length(text) - length(clean))::BIGINT AS chars_removed,
  sum(len(regexp_extract_all(text, '[^\\x{{0}}-\\x{{7F}}]')))::BIGINT AS non_ascii_before
FROM (SELECT lang AS language, text, {sanitize_sql('text')} AS clean FROM documents) GROUP BY language"""

ORACLES["build_impact"] = ORACLES["cleaning_impact"].replace("FROM documents)", "FROM documents WHERE lang IN ('de', 'en', 'es', 'fr'))")

# --- sources -----------------------------------------------------------------

ORACLES["scan_corpus"] = "SELECT doc_id, text, lang, source FROM documents"
ORACLES["scan_csv_roundtrip"] = (
    f"SELECT doc_id, text, length(label_text)::BIGINT AS label, label_text, language FROM {DOCS}"
)
ORACLES["label_dimension"] = (
    "SELECT DISTINCT length(source)::BIGINT AS label, source AS label_text FROM documents"
)


def digest(key: str) -> str:
    return f"md5(concat('{SEED}', ':', {key}::VARCHAR))"


def split_sql(source: str, label: str) -> str:
    """Rows of ``source`` with ``split``."""
    return f"""(SELECT * EXCLUDE (rn, n), CASE WHEN rn <= round(n * 0.2) THEN 'val' ELSE 'train' END AS split FROM (
      SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY {digest('doc_id')}, doc_id) AS rn,
        count(*) OVER (PARTITION BY {label}) AS n FROM {source}))"""


ORACLES["union_splits"] = (
    f"SELECT doc_id, text, label_text, split FROM {split_sql(DOCS, 'label_text')} WHERE language = 'en'"
)
ORACLES["demo_sample"] = f"""
SELECT doc_id, language, text FROM {DOCS}
QUALIFY row_number() OVER (PARTITION BY language ORDER BY {digest('doc_id')}, doc_id) <= {settings.DEMO_ROWS_PER_LANGUAGE}"""

PREDICTIONS = f"""(SELECT doc_id, text, lang AS language, list_position({strings(LANGS)}, lang) - 1 AS label,
  length(text) % {len(LANGS)} AS pred, {LANGS.index('en')} AS baseline_pred FROM documents)"""

ORACLES["example_predictions"] = f"""
SELECT doc_id, text, label::BIGINT AS label, pred::BIGINT AS predicted_label, language
FROM {split_sql(PREDICTIONS, 'label')} WHERE split = 'val'
ORDER BY {digest('doc_id')}, doc_id LIMIT {settings.EXAMPLE_PREDICTIONS}"""


def f1_sql(pred: str) -> str:
    return f"""(SELECT avg(CASE WHEN tp = 0 THEN 0.0::DOUBLE ELSE
        2 * (tp / predicted) * (tp / actual) / ((tp / predicted) + (tp / actual)) END) FROM (
      SELECT c, (SELECT count(*) FROM {PREDICTIONS} WHERE label = c AND {pred} = c)::DOUBLE AS tp,
        (SELECT count(*) FROM {PREDICTIONS} WHERE label = c)::DOUBLE AS actual,
        (SELECT count(*) FROM {PREDICTIONS} WHERE {pred} = c)::DOUBLE AS predicted
      FROM (SELECT label AS c FROM {PREDICTIONS} UNION SELECT {pred} FROM {PREDICTIONS})))"""


def accuracy_sql(pred: str) -> str:
    return f"(SELECT avg((label = {pred})::INT) FROM {PREDICTIONS})"


ORACLES["performance_report"] = f"""
SELECT round({accuracy_sql('pred')}, 4) AS classification_accuracy, round({f1_sql('pred')}, 4) AS f1_score_macro,
  round({accuracy_sql('baseline_pred')}, 4) AS baseline_accuracy,
  round({f1_sql('baseline_pred')}, 4) AS baseline_f1_macro,
  (SELECT string_agg(lang, ',' ORDER BY lang) FROM (SELECT DISTINCT lang FROM documents)) AS languages_supported"""

# --- labels and filters ------------------------------------------------------

STANDARD = "SELECT doc_id, text, n_chars AS label, source AS label_text, lang AS language FROM documents"
MAP = "(SELECT label_text, row_number() OVER (ORDER BY label_text) - 1 AS label FROM (SELECT DISTINCT source AS label_text FROM documents{where}))"

ORACLES["standardize"] = STANDARD
ORACLES["union_languages"] = STANDARD
ORACLES["label_map"] = f"SELECT label_text, label FROM {MAP.format(where='')}"
ORACLES["label_map_en"] = f"SELECT label_text, label FROM {MAP.format(where=chr(32) + 'WHERE lang = ' + q('en'))}"
ORACLES["encode_labels"] = f"""
SELECT doc_id, language, label_text, label FROM {DOCS} JOIN {MAP.format(where='')} USING (label_text)"""
ORACLES["decode_labels"] = f"""
SELECT doc_id, d.label, coalesce(m.label_text, d.label::VARCHAR) AS category
FROM (SELECT doc_id, doc_id % 25 AS label FROM documents) d LEFT JOIN {MAP.format(where='')} m USING (label)"""
ORACLES["unknown_labels"] = """
SELECT DISTINCT concat(source, '-', lang) AS label_text FROM documents
WHERE concat(source, '-', lang) NOT IN (SELECT concat(source, '-', lang) FROM documents WHERE lang = 'en')"""
ORACLES["unsupported_language_rows"] = (
    f"SELECT doc_id, language, label_text FROM {DOCS} WHERE language NOT IN ('en', 'sv', 'fi')"
)
ORACLES["drop_ghosts"] = f"SELECT doc_id, lang AS language FROM documents WHERE {words('text')} >= 3"

BUILD_TEXT = sanitize_sql("coalesce(text, '')")
ORACLES["build_corpus"] = f"""
SELECT doc_id, text, label, label_text, language FROM (
  SELECT doc_id, {BUILD_TEXT} AS text, label, label_text, language
  FROM {DOCS} JOIN {MAP.format(where=chr(32) + 'WHERE lang = ' + q('en'))} USING (label_text))
WHERE {words('text')} >= 1"""

TAG_CASE = (
    "CASE label " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in settings.ENTITY_TAGS.items())
    + f" ELSE {q(settings.UNKNOWN_TAG)} END"
)
ORACLES["normalize_entity_label"] = f"""
SELECT doc_id, label, {TAG_CASE} AS tag FROM (
  SELECT doc_id, {strings([*settings.ENTITY_TAGS, 'UNLISTED'])}[1 + doc_id % {len(settings.ENTITY_TAGS) + 1}] AS label
  FROM documents)"""

TOKEN = rf"[\p{{L}}\p{{M}}\p{{N}}]+|[^{WS}\p{{L}}\p{{M}}\p{{N}}]"
TOKENS = f"regexp_extract_all(text, {q(TOKEN)})"
# --- samples -----------------------------------------------------------------

ORACLES["stratified_sample"] = f"""
SELECT doc_id, label_text, text FROM {DOCS}
QUALIFY row_number() OVER (PARTITION BY label_text ORDER BY {digest('doc_id')}, doc_id)
  <= 200 // (SELECT count(DISTINCT source) FROM documents)"""
ORACLES["stratified_split"] = f"SELECT doc_id, language, split FROM {split_sql(DOCS, 'language')}"
ORACLES["eval_sample"] = f"SELECT doc_id, text FROM documents ORDER BY {digest('doc_id')}, doc_id LIMIT 100"
ORACLES["kfold_assign"] = f"""
SELECT doc_id, lang AS language,
  (row_number() OVER (PARTITION BY lang ORDER BY {digest('doc_id')}, doc_id) - 1) % 3 AS fold FROM documents"""

# --- profiles ----------------------------------------------------------------

LENGTHS = f"(SELECT lang AS language, {words('text')} AS words FROM documents)"


def taxonomy_row(name: str, test: str) -> str:
    return f"""SELECT {q(name)} AS category, count(*) FILTER ({test}) AS count,
  round(100.0::DOUBLE * count(*) FILTER ({test}) / count(*), 2) AS percent
FROM (SELECT text, {words('text')} AS w FROM documents)"""


ORACLES["missing_taxonomy"] = " UNION ALL ".join([
    taxonomy_row("NaN / Null", "text IS NULL"),
    taxonomy_row("Empty / Whitespace", "w = 0"),
    taxonomy_row("Micro (<3 words)", "w > 0 AND w < 3"),
    taxonomy_row("Valid", "w >= 3"),
])
ORACLES["duplicates"] = f"""
SELECT count(*) AS total, count(DISTINCT t) AS distinct_texts, count(*) - count(DISTINCT t) AS duplicates,
  round(100.0::DOUBLE * (count(*) - count(DISTINCT t)) / count(*), 2) AS duplicate_percent
FROM (SELECT {strip("coalesce(text, '')")} AS t FROM documents)"""
DESCRIBE = """count(*) AS count, round(avg(words), 6) AS mean, round(stddev_samp(words), 6) AS std,
  min(words) AS min, """ + ", ".join(
    f"round(quantile_cont(words, {p}), 6) AS p{round(p * 100)}" for p in (0.25, 0.5, 0.75, 0.9, 0.95, 0.99)
) + ", max(words) AS max"
ORACLES["length_describe"] = f"SELECT {DESCRIBE} FROM {LENGTHS} WHERE words >= 3"
ORACLES["profile_by_language"] = f"""
SELECT CASE WHEN grouping(language) = 1 THEN '*' ELSE language END AS language, {DESCRIBE}
FROM {LENGTHS} WHERE words >= 1 GROUP BY GROUPING SETS ((language), ())"""
ORACLES["length_outliers"] = f"""
WITH l AS (SELECT words FROM {LENGTHS} WHERE words >= 3),
s AS (SELECT quantile_cont(words, 0.25) AS a, quantile_cont(words, 0.75) AS b FROM l),
f AS (SELECT greatest(0.0::DOUBLE, a - 1.5::DOUBLE * (b - a)) AS lower_bound, b + 1.5::DOUBLE * (b - a) AS upper_bound FROM s)
SELECT round(lower_bound, 6) AS lower_bound, round(upper_bound, 6) AS upper_bound,
  (SELECT count(*) FROM l WHERE words < lower_bound OR words > upper_bound) AS outliers,
  round(100.0::DOUBLE * (SELECT count(*) FROM l WHERE words < lower_bound OR words > upper_bound)
    / (SELECT count(*) FROM l), 2) AS outlier_percent FROM f"""
ORACLES["length_histogram"] = f"""
WITH l AS (SELECT words FROM {LENGTHS} WHERE words >= 3), m AS (SELECT min(words) AS lo, max(words) AS hi FROM l)
SELECT least((words - lo) * 60 // greatest(hi - lo, 1), 59) AS bin, count(*) AS documents
FROM l, m GROUP BY bin"""
ORACLES["class_distribution"] = "SELECT lang AS language, count(*) AS documents FROM documents GROUP BY lang"
ORACLES["language_distribution"] = ORACLES["class_distribution"]
ORACLES["class_imbalance"] = """
WITH c AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang)
SELECT (SELECT lang FROM c ORDER BY n DESC, lang LIMIT 1) AS most_common, (SELECT max(n) FROM c) AS most_common_documents,
  (SELECT lang FROM c ORDER BY n, lang LIMIT 1) AS least_common, (SELECT min(n) FROM c) AS least_common_documents,
  (SELECT count(*) FROM c) AS classes, round((SELECT max(n) / min(n)::DOUBLE FROM c), 2) AS imbalance_ratio"""
ORACLES["median_words_by_language"] = (
    f"SELECT language, quantile_cont(words, 0.5) AS median_words FROM {LENGTHS} GROUP BY language"
)
ORACLES["corpus_summary"] = f"""
WITH l AS (SELECT language, count(*) AS documents, quantile_cont(words, 0.5) AS median_words,
    round(avg(words), 1) AS mean_words, max(words) AS max_words, count(*) FILTER (words = 0) AS empty
  FROM {LENGTHS} GROUP BY language),
d AS (SELECT lang AS language, count(*) - count(DISTINCT {strip('text')}) AS duplicates FROM documents GROUP BY lang),
k AS (SELECT lang AS language, source, count(*) AS n FROM documents GROUP BY lang, source),
c AS (SELECT language, count(*) AS classes, round(max(n) / min(n)::DOUBLE, 1) AS imbalance FROM k GROUP BY language)
SELECT * FROM l JOIN d USING (language) JOIN c USING (language)"""

# --- languages ---------------------------------------------------------------


def grams(word: str) -> str:
    padded = f"concat(' ', {word}, ' ')"
    parts = [
        f"[substr({t}, i, {k}) for i in range(1, length({t}) - {k} + 2)]" for t, k in ((word, 1), (padded, 2), (padded, 3))
    ]
    return f"list_concat(list_concat({parts[0]}, {parts[1]}), {parts[2]})"


PROFILE_CTES = rf"""
w AS (SELECT doc_id, lang, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{M}}]+')) AS word FROM documents),
wc AS (SELECT lang, word, count(*) AS n FROM w GROUP BY lang, word),
g AS (SELECT lang, n, unnest({grams('word')}) AS gram FROM wc),
gc AS (SELECT lang, gram, sum(n)::BIGINT AS n FROM g GROUP BY lang, gram),
tot AS (SELECT lang, sum(n)::BIGINT AS total FROM gc GROUP BY lang),
vocab AS (SELECT DISTINCT gram FROM gc),
prof AS (SELECT tot.lang AS language, vocab.gram AS gram,
    round(ln((coalesce(gc.n, 0) + 1)::DOUBLE / (total + (SELECT count(*) FROM vocab))::DOUBLE) * 1000000)::BIGINT AS score
  FROM vocab CROSS JOIN tot LEFT JOIN gc ON gc.lang = tot.lang AND gc.gram = vocab.gram),
dw AS (SELECT doc_id, word, count(*) AS n FROM w GROUP BY doc_id, word),
dg AS (SELECT doc_id, n, unnest({grams('word')}) AS gram FROM dw),
dgc AS (SELECT doc_id, gram, sum(n)::BIGINT AS n FROM dg GROUP BY doc_id, gram),
ds AS (SELECT doc_id, language, sum(n * score)::BIGINT AS score FROM dgc JOIN prof USING (gram) GROUP BY doc_id, language),
det AS (SELECT doc_id, language AS detected, score FROM ds
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, language) = 1)"""
ORACLES["lang_profiles"] = f"WITH {PROFILE_CTES} SELECT language, gram, score FROM prof"
ORACLES["detect_language"] = f"WITH {PROFILE_CTES} SELECT doc_id, detected, score FROM documents LEFT JOIN det USING (doc_id)"
ORACLES["route_language"] = """
SELECT doc_id, lang AS language, CASE WHEN lang IN ('en', 'sv', 'fi') THEN lang ELSE 'en' END AS routed FROM documents"""
DAMAGED = r"""CASE length(text) % 7 WHEN 0 THEN concat(' ', chr(9), chr(10))
  WHEN 1 THEN regexp_replace(text, '\p{L}', '', 'g') ELSE text END"""
STATUS = rf"""CASE WHEN {strip('text')} = '' THEN 'blank' WHEN NOT regexp_matches(text, '\p{{L}}') THEN 'no_letters' ELSE 'ok' END"""
ORACLES["detect_saved_profiles"] = f"""WITH {PROFILE_CTES}
SELECT doc_id, CASE WHEN length(text) % 7 > 1 THEN detected END AS detected, CASE WHEN length(text) % 7 > 1 THEN score END AS score
FROM documents LEFT JOIN det USING (doc_id)"""
ORACLES["detect_status"] = f"SELECT doc_id, {STATUS} AS status FROM (SELECT doc_id, {DAMAGED} AS text FROM documents)"

# --- tokens ------------------------------------------------------------------

ORACLES["word_tokens"] = (
    f"SELECT doc_id, len({TOKENS}) AS n_tokens, array_to_string({TOKENS}, '|') AS tokens FROM documents"
)
ORACLES["truncate_tokens"] = (
    f"SELECT doc_id, len({TOKENS}[1:{settings.MAX_TOKENS}]) AS n_tokens, "
    f"array_to_string({TOKENS}[1:{settings.MAX_TOKENS}], '|') AS tokens FROM documents"
)


def pieces_sql(source: str) -> str:
    """CTEs: tokens of ``source``, and the vocabulary learned from them."""
    return rf"""
tk AS (SELECT doc_id, unnest({TOKENS}) AS tok, generate_subscripts({TOKENS}, 1) AS i FROM {source}),
w AS (SELECT tok, count(*) AS n FROM tk GROUP BY tok),
p AS (SELECT n, k, unnest([CASE WHEN i = 1 THEN '' ELSE '##' END || substr(tok, i, k)
      for i in range(1, length(tok) - k + 2)]) AS piece
  FROM w CROSS JOIN (SELECT unnest(range(1, 9)) AS k)),
c AS (SELECT piece, k, sum(n)::BIGINT AS n FROM p GROUP BY piece, k),
v AS (SELECT piece, k, n FROM c WHERE k = 1
  UNION ALL SELECT * FROM (SELECT piece, k, n FROM c WHERE k > 1 ORDER BY n * (k - 1) DESC, piece LIMIT 8000))"""


ORACLES["subword_vocab"] = f"WITH {pieces_sql('documents')} SELECT piece, n FROM v"
# Every character of a token is in its vocabulary, so each step finds a piece.
ENCODED = f"""{pieces_sql('documents')},
enc AS (
  SELECT tok, 1 AS pos, '' AS pieces, 0 AS used FROM w
  UNION ALL
  SELECT tok, pos + k, concat(pieces, '|', piece), used + 1 FROM (
    SELECT e.tok, e.pos, e.pieces, e.used, v.k, v.piece,
      row_number() OVER (PARTITION BY e.tok ORDER BY v.k DESC) AS choice
    FROM enc e CROSS JOIN (SELECT unnest(range(1, 9)) AS len) JOIN v
      ON v.k = len AND v.piece = CASE WHEN e.pos = 1 THEN '' ELSE '##' END || substr(e.tok, e.pos, len)
    WHERE e.pos + len - 1 <= length(e.tok)) WHERE choice = 1),
sw AS (SELECT doc_id, sum(used)::BIGINT AS n_tokens, substr(string_agg(pieces, '' ORDER BY i), 2) AS tokens
  FROM tk JOIN (SELECT tok, pieces, used FROM enc WHERE pos > length(tok)) USING (tok) GROUP BY doc_id)"""
ORACLES["subword_tokens"] = f"WITH RECURSIVE {ENCODED} SELECT doc_id, n_tokens, tokens FROM sw"
ORACLES["route_tokens"] = f"""
WITH RECURSIVE {ENCODED}
SELECT doc_id, 'de' AS language, n_tokens, tokens FROM sw JOIN documents USING (doc_id) WHERE lang = 'de'
UNION ALL SELECT doc_id, lang, len({TOKENS}), array_to_string({TOKENS}, '|') FROM documents WHERE lang <> 'de'"""

# --- tags --------------------------------------------------------------------

NUMBER = r"[0-9]+(?:[.,][0-9]+)*"
MENTION = "|".join([
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", r"[0-9]{4}-[0-9]{2}-[0-9]{2}", r"[0-9]{1,2}:[0-9]{2}",
    rf"[$€£] ?{NUMBER}", rf"{NUMBER} ?%", NUMBER, r"\p{Lu}[\p{L}\p{M}]+(?: \p{Lu}[\p{L}\p{M}]+)*",
])
SURFACES = (
    f"list_filter(regexp_extract_all(text, {q(f'({MENTION})|' + r'[\p{L}\p{M}\p{N}]+')}, 1), "
    "lambda x: x IS NOT NULL AND x <> '')"
)


def mention_ctes(source: str, mentions: str | None = None) -> str:
    """CTEs from ``doc_id, text, language`` to mentions (or those of the CTE ``men`` given),
    entities, keywords and tags."""
    cases = " ".join(
        f"WHEN language = {q(lang)} THEN list_contains({strings(ws)}, word)"
        for lang, ws in settings.STOP_WORDS.items() if lang != settings.DEFAULT_LANGUAGE
    )
    stop = f"CASE {cases} ELSE list_contains({strings(settings.STOP_WORDS[settings.DEFAULT_LANGUAGE])}, word) END"
    alphabetic = (
        f"list_transform(list_filter({TOKENS}, lambda x: length(x) >= {settings.MIN_KEYWORD_LENGTH} "
        r"AND regexp_full_match(x, '\p{L}+')), lambda x: lower(x))"
    )
    found = rf"""
gaz AS (SELECT lower(n_name) AS name, 'GPE' AS listed FROM nation UNION SELECT lower(r_name), 'LOC' FROM region),
sf AS (SELECT doc_id, unnest({SURFACES}) AS surface, generate_subscripts({SURFACES}, 1) - 1 AS pos FROM src),
men AS (SELECT * FROM (SELECT doc_id, pos, surface AS text, coalesce(listed, CASE
      WHEN contains(surface, '@') THEN 'EMAIL'
      WHEN regexp_full_match(surface, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN 'DATE'
      WHEN regexp_full_match(surface, '[0-9]{{1,2}}:[0-9]{{2}}') THEN 'TIME'
      WHEN left(surface, 1) IN ('$', '€', '£') THEN 'MONEY' WHEN ends_with(surface, '%') THEN 'PERCENT'
      WHEN regexp_matches(left(surface, 1), '[0-9]') THEN 'CARDINAL'
      WHEN contains(surface, ' ') THEN 'MISC' END) AS label
    FROM sf LEFT JOIN gaz ON gaz.name = lower(surface)) WHERE label IS NOT NULL),
"""
    return rf"""
src AS (SELECT doc_id, text, language FROM {source}),
{(mentions or found).strip().rstrip(',')},
lab AS (SELECT doc_id, text, label, count(*) AS n, min(pos) AS first FROM men GROUP BY doc_id, text, label),
ent0 AS (SELECT doc_id, text, arg_max(label, row(n, -first)) AS label, sum(n)::BIGINT AS mentions, min(first) AS first
  FROM lab GROUP BY doc_id, text),
ent AS (SELECT doc_id, text, label, {TAG_CASE} AS tag, mentions,
    row_number() OVER (PARTITION BY doc_id ORDER BY mentions DESC, first) - 1 AS rank FROM ent0),
ew AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{M}}\p{{N}}]+')) AS word FROM men),
cw AS (SELECT doc_id, language, unnest({alphabetic}) AS word, generate_subscripts({alphabetic}, 1) - 1 AS pos FROM src),
kc AS (SELECT doc_id, word, count(*) AS n, min(pos) AS first FROM cw
  WHERE NOT ({stop}) AND NOT EXISTS (SELECT 1 FROM ew WHERE ew.doc_id = cw.doc_id AND ew.word = cw.word)
  GROUP BY doc_id, word),
kw AS (SELECT doc_id, word, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, first) - 1 AS rank FROM kc
  QUALIFY rank < {settings.MAX_KEYWORDS}),
tg AS (SELECT doc_id, tag FROM ent UNION SELECT doc_id, word FROM kw),
occ AS (SELECT doc_id, tag FROM ent UNION ALL SELECT doc_id, word FROM kw),
rec AS (SELECT doc_id, language,
    coalesce((SELECT string_agg(concat_ws('~', text, label, tag, mentions::VARCHAR), '|' ORDER BY rank) FROM ent WHERE ent.doc_id = src.doc_id), '') AS entities,
    coalesce((SELECT string_agg(DISTINCT tag, '|' ORDER BY tag) FROM ent WHERE ent.doc_id = src.doc_id), '') AS entity_tags,
    coalesce((SELECT string_agg(word, '|' ORDER BY rank) FROM kw WHERE kw.doc_id = src.doc_id), '') AS keywords,
    coalesce((SELECT string_agg(tag, '|' ORDER BY tag) FROM tg WHERE tg.doc_id = src.doc_id), '') AS tags
  FROM src)"""


TAGGED = mention_ctes(DOCS)
ORACLES["entity_mentions"] = f"WITH {TAGGED} SELECT doc_id, pos, text, label FROM men"
ORACLES["entity_dedupe"] = f"WITH {TAGGED} SELECT doc_id, rank, text, label, tag, mentions FROM ent"
ORACLES["entity_majority"] = f"""
WITH {TAGGED},
rl AS (SELECT doc_id, text, CASE WHEN pos % 3 = 0 THEN 'ORG' ELSE 'PERSON' END AS label, count(*) AS n, min(pos) AS first
  FROM men GROUP BY ALL),
e AS (SELECT doc_id, text, arg_max(label, row(n, -first)) AS label, sum(n)::BIGINT AS mentions, min(first) AS first
  FROM rl GROUP BY doc_id, text)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY mentions DESC, first) - 1 AS rank, text, label, mentions
FROM e"""
ORACLES["entity_tags"] = f"WITH {TAGGED} SELECT doc_id, entity_tags FROM rec"
ORACLES["keyword_candidates"] = f"WITH {TAGGED} SELECT doc_id, word, n, first FROM kc"
ORACLES["top_keywords"] = f"WITH {TAGGED} SELECT doc_id, rank, word FROM kw"
ORACLES["merge_tags"] = f"WITH {TAGGED} SELECT doc_id, tags FROM rec"
ORACLES["tag_documents"] = f"WITH {TAGGED} SELECT doc_id, entities, entity_tags, keywords, tags FROM rec"
ORACLES["tag_counts_doc"] = f"WITH {TAGGED} SELECT doc_id, tag, count(*) AS n FROM occ GROUP BY doc_id, tag"
ORACLES["tag_counts_all"] = f"WITH {TAGGED} SELECT tag, count(*) AS n FROM occ GROUP BY tag"
ROUTED = """(SELECT doc_id, text, CASE WHEN length(text) % 2 = 0 THEN lang ELSE coalesce(detected, 'en') END AS language
  FROM documents LEFT JOIN det USING (doc_id))"""
ORACLES["tag_routed"] = f"WITH {PROFILE_CTES}, {mention_ctes(ROUTED)} SELECT doc_id, language, tags FROM rec"
UPPER_WORDS = (
    f"list_filter(regexp_extract_all(text, {q(f'[^{WS}]+')}), lambda x: length(x) > 1 AND upper(x) = x AND lower(x) <> x)"
)
ORACLES["annotate_plugin"] = f"""
SELECT doc_id, len({UPPER_WORDS}) AS n_mentions, array_to_string({UPPER_WORDS}, '|') AS surfaces,
  NULL::VARCHAR AS error FROM documents"""

# --- features and metrics ----------------------------------------------------

TERMS = f"""
t AS (SELECT doc_id, term, count(*) AS tf FROM (
    SELECT doc_id, unnest(regexp_extract_all(lower(text), {q(TOKEN)})) AS term FROM documents) GROUP BY doc_id, term),
v AS (SELECT term, sum(tf)::BIGINT AS term_count, count(*) AS doc_count,
    ln((1 + (SELECT count(*) FROM documents))::DOUBLE / (1 + count(*))::DOUBLE) + 1 AS idf
  FROM t GROUP BY term ORDER BY term_count DESC, term LIMIT {settings.MAX_FEATURES})"""
ORACLES["tfidf_vocab"] = f"WITH {TERMS} SELECT term, term_count, doc_count, round(idf, 6) AS idf FROM v"
ORACLES["tfidf_weights"] = f"""
WITH {TERMS}, x AS (SELECT doc_id, term, tf * idf AS raw FROM t JOIN v USING (term))
SELECT doc_id, term, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)), 6) AS weight FROM x"""
ORACLES["class_weights"] = """
WITH c AS (SELECT lang AS language, count(*) AS n FROM documents GROUP BY lang)
SELECT language, n, round((SELECT sum(n) FROM c)::DOUBLE / ((SELECT count(*) FROM c) * n), 6) AS weight FROM c"""
ORACLES["score_plugin"] = """
SELECT doc_id, category_id, CASE WHEN length(text) % 4 = category_id THEN 0.9::DOUBLE ELSE 0.0::DOUBLE END AS probability
FROM documents CROSS JOIN (SELECT unnest(range(0, 4)) AS category_id)"""
PROBABILITIES = """
v AS (SELECT vec_id, label, i AS pos, embedding[i]::DOUBLE AS x FROM embeddings CROSS JOIN (SELECT unnest(range(1, 65)) AS i)),
mn AS (SELECT label AS class, pos, round(avg(x), 6) AS mean FROM v GROUP BY label, pos),
z AS (SELECT vec_id, v.label, class, 20.0::DOUBLE * sum(mean * x) AS x FROM v JOIN mn USING (pos) GROUP BY vec_id, v.label, class),
ex AS (SELECT vec_id, label, class, exp(x - max(x) OVER (PARTITION BY vec_id)) AS e FROM z),
pr AS (SELECT vec_id, label, class, round(e / sum(e) OVER (PARTITION BY vec_id), 7) AS p FROM ex)"""
ORACLES["softmax"] = f"WITH {PROBABILITIES} SELECT vec_id, class AS category_id, p AS probability FROM pr"
ORACLES["low_confidence"] = f"""
WITH {PROBABILITIES} SELECT vec_id, round(max(p), 4) AS confidence FROM pr GROUP BY vec_id HAVING round(max(p), 4) < 0.5"""
ORACLES["argmax_confidence"] = f"""
WITH {PROBABILITIES} SELECT vec_id, class AS category_id, round(p, 4) AS confidence FROM pr
QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, class) = 1"""
ORACLES["top3_categories"] = f"""
WITH {PROBABILITIES}
SELECT vec_id, row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, class) - 1 AS rank, class AS category_id,
  round(p, 4) AS probability FROM pr QUALIFY rank < 3"""
ORACLES["eval_accuracy"] = f"SELECT round({accuracy_sql('pred')}, 6) AS accuracy"
ORACLES["eval_macro_f1"] = f"SELECT round({f1_sql('pred')}, 6) AS f1_macro"
ORACLES["confusion_matrix"] = (
    f"SELECT label::BIGINT AS label, pred::BIGINT AS pred, count(*) AS n FROM {PREDICTIONS} GROUP BY label, pred"
)
ORACLES["per_language_accuracy"] = (
    f"SELECT language, round(avg((label = pred)::INT), 4) AS accuracy FROM {PREDICTIONS} GROUP BY language"
)
ORACLES["lift_over_baseline"] = f"""
SELECT round(a, 6) AS accuracy, round(b, 6) AS baseline_accuracy, round((a - b) * 100, 2) AS lift_points
FROM (SELECT {accuracy_sql('pred')} AS a, {accuracy_sql('baseline_pred')} AS b)"""
ORACLES["eval_auc"] = f"""
WITH {PROBABILITIES},
r AS (SELECT class, label = class AS pos,
    rank() OVER (PARTITION BY class ORDER BY p) + (count(*) OVER (PARTITION BY class, p) - 1) / 2.0::DOUBLE AS rk FROM pr),
a AS (SELECT class, (sum(rk) FILTER (pos) - count(*) FILTER (pos) * (count(*) FILTER (pos) + 1) / 2.0::DOUBLE)
    / (count(*) FILTER (pos) * count(*) FILTER (NOT pos)) AS auc FROM r GROUP BY class)
SELECT class::VARCHAR AS class, round(auc, 6) AS auc FROM a UNION ALL SELECT 'macro', round(avg(auc), 6) FROM a"""

# --- scoring -----------------------------------------------------------------


def scores_sql(source: str, before: str = "", named: bool = False, tagging: str | None = None, more: str = "") -> str:
    """The scored record of ``doc_id, text, language``; class is length(clean) % 20."""
    name = (
        f"coalesce((SELECT label_text FROM {MAP.format(where='')} m WHERE m.label = {{0}}), ({{0}})::VARCHAR)"
        if named else "({0})::VARCHAR"
    )
    # The class hit has at least 0.3, the one after it 0.25, and the lowest of the others comes third.
    second = "(hit + 1) % 20"
    third = "CASE hit WHEN 0 THEN 2 WHEN 19 THEN 1 ELSE 0 END"
    top = ", ".join(name.format(c) for c in ("hit", second, third))
    clean = sanitize_sql("coalesce(text, '')")
    return f"""WITH {before}
raw AS (SELECT doc_id, text AS raw_text, {clean} AS text, language FROM {source}),
{(tagging or mention_ctes('raw')).strip()},
sc AS (SELECT doc_id, text, length(text) % 20 AS hit, round((3 + length(text) % 7) / 10.0::DOUBLE, 4) AS confidence,
    CASE WHEN {strip('raw_text')} = '' THEN 'blank' ELSE 'ok' END AS status FROM raw)
SELECT doc_id, status, language, {name.format('hit')} AS category, hit AS category_id, confidence,
  confidence < 0.5 AS low_confidence, concat_ws('|', {top}) AS top_categories, tags, keywords, entities{more}
FROM sc JOIN rec USING (doc_id)"""


DETECTED = (
    "(SELECT doc_id, text, coalesce(detected, 'en') AS language FROM documents LEFT JOIN det USING (doc_id))"
)
ORACLES["score_batch"] = scores_sql(DETECTED, PROFILE_CTES.strip() + ",", named=True)
ORACLES["score_known_language"] = scores_sql(DOCS)
UPPER_CLEAN = (
    f"list_filter(regexp_extract_all(text, {q(f'[^{WS}]+')}), lambda x: length(x) > 1 AND upper(x) = x AND lower(x) <> x)"
)
ORACLES["score_annotated"] = scores_sql(
    DOCS, tagging=mention_ctes("raw", f"""
men AS (SELECT doc_id, generate_subscripts({UPPER_CLEAN}, 1) - 1 AS pos, unnest({UPPER_CLEAN}) AS text, 'ORG' AS label
  FROM src WHERE length(text) % 3 <> 0)"""),
    more=", CASE WHEN length(text) % 3 = 0 THEN 'ValueError: cannot annotate' END AS error",
)
ORACLES["stream_detect"] = scores_sql(ROUTED, PROFILE_CTES.strip() + ",")
ORACLES["stream_score"] = ORACLES["score_known_language"]
CLEAN_TAGGED = f"""
raw AS (SELECT doc_id, {sanitize_sql('text')} AS text, lang AS language FROM documents),
{mention_ctes('raw').strip()}"""
ORACLES["stream_tag_counts"] = f"WITH {CLEAN_TAGGED} SELECT tag, count(*) AS n FROM occ GROUP BY tag"
ORACLES["stream_monitor"] = f"""
WITH raw AS (SELECT lang AS language, {sanitize_sql("coalesce(text, '')")} AS text FROM documents)
SELECT language, count(*) AS documents, round(avg(confidence), 6) AS mean_confidence,
  count(*) FILTER (confidence < 0.5) AS low_confidence
FROM (SELECT language, (3 + length(text) % 7) / 10.0::DOUBLE AS confidence FROM raw) GROUP BY language"""

# --- compression -------------------------------------------------------------

ENTRIES = """e AS (SELECT vec_id, label, i - 1 AS idx, embedding[i] AS w
  FROM embeddings CROSS JOIN (SELECT unnest(range(1, 65)) AS i))"""


def prune_sql(tensor: str, order: str) -> str:
    return f"""{ENTRIES},
rk AS (SELECT *, row_number() OVER (PARTITION BY {tensor} ORDER BY abs(w), {order}) AS rn,
  count(*) OVER (PARTITION BY {tensor}) AS size FROM e),
cut AS (SELECT *, max(CASE WHEN rn = floor(0.3::DOUBLE * size)::BIGINT THEN abs(w) END) OVER (PARTITION BY {tensor}) AS threshold FROM rk)"""


ORACLES["prune_vectors"] = f"""
WITH {prune_sql('vec_id', 'idx')}
SELECT vec_id, idx, CASE WHEN abs(w) > threshold THEN w ELSE 0 END::DOUBLE AS w FROM cut"""
ORACLES["prune_long"] = f"""
WITH {prune_sql('label', 'vec_id, idx')}
SELECT label::VARCHAR AS tensor, vec_id * 64 + idx AS idx, CASE WHEN abs(w) > threshold THEN w ELSE 0 END::DOUBLE AS w
FROM cut"""
ORACLES["prune_report"] = f"""
WITH {prune_sql('vec_id', 'idx')},
p AS (SELECT vec_id, CASE WHEN abs(w) > threshold THEN w ELSE 0 END AS w FROM cut WHERE label % 2 = 0)
SELECT 0.3::DOUBLE AS target_sparsity, count(*) AS params_total, count(*) FILTER (w = 0) AS params_zeroed,
  count(DISTINCT vec_id) AS tensors_pruned, round(count(*) FILTER (w = 0) / count(*)::DOUBLE, 4) AS achieved_sparsity FROM p"""


def half_sql(w: str) -> str:
    a = f"abs({w}::DOUBLE)"
    step = f"power(2.0::DOUBLE, greatest(floor(log2({a})), -14.0::DOUBLE) - 10.0::DOUBLE)"
    return f"(CASE WHEN {w} = 0 THEN 0.0::DOUBLE ELSE round_even({w}::DOUBLE / {step}, 0) * {step} END)"


ORACLES["fp16_vectors"] = f"WITH {ENTRIES} SELECT vec_id::VARCHAR AS tensor, idx, {half_sql('w')} AS w FROM e"
ORACLES["int8_vectors"] = f"""
WITH {ENTRIES}, s AS (SELECT *, max(abs(w)) OVER (PARTITION BY vec_id)::DOUBLE / 127.0::DOUBLE AS scale FROM e)
SELECT vec_id::VARCHAR AS tensor, idx, CASE WHEN scale > 0 THEN round_even(w::DOUBLE / scale, 0)::BIGINT ELSE 0 END AS code FROM s"""
ORACLES["artifact_size"] = """
SELECT variant, sum(len(embedding))::BIGINT AS params, round(sum(len(embedding)) * bytes / 1000000.0::DOUBLE, 2) AS size_mb
FROM embeddings CROSS JOIN (VALUES ('original', 4), ('pruned', 4), ('fp16', 2), ('int8', 1)) v(variant, bytes)
GROUP BY variant, bytes"""
HALF = half_sql("w")
def sweep_sql(train: str, evaluated: str) -> str:
    """Report of the sweep: weights are the label means of ``train`` vectors."""
    return f"""WITH {ENTRIES},
c AS (SELECT label::VARCHAR AS tensor, idx, avg(w::DOUBLE)::FLOAT AS w FROM e WHERE vec_id IN ({train}) GROUP BY label, idx),
cr AS (SELECT *, row_number() OVER (PARTITION BY tensor ORDER BY abs(w), idx) AS rn FROM c),
ct AS (SELECT tensor, abs(w) AS threshold FROM cr WHERE rn = 19),
pr AS (SELECT tensor, idx, CASE WHEN abs(w) > threshold THEN w ELSE 0 END AS w FROM c JOIN ct USING (tensor)),
fp AS (SELECT tensor, idx, {HALF}::FLOAT AS w FROM pr),
m AS (SELECT 'original' AS variant, * FROM c UNION ALL SELECT 'pruned', * FROM pr UNION ALL SELECT 'fp16', * FROM fp),
d AS (SELECT variant, vec_id, label, tensor, sum(m.w::DOUBLE * e.w::DOUBLE) AS dot FROM e JOIN m USING (idx)
  WHERE vec_id IN ({evaluated}) GROUP BY ALL),
b AS (SELECT variant, label::VARCHAR = tensor AS hit FROM d
  QUALIFY row_number() OVER (PARTITION BY variant, vec_id ORDER BY dot DESC, tensor) = 1),
acc AS (SELECT variant, round(avg(hit::INT), 4) AS accuracy FROM b GROUP BY variant),
n AS (SELECT count(*) AS params FROM c),
s AS (SELECT variant, bytes, params * bytes AS size, params FROM n
  CROSS JOIN (VALUES ('original', 4), ('pruned', 4), ('fp16', 2), ('int8', 1)) v(variant, bytes))
SELECT variant, 'size_bytes' AS metric, size::DOUBLE AS value FROM s
UNION ALL SELECT variant, 'size_reduction_pct', round(100.0::DOUBLE * (1.0::DOUBLE - size / (params * 4)::DOUBLE), 1) FROM s
UNION ALL SELECT variant, 'accuracy', accuracy FROM acc
UNION ALL SELECT variant, 'accuracy_drop', round((SELECT accuracy FROM acc WHERE variant = 'original') - accuracy, 4) FROM acc
UNION ALL SELECT 'pruned', 'achieved_sparsity', round(count(*) FILTER (w = 0) / count(*)::DOUBLE, 4) FROM pr"""


ALL_VECTORS = "SELECT vec_id FROM embeddings"
VECTOR_SPLIT = split_sql("(SELECT vec_id AS doc_id, label FROM embeddings)", "label")
ORACLES["compression_report"] = sweep_sql(ALL_VECTORS, ALL_VECTORS)
ORACLES["optimize_weights"] = sweep_sql(
    f"SELECT doc_id FROM {VECTOR_SPLIT} WHERE split = 'train'",
    f"SELECT doc_id FROM {VECTOR_SPLIT} WHERE split = 'val' ORDER BY {digest('doc_id')}, doc_id LIMIT {settings.EVAL_SAMPLE}",
)
ORACLES["score_blank_status"] = f"""
WITH d AS (SELECT doc_id, {DAMAGED} AS text, 'en' AS language FROM documents),
raw AS (SELECT doc_id, text AS raw_text, {sanitize_sql('text')} AS text, lang AS language
  FROM d JOIN (SELECT doc_id, lang FROM documents) USING (doc_id)),
{mention_ctes('raw').replace('FROM nation UNION SELECT lower(r_name), ' + q('LOC') + ' FROM region',
                             'FROM nation WHERE false').strip()}
SELECT doc_id, CASE WHEN {strip('raw_text')} = '' THEN 'blank' ELSE 'ok' END AS status,
  (SELECT count(*) FROM tg WHERE tg.doc_id = raw.doc_id) AS n_tags FROM raw"""

# --- trained models: facts that hold for any right fit ------------------------

QUALITY = f"""(SELECT doc_id, label, clean_text FROM (
  SELECT doc_id, quality AS label, {sanitize_sql("coalesce(text, '')")} AS clean_text FROM documents JOIN labels USING (doc_id))
  WHERE {words('clean_text')} >= 1)"""
VALIDATION = f"(SELECT * FROM {split_sql(QUALITY, 'label')} WHERE split = 'val')"
ORACLES["baseline_gradient"] = "SELECT true AS flatter, count(DISTINCT quality) AS classes FROM labels"
ORACLES["baseline_proba_equal"] = f"""
SELECT doc_id, category_id, true AS equal FROM {VALIDATION} CROSS JOIN (SELECT unnest(range(0, 2)) AS category_id)"""
ORACLES["training_history_falls"] = "SELECT true AS moved, true AS falls"
ORACLES["select_model_kept"] = """
SELECT unnest(range(0, 2)) AS candidate, true AS kept_is_best, true AS best_is_returned"""
ORACLES["model_roundtrip"] = f"SELECT doc_id, true AS equal FROM {VALIDATION}"


# --- names, session state and artifacts ---------------------------------------

ORACLES["name_mentions"] = r"""
WITH listed AS (
  SELECT lower(n_name) AS name, 'GPE' AS label FROM nation UNION ALL SELECT lower(r_name), 'LOC' FROM region
  UNION ALL SELECT lower(array_to_string(string_split(text, ' ')[1:4], ' ')), 'PASSAGE' FROM benchmark
), names AS (SELECT name, min(label) AS label FROM listed WHERE label <> 'PASSAGE' OR regexp_full_match(name, '[a-z]+( [a-z]+)*') GROUP BY name
), pattern AS (SELECT '\b(?:' || string_agg(name, '|' ORDER BY length(name) DESC, name) || ')\b' AS p FROM names
), found AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), p)) AS name FROM documents, pattern)
SELECT doc_id, name, label, count(*) AS n FROM found JOIN names USING (name) GROUP BY ALL"""

ORACLES["stream_session_tags"] = """
WITH cleared AS (SELECT user_id, max(ts) FILTER (event_type = 'error') AS last FROM events GROUP BY user_id)
SELECT user_id::VARCHAR AS session, event_type AS tag, count(*) AS n
FROM events JOIN cleared USING (user_id) WHERE last IS NULL OR ts > last GROUP BY ALL"""

ORACLES["stream_frequent_words"] = f"""
WITH counts AS (SELECT tag, count(*) AS n FROM (SELECT unnest({TOKENS.replace("(text,", "(lower(text),")}) AS tag FROM documents) GROUP BY tag)
SELECT tag, n, true AS held FROM counts WHERE n * 400 > (SELECT sum(n) FROM counts)"""

ORACLES["artifact_roundtrip"] = f"""
WITH {prune_sql('vec_id', 'idx')}, p AS (SELECT vec_id, CASE WHEN abs(w) > threshold THEN w ELSE 0 END AS w FROM cut)
SELECT vec_id, count(*) AS params, count(*) FILTER (w <> 0) AS kept, round(sum(abs(w::DOUBLE)), 6) AS weight FROM p GROUP BY vec_id"""
