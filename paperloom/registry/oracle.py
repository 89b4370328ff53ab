"""The registered queries in plain SQL, written against the tables; word lists and missing texts are the library's."""

from __future__ import annotations

from paperloom.functions.wordlists import CORPUS_CATEGORIES, MISSING_TEXTS, QUERY_CATEGORIES, stop_words


def _quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


WORDS = r"regexp_extract_all(lower(text), '([\p{L}\p{N}_]{2,})', 1)"
# The marks that split a word, as the body of a character class inside a quoted string.
MARKS = r""".,?!:;‘’`“”"''~()\[\]{}"""
SPACES = r"\p{Z}\t\n\x0B\f\r\x1C-\x1F\x85"


def _pieces(text) -> str:
    return f"regexp_extract_all(lower({text}), '([^{SPACES}{MARKS}]+|[{MARKS}])', 1)"



TITLE = "split_part(text, chr(10), 1)"
ABSTRACT = "substr(text, length(split_part(text, chr(10), 1)) + 2)"
MONTHS = "['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec']"
SEASONS = "['Spring','Summer','Fall','Winter']"

_TOKENS = f"""
toks AS (
  SELECT doc_id, unnest(w) AS term, unnest(range(len(w))) AS pos
  FROM (SELECT doc_id, {WORDS} AS w FROM documents)
)"""
_PAIRS = """
pairs AS (
  SELECT doc_id, term || ' ' || follower AS term
  FROM (SELECT doc_id, term, lead(term) OVER (PARTITION BY doc_id ORDER BY pos) AS follower FROM toks)
  WHERE follower IS NOT NULL
)"""
_UNIGRAM_TF = "tf AS (SELECT doc_id, term, count(*) AS tf FROM toks GROUP BY doc_id, term)"
_BIGRAM_TF = f"{_PAIRS.strip()}, tf AS (SELECT doc_id, term, count(*) AS tf FROM pairs GROUP BY doc_id, term)"
_IDF = """
n AS (SELECT count(*) AS n FROM documents),
dfs AS (
  SELECT term, count(*) AS df, ln((1e0 + any_value(n.n)) / (1e0 + count(*))) + 1e0 AS idf
  FROM tf, n GROUP BY term
)"""
TF = {"unigram": _UNIGRAM_TF, "bigram": _BIGRAM_TF}
RAW = {"freq": "CAST(tf AS DOUBLE)", "binary": "1e0", "tfidf": "tf * idf"}


def _tf_sql(feature):
    return f"WITH {_TOKENS}, {TF[feature]} SELECT doc_id, term, tf FROM tf"


def _binary_sql(feature):
    return f"WITH {_TOKENS}, {TF[feature]} SELECT doc_id, term, CAST(1 AS INTEGER) AS weight FROM tf"


def _tfidf_sql(feature):
    return f"""WITH {_TOKENS}, {TF[feature]}, {_IDF},
raw AS (SELECT doc_id, term, tf * idf AS w FROM tf JOIN dfs USING (term)),
norms AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM raw GROUP BY doc_id)
SELECT doc_id, term, round(w / norm, 6) AS weight FROM raw JOIN norms USING (doc_id)"""


_QUERY_WORDS = f"""
qtoks AS (
  SELECT query_id, unnest(w) AS term, unnest(range(len(w))) AS pos
  FROM (SELECT query_id, {WORDS} AS w FROM asked)
)"""
_ASKED = "asked AS (SELECT item_id AS query_id, text FROM benchmark WHERE trim(text) <> '')"
_QUERY_TF = {
    "unigram": "qtf AS (SELECT query_id, term, count(*) AS tf FROM qtoks GROUP BY query_id, term)",
    "bigram": """qpairs AS (
  SELECT query_id, term || ' ' || follower AS term
  FROM (SELECT query_id, term, lead(term) OVER (PARTITION BY query_id ORDER BY pos) AS follower FROM qtoks)
  WHERE follower IS NOT NULL
), qtf AS (SELECT query_id, term, count(*) AS tf FROM qpairs GROUP BY query_id, term)""",
}


def _search_ctes(feature, weighting, tokens=_TOKENS, asked=_ASKED):
    """CTEs up to `scores` (query_id, doc_id, score)."""
    raw = RAW[weighting]
    return f"""{tokens}, {TF[feature]}, {_IDF}, {asked}, {_QUERY_WORDS}, {_QUERY_TF[feature]},
dw AS (SELECT doc_id, term, {raw} AS w FROM tf JOIN dfs USING (term)),
dn AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM dw GROUP BY doc_id),
qw AS (SELECT query_id, term, df, {raw} AS w FROM qtf JOIN dfs USING (term)),
qn AS (SELECT query_id, sqrt(sum(w * w)) AS norm FROM qw GROUP BY query_id),
scores AS (
  SELECT query_id, doc_id, round(sum((qw.w / qn.norm) * (dw.w / dn.norm)), 9) AS score
  FROM qw JOIN qn USING (query_id) JOIN dw USING (term) JOIN dn USING (doc_id)
  GROUP BY query_id, doc_id
)"""


_RANK = "CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id DESC) AS INTEGER)"


def _top_sql(feature, weighting, score="score"):
    return f"""WITH {_search_ctes(feature, weighting)},
ranked AS (SELECT query_id, doc_id, score, {_RANK} AS rank FROM scores)
SELECT query_id, rank, doc_id, {score} FROM ranked WHERE rank <= 10"""


def _padded_sql(feature, weighting, tokens=_TOKENS, asked=_ASKED, extra=""):
    return f"""SELECT {extra}query_id, rank, doc_id, score FROM (
WITH {_search_ctes(feature, weighting, tokens, asked)},
everything AS (
  SELECT a.query_id, d.doc_id, coalesce(s.score, 0e0) AS score
  FROM asked a CROSS JOIN documents d LEFT JOIN scores s ON s.query_id = a.query_id AND s.doc_id = d.doc_id
)
SELECT query_id, doc_id, score, {_RANK} AS rank FROM everything
) WHERE rank <= 10"""


_VARIANTS = "\nUNION ALL\n".join(
    _padded_sql(f, w, extra=f"'{f}' AS feature, '{w}' AS weighting, ") for f in TF for w in RAW
)

# ---- normalisation


def _normal(text, words):
    # a list comprehension keeps the order
    return f"array_to_string([x FOR x IN {_pieces(text)} IF x NOT IN ({_quoted(words)})], ' ')"


def _blanked(text):
    return f"CASE WHEN {text} IS NULL OR {text} IN ({_quoted(MISSING_TEXTS)}) THEN '' ELSE {text} END"


_STOP = stop_words(QUERY_CATEGORIES)
_KEEP_AND = stop_words(CORPUS_CATEGORIES)
_NORMAL_DOCS = f"SELECT doc_id, {_normal('text', _STOP)} AS normalized FROM documents"
_RULES = (("ies", "y"), ("sses", "ss"), ("es", "e"), ("s", ""), ("ing", ""), ("ing", "e"), ("ed", ""), ("ed", "e"))
_PROPOSALS = "\n  UNION ALL\n".join(
    f"  SELECT token, {i} AS rule_no, left(token, length(token) - {len(a)}) || '{b}' AS lemma "
    f"FROM vocab WHERE token LIKE '%{a}' AND length(token) >= {len(a) + 3}"
    for i, (a, b) in enumerate(_RULES)
)
_LEMMA_SQL = f"""
WITH pieces AS (
  SELECT doc_id, unnest(p) AS token, unnest(range(len(p))) AS pos
  FROM (SELECT doc_id, {_pieces('text')} AS p FROM documents)
),
kept AS (SELECT * FROM pieces WHERE token NOT IN ({_quoted(_STOP)})),
vocab AS (SELECT DISTINCT token FROM kept),
proposed AS (
{_PROPOSALS}
),
lemmas AS (
  SELECT token, arg_min(lemma, rule_no) AS lemma
  FROM proposed WHERE lemma IN (SELECT token FROM vocab) GROUP BY token
),
texts AS (
  SELECT doc_id, string_agg(coalesce(lemma, token), ' ' ORDER BY pos) AS normalized
  FROM kept LEFT JOIN lemmas USING (token) GROUP BY doc_id
)
SELECT doc_id, coalesce(normalized, '') AS normalized FROM documents LEFT JOIN texts USING (doc_id)"""

# ---- dates

_Y = "CAST(1990 + n_chars % 35 AS VARCHAR)"
_D = "CAST(n_chars % 28 + 1 AS VARCHAR)"
_M = f"{MONTHS}[n_chars % 12 + 1]"
_M2 = f"{MONTHS}[(n_chars + 5) % 12 + 1]"
_S = f"{SEASONS}[n_chars % 4 + 1]"
CITATION_DATE = f"""CASE WHEN n_chars % 11 = 0 THEN {_Y} || ' Foo' WHEN lang = 'es' THEN {_Y}
  WHEN lang = 'de' THEN {_Y} || ' ' || {_S} WHEN lang = 'fr' THEN {_Y} || ' ' || {_M} || '-' || {_M2} || ' ' || {_D}
  ELSE {_Y} || ' ' || {_M} || ' ' || {_D} END"""
_NO = "CAST(n_chars % 12 + 1 AS VARCHAR)"
_NO2 = "CAST((n_chars + 5) % 12 + 1 AS VARCHAR)"
_SEASON_DAY = "['20/03','21/06','22/09','21/12'][n_chars % 4 + 1]"
PARSED_DATE = f"""CASE WHEN n_chars % 11 = 0 THEN NULL WHEN lang = 'es' THEN '01/01/' || {_Y}
  WHEN lang = 'de' THEN {_SEASON_DAY} || '/' || {_Y}
  WHEN lang = 'fr' THEN lpad({_D}, 2, '0') || '/' || lpad({_NO2}, 2, '0') || '/' || {_Y}
  ELSE lpad({_D}, 2, '0') || '/' || lpad({_NO}, 2, '0') || '/' || {_Y} END"""


def _dateline(n):
    """Date shown by a dateline that is made from the number n."""
    text = f"CAST({n} % 31 + 1 AS VARCHAR) || ' ' || {MONTHS}[{n} % 12 + 1] || ' ' || CAST(1990 + {n} % 35 AS VARCHAR)"
    return f"CASE WHEN {n} % 13 = 0 THEN 'N/A' ELSE strftime(try_strptime({text}, '%d %b %Y'), '%d/%m/%Y') END"


# ---- citation records

_NBIB = f"""
rendered AS (
  SELECT doc_id, concat_ws(chr(10),
    'PMID- ' || doc_id,
    'TI  - ' || {TITLE},
    'LID - S' || doc_id || ' [pii]',
    CASE WHEN lang <> 'de' THEN 'LID - 10.5555/' || doc_id || ' [doi]' END,
    'AB  - ' || replace({ABSTRACT}, chr(10), chr(10) || '      '),
    'FAU - Full, Name',
    'AU  - ' || lang,
    'AU  - ' || source,
    'DP  - ' || {CITATION_DATE},
    CASE WHEN lang <> 'es' OR n_chars % 2 = 0 THEN 'JT  - ' || source END,
    'AB  - Second block' || chr(10) || '      and its continuation') AS record
  FROM documents
),
lines AS (
  SELECT doc_id, trim(unnest(l)) AS line, unnest(range(len(l))) AS n
  FROM (SELECT doc_id, string_split(record, chr(10)) AS l FROM rendered)
),
tagged AS (
  SELECT doc_id, n, line, nullif(regexp_extract(line, '^([A-Z]{{2,4}})\\s*-\\s*(.*)', 1), '') AS tag,
    regexp_extract(line, '^([A-Z]{{2,4}})\\s*-\\s*(.*)', 2) AS v
  FROM lines WHERE line <> ''
),
owned AS (
  SELECT *, last_value(tag IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS owner
  FROM tagged
),
firsts AS (SELECT doc_id, min(n) AS first_ab FROM owned WHERE tag = 'AB' GROUP BY doc_id),
found AS (
  SELECT doc_id,
    coalesce(split_part(arg_max(v, n) FILTER (WHERE tag = 'LID' AND contains(line, '[doi]')), ' ', 1),
             arg_min(v, n) FILTER (WHERE tag = 'LID')) AS "DOI",
    arg_min(v, n) FILTER (WHERE tag = 'TI') AS "Title",
    string_agg(v, ', ' ORDER BY n) FILTER (WHERE tag = 'AU') AS "Authors",
    string_agg(CASE WHEN tag = 'AB' THEN v ELSE line END, ' ' ORDER BY n)
      FILTER (WHERE owner = 'AB' AND (tag IS NULL OR n = first_ab)) AS "Abstract",
    arg_min(v, n) FILTER (WHERE tag = 'JT') AS "Journal"
  FROM owned JOIN firsts USING (doc_id) GROUP BY doc_id
),
recs AS (SELECT found.*, {PARSED_DATE} AS "Date" FROM found JOIN documents USING (doc_id))"""
_FIELDS = ("Title", "Authors", "Abstract", "Journal", "Date", "DOI")
_COMPLETE = " AND ".join(f"""coalesce("{f}", '') <> ''""" for f in _FIELDS)
_MISSING = " ".join(f"""WHEN coalesce("{f}", '') = '' THEN '{f}'""" for f in _FIELDS)
_SIX = '"DOI", "Title", "Authors", "Abstract", "Journal", "Date"'

_FIRST_LINE = f"trim(split_part({ABSTRACT}, chr(10), 1))"
_RIS_TITLE = f"CASE WHEN lang = 'fr' THEN 'Second title of ' || source ELSE trim({TITLE}) END"
_RIS_ABSTRACT = f"CASE WHEN n_chars % 3 = 0 THEN 'A note' ELSE {_FIRST_LINE} END"
_RIS_FULL_ABSTRACT = (
    f"CASE WHEN n_chars % 3 = 0 THEN 'A note' ELSE trim(regexp_replace({ABSTRACT}, '\\s*\\n\\s*', ' ', 'g')) END"
)
_BRACED = "translate({}, '{{}}', '()')"
_BIB_TITLE = "'The {W}hole of ' || " + _BRACED.format(TITLE)
_BIB_TEXT = "regexp_replace(" + _BRACED.format(ABSTRACT) + ", '\\n[ \\t]+', chr(10), 'g')"
_BIB_ABSTRACT = f"CASE WHEN lang IN ('en', 'de') THEN {_BIB_TEXT} END"
_BIB_NOTE = f"CASE WHEN lang = 'fr' THEN {_BIB_TEXT} END"
_EXT = "CASE n_chars % 4 WHEN 0 THEN '.ris' WHEN 1 THEN '.txt' ELSE '.bib' END"


def _file_text(rows):
    return f"""SELECT doc_id, trim(CASE WHEN n_chars % 4 = 0 THEN {_RIS_TITLE} || ' ' || {_RIS_ABSTRACT}
  ELSE {_BIB_TITLE} || ' ' || coalesce({_BIB_ABSTRACT}, {_BIB_NOTE}, '') END) AS text
FROM {rows} WHERE n_chars % 4 <> 1"""


_ASKED_FILES = f"""
files AS (SELECT item_id AS doc_id, text, 'en' AS lang, 'asked' AS source, length(text) AS n_chars FROM benchmark),
plain AS ({_file_text('files')}),
asked AS (SELECT doc_id AS query_id, {_normal('text', _STOP)} AS text FROM plain)"""
# ---- saved pages

_ENTRIES = """
entries AS (
  SELECT page_id, page_id // 12 AS section_no, page_id % 12 AS page_no, unnest(p) AS paragraph, unnest(range(len(p))) AS i
  FROM (SELECT page_id, regexp_extract_all(html, '<p>([^<]*)</p>', 1) AS p FROM pages)
)"""
_TEXT = "replace(replace(replace(replace(paragraph, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;', '&')"
_NUMBER = "CAST(page_id AS VARCHAR) || '.' || CAST(i AS VARCHAR)"
_ENTRY_FIELDS = f"""'10.48550/arXiv.' || {_NUMBER} AS "DOI", trim({_TEXT}) AS "Title", 'Ana & Bo, C. ' || i AS "Authors" """
_N = "length(paragraph)"
_SHOWN_DATE = _dateline(_N)
_SHOWN_ABSTRACT = f"""CASE WHEN {_N} % 7 = 0 THEN 'N/A' ELSE 'On ' || replace({_TEXT}, chr(10), ' ') || ' in full' END"""
_SECTION = "'https://arxiv.org/list/s' || section_no || '/recent'"
_VALID = f"i % 4 <> 3 AND {_N} > 20 AND {_SHOWN_DATE} IS NOT NULL"

# ---- article tables

_ARTICLES = f"""
articles AS (
  SELECT doc_id, '10.48550/arXiv.' || doc_id AS "DOI", {TITLE} AS "Title",
    CASE WHEN lang <> 'fr' THEN source || ', ' || lang END AS "Authors",
    CASE WHEN {ABSTRACT} = '' THEN 'N/A' ELSE {ABSTRACT} END AS "Abstract",
    source AS "Section",
    CASE WHEN lang = 'es' THEN 'N/A' ELSE strftime(DATE '2000-01-01' + CAST(n_chars AS INTEGER), '%d/%m/%Y') END AS "Date"
  FROM documents
)"""
_ARTICLE_COLUMNS = ("DOI", "Title", "Authors", "Abstract", "Section", "Date")
_ARTICLE_LIST = ", ".join(f'"{c}"' for c in _ARTICLE_COLUMNS)
_NULLS = ", ".join(f'count(*) FILTER (WHERE "{c}" IS NULL) AS "{c}_nulls"' for c in _ARTICLE_COLUMNS)
_NAS = ", ".join(f"""count(*) FILTER (WHERE "{c}" = 'N/A') AS "{c}_na\"""" for c in _ARTICLE_COLUMNS)


def _normal_column(name):
    text = _blanked(f'"{name}"')
    return lambda words, empty="{}": f'{empty.format(_normal(f"({text})", words))} AS "{name}"'


_NORMAL_TITLE, _NORMAL_ABSTRACT = _normal_column("Title"), _normal_column("Abstract")
_ARTICLE_TOKENS = f"""{_ARTICLES},
normal AS (SELECT doc_id, {_NORMAL_TITLE(_STOP)}, {_NORMAL_ABSTRACT(_STOP)} FROM articles),
combined AS (SELECT doc_id, ({_blanked('"Title"')}) || ' ' || ({_blanked('"Abstract"')}) AS text FROM normal),
toks AS (
  SELECT doc_id, unnest(w) AS term, unnest(range(len(w))) AS pos
  FROM (SELECT doc_id, {WORDS} AS w FROM combined)
)"""



def _split_kept(rows, key):
    """(key, token, pos) of the tokens of `rows` (key, text) that the word lists leave."""
    return f"""SELECT * FROM (
  SELECT {key}, unnest(p) AS token, unnest(range(len(p))) AS pos FROM (SELECT {key}, {_pieces('text')} AS p FROM {rows})
) WHERE token NOT IN ({_quoted(_STOP)})"""


_LEMMA_TOKENS = f"""{_ARTICLES},
raw_texts AS (SELECT doc_id, ({_blanked('"Title"')}) || ' ' || ({_blanked('"Abstract"')}) AS text FROM articles),
kept AS ({_split_kept('raw_texts', 'doc_id')}),
vocab AS (SELECT DISTINCT token FROM kept),
proposed AS (
{_PROPOSALS}
),
lemmas AS (
  SELECT token, arg_min(lemma, rule_no) AS lemma
  FROM proposed WHERE lemma IN (SELECT token FROM vocab) GROUP BY token
),
combined AS (
  SELECT doc_id, string_agg(coalesce(lemma, token), ' ' ORDER BY pos) AS text
  FROM kept LEFT JOIN lemmas USING (token) GROUP BY doc_id
),
toks AS (
  SELECT doc_id, unnest(w) AS term, unnest(range(len(w))) AS pos
  FROM (SELECT doc_id, {WORDS} AS w FROM combined)
)"""
_LEMMA_ASKED = f"""
files AS (SELECT item_id AS doc_id, text, 'en' AS lang, 'asked' AS source, length(text) AS n_chars FROM benchmark),
plain AS ({_file_text('files')}),
asked_kept AS ({_split_kept('plain', 'doc_id')}),
asked AS (
  SELECT doc_id AS query_id, string_agg(coalesce(lemma, token), ' ' ORDER BY pos) AS text
  FROM asked_kept LEFT JOIN lemmas USING (token) GROUP BY doc_id
)"""

ORACLE_SQL = {
    "top10_similar": _top_sql("unigram", "tfidf"),
    "tokens": f"WITH {_TOKENS} SELECT doc_id, CAST(pos AS INTEGER) AS pos, term FROM toks",
    "bigrams": f"WITH {_TOKENS}, {_PAIRS} SELECT doc_id, term FROM pairs",
    "tf_unigram": _tf_sql("unigram"),
    "tf_bigram": _tf_sql("bigram"),
    "binary_unigram": _binary_sql("unigram"),
    "binary_bigram": _binary_sql("bigram"),
    "tfidf_unigram": _tfidf_sql("unigram"),
    "tfidf_bigram": _tfidf_sql("bigram"),
    "vocabulary": f"""WITH {_TOKENS}
SELECT term, row_number() OVER (ORDER BY term) - 1 AS term_idx, count(DISTINCT doc_id) AS df FROM toks GROUP BY term""",
    "doc_freq": f"WITH {_TOKENS}, {_UNIGRAM_TF}, {_IDF} SELECT term, df, round(idf, 6) AS idf FROM dfs",
    "doc_norms": f"""WITH {_TOKENS}, {_UNIGRAM_TF}, {_IDF}
SELECT doc_id, round(sqrt(sum(CAST(tf AS DOUBLE) * tf)), 6) AS norm_freq, round(sqrt(CAST(count(*) AS DOUBLE)), 6) AS norm_binary,
  round(sqrt(sum(tf * idf * tf * idf)), 6) AS norm_tfidf
FROM tf JOIN dfs USING (term) GROUP BY doc_id""",
    "query_vectors": f"""WITH {_search_ctes('unigram', 'tfidf')}
SELECT query_id, term, df, round(w / norm, 6) AS weight FROM qw JOIN qn USING (query_id)""",
    "cosine_scores": f"WITH {_search_ctes('unigram', 'tfidf')} SELECT query_id, doc_id, round(score, 6) AS score FROM scores",
    "topk_padded": _padded_sql("bigram", "freq"),
    "topk_ranked": _top_sql("unigram", "binary", "printf('%.6f', score) AS score_text"),
    "load_index": f"WITH {_TOKENS}, {_BIGRAM_TF} SELECT doc_id, term, tf, CAST(tf AS DOUBLE) AS weight FROM tf",
    "search_variants": _VARIANTS,
    "search_segments": _VARIANTS,
    "search_compacted": _VARIANTS,
    "search_files": _padded_sql("unigram", "tfidf", _ARTICLE_TOKENS, _ASKED_FILES),
    "search_reindexed": _padded_sql("unigram", "tfidf", _ARTICLE_TOKENS, _ASKED_FILES),
    "search_lemmas": _padded_sql("unigram", "tfidf", _LEMMA_TOKENS, _LEMMA_ASKED),
    "normalize_docs": _NORMAL_DOCS,
    "normalize_compat": f"WITH {_ARTICLES} SELECT doc_id, {_NORMAL_TITLE(_KEEP_AND)}, {_NORMAL_ABSTRACT(_KEEP_AND)} FROM articles",
    "lemma_join": _LEMMA_SQL,
    "doc_index": "SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS doc_idx FROM documents",
    "nbib_records": f"WITH {_NBIB} SELECT doc_id, {_SIX} FROM recs",
    "complete_records": f"WITH {_NBIB} SELECT doc_id, {_SIX} FROM recs WHERE {_COMPLETE}",
    "rejects": f"WITH {_NBIB} SELECT doc_id, CASE {_MISSING} END AS missing_field FROM recs WHERE NOT ({_COMPLETE})",
    "nbib_bulk": f"""WITH {_NBIB} SELECT doc_id // 20 AS file_no,
  CAST(row_number() OVER (PARTITION BY doc_id // 20 ORDER BY doc_id) - 1 AS INTEGER) AS record_no, {_SIX} FROM recs""",
    "journal_all": f"WITH {_NBIB} SELECT {_SIX} FROM recs WHERE {_COMPLETE}",
    "cap_global": f"WITH {_NBIB} SELECT doc_id, {_SIX} FROM recs WHERE {_COMPLETE} ORDER BY doc_id LIMIT 300",
    "ris_records": f"SELECT doc_id, {_RIS_TITLE} AS title, {_RIS_ABSTRACT} AS abstract FROM documents",
    "ris_full": f"SELECT doc_id, {_RIS_TITLE} AS title, {_RIS_FULL_ABSTRACT} AS abstract FROM documents",
    "bib_records": f"""SELECT doc_id, 'article' AS "ENTRYTYPE", 'key' || doc_id AS "ID", {_BIB_TITLE} AS title,
  'A. Author and {{B. \\"Author}}' AS author, {_BIB_ABSTRACT} AS abstract, {_BIB_NOTE} AS note,
  'January' AS month, '2024' AS year FROM documents""",
    "dispatch_ext": f"SELECT doc_id, {_EXT} AS extension, n_chars % 4 <> 1 AS supported FROM documents",
    "rejected_files": """SELECT '/saved/' || source || '/v1.' || doc_id || '.txt' AS path, 'unsupported extension: .txt' AS reason
FROM documents WHERE n_chars % 4 = 1""",
    "query_rejects": """SELECT '/saved/' || source || '/v1.' || doc_id || '.txt' AS path, 'unsupported extension: .txt' AS reason
FROM documents WHERE n_chars % 4 = 1""",
    "query_text": f"SELECT doc_id, text FROM ({_file_text('documents')}) WHERE text <> ''",
    "display_text": f"""SELECT doc_id, CASE WHEN n_chars % 4 = 0 THEN {_RIS_ABSTRACT}
  ELSE coalesce({_BIB_ABSTRACT}, {_BIB_NOTE}, '''Abstract'' no encontrado en el archivo.') END AS text
FROM documents WHERE n_chars % 4 <> 1""",
    "parse_pubdate": f"""SELECT doc_id, {PARSED_DATE} AS padded,
  CASE WHEN n_chars % 11 = 0 OR lang = 'de' THEN NULL WHEN lang = 'es' THEN '01/01/' || {_Y}
    WHEN lang = 'fr' THEN {_D} || '/' || lpad({_NO2}, 2, '0') || '/' || {_Y}
    ELSE {_D} || '/' || lpad({_NO}, 2, '0') || '/' || {_Y} END AS unpadded,
  CASE WHEN n_chars % 11 = 0 OR lang IN ('de', 'es') THEN NULL
    WHEN lang = 'fr' THEN {_Y} || '/' || lpad({_NO2}, 2, '0') || '/' || {_D}
    ELSE {_Y} || '/' || lpad({_NO}, 2, '0') || '/' || {_D} END AS ymd
FROM documents""",
    "arxiv_date": f"""SELECT doc_id, {_dateline('n_chars')} AS "Date" FROM documents""",
    "doi_from_url": """SELECT page_id, '10.48550/arXiv.' || list_extract(string_split(url, '/'), -1) AS "DOI" FROM pages""",
    "listing_articles": f"""WITH {_ENTRIES}
SELECT page_id, {_SECTION} AS section_url, CAST(page_no AS INTEGER) AS page_no, CAST(i + 1 AS INTEGER) AS entry_no, {_ENTRY_FIELDS}
FROM entries WHERE i % 4 <> 3""",
    "page_rejects": f"""WITH {_ENTRIES}
SELECT page_id, CAST(i + 1 AS INTEGER) AS entry_no, 'no link to the full text' AS reason FROM entries WHERE i % 4 = 3""",
    "preprint_all": f"""WITH {_ENTRIES},
sizes AS (SELECT section_no, page_no FROM entries GROUP BY section_no, page_no),
reached AS (
  SELECT section_no, page_no
  FROM (SELECT *, row_number() OVER (PARTITION BY section_no ORDER BY page_no) AS k FROM sizes) WHERE k = page_no + 1
)
SELECT {_ENTRY_FIELDS}, {_SHOWN_ABSTRACT} AS "Abstract", {_SECTION} AS "Section", {_SHOWN_DATE} AS "Date"
FROM entries SEMI JOIN reached USING (section_no, page_no) WHERE {_VALID}""",
    "page_details": f"""WITH {_ENTRIES}
SELECT 'https://arxiv.org/abs/' || {_NUMBER} AS url, {_SHOWN_DATE} AS found FROM entries
WHERE {_N} > 20 AND {_SHOWN_DATE} IS NOT NULL
UNION ALL SELECT 'https://arxiv.org/html/' || {_NUMBER} || 'v1', {_SHOWN_ABSTRACT} FROM entries""",
    "article_details": f"""WITH {_ENTRIES}
SELECT page_id, CAST(i + 1 AS INTEGER) AS entry_no, {_ENTRY_FIELDS}, {_SHOWN_ABSTRACT} AS "Abstract", {_SHOWN_DATE} AS "Date"
FROM entries WHERE {_VALID}""",
    "cap_per_section": f"""WITH {_ENTRIES},
sizes AS (SELECT section_no, page_no FROM entries WHERE page_no < 10 GROUP BY section_no, page_no),
reached AS (
  SELECT section_no, page_no
  FROM (SELECT *, row_number() OVER (PARTITION BY section_no ORDER BY page_no) AS k FROM sizes) WHERE k = page_no + 1
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY section_no ORDER BY page_no, i) AS place
  FROM entries SEMI JOIN reached USING (section_no, page_no) WHERE {_VALID}
)
SELECT {_SECTION} AS section_url, CAST(place AS INTEGER) AS place, '10.48550/arXiv.' || {_NUMBER} AS "DOI"
FROM placed WHERE place <= 30""",
    "project_corpus": f"WITH {_ARTICLES} SELECT {_ARTICLE_LIST} FROM articles",
    "union_sections": f"""SELECT lang, doc_id, {TITLE} AS "Title" FROM documents
UNION ALL SELECT 'cross', doc_id, {TITLE} FROM documents WHERE lang = 'en'""",
    "read_raw": f"""WITH {_ARTICLES}
SELECT {_ARTICLE_LIST}, CAST(try_strptime("Date", '%d/%m/%Y') AS DATE) AS pub_date FROM articles""",
    "read_normalized": f"""WITH {_ARTICLES}
SELECT "DOI", {_NORMAL_TITLE(_STOP, "nullif({}, '')")}, "Authors", {_NORMAL_ABSTRACT(_STOP, "nullif({}, '')")}, "Section", "Date"
FROM articles""",
    "section_counts": """SELECT source AS "Section", count(*) AS n_articles FROM documents GROUP BY source""",
    "null_counts": f"WITH {_ARTICLES} SELECT {_NULLS}, {_NAS} FROM articles",
    "corpus_shape": "SELECT count(*) AS n_rows, CAST(6 AS BIGINT) AS n_columns FROM documents",
    "sample_docs": "SELECT doc_id, text FROM documents ORDER BY md5('0:' || doc_id), doc_id LIMIT 10",
}

# the same rows by another way of reading
ORACLE_SQL |= {
    "ris_bulk": ORACLE_SQL["ris_full"],
    "search_arrivals": ORACLE_SQL["search_files"],
    "bib_bulk": ORACLE_SQL["bib_records"],
    "read_raw_splits": ORACLE_SQL["read_raw"],
}
