"""SQL counterparts of the registered queries, written against the given tables."""

from __future__ import annotations

from .views import (
    SPELT_LABELS,
    SPELT_SUFFIXES,
    STOP_WORDS,
    SUFFIX_RULES,
    TRAINING_STOP_WORDS,
)

VOCABULARY = 1500
SIZES = (1500, 3000, 5000, 7500, 10000)
FOLDS = 10
WS = r"[ \t\n\x0B\f\r]+"


def _list(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _values(words) -> str:
    return ", ".join(f"('{w}')" for w in words)


def _with(*parts: str, body: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + body


def _num(col: str) -> str:
    return f"CAST('0x' || substr(md5({col}), 1, 6) AS BIGINT)"


# Crawl records and URLs -------------------------------------------------------------------------

CRAWL = r"""
crawl AS (
  SELECT page_id, crawl,
    CASE page_id % 37
      WHEN 1 THEN 'nourl' || path
      WHEN 2 THEN 'http://10.2.3.4' || path
      WHEN 3 THEN front || '.' || path
      WHEN 4 THEN 'http://-x.example.com' || path
      WHEN 5 THEN 'http://example.org' || path
      WHEN 6 THEN 'gopher://a.example.com' || path
      WHEN 7 THEN 'http://www.a.b.uk' || path
      WHEN 8 THEN 'http://www.city.uk' || path
      WHEN 9 THEN 'HTTP://user@WWW2.' || hostname || path
      WHEN 10 THEN front || ':8080' || path
      WHEN 11 THEN front || ':80x' || path
      WHEN 12 THEN 'http://www.m.' || hostname || path
      ELSE url END AS url,
    CASE WHEN page_id % 10 = 9 THEN 404 WHEN page_id % 10 = 8 THEN 302
         WHEN page_id % 50 = 7 THEN 503 WHEN page_id % 50 = 16 THEN NULL
         WHEN page_id % 50 = 27 THEN 150 ELSE 200 END AS status,
    CASE WHEN page_id % 13 = 5 THEN 'pdf' WHEN page_id % 13 <> 6 THEN 'html-doc' END AS kind,
    CASE WHEN page_id % 11 = 4 THEN '' ELSE trim(regexp_replace(
      regexp_extract(html, '<title>([^<]*)</title>', 1) || '  v' || crawl, '[ \t\n\x0B\f\r]+', ' ', 'g'))
      END AS title,
    CASE WHEN page_id % 3 = 0 THEN ''
         ELSE 'kw' || (page_id % 7) || ', k' || (page_id % 5) END AS keywords,
    CASE WHEN page_id % 17 = 3 THEN 'blank' WHEN page_id % 19 = 4 THEN 'bad' ELSE 'ok' END AS doc
  FROM (
    SELECT *, unnest(range(1, CASE WHEN page_id % 4 = 0 THEN 3 + page_id % 6 ELSE 2 END)) AS crawl,
      regexp_replace(url, '^[a-z]+://[^/]*', '') AS path,
      regexp_extract(url, '^[a-z]+://[^/]*') AS front,
      regexp_extract(url, '^[a-z]+://([^/]*)', 1) AS hostname
    FROM pages) p)"""

_EDGE = r"[a-z0-9\x{80}-\x{10FFFF}]"
_LAST = r"[a-z\x{80}-\x{10FFFF}]"
_IN = r"[a-z0-9_\-\x{80}-\x{10FFFF}]"
_HOST_OK = (
    rf"^(?:{_EDGE}(?:{_IN}{{0,61}}{_EDGE})?\.)*{_LAST}(?:{_IN}{{0,61}}{_EDGE})?$"
)


def _hosts(source: str, columns: str) -> str:
    """Hosts of a (url, …) source."""
    return rf"""
split_urls AS (
  SELECT {columns}, url, host, port,
    CASE WHEN right(host, 1) = '.' THEN left(host, length(host) - 1) ELSE host END AS bare,
    regexp_extract(lower(url), '^([a-z][a-z0-9+.\-]*):', 1) AS scheme
  FROM (
    SELECT *, regexp_extract(lower(url), '^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1) AS host,
      regexp_extract(lower(url), '^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?[^/?#:]*:([^/?#]*)', 1) AS port
    FROM {source}) s)"""


DOMAINS = rf"""
rules AS (SELECT * FROM (VALUES {_values(SUFFIX_RULES)}) r(rule)),
parts AS (
  SELECT bare, string_split(bare, '.') AS labels, len(string_split(bare, '.')) AS n
  FROM (SELECT DISTINCT bare FROM split_urls) b),
candidates AS (
  SELECT bare, n, k, array_to_string(list_slice(labels, n - k + 1, n), '.') AS suffix,
    array_to_string(list_slice(labels, n - k + 2, n), '.') AS parent
  FROM (SELECT *, unnest(range(1, n + 1)) AS k FROM parts) c),
matches AS (
  SELECT bare, n, k, 1 AS rank, k AS suffix_labels FROM candidates JOIN rules ON rule = suffix
  UNION ALL
  SELECT bare, n, k, 2, k - 1 FROM candidates JOIN rules ON rule = '!' || suffix
  UNION ALL
  SELECT bare, n, k, 3, k FROM candidates JOIN rules ON rule = '*.' || parent WHERE k > 1),
best AS (
  SELECT bare, suffix_labels FROM (
    SELECT *, row_number() OVER (PARTITION BY bare ORDER BY k DESC, rank) AS pos FROM matches) m
  WHERE pos = 1),
domains AS (
  SELECT bare, array_to_string(list_slice(labels, n - suffix_labels, n), '.') AS domain
  FROM best JOIN parts USING (bare) WHERE n > suffix_labels)"""


def _resolved(columns: str) -> str:
    return rf"""
resolved AS (
  SELECT {columns}, url, host,
    CASE WHEN text_outcome = 'OK' THEN domain END AS text_domain, text_outcome,
    CASE WHEN text_outcome = 'OK' AND host <> domain AND strpos(host, domain) <= 2
         THEN 'ERR_URI_MALFORMED' ELSE text_outcome END AS url_outcome,
    CASE WHEN text_outcome <> 'OK' OR (host <> domain AND strpos(host, domain) <= 2) THEN NULL
         WHEN host <> domain AND regexp_full_match(
           left(host, strpos(host, domain) - 2), 'www[A-Za-z0-9_]*') THEN domain
         ELSE host END AS canonical_host
  FROM (
    SELECT u.*, d.domain,
      CASE WHEN scheme NOT IN ('http', 'https', 'ftp', 'file', 'jar', 'mailto')
             OR NOT regexp_full_match(port, '[0-9]*') THEN 'ERR_URI_MALFORMED'
           WHEN NOT regexp_matches(u.bare, '{_HOST_OK}') THEN 'ERR_URI_ILLEGAL'
           WHEN d.domain IS NULL THEN 'ERR_URI_NO_SUFFIX' ELSE 'OK' END AS text_outcome
    FROM split_urls u LEFT JOIN domains d ON d.bare = u.bare) r)"""


def _pairs(pairs) -> str:
    rows = (f"({k}, {i}, '{name}')" for k, pair in enumerate(pairs) for i, name in enumerate(pair))
    return ", ".join(rows)


SPELT = f"""
labels_spelt(kind, spelling, label) AS (VALUES {_pairs(SPELT_LABELS)}),
suffixes_spelt(kind, spelling, suffix) AS (VALUES {_pairs(SPELT_SUFFIXES)}),
spelt AS (
  SELECT page_id, label || '.' || suffix AS domain, l.kind AS label_kind, s.kind AS suffix_kind
  FROM pages JOIN labels_spelt l ON l.kind = page_id % 3 AND l.spelling = page_id // 3 % 2
  JOIN suffixes_spelt s ON s.kind = page_id // 6 % 2 AND s.spelling = page_id // 12 % 2)"""

_PAGE_COLUMNS = "page_id, crawl, status, kind, title, keywords, doc"
URLS = [CRAWL, _hosts("crawl", _PAGE_COLUMNS), DOMAINS, _resolved(_PAGE_COLUMNS)]

INDEX = rf"""
index_hosts AS (
  SELECT host, {_num('host')} AS num FROM (
    SELECT DISTINCT regexp_replace(regexp_extract(lower(url), '^[a-z]+://([^/?#:]*)', 1),
      '^www[a-z0-9_]*[.]', '') AS host FROM pages) h),
category_index AS (
  SELECT host, n_name AS cat1, CASE WHEN num % 4 = 0 THEN r_name END AS cat2
  FROM index_hosts JOIN nation ON n_nationkey = num % 25 JOIN region ON r_regionkey = n_regionkey
  WHERE num % 5 <> 0)"""

EVALUATED = """
evaluated AS (
  SELECT r.*, concat_ws(',', cat1, cat2) AS categories, cat2 IS NOT NULL AS two,
    CASE WHEN url_outcome <> 'OK' THEN url_outcome
         WHEN cat1 IS NULL THEN 'PAGE_NO_CATEGORY'
         WHEN doc = 'blank' THEN 'DATA_NO_JSON'
         WHEN doc = 'bad' THEN 'DATA_BAD_JSON'
         WHEN status IS NULL THEN 'HTTP_UNDEFINED'
         WHEN status < 200 OR status >= 300 THEN 'HTTP_NOT_2XX'
         WHEN kind IS NULL OR kind <> 'html-doc' THEN 'PAGE_TYPE'
         WHEN title = '' THEN 'PAGE_NO_TITLE' ELSE 'SUCCESS' END AS outcome
  FROM resolved r LEFT JOIN category_index i ON i.host = r.canonical_host),
harvested AS (
  SELECT url, title, keywords, categories FROM evaluated WHERE outcome = 'SUCCESS')"""
PAGES = [*URLS, INDEX, EVALUATED]

_STATUS = """CASE WHEN status IS NULL THEN 'UNDEFINED' WHEN status < 200 THEN 'INFO_1XX'
  WHEN status < 300 THEN 'SUCCESS_2XX' WHEN status < 400 THEN 'REDIRECTION_3XX'
  WHEN status < 500 THEN 'ERROR_4XX' ELSE 'ERROR_5XX' END"""
_REACHED_STATUS = (
    "outcome IN ('HTTP_UNDEFINED', 'HTTP_NOT_2XX', 'PAGE_TYPE', 'PAGE_NO_TITLE', 'SUCCESS')"
)
_REACHED_TYPE = "outcome IN ('PAGE_TYPE', 'PAGE_NO_TITLE', 'SUCCESS')"
_BUCKET = """CASE {n} WHEN 1 THEN 'ONE' WHEN 2 THEN 'TWO' WHEN 3 THEN 'THREE' WHEN 4 THEN 'FOUR'
  WHEN 5 THEN 'FIVE' ELSE 'MORE' END"""


def _bucket(n: str) -> str:
    return _BUCKET.format(n=n)


_STATS_BODY = f"""
SELECT 'parse' AS grp, outcome AS name, count(*) AS n FROM evaluated
WHERE outcome NOT IN ('HTTP_UNDEFINED', 'HTTP_NOT_2XX', 'PAGE_TYPE') GROUP BY outcome
UNION ALL SELECT 'parse', 'PAGE_NO_KEYWORDS', count(*) FROM harvested WHERE keywords = ''
  HAVING count(*) > 0
UNION ALL SELECT 'http', {_STATUS}, count(*) FROM evaluated WHERE {_REACHED_STATUS} GROUP BY 2
UNION ALL SELECT 'page_type', coalesce(kind, 'undefined'), count(*) FROM evaluated
  WHERE {_REACHED_TYPE} GROUP BY 2
UNION ALL SELECT 'categories', CASE WHEN two THEN 'TWO' ELSE 'ONE' END, count(*) FROM evaluated
  WHERE outcome = 'SUCCESS' GROUP BY 2
UNION ALL SELECT 'url_occurrence', {_bucket('c')}, count(*) FROM (
  SELECT url, count(*) AS c FROM harvested GROUP BY url) o GROUP BY 2"""

_LINE = r"url || chr(9) || title || chr(9) || keywords || chr(9) || categories"

# Text -------------------------------------------------------------------------------------------

_TOKEN = r"\p{L}(?:[\p{L}\p{Nd}'']*\p{L})?"


def _bags(source: str, key: str) -> str:
    """Bags of a (key, text) source with distinct keys."""
    return rf"""
tokens AS (
  SELECT {key}, lower(unnest(regexp_extract_all(text, '{_TOKEN}'))) AS token FROM {source}),
token_counts AS (
  SELECT {key}, token, count(*) AS n FROM tokens
  WHERE token NOT IN ({_list(STOP_WORDS)}) GROUP BY ALL),
bags AS (
  SELECT {key}, string_agg(token || ':' || n, ' ' ORDER BY token) AS bag
  FROM token_counts GROUP BY ALL)"""


TEXTS = r"""
texts AS (
  SELECT doc_id, lang, text, 'http://' || CASE WHEN doc_id % 3 = 0 THEN 'www.' ELSE '' END
    || source || '.example.com/p/' || (doc_id % 60) AS url, source || '.example.com' AS site
  FROM documents)"""
WHITELIST = f"""
whitelist AS (
  SELECT source || '.example.com' AS domain FROM (SELECT DISTINCT source FROM documents) s
  WHERE {_num('source')} % 2 = 0)"""
_WANTED = """
wanted AS (SELECT t.*, w.domain FROM texts t JOIN whitelist w ON w.domain = t.site)"""


def _longest(source: str) -> str:
    return f"""
longest AS (
  SELECT url, domain, bag, occurrences FROM (
    SELECT url, domain, coalesce(bag, '') AS bag, count(*) OVER (PARTITION BY url) AS occurrences,
      row_number() OVER (PARTITION BY url ORDER BY strlen(coalesce(bag, '')) DESC,
        coalesce(bag, '') DESC) AS pos
    FROM {source} LEFT JOIN bags USING (doc_id)) x
  WHERE pos = 1)"""


_ENGLISH = "english AS (SELECT * FROM wanted WHERE lang = 'en')"
LABELLED = [TEXTS, WHITELIST, _WANTED, _ENGLISH, _bags("english", "doc_id"), _longest("english")]

GRAMS = r"""
words AS (
  SELECT doc_id, lang, ' ' || unnest(regexp_extract_all(text, '[\p{L}\p{M}]+')) || ' ' AS w
  FROM documents),
all_grams AS (
  SELECT doc_id, lang, size, substr(w, i, size) AS ngram, substr(w, i + size - 2, 2) AS tail
  FROM (SELECT doc_id, lang, w, size, unnest(range(1, length(w) - size + 2)) AS i
        FROM (SELECT *, unnest([1, 2, 3]) AS size FROM words) a) b),
grams AS (
  SELECT doc_id, lang, size, ngram FROM all_grams
  WHERE ngram <> ' ' AND NOT regexp_matches(tail, '^\p{Lu}\p{Lu}$')),
profile AS (SELECT lang, size, ngram, count(*) AS cnt FROM grams GROUP BY ALL),
shares AS (
  SELECT lang, ngram, cnt * 1.0::DOUBLE / sum(cnt) OVER (PARTITION BY lang, size) AS share
  FROM profile),
known AS (SELECT DISTINCT ngram FROM profile),
langs AS (SELECT DISTINCT lang FROM profile),
logs AS (
  SELECT l.lang, k.ngram, ln(coalesce(s.share, 0) + 0.00005) AS v
  FROM known k CROSS JOIN langs l LEFT JOIN shares s ON s.lang = l.lang AND s.ngram = k.ngram),
doc_grams AS (SELECT doc_id, ngram, count(*) AS n FROM grams GROUP BY ALL),
scores AS (
  SELECT doc_id, logs.lang, round(sum(n * v), 6) AS s
  FROM doc_grams JOIN logs USING (ngram) GROUP BY ALL),
detected AS (
  SELECT doc_id, lang FROM (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, lang) AS pos FROM scores) x
  WHERE pos = 1)"""
_DETECTED_ENGLISH = (
    "english AS (SELECT w.* FROM wanted w JOIN detected d USING (doc_id) WHERE d.lang = 'en')"
)
DETECTED = [
    GRAMS, TEXTS, WHITELIST, _WANTED, _DETECTED_ENGLISH, _bags("english", "doc_id"),
    _longest("english"),
]

# Training ---------------------------------------------------------------------------------------


def _tokenised(expr: str) -> str:
    runs = f"regexp_extract_all({expr}, '[A-Za-z0-9]+')"
    return (
        f"list_filter(list_transform({runs}, lambda t: lower(t)), lambda t: length(t) > 3 "
        f"AND regexp_matches(t, '[a-z]') AND t NOT IN ({_list(TRAINING_STOP_WORDS)}))"
    )


def _training(source: str) -> str:
    return f"""
training AS (
  SELECT url, tokens, unnest(string_split(categories, ',')) AS klass FROM (
    SELECT *, array_to_string(list_concat(list_concat({_tokenised('url')},
      {_tokenised('title')}), {_tokenised('keywords')}), ' ') AS tokens FROM {source}) s
  WHERE tokens <> '')"""


CORPUS = """
corpus AS (
  SELECT 'http://' || source || '.example.com/' || d.doc_id AS url, text AS title,
    source AS keywords, lang || CASE quality WHEN 1 THEN ',good' WHEN 0 THEN ',poor' ELSE '' END
    AS categories
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""


def _split(source: str, seed: str) -> str:
    return f"""
placed AS (
  SELECT *, row_number() OVER (PARTITION BY category ORDER BY
      md5(concat_ws(chr(9), '{seed}', url, title, keywords, categories))) AS pos,
    count(*) OVER (PARTITION BY category) AS total
  FROM (SELECT *, unnest(string_split(categories, ',')) AS category FROM {source}) s),
parted AS (
  SELECT *, CASE WHEN pos <= floor(total * 0.8::DOUBLE) THEN 'train'
    WHEN pos <= floor(total * 0.8::DOUBLE) + floor(total * 0.1::DOUBLE) THEN 'validate'
    ELSE 'test' END AS split FROM placed)"""


COPIED = f"""
copied AS (
  SELECT url, tokens, klass,
    unnest(CASE WHEN {_num('url')} % 3 = 0 THEN [1, 2] ELSE [1] END) AS crawl FROM training)"""


def _instances(source: str) -> str:
    return f"""
instances AS (
  SELECT row_number() OVER (ORDER BY url, klass) AS id, url, klass, tokens,
    CAST('0x' || substr(md5(url), 1, 8) AS BIGINT) % {FOLDS} AS fold FROM {source}),
terms AS (
  SELECT id, term, count(*) AS tf FROM (
    SELECT id, unnest(string_split(tokens, ' ')) AS term FROM instances) t GROUP BY ALL),
term_counts AS (
  SELECT term, sum(tf)::BIGINT AS total, count(*) AS df FROM terms GROUP BY term)"""


INSTANCES = _instances("training")


def _vocabulary(size: int, suffix: str = "") -> str:
    return f"""
vocab{suffix} AS (
  SELECT *, ln((SELECT count(*) FROM instances)::DOUBLE / df) AS idf FROM term_counts
  WHERE total >= (SELECT min(total) FROM (
    SELECT total FROM term_counts ORDER BY total DESC LIMIT {size}) c)),
weights{suffix} AS (
  SELECT id, term, ln(1 + tf::DOUBLE) * idf AS weight FROM terms JOIN vocab{suffix} USING (term))"""


def _fold_models(suffix: str = "") -> str:
    """Cross-validated prediction per instance; every model is fitted on its own rows."""
    s = suffix
    return f"""
folds{s} AS (SELECT unnest(range(0, {FOLDS})) AS fold),
fold_classes{s} AS (
  SELECT f.fold, k.klass, count(i.id) AS n FROM folds{s} f
  CROSS JOIN (SELECT DISTINCT klass FROM instances) k
  LEFT JOIN instances i ON i.klass = k.klass AND i.fold <> f.fold GROUP BY ALL),
fold_priors{s} AS (
  SELECT fold, klass, ln((n + 1)::DOUBLE / (sum(n) OVER (PARTITION BY fold)
    + count(*) OVER (PARTITION BY fold))) AS lp FROM fold_classes{s}),
fold_sums{s} AS (
  SELECT f.fold, i.klass, w.term, sum(w.weight) AS w FROM folds{s} f
  JOIN instances i ON i.fold <> f.fold JOIN weights{s} w ON w.id = i.id GROUP BY ALL),
fold_totals{s} AS (SELECT fold, klass, sum(w) AS total FROM fold_sums{s} GROUP BY ALL),
fold_lls{s} AS (
  SELECT p.fold, p.klass, v.term, ln((coalesce(s.w, 0) + 1) / (coalesce(t.total, 0)
    + (SELECT count(*) FROM vocab{s}))) AS ll
  FROM fold_priors{s} p CROSS JOIN vocab{s} v
  LEFT JOIN fold_sums{s} s ON s.fold = p.fold AND s.klass = p.klass AND s.term = v.term
  LEFT JOIN fold_totals{s} t ON t.fold = p.fold AND t.klass = p.klass),
fold_scores{s} AS (
  SELECT i.id, l.klass, sum(w.weight * l.ll) AS s FROM instances i
  JOIN weights{s} w ON w.id = i.id JOIN fold_lls{s} l ON l.fold = i.fold AND l.term = w.term
  GROUP BY ALL),
cv{s} AS (
  SELECT id, url, actual AS klass, fold, klass AS prediction FROM (
    SELECT i.id, i.url, i.fold, i.klass AS actual, p.klass, row_number() OVER (PARTITION BY i.id
      ORDER BY round(p.lp + coalesce(s.s, 0), 6) DESC, p.klass) AS pos
    FROM instances i JOIN fold_priors{s} p ON p.fold = i.fold
    LEFT JOIN fold_scores{s} s ON s.id = i.id AND s.klass = p.klass) x
  WHERE pos = 1)"""


MODEL = """
class_counts AS (SELECT klass, count(*) AS n FROM instances GROUP BY klass),
priors AS (
  SELECT row_number() OVER (ORDER BY klass) - 1 AS class_idx, klass, n,
    ln((n + 1)::DOUBLE / (sum(n) OVER () + count(*) OVER ())) AS log_prior FROM class_counts),
class_terms AS (
  SELECT klass, term, sum(weight) AS w FROM weights JOIN instances USING (id) GROUP BY ALL),
class_totals AS (SELECT klass, sum(w) AS total FROM class_terms GROUP BY klass),
likelihoods AS (
  SELECT v.term, p.class_idx, p.klass, ln((coalesce(c.w, 0) + 1) / (t.total
    + (SELECT count(*) FROM vocab))) AS ll
  FROM vocab v CROSS JOIN priors p JOIN class_totals t ON t.klass = p.klass
  LEFT JOIN class_terms c ON c.klass = p.klass AND c.term = v.term),
class_scores AS (
  SELECT w.id, l.klass, sum(w.weight * l.ll) AS s
  FROM weights w JOIN likelihoods l USING (term) GROUP BY ALL),
predicted AS (
  SELECT id, url, actual AS klass, klass AS prediction FROM (
    SELECT i.id, i.url, i.klass AS actual, p.klass, row_number() OVER (PARTITION BY i.id
      ORDER BY round(p.log_prior + coalesce(s.s, 0), 6) DESC, p.klass) AS pos
    FROM instances i CROSS JOIN priors p
    LEFT JOIN class_scores s ON s.id = i.id AND s.klass = p.klass) x
  WHERE pos = 1)"""

CORPUS_TRAINING = [CORPUS, _training("corpus")]
VECTORS = [*CORPUS_TRAINING, INSTANCES, _vocabulary(VOCABULARY)]
CV = [*VECTORS, _fold_models()]
SWEEP = [*CORPUS_TRAINING, INSTANCES]
for _size in SIZES:
    SWEEP += [_vocabulary(_size, str(_size)), _fold_models(str(_size))]

ORACLE: dict[str, str] = {
    "url_host": _with(*URLS, body="SELECT page_id, crawl, host FROM resolved"),
    "registrable_domain": _with(
        *URLS, body="SELECT page_id, crawl, text_domain AS domain FROM resolved"
    ),
    "url_outcome": _with(*URLS, body="SELECT page_id, crawl, url_outcome FROM resolved"),
    "canonical_host": _with(*URLS, body="SELECT page_id, crawl, canonical_host FROM resolved"),
    "page_fields": _with(
        CRAWL,
        body="SELECT page_id, crawl, status, kind, title, keywords FROM crawl WHERE doc = 'ok'",
    ),
    "page_outcomes": _with(*PAGES, body="SELECT page_id, crawl, outcome FROM evaluated"),
    "page_categories": _with(
        *PAGES, body="SELECT page_id, crawl, categories FROM evaluated WHERE categories <> ''"
    ),
    "harvest_titles": _with(*PAGES, body="SELECT * FROM harvested"),
    "harvest_tsv": _with(*PAGES, body=f"SELECT {_LINE} AS value FROM harvested"),
    "status_classes": _with(*PAGES, body=f"""
SELECT {_STATUS} AS status_class, count(*) AS n FROM evaluated
WHERE {_REACHED_STATUS} GROUP BY 1"""),
    "page_types": _with(*PAGES, body=f"""
SELECT coalesce(kind, 'undefined') AS page_type, count(*) AS n FROM evaluated
WHERE {_REACHED_TYPE} GROUP BY 1"""),
    "category_histogram": _with(*PAGES, body="""
SELECT CASE WHEN two THEN 'TWO' ELSE 'ONE' END AS bucket, count(*) AS n FROM evaluated
WHERE outcome = 'SUCCESS' GROUP BY 1"""),
    "url_occurrences": _with(*PAGES, body=f"""
SELECT {_bucket('c')} AS bucket, count(*) AS n FROM (
  SELECT url, count(*) AS c FROM harvested GROUP BY url) o GROUP BY 1"""),
    "harvest_stats": _with(*PAGES, body=_STATS_BODY),
    "title_job_files": _with(*PAGES, body="SELECT * FROM harvested"),
    "title_job_statistics": _with(*PAGES, body=_STATS_BODY),
    "growing_title_statistics": _with(*PAGES, body=_STATS_BODY),
    "clean_tokens": rf"""
SELECT doc_id, len(t)::BIGINT AS n_tokens, md5(array_to_string(t, ' ')) AS tokens_md5 FROM (
  SELECT doc_id, list_transform(regexp_extract_all(text, '{_TOKEN}'), lambda x: lower(x)) AS t
  FROM documents) d""",
    "token_counts": _with(
        _bags("documents", "doc_id"), body="SELECT doc_id, token, n FROM token_counts"
    ),
    "bag_of_words": _with(_bags("documents", "doc_id"), body="""
SELECT doc_id, coalesce(bag, '') AS bag FROM documents LEFT JOIN bags USING (doc_id)"""),
    "whitelisted_texts": _with(TEXTS, WHITELIST, _WANTED, body="""
SELECT url, domain, count(*) AS n FROM wanted GROUP BY ALL"""),
    "harvest_texts": _with(*LABELLED, body="SELECT * FROM longest"),
    "harvest_texts_tsv": _with(*LABELLED, body="""
SELECT url || chr(9) || domain || chr(9) || bag AS value FROM longest"""),
    "longest_text": _with(
        TEXTS, "every AS (SELECT *, 'any' AS domain FROM texts)", _bags("every", "doc_id"),
        _longest("every"), body="SELECT url, bag, occurrences FROM longest",
    ),
    "text_occurrences": _with(*LABELLED, body=f"""
SELECT {_bucket('occurrences')} AS bucket, count(*) AS n FROM longest GROUP BY 1"""),
    "language_profiles": _with(GRAMS, body="SELECT lang, ngram, cnt FROM profile"),
    "detect_language": _with(GRAMS, body="""
SELECT doc_id, d.lang FROM documents LEFT JOIN detected d USING (doc_id)"""),
    "language_counts": _with(GRAMS, body="""
SELECT lang, count(*) AS n FROM detected GROUP BY lang"""),
    "harvest_detected_texts": _with(*DETECTED, body="SELECT * FROM longest"),
    "growing_texts": _with(*DETECTED, body="SELECT * FROM longest"),
    "text_job_statistics": _with(
        GRAMS, TEXTS, WHITELIST, _WANTED, """
english AS (SELECT w.* FROM wanted w JOIN detected d USING (doc_id)
  WHERE d.lang = 'en' AND doc_id % 43 <> 0 AND doc_id % 41 > 2)""",
        _bags("english", "doc_id"), _longest("english"), body=f"""
SELECT 'parse' AS grp, 'SUCCESS' AS name, count(*) AS n FROM longest
UNION ALL SELECT 'url_occurrence', {_bucket('occurrences')}, count(*) FROM longest GROUP BY 2
UNION ALL SELECT 'parse', 'ERR_LANG_DETECT', count(*) FROM documents
  WHERE doc_id % 43 = 0 OR doc_id NOT IN (SELECT doc_id FROM detected) HAVING count(*) > 0
UNION ALL SELECT 'parse', CASE doc_id % 41 WHEN 0 THEN 'ERR_URI_MALFORMED'
  WHEN 1 THEN 'ERR_URI_ILLEGAL' ELSE 'ERR_URI_NO_SUFFIX' END, count(*) FROM detected
  WHERE lang = 'en' AND doc_id % 43 <> 0 AND doc_id % 41 < 3 GROUP BY 2"""),
    "stop_list_file": _with(_bags("documents", "doc_id"), body="""
SELECT doc_id, coalesce(bag, '') AS bag FROM documents LEFT JOIN bags USING (doc_id)"""),
    "profile_files": _with(GRAMS, body="""
SELECT doc_id, d.lang FROM documents LEFT JOIN detected d USING (doc_id)"""),
    "language_count_file": _with(GRAMS, body="""
SELECT '0lang:' || lang || chr(9) || count(*) AS value FROM detected GROUP BY lang"""),
    "sequence_file_scan": _with(CRAWL, body="""
SELECT url, status, title, keywords FROM crawl WHERE doc = 'ok'"""),
    "spelt_domains": _with(SPELT, body="SELECT page_id, domain FROM spelt"),
    "spelt_whitelisted": _with(SPELT, body="""
SELECT page_id, domain FROM spelt WHERE label_kind = suffix_kind"""),
    "segment_files": _with(CRAWL, body="""
SELECT CASE page_id % 2 WHEN 1 THEN '7' ELSE '8' END AS segment, count(*) AS pages,
  false AS unreadable FROM crawl GROUP BY 1
UNION ALL SELECT 'broken', 0, true"""),
    "segment_pages": _with(CRAWL, body="""
SELECT url, count(*) AS n, count(*) FILTER (doc = 'blank') AS blank FROM crawl GROUP BY url"""),
    "training_terms_bigrams": _with(CORPUS, f"""
hanzi AS (SELECT url, title || ' ' || chr((26376 + doc % 7)::INT) || chr(26085) || chr((26412 + doc % 5)::INT)
    || 'word' AS title, keywords, categories
  FROM (SELECT *, CAST(split_part(url, '/', 4) AS BIGINT) AS doc FROM corpus) c)""", body=f"""
SELECT url, md5(array_to_string(list_concat(list_concat({_tokenised('url')}, list_concat(
    [substr(right(title, 7), 1, 2), substr(right(title, 7), 2, 2)],
    {_tokenised("left(title, length(title) - 7) || ' word'")})),
    {_tokenised('keywords')}), ' ')) AS tokens_md5,
  unnest(string_split(categories, ',')) AS klass FROM hanzi"""),
    "split_by_page": _with(CORPUS, """
strata AS (SELECT url, '' AS title, '' AS keywords, replace(min(categories), ',', ';') AS categories
  FROM corpus GROUP BY url)""", _split("strata", "7"), body="""
SELECT c.url, unnest(string_split(c.categories, ',')) AS category, p.split
FROM corpus c JOIN parted p USING (url)"""),
    "training_rows": _with(
        *PAGES, _training("harvested"), body="SELECT url, tokens, klass FROM training"
    ),
    "training_rows_corpus": _with(
        *CORPUS_TRAINING, body="SELECT url, md5(tokens) AS tokens_md5, klass FROM training"
    ),
    "training_rows_raw": _with(*PAGES, body=f"""
SELECT url, tokens, unnest(string_split(categories, ',')) AS klass FROM (
  SELECT *, replace(array_to_string(list_concat({_tokenised('url')}, [title, keywords]), ' '),
    chr(92), '') AS tokens FROM harvested) s
WHERE tokens <> ''"""),
    "labels": _with(*PAGES, body="""
SELECT DISTINCT unnest(string_split(categories, ',')) AS label FROM harvested"""),
    "labels_json": _with(*PAGES, body="""
SELECT DISTINCT unnest(string_split(categories, ',')) AS label FROM harvested"""),
    "category_docs": _with(CORPUS, body="""
SELECT category, count(*) AS n FROM (
  SELECT unnest(string_split(categories, ',')) AS category FROM corpus) c GROUP BY category"""),
    "stratified_split": _with(
        CORPUS, _split("corpus", "7"), body="SELECT url, category, split FROM parted"
    ),
    "stratified_split_sizes": _with(CORPUS, """
copies AS (SELECT 'u' AS url, 't' AS title, keywords, split_part(categories, ',', 1) AS categories
  FROM corpus)""", _split("copies", "0"), body="""
SELECT category, split, count(*) AS n FROM parted GROUP BY ALL"""),
    "vocabulary_topw": _with(*VECTORS, body="SELECT term, total, df FROM vocab"),
    "tfidf": _with(*VECTORS, body="""
SELECT url, klass, term, round(weight, 6) AS weight FROM weights JOIN instances USING (id)"""),
    "tfidf_normalized": _with(
        *CORPUS_TRAINING, COPIED, _instances("copied"), _vocabulary(VOCABULARY), """
lengths AS (SELECT id, sqrt(sum(weight * weight)) AS len FROM weights GROUP BY id)""", body="""
SELECT url, klass, term, round(CASE WHEN len > 0 THEN weight * (SELECT sum(len) FROM lengths)
  / (SELECT count(*) FROM instances) / len ELSE weight END, 6) AS weight
FROM weights JOIN lengths USING (id) JOIN instances USING (id)"""),
    "nb_priors": _with(*VECTORS, MODEL, body="""
SELECT class_idx, klass, n, round(log_prior, 6) AS log_prior FROM priors"""),
    "nb_likelihoods": _with(*VECTORS, MODEL, body="""
SELECT term, class_idx, round(ll, 6) AS ll FROM likelihoods"""),
    "nb_predict": _with(
        *VECTORS, MODEL, body="SELECT url, klass, prediction FROM predicted"
    ),
    "nb_cross_validation": _with(*CV, body="SELECT url, klass, fold, prediction FROM cv"),
    "nb_confusion": _with(
        *CV, body="SELECT klass, prediction, count(*) AS n FROM cv GROUP BY ALL"
    ),
    "nb_accuracy": _with(*CV, body="""
SELECT count(*) AS instances, count(*) FILTER (klass = prediction) AS correct,
  round(count(*) FILTER (klass = prediction) / count(*)::DOUBLE, 6) AS accuracy FROM cv"""),
    "nb_vocabulary_sweep": _with(*SWEEP, body="\nUNION ALL\n".join(
        f"SELECT {s} AS size, count(*) AS instances, count(*) FILTER (klass = prediction) "
        f"AS correct FROM cv{s}" for s in SIZES)),
    "nb_class_metrics": _with(*CV, """
actual AS (SELECT klass, count(*) AS instances, count(*) FILTER (klass = prediction) AS correct
  FROM cv GROUP BY klass),
guessed AS (SELECT prediction AS klass, count(*) AS predicted FROM cv GROUP BY prediction)""",
        body="""
SELECT klass, coalesce(instances, 0) AS instances, coalesce(predicted, 0) AS predicted,
  coalesce(correct, 0) AS correct,
  CASE WHEN predicted > 0 THEN round(coalesce(correct, 0) / predicted::DOUBLE, 6) ELSE 0 END AS precision,
  CASE WHEN instances > 0 THEN round(correct / instances::DOUBLE, 6) ELSE 0 END AS recall,
  round(2 * coalesce(correct, 0)
    / (coalesce(instances, 0) + coalesce(predicted, 0))::DOUBLE, 6) AS f1
FROM actual FULL JOIN guessed USING (klass)"""),
    "nb_model_json": _with(*VECTORS, MODEL, body="""
SELECT term, klass, round(log_prior, 6) AS log_prior, round(ll, 6) AS ll
FROM likelihoods JOIN priors USING (klass)"""),
    "build_index": _with(INDEX, body="""
SELECT host, concat_ws(',', cat1, cat2) AS categories FROM category_index"""),
    "whitelist_sorted": _with(INDEX, body="SELECT host FROM category_index"),
    "index_files": _with(INDEX, body="""
SELECT host, concat_ws(',', cat1, cat2) AS categories FROM category_index"""),
    "whitelist_files": _with(INDEX, body="SELECT host AS domain FROM category_index"),
    "harvest_file_scan": _with(*PAGES, body="SELECT * FROM harvested"),
    "harvest_file_rejects": _with(*PAGES, body="""
SELECT url || chr(9) || title || chr(9) || categories AS line FROM harvested
WHERE keywords = ''"""),
    "training_file": _with(
        *PAGES, _training("harvested"), body="SELECT tokens, klass FROM training"
    ),
    "split_files": _with(
        *PAGES, _split("harvested", "7"), body=f"SELECT {_LINE} AS value, split FROM parted"
    ),
    "key_ordered_file": _with(*PAGES, body=f"SELECT {_LINE} AS value FROM harvested"),
}
ORACLE["growing_text_statistics"] = ORACLE["text_job_statistics"]
ORACLE["sparse_vectors"] = ORACLE["tfidf"]
