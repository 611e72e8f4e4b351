r"""DuckDB SQL for the registered queries, written independently of the Spark expressions.

``{name}`` marks a snippet from ``PARTS``. Regular expressions are RE2: no look-around, no
back-references.
"""

# --- snippets --------------------------------------------------------------------------------------

_WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_NL = r"(?:\r\n|[\n-\r\x1c-\x1e\x{85}\x{2028}\x{2029}])"
_ATTRS = r"""(?:[^>"']|"[^"]*"|'[^']*')*>"""
_TAGS = (
    r"(?is)<script(?:[\s/][^>]*)?>.*?(?:</script\s*>|\z)|<style(?:[\s/][^>]*)?>.*?(?:</style\s*>|\z)"
    r"|<!--.*?(?:-->|\z)|<[!/?]?[A-Za-z]" + _ATTRS.replace("'", "''") + r"|<[!/?]?[A-Za-z][^>]*>"
)


def _nest(value, *calls):
    for call in calls:
        value = call.replace("$", value, 1)
    return value


def decode(value):
    pairs = (("lt", "<"), ("gt", ">"), ("quot", '"'), ("copy", "©"), ("middot", "·"), ("nbsp", "\u00a0"), ("amp", "&"))
    # these names also count when the semicolon is missing, as in text that was cut
    return _nest(value, *[f"regexp_replace($, '&{name};?', '{char}', 'g')" for name, char in pairs])


def trim(value):
    return f"regexp_replace({value}, '^{_WS}+|{_WS}+$', '', 'g')"


def clean_text(html):
    lines = f"regexp_split_to_array({decode(f"regexp_replace({html}, '{_TAGS}', chr(10), 'g')")}, '{_NL}|  ')"
    trimmed = f"list_transform({lines}, lambda line: {trim('line')})"
    return f"array_to_string(list_filter({trimmed}, lambda line: line <> ''), chr(10))"


def joined(fragment):
    pieces = f"string_split(regexp_replace({fragment}, '{_TAGS}', chr(1), 'g'), chr(1))"
    return f"array_to_string(list_transform({pieces}, lambda piece: {trim(decode('piece'))}), '')"


def page_title(html):
    found = f"regexp_extract({html}, '(?is)<h1(?:\\s[^>]*)?>(.*?)(?:</h1\\s*>|\\z)', 1)"
    return f"CASE WHEN regexp_matches({html}, '(?i)<h1[\\s>]') THEN {joined(found)} ELSE 'Unknown Title' END"


def page_content(html):
    block = f"regexp_extract({html}, '(?is)<article(?:\\s[^>]*)?>(.*?)(?:</article\\s*>|\\z)', 1)"
    pieces = f"regexp_split_to_array({block}, '(?i)<p(?:[\\s/][^>]*)?>')[2:]"
    cut = "regexp_replace(p, '(?is)</p\\s*>.*$', '')"
    return f"array_to_string(list_transform({pieces}, lambda p: {joined(cut)}), chr(10) || chr(10))"


def normalized(url):
    """Enough of the rules for the given URLs and their variants."""
    no_fragment = f"regexp_replace({url}, '#.*$', '')"
    no_query = f"regexp_replace({no_fragment}, '\\?$', '')"
    no_params = f"regexp_replace({no_query}, ';$', '')"
    prefix = f"regexp_extract({no_params}, '^([A-Za-z]+:)?//[^/?]*')"
    return f"lower({prefix}) || substr({no_params}, length({prefix}) + 1)"


def key(url):
    return f"sha256({normalized(url)})"


def iso(ts):
    return (
        f"strftime({ts}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond({ts}) % 1000000 <> 0 "
        f"THEN strftime({ts}, '.%f') ELSE '' END"
    )


def on_topic(value):
    phrases = (
        "artificial intelligence|llm|large language model|machine learning|neural network|transformer|gpt"
        "|openai|anthropic|deepmind|generative ai|diffusion model"
    )
    return (
        f"list_contains(regexp_split_to_array(lower({value}), '{_WS}+'), 'ai')"
        f" OR regexp_matches(lower({value}), '{phrases}')"
    )


LINE1 = "split_part(text, chr(10), 1)"
DOC_URL = "'https://news.example.org/' || lang || '/' || doc_id"
DOC_TIME = "make_timestamp((1700000000 + n_chars) * 1000000)"
RUN = "'2026-01-01T00:00:00'"
NO_ANALYSIS = "'Analysis failed or content unavailable.'"

VARIANTS = """
variants AS (
  SELECT page_id, 0 AS variant, url FROM pages
  UNION ALL SELECT page_id, 1, 'HTTP' || substr(url, 5) FROM pages
  UNION ALL SELECT page_id, 2, regexp_replace(url, '[?#].*$', '') || ';?' FROM pages
  UNION ALL SELECT page_id, 3, 'ftp' || substr(url, strpos(url, '://')) FROM pages
  UNION ALL SELECT page_id, 4, substr(url, strpos(url, '://') + 1) FROM pages)
"""

RUN_ROWS = """
run_rows AS (
  SELECT wave, doc_id AS pos,
         sha256(coalesce(text, '') || if(wave = 1 OR coalesce(lang IN ('en', 'fr'), false), '', '+')) AS k,
         'source ' || wave || ' ' || doc_id AS source, 'title ' || wave || ' ' || doc_id AS title,
         'https://news.example.org/' || wave || ' ' || doc_id AS url,
         CASE WHEN doc_id % 3 <> wave THEN wave || ' ' || doc_id END AS company,
         '2026-01-0' || wave || 'T00:00:00' AS inserted_at
  FROM documents, (SELECT unnest([1, 2]) AS wave))"""
FIRST = "min(pos) AS pos, arg_min(struct_pack(source := source, url := url, inserted_at := inserted_at), pos) AS kept"
LAST = "arg_max(struct_pack(title := title, company := company), pos) AS upd"
ENTRIES = f"""
entries AS (
  SELECT page_id * 2 AS pos, page_id, 0 AS copy, url, html FROM pages
  UNION ALL
  SELECT page_id * 2 + 1, page_id, 1, regexp_replace(url, '#.*$', '') || '#again', html FROM pages),
keyed AS (SELECT *, {key('url')} AS canonical_key FROM entries),
seen AS (SELECT DISTINCT {key('url')} AS k FROM pages WHERE url LIKE '%?%')
"""

# Serial first-wins walk written as SQL over a table ``cand(source, pos, k, ok)``.
STATUS = """
status AS (
  SELECT *, CASE WHEN coalesce(max(CASE WHEN ok THEN 1 ELSE 0 END) OVER (PARTITION BY k ORDER BY pos
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1 THEN 'duplicate'
                 WHEN ok THEN 'accepted' ELSE 'error' END AS status
  FROM cand)
"""


def visited(n):
    return f"""
visited AS (
  SELECT * FROM (
    SELECT *, coalesce(sum(CASE WHEN status = 'accepted' THEN 1 ELSE 0 END) OVER (PARTITION BY source ORDER BY pos
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior
    FROM status) WHERE prior < {n})
"""


DOC_CAND = "cand AS (SELECT source, doc_id AS pos, sha256(text) AS k, n_chars >= 500 AS ok FROM documents)"

AUDIT = """
recs AS (
  SELECT doc_id AS pos,
         CASE lang WHEN 'de' THEN '' WHEN 'fr' THEN '//news.example.org/' || sha256(text)
              ELSE 'https://news.example.org/' || sha256(text) END AS url,
         CASE WHEN source <> 'src7' THEN source END AS source,
         split_part(text, ' ', 1) AS title,
         CASE WHEN source <> 'src3' THEN n_chars END AS raw_text_length
  FROM documents)
"""

RUNS = """
ra AS (SELECT doc_id AS pos, text, lang, source FROM documents),
rb AS (SELECT doc_id AS pos, regexp_replace(text, '[0-9]+', '#', 'g') AS text, lang,
              CASE WHEN source <> 'src5' THEN source END AS source FROM documents)
"""

DEFAULT_RECORD = f"""
  NULL::VARCHAR AS company, NULL::VARCHAR AS funding_amount, NULL::VARCHAR AS funding_stage, '' AS investors,
  {NO_ANALYSIS} AS summary, false AS investment_relevant, 'other' AS event_type, 'unknown' AS model_used,
  '2.0.0' AS prompt_version, {RUN} AS processing_timestamp
"""

FEED = f"""
{ENTRIES},
listed AS (SELECT * FROM keyed WHERE canonical_key NOT IN (SELECT k FROM seen)),
cand AS (
  SELECT 'techcrunch' AS source, pos, canonical_key AS k, url, page_id, html, url NOT LIKE '%//spam%' AS ok
  FROM listed),
{STATUS}
"""

ITEMS = """
items AS (
  SELECT d.doc_id AS id, d.text AS title, p.url, CASE WHEN d.lang <> 'es' THEN d.text END AS text,
         1700000000 + d.n_chars AS time, d.n_chars AS score, NULL::BIGINT AS descendants, d.source AS by
  FROM documents d LEFT JOIN pages p ON p.page_id = d.doc_id)
"""

RANKED = f"""
{ITEMS},
ranked AS (
  SELECT doc_id * 2 AS pos, doc_id AS id FROM documents
  UNION ALL SELECT doc_id * 2 + 1, -1 - doc_id FROM labels),
found AS (
  SELECT r.pos, r.id, i.id IS NOT NULL AS has_item, i.title, i.url AS link, i.text, i.time, i.score, i.by AS author,
         CASE WHEN i.id IS NULL THEN NULL WHEN i.url IS NOT NULL THEN i.url
              ELSE 'https://news.ycombinator.com/item?id=' || r.id END AS url
  FROM ranked r LEFT JOIN items i ON i.id = r.id
  WHERE i.id IS NULL OR {on_topic('i.title')}),
cand AS (
  SELECT 'hackernews' AS source, f.*, {key('f.url')} AS k, p.html,
         CASE WHEN link IS NOT NULL THEN {clean_text('p.html')} ELSE coalesce(text, '') END AS content,
         CASE WHEN link IS NOT NULL THEN coalesce(p.html, '') ELSE coalesce(text, '') END AS body,
         has_item AND CASE WHEN link IS NOT NULL THEN {clean_text('p.html')} ELSE coalesce(text, '') END <> '' AS ok
  FROM found f LEFT JOIN pages p ON p.url = f.link
  WHERE f.url IS NULL OR {key('f.url')} NOT IN (SELECT {key('url')} FROM pages WHERE url LIKE '%?%')),
{STATUS}
"""

HN_META = (
    "'{\"hn_score\":' || score || ',\"comment_count\":null,\"by\":\"' || author || '\",\"id\":' || id || '}'"
)

PROMPT = (
    "chr(10) || 'Analyze the following article for Capital Intelligence:' || chr(10) || chr(10) || 'Title: ' || "
    f"{LINE1} || chr(10) || 'Source: ' || source || chr(10) || 'Date: ' || strftime({DOC_TIME}, '%Y-%m-%d %H:%M:%S')"
    " || chr(10) || 'Content:' || chr(10) || substr(text, 1, 15000) || chr(10) || chr(10)"
    " || 'Extract the required fields based on the schema.' || chr(10)"
)

RANK_LISTS = """
lists AS (
  SELECT doc_id, regexp_extract_all(text, '[0-9]{1,9}') AS ids FROM documents),
listed AS (
  SELECT doc_id, unnest(range(least(len(ids), 6)))::INTEGER AS rank, unnest(ids[1:6])::BIGINT AS id FROM lists)
"""

# --- one statement per query --------------------------------------------------------------------------

ORACLES = {
    "topic_filter": f"SELECT doc_id, {on_topic('text')} AS text_on_topic, {on_topic(LINE1)} AS title_on_topic FROM documents",
    "canonical_keys": f"""
WITH {VARIANTS}
SELECT page_id, variant, {normalized('url')} AS normalized, {key('url')} AS canonical_key FROM variants""",
    "url_checks": f"""
WITH {VARIANTS}
SELECT page_id, variant, url LIKE 'http://%' OR url LIKE 'https://%' AS is_http,
       regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1) <> ''
         AND regexp_extract(url, '^[A-Za-z0-9+.-]*:?//([^/?#]*)', 1) <> '' AS is_well_formed
FROM variants""",
    "generic_text": f"SELECT page_id, {clean_text('html')} AS clean_text FROM pages",
    "article_extract": f"""
SELECT page_id, CASE WHEN title IN ('', 'Unknown Title') THEN url ELSE title END AS title, content,
       '' AS published_raw, {RUN} AS published_at
FROM (SELECT page_id, url, {page_title('html')} AS title, {page_content('html')} AS content FROM pages)""",
    "page_scan": """
SELECT url, CASE WHEN coalesce(html, '') <> '' THEN 200 ELSE 0 END AS http_status, length(html) AS n_chars FROM pages""",
    "bucketed_page_lookup": f"""
WITH {ENTRIES}
SELECT e.pos, e.url, CASE WHEN coalesce(p.html, '') <> '' THEN 200 ELSE 0 END AS http_status, length(p.html) AS n_chars
FROM entries e JOIN pages p ON p.url = e.url""",
    "upsert_runs": f"""
WITH {RUN_ROWS},
a AS (SELECT k, {FIRST}, {LAST} FROM run_rows WHERE wave = 1 GROUP BY k),
b AS (SELECT k, {FIRST}, {LAST} FROM run_rows WHERE wave = 2 GROUP BY k),
old AS (SELECT *, row_number() OVER (ORDER BY pos) AS id FROM a),
added AS (SELECT *, (SELECT count(*) FROM a) + row_number() OVER (ORDER BY pos) AS id FROM b WHERE k NOT IN (SELECT k FROM a))
SELECT old.id, old.k AS canonical_key, old.kept.source, if(b.k IS NULL, old.upd.title, b.upd.title) AS title, old.kept.url,
       if(b.k IS NULL, old.upd.company, b.upd.company) AS company, old.kept.inserted_at
FROM old LEFT JOIN b ON b.k = old.k
UNION ALL SELECT id, k, kept.source, upd.title, kept.url, upd.company, kept.inserted_at FROM added""",
    "fold_articles": f"""
WITH {RUN_ROWS},
placed AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY inserted_at, pos) AS up,
         row_number() OVER (PARTITION BY k ORDER BY inserted_at DESC, pos DESC) AS down FROM run_rows),
folded AS (
  SELECT f.k, f.pos + 1 AS id, f.source, f.url, f.inserted_at, l.title, l.company
  FROM placed f JOIN placed l ON l.k = f.k AND l.down = 1 WHERE f.up = 1),
owned AS (SELECT *, k = min(k) OVER (PARTITION BY id) AS owner FROM folded),
late AS (SELECT k, row_number() OVER (ORDER BY inserted_at, id, k) AS place FROM owned WHERE NOT owner)
SELECT coalesce((SELECT max(id) FROM folded) + place, id) AS id, k AS canonical_key, source, title, url, company, inserted_at
FROM owned LEFT JOIN late USING (k)""",
    "content_choice": f"""
SELECT * FROM (
  SELECT page_id,
         CASE WHEN url LIKE '%#%' THEN 'https://news.ycombinator.com/item?id=' || page_id ELSE url END AS item_url,
         CASE WHEN url LIKE '%#%' THEN html ELSE {clean_text('html')} END AS content
  FROM pages) WHERE content <> ''""",
    "epoch_iso": f"""
SELECT event_id, {iso('ts')} AS iso,
       CASE WHEN event_type = 'error' THEN {RUN} ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS from_epoch
FROM events""",
    "feed_dates": """
SELECT event_id, CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS published_at FROM events""",
    "raw_feed_records": f"""
SELECT '1.0' AS schema_version, 'pages' AS source, url AS title, url, NULL::VARCHAR AS published_at,
       length(body)::INTEGER AS raw_text_length, substr(body, 1, 500) AS raw_text_preview, 200 AS http_status,
       {RUN} AS collected_at, page_id AS pos
FROM (SELECT *, CASE WHEN content <> '' THEN content ELSE html END AS body
      FROM (SELECT *, {page_content('html')} AS content FROM pages))""",
    "article_rows": f"""
SELECT source, {LINE1} AS title, {DOC_URL} AS url, strftime({DOC_TIME}, '%Y-%m-%dT%H:%M:%S') AS published_at,
       text AS content,
       '{{"hn_score":' || n_chars || ',"comment_count":null,"by":"' || lang || '","id":' || doc_id || '}}' AS raw_metadata,
       doc_id AS pos, sha256({DOC_URL}) AS canonical_key
FROM documents""",
    "json_records": """
SELECT doc_id, to_json({'doc_id': doc_id, 'text': text, 'lang': lang, 'source': source, 'n_chars': n_chars})::VARCHAR AS raw_data
FROM documents""",
    "analysis_defaults": f"""
WITH docs AS (SELECT *, sha256(text) AS h FROM documents),
first_label AS (
  SELECT h, doc_id, lang, quality, toxic FROM (
    SELECT d.h, d.doc_id, d.lang, l.quality, l.toxic, row_number() OVER (PARTITION BY h ORDER BY d.doc_id) AS rn
    FROM docs d JOIN labels l ON l.doc_id = d.doc_id) WHERE rn = 1)
SELECT '2.0' AS schema_version, d.source, {LINE1} AS title,
       'https://news.example.org/' || d.lang || '/' || d.doc_id AS url,
       strftime({DOC_TIME}, '%Y-%m-%dT%H:%M:%S') AS published_at,
       CASE WHEN f.quality = 1 THEN 'Company ' || f.doc_id END AS company,
       NULL::VARCHAR AS funding_amount,
       CASE WHEN f.toxic = 1 THEN 'Bridge' END AS funding_stage,
       CASE WHEN f.h IS NULL THEN '' ELSE f.lang || '|Quay Fund' END AS investors,
       CASE WHEN f.h IS NULL THEN {NO_ANALYSIS} ELSE 'quality ' || f.quality END AS summary,
       coalesce(f.quality = 1, false) AS investment_relevant,
       CASE WHEN f.h IS NULL THEN 'other' WHEN f.toxic = 1 THEN 'funding' ELSE 'partnership' END AS event_type,
       'unknown' AS model_used, '2.0.0' AS prompt_version, {RUN} AS processing_timestamp, d.h AS article_hash,
       '{{"hn_score":' || n_chars || ',"comment_count":null,"by":"' || d.lang || '","id":' || d.doc_id || '}}' AS metadata,
       {RUN} AS collected_at, sha256('https://news.example.org/' || d.lang || '/' || d.doc_id) AS canonical_key, d.doc_id AS pos
FROM docs d LEFT JOIN first_label f ON f.h = d.h""",
    "prompts": f"""
SELECT doc_id AS pos, sha256(prompt) AS prompt_hash, length(prompt)::INTEGER AS prompt_chars
FROM (SELECT doc_id, {PROMPT} AS prompt FROM documents)""",
    "parse_json": """
SELECT event_id, good AS has_analysis, CASE WHEN good THEN event_type END AS summary,
       CASE WHEN good THEN 'funding' END AS event_type, NULL::VARCHAR AS company,
       CASE WHEN good THEN 0 END::INTEGER AS n_investors
FROM (SELECT *, event_type NOT IN ('error', 'view') AND value > 20 AS good FROM events)""",
    "analyze_batch": f"""
SELECT doc_id AS pos, CASE WHEN good THEN length(prompt) || ' characters' END AS summary,
       CASE WHEN good THEN prompt LIKE '% the %' END AS investment_relevant,
       CASE WHEN good THEN CASE WHEN prompt LIKE '% of %' THEN 'funding' ELSE 'other' END END AS event_type,
       CASE WHEN source = 'src1' THEN 'ValueError: refused' END AS analysis_error
FROM (SELECT doc_id, source, source NOT IN ('src1', 'src2') AS good, {PROMPT} AS prompt FROM documents)""",
    "validation": f"""
SELECT doc_id AS pos, array_to_string(list_filter([
         CASE WHEN length({LINE1}) < 40 THEN 'title' END,
         CASE WHEN lang = 'fr' THEN 'url' END,
         CASE WHEN lang = 'de' THEN 'event_type' END], lambda x: x IS NOT NULL), ',') AS violations
FROM documents""",
    "preview": f"""
SELECT source, {LINE1} AS title, 'other' AS event_type, NULL::VARCHAR AS company, 'None (None)' AS funding,
       {NO_ANALYSIS} AS summary, false AS investment_relevant
FROM documents ORDER BY doc_id LIMIT 5""",
    "latest_articles": """
SELECT event_type AS source, props AS title, value > 20 AS investment_relevant
FROM events ORDER BY ts DESC, sha256(event_id::VARCHAR) LIMIT 10""",
    "first_wins_dedupe": f"""
WITH {ENTRIES},
cand AS (SELECT pos, canonical_key AS k, length(html) + copy * 1000 >= 3000 AS ok FROM keyed),
{STATUS}
SELECT pos, k AS canonical_key, ok, status FROM status""",
    "only_new": f"WITH {ENTRIES} SELECT pos, canonical_key FROM keyed WHERE canonical_key NOT IN (SELECT k FROM seen)",
    "seen_flag": f"WITH {ENTRIES} SELECT pos, canonical_key, canonical_key IN (SELECT k FROM seen) AS is_processed FROM keyed",
    "seen_union": f"WITH {ENTRIES} SELECT k AS canonical_key FROM seen UNION SELECT canonical_key FROM keyed",
    "mark_processed": f"WITH {ENTRIES} SELECT k AS canonical_key FROM seen UNION SELECT canonical_key FROM keyed",
    "seen_scan": f"WITH {ENTRIES} SELECT DISTINCT canonical_key FROM keyed",
    "success_quota": f"WITH {DOC_CAND}, {STATUS}, {visited(30)} SELECT source, pos, status FROM visited",
    "run_counters": f"""
WITH {DOC_CAND}, {STATUS}, {visited(30)}
SELECT source, count(*) FILTER (status = 'accepted') AS items_processed, count(*) FILTER (status = 'error') AS errors
FROM visited GROUP BY source""",
    "run_ledger": f"""
WITH {DOC_CAND}, {STATUS},
counted AS (
  SELECT source, count(*) FILTER (status = 'accepted') AS items_processed, count(*) FILTER (status = 'error') AS errors
  FROM status GROUP BY source)
SELECT 'run-' || source AS run_id, source, {RUN} AS started_at,
       strftime(TIMESTAMP '2026-01-01' + to_seconds(items_processed), '%Y-%m-%dT%H:%M:%S') AS completed_at,
       CASE WHEN errors > 3 THEN 'failed' ELSE 'success' END AS status, items_processed, errors
FROM counted""",
    "ranked_items": f"""
WITH {RANK_LISTS}
SELECT l.doc_id, l.rank, l.id, d.doc_id IS NOT NULL AS found, d.lang
FROM listed l LEFT JOIN documents d ON d.doc_id = l.id""",
    "found_items": f"""
WITH {RANK_LISTS}
SELECT l.doc_id, l.rank, l.id, d.lang FROM listed l JOIN documents d ON d.doc_id = l.id""",
    "upsert_articles": f"""
WITH base AS (
  SELECT doc_id AS pos, lang, {DOC_URL} AS url, sha256({DOC_URL}) AS canonical_key, source, {LINE1} AS title,
         strftime({DOC_TIME}, '%Y-%m-%dT%H:%M:%S') AS published_at
  FROM documents),
full_base AS (
  SELECT *, to_json({{'pos': pos, 'canonical_key': canonical_key, 'source': source, 'title': title, 'url': url,
                      'published_at': published_at, 'investment_relevant': false, 'event_type': 'other',
                      'summary': {NO_ANALYSIS}}})::VARCHAR AS raw_data
  FROM base),
joined AS (
  SELECT b.*, l.doc_id IS NOT NULL AS old, b.lang <> 'en' AS hit
  FROM full_base b LEFT JOIN labels l ON l.doc_id = b.pos),
fresh AS (SELECT pos, row_number() OVER (ORDER BY pos) AS rank FROM joined WHERE hit AND NOT old)
SELECT CASE WHEN old THEN j.pos + 1 ELSE (SELECT max(doc_id) + 1 FROM labels) + f.rank END AS id, canonical_key,
       CASE WHEN old THEN source ELSE source || '-0' END AS source,
       CASE WHEN old THEN url ELSE url || '#0' END AS url,
       CASE WHEN old THEN '2025-01-01T00:00:00' ELSE {RUN} END AS inserted_at,
       CASE WHEN hit THEN 'new 1 ' || title ELSE title END AS title, published_at,
       CASE WHEN NOT hit THEN 'Old Corp' END AS company, false AS investment_relevant, 'other' AS event_type,
       CASE WHEN NOT hit THEN {NO_ANALYSIS} END AS summary, raw_data
FROM joined j LEFT JOIN fresh f ON f.pos = j.pos WHERE old OR hit""",
    "audit_summary": f"""
WITH {AUDIT}
SELECT count(*) AS total_records, count(DISTINCT url) FILTER (url <> '') AS unique_urls,
       count(*) FILTER (url = '') AS missing_urls, count(*) FILTER (url LIKE '//%') AS invalid_urls,
       count(*) FILTER (url <> '' AND length(title) < 10) AS short_titles,
       count(*) FILTER (url <> '' AND raw_text_length < 500) AS short_texts,
       count(*) FILTER (url <> '') - count(DISTINCT url) FILTER (url <> '') AS duplicates,
       count(*) FILTER (url <> '') = count(DISTINCT url) FILTER (url <> '') AS passed
FROM recs""",
    "source_distribution": f"""
WITH {AUDIT}
SELECT coalesce(source, 'unknown') AS source, count(*) AS records FROM recs WHERE url <> '' GROUP BY 1""",
    "duplicate_flags": f"""
WITH {AUDIT}
SELECT pos, url <> '' AND row_number() OVER (PARTITION BY url ORDER BY pos) > 1 AS is_duplicate FROM recs""",
    "audit_findings": f"""
WITH {AUDIT},
checked AS (
  SELECT pos, list_filter([
    CASE WHEN url = '' THEN 'missing_url' END,
    CASE WHEN url LIKE '//%' THEN 'invalid_url' END,
    CASE WHEN url <> '' AND row_number() OVER (PARTITION BY url ORDER BY pos) > 1 THEN 'duplicate_url' END,
    CASE WHEN url <> '' AND length(title) < 10 THEN 'short_title' END,
    CASE WHEN url <> '' AND raw_text_length < 500 THEN 'short_text' END], lambda x: x IS NOT NULL) AS found
  FROM recs)
SELECT pos, array_to_string(found, ',') AS findings FROM checked WHERE len(found) > 0""",
    "comparison_fields": f"SELECT source, {LINE1} AS title FROM documents",
    "fingerprints": """
SELECT doc_id AS pos, sha256(to_json({'lang': lang, 'source': source, 'text': text})::VARCHAR) AS digest FROM documents""",
    "compare_positional": f"""
WITH {RUNS},
na AS (SELECT *, row_number() OVER (ORDER BY pos) - 1 AS i FROM ra),
nb AS (SELECT *, row_number() OVER (ORDER BY pos) - 1 AS i FROM rb)
SELECT na.i AS index, na.pos AS left_pos, nb.pos AS right_pos FROM na JOIN nb ON na.i = nb.i
WHERE (na.text, na.lang, na.source) IS DISTINCT FROM (nb.text, nb.lang, nb.source)""",
    "compare_counts": f"""
WITH {RUNS}
SELECT (SELECT count(*) FROM ra) AS left_count, (SELECT count(*) FROM rb WHERE lang <> 'es') AS right_count,
       (SELECT count(*) FROM ra) = (SELECT count(*) FROM rb WHERE lang <> 'es') AS same""",
    "compare_verdict": f"""
WITH {RUNS}
SELECT count(*) AS left_count, count(*) AS right_count,
       count(*) FILTER (ra.text <> rb.text OR ra.source IS DISTINCT FROM rb.source) AS mismatches,
       count(*) FILTER (ra.text <> rb.text OR ra.source IS DISTINCT FROM rb.source) = 0 AS identical
FROM ra JOIN rb ON ra.pos = rb.pos""",
    "compare_ingestion_verdict": f"""
WITH {RUNS}
SELECT count(*) AS left_count, count(*) AS right_count,
       count(*) FILTER (ra.source IS DISTINCT FROM rb.source) AS mismatches,
       count(*) FILTER (ra.source IS DISTINCT FROM rb.source) = 0 AS identical
FROM ra JOIN rb ON ra.pos = rb.pos""",
    "compare_multiset": f"""
WITH {RUNS},
both_sides AS (
  SELECT sha256(to_json({{'lang': lang, 'source': source, 'text': text}})::VARCHAR) AS digest, 1 AS l, 0 AS r FROM ra
  UNION ALL
  SELECT sha256(to_json({{'lang': lang, 'source': source, 'text': text}})::VARCHAR), 0, 1 FROM rb)
SELECT digest, sum(l)::BIGINT AS left_count, sum(r)::BIGINT AS right_count FROM both_sides
GROUP BY digest HAVING sum(l) <> sum(r)""",
    "compare_content_verdict": f"""
WITH {RUNS},
gone AS (SELECT text, lang, source FROM ra EXCEPT ALL SELECT text, lang, source FROM rb)
SELECT (SELECT count(*) FROM ra) AS left_count, (SELECT count(*) FROM rb) AS right_count,
       count(*) AS mismatches, count(*) = 0 AS identical FROM gone""",
    "field_diff": f"""
WITH {RUNS},
na AS (SELECT *, row_number() OVER (ORDER BY pos) - 1 AS i FROM ra),
nb AS (SELECT *, row_number() OVER (ORDER BY pos) - 1 AS i FROM rb),
cells AS (
  SELECT na.i AS index, unnest(['text', 'lang', 'source']) AS field, unnest([na.text, na.lang, na.source]) AS left_value,
         unnest([nb.text, nb.lang, nb.source]) AS right_value
  FROM na JOIN nb ON na.i = nb.i)
SELECT * FROM cells WHERE left_value IS DISTINCT FROM right_value""",
    "field_diff_by_key": f"""
WITH {RUNS},
ua AS (SELECT *, 'https://news.example.org/' || sha256(text) AS url FROM ra),
ub AS (SELECT rb.*, ua.url FROM rb JOIN ua ON ua.pos = rb.pos WHERE rb.lang <> 'es'),
na AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY pos) - 1 AS occ FROM ua),
nb AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY pos) - 1 AS occ FROM ub),
cells AS (
  SELECT coalesce(na.url, nb.url) AS url, coalesce(na.occ, nb.occ) AS occurrence,
         unnest(['text', 'lang', 'source']) AS field, unnest([na.text, na.lang, na.source]) AS left_value,
         unnest([nb.text, nb.lang, nb.source]) AS right_value
  FROM na FULL JOIN nb ON na.url = nb.url AND na.occ = nb.occ)
SELECT * FROM cells WHERE left_value IS DISTINCT FROM right_value""",
    "jsonl_round_trip": f"""
SELECT '1.0' AS schema_version, source, {LINE1} AS title, {DOC_URL} AS url,
       strftime({DOC_TIME}, '%Y-%m-%dT%H:%M:%S') AS published_at, length(text)::INTEGER AS raw_text_length,
       substr(text, 1, 500) AS raw_text_preview, 200 AS http_status, {RUN} AS collected_at
FROM documents""",
    "feed_scan": """
SELECT 'Page & <' || page_id || '>' AS title, url AS link,
       CASE WHEN url NOT LIKE '%#%' THEN 'Tue, 05 Mar 2024 10:11:12 +0100' END AS published,
       CASE WHEN url NOT LIKE '%#%' THEN '2024-03-05T09:11:12' END AS published_at
FROM pages""",
    "item_scan": f"WITH {ITEMS} SELECT * FROM items",
    "feed_ingest": f"""
WITH {FEED}
SELECT '2.0' AS schema_version, source,
       CASE WHEN title IN ('', 'Unknown Title') THEN 'Feed title ' || page_id ELSE title END AS title, url,
       {RUN} AS published_at, {DEFAULT_RECORD}, sha256(content) AS article_hash,
       '{{"parsed_at":"' || {RUN} || '"}}' AS metadata, {RUN} AS collected_at, k AS canonical_key, pos
FROM (SELECT *, {page_title('html')} AS title, {page_content('html')} AS content FROM status WHERE status = 'accepted')""",
    "feed_ingest_counters": f"""
WITH {FEED}, {visited(30)}
SELECT source, count(*) FILTER (status = 'accepted') AS items_processed, count(*) FILTER (status = 'error') AS errors
FROM visited GROUP BY source""",
    "feed_raw_ingest": f"""
WITH {ENTRIES},
cand AS (SELECT 'techcrunch' AS source, pos, page_id, url, html, canonical_key AS k, true AS ok FROM keyed
         WHERE canonical_key NOT IN (SELECT k FROM seen)),
{STATUS},
bodies AS (
  SELECT *, CASE WHEN url LIKE '%//spam%' THEN '' WHEN {page_content('html')} <> '' THEN {page_content('html')}
            ELSE html END AS body
  FROM status WHERE status = 'accepted')
SELECT '1.0' AS schema_version, source, 'Feed title ' || page_id AS title, url,
       'Tue, 05 Mar 2024 10:11:12 +0100' AS published_at, length(body)::INTEGER AS raw_text_length,
       substr(body, 1, 500) AS raw_text_preview, CASE WHEN url LIKE '%//spam%' THEN 0 ELSE 200 END AS http_status,
       {RUN} AS collected_at, k AS canonical_key, pos
FROM bodies""",
    "ranked_ingest": f"""
WITH {RANKED}
SELECT '2.0' AS schema_version, source, title, url,
       strftime(make_timestamp(time * 1000000), '%Y-%m-%dT%H:%M:%S') AS published_at, {DEFAULT_RECORD},
       sha256(content) AS article_hash, {HN_META} AS metadata, {RUN} AS collected_at, k AS canonical_key, pos
FROM status WHERE status = 'accepted'""",
    "ranked_ingest_counters": f"""
WITH {RANKED}
SELECT source, count(*) FILTER (status = 'accepted') AS items_processed, count(*) FILTER (status = 'error') AS errors
FROM status GROUP BY source""",
    "ranked_raw_ingest": f"""
WITH {RANKED}
SELECT '1.0' AS schema_version, source, title, url,
       strftime(make_timestamp(time * 1000000), '%Y-%m-%dT%H:%M:%S') AS published_at,
       length(body)::INTEGER AS raw_text_length, substr(body, 1, 500) AS raw_text_preview, 200 AS http_status,
       {RUN} AS collected_at, k AS canonical_key, pos
FROM status WHERE status = 'accepted'""",
    "stream_ingest": f"""
WITH all_entries AS (
  SELECT page_id * 2 AS pos, page_id, url, html FROM pages
  UNION ALL SELECT page_id * 2 + 1, page_id, regexp_replace(url, '#.*$', '') || '#again', html FROM pages),
cand AS (SELECT 'techcrunch' AS source, pos, page_id, url, html, {key('url')} AS k, url NOT LIKE '%//spam%' AS ok FROM all_entries),
{STATUS},
recs AS (
  SELECT *, CASE WHEN title IN ('', 'Unknown Title') THEN 'Feed title ' || page_id ELSE title END AS final_title
  FROM (SELECT *, {page_title('html')} AS title, {page_content('html')} AS content FROM status WHERE status = 'accepted'))
SELECT row_number() OVER (ORDER BY pos) AS id, k AS canonical_key, source, final_title AS title, url,
       {RUN} AS published_at, NULL::VARCHAR AS company, NULL::VARCHAR AS funding_amount,
       NULL::VARCHAR AS funding_stage, '' AS investors, false AS investment_relevant, 'other' AS event_type,
       {NO_ANALYSIS} AS summary, {RUN} AS inserted_at,
       to_json({{'schema_version': '2.0', 'source': source, 'title': final_title, 'url': url, 'published_at': {RUN},
                 'company': NULL, 'funding_amount': NULL, 'funding_stage': NULL, 'investors': []::VARCHAR[],
                 'summary': {NO_ANALYSIS}, 'investment_relevant': false, 'event_type': 'other',
                 'model_used': 'unknown', 'prompt_version': '2.0.0', 'processing_timestamp': {RUN},
                 'article_hash': sha256(content), 'metadata': '{{"parsed_at":"' || {RUN} || '"}}',
                 'collected_at': {RUN}}})::VARCHAR AS raw_data
FROM recs""",
}
