"""The same queries in SQL, run by another engine over the same tables."""

from __future__ import annotations

from pressloom.functions.pii import EMAIL_PATTERN, PHONE_PATTERN, RULES, URL_PATTERN
from pressloom.functions.text import STOP_WORDS
from pressloom.operators.index import FIELD_WEIGHTS
from workloads.queries import LEXICON

WS = r"[\t\n\x0B\f\r \x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _in(words) -> str:
    return "(" + ", ".join(_q(w) for w in dict.fromkeys(words)) + ")"


STOPS = _in(STOP_WORDS)
EMAIL, PHONE, URL = _q(EMAIL_PATTERN), _q(PHONE_PATTERN), _q(URL_PATTERN)


def _trim(column: str) -> str:
    return f"regexp_replace({column}, '^{WS}+|{WS}+$', '', 'g')"


ARTICLES = """
articles AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, doc_id,
         'https://news.example.com/' || source || '/' || doc_id AS url,
         regexp_extract(text, '^[^.\\n]*') AS title, text, lang AS category, source, n_chars,
         DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER) AS article_date,
         CAST(DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER) AS TIMESTAMP)
           + to_hours(CAST(doc_id % 24 AS INTEGER)) AS published_at
  FROM documents)"""

SILVER = f"""{ARTICLES},
silver AS (
  SELECT a.*, quality IS NOT NULL AS ok,
         CASE WHEN quality IS NULL THEN NULL WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive'
              ELSE 'neutral' END AS label,
         CASE WHEN quality IS NULL THEN NULL WHEN toxic = 1 THEN 0.05::DOUBLE
              WHEN quality = 1 THEN 0.55::DOUBLE + (n_chars % 97) / 97.0::DOUBLE * 0.25::DOUBLE
              ELSE (n_chars % 97) / 97.0::DOUBLE * 0.3::DOUBLE END AS positive,
         CASE WHEN quality IS NULL THEN NULL
              WHEN toxic = 1 THEN 0.6::DOUBLE + (n_chars % 97) / 97.0::DOUBLE * 0.3::DOUBLE
              ELSE (n_chars % 97) / 97.0::DOUBLE * 0.2::DOUBLE END AS negative
  FROM articles a LEFT JOIN labels l ON a.doc_id = l.doc_id)"""

SQL: dict[str, str] = {}

DOMINANT = """CASE WHEN avg_positive >= avg_negative THEN 'positive' WHEN avg_negative > avg_neutral THEN 'negative'
            ELSE 'neutral' END"""

SQL["sentiment_trends"] = f"""
WITH {SILVER}, daily AS (
  SELECT category, article_date, count(*) AS article_count, round(avg(positive), 4) AS avg_positive,
         round(avg(negative), 4) AS avg_negative, round(avg(1.0 - positive - negative), 4) AS avg_neutral
  FROM silver WHERE ok GROUP BY ALL)
SELECT category, CAST(article_date AS VARCHAR) AS article_date, article_count, avg_positive, avg_negative, avg_neutral,
       {DOMINANT} AS dominant_sentiment, '2024-01-30' AS run_date
FROM daily"""

SQL["sentiment_rolling"] = f"""
WITH {SILVER}, daily AS (
  SELECT category, article_date, count(*) AS n, sum(positive) AS p, sum(negative) AS g,
         sum(1.0 - positive - negative) AS u
  FROM silver WHERE ok GROUP BY ALL)
SELECT category, CAST(article_date AS VARCHAR) AS article_date, CAST(sum(n) OVER w AS BIGINT) AS article_count,
       round(sum(p) OVER w / sum(n) OVER w, 4) AS avg_positive,
       round(sum(g) OVER w / sum(n) OVER w, 4) AS avg_negative,
       round(sum(u) OVER w / sum(n) OVER w, 4) AS avg_neutral
FROM daily
WINDOW w AS (PARTITION BY category ORDER BY article_date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)"""

ENTITIES = r"unnest(regexp_extract_all(text, '\p{Lu}\p{L}+'))"


def _top_entities(count: str) -> str:
    return f"""
WITH {SILVER}, mentions AS (SELECT id, category, {ENTITIES} AS entity_text FROM silver WHERE ok),
totals AS (SELECT category, entity_text, {count} AS entity_count FROM mentions GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY entity_count DESC, entity_text) AS rank FROM totals)
SELECT category, entity_text, entity_count, rank, '2024-01-30' AS run_date FROM ranked WHERE rank <= 20"""


SQL["top_entities"] = _top_entities("count(*)")
SQL["top_entities_articles"] = _top_entities("count(DISTINCT id)")

TRENDING = f"""
WITH {SILVER}, words AS (
  SELECT category, article_date, unnest(regexp_split_to_array(text, '[ \\t\\n\\r]+')) AS word FROM silver WHERE ok),
phrases AS (SELECT category, article_date, lower(trim(word)) AS key_phrase FROM words WHERE length(word) > 2),
counts AS (
  SELECT category, key_phrase, count(*) FILTER (article_date >= DATE '2024-01-16') AS count_current,
         count(*) FILTER (article_date < DATE '2024-01-16') AS count_prior
  FROM phrases GROUP BY ALL),
scored AS (SELECT *, round(count_current / (count_prior + 1), 4) AS trend_score FROM counts WHERE count_current > 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY trend_score DESC, count_current DESC, key_phrase)
             AS rank FROM scored)
SELECT category, key_phrase, count_current, count_prior, trend_score, rank"""

SQL["trending_keywords"] = TRENDING + ", '2024-01-30' AS run_date FROM ranked WHERE rank <= 30"
SQL["gold_job"] = TRENDING + " FROM ranked WHERE rank <= 30"

HAS_PII = f"(regexp_matches(text, {EMAIL}) OR regexp_matches(text, {PHONE}))"

SQL["data_quality"] = f"""
WITH {SILVER}, counted AS (
  SELECT count(*) AS total_rows, count(*) FILTER (ok) AS nlp_ok, count(*) FILTER ({HAS_PII}) AS pii_rows FROM silver)
SELECT 'silver' AS label, total_rows, nlp_ok, total_rows - nlp_ok AS nlp_failed, pii_rows,
       CASE WHEN total_rows = 0 THEN 'NO_ROWS' WHEN (total_rows - nlp_ok) / total_rows > 0.2 THEN 'HIGH_FAILURE_RATE' END AS warning
FROM counted"""

SQL["date_spine"] = f"""
WITH {ARTICLES}, spine AS (
  SELECT category, CAST(d AS DATE) AS article_date
  FROM (VALUES ('en'), ('fr'), ('de'), ('es')) AS c(category),
       generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY) AS s(d))
SELECT s.category, CAST(s.article_date AS VARCHAR) AS article_date, count(a.id) AS n
FROM spine s LEFT JOIN articles a ON a.category = s.category AND a.article_date = s.article_date
GROUP BY s.category, s.article_date"""

SQL["url_hash"] = "SELECT page_id, substr(sha256(url), 1, 16) AS url_hash, substr(sha256(url), 1, 16) AS padded_hash FROM pages"

SQL["extract_text"] = f"""
SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(
         html || ' [+' || length(html) || ' chars] ' || chr(10), '{WS}*\\[\\+\\d+ chars\\]{WS}*$', ''),
         '<[^>]+>', ' ', 'g'), '{WS}+', ' ', 'g')) AS text, true AS truncated
FROM pages"""

SQL["text_source"] = f"""
SELECT conv_id, turn,
       CASE WHEN role = 'assistant' AND length({_trim('text')}) > 0 THEN 'content'
            WHEN role = 'user' AND length({_trim('text')}) > 0 THEN 'description' ELSE 'title' END AS text_source,
       substr(CASE WHEN role = 'assistant' AND length({_trim('text')}) > 0
                THEN trim(regexp_replace(regexp_replace(regexp_replace(text, '{WS}*\\[\\+\\d+ chars\\]{WS}*$', ''),
                     '<[^>]+>', ' ', 'g'), '{WS}+', ' ', 'g'))
            WHEN role = 'user' AND length({_trim('text')}) > 0 THEN {_trim('text')} ELSE role END, 1, 500) AS body_snippet
FROM conversations"""

SQL["truncate_words"] = """
WITH cut AS (
  SELECT doc_id, text, substr(text, 1, 5000) AS head,
         5000 - instr(reverse(substr(text, 1, 5000)), ' ') AS before_space FROM documents),
done AS (
  SELECT doc_id, CASE WHEN length(text) <= 5000 THEN text
                      WHEN before_space < 5000 AND before_space > 4000 THEN substr(head, 1, before_space)
                      ELSE head END AS t FROM cut)
SELECT doc_id, length(t) AS chars, md5(t) AS digest FROM done"""

SQL["embedding_input"] = f"""
WITH {ARTICLES}, joined AS (
  SELECT id, concat_ws(chr(10) || chr(10), nullif(title, ''), nullif(substr(text, 1, 500), '')) AS t FROM articles),
done AS (SELECT id, CASE WHEN length({_trim('t')}) > 0 THEN substr(t, 1, 32000) END AS t FROM joined)
SELECT id, length(t) AS chars, md5(t) AS digest FROM done"""

SQL["strip_publisher"] = f"""
WITH {ARTICLES}
SELECT id, CASE WHEN doc_id % 2 = 0 THEN title ELSE title || ' - else' END AS headline FROM articles"""

FILE_EVENTS = """
file_events AS (
  SELECT event_id, event_type, user_id, ts,
         CASE WHEN event_type = 'error' THEN 'articles-error' ELSE 'articles-bronze' END AS container,
         strftime(ts, '%Y-%m-%d') AS date_str, substr(sha256(CAST(user_id AS VARCHAR)), 1, 16) AS url_hash FROM events)"""

SQL["parse_paths"] = f"""
WITH {FILE_EVENTS}
SELECT event_id, container, 'user/' || date_str || '/' || url_hash || '.json' AS path, 'user' AS category, date_str,
       url_hash, true AS date_ok FROM file_events"""

TOKENS = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}]+')"

SQL["tokens"] = f"""
WITH {ARTICLES}, words AS (SELECT DISTINCT id, unnest({TOKENS.format('text')}) AS term FROM articles)
SELECT term, count(*) AS df FROM words WHERE term NOT IN {STOPS} GROUP BY term"""

SQL["latest_per_key"] = """
SELECT user_id, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""

SQL["envelope_explode"] = """
WITH lines AS (
  SELECT conv_id || '/' || turn AS category, role, string_split(text, chr(10)) AS parts FROM conversations),
articles AS (
  SELECT category, unnest(parts) AS title, generate_subscripts(parts, 1) - 1 AS i FROM lines WHERE role <> 'system')
SELECT CASE WHEN length(title) > 40 THEN 'article' ELSE 'no_url' END AS kind, category, title,
       CASE WHEN length(title) > 40 THEN 'u' || i END AS url FROM articles
UNION ALL
SELECT 'failed', category, role, 'rateLimited' FROM lines WHERE role = 'system'"""

SQL["bronze_latest"] = f"""
WITH {ARTICLES}
SELECT id, category, CASE WHEN length(text) > 1000 THEN 'Update: ' || title ELSE title END AS title,
       CASE WHEN length(text) > 1000 THEN '2024-01-31T12:00:00Z' ELSE '2024-01-31T06:00:00Z' END AS ingested_at
FROM articles"""

SQL["dedup_new"] = f"""
WITH {FILE_EVENTS}
SELECT url_hash, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS ingested_at FROM file_events
WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'error' AND value > 90)
GROUP BY url_hash"""

SQL["new_only"] = f"""
WITH {SILVER}
SELECT category, CAST(article_date AS VARCHAR) AS article_date, id, 'a' AS ingested_at FROM silver WHERE NOT ok"""

SQL["backfill_candidates"] = f"""
WITH {SILVER}
SELECT category, CAST(article_date AS VARCHAR) AS article_date, id,
       category || '/' || article_date || '/' || id || '.json' AS blob_path, ok AS enriched FROM silver"""

SQL["backfill_stats"] = f"""
WITH {SILVER}
SELECT count(*) AS total, count(*) FILTER (ok) AS already_enriched, count(*) FILTER (NOT ok) AS queued,
       CAST(0 AS BIGINT) AS failed FROM silver"""

SQL["backfill_sample"] = f"""
WITH {SILVER}
SELECT category || '/' || article_date || '/' || id || '.json' AS blob_path FROM silver WHERE NOT ok ORDER BY 1 LIMIT 5"""

SQL["merge_upsert"] = """
SELECT coalesce(c_custkey, s_suppkey * 30) AS key, CASE WHEN c_custkey IS NULL THEN s_name ELSE c_name END AS name,
       CASE WHEN s_suppkey IS NULL THEN c_acctbal ELSE s_acctbal END AS balance, c_mktsegment AS segment
FROM customer FULL JOIN supplier ON c_custkey = s_suppkey * 30"""

SQL["merge_counts"] = """
SELECT CASE WHEN c_custkey IS NULL THEN 'inserted' WHEN s_suppkey IS NULL THEN 'kept' ELSE 'updated' END AS change,
       count(*) AS n
FROM customer FULL JOIN supplier ON c_custkey = s_suppkey * 30 GROUP BY ALL"""

SQL["overwrite_partition"] = f"WITH {ARTICLES} SELECT id, category, substr(sha256(url), 1, 16) AS url_hash FROM articles"

SQL["audit_rows"] = """
SELECT substr(sha256(CAST(user_id AS VARCHAR)), 1, 16) || '_enrich_queued_' || (epoch_us(ts) // 1000) AS "rowKey",
       substr(sha256(CAST(user_id AS VARCHAR)), 1, 16) AS "urlHash", 'enrich_queued' AS event,
       '{"message":"' || event_type || '","event_id":' || event_id || '}' AS details, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS audit_date
FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-30'"""

SQL["error_rows"] = f"""
WITH {SILVER}
SELECT id AS "urlHash", category || '/' || article_date || '/' || id || '.json' AS "blobPath", 'no label' AS error,
       'enrichment' AS stage, category, CAST(article_date AS VARCHAR) AS article_date FROM silver WHERE NOT ok"""

SQL["peek_pending"] = f"""
WITH {FILE_EVENTS}
SELECT 'user/' || date_str || '/' || url_hash || '.json' AS "blobPath", url_hash AS "urlHash", 'user' AS category,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS enqueued_at
FROM file_events WHERE event_type NOT IN ('error', 'view') ORDER BY ts LIMIT 10"""

SQL["pending_depth"] = "SELECT count(*) AS depth FROM events WHERE event_type NOT IN ('error', 'view')"

SQL["merge_annotations"] = f"""
WITH {SILVER}, found AS (
  SELECT id, category, label, ok, {HAS_PII} AS pii, length(text) > 2000 AS long,
         len(regexp_extract_all(text, '\\p{{Lu}}\\p{{L}}+')) AS ents, len(regexp_split_to_array(text, '[ \\t\\n\\r]+')) AS phr
  FROM silver)
SELECT id, CASE WHEN ok OR pii OR long THEN 'ok' ELSE 'failed' END AS "nlpStatus",
       CASE WHEN ok OR pii OR long THEN NULL ELSE 'No result returned by annotator' END AS "nlpError", label AS sentiment,
       CASE WHEN pii THEN ents ELSE 0 END AS n_entities, CASE WHEN long THEN phr ELSE 0 END AS n_phrases
FROM found"""

LEXICON_SCORES = f"""
polar AS (
  SELECT id, count(*) FILTER (w IN {_in(LEXICON.positive)}) AS np, count(*) FILTER (w IN {_in(LEXICON.negative)}) AS nn
  FROM (SELECT id, unnest({TOKENS.format('text')}) AS w FROM articles) GROUP BY id),
scored AS (
  SELECT a.id, coalesce(np, 0) / (coalesce(np, 0) + coalesce(nn, 0) + 1) AS p,
         coalesce(nn, 0) / (coalesce(np, 0) + coalesce(nn, 0) + 1) AS g,
         1 / (coalesce(np, 0) + coalesce(nn, 0) + 1) AS u
  FROM articles a LEFT JOIN polar USING (id)),
sentiment AS (
  SELECT id, CASE WHEN p >= 0.3 AND g >= 0.3 THEN 'mixed' WHEN p > g AND p > u THEN 'positive'
                  WHEN g > p AND g > u THEN 'negative' ELSE 'neutral' END AS label, p, g, u FROM scored)"""

SQL["sentiment_lexicon"] = f"""
WITH {ARTICLES}, {LEXICON_SCORES}
SELECT id, label, round(p, 6) AS positive, round(g, 6) AS negative, round(u, 6) AS neutral FROM sentiment"""

PATTERNED = f"""
patterned AS (
  SELECT id, 'Email' AS category, 1 AS kind, unnest(regexp_extract_all(text, {EMAIL})) AS t,
         generate_subscripts(regexp_extract_all(text, {EMAIL}), 1) AS pos FROM articles
  UNION ALL
  SELECT id, 'PhoneNumber', 2, unnest(regexp_extract_all(text, {PHONE})),
         generate_subscripts(regexp_extract_all(text, {PHONE}), 1) FROM articles
  UNION ALL
  SELECT id, 'URL', 3, unnest(regexp_extract_all(text, {URL})),
         generate_subscripts(regexp_extract_all(text, {URL}), 1) FROM articles)"""

SQL["entities_extract"] = f"""
WITH {ARTICLES}, {PATTERNED},
names AS (
  SELECT DISTINCT name FROM (
    SELECT unnest(regexp_extract_all(text, '\\p{{Lu}}\\p{{L}}+')) AS name FROM benchmark
    UNION ALL SELECT regexp_extract(text, '^\\p{{L}}+ \\p{{L}}+') FROM benchmark) WHERE name <> ''),
words AS (
  SELECT id, unnest(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}]+')) AS w,
         generate_subscripts(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}]+'), 1) AS pos FROM articles),
runs AS (
  SELECT id, pos, w AS name FROM words
  UNION ALL
  SELECT a.id, a.pos, a.w || ' ' || b.w FROM words a JOIN words b ON a.id = b.id AND b.pos = a.pos + 1),
mentions AS (
  SELECT id, category, kind, t, pos FROM patterned
  UNION ALL
  SELECT id, CASE WHEN length(name) % 2 = 0 THEN 'Organization' ELSE 'Person' END, 4, name, pos
  FROM runs JOIN names USING (name)),
listed AS (
  SELECT id, string_agg(category || ':' || t, '|' ORDER BY kind, pos, length(t)) AS entities,
         bool_or(category IN ('Email', 'PhoneNumber', 'Person')) AS has_pii FROM mentions GROUP BY id)
SELECT id, coalesce(entities, '') AS entities, coalesce(has_pii, false) AS has_pii FROM articles LEFT JOIN listed USING (id)"""

_WS_CLASS = WS[1:-1]
RAKE = f"""
pieces AS (
  SELECT id, unnest(regexp_split_to_array(regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}{_WS_CLASS}]', ' | ', 'g'), '{WS}+')) AS w,
         generate_subscripts(regexp_split_to_array(regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}{_WS_CLASS}]', ' | ', 'g'), '{WS}+'), 1) AS pos
  FROM articles),
marked AS (
  SELECT id, w, pos, count(*) FILTER (w = '|' OR w IN {STOPS}) OVER (PARTITION BY id ORDER BY pos) AS run,
         (w = '|' OR w IN {STOPS}) AS is_break
  FROM pieces WHERE w <> ''),
runs AS (
  SELECT id, run, string_agg(w, ' ' ORDER BY pos) AS phrase, count(*) AS n FROM marked WHERE NOT is_break GROUP BY id, run),
kept AS (SELECT * FROM runs),
kept_words AS (SELECT m.id, m.run, m.w, k.n FROM marked m JOIN kept k ON m.id = k.id AND m.run = k.run WHERE NOT is_break),
weights AS (SELECT id, w, avg(n) AS weight FROM kept_words GROUP BY id, w),
run_scores AS (SELECT k.id, k.run, sum(weight) AS score FROM kept_words k JOIN weights USING (id, w) GROUP BY k.id, k.run),
phrase_scores AS (SELECT id, phrase, round(max(score), 6) AS score FROM kept JOIN run_scores USING (id, run) GROUP BY id, phrase),
ranked_phrases AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, phrase) AS rank FROM phrase_scores)"""

SQL["rake_phrases"] = f"WITH {ARTICLES}, {RAKE} SELECT id, phrase, score, rank FROM ranked_phrases WHERE rank <= 10"

SQL["hashed_embedding"] = f"""
WITH {ARTICLES}, counted AS (SELECT id, len({TOKENS.format('text')}) > 0 AS has_words FROM articles)
SELECT id, CASE WHEN has_words THEN 'ok' ELSE 'empty_content' END AS "vectorStatus",
       CASE WHEN has_words THEN CAST(64 AS BIGINT) END AS dims, CASE WHEN has_words THEN 1.0::DOUBLE END AS norm
FROM counted"""

CLEANED = ARTICLES.replace("text, lang AS", f"""trim(regexp_replace(regexp_replace(regexp_replace(text,
           '{WS}*\\[\\+\\d+ chars\\]{WS}*$', ''), '<[^>]+>', ' ', 'g'), '{WS}+', ' ', 'g')) AS text, lang AS""")

SQL["enrich_end_to_end"] = f"""
WITH {CLEANED}, {LEXICON_SCORES}, {PATTERNED}, {RAKE},
pattern_counts AS (SELECT id, count(*) AS n, bool_or(category <> 'URL') AS pii FROM patterned GROUP BY id),
phrase_counts AS (SELECT id, count(*) AS n, min(phrase) FILTER (rank = 1) AS top FROM ranked_phrases WHERE rank <= 10 GROUP BY id)
SELECT a.id, a.category, CASE WHEN length(text) > 0 THEN 'ok' ELSE 'failed' END AS "nlpStatus",
       CASE WHEN length(text) > 0 THEN s.label END AS sentiment_label, coalesce(e.n, 0) AS n_entities,
       coalesce(e.pii, false) AS "hasPii", p.top AS top_phrase, coalesce(p.n, 0) AS n_phrases,
       CASE WHEN len({TOKENS.format("a.title || ' ' || substr(a.text, 1, 500)")}) > 0 THEN 'ok' ELSE 'empty_content' END AS "vectorStatus"
FROM articles a JOIN sentiment s USING (id) LEFT JOIN pattern_counts e USING (id) LEFT JOIN phrase_counts p USING (id)"""

SQL["search_docs"] = f"""
WITH {SILVER}
SELECT id, url, title, source, category, strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published_at,
       silver.label AS sentiment_label, round(positive, 6) AS sentiment_score_positive,
       len(regexp_extract_all(text, '\\p{{Lu}}\\p{{L}}+')) AS n_entities,
       list_extract(regexp_extract_all(text, '\\p{{Lu}}\\p{{L}}+'), 1) AS first_entity,
       len(regexp_split_to_array(text, '[ \\t\\n\\r]+')) AS n_key_phrases, len(embedding) AS dims
FROM silver LEFT JOIN embeddings ON vec_id = doc_id"""

SQL["index_upsert"] = f"""
WITH {SILVER}
SELECT id, CASE WHEN label = 'negative' THEN 'Update: ' || title ELSE title END AS title, category,
       strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published_at, label AS sentiment_label FROM silver"""

SQL["index_refresh"] = f"""
WITH {SILVER}
SELECT id, category, strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published_at, label AS sentiment_label,
       len(list_filter({TOKENS.format('title')}, lambda w: w NOT IN {STOPS})) AS title_terms
FROM silver"""

SQL["index_stats"] = "SELECT count(*) AS document_count, true AS has_bytes FROM documents"

def _field_tokens(docs: str = "articles") -> str:
    """Terms of all searchable fields of a table, and their statistics."""
    return f"""
field_texts AS (
  SELECT id, 'title' AS field, title AS t FROM {docs} UNION ALL SELECT id, 'body_snippet', text FROM {docs}
  UNION ALL SELECT id, 'key_phrases', array_to_string(regexp_split_to_array(text, '[ \\t\\n\\r]+'), ' ') FROM {docs}
  UNION ALL SELECT id, 'entities', array_to_string(regexp_extract_all(text, '\\p{{Lu}}\\p{{L}}+'), ' ') FROM {docs}),
raw_tokens AS (SELECT id, field, unnest({TOKENS.format('t')}) AS term FROM field_texts),
field_terms AS (SELECT * FROM raw_tokens WHERE term NOT IN {STOPS}),
lens AS (SELECT id, field, count(*) AS len FROM field_terms GROUP BY id, field),
stats AS (
  SELECT field, count(*) AS n_docs, sum(coalesce(len, 0)) / count(*) AS avg_len
  FROM field_texts LEFT JOIN lens USING (id, field) GROUP BY field),
postings AS (SELECT id, field, term, count(*) AS tf FROM field_terms GROUP BY id, field, term),
dfs AS (SELECT field, term, count(*) AS df FROM postings GROUP BY field, term)"""


FIELD_TOKENS = _field_tokens()
WEIGHT = "CASE field " + " ".join(f"WHEN '{name}' THEN {weight}::DOUBLE" for name, weight in FIELD_WEIGHTS.items()) + " END"

SQL["corpus_stats"] = f"WITH {ARTICLES}, {FIELD_TOKENS} SELECT field, n_docs, round(avg_len, 6) AS avg_len FROM stats"

SQL["postings"] = f"""
WITH {ARTICLES}, {FIELD_TOKENS}
SELECT field, term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS occurrences FROM postings GROUP BY field, term"""

SQL["index_build"] = f"""
WITH {ARTICLES}, {FIELD_TOKENS}
SELECT field, count(*) AS postings, CAST(sum(tf) AS BIGINT) AS tokens, any_value(n_docs) AS n_docs,
       round(any_value(avg_len), 6) AS avg_len FROM postings JOIN stats USING (field) GROUP BY field"""

_SCORES = f"""
query_terms AS (
  SELECT DISTINCT item_id AS query_id, term FROM (SELECT item_id, unnest({TOKENS.format('text')}) AS term FROM benchmark)
  WHERE term NOT IN {STOPS}),
bm25 AS (
  SELECT query_id, p.id, sum({WEIGHT.replace('field', 'p.field')}
           * ln(1 + (n_docs - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.2::DOUBLE
           / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * len / avg_len))) AS score
  FROM postings p JOIN query_terms USING (term) JOIN dfs USING (field, term) JOIN stats USING (field)
       JOIN lens ON lens.id = p.id AND lens.field = p.field
  GROUP BY query_id, p.id)"""
BM25 = f"{FIELD_TOKENS},{_SCORES}"

SQL["bm25_top"] = f"""
WITH {ARTICLES}, {BM25}, rounded AS (SELECT query_id, id, round(score, 6) AS score FROM bm25)
SELECT query_id, id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM rounded
QUALIFY rank <= 10"""

SQL["segment_refresh"] = f"""
WITH {ARTICLES}, marked AS (
  SELECT *, CASE WHEN day(article_date) <= 27 AND doc_id % 20 < 3 THEN doc_id % 20 END AS updated,
         CASE WHEN day(article_date) <= 27 AND doc_id % 23 < 3 THEN doc_id % 23 END AS deleted FROM articles),
current_docs AS (
  SELECT id, CASE WHEN updated IS NULL THEN title ELSE 'Update: ' || title END AS title, text FROM marked
  WHERE deleted IS NULL OR coalesce(updated > deleted, false)),
{_field_tokens('current_docs')},{_SCORES}, rounded AS (SELECT query_id, id, round(score, 6) AS score FROM bm25)
SELECT query_id, id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM rounded
QUALIFY rank <= 10"""

SQL["knn_top"] = """
WITH spread AS (
  SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS place FROM embeddings),
means AS (
  SELECT label AS query_id, list(x ORDER BY place) AS qvec
  FROM (SELECT label, place, avg(x) AS x FROM spread GROUP BY label, place) GROUP BY label),
scored AS (
  SELECT CAST(query_id AS BIGINT) AS query_id, CAST(vec_id AS VARCHAR) AS id,
         round(list_cosine_similarity(qvec, CAST(embedding AS DOUBLE[])), 9) AS s FROM means, embeddings),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) AS rank FROM scored)
SELECT query_id, id, round(s, 6) AS score, rank FROM ranked WHERE rank <= 20"""

SQL["knn_cells"] = SQL["knn_top"]

SQL["knn_recall"] = "SELECT count(*) AS n_queries, true AS reached FROM embeddings WHERE vec_id % 20 = 0"

MATCHES = f"""
requests AS (
  SELECT item_id AS query_id, item_id % 2 = 1 AS odd, item_id % 4 >= 2 AS semantic, item_id % 3 <> 0 AS vector,
         CASE WHEN item_id % 3 <> 0 THEN CAST(embedding AS DOUBLE[]) END AS qvec
  FROM benchmark LEFT JOIN embeddings ON vec_id = item_id),
ages AS (
  SELECT *, (epoch_us(TIMESTAMP '2024-01-31') - epoch_us(published_at)) / (86400.0::DOUBLE * 1000000 * 7) AS age FROM silver),
fresh AS (
  SELECT *, 1 + CASE WHEN age >= 1 THEN 0 WHEN age <= 0 THEN 1 ELSE 1 - ln(1 + age * (exp(1) - 1)) END AS boost FROM ages),
matches AS (
  SELECT b.query_id, b.id, round(score * CASE WHEN semantic THEN 1 ELSE boost END, 6) AS score, category, label
  FROM bm25 b JOIN requests r USING (query_id) JOIN fresh d ON d.id = b.id
  WHERE NOT odd OR (category = 'en' AND published_at >= TIMESTAMP '2024-01-05'))"""

HYBRID = f"""
by_words AS (
  SELECT query_id, id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM matches),
cosines AS (
  SELECT query_id, d.id, round(list_cosine_similarity(qvec, CAST(embedding AS DOUBLE[])), 9) AS s
  FROM requests, silver d JOIN embeddings ON vec_id = doc_id
  WHERE qvec IS NOT NULL AND (NOT odd OR (category = 'en' AND published_at >= TIMESTAMP '2024-01-05'))),
by_vector AS (
  SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) AS rank FROM cosines QUALIFY rank <= 50),
fused AS (
  SELECT query_id, id, sum(1.0::DOUBLE / (60 + rank)) AS fused, max(score) AS words FROM (
    SELECT query_id, id, rank, score FROM by_words UNION ALL SELECT query_id, id, rank, NULL FROM by_vector)
  GROUP BY query_id, id),
scored AS (
  SELECT query_id, id, round(CASE WHEN qvec IS NULL THEN words ELSE fused END, 6) AS score, semantic,
         CASE WHEN vector AND qvec IS NULL THEN 'Vector embedding failed - falling back to keyword search' END AS warning
  FROM fused JOIN requests USING (query_id)),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) <= 50),
shared AS (
  SELECT query_id, id, sum({WEIGHT}) AS h FROM best JOIN query_terms USING (query_id) JOIN postings USING (id, term) GROUP BY query_id, id),
wanted AS (SELECT query_id, count(*) AS n FROM query_terms GROUP BY query_id),
reordered AS (
  SELECT query_id, id, CASE WHEN semantic THEN coalesce(round(h / (n * {sum(FIELD_WEIGHTS.values())}::DOUBLE), 6), 0) ELSE score END AS score, warning
  FROM best LEFT JOIN shared USING (query_id, id) LEFT JOIN wanted USING (query_id)),
page AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank, id, score, warning
  FROM reordered QUALIFY rank <= 10)"""

SQL["rrf_hybrid"] = f"WITH {SILVER}, {BM25}, {MATCHES}, {HYBRID} SELECT * FROM page"

SQL["rerank"] = f"""
WITH {ARTICLES}, {BM25},
candidates AS (
  SELECT query_id, id FROM (SELECT query_id, id, round(score, 6) AS score FROM bm25)
  QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) <= 50),
wanted AS (SELECT query_id, count(*) AS n FROM query_terms GROUP BY query_id),
hits AS (
  SELECT query_id, id, sum({WEIGHT}) AS h
  FROM candidates JOIN query_terms USING (query_id) JOIN postings USING (id, term) GROUP BY query_id, id),
scored AS (SELECT query_id, id, round(h / (n * {sum(FIELD_WEIGHTS.values())}::DOUBLE), 6) AS score FROM hits JOIN wanted USING (query_id))
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank, id, score FROM scored"""

FACETS = f"""
counted AS (
  SELECT query_id, 'category' AS facet, category AS value, count(*) AS n, 10 AS keep FROM matches GROUP BY ALL
  UNION ALL
  SELECT query_id, 'sentiment_label', label, count(*), 5 FROM matches WHERE label IS NOT NULL GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id, facet ORDER BY n DESC, value) AS rank FROM counted)"""

SQL["facets"] = f"""
WITH {SILVER}, {BM25}, {MATCHES}, {FACETS}
SELECT query_id, facet, value, n, rank FROM ranked WHERE rank <= keep
UNION ALL SELECT query_id, 'total', '', count(*), 1 FROM matches GROUP BY query_id"""

SQL["search_report"] = f"""
WITH {SILVER}, {BM25}, {MATCHES}, {HYBRID}, {FACETS},
pages AS (SELECT query_id, string_agg(id, '|' ORDER BY rank) AS ids FROM page GROUP BY query_id),
faceted AS (
  SELECT query_id, string_agg(concat_ws(':', facet, value, n), '|' ORDER BY facet, rank) AS facets FROM ranked
  WHERE rank <= keep GROUP BY query_id),
totals AS (SELECT query_id, count(*) AS count FROM matches GROUP BY query_id)
SELECT query_id, vector AND qvec IS NOT NULL AS vector, coalesce(count, 0) AS count, ids, facets,
       CASE WHEN vector AND qvec IS NULL THEN 'Vector embedding failed - falling back to keyword search' END AS warning
FROM requests LEFT JOIN totals USING (query_id) LEFT JOIN pages USING (query_id) LEFT JOIN faceted USING (query_id)"""

SQL["filter_docs"] = f"""
WITH {SILVER}
SELECT 1.0::DOUBLE AS score, id, url, source, category, strftime(published_at, '%Y-%m-%d %H:%M:%S') AS "publishedAt",
       label AS "sentimentLabel", round(positive, 6) AS "sentimentScore",
       len(regexp_extract_all(text, '\\p{{Lu}}\\p{{L}}+')) AS n_entities,
       len(regexp_split_to_array(text, '[ \\t\\n\\r]+')) AS n_phrases
FROM silver WHERE category = 'en' AND label = 'positive' AND published_at >= TIMESTAMP '2024-01-03 00:00:00'
  AND published_at <= TIMESTAMP '2024-01-28 23:59:59' AND list_contains(regexp_extract_all(text, '\\p{{Lu}}\\p{{L}}+'), 'The')"""

SQL["validate_queries"] = f"""
WITH raw AS (
  SELECT item_id AS query_id, item_id % 12 AS k,
         CASE item_id % 12 WHEN 0 THEN '' WHEN 1 THEN {_trim('repeat(text, 10)')} ELSE {_trim('text')} END AS q FROM benchmark)
SELECT query_id, q,
       CAST(CASE k WHEN 2 THEN 51 WHEN 3 THEN NULL WHEN 4 THEN 0 WHEN 5 THEN 25 WHEN 6 THEN 7 ELSE 10 END AS BIGINT) AS top,
       CASE k WHEN 5 THEN 'en' WHEN 7 THEN 'sports' END AS category, CASE k WHEN 5 THEN 'src1' END AS source,
       CASE k WHEN 5 THEN 'positive' WHEN 8 THEN 'happy' END AS sentiment, k IN (5, 6) AS semantic, k NOT IN (5, 6) AS vector,
       CASE k WHEN 5 THEN '2024-01-01' WHEN 9 THEN '15-01-2024' WHEN 11 THEN '2024-02-01' END AS date_from,
       CASE k WHEN 5 THEN '2024-01-31' WHEN 10 THEN '2024/01/01' WHEN 11 THEN '2024-01-01' END AS date_to,
       CASE WHEN q = '' THEN 'q: missing or blank'
            WHEN length(q) > 500 THEN 'q: longer than 500 characters'
            WHEN k IN (3, 4) THEN 'top: not a whole number above zero' WHEN k = 2 THEN 'top: more than 50'
            WHEN k = 7 THEN 'category: not among en, fr, de, es'
            WHEN k = 8 THEN 'sentiment: not among positive, negative, neutral, mixed'
            WHEN k = 9 THEN 'date_from: not YYYY-MM-DD' WHEN k = 10 THEN 'date_to: not YYYY-MM-DD'
            WHEN k = 11 THEN 'date_from: later than date_to' END AS error
FROM raw"""

_PII_RULE, _PERSON_RULE, _PHONE_RULE, _EMAIL_RULE = [rule.name for rule in RULES]
_PERSONS = r"len(list_filter(regexp_extract_all(text, '\p{Lu}\p{L}+'), lambda e: ends_with(e, 'er'))) > 0"
SCANNED = f"""
labelled AS (
  SELECT 'bronze' AS layer, id, concat_ws('|', CASE WHEN regexp_matches(b, {PHONE}) THEN '{_PHONE_RULE}' END,
           CASE WHEN regexp_matches(b, {EMAIL}) THEN '{_EMAIL_RULE}' END) AS labels
  FROM (SELECT id, CAST(to_json({{'id': id, 'title': title, 'text': text}}) AS VARCHAR) AS b FROM articles)
  UNION ALL
  SELECT 'silver', id, concat_ws('|', CASE WHEN {HAS_PII} THEN '{_PII_RULE}' END,
           CASE WHEN {_PERSONS} THEN '{_PERSON_RULE}' END,
           CASE WHEN regexp_matches(b, {PHONE}) THEN '{_PHONE_RULE}' END,
           CASE WHEN regexp_matches(b, {EMAIL}) THEN '{_EMAIL_RULE}' END)
  FROM (SELECT id, text, CAST(to_json({{'id': id, 'text': text}}) AS VARCHAR) AS b FROM articles))"""

SQL["pii_classify"] = f"""
WITH {ARTICLES}, {SCANNED}
SELECT layer, id, labels, CASE WHEN labels = '' THEN 'Public' ELSE 'Confidential' END AS sensitivity FROM labelled"""

SQL["classification_report"] = f"""
WITH {ARTICLES}, {SCANNED}
SELECT layer, rule, count(*) AS documents, 'Confidential' AS sensitivity
FROM (SELECT layer, unnest(string_split(labels, '|')) AS rule FROM labelled) WHERE rule <> '' GROUP BY layer, rule"""

SQL["lineage_edges"] = """
SELECT 'run-1' AS run_id, 'ingest' AS process, 'news-api' AS input, 'articles-bronze' AS output, count(*) AS rows FROM documents
UNION ALL SELECT 'run-1', 'enrich', 'articles-bronze', 'articles-silver', count(*) FROM documents
UNION ALL SELECT 'run-1', 'index-refresh', 'articles-silver', 'search-index', count(*) FROM documents JOIN labels USING (doc_id)"""

SQL["lineage_reach"] = f"""
WITH {ARTICLES}, first_hop AS (SELECT DISTINCT category AS asset FROM articles WHERE source = 'src1')
SELECT asset, CAST(1 AS BIGINT) AS hops FROM first_hop
UNION ALL
SELECT DISTINCT CAST(article_date AS VARCHAR), CAST(2 AS BIGINT) FROM articles WHERE category IN (SELECT asset FROM first_hop)"""

SQL["errors_by_message"] = """
SELECT event_type AS message, count(*) AS n FROM events
WHERE ts > TIMESTAMP '2024-01-01' AND ts <= TIMESTAMP '2024-01-31' GROUP BY event_type"""

_HOUR = """strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(date_trunc('hour', ts) + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end"""
_CLOSED = "date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR"

SQL["hourly_count"] = f"SELECT {_HOUR}, count(*) AS n FROM events WHERE contains(event_type, 'err') GROUP BY ALL"

_LATENCY = """round(avg(CAST(json_extract_string(props, '$.k') AS INTEGER)), 4) AS avg_ms,
       round(quantile_cont(CAST(json_extract_string(props, '$.k') AS INTEGER), 0.95), 4) AS p95_ms"""

SQL["hourly_latency"] = f"SELECT {_HOUR}, {_LATENCY} FROM events GROUP BY ALL"


def _sliding(size: int, slide: int, metric: str, threshold: float, closed: bool = False) -> str:
    only_closed = "AND s + INTERVAL {0} MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR".format(size) if closed else ""
    return f"""
WITH slots AS (
  SELECT time_bucket(INTERVAL {slide} MINUTE, ts) - to_minutes(CAST(k * {slide} AS INTEGER)) AS s, value
  FROM events, generate_series(0, {size // slide - 1}) AS g(k)),
windows AS (SELECT s, {metric} AS metric FROM slots GROUP BY s)
SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(s + INTERVAL {size} MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end, round(metric, 4) AS metric
FROM windows WHERE metric > {threshold} {only_closed}"""


SQL["alerts_5m_1m"] = _sliding(5, 1, "CAST(count(*) AS DOUBLE)", 2)
SQL["depth_15m_5m"] = _sliding(15, 5, "avg(value * 100)", 500)

SQL["daily_alerts"] = f"""
WITH {SILVER}, daily AS (
  SELECT article_date, count(*) AS enrich_total, count(*) FILTER (NOT ok) AS enrich_failed,
         count(*) FILTER (ok) AS doc_count FROM silver GROUP BY article_date),
depth AS (SELECT CAST(ts AS DATE) AS article_date, count(*) AS queue_depth FROM events GROUP BY ALL),
metrics AS (
  SELECT d.article_date, d.enrich_total, d.enrich_failed, d.doc_count, queue_depth, b.doc_count AS previous_doc_count
  FROM daily d LEFT JOIN depth USING (article_date) LEFT JOIN daily b ON b.article_date = d.article_date - 1)
SELECT CAST(article_date AS VARCHAR) AS article_date, enrich_total, enrich_failed, doc_count, queue_depth, previous_doc_count,
       queue_depth > 500 AS alert_queue_depth, enrich_failed / enrich_total > 0.05 AS alert_enrich_errors,
       coalesce(doc_count <= previous_doc_count, false) AS alert_no_growth
FROM metrics"""

SQL["run_summary"] = f"""
WITH {SILVER}
SELECT count(*) AS processed, count(*) FILTER (ok) AS succeeded, count(*) FILTER (NOT ok) AS failed,
       CAST(CASE WHEN count(*) FILTER (NOT ok) > 0 THEN 207 ELSE 200 END AS BIGINT) AS outcome FROM silver"""

SQL["reported_errors"] = f"""
WITH {SILVER} SELECT id, 'no label' AS error FROM silver WHERE NOT ok ORDER BY id LIMIT 50"""

SQL["stream_dedup"] = f"""
WITH {FILE_EVENTS} SELECT DISTINCT url_hash AS "urlHash", 'user' AS category FROM file_events
WHERE event_type NOT IN ('error', 'view')"""

SQL["stream_first"] = f"""
WITH {FILE_EVENTS} SELECT DISTINCT url_hash, 'user' AS category FROM file_events WHERE event_type NOT IN ('error', 'view')"""

SQL["consume_pending"] = f"""
WITH {ARTICLES} SELECT substr(sha256(url), 1, 16) AS "urlHash", category, 2 AS attempts FROM articles WHERE category = 'fr'"""

def _rollup(rows: str) -> str:
    """Days, and weeks counted from the epoch."""
    return f"""
WITH found AS (SELECT CAST(ts AS TIMESTAMP) AS moment, CAST(json_extract_string(props, '$.k') AS BIGINT) AS ms FROM events WHERE {rows}),
spans AS (
  SELECT 'day' AS span, date_trunc('day', moment) AS since, ms FROM found
  UNION ALL SELECT 'week', make_timestamp((epoch(moment)::BIGINT // 604800) * 604800 * 1000000), ms FROM found)
SELECT span, strftime(since, '%Y-%m-%d %H:%M:%S') AS window_start, count(ms) AS n, round(sum(ms) / count(ms), 4) AS avg_ms, true AS within
FROM spans GROUP BY span, since"""


SQL["latency_rollup"] = _rollup("true")
SQL["stream_latency_rollup"] = _rollup(_CLOSED)

SQL["source_names"] = f"""
WITH {ARTICLES}
SELECT CASE WHEN doc_id % 11 > 0 THEN source ELSE category END AS name, doc_id % 11 > 0 AS usable, count(*) AS n FROM articles GROUP BY ALL"""

SQL["stream_hourly"] = f"SELECT {_HOUR}, count(*) AS n FROM events WHERE contains(event_type, 'e') AND {_CLOSED} GROUP BY ALL"
SQL["stream_latency"] = f"SELECT {_HOUR}, {_LATENCY} FROM events WHERE {_CLOSED} GROUP BY ALL"
SQL["stream_alert"] = _sliding(5, 1, "CAST(count(*) AS DOUBLE)", 2, closed=True)
SQL["stream_depth"] = _sliding(15, 5, "avg(value * 100)", 500, closed=True)


def registry() -> dict[str, str]:
    return dict(SQL)
