"""DuckDB SQL for the registered queries, written on its own and not from the plans."""

from __future__ import annotations

from ..functions.language import COMMON
from ..vocabulary import (
    CATEGORIES, COMPANY_TEMPLATES, ENTITY_TYPES, FOLLOWUP_COMPANY_TEMPLATES, FOLLOWUP_LOCATION_TEMPLATES, GENERAL_QUERIES, LEGAL_FORMS, LOCATION_TEMPLATES, PAGE_CLAIM_STATUSES, SITE_TERMS, TRACKING_PARAMETERS,
)

ORACLE: dict[str, str] = {}


def _quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _rows(values: list[str]) -> str:
    return ", ".join(f"({k}, '{v}')" for k, v in enumerate(values))


_FOLD = "replace(translate(lower({0}), 'µſς', 'μsσ'), 'ß', 'ss')"
_HASH = "sha1(" + _FOLD.format(r"trim(regexp_replace(text, '\s+', ' ', 'g'), ' ')") + ")"

# A url's parts, and its canonical form, for urls with a scheme and no escapes.
_URL = f"""
u0 AS (SELECT page_id, url, html, regexp_extract(url, '^([a-z]+)://([^/?#]*)([^?#]*)(?:\\?([^#]*))?', ['scheme', 'host', 'path', 'query']) AS p FROM pages),
u1 AS (
  SELECT *, list_sort(list_distinct(list_transform(list_filter(string_split(p.query, '&'), lambda x: x <> '' AND NOT list_contains([{_quoted(TRACKING_PARAMETERS)}], lower(split_part(x, '=', 1)))),
    lambda x: {{'k': split_part(x, '=', 1), 'v': split_part(x, '=', 2)}}))) AS q FROM u0
),
u AS (
  SELECT page_id, url, split_part(lower(p.host), ':', 1) AS host, array_to_string(string_split(split_part(lower(p.host), ':', 1), '.')[-2:], '.') AS domain, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
    (CASE p.scheme WHEN 'http' THEN 'https' ELSE p.scheme END) || '://' || regexp_replace(lower(p.host), ':(443|80)$', '') || rtrim(p.path, '/')
      || CASE WHEN len(q) > 0 THEN '?' || array_to_string(list_transform(q, lambda x: x.k || '=' || x.v), '&') ELSE '' END AS normalized_url
  FROM u1
)"""
_PRIORITY = "CASE WHEN contains(host, 'blog.') THEN 'skip' WHEN contains(host, '.org') THEN 'high' WHEN contains(host, 'm.') THEN 'medium' WHEN contains(host, '.net') THEN 'low' ELSE 'medium' END"
_RANK = "CASE priority WHEN 'high' THEN 0 WHEN 'medium' THEN 1 WHEN 'low' THEN 2 WHEN 'skip' THEN 3 ELSE 1 END"
_SUMMARY = f"""
summary AS (
  SELECT domain, count(*) AS url_count, arg_min({_PRIORITY}, page_id) AS priority, min(page_id) AS first,
    coalesce(array_to_string((list(title ORDER BY page_id) FILTER (title <> ''))[1:3], ' | '), '') AS sample_titles
  FROM u WHERE domain <> '' GROUP BY 1
)"""

ORACLE["url_normalize"] = f"WITH {_URL} SELECT page_id, normalized_url FROM u"
ORACLE["url_recompute_changed"] = f"WITH {_URL} SELECT count(*) AS n_rows, count(*) FILTER (page_id % 2 = 0 AND normalized_url <> url OR page_id % 3 = 0 AND domain <> '') AS n_changed, count(DISTINCT normalized_url) AS n_urls FROM u"
ORACLE["url_dedupe_label"] = f"WITH {_URL} SELECT page_id, normalized_url, CASE WHEN row_number() OVER (PARTITION BY normalized_url ORDER BY page_id) = 1 THEN 'new' ELSE 'duplicate' END AS status FROM u"
ORACLE["url_host_counts"] = f"WITH {_URL} SELECT host AS value, count(*) AS n FROM u GROUP BY 1"
ORACLE["domain_registered"] = f"WITH {_URL} SELECT domain, count(*)::BIGINT AS n FROM u GROUP BY 1"
ORACLE["url_priority"] = f"WITH {_URL} SELECT page_id, domain, priority, {_RANK} AS rank FROM (SELECT *, {_PRIORITY} AS priority FROM u)"
ORACLE["priority_counts"] = f"WITH {_URL} SELECT {_PRIORITY} AS value, count(*) AS n FROM u GROUP BY 1"
ORACLE["domain_summary"] = f"WITH {_URL}, {_SUMMARY} SELECT domain, url_count, priority, sample_titles FROM summary"
ORACLE["priority_url_sums"] = f"WITH {_URL}, {_SUMMARY} SELECT priority, sum(url_count)::BIGINT AS urls, count(*) AS domains FROM summary GROUP BY 1"
ORACLE["content_hash_dups"] = f"SELECT doc_id, content_hash, CASE WHEN row_number() OVER (PARTITION BY content_hash ORDER BY doc_id) = 1 THEN 'new' ELSE 'duplicate' END AS status FROM (SELECT doc_id, {_HASH} AS content_hash FROM documents)"
ORACLE["distinct_first"] = f"SELECT min(doc_id) AS doc_id, arg_min(source, doc_id) AS source, content_hash FROM (SELECT doc_id, source, {_HASH} AS content_hash FROM documents) GROUP BY content_hash"

_WORDS = r"CASE WHEN trim(regexp_replace(text, '\s+', ' ', 'g'), ' ') = '' THEN 0 ELSE len(string_split(trim(regexp_replace(text, '\s+', ' ', 'g'), ' '), ' ')) END"
_CRAWLED = f"""c AS (
  SELECT doc_id, source AS domain, CASE quality WHEN 1 THEN 'success' ELSE 'failed' END AS crawl_status, lang AS language, toxic, ({_WORDS})::BIGINT AS word_count, length(text) AS char_count
  FROM documents JOIN labels USING (doc_id)
)"""
ORACLE["crawl_status_report"] = f"""WITH {_CRAWLED}
SELECT 'status' AS part, crawl_status AS value, count(*) AS n FROM c GROUP BY 2 UNION ALL SELECT 'language', language, count(*) FROM c WHERE crawl_status = 'success' GROUP BY 2
UNION ALL SELECT 'failed_domain', domain, count(*) FROM c WHERE crawl_status = 'failed' GROUP BY 2 UNION ALL SELECT 'duplicates', '', count(*) FILTER (toxic = 1) FROM c"""
ORACLE["lang_top10"] = f"WITH {_CRAWLED} SELECT language AS value, count(*) AS n FROM c WHERE crawl_status = 'success' GROUP BY 1 ORDER BY n DESC, min(doc_id) LIMIT 10"
ORACLE["failed_domains_top10"] = f"WITH {_CRAWLED} SELECT domain AS value, count(*) AS n FROM c WHERE crawl_status = 'failed' GROUP BY 1 ORDER BY n DESC, min(doc_id) LIMIT 10"
ORACLE["value_counts"] = "SELECT source AS value, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY 1"
ORACLE["status_pivot"] = "SELECT user_id % 10 AS bucket, " + ", ".join(f"count(*) FILTER (event_type = '{t}') AS {t}" for t in ("view", "click", "signup", "error", "purchase")) + " FROM events GROUP BY 1"
ORACLE["describe_lengths"] = f"WITH {_CRAWLED} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS n, avg({c}) AS mean, stddev_samp({c}) AS std, min({c})::DOUBLE AS min, quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50, quantile_cont({c}, 0.75) AS q75, max({c})::DOUBLE AS max FROM c" for c in ("word_count", "char_count")
)
ORACLE["success_columns"] = f"WITH {_CRAWLED} SELECT doc_id AS _ord, domain, language, char_count FROM c WHERE crawl_status = 'success' AND word_count >= 20"

ORACLE["query_expand"] = f"""WITH {_URL},
domains AS (SELECT host AS domain, min(page_id) AS seed FROM u GROUP BY 1),
companies AS (SELECT p_name AS company, min(p_partkey) AS seed FROM part GROUP BY 1),
every AS (
  SELECT 0 AS branch, t::BIGINT AS seed, 0 AS t, q AS query, 'general' AS source_type FROM (VALUES {_rows(GENERAL_QUERIES)}) g(t, q)
  UNION ALL SELECT 1, s_suppkey, 0, s_name, CASE WHEN s_suppkey % 2 = 0 THEN 'general' ELSE 'seed' END FROM supplier WHERE s_suppkey % 7 <> 0
  UNION ALL SELECT 2, seed, t, 'site:' || domain || ' ' || q, 'site' FROM domains, (VALUES {_rows(SITE_TERMS)}) g(t, q) WHERE seed % 2 = 0
  UNION ALL SELECT 3, n_nationkey, t, replace(q, '{{location}}', n_name), 'location' FROM nation, (VALUES {_rows(LOCATION_TEMPLATES)}) g(t, q)
  UNION ALL SELECT 4, seed, t, replace(q, '{{company}}', company), 'company' FROM companies, (VALUES {_rows(COMPANY_TEMPLATES)}) g(t, q)
)
SELECT branch, seed, t, query, source_type FROM every QUALIFY row_number() OVER (PARTITION BY lower(query) ORDER BY branch, seed, t) = 1"""


def _queries(low: int, high: int) -> str:
    return f"(SELECT p_partkey AS n, p_brand || ' ' || CASE WHEN p_partkey % 3 = 0 THEN upper(p_name) ELSE p_name END AS query, p_type AS source_type FROM part WHERE p_size >= {low} AND p_size < {high})"


ORACLE["query_upsert"] = f"""WITH old AS (SELECT *, lower(query) AS key FROM {_queries(0, 25)}),
kept AS (SELECT 0 AS part, min(n) AS n, arg_max(query, n) AS query, arg_max(source_type, n) AS source_type, '0' AS iteration, 'done' AS status FROM old GROUP BY key),
fresh AS (SELECT *, lower(query) AS key FROM {_queries(15, 60)} WHERE lower(query) NOT IN (SELECT key FROM old) QUALIFY row_number() OVER (PARTITION BY lower(query) ORDER BY n) = 1)
SELECT * FROM kept UNION ALL SELECT 1, n, query, source_type, '0', 'new' FROM fresh"""
ORACLE["query_followup"] = f"""WITH e AS (SELECT p_partkey AS entity, p_name, CASE WHEN p_size > 10 THEN 'company' ELSE 'location' END AS source_type FROM part),
t(kind, t, q) AS (VALUES {", ".join(f"('company', {k}, '{v}')" for k, v in enumerate(FOLLOWUP_COMPANY_TEMPLATES))}, {", ".join(f"('location', {k}, '{v}')" for k, v in enumerate(FOLLOWUP_LOCATION_TEMPLATES))}),
f AS (SELECT entity, t, replace(replace(q, '{{company}}', p_name), '{{location}}', p_name) AS query, source_type FROM e JOIN t ON kind = source_type)
SELECT entity, t, query, 'expansion_' || source_type AS source_type FROM f QUALIFY row_number() OVER (PARTITION BY lower(query) ORDER BY entity, t) = 1"""
ORACLE["query_merge_cap"] = f"""WITH f AS (SELECT * FROM {_queries(0, 60)} WHERE lower(query) NOT IN (SELECT lower(query) FROM {_queries(0, 5)}) QUALIFY row_number() OVER (PARTITION BY lower(query) ORDER BY n) = 1)
SELECT row_number() OVER (ORDER BY n) AS n, query, source_type, '1' AS iteration FROM (SELECT * FROM f ORDER BY n LIMIT 100)"""
ORACLE["query_known_keys"] = f"""WITH a AS (SELECT DISTINCT lower(query) AS key FROM {_queries(0, 25)}), b AS (SELECT DISTINCT lower(query) AS key FROM {_queries(15, 60)})
SELECT key, 'both' AS part FROM (SELECT * FROM a INTERSECT SELECT * FROM b) UNION ALL SELECT key, 'first' FROM (SELECT * FROM a EXCEPT SELECT * FROM b)"""
ORACLE["search_mock_candidates"] = f"""WITH q AS (SELECT * FROM {_queries(0, 60)}), kinds AS (SELECT query, arg_min(source_type, n) AS source_type FROM q GROUP BY 1)
SELECT 'https://r' || k || '.example.com/' AS url, 'Result ' || k AS title, k::VARCHAR AS snippet, q.query AS query_used, 'mock' AS search_engine, (k + 1)::VARCHAR AS rank, kinds.source_type, 'new' AS status
FROM q JOIN kinds USING (query), (VALUES (0), (1), (3), (4)) r(k)"""


def _made(without: str = "") -> str:
    return f"""(SELECT page_id, normalized_url, priority, CASE priority WHEN 'high' THEN 'queued' WHEN 'medium' THEN 'queued' WHEN 'low' THEN 'needs_review' WHEN 'skip' THEN 'rejected' ELSE 'needs_review' END AS status
FROM (SELECT page_id, normalized_url, CASE WHEN page_id % 7 = 0 THEN '' ELSE {_PRIORITY} END AS priority FROM u) WHERE NOT contains(normalized_url, '{without or '|'}'))"""


def _old(without: str = "") -> str:
    return f"(SELECT page_id, normalized_url, priority, CASE WHEN page_id % 3 = 0 THEN 'failed' ELSE 'crawled' END AS status, page_id % 5 AS retry_count FROM {_made(without)} QUALIFY row_number() OVER (PARTITION BY normalized_url ORDER BY page_id) = 1)"


ORACLE["frontier_build"] = f"WITH {_URL} SELECT page_id, normalized_url, priority, status, 'seed' AS discovered_from, 0 AS retry_count FROM {_made()}"
ORACLE["frontier_upsert"] = f"""WITH {_URL}, a AS (SELECT * FROM {_old("/fr/")}), b AS (SELECT * FROM {_made("/de/")} QUALIFY row_number() OVER (PARTITION BY normalized_url ORDER BY page_id) = 1)
SELECT coalesce(a.normalized_url, b.normalized_url) AS normalized_url, coalesce(b.priority, a.priority) AS priority, coalesce(a.status, b.status) AS status, coalesce(a.retry_count, 0) AS retry_count, a.normalized_url IS NULL AS inserted
FROM a FULL JOIN b ON a.normalized_url = b.normalized_url"""
ORACLE["frontier_upsert_bucketed"] = ORACLE["frontier_upsert"]
ORACLE["model_answers"] = """WITH d AS (SELECT *, doc_id % 6 AS k, sha256(coalesce(text, '')) AS whole, sha256('') AS nothing FROM documents)
SELECT doc_id, 0::BIGINT AS place, NULL AS reason, coalesce(source, '') AS entity_name, coalesce(n_chars::VARCHAR, '') AS details, whole AS overview, coalesce(lang, '') AS key_facts,
  coalesce(source, '') || '/7' AS facilities, 1.0::DOUBLE AS confidence_score FROM d WHERE k IN (0, 5)
UNION ALL SELECT doc_id, 0, NULL, doc_id::VARCHAR, '', whole, concat_ws(';', lang, source), 'x/', 0 FROM d WHERE k = 1
UNION ALL SELECT doc_id, 1, 'record_not_an_object', '', '', nothing, '', '', 0 FROM d WHERE k = 1
UNION ALL SELECT doc_id, NULL, CASE k WHEN 2 THEN 'malformed_json' ELSE 'records_not_a_list' END, '', '', nothing, '', '', 0 FROM d WHERE k IN (2, 4)"""
_REQUEUED = f"SELECT *, status = 'failed' AND retry_count < 3 AS requeued FROM {_old()}"
ORACLE["frontier_requeue"] = f"WITH {_URL} SELECT normalized_url, CASE WHEN requeued THEN 'queued' ELSE status END AS status, retry_count + requeued::INT AS retry_count, requeued FROM ({_REQUEUED})"
ORACLE["frontier_counts"] = f"WITH {_URL} SELECT status, count(*) AS n FROM {_made()} GROUP BY 1"
ORACLE["frontier_next_batch"] = f"WITH {_URL} SELECT page_id AS frontier_id, normalized_url, priority FROM ({_REQUEUED}) WHERE requeued AND priority IN ('high', 'medium') ORDER BY page_id LIMIT 1000"

_FOLDED = lambda c: _FOLD.format(rf"trim(regexp_replace(coalesce({c}, ''), '\s+', ' ', 'g'), ' ')")
_RECORDS = f"""lines AS (SELECT doc_id, source, n_chars, string_split(text, chr(10)) AS claims FROM documents),
claims AS (SELECT doc_id, source, n_chars, unnest(claims) AS claim, unnest(range(len(claims))) AS line FROM lines),
about AS (
  SELECT *, doc_id AS about FROM claims WHERE doc_id % 3 IN (1, 2)
  UNION ALL SELECT *, doc_id + 1 FROM claims WHERE doc_id % 3 = 2
),
r AS (
  SELECT (a.about * 2 + a.about - a.doc_id) * 1000000 + a.line AS _ord, printf('page_%06d', a.about) AS page_id,
    'https://' || a.source || '.example.com/' AS source_url, split_part(a.claim, ' ', 1) AS entity_name,
    CASE WHEN (a.doc_id + a.line) % 7 = 3 THEN '' ELSE a.claim END AS evidence_text,
    [{_quoted([*ENTITY_TYPES, "not_a_type"])}][(a.doc_id + a.line) % 14 + 1] AS entity_type,
    CASE WHEN (a.doc_id + a.line) % 7 = 5 THEN 'no_category' ELSE 'logistics' END AS category,
    CASE WHEN (a.doc_id + a.line) % 7 = 6 THEN 'cancelled' ELSE 'announced' END AS claim_status,
    greatest(0.0, least(1.0, a.n_chars / 1000))::DOUBLE AS score, coalesce(d.text, '') AS text, a.claim AS fact
  FROM about a LEFT JOIN documents d ON d.doc_id = a.about
),
g AS (SELECT *, {_FOLDED("evidence_text")} <> '' AND {_FOLDED("text")} <> '' AND contains({_FOLDED("text")}, {_FOLDED("evidence_text")}) AS is_grounded FROM r),
v AS (
  SELECT *, list_filter([
    CASE WHEN trim(entity_name) = '' THEN 'missing_entity_name' END, CASE WHEN trim(evidence_text) = '' THEN 'missing_evidence' END, CASE WHEN entity_type NOT IN ({_quoted(ENTITY_TYPES)}) THEN 'invalid_entity_type' END,
    CASE WHEN category NOT IN ({_quoted(CATEGORIES)}) THEN 'invalid_category' END, CASE WHEN claim_status NOT IN ({_quoted(PAGE_CLAIM_STATUSES)}) THEN 'invalid_claim_status' END, CASE WHEN score < 0.3 THEN 'low_confidence' END,
    CASE WHEN trim(evidence_text) <> '' AND NOT is_grounded THEN 'unsupported_claim' END], lambda x: x IS NOT NULL) AS reasons
  FROM g
)"""
ORACLE["grounding_exact"] = f"WITH {_RECORDS} SELECT page_id, _ord, is_grounded FROM g"
ORACLE["fact_dedupe"] = f"""WITH {_RECORDS}
SELECT page_id, _ord, CASE WHEN k > 1 THEN 'failed' ELSE '' END AS validation_status, CASE WHEN k > 1 THEN 'duplicate_record' ELSE '' END AS reasons
FROM (SELECT page_id, _ord, row_number() OVER (PARTITION BY source_url, {_FOLD.format("trim(entity_name)")}, {_FOLDED("evidence_text")} ORDER BY _ord) AS k FROM r)"""
ORACLE["record_validate_reasons_exact"] = f"WITH {_RECORDS} SELECT page_id, _ord, CASE WHEN len(reasons) = 0 THEN 'passed' ELSE 'failed' END AS validation_status, array_to_string(reasons, ';') AS reasons, round(least(score, 0.95), 6) AS confidence FROM v"
ORACLE["reasons_explode_counts_exact"] = f"WITH {_RECORDS} SELECT value, count(*) AS n FROM (SELECT unnest(reasons) AS value FROM v) GROUP BY 1"
ORACLE["validation_totals_exact"] = f"WITH {_RECORDS} SELECT count(*) FILTER (len(reasons) = 0) AS passed, count(*) FILTER (len(reasons) > 0) AS failed, count(*) AS records FROM v"
ORACLE["wiki_id"] = f"WITH {_RECORDS} SELECT page_id, _ord, substr(sha256(source_url || chr(1) || entity_name || chr(1) || evidence_text), 1, 16) AS wiki_id FROM r"
ORACLE["bag_union_exact"] = f"""WITH {_RECORDS} SELECT page_id, count(*) + count(*) FILTER (len(reasons) > 0) AS n, CASE WHEN bool_or(len(reasons) > 0) THEN 'failed' END AS status
FROM v GROUP BY page_id"""
ORACLE["entity_profiles"] = f"""WITH {_RECORDS}
SELECT lower(entity_name) AS canonical_name, array_to_string(list_sort(list(DISTINCT entity_name)), ';') AS aliases, arg_min(entity_type, _ord) AS entity_type,
  count(DISTINCT {{'u': source_url, 'e': evidence_text}}) AS n_sources, count(DISTINCT fact) AS n_facts FROM r GROUP BY 1"""
ORACLE["markdown_round_trip"] = f"WITH {_RECORDS} SELECT page_id, entity_name AS title, entity_type, 1::BIGINT AS n_facts, evidence_text AS fact FROM r"

_URLS = "'https://c.example.com/' || conv_id || '/' || turn"
_ENTITIES = f"""e AS (
  SELECT conv_id, 'Entity ' || conv_id AS canonical_name, list({{'turn': turn, 'url': {_URLS}, 'role': role, 'text': text}} ORDER BY turn) AS sources, arg_min(text, turn) AS overview, conv_id % 2 = 0 AS even,
    CASE WHEN conv_id % 3 = 0 THEN '2020' ELSE '' END AS span FROM conversations GROUP BY conv_id
)"""
ORACLE["sources_explode"] = f"SELECT 'Entity ' || conv_id AS canonical_name, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS place, {_URLS} AS source_url, role AS source_title, 'c.example.com' AS source_domain, text AS evidence_text, 'announced' AS claim_status FROM conversations"
ORACLE["sources_rollup"] = f"WITH {_ENTITIES} SELECT canonical_name, CASE WHEN even THEN len(sources) ELSE 9 END AS source_count, array_to_string(list_filter(list_transform(sources, lambda s: s.url), lambda u: ends_with(u, '1')), ', ') AS urls FROM e"
ORACLE["final_wiki_rows"] = f"""WITH {_ENTITIES} SELECT canonical_name, overview, CASE WHEN even THEN len(sources) ELSE 9 END AS source_count, CASE WHEN even THEN '["Bryan County","Jackson County"]' ELSE '[]' END AS locations, '[]' AS aliases,
  CASE WHEN even THEN 'stale' ELSE 'fresh' END AS currency, len(sources) AS n_sources FROM e"""
_ENDING = "CASE WHEN span <> '' AND even THEN ' (as of 2020; currency: stale)' WHEN span <> '' THEN ' (as of 2020)' WHEN even THEN ' (currency: stale)' ELSE '' END || ' Source: ' || sources[1].url"
ORACLE["finetune_examples"] = rf"""WITH {_ENTITIES}, x AS (SELECT *, regexp_replace(overview, '^\s+|\s+$', '', 'g') AS o, {_ENDING} AS ending FROM e)
SELECT conv_id, 0 AS k, 'What does ' || canonical_name || ' do in Georgia''s EV supply chain?' AS instruction, o || ending AS output FROM x WHERE o <> ''
UNION ALL SELECT conv_id, 1, 'Where does ' || canonical_name || ' operate in Georgia?', canonical_name || ' operates in Bryan County, Jackson County based on the sources.' || ending FROM x WHERE o <> '' AND even"""
ORACLE["wiki_listing"] = f"WITH {_ENTITIES} SELECT canonical_name, '- [[entity-' || conv_id || '|' || canonical_name || ']]' || CASE WHEN even THEN ' _(Bryan County)_' ELSE '' END || ' — ' || split_part(overview, '.', 1) AS line FROM e"
ORACLE["wiki_pages"] = f"""WITH {_ENTITIES},
w AS (
  SELECT canonical_name AS name, conv_id, overview, len(sources) AS f, '[[entity-' || conv_id || '|' || canonical_name || ']]' AS link,
    CASE conv_id % 3 WHEN 0 THEN 'logistics' WHEN 1 THEN 'battery-materials' ELSE 'unknown' END AS page, CASE conv_id % 3 WHEN 0 THEN 'Logistics' WHEN 1 THEN 'Battery Materials' ELSE 'Unknown' END AS kind,
    CASE conv_id % 4 WHEN 0 THEN 'Bryan County' WHEN 2 THEN 'Jackson County' END AS county FROM e
),
concepts AS (SELECT page, kind, count(*) AS n, sum(f) AS f FROM w GROUP BY ALL),
counties AS (SELECT county, 'county-' || lower(replace(county, ' ', '-')) AS page, count(*) AS n FROM w WHERE county IS NOT NULL GROUP BY ALL),
urls AS (SELECT count(DISTINCT s.url) AS sources FROM (SELECT unnest(sources) AS s FROM e))
SELECT 'index.md' AS file_name, 0 AS part, '' AS name, '*Auto-generated catalog. ' || count(*) || ' entities · ' || sum(f) || ' facilities · ' || any_value(sources) || ' unique sources.*' AS line FROM w, urls
UNION ALL SELECT 'index.md', 1, kind, '- [[' || page || '|' || kind || ']] — ' || n || ' entities' FROM concepts
UNION ALL SELECT 'index.md', 2, county, '- [[' || page || '|' || county || ']] — ' || n || ' entities' FROM counties
UNION ALL SELECT 'index.md', 3, name, '- ' || link || ' — ' || kind FROM w
UNION ALL SELECT 'concepts/' || page || '.md', 0, '', 'Supply-chain segment covering **' || n || ' entities** and **' || f || ' facilities** in the Georgia EV corpus.' FROM concepts
UNION ALL SELECT 'concepts/' || page || '.md', 1, name, '- ' || link || CASE WHEN county IS NULL THEN '' ELSE ' _(' || county || ')_' END || ' — ' || split_part(overview, '.', 1) FROM w
UNION ALL SELECT 'geography/' || page || '.md', 0, '', 'Georgia county with **' || n || ' EV supply-chain entities** in the corpus.' FROM counties
UNION ALL SELECT 'geography/county-' || lower(replace(county, ' ', '-')) || '.md', 1, name, '- ' || link || ' — ' || kind FROM w WHERE county IS NOT NULL"""
ORACLE["entity_demotion"] = f"""WITH {_ENTITIES}, s AS (SELECT canonical_name, unnest(sources) AS s FROM e),
t AS (SELECT canonical_name, s.turn AS turn, s.url AS url, s.role = 'user' AND {_FOLDED("s.text")} <> '' AS ok FROM s)
SELECT canonical_name, bool_or(ok) AS kept, coalesce('Ungrounded sources: ' || string_agg(url, ', ' ORDER BY turn) FILTER (NOT ok), '') AS notes, count(*)::INT AS n_sources FROM t GROUP BY 1"""

ORACLE["currency_bucket"] = """WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 1 THEN date_trunc('month', o_orderdate)::DATE WHEN o_orderkey % 10 > 1 THEN o_orderdate::DATE END AS d FROM orders),
a AS (SELECT *, (2001 - year(d)) * 12 + 8 - month(d) - (day(d) > 1)::INT AS age FROM o)
SELECT o_orderkey, CASE WHEN d IS NULL THEN 'undated' WHEN age < 12 THEN 'fresh' WHEN age < 24 THEN 'aging' ELSE 'stale' END AS currency, CASE WHEN d IS NULL THEN 'none' WHEN o_orderkey % 10 = 1 THEN 'month' ELSE 'day' END AS precision FROM a"""
ORACLE["confidence_clamp"] = "SELECT event_id, round(CASE WHEN event_id % 11 = 0 OR event_id % 13 = 0 OR event_id % 17 = 0 THEN 0 ELSE greatest(0, least(1, value / 40)) END, 9) AS confidence FROM events"
ORACLE["event_keys"] = "SELECT event_type, sum((props->>'$.k')::BIGINT)::BIGINT AS k_sum, count(*) AS n FROM events GROUP BY 1"
ORACLE["page_id_format"] = "SELECT doc_id, printf('page_%06d', doc_id) AS page_id, printf('page_%06d', doc_id + 123456789) AS long_id FROM documents"
ORACLE["text_metrics"] = f"""SELECT doc_id, ({_WORDS})::BIGINT AS words, length(text) AS chars,
  regexp_replace(left(regexp_replace(regexp_replace(lower(text), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 60), '-+$', '') AS slug FROM documents"""
ORACLE["name_normalize"] = f"""SELECT p_partkey, regexp_replace(trim(regexp_replace(lower(p_name || CASE p_partkey % 3 WHEN 0 THEN ', Inc.' WHEN 1 THEN ' LLC' ELSE '' END), '[^a-z0-9]+', ' ', 'g')), '( ({"|".join(LEGAL_FORMS)}))+$', '') AS name FROM part"""


def _clusters(names: str) -> str:
    """CTEs scored (a, b, score) and clusters (name, cluster) of a table of name and ord: every two names, by the rows of their subsequence table one after the other."""
    return f"""n AS (SELECT name, min(ord) AS ord, array_to_string(list_sort(list_filter(string_split(name, ' '), lambda x: x <> '')), ' ') AS s FROM {names} GROUP BY name),
pairs AS (SELECT a.name AS a, b.name AS b, a.s AS s, b.s AS t FROM n a JOIN n b ON a.name < b.name WHERE a.s <> '' AND b.s <> '' AND 40 * length(a.s) <= 60 * length(b.s) AND 40 * length(b.s) <= 60 * length(a.s)),
dp(a, b, s, t, i, line) AS (
  SELECT a, b, s, t, 0, list_transform(range(length(t) + 1), lambda x: 0) FROM pairs
  UNION ALL SELECT a, b, s, t, i + 1, list_transform(range(1, len(line) + 1), lambda j: list_max(list_transform(range(1, j + 1), lambda k: greatest(line[k], CASE WHEN k > 1 AND t[k - 1] = s[i + 1] THEN line[k - 1] + 1 ELSE 0 END))))
  FROM dp WHERE i < length(s)
),
scored AS MATERIALIZED (SELECT a, b, 200 * line[-1] / (length(s) + length(t)) AS score FROM dp WHERE i = length(s)),
marks AS MATERIALIZED (SELECT name, arg_min(location, ord) FILTER (location <> '') AS mark FROM {names} GROUP BY name),
merge_order AS MATERIALIZED (SELECT a, b, row_number() OVER (ORDER BY score DESC, md5(a || chr(1) || b)) AS i FROM scored WHERE score >= 90),
merging(i, nodes) AS (
  SELECT 0::BIGINT, (SELECT list(struct_pack(n := name, c := name, m := mark) ORDER BY name) FROM marks)
  UNION ALL SELECT i + 1, CASE WHEN x.c = y.c OR coalesce(x.m <> y.m, false) THEN nodes
    ELSE list_transform(nodes, lambda v: CASE WHEN v.c IN (x.c, y.c) THEN struct_pack(n := v.n, c := least(x.c, y.c), m := coalesce(x.m, y.m)) ELSE v END) END
  FROM (SELECT g.i, g.nodes, list_filter(g.nodes, lambda v: v.n = e.a)[1] AS x, list_filter(g.nodes, lambda v: v.n = e.b)[1] AS y FROM merging g JOIN merge_order e ON e.i = g.i + 1)
),
rooted AS (SELECT v.n AS name, v.c AS root FROM (SELECT unnest(nodes) AS v FROM (SELECT nodes FROM merging ORDER BY i DESC LIMIT 1))),
clusters AS (SELECT name, arg_min(name, ord) OVER (PARTITION BY root) AS cluster FROM rooted JOIN n USING (name))"""


_PART_NAMES = f"""p AS (SELECT p_partkey AS ord, regexp_replace(trim(regexp_replace(lower(p_name || CASE WHEN p_partkey % 5 = 0 THEN 's' ELSE '' END), '[^a-z0-9]+', ' ', 'g')), '( ({"|".join(LEGAL_FORMS)}))+$', '') AS name,
  CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_brand END AS location FROM part)"""
ORACLE["name_cluster"] = f"WITH RECURSIVE {_PART_NAMES}, {_clusters('p')} SELECT name, cluster FROM clusters"
ORACLE["name_review_pairs"] = f"""WITH RECURSIVE {_PART_NAMES}, {_clusters('p')} SELECT a, b, round(score, 6) AS score
FROM scored JOIN clusters x ON x.name = a JOIN clusters y ON y.name = b WHERE score >= 80 AND x.cluster <> y.cluster"""
ORACLE["entity_profiles_clustered"] = f"""WITH RECURSIVE {_RECORDS},
q AS (SELECT *, split_part(split_part(source_url, '/', 3), '.', 1) || CASE WHEN _ord % 2 = 0 THEN ' battery plant' ELSE ' battery plants' END AS plant FROM r),
p AS (SELECT plant AS name, _ord AS ord, CASE WHEN contains(plant, '7') THEN '' ELSE substr(plant, 1, 4) END AS location FROM q), {_clusters('p')}
SELECT cluster AS canonical_name, array_to_string(list_sort(list(DISTINCT plant)), ';') AS aliases, arg_min(entity_type, _ord) AS entity_type,
  count(DISTINCT {{'u': source_url, 'e': evidence_text}}) AS n_sources, count(DISTINCT fact) AS n_facts FROM q JOIN clusters ON plant = name GROUP BY 1"""
ORACLE["name_aliases"] = "SELECT p_partkey, CASE WHEN p_name IN ('red widget', 'blue widget') THEN 'widget works' ELSE p_name END AS canonical_name FROM part"
ORACLE["rollup_counts"] = "SELECT p_type AS category, p_brand AS county, count(*) AS entities, sum(p_size % 4)::BIGINT AS facilities, count(DISTINCT p_name) AS sources FROM part GROUP BY ROLLUP (p_type, p_brand)"
ORACLE["shard_sizes"] = "SELECT (('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % 16)::INT AS shard, count(*) AS n FROM documents GROUP BY 1"
ORACLE["half_sizes"] = "SELECT CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'a' ELSE 'b' END AS half, count(*) AS n FROM documents GROUP BY 1"
ORACLE["related_organizations"] = """WITH s AS (SELECT s_nationkey, string_agg(s_name, ';' ORDER BY s_name) AS own FROM supplier WHERE s_suppkey % 10 = 0 GROUP BY 1)
SELECT c_custkey, c_name AS entity_name, 'Acme' || coalesce(';' || own, '') AS organizations FROM customer LEFT JOIN s ON c_nationkey = s_nationkey"""
ORACLE["dated_records"] = """WITH d AS (SELECT l_orderkey, min(strftime(l_shipdate, '%Y-%m-%d')) AS found FROM lineitem WHERE l_linenumber <= 2 GROUP BY 1)
SELECT o_orderkey AS page_id, CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE coalesce(found, '') END AS publication_date FROM orders LEFT JOIN d ON o_orderkey = l_orderkey"""
_FACT = f"source_url, {_FOLD.format('trim(entity_name)')}, {_FOLDED('evidence_text')}"
ORACLE["validation_with_duplicates"] = f"""WITH {_RECORDS}, ok AS (SELECT count(*) AS n, count(DISTINCT ({_FACT})) AS kinds FROM v WHERE len(reasons) = 0), bad AS (SELECT count(*) AS n FROM v WHERE len(reasons) > 0),
gone AS (SELECT count(*) AS n FROM labels WHERE quality = 0)
SELECT 2 * bad.n + gone.n + 2 * ok.n - ok.kinds AS failed, 2 * ok.n - ok.kinds AS repeated, gone.n AS generation, ok.kinds AS passed FROM ok, bad, gone"""

_COUNTS = ", ".join(f"len(list_filter(w, lambda x: list_contains([{_quoted(COMMON[k])}], x))) AS {k}" for k in sorted(COMMON))
ORACLE["language_by_words"] = rf"""WITH d AS (SELECT doc_id, regexp_split_to_array(lower(text), '[^\p{{L}}]+') AS w FROM documents), c AS (SELECT doc_id, {_COUNTS} FROM d)
SELECT doc_id, CASE greatest(de, en, es, fr) WHEN 0 THEN 'unknown' WHEN de THEN 'de' WHEN en THEN 'en' WHEN es THEN 'es' ELSE 'fr' END AS language FROM c"""
ORACLE["csv_parts_in_order"] = f"""WITH {_URL}, n AS (SELECT page_id, normalized_url, row_number() OVER (ORDER BY page_id % 3 <> 0, page_id) - 1 AS place FROM u)
SELECT page_id, place, CASE WHEN row_number() OVER (PARTITION BY normalized_url ORDER BY place) = 1 THEN 'new' ELSE 'duplicate' END AS status FROM n"""
_RANKED = lambda key, rows: f"""(SELECT {key}, gram, row_number() OVER (PARTITION BY {key} ORDER BY n DESC, gram) AS rank FROM (
  SELECT {key}, substr(word, i, 3) AS gram, sum(n) AS n FROM (
    SELECT {key}, word, n, unnest(range(1, length(word) - 1)) AS i FROM (
      SELECT {key}, ' ' || word || ' ' AS word, count(*) AS n FROM (SELECT {key}, unnest(regexp_extract_all(lower(text), '\\p{{L}}{{1,40}}')) AS word FROM {rows}) GROUP BY ALL))
  GROUP BY ALL) QUALIFY rank <= 300)"""  # noqa: E731
ORACLE["language_by_profiles"] = f"""WITH known AS MATERIALIZED {_RANKED("lang", "(SELECT lang, text FROM documents WHERE lang IS NOT NULL)")},
own AS MATERIALIZED {_RANKED("doc_id", "documents")},
sums AS (SELECT doc_id, lang, sum(abs(own.rank - known.rank) - 300) AS d FROM own JOIN known USING (gram) GROUP BY ALL),
best AS (SELECT doc_id, lang FROM sums QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY d, lang) = 1)
SELECT doc_id, coalesce(b.lang, 'unknown') AS language FROM documents LEFT JOIN best b USING (doc_id)"""
ORACLE["unprocessed_documents"] = "SELECT doc_id AS page_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"
ORACLE["entity_cap"] = "SELECT p_partkey AS _ord, p_name AS entity, CASE WHEN p_size > 10 THEN 'company' ELSE 'facility' END AS entity_type FROM part ORDER BY p_partkey LIMIT 30"
