"""URL, HTML, JSON and text operators on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import text, urls
from millrace.sources.tables import load
from millrace.streaming.ingest import ingest_files

from .registry import query

_PARTS = r"""
WITH u AS (
    SELECT page_id, url, lower(regexp_extract(url, '^([a-zA-Z]+)://', 1)) AS scheme, lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#:]+)', 1)) AS host,
           regexp_extract(url, '^[a-zA-Z]+://[^/?#]+(/[^?#]*)', 1) AS path, regexp_extract(url, '^[^?#]*\?([^#]*)', 1) AS query FROM pages
), q AS (
    SELECT *, CASE WHEN regexp_replace(path, '/+$', '') = '' THEN '/' ELSE regexp_replace(path, '/+$', '') END AS trimmed,
           list_transform(list_filter(string_split(query, '&'), lambda p : p <> ''), lambda p : {
               'k': url_decode(replace(regexp_extract(p, '^([^=]*)', 1), '+', ' ')), 'v': url_decode(replace(regexp_extract(p, '^[^=]*=?(.*)$', 1), '+', ' '))}) AS items FROM u
)
"""
_JOINED = "array_to_string(list_transform(list_sort({0}), lambda p : concat(replace(url_encode(p.k), '%20', '+'), '=', replace(url_encode(p.v), '%20', '+'))), '&')"


@query(_PARTS + r"""
SELECT host, lower(regexp_extract(path, '^/([^/]+)', 1)) AS token, count(*) AS n, min(url) AS example, min(page_id) AS first_id, max(page_id) AS last_id FROM q GROUP BY 1, 2
""")
def host_token_rollup(spark, sf):
    pages = load(spark, sf, "pages").select("page_id", "url", urls.host(F.col("url")).alias("host"), urls.token(F.col("url")).alias("token"))
    return pages.groupBy("host", "token").agg(F.count(F.lit(1)).alias("n"), F.min("url").alias("example"), F.min("page_id").alias("first_id"), F.max("page_id").alias("last_id"))


@query(_PARTS + f"""
SELECT page_id, concat(scheme, '://', host, trimmed, CASE WHEN len(items) > 0 THEN concat('?', {_JOINED.format('items')}) ELSE '' END) AS work_url FROM q
""")
def url_normalize_work(spark, sf):
    return load(spark, sf, "pages").select("page_id", urls.normalize_work_url(F.col("url")).alias("work_url"))


@query(_PARTS + rf"""
, n AS (
    SELECT page_id, url, list_filter(items, lambda p : NOT regexp_matches(lower(p.k), '^(utm_.*|gh_src|ref|referrer|source)$')) AS kept,
           concat('https://', regexp_replace(host, '^www\.', ''), regexp_replace(trimmed, '/{{2,}}', '/', 'g')) AS base FROM q
)
SELECT concat(base, CASE WHEN len(kept) > 0 THEN concat('?', {_JOINED.format('kept')}) ELSE '' END) AS job_url, count(*) AS n, min(page_id) AS first_id, max(page_id) AS last_id FROM n GROUP BY 1
""")
def url_dedupe_global(spark, sf):
    rows = load(spark, sf, "pages").select("page_id", urls.normalize_job_url(F.col("url")).alias("job_url"))
    return rows.groupBy("job_url").agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first_id"), F.max("page_id").alias("last_id"))


@query(_PARTS + r"""
SELECT page_id, concat(scheme, '://', host) AS origin, nullif(regexp_extract(concat('&', query), '&page=([^&]*)', 1), '') AS page_number,
       host LIKE '%.example.com' OR host = 'example.com' AS on_example FROM q
""")
def url_origin_and_parameter(spark, sf):
    url = F.col("url")
    suffix = F.array_contains(urls.domain_suffixes(urls.host(url)), "example.com")
    return load(spark, sf, "pages").select("page_id", urls.origin(url).alias("origin"), urls.parameter(url, "page").alias("page_number"), suffix.alias("on_example"))


@query(r"""
WITH t AS (
    SELECT page_id, regexp_replace(regexp_replace(html, '(?is)<script\b[^>]*>.*?</script>', ' ', 'g'), '(?is)<style\b[^>]*>.*?</style>', ' ', 'g') AS h FROM pages
), c AS (SELECT page_id, trim(regexp_replace(regexp_replace(h, '<[^>]+>', ' ', 'g'), '[ \t\n\x0B\f\r]+', ' ', 'g')) AS v FROM t)
SELECT page_id, length(v) AS n_chars, sha256(v) AS text_sha256 FROM c
""")
def html_text_clean(spark, sf):
    visible = load(spark, sf, "pages").select("page_id", text.visible_text(F.col("html")).alias("v"))
    return visible.select("page_id", F.char_length("v").cast("long").alias("n_chars"), F.sha2("v", 256).alias("text_sha256"))


@query("""
SELECT event_type, count(*) FILTER (json_exists(props, '$.k')) AS with_key, CAST(sum(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER)) AS BIGINT) AS total,
       max(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER)) AS most, count(*) FILTER (json_exists(props, '$.none')) AS with_other FROM events GROUP BY 1
""")
def json_path_extract(spark, sf):
    k = F.get_json_object("props", "$.k").try_cast("int")
    names = F.json_object_keys("props")
    return load(spark, sf, "events").groupBy("event_type").agg(
        F.count_if(F.array_contains(names, "k")).alias("with_key"), F.sum(k).alias("total"), F.max(k).alias("most"), F.count_if(F.array_contains(names, "none")).alias("with_other")
    )


@query("""
SELECT p_partkey, p_name, CASE WHEN regexp_matches(t, '(^|[^a-z0-9])(bolt|nut)($|[^a-z0-9])') THEN 'exclude' WHEN regexp_matches(t, '(^|[^a-z0-9])widget($|[^a-z0-9])') AND p_type = 'ECONOMY' THEN 'strong'
       WHEN regexp_matches(t, '(^|[^a-z0-9])(widget|ring)($|[^a-z0-9])') THEN 'possible' ELSE 'weak' END AS role_status
FROM (SELECT *, trim(regexp_replace(lower(p_name), '[^a-z0-9+#]+', ' ', 'g')) AS t FROM part)
""")
def role_class_cascade(spark, sf):
    title = text.normalize_title(F.col("p_name"))
    status = (
        F.when(text.whole_term(title, "(bolt|nut)"), "exclude")
        .when(text.whole_term(title, "widget") & (F.col("p_type") == "ECONOMY"), "strong")
        .when(text.whole_term(title, "(widget|ring)"), "possible")
        .otherwise("weak")
    )
    return load(spark, sf, "part").select("p_partkey", "p_name", status.alias("role_status"))


@query(_PARTS + r"""
, c AS (SELECT host, path, page_id, count(*) OVER (PARTITION BY host) AS claims FROM q)
SELECT host, claims, count(*) FILTER (starts_with(path, '/en')) AS compatible, CASE WHEN claims = 1 OR count(*) FILTER (starts_with(path, '/en')) = 1
       THEN coalesce(min(page_id) FILTER (starts_with(path, '/en') OR claims = 1), min(page_id)) END AS survivor FROM c GROUP BY host, claims
""")
def domain_claim_survivor(spark, sf):
    url = F.col("url")
    rows = load(spark, sf, "pages").select("page_id", urls.host(url).alias("host"), F.startswith(urls.part(url, 5), F.lit("/en")).alias("fits"))
    by = rows.groupBy("host").agg(F.count(F.lit(1)).alias("claims"), F.count_if("fits").alias("compatible"), F.min("page_id").alias("_any"), F.min(F.when(F.col("fits"), F.col("page_id"))).alias("_fit"))
    survivor = F.when(F.col("claims") == 1, F.col("_any")).when(F.col("compatible") == 1, F.col("_fit"))
    return by.select("host", "claims", "compatible", survivor.alias("survivor"))


@query("SELECT sha256(text) AS text_sha256, count(*) AS n, min(doc_id) AS first_id, max(doc_id) AS last_id FROM documents GROUP BY text HAVING count(*) > 1")
def exact_text_duplicates(spark, sf):
    rows = load(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("text_sha256"))
    return rows.groupBy("text_sha256").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")).where("n > 1")


@query(r"""
WITH s AS (SELECT c_custkey, coalesce(nullif(regexp_replace(regexp_replace(lower(c_mktsegment), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'company') AS base FROM customer)
SELECT c_custkey, CASE WHEN k = 1 THEN base ELSE concat(base, '-', k) END AS slug FROM (SELECT *, row_number() OVER (PARTITION BY base ORDER BY c_custkey) AS k FROM s)
""")
def slug_with_suffix(spark, sf):
    from millrace.operators.identity import unique_slugs

    rows = load(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return unique_slugs(rows, "c_mktsegment", "c_custkey").select("c_custkey", "slug")


@query("""
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type, count(*) AS n, count(DISTINCT event_id) AS ids FROM events GROUP BY 1, 2
""")
def stream_ingest_resume(spark, sf):
    rows = ingest_files(spark, sf, "events")
    return rows.groupBy(F.to_date("ts").cast("string").alias("day"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("ids"))
