"""Canonical hashes, boards' evidence, openings of companies and their order. Events bring JSON, documents postings of a board, order lines postings of companies, customers stand for companies."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.canonical import json_sha256, json_text
from millrace.operators import companies as fits
from millrace.operators import focus, hiring
from millrace.sources import boards
from millrace.sources.tables import load

from .registry import query

PROFILE = "Backend engineer: Python, Spark, distributed data pipelines, cloud; React on the side. Open source maintainer."


@query("""
SELECT event_id, sha256('{"event":"' || event_type || '","props":{"k":' || json_extract_string(props, '$.k') || '},"value":null}') AS props_sha256,
       'value props k ' || json_extract_string(props, '$.k') || ' event ' || event_type AS props_text FROM events
""")
def props_sha256(spark, sf):
    whole = F.concat(F.lit('{ "value": null, "props": '), "props", F.lit(', "event" : "'), "event_type", F.lit('"}'))
    return load(spark, sf, "events").select("event_id", json_sha256(whole).alias("props_sha256"), json_text(whole).alias("props_text"))


@query("""
WITH e AS (
    SELECT doc_id, 'Posting ' || doc_id AS title, 'https://jobs.example/' || doc_id AS url,
           '{"application":{"is_listed":true,"posting_url":"https://jobs.example/' || doc_id || '"},"countries":['
           || CASE WHEN doc_id % 3 = 0 THEN '' WHEN doc_id % 2 = 0 THEN '"Chile","Peru"' ELSE '"Chile"' END || '],"eligibility_signals":['
           || CASE WHEN doc_id % 3 = 0 THEN '' ELSE '{"kind":"provider_metadata","name":"Eligible Countries","value":["Chile"' || CASE WHEN doc_id % 2 = 0 THEN ',"Peru | chile"' ELSE '' END || ']}' END
           || '],"offices":[{"location":"\\u00c9vry","name":"A"},{"name":"' || lang || '"}],"primary_location":{"label":"' || lang || '"},"provider":"board","provider_metadata":['
           || CASE WHEN doc_id % 3 = 0 THEN '' ELSE '{"name":"Eligible Countries","value":["Chile"' || CASE WHEN doc_id % 2 = 0 THEN ',"Peru | chile"' ELSE '' END || ']},' END
           || '{"name":"Size","value":' || CAST(n_chars AS VARCHAR) || ',"value_type":"number"}],"requisition_id":' || CASE WHEN doc_id % 5 = 0 THEN 'null' ELSE '"R' || doc_id || '"' END
           || ',"schema_version":1,"secondary_locations":[],"workplace":{}}' AS evidence, source, lang
    FROM documents
)
SELECT CAST(doc_id AS VARCHAR) AS external_job_id, evidence AS structured_evidence,
       sha256('{"apply_url":null,"department":"' || source || '","description_text":"Work & live","employment_type":null,"location":"' || lang || '","posting_url":"' || url || '","structured_evidence":' || evidence || ',"title":"' || title || '"}') AS content_hash
FROM e
""")
def board_content_hashes(spark, sf):
    d = F.col("doc_id")
    value = F.when(d % 2 == 0, F.lit('["Chile", "Peru | chile"]')).otherwise(F.lit('["Chile"]'))
    countries = F.when(d % 3 == 0, "").otherwise(F.concat(F.lit('{"id": 1, "value": '), value, F.lit(', "name": " Eligible Countries "}, ')))
    payload = F.concat(
        F.lit('{"jobs": [{"title": " Posting '), d, F.lit(' ", "id": '), d, F.lit(', "absolute_url": "https://jobs.example/'), d, F.lit('", "content": "<p>Work &amp;<br>live</p>", "location": {"name": "'), "lang",
        F.lit('"}, "departments": [{"name": "'), "source", F.lit('"}], "metadata": ['), countries, F.lit('{"name": "Size", "value": '), F.col("n_chars").cast("string"), F.lit(', "value_type": "number"}], "offices": [{"name": "'), "lang",
        F.lit('", "location": null}, {"location": "Évry", "name": "A"}]'), F.when(d % 5 == 0, "").otherwise(F.concat(F.lit(', "req_id": "R'), d, F.lit('"'))), F.lit("}]}")
    )
    payloads = load(spark, sf, "documents").select(F.lit("s").alias("source_id"), payload.alias("payload"))
    return boards.board_a(payloads, "board").select("external_job_id", "structured_evidence", "content_hash")


_REMOTE_SQL = "list_extract(['pakistan_explicit', 'global_explicit', 'regional_unconfirmed', 'remote_unclear', 'restricted_remote', 'onsite_explicit', 'no_remote_evidence'], CAST(l_suppkey % 7 + 1 AS INTEGER))"


@query(f"""
WITH lines AS (
    SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey, min(l_suppkey) AS l_suppkey, min(l_quantity) AS l_quantity, min(l_returnflag) AS l_returnflag FROM lineitem GROUP BY ALL
), j AS (
    SELECT l_orderkey AS company, l_linenumber AS job, (l_linenumber - 1) // 2 AS cl, {_REMOTE_SQL} AS remote, l_suppkey % 7 AS remote_rank, l_quantity > 20 AS managed,
           list_extract(['strong', 'possible', 'weak', 'exclude'], CAST(l_partkey % 4 + 1 AS INTEGER)) AS role, l_partkey % 4 AS role_rank, l_returnflag AS reason, 'Title ' || (l_partkey % 3) AS title FROM lines
), s AS (
    SELECT company, count(*) AS raw, count(DISTINCT cl) AS n, count(*) FILTER (role_rank < 2) AS raw_m, count(DISTINCT cl) FILTER (role_rank < 2) AS n_m,
           count(*) FILTER (managed) AS raw_a, count(DISTINCT cl) FILTER (managed) AS n_a, count(*) FILTER (managed AND role_rank < 2) AS raw_am, count(DISTINCT cl) FILTER (managed AND role_rank < 2) AS n_am,
           min(role_rank) AS best, min(role_rank) FILTER (managed) AS best_managed FROM j GROUP BY company
), heads AS (
    SELECT company, cl, arg_min(remote, (CASE WHEN managed THEN 0 ELSE 1 END) * 1000 + remote_rank * 100 + job) AS remote, arg_min(remote_rank, (CASE WHEN managed THEN 0 ELSE 1 END) * 1000 + remote_rank * 100 + job) AS rank
    FROM j WHERE role_rank < 2 GROUP BY company, cl
), managed_heads AS (
    SELECT company, cl, min(remote_rank) AS rank FROM j WHERE role_rank < 2 AND managed GROUP BY company, cl
), r AS (
    SELECT company, count(*) FILTER (remote = 'pakistan_explicit') AS p, count(*) FILTER (remote = 'global_explicit') AS g, count(*) FILTER (remote = 'no_remote_evidence') AS none, min(rank) AS best FROM heads GROUP BY company
), m AS (
    SELECT company, min(rank) AS best FROM managed_heads GROUP BY company
), w AS (
    SELECT company, reason, min(job) AS k FROM j WHERE role_rank < 2 OR company NOT IN (SELECT company FROM j WHERE role_rank < 2) GROUP BY ALL
), t AS (
    SELECT company, title, min(job) AS k FROM j WHERE role_rank < 2 GROUP BY ALL
)
SELECT s.company, n AS active_job_count, raw AS raw_active_job_count, raw - n AS duplicate_active_job_count, n_m AS matching_job_count, raw_m - n_m AS duplicate_matching_job_count, n_a AS managed_active_job_count,
       n_am AS managed_matching_job_count, raw_am AS managed_raw_matching_job_count, coalesce(p, 0) AS pakistan_explicit_matching_job_count, coalesce(g, 0) AS global_explicit_matching_job_count,
       coalesce(none, 0) AS no_remote_evidence_matching_job_count, list_extract(['strong', 'possible', 'weak', 'exclude'], CAST(s.best + 1 AS INTEGER)) AS role_match_status,
       coalesce(list_extract(['strong', 'possible', 'weak', 'exclude'], CAST(best_managed + 1 AS INTEGER)), 'none') AS managed_role_match_status,
       coalesce({_REMOTE_SQL.replace("l_suppkey % 7", "r.best")}, 'no_remote_evidence') AS best_remote_eligibility, coalesce({_REMOTE_SQL.replace("l_suppkey % 7", "m.best")}, 'no_remote_evidence') AS managed_best_remote_eligibility,
       (SELECT string_agg(reason, ';' ORDER BY k) FROM w WHERE w.company = s.company) AS reasons, coalesce((SELECT string_agg(title, ';' ORDER BY k) FROM t WHERE t.company = s.company), '') AS titles
FROM s LEFT JOIN r USING (company) LEFT JOIN m USING (company)
""")
def role_focus(spark, sf):
    n, values = F.col("l_linenumber"), ("l_partkey", "l_suppkey", "l_quantity", "l_returnflag")
    # An order has few lines. Dealt by order once, they are grouped by line, company, cluster and title where they lie.
    line = load(spark, sf, "lineitem").repartition("l_orderkey").groupBy("l_orderkey", "l_linenumber").agg(*[F.min(c).alias(c) for c in values])
    pick = lambda values, k: F.element_at(F.array(*map(F.lit, values)), (k + 1).cast("int"))
    anchor = F.struct(F.lit("url").alias("kind"), F.concat(F.lit("u"), F.floor((n - 1) / 2)).alias("value"), F.lit(1).alias("priority"))
    jobs = line.select(
        F.col("l_orderkey").alias("company"), n.alias("job"), (n % 2).cast("string").alias("source"), n.cast("string").alias("external_id"), F.lit("p").alias("provider"), F.array(anchor).alias("anchors"),
        F.concat(F.lit("Title "), F.col("l_partkey") % 3).alias("title"), pick(focus.ROLES, F.col("l_partkey") % 4).alias("role_status"), F.col("l_returnflag").alias("role_reason"),
        pick(focus.REMOTES, F.col("l_suppkey") % 7).alias("remote_status"), (F.col("l_quantity") > 20).alias("managed")
    )
    found = focus.role_focus(jobs)
    kept = ["company", "active_job_count", "raw_active_job_count", "duplicate_active_job_count", "matching_job_count", "duplicate_matching_job_count", "managed_active_job_count", "managed_matching_job_count"]
    kept += ["managed_raw_matching_job_count", *(f"{s}_matching_job_count" for s in ("pakistan_explicit", "global_explicit", "no_remote_evidence"))]
    kept += ["role_match_status", "managed_role_match_status", "best_remote_eligibility", "managed_best_remote_eligibility"]
    return found.select(*kept, F.array_join("role_match_reasons", ";").alias("reasons"), F.array_join("matching_job_titles", ";").alias("titles"))


@query("""
WITH c AS (
    SELECT c_custkey AS k, 'c' || c_custkey AS slug, lower(c_name || ' ' || c_mktsegment || CASE c_custkey % 6 WHEN 0 THEN ' cloud data' WHEN 1 THEN ' ai agents' WHEN 2 THEN ' said airy' WHEN 3 THEN ' github react' ELSE '' END
                  || CASE WHEN c_custkey % 9 = 0 THEN ' South Asia' ELSE '' END) AS t,
           CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_custkey % 90 END AS size, c_custkey % 70 AS proto, c_custkey % 4 AS q FROM customer WHERE c_custkey % 10 <> 0
), s AS (
    SELECT *, least(proto, 50) + CASE WHEN q = 1 THEN 8 ELSE 0 END + 4 + CASE WHEN q = 2 THEN 8 ELSE 0 END + CASE WHEN size <= 5 THEN 14 WHEN size <= 10 THEN 10 WHEN size <= 25 THEN 6 ELSE 0 END
           + CASE WHEN t LIKE '%asia%' THEN 4 ELSE 0 END + CASE WHEN q = 3 THEN 5 ELSE 0 END
           + CASE WHEN t LIKE '%cloud%' THEN 16 ELSE 0 END + CASE WHEN t LIKE '%data%' THEN 9 ELSE 0 END + CASE WHEN t LIKE '%react%' THEN 3 ELSE 0 END + CASE WHEN t LIKE '%github%' THEN 7 ELSE 0 END AS score
    FROM c WHERE size IS NULL OR size <= 25
)
SELECT k AS company, score AS fit_score, row_number() OVER (ORDER BY score DESC, slug) AS rank,
       concat_ws(';', CASE WHEN t LIKE '%cloud%' THEN 'Backend systems' END, CASE WHEN t LIKE '%data%' THEN 'Data engineering' END, CASE WHEN t LIKE '%react%' THEN 'Full-stack product' END, CASE WHEN t LIKE '%github%' THEN 'Open-source leverage' END) AS matches
FROM s
""")
def company_ranks(spark, sf):
    k, none = F.col("c_custkey"), F.lit(None).cast("string")
    tag = F.when(k % 6 == 0, "Cloud data").when(k % 6 == 1, "AI agents").when(k % 6 == 2, "said airy").when(k % 6 == 3, "GitHub React")
    listed = lambda c: F.array_compact(F.array(c))
    rows = load(spark, sf, "customer").select(
        k.alias("company"), F.concat(F.lit("c"), k).alias("slug"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("one_liner"), none.alias("industry"), none.alias("subindustry"), listed(tag).alias("tags"),
        listed(none).alias("industries"), listed(F.when(k % 9 == 0, "South Asia")).alias("regions"), none.alias("all_locations"), none.alias("prototype_angle"), (k % 70).cast("int").alias("prototype_score"),
        F.lit("u").alias("directory_url"), F.when(k % 4 == 1, "Active").alias("status"), F.when(k % 10 != 0, "https://x.example").alias("website"), (k % 4 == 2).alias("is_hiring"),
        F.when(k % 7 != 0, (k % 90).cast("int")).alias("team_size"), F.when(k % 4 == 3, "Winter 2025").otherwise("W12").alias("batch")
    )
    found = fits.ranked(rows, PROFILE)
    return found.select("company", "fit_score", "rank", F.array_join("candidate_strength_matches", ";").alias("matches"))


@query("""
SELECT page_id AS company_id, CASE page_id % 6 WHEN 0 THEN 'hiring' WHEN 1 THEN 'not_hiring' WHEN 4 THEN 'hiring' ELSE 'unknown' END AS verified_hiring_status,
       CASE page_id % 6 WHEN 2 THEN NULL WHEN 3 THEN NULL WHEN 4 THEN 'https://jobs.lever.co/c' || page_id WHEN 5 THEN NULL ELSE 'https://c' || page_id || '.example/careers' END AS career_page_url,
       CASE page_id % 6 WHEN 0 THEN 'Senior Backend Engineer;Staff Data Engineer' WHEN 4 THEN 'Product Manager' ELSE '' END AS roles,
       CASE page_id % 6 WHEN 0 THEN 'strong' WHEN 4 THEN 'possible' ELSE 'unknown' END AS role_fit,
       CASE page_id % 6 WHEN 0 THEN 0.9 WHEN 1 THEN 0.72 WHEN 2 THEN 0.0 WHEN 4 THEN 0.78 WHEN 5 THEN 0.0 ELSE 0.25 END::DOUBLE AS confidence, CASE page_id % 6 WHEN 3 THEN 1 WHEN 5 THEN 1 ELSE 2 END AS pages_used
FROM pages
""")
def hiring_verification(spark, sf):
    rows, k = load(spark, sf, "pages"), F.col("page_id")
    site, body = F.concat(F.lit("https://c"), k, F.lit(".example")), F.replace("html", F.lit("<a href="), F.lit("<a name="))  # each page's own links lead to pages that are not there
    link = F.when(k % 6 == 4, F.concat(F.lit('<a class="x" HREF="https://jobs.lever.co/c'), k, F.lit('/"><b>Apply</b></a>'))).when(k % 6 != 3, F.lit('<a href="careers/#top">Work with us</a><a href="/blog">Blog</a>')).otherwise("")
    said = F.when(k % 6 == 0, "<p>Senior Backend Engineer</p><p>1. Staff Data Engineer</p>").when(k % 6 == 1, "<p>There are no open roles.</p>").when(k % 6 == 4, "<p>| Product Manager</p>").otherwise("")
    home = rows.where(k % 6 != 5).select(F.concat(site, F.lit("/")).alias("url"), F.concat(link, body).alias("html"))
    more = rows.where((k % 6).isin(0, 1, 4)).select(F.when(k % 6 == 4, F.concat(F.lit("https://jobs.lever.co/c"), k)).otherwise(F.concat(site, F.lit("/careers"))).alias("url"), F.concat(body, said).alias("html"))
    found = hiring.verify(rows.select(k.alias("company_id"), site.alias("website")), home.unionByName(more), PROFILE)
    return found.select("company_id", "verified_hiring_status", "career_page_url", F.array_join("verified_roles", ";").alias("roles"), "role_fit", "confidence", "pages_used")
