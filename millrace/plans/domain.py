"""Domain operators, applied to domain columns that are derived from the given tables: postings from orders, sources, runs and observations from events, companies from suppliers."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import urls
from millrace.operators import clustering, eligibility, identity, metrics, pool, records
from millrace.sources.tables import load

from .registry import query

AS_OF = "2000-06-01 00:00:00"
PER_LANE = 40
REMOTES = ["pakistan_explicit", "global_explicit", "regional_unconfirmed", "remote_unclear", "restricted_remote", "onsite_explicit", "no_remote_evidence"]
_REMOTE = "CASE o_orderkey % 7 " + " ".join(f"WHEN {k} THEN '{r}'" for k, r in enumerate(REMOTES)) + " END"
_JOBS = f"""
WITH j AS (
    SELECT o_orderkey AS job, o_custkey AS company, CASE WHEN o_orderkey % 11 = 0 THEN 'closed' ELSE 'active' END AS status,
           CASE o_orderstatus WHEN 'O' THEN 'strong' WHEN 'P' THEN 'possible' ELSE 'weak' END AS role, {_REMOTE} AS remote, o_orderkey % 2 = 0 AS managed,
           CASE o_orderkey % 5 WHEN 0 THEN 'https://www.linkedin.com/jobs/' || o_orderkey WHEN 1 THEN 'http://10.0.0.7/x' WHEN 2 THEN NULL ELSE 'https://apply.example.com/' || o_orderkey END AS apply_url,
           CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'https://board.example.org/' || o_orderkey END AS posting_url, left(o_orderpriority, 1) AS provider,
           greatest(date_diff('second', o_orderdate, TIMESTAMP '{AS_OF}'), 0) // 86400 AS age FROM orders
), u AS (
    SELECT *, CASE WHEN o = 1 THEN NULL ELSE apply_url END AS a FROM (SELECT *, job % 5 AS o FROM j)
), c AS (
    SELECT *, CASE WHEN o = 0 AND posting_url IS NOT NULL THEN posting_url ELSE coalesce(a, posting_url) END AS url FROM u
), k AS (
    SELECT *, CASE WHEN age <= 7 THEN '0_7_days' WHEN age <= 30 THEN '8_30_days' WHEN age <= 90 THEN '31_90_days' WHEN age <= 180 THEN '91_180_days' ELSE 'over_180_days' END AS band,
        CASE WHEN status <> 'active' THEN 'job is not active' WHEN role = 'weak' THEN 'role is outside the strong or possible target lanes'
             WHEN url IS NULL THEN 'no public posting or application URL is available' WHEN age > 365 THEN 'posting is older than the application freshness window'
             WHEN remote IN ('pakistan_explicit', 'global_explicit') THEN 'role has explicit Pakistan or worldwide remote evidence'
             WHEN remote IN ('regional_unconfirmed', 'remote_unclear') THEN 'role is remote but geographic eligibility needs verification'
             WHEN remote = 'restricted_remote' THEN 'remote eligibility is explicitly restricted' WHEN remote = 'onsite_explicit' THEN 'role explicitly requires onsite or hybrid work'
             ELSE 'role lacks usable remote eligibility evidence' END AS reason,
        CASE role WHEN 'strong' THEN 60 WHEN 'possible' THEN 35 ELSE 5 END
        + CASE remote WHEN 'pakistan_explicit' THEN 52 WHEN 'global_explicit' THEN 48 WHEN 'regional_unconfirmed' THEN 16 WHEN 'remote_unclear' THEN 10
                      WHEN 'restricted_remote' THEN -55 WHEN 'onsite_explicit' THEN -65 ELSE -35 END
        + CASE WHEN managed THEN 10 ELSE 0 END + CASE WHEN apply_url IS NOT NULL THEN 10 WHEN posting_url IS NOT NULL THEN 5 ELSE -20 END
        + CASE WHEN age <= 7 THEN 25 WHEN age <= 30 THEN 15 WHEN age <= 90 THEN 5 WHEN age > 180 THEN -15 ELSE 0 END AS score FROM c
), l AS (
    SELECT *, CASE WHEN reason LIKE 'role has%' THEN 'application' WHEN reason LIKE 'role is remote%' THEN 'verification' ELSE 'excluded' END AS lane FROM k
), r AS (
    SELECT *, row_number() OVER (PARTITION BY lane ORDER BY score DESC, age, company, job) AS lane_rank FROM l
)
"""


def _jobs(spark, sf):
    orders = load(spark, sf, "orders")
    key = F.col("o_orderkey")
    number = key.cast("string")
    remote = F.element_at(F.array(*map(F.lit, REMOTES)), (key % 7 + 1).cast("int"))
    apply = F.when(key % 5 == 0, F.concat(F.lit("https://www.linkedin.com/jobs/"), number)).when(key % 5 == 1, "http://10.0.0.7/x").when(key % 5 > 2, F.concat(F.lit("https://apply.example.com/"), number))
    jobs = orders.select(
        key.alias("job"),
        F.col("o_custkey").alias("company"),
        F.when(key % 11 == 0, "closed").otherwise("active").alias("status"),
        F.when(F.col("o_orderstatus") == "O", "strong").when(F.col("o_orderstatus") == "P", "possible").otherwise("weak").alias("role_match_status"),
        remote.alias("remote_eligibility_status"),
        (key % 2 == 0).alias("lifecycle_managed"),
        apply.alias("apply_url"),
        F.when(key % 3 != 0, F.concat(F.lit("https://board.example.org/"), number)).alias("posting_url"),
        F.substring("o_orderpriority", 1, 1).alias("provider"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("source_published_at"),
    )
    return pool.classify(jobs, f"{AS_OF}Z", 365)


@query(_JOBS + "SELECT job, lane AS application_lane, reason AS application_lane_reason, url AS application_url, CAST(age AS INTEGER) AS freshness_age_days, band AS freshness_band, CAST(score AS INTEGER) AS priority_score FROM l")
def pool_classify(spark, sf):
    return _jobs(spark, sf).select("job", "application_lane", "application_lane_reason", "application_url", "freshness_age_days", "freshness_band", "priority_score")


_COUNTS = {
    "inventory_count": "true",
    "application_candidate_count": "lane = 'application'",
    "verification_candidate_count": "lane = 'verification'",
    "application_queue_count": f"lane = 'application' AND lane_rank <= {PER_LANE}",
    "verification_queue_count": f"lane = 'verification' AND lane_rank <= {PER_LANE}",
    "excluded_count": "lane = 'excluded'",
}
_CHOSEN = f"lane <> 'excluded' AND lane_rank <= {PER_LANE}"
_SHARES = {
    "provider_contribution": ("provider", _CHOSEN),
    "application_provider_contribution": ("provider", f"{_CHOSEN} AND lane = 'application'"),
    "verification_provider_contribution": ("provider", f"{_CHOSEN} AND lane = 'verification'"),
    "remote_status_distribution": ("remote", "true"),
    "role_status_distribution": ("role", "true"),
    "freshness_distribution": ("band", _CHOSEN),
    "exclusion_reason_distribution": ("reason", "lane = 'excluded'"),
}


@query(
    _JOBS
    + " UNION ALL ".join(
        [f"SELECT '{m}' AS metric, CAST(NULL AS VARCHAR) AS value, count(*) AS n FROM r WHERE {w} HAVING count(*) > 0" for m, w in _COUNTS.items()]
        + [f"SELECT '{m}', {c}, count(*) FROM r WHERE {w} GROUP BY 2" for m, (c, w) in _SHARES.items()]
    )
)
def pool_summary(spark, sf):
    jobs = _jobs(spark, sf)
    top = pool.top_per_lane(jobs.select("job", "company", "application_lane", "priority_score", "freshness_age_days"), "application_lane", "priority_score", "freshness_age_days", ["company", "job"], PER_LANE)
    return records.pool_summary(jobs.join(top.select("job", "lane_rank"), "job", "left"), PER_LANE)


@query(_JOBS + """
SELECT lane AS queue, count(*) AS row_count, count(DISTINCT company) AS company_count, count(apply_url) AS direct_application_url_count, count(url) AS selected_url_count,
       count(*) - count(url) AS missing_url_count, round(count(apply_url) / count(*)::DOUBLE, 6) AS direct_application_url_coverage, round(count(url) / count(*)::DOUBLE, 6) AS selected_url_coverage
FROM l GROUP BY 1
""")
def queue_metrics(spark, sf):
    jobs = _jobs(spark, sf)
    return metrics.queue_metrics(jobs.select(F.col("application_lane").alias("queue"), F.col("company").cast("string").alias("company_slug"), F.lit(None).cast("string").alias("company_name"), "apply_url", "posting_url"))


@query("""
WITH c AS (SELECT *, 200 + event_id % 350 AS status FROM events),
o AS (
    SELECT event_type, CASE WHEN status BETWEEN 200 AND 299 THEN 'live' WHEN status IN (404, 410) THEN 'dead' WHEN status IN (401, 403, 407, 451) THEN 'blocked'
           WHEN status IN (408, 425, 429) OR status >= 500 THEN 'transient_error' ELSE 'unhealthy' END AS outcome FROM c
)
SELECT event_type, count(*) AS validation_row_count, count(*) FILTER (outcome = 'live') AS live_link_count, count(*) FILTER (outcome = 'dead') AS dead_link_count,
       count(*) FILTER (outcome = 'blocked') AS blocked_link_count, count(*) FILTER (outcome = 'transient_error') AS transient_error_link_count, count(*) FILTER (outcome = 'invalid') AS invalid_link_count,
       round(count(*) FILTER (outcome = 'dead') / nullif(count(*) FILTER (outcome IN ('dead', 'live')), 0)::DOUBLE, 6) AS dead_link_rate FROM o GROUP BY 1
""")
def link_check_metrics(spark, sf):
    status = (F.col("event_id") % 350 + 200).cast("int")
    return metrics.link_metrics(load(spark, sf, "events").withColumn("outcome", metrics.classify_status(status)), "event_type")


@query("""
SELECT l_orderkey, l_linenumber, l_returnflag, l_partkey, l_suppkey FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE WHEN l_returnflag = 'N' THEN 0 ELSE 1 END, l_suppkey % 3, l_linenumber, l_partkey, l_suppkey) AS k FROM lineitem) WHERE k = 1
""")
def representative_variant(spark, sf):
    rows = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_partkey", "l_suppkey").withColumns({"managed": F.col("l_returnflag") == "N", "rank": F.col("l_suppkey") % 3})
    return clustering.representative(rows, "l_orderkey", "managed", "rank", ["l_linenumber", "l_partkey", "l_suppkey"]).drop("managed", "rank")


@query("""
WITH known AS (SELECT s_suppkey AS id, lower(s_name) AS name, CASE WHEN s_suppkey % 4 < 3 THEN concat('s', s_suppkey % 7, '.example.com') END AS domain FROM supplier),
c AS (
    SELECT c_custkey AS id, lower(CASE WHEN c_custkey % 2 = 0 THEN replace(c_name, 'Customer', 'Supplier') ELSE c_name END) AS name,
           CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN concat('n', c_custkey, '.example.org') ELSE concat('x.s', c_custkey % 7, '.example.com') END AS domain FROM customer
),
n AS (SELECT c.id, count(k.id) AS names, min(k.id) AS one, min(k.domain) AS stored FROM c LEFT JOIN known k ON k.name = c.name GROUP BY 1),
d AS (SELECT c.id, count(DISTINCT k.id) AS domains FROM c LEFT JOIN known k ON k.domain = c.domain OR ends_with(k.domain, '.' || c.domain) OR ends_with(c.domain, '.' || k.domain) GROUP BY 1),
r AS (
    SELECT c.id, one, CASE WHEN names > 1 THEN 'ambiguous_name' WHEN names = 1 AND (domain IS NULL OR stored IS NULL) THEN 'ambiguous_name'
           WHEN names = 1 AND (domain = stored OR ends_with(stored, '.' || domain) OR ends_with(domain, '.' || stored)) THEN 'existing_exact_name' WHEN names = 1 THEN 'identity_conflict'
           WHEN domain IS NULL THEN 'unresolved_no_domain' WHEN domains > 1 THEN 'ambiguous_domain' WHEN domains = 1 THEN 'identity_conflict' ELSE 'new_company_domain_candidate' END AS resolution
    FROM c JOIN n USING (id) JOIN d USING (id)
)
SELECT id AS candidate_id, resolution, CASE WHEN resolution = 'existing_exact_name' THEN one END AS company_id FROM r
""")
def company_resolution(spark, sf):
    key = F.col("s_suppkey")
    companies = load(spark, sf, "supplier").select(key.alias("company_id"), F.col("s_name").alias("name"), F.when(key % 4 < 3, F.concat(F.lit("s"), key % 7, F.lit(".example.com"))).alias("domain"))
    c = F.col("c_custkey")
    name = F.when(c % 2 == 0, F.replace("c_name", F.lit("Customer"), F.lit("Supplier"))).otherwise(F.col("c_name"))
    domain = F.when(c % 5 == 1, F.concat(F.lit("https://www.n"), c, F.lit(".example.org/about"))).when(c % 5 > 1, F.concat(F.lit("x.s"), c % 7, F.lit(".example.com")))
    candidates = load(spark, sf, "customer").select(c.alias("candidate_id"), name.alias("name"), domain.alias("domain"))
    return identity.resolve(candidates, companies).select("candidate_id", "resolution", "company_id")


@query("""
WITH k AS (SELECT user_id, event_type, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) % 4 AS c FROM events)
SELECT user_id, event_type, coalesce(string_agg(DISTINCT CAST(c AS VARCHAR), ',' ORDER BY CAST(c AS VARCHAR)), '') AS company_ids, count(DISTINCT c) > 1 AS ambiguous FROM k GROUP BY 1, 2
""")
def asserted_companies(spark, sf):
    company = (F.get_json_object("props", "$.k").try_cast("int") % 4).cast("string")
    found = records.asserted_companies(load(spark, sf, "events").withColumn("company", company), ["user_id", "event_type"], "company")
    return found.withColumn("company_ids", F.array_join("company_ids", ","))


@query("""
WITH n AS (SELECT o_custkey, o_orderkey, CASE WHEN o_custkey % 3 = 0 THEN concat(' Name', o_orderkey % 2) WHEN o_orderkey % 2 = 0 THEN 'ACME ' ELSE 'Acme' END AS name FROM orders)
SELECT o_custkey, CASE WHEN count(DISTINCT lower(trim(name))) = 1 THEN min_by(trim(name), o_orderkey) END AS confirmed_name FROM n GROUP BY 1
""")
def confirmed_company_name(spark, sf):
    key = F.col("o_orderkey")
    name = F.when(F.col("o_custkey") % 3 == 0, F.concat(F.lit(" Name"), key % 2)).when(key % 2 == 0, "ACME ").otherwise("Acme")
    return records.confirmed_names(load(spark, sf, "orders").select("o_custkey", "o_orderkey", name.alias("name")), ["o_custkey"], "name", "o_orderkey")


@query("""
WITH s AS (SELECT c_custkey AS id, concat('p', c_custkey % 3) AS provider, c_custkey % 10 <> 0 AS on_, c_custkey % 7 <> 0 AS snap FROM customer),
runs AS (SELECT o_custkey AS id, strftime(o_orderdate, '%Y') AS run_key, max(o_orderstatus) AS status FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1, 2),
asked AS (SELECT DISTINCT o_custkey AS id, strftime(o_orderdate, '%Y') AS run_key FROM orders)
SELECT a.id AS source_id, a.run_key, CASE WHEN s.id IS NULL THEN 'unknown_source' WHEN s.provider <> CASE WHEN a.id % 11 = 0 THEN 'p9' ELSE concat('p', a.id % 3) END THEN 'provider_differs' WHEN NOT on_ THEN 'source_disabled'
       WHEN NOT snap THEN 'not_a_snapshot_source' WHEN r.status = 'P' THEN 'replay' WHEN r.status IS NOT NULL THEN 'run_key_reused' ELSE 'start' END AS action
FROM asked a LEFT JOIN s ON s.id = a.id LEFT JOIN runs r ON r.id = a.id AND r.run_key = a.run_key
""")
def run_starts(spark, sf):
    key = F.col("c_custkey")
    provider = F.concat(F.lit("p"), key % 3)
    sources = load(spark, sf, "customer").select(key.alias("source_id"), provider.alias("provider"), F.when(key % 10 == 0, "disabled").otherwise("active").alias("status"), F.when(key % 7 == 0, "observation").otherwise("complete_snapshot").alias("sync_mode"))
    orders = load(spark, sf, "orders").select(F.col("o_custkey").alias("source_id"), F.date_format("o_orderdate", "yyyy").alias("run_key"), "o_orderstatus")
    runs = orders.where("o_orderstatus <> 'F'").groupBy("source_id", "run_key").agg(F.max("o_orderstatus").alias("_s"))
    runs = runs.select("source_id", "run_key", F.when(F.col("_s") == "P", "completed").otherwise("running").alias("status"))
    source = F.col("source_id")
    requests = orders.select("source_id", "run_key").distinct().withColumn("provider", F.when(source % 11 == 0, "p9").otherwise(F.concat(F.lit("p"), source % 3)))
    return records.start_runs(requests, sources, runs).select("source_id", "run_key", "action")


@query("SELECT c_custkey AS source_id, concat('p', c_custkey % 3) AS provider FROM customer WHERE c_custkey % 10 <> 0 AND c_custkey % 7 <> 0 AND c_custkey % 3 = 1 AND c_nationkey = 5")
def active_sources_filtered(spark, sf):
    key = F.col("c_custkey")
    sources = load(spark, sf, "customer").select(
        key.alias("source_id"),
        F.concat(F.lit("p"), key % 3).alias("provider"),
        F.col("c_nationkey").alias("company_id"),
        F.when(key % 10 == 0, "disabled").otherwise("active").alias("status"),
        F.when(key % 7 == 0, "observation").otherwise("complete_snapshot").alias("sync_mode"),
    )
    return records.active_sources(sources, provider="p1", company_id=5).select("source_id", "provider")


@query("""
WITH h AS (SELECT page_id, lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#:]+)', 1)) AS host FROM pages)
SELECT page_id, host AS key, length(host) AS host_length, host LIKE '%.example.net' AS on_net FROM h
""")
def computed_once_by_host(spark, sf):
    def measure(keys):
        return keys.select("key", F.char_length("key").cast("long").alias("host_length"), F.endswith("key", F.lit(".example.net")).alias("on_net"))

    return records.computed_once(load(spark, sf, "pages").select("page_id", "url"), urls.host(F.col("url")), measure).drop("url")


@query(f"""
SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderdate END, o_orderdate + INTERVAL 30 DAY) BETWEEN TIMESTAMP '{AS_OF}' - INTERVAL 45 DAY AND TIMESTAMP '{AS_OF}' + INTERVAL 1 DAY AS recent FROM orders
""")
def recent_observation(spark, sf):
    at, later = F.col("o_orderdate"), F.expr("o_orderdate + INTERVAL 30 DAYS")
    as_of = F.lit(AS_OF).cast("timestamp_ntz")
    recent = records.recently_observed(as_of, [F.when(F.col("o_orderkey") % 3 != 0, at), F.when(F.col("o_orderkey") % 3 != 0, F.expr("o_orderdate - INTERVAL 3 DAYS"))], [later, at])
    return load(spark, sf, "orders").select("o_orderkey", recent.alias("recent"))


@query("""
WITH b AS (SELECT page_id, lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#:]+)', 1)) AS host, lower(regexp_extract(url, '^[a-zA-Z]+://[^/?#]+/+([^/?#]+)', 1)) AS t FROM pages)
SELECT page_id, CASE WHEN host LIKE 'blog.%' AND t <> 'embed' AND regexp_full_match(t, '[a-z0-9_-]+') THEN t END AS board FROM b
""")
def board_tokens(spark, sf):
    pages = load(spark, sf, "pages").select("page_id", F.regexp_replace("url", "(?i)://blog\\.[^/?#:]+", "://board.example").alias("url"))
    return pages.select("page_id", urls.board_token(F.col("url"), "api.board.example", ["board.example"]).alias("board"))


@query("""
WITH o AS (SELECT o_custkey, count(*) AS n, sum(o_totalprice) AS total, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS jobs FROM orders WHERE o_orderstatus = 'P' GROUP BY 1)
SELECT c_custkey, coalesce(n, 0) AS n, coalesce(jobs, '') AS jobs FROM customer LEFT JOIN o ON o_custkey = c_custkey
""")
def jobs_by_company(spark, sf):
    orders = load(spark, sf, "orders").where("o_orderstatus = 'P'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.array_sort(F.collect_list("o_orderkey")).alias("jobs"))
    rows = load(spark, sf, "customer").select("c_custkey").join(orders, "c_custkey", "left")
    jobs = F.coalesce("jobs", F.array().cast("array<bigint>"))
    return rows.select("c_custkey", F.size(jobs).cast("long").alias("n"), F.array_join(jobs, ",").alias("jobs"))


@query("""
SELECT DISTINCT o_custkey AS id FROM orders WHERE o_orderstatus = 'P' UNION SELECT c_custkey FROM customer WHERE c_acctbal < 0
""")
def complete_keys_union(spark, sf):
    done = load(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("id"))
    return done.union(load(spark, sf, "customer").where("c_acctbal < 0").select("c_custkey")).distinct()


@query("SELECT event_type, first_day, count(*) AS keys FROM (SELECT user_id, event_type, CAST(min(CAST(ts AS DATE)) AS VARCHAR) AS first_day FROM events GROUP BY 1, 2) GROUP BY 1, 2")
def first_seen_order(spark, sf):
    first = load(spark, sf, "events").groupBy("user_id", "event_type").agg(F.min(F.to_date("ts")).cast("string").alias("first_day"))
    return first.groupBy("event_type", "first_day").agg(F.count(F.lit(1)).alias("keys"))


PLACES = ["Remote", "Worldwide - Remote", "Remote - Canada", "Berlin, Germany", "Remote - APAC", "Remote, Pakistan", ""]
TEXTS = [
    "We build software.",
    "Work from anywhere in the world.",
    "This role is on-site.",
    "Applicants must be authorized to work in the United States.",
    "This is a fully remote role.",
    "Preferred: U.S. citizenship required.",
    "Candidates based in India may apply.",
    "Our hours overlap with UTC+2 teams.",
]
TITLES = ["Software Engineer", "Backend Engineer (US only)", "Engineer, Remote"]


@query("""
WITH k AS (SELECT o_orderkey, o_orderkey % 7 AS place, (o_orderkey // 7) % 8 AS said, (o_orderkey // 56) % 3 AS title FROM orders),
s AS (SELECT *, place IN (0, 1, 2, 4, 5) OR title = 2 OR said IN (1, 4) AS signal FROM k)
SELECT o_orderkey, CASE WHEN said = 3 AND signal THEN 'restricted_remote' WHEN title = 1 AND signal THEN 'restricted_remote' WHEN said = 2 THEN 'onsite_explicit'
    WHEN place = 2 THEN 'restricted_remote' WHEN signal AND said = 6 THEN 'restricted_remote' WHEN place = 1 AND said = 7 THEN 'regional_unconfirmed'
    WHEN signal AND place = 3 THEN 'restricted_remote' WHEN place = 5 THEN 'pakistan_explicit' WHEN place = 1 THEN 'global_explicit'
    WHEN signal AND (place = 4 OR said = 7) THEN 'regional_unconfirmed' WHEN said = 1 THEN 'global_explicit' WHEN signal THEN 'remote_unclear' ELSE 'no_remote_evidence' END AS remote_eligibility_status FROM s
""")
def remote_eligibility(spark, sf):
    key = F.col("o_orderkey")
    pick = lambda of, by: F.element_at(F.array(*map(F.lit, of)), (by % len(of) + 1).cast("int"))
    jobs = load(spark, sf, "orders").select("o_orderkey", pick(PLACES, key).alias("place"), pick(TEXTS, F.floor(key / 7)).alias("said"), pick(TITLES, F.floor(key / 56)).alias("title"))
    return eligibility.classify(jobs, F.col("title"), F.col("place"), F.col("said")).select("o_orderkey", eligibility.STATUS)
