"""Queues, funnels, distributions, freshness and quotas on the given tables. Orders stand for postings, events for work items and checks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions import times
from millrace.operators import clustering, pool, quota
from millrace.sources.tables import load, micros

from .registry import query

ROLE = "CASE o_orderstatus WHEN 'O' THEN 'strong' WHEN 'P' THEN 'possible' ELSE 'weak' END"
AS_OF_ORDERS = "2001-01-01 00:00:00"
_LANES = f"""
WITH o AS (
    SELECT *, {ROLE} AS role, greatest(date_diff('day', o_orderdate, TIMESTAMP '{AS_OF_ORDERS}'), 0) AS age FROM orders
), s AS (
    SELECT *, CASE role WHEN 'strong' THEN 60 WHEN 'possible' THEN 35 ELSE 5 END
        + CASE left(o_orderpriority, 1) WHEN '1' THEN 52 WHEN '2' THEN 48 WHEN '3' THEN 16 WHEN '4' THEN 10 ELSE -35 END
        + CASE WHEN age <= 7 THEN 25 WHEN age <= 30 THEN 15 WHEN age <= 90 THEN 5 WHEN age > 180 THEN -15 ELSE 0 END AS score,
        CASE WHEN role = 'weak' THEN 'excluded' WHEN left(o_orderpriority, 1) IN ('1', '2') THEN 'application'
             WHEN left(o_orderpriority, 1) IN ('3', '4') THEN 'verification' ELSE 'excluded' END AS lane,
        CASE WHEN age <= 7 THEN '0_7_days' WHEN age <= 30 THEN '8_30_days' WHEN age <= 90 THEN '31_90_days' WHEN age <= 180 THEN '91_180_days' ELSE 'over_180_days' END AS band
    FROM o
)
"""


def _lanes(spark, sf):
    rows = load(spark, sf, "orders")
    level = F.substring("o_orderpriority", 1, 1)
    role = F.when(F.col("o_orderstatus") == "O", "strong").when(F.col("o_orderstatus") == "P", "possible").otherwise("weak")
    age = F.greatest(F.floor((F.lit(978307200) - micros("o_orderdate") / 1000000) / 86400), F.lit(0)).cast("int")
    rows = rows.withColumns({"role": role, "age": age})
    remote = F.when(level == "1", 52).when(level == "2", 48).when(level == "3", 16).when(level == "4", 10).otherwise(-35)
    lane = F.when(F.col("role") == "weak", "excluded").when(level.isin("1", "2"), "application").when(level.isin("3", "4"), "verification").otherwise("excluded")
    return rows.withColumns({"score": pool.points(F.col("role"), pool.ROLE_SCORES) + remote + pool.age_points(F.col("age")), "lane": lane, "band": times.freshness_band(F.col("age"))})


@query(_LANES + """
SELECT lane, o_orderkey, CAST(score AS INTEGER) AS score, CAST(age AS INTEGER) AS age, k AS lane_rank
FROM (SELECT *, row_number() OVER (PARTITION BY lane ORDER BY score DESC, age, o_custkey, o_orderkey) AS k FROM s) WHERE k <= 25
""")
def lane_priority_topk(spark, sf):
    top = pool.top_per_lane(_lanes(spark, sf), "lane", "score", "age", ["o_custkey", "o_orderkey"], 25)
    return top.select("lane", "o_orderkey", "score", "age", "lane_rank")


@query(_LANES + "SELECT lane, band, role, count(*) AS n, min(score) AS least, max(score) AS most FROM s GROUP BY ALL")
def lane_summary(spark, sf):
    return _lanes(spark, sf).groupBy("lane", "band", "role").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"), F.max("score").alias("most"))


@query("""
SELECT coalesce(nullif(o_orderpriority, ''), 'unknown') AS value, count(*) AS n FROM orders GROUP BY 1
""")
def value_distribution(spark, sf):
    return pool.distribution(load(spark, sf, "orders"), "o_orderpriority")


@query("""
WITH g AS (SELECT l_returnflag, count(*) AS n, count(*) FILTER (l_linestatus = 'F') AS f, count(*) FILTER (l_linestatus = 'O') AS o FROM lineitem GROUP BY 1)
SELECT l_returnflag, n, f AS n_f, o AS n_o, round(n / (SELECT sum(n) FROM g)::DOUBLE, 6) AS share FROM g
""")
def provider_share_pivot(spark, sf):
    rows = load(spark, sf, "lineitem").groupBy("l_returnflag").pivot("l_linestatus", ["F", "O"]).count()
    rows = rows.select("l_returnflag", F.coalesce("F", F.lit(0)).alias("n_f"), F.coalesce("O", F.lit(0)).alias("n_o"))
    n = F.col("n_f") + F.col("n_o")
    total = F.sum(n).over(Window.partitionBy())  # over the few groups
    return rows.select("l_returnflag", n.alias("n"), "n_f", "n_o", F.round(n / total, 6).alias("share"))


@query("""
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) FILTER (event_type = 'error') AS dead, count(*) FILTER (event_type = 'purchase') AS live,
       round(count(*) FILTER (event_type = 'error') / nullif(count(*) FILTER (event_type IN ('error', 'purchase')), 0)::DOUBLE, 6) AS dead_rate
FROM events GROUP BY 1
""")
def dead_rate_ratio(spark, sf):
    dead, live = F.count_if(F.col("event_type") == "error"), F.count_if(F.col("event_type") == "purchase")
    rows = load(spark, sf, "events").groupBy(F.to_date("ts").cast("string").alias("day")).agg(dead.alias("dead"), live.alias("live"))
    return rows.withColumn("dead_rate", F.round(F.try_divide(F.col("dead"), F.col("dead") + F.col("live")), 6))


@query("""
SELECT count(*) AS rows, count(DISTINCT user_id) AS users, count(DISTINCT CASE WHEN event_type = 'click' THEN user_id END) AS clicked,
       count(DISTINCT CASE WHEN event_type = 'purchase' THEN user_id END) AS bought,
       count(DISTINCT CASE WHEN event_type = 'error' AND value > 50 THEN user_id END) AS failed,
       round(count(DISTINCT user_id) / count(*)::DOUBLE, 6) AS users_per_row,
       count(DISTINCT CASE WHEN regexp_matches(json_extract_string(props, '$.k'), '^[0-9]+$') THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END) AS keys
FROM events
""")
def funnel_conditional_distinct(spark, sf):
    kind, value = F.col("event_type"), F.col("value")
    key = F.get_json_object("props", "$.k").try_cast("bigint")
    # A row of flags for each user, and one for each key; then sums. Each event counts once for its user and once for its key.
    entities = F.array(F.struct(F.lit("user").alias("of"), F.col("user_id").cast("bigint").alias("id")), F.struct(F.lit("key").alias("of"), key.alias("id")))
    flags = {"clicked": kind == "click", "bought": kind == "purchase", "failed": (kind == "error") & (value > 50)}
    each = load(spark, sf, "events").select(F.explode(entities).alias("e"), *[F.coalesce(c, F.lit(False)).alias(n) for n, c in flags.items()])
    each = each.groupBy("e.of", "e.id").agg(F.count(F.lit(1)).alias("n"), *[F.max(n).alias(n) for n in flags])
    user, known = F.col("of") == "user", F.col("id").isNotNull()
    out = each.agg(
        F.coalesce(F.sum(F.when(user, F.col("n"))), F.lit(0)).alias("rows"),
        F.count_if(user & known).alias("users"),
        *[F.count_if(user & known & F.col(n)).alias(n) for n in flags],
        F.count_if(~user & known).alias("keys"),
    )
    return out.withColumn("users_per_row", F.round(F.try_divide("users", "rows"), 6))


@query("""
SELECT n_name, count(DISTINCT c_custkey) AS sources, count(DISTINCT CASE WHEN o_orderkey IS NOT NULL THEN c_custkey END) AS with_runs,
       epoch_us(max(o_orderdate)) AS last_run_us, epoch_us(max(CASE WHEN o_orderstatus = 'F' THEN o_orderdate END)) AS last_good_us,
       count(DISTINCT c_custkey) FILTER (o_orderdate >= TIMESTAMP '2000-06-01') AS fresh
FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey GROUP BY n_name
""")
def freshness_by_group(spark, sf):
    nation, customer, orders = (load(spark, sf, t) for t in ("nation", "customer", "orders"))
    at = micros("o_orderdate")
    runs = orders.groupBy("o_custkey").agg(F.max(at).alias("last"), F.max(F.when(F.col("o_orderstatus") == "F", at)).alias("good"))  # before the join
    rows = customer.join(runs, F.col("c_custkey") == F.col("o_custkey"), "left")
    by = rows.groupBy("c_nationkey").agg(
        F.count("c_custkey").alias("sources"),  # the customers' key: each is there once
        F.count("o_custkey").alias("with_runs"),
        F.max("last").alias("last_run_us"),
        F.max("good").alias("last_good_us"),
        F.count_if(F.col("last") >= 959817600000000).alias("fresh"),
    )
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("sources", "with_runs", "fresh")]
    return nation.join(by, F.col("n_nationkey") == F.col("c_nationkey"), "left").select("n_name", *counts, "last_run_us", "last_good_us")


@query("""
WITH t AS (SELECT max(ts) AS m FROM events), g AS (SELECT event_type, max(ts) AS last, count(*) AS n FROM events GROUP BY 1)
SELECT event_type, n, CAST(date_diff('second', last, m) AS BIGINT) AS age_seconds,
       CASE WHEN last IS NULL THEN 'never' WHEN date_diff('second', last, m) > 3600 THEN 'stale' ELSE 'healthy' END AS state FROM g, t
""")
def freshness_assessment(spark, sf):
    rows = load(spark, sf, "events").groupBy("event_type").agg(F.max("ts").alias("last"), F.count(F.lit(1)).alias("n"))
    newest = F.max("last").over(Window.partitionBy())  # over the few groups
    age = F.timestamp_diff("SECOND", F.date_trunc("second", "last"), F.date_trunc("second", newest))
    rows = rows.withColumn("age_seconds", age.cast("long"))
    state = F.when(F.col("last").isNull(), "never").when(F.col("age_seconds") > 3600, "stale").otherwise("healthy")
    return rows.select("event_type", "n", "age_seconds", state.alias("state"))


@query("""
WITH s AS (
    SELECT user_id, props, CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 'crawl-2024-01' WHEN ts < TIMESTAMP '2024-01-21' THEN 'crawl-2024-02' ELSE 'crawl-2024-03' END AS crawl, ts, value FROM events
)
SELECT user_id AS token, count(*) AS observations, count(DISTINCT crawl) AS crawls, string_agg(DISTINCT crawl, ',' ORDER BY crawl) AS crawl_ids,
       min(crawl) AS first_crawl, max(crawl) AS last_crawl, epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us, min(props) AS example FROM s GROUP BY 1
""")
def source_union_rollup(spark, sf):
    edges = [F.lit(f"{e} 00:00:00").cast("timestamp_ntz") for e in ("2024-01-11", "2024-01-21")]
    crawl = F.when(F.col("ts") < edges[0], "crawl-2024-01").when(F.col("ts") < edges[1], "crawl-2024-02").otherwise("crawl-2024-03")
    rows = load(spark, sf, "events").select("user_id", "ts", "props", crawl.alias("crawl"))
    return rows.groupBy(F.col("user_id").alias("token")).agg(
        F.count(F.lit(1)).alias("observations"),
        F.countDistinct("crawl").alias("crawls"),
        F.array_join(F.array_sort(F.collect_set("crawl")), ",").alias("crawl_ids"),
        F.min("crawl").alias("first_crawl"),
        F.max("crawl").alias("last_crawl"),
        F.min(micros("ts")).alias("first_us"),
        F.max(micros("ts")).alias("last_us"),
        F.min("props").alias("example"),
    )


@query("""
WITH f AS (SELECT user_id, min(CASE WHEN ts < TIMESTAMP '2024-01-02' THEN 1 WHEN ts < TIMESTAMP '2024-01-03' THEN 2 ELSE 3 END) AS input FROM events GROUP BY 1)
SELECT input, count(*) AS new_tokens FROM f GROUP BY 1
""")
def marginal_tokens(spark, sf):
    day = F.to_date("ts")
    number = F.when(day < F.lit("2024-01-02").cast("date"), 1).when(day < F.lit("2024-01-03").cast("date"), 2).otherwise(3)
    first = load(spark, sf, "events").groupBy("user_id").agg(F.min(number).alias("input"))
    return first.groupBy("input").agg(F.count(F.lit(1)).alias("new_tokens"))


@query("""
WITH w AS (SELECT c_mktsegment AS s, count(*) AS n FROM customer GROUP BY 1), t AS (SELECT sum(n) AS t FROM w),
p AS (SELECT s, n * 175 // t AS f, n * 175 % t AS r FROM w, t),
q AS (SELECT s, f, row_number() OVER (ORDER BY r DESC, s) AS k, 175 - sum(f) OVER () AS spare FROM p)
SELECT s AS c_mktsegment, CAST(f + CASE WHEN k <= spare THEN 1 ELSE 0 END AS BIGINT) AS quota FROM q
""")
def largest_remainder_quota(spark, sf):
    weights = load(spark, sf, "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    return quota.largest_remainder(weights, "c_mktsegment", "n", 175)


@query("""
WITH r AS (SELECT user_id, CASE event_type WHEN 'purchase' THEN 1 WHEN 'click' THEN 2 WHEN 'view' THEN 3 ELSE 4 END AS k FROM events)
SELECT user_id, CASE min(k) WHEN 1 THEN 'purchase' WHEN 2 THEN 'click' WHEN 3 THEN 'view' ELSE 'other' END AS best, count(*) AS n FROM r GROUP BY 1
""")
def best_status_per_company(spark, sf):
    rank = F.when(F.col("event_type") == "purchase", 1).when(F.col("event_type") == "click", 2).when(F.col("event_type") == "view", 3).otherwise(4)
    name = F.when(F.col("k") < 4, F.col("event_type")).otherwise("other")
    rows = load(spark, sf, "events").withColumn("k", rank)
    return rows.groupBy("user_id").agg(F.min_by(name, "k").alias("best"), F.count(F.lit(1)).alias("n"))


@query("""
SELECT event_type AS stage, count(DISTINCT user_id) AS items, count(*) AS rows, count(*) FILTER (value > 50 AND json_exists(props, '$.k')) AS marked,
       CASE WHEN count(*) FILTER (value > 95) > 0 THEN 'running' WHEN count(*) FILTER (value > 90) > 0 THEN 'partial' ELSE 'completed' END AS run_status
FROM events GROUP BY 1
""")
def work_state_counts(spark, sf):
    keyed = F.array_contains(F.json_object_keys("props"), "k")
    rows = load(spark, sf, "events").groupBy(F.col("event_type").alias("stage")).agg(
        F.countDistinct("user_id").alias("items"), F.count(F.lit(1)).alias("rows"), F.count_if((F.col("value") > 50) & keyed).alias("marked"), F.count_if(F.col("value") > 95).alias("_r"), F.count_if(F.col("value") > 90).alias("_p")
    )
    return rows.withColumn("run_status", F.when(F.col("_r") > 0, "running").when(F.col("_p") > 0, "partial").otherwise("completed")).drop("_r", "_p")


@query("""
SELECT l_orderkey, l_linenumber, CAST(least(300, greatest(5 * pow(2, l_linenumber - 1), CASE WHEN l_quantity > 40 THEN 100 ELSE 0 END)) AS INTEGER) AS wait_seconds FROM lineitem
""")
def retry_backoff(spark, sf):
    asked = F.when(F.col("l_quantity") > 40, 100)
    return load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", times.backoff_seconds(F.col("l_linenumber"), asked).alias("wait_seconds"))


@query("""
SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 1
""")
def duplicate_external_ids(spark, sf):
    return load(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query("SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 50 OFFSET 20")
def offset_limit_slice(spark, sf):
    return load(spark, sf, "customer").select("c_custkey", "c_acctbal").orderBy(F.desc("c_acctbal"), "c_custkey").offset(20).limit(50)


@query("""
WITH g AS (SELECT c_nationkey, c_mktsegment, count(*) AS n, max(c_acctbal) AS best FROM customer GROUP BY 1, 2),
k AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY best DESC, c_mktsegment) AS k FROM g)
SELECT c_nationkey, c_mktsegment, n, best FROM k WHERE k <= 2
""")
def link_topk_by_max(spark, sf):
    rows = load(spark, sf, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.max("c_acctbal").alias("best"))
    k = F.row_number().over(Window.partitionBy("c_nationkey").orderBy(F.desc("best"), "c_mktsegment"))
    return rows.withColumn("k", k).where("k <= 2").drop("k")


@query()
def greedy_quota_select(spark, sf):
    events = load(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    weights = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    quotas = quota.largest_remainder(weights, "event_type", "n", 100)
    return quota.greedy(events, quotas, "event_type", "user_id", [F.desc("value"), "event_id"], 2)


@query()
def complete_linkage_clusters(spark, sf):
    part = load(spark, sf, "part").select("p_brand", "p_partkey", "p_name", "p_type", "p_size")
    anchors = F.array(
        F.struct(F.lit("name").alias("kind"), F.col("p_name").alias("value"), F.lit(1).alias("priority")),
        F.struct(F.lit("shape").alias("kind"), F.concat_ws("|", F.substring("p_name", 1, 5), "p_size").alias("value"), F.lit(2).alias("priority")),
    )
    rows = part.withColumns({"external_id": F.col("p_size").cast("string"), "anchors": anchors})
    return clustering.clusters(rows, "p_brand", "p_partkey", "p_type", "external_id", "anchors").select(*part.columns, "cluster")
