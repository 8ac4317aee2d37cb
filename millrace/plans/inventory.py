"""Inventory, lifecycle and registry operators on the given tables. Customers stand for sources, events for runs and observations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import lifecycle
from millrace.operators.latest import latest_per_key, with_latest
from millrace.sources.tables import load, micros

from .registry import query

AS_OF = "2024-01-31 00:00:00"


@query("""
WITH last AS (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events
)
SELECT c_custkey, c_name, n_name, event_type AS last_status, epoch_us(ts) AS last_seen_us,
       concat(n_name, ':', c_custkey) AS job_key,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'directory' WHEN c_mktsegment IN ('MACHINERY', 'FURNITURE') THEN 'board' ELSE 'vendor' END AS origin,
       CASE WHEN event_type IS NULL THEN 'unknown' WHEN event_type = 'error' THEN 'low' ELSE 'high' END AS status_confidence
FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN last ON user_id = c_custkey AND k = 1
""")
def inventory_latest_status(spark, sf):
    events = load(spark, sf, "events").select("user_id", "event_id", "event_type", micros("ts").alias("last_seen_us"))
    rows = with_latest(load(spark, sf, "customer"), events, "c_custkey", "user_id", ["last_seen_us", "event_id"], ["event_type", "last_seen_us"])
    rows = rows.join(F.broadcast(load(spark, sf, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))  # a fixed table of nations
    origin = F.when(F.col("c_mktsegment") == "BUILDING", "directory").when(F.col("c_mktsegment").isin("MACHINERY", "FURNITURE"), "board").otherwise("vendor")
    confidence = F.when(F.col("event_type").isNull(), "unknown").when(F.col("event_type") == "error", "low").otherwise("high")
    return rows.select(
        "c_custkey", "c_name", "n_name", F.col("event_type").alias("last_status"), "last_seen_us", F.concat_ws(":", "n_name", "c_custkey").alias("job_key"), origin.alias("origin"), confidence.alias("status_confidence")
    )


@query("SELECT DISTINCT ON (user_id, event_type) user_id, event_type, event_id, value FROM events ORDER BY user_id, event_type, ts DESC, event_id DESC")
def latest_per_key_distinct_on(spark, sf):
    return latest_per_key(load(spark, sf, "events"), ["user_id", "event_type"], ["ts", "event_id"], ["event_id", "value"])


@query("""
SELECT c_custkey, e.event_id, e.value FROM customer LEFT JOIN LATERAL (
    SELECT event_id, value FROM events WHERE user_id = c_custkey AND event_type = 'purchase' ORDER BY ts DESC, event_id DESC LIMIT 1
) e ON true
""")
def lateral_latest_purchase(spark, sf):
    events = load(spark, sf, "events").where("event_type = 'purchase'")
    return with_latest(load(spark, sf, "customer").select("c_custkey"), events, "c_custkey", "user_id", ["ts", "event_id"], ["event_id", "value"])


def _weeks(spark, sf):
    events = load(spark, sf, "events")
    keys, values = ["user_id", "event_type"], ["value", "props"]
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")

    def state(rows):
        last = latest_per_key(rows, keys, ["ts", "event_id"], values)
        return last.select(*keys, F.sha2(F.col("props"), 256).alias("content_hash"))

    return state(events.where(F.col("ts") < cut)), state(events.where(F.col("ts") >= cut)), keys


@query("""
WITH s AS (
    SELECT user_id, event_type, ts >= TIMESTAMP '2024-01-15' AS later, sha256(props) AS h,
           row_number() OVER (PARTITION BY user_id, event_type, ts >= TIMESTAMP '2024-01-15' ORDER BY ts DESC, event_id DESC) AS k
    FROM events
), a AS (SELECT * FROM s WHERE k = 1 AND NOT later), b AS (SELECT * FROM s WHERE k = 1 AND later)
SELECT count(*) FILTER (a.user_id IS NULL) AS added,
       count(*) FILTER (a.user_id IS NOT NULL AND b.user_id IS NOT NULL AND a.h <> b.h) AS updated,
       count(*) FILTER (a.user_id IS NOT NULL AND b.user_id IS NOT NULL AND a.h = b.h) AS unchanged,
       count(*) FILTER (b.user_id IS NULL) AS missed
FROM a FULL JOIN b ON a.user_id = b.user_id AND a.event_type = b.event_type
""")
def snapshot_diff_counters(spark, sf):
    before, after, keys = _weeks(spark, sf)
    return lifecycle.diff_counters(lifecycle.diff(before, after, keys, "content_hash"))


@query("""
WITH days AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events),
last AS (SELECT max(CAST(ts AS DATE)) AS m FROM events),
gaps AS (
    SELECT user_id, d, coalesce(lead(d) OVER w, m + 1) - d - 1 AS g, lead(d) OVER w IS NULL AS final FROM days, last WINDOW w AS (PARTITION BY user_id ORDER BY d)
)
SELECT user_id, CAST(min(d) AS VARCHAR) AS first_day, CAST(max(d) AS VARCHAR) AS last_day, count(*) FILTER (g >= 2) AS closures,
       count(*) FILTER (g >= 2 AND NOT final) AS reactivations, CAST(sum(g) AS BIGINT) AS missed,
       CAST(max(least(g, 2)) FILTER (final) AS INTEGER) AS misses, max(CASE WHEN g >= 2 THEN 'closed' ELSE 'active' END) FILTER (final) AS status
FROM gaps GROUP BY user_id
""")
def two_miss_lifecycle(spark, sf):
    seen = load(spark, sf, "events").select("user_id", F.to_date("ts").alias("day"))
    history = lifecycle.presence_history(seen.distinct(), "user_id", "day", seen.agg(F.max("day")).scalar())
    return history.withColumns({c: F.col(c).cast("string") for c in ("first_day", "last_day")})


@query(f"""
SELECT event_type, count(*) AS n, max(event_id) AS last_event FROM events
WHERE event_type <> 'view' OR ts >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY GROUP BY event_type
""")
def observation_freshness_filter(spark, sf):
    fresh = F.col("ts") >= F.expr(f"TIMESTAMP_NTZ '{AS_OF}' - INTERVAL 7 DAYS")
    rows = load(spark, sf, "events").where((F.col("event_type") != "view") | fresh)
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last_event"))


@query("""
SELECT s_suppkey, s_name, n_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey AND n_regionkey = 1
""")
def left_join_predicate_in_on(spark, sf):
    nation = load(spark, sf, "nation")
    return load(spark, sf, "supplier").join(nation, (F.col("s_nationkey") == F.col("n_nationkey")) & (F.col("n_regionkey") == 1), "left").select("s_suppkey", "s_name", "n_name")


@query("""
SELECT 'customers_without_orders' AS what, count(*) AS n FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)
UNION ALL SELECT 'customers_with_open_orders', count(*) FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'O')
UNION ALL SELECT 'parts_never_ordered', count(*) FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey)
UNION ALL SELECT 'lines_without_order', count(*) FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey)
UNION ALL SELECT 'users_without_customer', count(DISTINCT user_id) FROM events WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = user_id)
""")
def missing_key_semi_anti(spark, sf):
    customer, orders, part = (load(spark, sf, t) for t in ("customer", "orders", "part"))
    lines, events = load(spark, sf, "lineitem"), load(spark, sf, "events")
    users = events.select("user_id").distinct()

    def count(name, rows):
        return rows.agg(F.lit(name).alias("what"), F.count(F.lit(1)).alias("n"))

    open_orders = orders.where("o_orderstatus = 'O'")
    parts = [
        count("customers_without_orders", customer.join(orders, F.col("c_custkey") == F.col("o_custkey"), "left_anti")),
        count("customers_with_open_orders", customer.join(open_orders, F.col("c_custkey") == F.col("o_custkey"), "left_semi")),
        count("parts_never_ordered", part.join(lines, F.col("p_partkey") == F.col("l_partkey"), "left_anti")),
        count("lines_without_order", lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti")),
        count("users_without_customer", users.join(customer, F.col("user_id") == F.col("c_custkey"), "left_anti")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("""
WITH s AS (SELECT *, lag(value) OVER w AS v, lag(event_type) OVER w AS t FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT count(*) FILTER (value IS DISTINCT FROM v) AS value_moved, count(*) FILTER (event_type IS DISTINCT FROM t) AS type_moved,
       count(*) FILTER (event_type IS NOT DISTINCT FROM t) AS type_same FROM s
""")
def null_safe_mismatch(spark, sf):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = load(spark, sf, "events").select("value", "event_type", F.lag("value").over(w).alias("v"), F.lag("event_type").over(w).alias("t"))
    same_value, same_type = F.col("value").eqNullSafe(F.col("v")), F.col("event_type").eqNullSafe(F.col("t"))
    return rows.agg(F.count_if(~same_value).alias("value_moved"), F.count_if(~same_type).alias("type_moved"), F.count_if(same_type).alias("type_same"))


@query("""
SELECT c_nationkey AS key, 'customer' AS via FROM customer WHERE c_acctbal < 0 UNION SELECT s_nationkey, 'supplier' FROM supplier WHERE s_acctbal < 0
""")
def linked_sources_union(spark, sf):
    a = load(spark, sf, "customer").where("c_acctbal < 0").select(F.col("c_nationkey").alias("key"), F.lit("customer").alias("via"))
    b = load(spark, sf, "supplier").where("s_acctbal < 0").select(F.col("s_nationkey").alias("key"), F.lit("supplier").alias("via"))
    return a.union(b).distinct()


@query("""
SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT user_id FROM events WHERE event_type = 'purchase')
UNION (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT user_id FROM events WHERE event_type = 'error')
""")
def sources_to_sync_sets(spark, sf):
    events = load(spark, sf, "events")
    buyers = events.where("event_type = 'purchase'").select(F.col("user_id").alias("c_custkey"))
    first = load(spark, sf, "customer").select("c_custkey").join(buyers, "c_custkey", "left_semi")
    done = load(spark, sf, "orders").where("o_orderstatus = 'F'").select("o_custkey")
    return first.union(done.intersect(events.where("event_type = 'error'").select("user_id"))).distinct()


@query("""
SELECT o_orderkey, coalesce(c.c_custkey, s.s_suppkey) AS owner, CASE WHEN c.c_custkey IS NOT NULL THEN 'id' WHEN s.s_suppkey IS NOT NULL THEN 'fallback' ELSE 'none' END AS via
FROM orders LEFT JOIN customer c ON c.c_custkey = o_custkey AND c.c_acctbal > 0 LEFT JOIN supplier s ON s.s_suppkey = o_custkey
""")
def prioritized_resolution(spark, sf):
    orders = load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    customer = load(spark, sf, "customer").where("c_acctbal > 0").select("c_custkey")
    supplier = load(spark, sf, "supplier").select("s_suppkey")
    both = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left").join(supplier, F.col("o_custkey") == F.col("s_suppkey"), "left")
    via = F.when(F.col("c_custkey").isNotNull(), "id").when(F.col("s_suppkey").isNotNull(), "fallback").otherwise("none")
    return both.select("o_orderkey", F.coalesce("c_custkey", "s_suppkey").alias("owner"), via.alias("via"))


@query("""
WITH o AS (SELECT c_custkey AS k, c_name AS name, c_acctbal AS v FROM customer), n AS (SELECT s_suppkey AS k, s_name AS name, s_acctbal AS v FROM supplier)
SELECT coalesce(n.k, o.k) AS k, coalesce(n.name, o.name) AS name, CASE WHEN n.k IS NOT NULL THEN n.v ELSE o.v END AS v,
       CASE WHEN o.k IS NULL THEN 'inserted' WHEN n.k IS NULL THEN 'kept' ELSE 'updated' END AS did
FROM o FULL JOIN n ON o.k = n.k
""")
def upsert_do_update(spark, sf):
    from millrace.sources.sinks import upsert

    old = load(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("v"))
    new = load(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("v"))
    return upsert(old, new, ["k"], action="did")


@query("""
SELECT c_custkey AS k, c_name AS name FROM customer
UNION ALL SELECT s_suppkey + 100, s_name FROM supplier WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = s_suppkey + 100)
""")
def upsert_do_nothing(spark, sf):
    from millrace.sources.sinks import insert_new

    old = load(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    new = load(spark, sf, "supplier").select((F.col("s_suppkey") + 100).alias("k"), F.col("s_name").alias("name"))
    return insert_new(old, new, ["k"])
