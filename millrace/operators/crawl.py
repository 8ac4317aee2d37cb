"""Board tokens seen in crawls: evidence per crawl, the union over crawls, and what each input added."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import urls

EVIDENCE = "input_order int, crawl_id string, board_token string, example_observed_url string, observation_count bigint, first_observed_at timestamp, last_observed_at timestamp"


def index_candidates(index: DataFrame, crawl: str, subset: str, hosts: list[str], token: Column | None = None) -> DataFrame:
    """Tokens of a crawl's index (url, url_host_name, fetch_status, fetch_time, partitioned by crawl and subset): the partition and host filters reach the scan."""
    rows = index.where((F.col("crawl") == crawl) & (F.col("subset") == subset) & F.col("url_host_name").isin(*hosts) & (F.col("fetch_status") == 200))
    found = F.nullif(F.coalesce(urls.parameter(F.col("url"), "for"), urls.token(F.col("url"))) if token is None else token, F.lit(""))
    rows = rows.withColumn("board_token", F.lower(found)).where("board_token IS NOT NULL")
    return rows.groupBy("board_token").agg(
        F.min("url").alias("example_observed_url"), F.count(F.lit(1)).alias("observation_count"), F.min("fetch_time").alias("first_observed_at"), F.max("fetch_time").alias("last_observed_at")
    )


def fold_tokens(rows: DataFrame) -> DataFrame:
    """One row a crawl and lower-case token: counts add up, the least URL and the outer times stay."""
    return rows.groupBy("crawl_id", F.lower("board_token").alias("board_token")).agg(
        F.min("input_order").alias("input_order"),
        F.min("example_observed_url").alias("example_observed_url"),
        F.sum("observation_count").alias("observation_count"),
        F.min("first_observed_at").alias("first_observed_at"),
        F.max("last_observed_at").alias("last_observed_at"),
    )


def union_of_crawls(evidence: DataFrame) -> DataFrame:
    """A row a token over all crawls. Crawl ids end in year and week, zero-padded, so their order is that of their text."""
    ids = F.array_sort(F.collect_set("crawl_id"))  # as many as there are crawls
    rows = fold_tokens(evidence).groupBy("board_token").agg(
        F.min("example_observed_url").alias("example_observed_url"),
        F.sum("observation_count").alias("observation_count"),
        F.min("first_observed_at").alias("first_observed_at"),
        F.max("last_observed_at").alias("last_observed_at"),
        ids.alias("crawl_ids"),
    )
    return rows.withColumns({"first_seen_crawl": F.col("crawl_ids")[0], "last_seen_crawl": F.element_at("crawl_ids", -1), "crawl_count": F.size("crawl_ids")})


def marginal(evidence: DataFrame) -> DataFrame:
    """input_order, tokens, new_tokens: how many tokens each input has, and how many no earlier one had."""
    first = evidence.groupBy(F.lower("board_token").alias("token")).agg(F.min("input_order").alias("input_order"))
    new = first.groupBy("input_order").agg(F.count(F.lit(1)).alias("new_tokens"))
    every = evidence.groupBy("input_order").agg(F.countDistinct(F.lower("board_token")).alias("tokens"))
    return every.join(new, "input_order", "left").select("input_order", "tokens", F.coalesce("new_tokens", F.lit(0)).alias("new_tokens"))
