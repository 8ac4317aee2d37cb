"""Crawl, metrics and freshness operators on small inputs."""

from datetime import datetime

from pyspark.sql import functions as F

from millrace.operators import crawl, metrics


def stamp(day):
    return datetime(2024, 1, day)


def test_union_of_crawls(spark):
    rows = [
        (1, "CC-MAIN-2024-10", "Acme", "u2", 3, stamp(2), stamp(3)),
        (1, "CC-MAIN-2024-10", "acme", "u1", 2, stamp(1), stamp(2)),
        (2, "CC-MAIN-2024-05", "acme", "u3", 1, stamp(5), stamp(9)),
        (2, "CC-MAIN-2024-05", "beta", "u4", 1, stamp(5), stamp(5)),
    ]
    evidence = spark.createDataFrame(rows, crawl.EVIDENCE)
    got = {r.board_token: r for r in crawl.union_of_crawls(evidence).collect()}
    a = got["acme"]
    assert (a.example_observed_url, a.observation_count, a.first_observed_at, a.last_observed_at) == ("u1", 6, stamp(1), stamp(9))
    assert (a.crawl_ids, a.first_seen_crawl, a.last_seen_crawl, a.crawl_count) == (["CC-MAIN-2024-05", "CC-MAIN-2024-10"], "CC-MAIN-2024-05", "CC-MAIN-2024-10", 2)
    assert sorted(map(tuple, crawl.marginal(evidence).collect())) == [(1, 1, 1), (2, 2, 1)]


def test_index_candidates(spark, tmp_path):
    rows = [("https://b.example/Acme/jobs/1", "b.example", 200, stamp(1), "c1", "warc"), ("https://b.example/embed?for=beta", "b.example", 200, stamp(2), "c1", "warc"), ("https://b.example/acme", "b.example", 404, stamp(3), "c1", "warc"), ("https://b.example/acme", "b.example", 200, stamp(4), "c2", "warc")]
    spark.createDataFrame(rows, "url string, url_host_name string, fetch_status smallint, fetch_time timestamp, crawl string, subset string").write.partitionBy("crawl", "subset").parquet(f"{tmp_path}/index")
    found = crawl.index_candidates(spark.read.parquet(f"{tmp_path}/index"), "c1", "warc", ["b.example"])
    assert {(r.board_token, r.observation_count) for r in found.collect()} == {("acme", 1), ("beta", 1)}
    plan = found._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(crawl" in plan and "PushedFilters: [IsNotNull(fetch_status)" in plan.replace("IsNotNull(url_host_name), ", "")


def test_metrics(spark):
    rows = [("a", "p", "https://x.example/1", None, "c1", None), ("a", "p", None, "https://y.example/1", None, "C"), ("b", "", None, None, "c1", None)]
    queues = spark.createDataFrame(rows, "queue string, provider string, apply_url string, posting_url string, company_slug string, company_name string")
    got = {r.queue: r for r in metrics.queue_metrics(queues).collect()}
    assert (got["a"].row_count, got["a"].company_count, got["a"].direct_application_url_coverage, got["a"].selected_url_coverage, got["b"].missing_url_count) == (2, 2, 0.5, 1.0, 1)
    by = {r.provider: (r.a, r.b, r.selected_row_count, r.share_of_selected_rows) for r in metrics.provider_contribution(queues, ["a", "b"]).collect()}
    assert by == {"p": (2, 0, 2, 0.666667), "unknown": (0, 1, 1, 0.333333)}
    checks = spark.createDataFrame([("live",), ("dead",), ("live",), (None,)], "outcome string")
    r = metrics.link_metrics(checks).first()
    assert (r.validation_row_count, r.live_link_count, r.dead_link_rate) == (4, 2, 0.333333)
    assert metrics.link_metrics(checks.where("outcome IS NULL")).first().dead_link_rate is None
    statuses = spark.createDataFrame([(s,) for s in (200, 301, 404, 403, 503, 418)], "s int")
    assert [r[0] for r in statuses.select(metrics.classify_status(F.col("s"))).collect()] == ["live", "unhealthy", "dead", "blocked", "transient_error", "unhealthy"]


def test_freshness_boundary(spark):
    sources = spark.createDataFrame([(1, "a", True, True), (2, "b", True, True), (3, "c", True, True), (4, "d", False, True)], "source_id int, provider string, active boolean, complete boolean")
    runs = [(1, "succeeded", "complete", stamp(1), stamp(2)), (2, "succeeded", "complete", stamp(1), datetime(2024, 1, 1, 23, 59, 59)), (3, "failed", "complete", stamp(2), stamp(2)), (3, "running", "complete", stamp(3), None)]
    frame = spark.createDataFrame(runs, "source_id int, status string, sync_mode string, started_at timestamp, completed_at timestamp")
    got = {r.provider: (r.code, r.running_sync_count) for r in metrics.source_freshness(sources, frame, "2024-01-03").collect()}
    assert got == {"a": (None, 0), "b": ("provider_successful_complete_sync_stale", 0), "c": ("provider_no_successful_complete_sync", 1)}


def test_opportunity_scores(spark):
    from millrace.operators import scoring

    new, old = datetime(2024, 1, 20), datetime(2023, 1, 1)
    rows = [
        ("managed", 1, True, "strong", "global_explicit", "u", new, None),
        ("managed", 2, True, "exclude", "onsite_explicit", "u", new, None),
        ("observed", 1, False, "strong", "pakistan_explicit", "u", new, None),
        ("observed", 1, False, "possible", "remote_unclear", "", old, None),
        ("observed", 2, False, "possible", "remote_unclear", "u", old, new),
        ("none", 1, True, "weak", None, "u", new, None),
        ("weak", 1, False, "weak", None, "u", new, None),
    ]
    jobs = spark.createDataFrame(rows, "company_id string, cluster int, managed boolean, role_match_status string, remote_eligibility string, job_url string, source_at timestamp, observed_at timestamp")
    scores = scoring.opportunity_scores(jobs, "2024-01-31")
    got = {r.company_id: (r.opportunity_score, r.best_remote_eligibility, r.role_match_status) for r in scores.collect()}
    assert got["managed"] == (70 + 2 + 8 + 28, "global_explicit", "strong")
    assert got["observed"] == (64, "pakistan_explicit", "strong")  # 36 + 18 + 6 + 4 + 4, capped
    assert got["none"][0] == -12 and got["weak"][0] == 0
    companies = spark.createDataFrame([("managed", "m", 5), ("none", "n", 3), ("x", "x", 3)], "company_id string, slug string, company_fit_score int")
    assert [(r.slug, r.fit_score, r.rank) for r in scoring.rank_companies(companies, scores).orderBy("rank").collect()] == [("m", 113, 1), ("x", 3, 2), ("n", 0, 3)]


def test_prototype_score(spark):
    from millrace.operators import scoring

    rows = [("Active", True, "w", None, None, ["Remote", "India"], "ai agent"), ("Inactive", None, "", True, 30, None, "")]
    frame = spark.createDataFrame(rows, "status string, is_hiring boolean, website string, top_company boolean, team_size int, regions array<string>, blob string")
    assert [r[0] for r in frame.select(scoring.prototype_score(F.col("blob"))).collect()] == [5 + 3 + 1 + 1 + 6 + 3 + 3 + 3 + 2, 0]
