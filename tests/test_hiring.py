"""Hiring verification: links, board pages, titles and the walk itself."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import hiring


@pytest.mark.parametrize(
    "url,want",
    [
        ("https://jobs.lever.co/acme", True), ("https://jobs.lever.co/", False), ("https://clever.co/acme", False), ("https://wellfound.com/company/x", True), ("https://wellfound.com/jobs", False), ("https://app.dover.com/dover/careers/1", True),
        ("https://boards.greenhouse.io/acme", True), ("https://boards.greenhouse.io/embed/job_board?for=acme", True), ("https://boards.greenhouse.io/embed/job_board", False), ("https://x.bamboohr.com/", True), ("https://x.bamboohr.com/about", False),
        ("https://x.bamboohr.com/a/careers", True), ("https://bamboohr.com/careers", False), ("https://www.x.recruitee.com", True), ("https://x.workable.com/", True), ("https://apply.workable.com/", False), ("https://apply.workable.com/x", True),
        ("https://acme.com/jobs", False), ("nonsense", False), (None, False),
    ],
)
def test_board_pages(spark, url, want):
    assert spark.createDataFrame([(url,)], "u string").select(hiring.is_board_page(F.col("u"))).first()[0] is want


@pytest.mark.parametrize(
    "url,label,want",
    [
        ("https://acme.com/careers", "", 5 + 16 + 8), ("https://jobs.acme.com/x", "", 5 + 16 + 8), ("https://acme.com/about", "Work with us", 5 + 8), ("https://acme.com/about", "", 0), ("https://acme.com/blog", "", 0), ("https://acme.com/blog/hiring", "", 13),
        ("https://other.com/careers", "", 0), ("https://jobs.lever.co/acme", "", 14 + 16 + 8), ("https://notacme.com/jobs", "", 0),
    ],
)
def test_link_scores(spark, url, label, want):
    rows = spark.createDataFrame([("https://www.acme.com", url, label)], "h string, u string, l string")
    assert rows.select(hiring.link_score(F.col("h"), F.col("u"), F.col("l"))).first()[0] == want


def test_titles(spark):
    texts = ["Senior Backend Engineer", "We seek a Full-Stack Product Engineer and an engineer, data platform. Also a senior backend engineer Remote", "Lead engineer privacy", "nothing here", "Staff " + "x " * 5 + "engineer"]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").orderBy("k").select(hiring.role_titles(F.col("t")))
    got = [r[0] for r in rows.collect()]
    assert got[0] == ["Senior Backend Engineer"] and got[2] == ["Lead engineer"] and got[3] == got[4] == []
    assert got[1][1] == "Full-Stack Product Engineer and an engineer" and "senior backend engineer" in got[1]


def test_walk(spark):
    pages = [
        ("https://a.example/", "<a href='/jobs'>Jobs</a> <a href=\"/jobs/\">again</a><a href='/careers'>C</a><a href='https://jobs.lever.co/a'>L</a>"),
        ("https://a.example/jobs", "Platform Engineer <script>Senior Data Engineer</script>"), ("https://a.example/careers", "We are not hiring"), ("https://jobs.lever.co/a", "AI Scientist"),
        ("https://b.example", "We are hiring: Founding Engineer"), ("https://c.example", "<a href='/careers'>x</a>"), ("https://d.example", "Principal Engineer of nothing"),
    ]
    companies = [(1, "https://a.example"), (2, "https://b.example/"), (3, "https://c.example"), (4, "https://d.example"), (5, "https://gone.example"), (6, None)]
    found = hiring.verify(spark.createDataFrame(companies, "company_id int, website string"), spark.createDataFrame(pages, "url string, html string"), "platform work")
    got = {r.company_id: r for r in found.collect()}
    assert (got[1].verified_hiring_status, got[1].verified_roles, got[1].role_fit, got[1].pages_used, got[1].career_page_url) == ("hiring", ["AI Scientist", "Platform Engineer"], "strong", 3, "https://jobs.lever.co/a")
    assert (got[2].verified_hiring_status, got[2].verified_roles, got[2].verification_source_url) == ("hiring", ["We are hiring: Founding Engineer", "Founding Engineer"], "https://b.example/")
    assert (got[3].verified_hiring_status, got[3].error, got[3].confidence) == ("unknown", "a page is missing", 0.0)
    assert (got[4].verified_hiring_status, got[4].confidence, got[4].verification_source_url) == ("unknown", 0.25, "https://d.example")
    assert got[5].error == "a page is missing" and got[6].error == "no website"
