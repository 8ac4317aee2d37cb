"""Whether a company hires, by its saved pages: the home page and the best links of it that lead to pages for jobs.

A bounded walk of two hops as joins: home pages by their URL, their links scored and cut to the best few of each company, and those pages by URL. Text, titles of roles and signs are read by native regular
expressions from whole pages. A page that is not there ends a company's walk with what is known: nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import text, urls

# Words that lead to jobs, words that lead elsewhere, and sentences that say that there are none.
CAREER_WORDS = ("career", "careers", "job", "jobs", "hiring", "join", "opening", "openings", "roles", "work with us")
ELSEWHERE_WORDS = ("blog", "docs", "documentation", "pricing", "login", "signin", "signup", "privacy", "terms", "twitter", "linkedin", "facebook")
NO_OPENINGS = ("no open roles", "no open positions", "no current openings", "no positions available", "not hiring", "not currently hiring", "we are not hiring", "we're not hiring", "currently no openings")
HOME_MARKERS = ("open roles", "open positions", "job openings", "we are hiring", "we're hiring", "join our team")
ROLE_TERMS = ("ai", "llm", "machine learning", "backend", "full stack", "full-stack", "data engineer", "infrastructure", "platform", "software engineer", "founding engineer", "python", "typescript", "node", "react")
# What a role's title looks like in running text.
ROLE_TITLE = (
    r"(?i)\b((?:founding|senior|staff|principal|lead|full[- ]stack|backend|frontend|software|ai|ml|machine learning|data|platform|infrastructure|product|devops|site reliability|applied ai|research|solutions)"
    r"(?:\s+[a-z/&+-]+){0,4}\s+(?:engineer|developer|architect|scientist|lead|manager)|(?:engineer|developer|architect|scientist),\s+[a-z][a-z /&+-]{2,60})\b"
)
# Hosts of boards, each with what its path or query must be like to be a company's own ('' for anything). A host that begins with a dot needs a name before it.
BOARD_PAGES = {
    "wellfound.com": "^/+company/+[^/]",
    "app.dover.com": "^/+(jobs/+[^/]|dover/+careers/+[^/])",
    "boards-api.greenhouse.io": "^/+v1/+boards/+[^/]",
    "jobs.ashbyhq.com": "^/+[^/]",
    "jobs.eu.ashbyhq.com": "^/+[^/]",
    "jobs.lever.co": "^/+[^/]",
    "jobs.eu.lever.co": "^/+[^/]",
    "jobs.smartrecruiters.com": "^/+[^/]",
    "careers.smartrecruiters.com": "^/+[^/]",
    "apply.workable.com": "^/+[^/]",
    ".workdayjobs.com": "^/+[^/]",
    ".myworkdayjobs.com": "^/+[^/]",
    ".bamboohr.com": "^(/*$|.*/careers(/|$))",
    ".recruitee.com": "",
    ".workable.com": "",
    ".applytojob.com": "",
}
# Hosts of boards whose first path segment is the company, unless it is an embedded board, which names it in a parameter.
EMBEDDING_HOSTS = ("boards.greenhouse.io", "boards.eu.greenhouse.io", "job-boards.greenhouse.io", "job-boards.eu.greenhouse.io")
MOST_PAGES, MOST_ROLES = 3, 12


def is_board_page(url: Column) -> Column:
    """Whether the URL is a company's own page on a job board, by host and path, not a page of the board's vendor."""
    host, path = F.regexp_replace(urls.host(url), r"^www\.", ""), urls.part(url, 5)
    own = F.when(host.isin(*EMBEDDING_HOSTS), F.when(path.rlike("^/+(?!embed(/|$))[^/]"), True).otherwise(urls.parameter(url, "for").isNotNull()))
    for name, pattern in BOARD_PAGES.items():
        there = F.endswith(host, F.lit(name)) if name.startswith(".") else host == name
        own = own.when(there, path.rlike(pattern) if pattern else F.lit(True))
    return F.coalesce(own, F.lit(False))


def page_key(url: Column) -> Column:
    """The form in which links and pages meet."""
    return urls.resolve_href(url, url)


def _any(value: Column, words: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for w in words:
        found = found | F.contains(value, F.lit(w))
    return found


def link_score(home: Column, url: Column, label: Column) -> Column:
    """How much a link of a home page looks like one to jobs; 0 for those that do not count."""
    domain = lambda u: F.regexp_replace(F.lower(F.regexp_extract(u, "^[a-zA-Z]+://([^/?#]*)", 1)), r"^www\.", "")
    own, there, both = domain(home), domain(url), F.lower(F.concat_ws(" ", url, label))
    same = (own == there) | F.endswith(there, F.concat(F.lit("."), own))
    board, speaks = is_board_page(url), _any(both, CAREER_WORDS)
    score = F.when(same, 5).otherwise(0) + F.when(board, 14).otherwise(0)
    for w in CAREER_WORDS:
        score = score + F.when(F.contains(both, F.lit(w)), 8).otherwise(0)
    score = score + F.when(F.contains(both, F.lit("/careers")) | F.contains(both, F.lit("/jobs")), 8).otherwise(0) - F.when(F.contains(there, F.lit("linkedin.com")), 6).otherwise(0)
    none = (~same & ~board) | (same & ~board & ~speaks) | (_any(both, ELSEWHERE_WORDS) & ~speaks)
    return F.when(none, 0).otherwise(score)


def anchors(html: Column) -> Column:
    """The page's links in order: array<struct<place, href, label>>."""
    whole = r"(?is)<a\b[^>]*?\shref\s*=\s*(?:\"[^\"]*\"|'[^']*')[^>]*>.*?</a\s*>"
    found = F.regexp_extract_all(html, F.lit(whole), 0)
    href = lambda a: F.regexp_extract(a, r"(?is)^<a\b[^>]*?\shref\s*=\s*[\"']([^\"']*)", 1)
    return F.transform(found, lambda a, k: F.struct(k.alias("place"), href(a).alias("href"), text.collapse(F.regexp_replace(a, "<[^>]+>", " ")).alias("label")))


def clean_title(title: Column) -> Column:
    out = F.regexp_replace(F.regexp_replace(F.regexp_replace(title, r"^\[[^\]]+\]\s*", ""), r"^#+\s*", ""), r"(?U)\s+", " ")
    return F.trim(F.regexp_replace(out, r"(?i)\s+(remote|hybrid|onsite|full[- ]time|part[- ]time)$", ""), F.lit(" -|:•"))


def role_titles(page: Column) -> Column:
    """Titles of roles in a page's text, each once, in order: the whole text if it is a short line, then every match."""
    line = F.trim(text.collapse(page), F.lit(" -*•|"))
    short = (F.char_length(line) <= 140) & ~_any(F.lower(line), ("privacy", "terms", "cookie", "subscribe")) & line.rlike(ROLE_TITLE)
    found = F.concat(F.when(short, F.array(line)).otherwise(F.array().cast("array<string>")), F.regexp_extract_all(page, F.lit(ROLE_TITLE), 1))
    cleaned = F.filter(F.transform(found, clean_title), lambda t: F.char_length(t).between(4, 100))
    return F.slice(text.distinct_folded(cleaned), 1, MOST_ROLES)


def verify(companies: DataFrame, pages: DataFrame, profile: str, most_pages: int = MOST_PAGES) -> DataFrame:
    """companies (company_id, website) with verified_hiring_status (hiring, not_hiring, unknown), career_page_url, verified_roles, role_fit, verification_source_url, confidence, pages_used and error.

    pages: url, html, one row a URL (of several that are the same in their key the first by URL counts).
    """
    known = pages.withColumn("_key", page_key(F.col("url"))).where("_key IS NOT NULL").groupBy("_key").agg(F.min_by("html", "url").alias("_html"))
    asked = companies.select("company_id", "website", page_key(F.col("website")).alias("_key"))
    homes = asked.join(known, "_key", "left")
    links = homes.where("_html IS NOT NULL").select("company_id", "website", F.inline(anchors(F.col("_html"))))
    links = links.withColumn("_key", urls.resolve_href(F.col("website"), F.col("href"))).where("_key IS NOT NULL")
    links = links.withColumn("score", link_score(F.col("website"), F.col("_key"), F.col("label"))).where("score > 0")
    links = links.groupBy("company_id", "website", "_key").agg(F.max("score").alias("score"), F.min("place").alias("place"))
    links = links.withColumn("_at", F.row_number().over(Window.partitionBy("company_id").orderBy(F.desc("score"), "place"))).where(F.col("_at") < most_pages)
    walked = homes.select("company_id", "website", "_key", "_html", F.lit(0).alias("_at")).unionByName(links.join(known, "_key", "left").select("company_id", "website", "_key", "_html", "_at"))
    visible = text.visible_text(F.col("_html"))
    path = F.lower(F.concat_ws(" ", F.regexp_extract("_key", "^[a-zA-Z]+://[^/?#]*([^?#]*)", 1), F.regexp_extract("_key", r"\?(.*)$", 1)))
    lower = F.lower(F.col("_text"))
    at_home = (F.col("_at") == 0) & F.regexp_extract("_key", "^[a-zA-Z]+://[^/?#]*([^?#]*)", 1).isin("", "/")
    likely = is_board_page(F.col("_key")) | _any(path, CAREER_WORDS) | (at_home & _any(lower, HOME_MARKERS))
    read = walked.withColumn("_text", F.coalesce(visible, F.lit(""))).withColumn("_roles", F.when(likely, role_titles(F.col("_text"))).otherwise(F.array().cast("array<string>")))
    read = read.withColumns({"_none": _any(lower, NO_OPENINGS), "_lost": F.col("_html").isNull()})
    # A company has ``most_pages`` at most.
    first = lambda when: F.min(F.when(when, F.struct("_at", "_key")))["_key"]
    each = read.groupBy("company_id").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_at", "_roles"))), lambda p: p["_roles"])).alias("_roles"),
        first(F.size("_roles") > 0).alias("_source"),
        first(F.col("_at") == 1).alias("_career"),
        first(F.col("_none")).alias("_negative"),
        F.max("_lost").alias("_lost"),
        F.count(F.lit(1)).alias("_pages"),
    )
    roles = F.slice(text.distinct_folded(F.col("_roles")), 1, MOST_ROLES)
    joined, own = F.lower(F.array_join(roles, " ")), profile.lower()
    strong = _any(joined, tuple(t for t in ROLE_TERMS if t in own)) if any(t in own for t in ROLE_TERMS) else F.lit(False)
    hires, lost = F.size("_roles") > 0, F.col("_lost") | F.col("website").isNull()
    out = companies.join(each, "company_id", "left")
    status = F.when(lost, "unknown").when(hires, "hiring").when(F.col("_negative").isNotNull(), "not_hiring").otherwise("unknown")
    fit = F.when(F.col("status") == "hiring", F.when(strong, "strong").otherwise("possible")).otherwise("unknown")
    out = out.withColumn("status", status).withColumn("role_fit", fit)
    hiring, not_hiring = F.col("status") == "hiring", F.col("status") == "not_hiring"
    return out.select(
        *companies.columns,
        F.col("status").alias("verified_hiring_status"),
        F.when(~lost, F.coalesce("_career", F.when(hiring, F.col("_source")).when(not_hiring, F.col("_negative")))).alias("career_page_url"),
        F.when(hiring, roles).otherwise(F.array().cast("array<string>")).alias("verified_roles"),
        "role_fit",
        F.when(~lost, F.when(hiring, F.col("_source")).when(not_hiring, F.col("_negative")).otherwise(F.coalesce("_career", "website"))).alias("verification_source_url"),
        F.when(lost, 0.0).when(hiring & (F.col("role_fit") == "strong"), 0.9).when(hiring, 0.78).when(not_hiring, 0.72).otherwise(0.25).alias("confidence"),
        F.coalesce("_pages", F.lit(0)).alias("pages_used"),
        F.when(F.col("website").isNull(), "no website").when(F.col("_lost"), "a page is missing").alias("error"),
    )
