"""How well companies fit a profile: points, their reasons, and one order over all."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import text
from millrace.operators.ranks import numbered

# Groups of signals with their points; a group counts if the company's text and the profile's both have one of its terms.
SIGNALS = {
    "Backend systems": (16, ("backend", "infrastructure", "platform", "api", "developer tools", "devtools", "cloud", "distributed")),
    "AI/LLM": (7, ("ai", "artificial intelligence", "llm", "large language model", "agent", "agents", "openai", "mcp", "machine learning")),
    "Data engineering": (9, ("data", "etl", "pipeline", "warehouse", "analytics", "ingestion", "observability")),
    "Full-stack product": (3, ("full-stack", "full stack", "react", "next.js", "typescript", "product engineer")),
    "Open-source leverage": (7, ("open source", "open-source", "github", "sdk", "framework", "library")),
    "Workflow automation": (6, ("automation", "workflow", "operations", "copilot", "assistant", "integration")),
}
# Regions, years, and the points and reasons of what a company's entry says.
REGIONS = ("remote", "pakistan", "india", "asia", "south asia", "mena", "middle east")
RECENT = ("2024", "2025", "2026")
REASONS = {
    "prototype": "Existing prototype score ",
    "active": "Active YC company",
    "website": "Has a live website to inspect",
    "hiring": "YC marks the company as hiring",
    "tiny": "Tiny team where a strong prototype can stand out",
    "small": "Small team with likely founder access",
    "direct": "Small enough for direct senior-engineer outreach",
    "large": "Larger team makes prototype outreach less asymmetric",
    "region": "Location looks remote/APAC-friendly enough to try",
    "recent": "Recent YC batch likely still founder-led",
    "general": "General senior engineering fit, but no sharp skill overlap signal",
}
MOST_PROTOTYPE, MOST_REASONS, MOST_MATCHES = 50, 7, 6
#: What a company's text is made of; lists are joined by spaces.
TEXT = ("name", "one_liner", "industry", "subindustry", "industries", "tags", "regions", "all_locations", "prototype_angle")


def has_any(value: Column, terms: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for term in terms:
        found = found | text.signal(value, term)
    return found


def company_text(companies: DataFrame) -> Column:
    kinds = dict(companies.dtypes)
    parts = [F.concat_ws(" ", c) if kinds[c].startswith("array") else F.col(c) for c in TEXT]
    return F.lower(F.concat_ws(" ", *[F.nullif(p, F.lit("")) for p in parts]))


def fit(companies: DataFrame, profile: str) -> DataFrame:
    """The companies with fit_score, fit_reasons and candidate_strength_matches. ``profile``: all text of the candidate's profile.

    companies: the columns of TEXT (industries, tags and regions as lists), prototype_score, directory_url, status, website, is_hiring, team_size, batch.
    """
    rows = companies.withColumn("_text", company_text(companies))
    size, start = F.col("team_size"), F.least(F.coalesce("prototype_score", F.lit(0)), F.lit(MOST_PROTOTYPE))
    given = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    recent = F.lit(False)
    for year in RECENT:
        recent = recent | F.contains(F.coalesce("batch", F.lit("")), F.lit(year))
    region = F.lit(False)
    for term in REGIONS:
        region = region | F.contains("_text", F.lit(term))
    rules: list[tuple[Column, int, Column | str]] = [
        (given("directory_url") & (F.lower(F.coalesce("status", F.lit(""))) == "active"), 8, REASONS["active"]),
        (given("website"), 4, REASONS["website"]),
        (F.coalesce("is_hiring", F.lit(False)), 8, REASONS["hiring"]),
        (size <= 5, 14, REASONS["tiny"]),
        ((size > 5) & (size <= 10), 10, REASONS["small"]),
        ((size > 10) & (size <= 25), 6, REASONS["direct"]),
        (size > 75, -8, REASONS["large"]),
        (region, 4, REASONS["region"]),
        (recent, 5, REASONS["recent"]),
    ]
    score, reasons = start, [F.when(start != 0, F.concat(F.lit(REASONS["prototype"]), start))]
    for test, points, reason in rules:
        test = F.coalesce(test, F.lit(False))
        score = score + F.when(test, points).otherwise(0)
        reasons.append(F.when(test, reason))
    matches, own = [], profile.lower()
    for label, (points, terms) in SIGNALS.items():
        wanted = any(_in(own, t) for t in terms)
        test = has_any(F.col("_text"), terms) if wanted else F.lit(False)
        score = score + F.when(test, points).otherwise(0)
        matches.append(F.when(test, label))
    found = F.array_compact(F.array(*matches))
    reasons.append(F.when(F.size(found) == 0, REASONS["general"]))
    rows = rows.withColumns({"fit_score": F.greatest(score, F.lit(0)).cast("int"), "fit_reasons": F.slice(F.array_compact(F.array(*reasons)), 1, MOST_REASONS), "candidate_strength_matches": F.slice(found, 1, MOST_MATCHES)})
    return rows.drop("_text")


def _in(value: str, term: str) -> bool:
    return bool(re.search(rf"\b{re.escape(term)}\b", value)) if len(term) <= 3 and term.isalpha() else term in value


def ranked(companies: DataFrame, profile: str, max_team_size: int | None = 25, require_website: bool = True) -> DataFrame:
    """The companies that come into question, with ``fit`` and ``rank``: best first, ties by slug (unique)."""
    rows = companies
    if require_website:
        rows = rows.where(F.coalesce("website", F.lit("")) != "")
    if max_team_size is not None:
        rows = rows.where(F.col("team_size").isNull() | (F.col("team_size") <= max_team_size))
    return numbered(fit(rows, profile), [F.desc("fit_score"), F.col("slug")])


# Points of a verification, a role's fit, and a role's status (where no opportunity score has been added).
VERIFIED = {"hiring": 20, "not_hiring": -16}
ROLE_FIT = {"strong": 12, "possible": 5}


def reranked(targets: DataFrame, role_points: dict[str, int] | None = None) -> DataFrame:
    """Targets (slug, fit_score, rank, verified_hiring_status, role_fit) with the points of their verification, in the new order; ties keep the old one."""
    score = F.coalesce("fit_score", F.lit(0))
    tables = [("verified_hiring_status", VERIFIED), ("role_fit", ROLE_FIT)] + ([("role_match_status", role_points)] if role_points else [])
    for column, points in tables:
        for value, n in points.items():
            score = score + F.when(F.col(column) == value, n).otherwise(0)
    rows = targets.withColumn("fit_score", F.greatest(score, F.lit(0)).cast("int")).withColumnRenamed("rank", "_before")
    return numbered(rows, [F.desc("fit_score"), F.col("_before")]).drop("_before")
