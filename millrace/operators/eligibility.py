"""Remote eligibility of postings: seven statuses by an ordered list of rules, compiled to one CASE over native regular expressions.

Only the test whether a requirement is called optional nearby needs positions of matches; it runs in an Arrow UDF that gets just those texts in which
the requirement was found natively, and null for all others.

Defined results: null counts as empty; letters are compared in lower case; whole texts are searched. A posting without any evidence is
``no_remote_evidence``. All columns of ``jobs`` are kept, but for those that have the names of the two made here. The texts of evidence are not made.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from millrace.functions import remote_terms as R

FLAGS = "(?iudU)"
STATUS, REASON = "remote_eligibility_status", "remote_eligibility_reason"
#: Fields of the structured evidence that ``classify`` can be told of, and their types.
EVIDENCE = {"workplace_type": "string", "is_remote": "boolean", "scope_kind": "string", "countries": "array<string>", "primary_label": "string", "labels": "array<string>", "eligibility": "string"}


def found(text: Column, patterns: tuple[str, ...] | str) -> Column:
    patterns = (patterns,) if isinstance(patterns, str) else patterns
    return text.rlike(FLAGS + "|".join(f"(?:{p})" for p in patterns))


def of_regions(contexts: tuple[str, ...], regions: tuple[str, ...]) -> tuple[str, ...]:
    """The contexts, each around any of the regions."""
    return tuple(c.format("|".join(regions)) for c in contexts)


def plain(text: Column) -> Column:
    """Words of a-z and 0-9 with one space between them."""
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def whole(text: Column, patterns: tuple[str, ...]) -> Column:
    return plain(text).rlike("^(?:" + "|".join(f"(?:{p})" for p in patterns) + ")$")


def is_global_location(location: Column) -> Column:
    """Whether one of the alternatives of a label (apart by ; | or a new line) is worldwide and nothing else."""
    return F.exists(F.split(location, r"[;|\n]+"), lambda part: whole(part, R.GLOBAL_REMOTE_LOCATION_PATTERNS))


def global_claim(text: Column) -> Column:
    """A worldwide claim about the role, once spells abroad of some days a year are put aside."""
    return found(F.regexp_replace(text, FLAGS + R.NON_ROLE_GLOBAL_REMOTE_PATTERNS[0], " "), R.GLOBAL_REMOTE_CLAIM_PATTERNS)


def says_remote(title: Column) -> Column:
    """Whether a title gives remote as the way of working, not as part of what is worked on."""
    return found(F.regexp_replace(title, FLAGS + R.SEMANTIC_REMOTE_TITLE_PATTERNS[0], ""), R.TITLE_REMOTE)


def legal_countries(text: Column) -> Column:
    """The countries of a list of those that one must be authorised to work in: to the end of the sentence, item or section, within 500 characters. Null without a list."""
    rest = F.regexp_extract(text, FLAGS + R.LEGAL_COUNTRIES_PREFIX + rf"([\s\S]{{0,{R.LEGAL_COUNTRIES_CHARS}}})", 1)
    items = F.regexp_extract(rest, FLAGS + rf"^(?:{R.DOTTED_NAMES}|(?!{R.LEGAL_COUNTRIES_STOP})[\s\S])*+", 0)
    items = F.regexp_replace(F.regexp_replace(items, "<[^>]+>", " "), r"(?U)\s+", " ")
    return F.nullif(F.regexp_replace(items, r"^[ .,:-]+|[ .,:-]+$", ""), F.lit(""))


def other_restriction(text: Column) -> Column:
    """Whether the first requirement to be in some place names one that is neither the home country, nor a broad region, nor the world."""
    first = F.coalesce(*[F.nullif(F.regexp_extract(text, f"{FLAGS}{p}", 0), F.lit("")) for p in R.GENERIC_LOCATION_RESTRICTION_PATTERNS], F.lit(""))
    wide = (R.HOME, *R.REGIONAL_UNCONFIRMED_PATTERNS, *R.GLOBAL_REMOTE_CLAIM_PATTERNS, *R.UNRESTRICTED_GLOBAL_DESTINATION_PATTERNS)
    return (first != "") & ~found(first, wide)


@F.pandas_udf(BooleanType())
def _required(texts: pd.Series) -> pd.Series:
    """Whether a match stands that no clause around it calls optional; null for null."""
    needs = [re.compile(p, re.I) for p in R.US_SPECIFIC_ELIGIBILITY_RESTRICTION_PATTERNS]
    before, after, clause, tag = (re.compile(p, re.I) for p in (R.OPTIONAL_BEFORE, R.OPTIONAL_AFTER, R.CLAUSE_TAG, "<[^>]+>"))

    def firm(text: str, m: re.Match) -> bool:
        left = clause.split(text[max(0, m.start() - R.CHARS_BEFORE) : m.start()])[-1]
        right = clause.split(text[m.end() : m.end() + R.CHARS_AFTER], maxsplit=1)[0]
        return not before.search(tag.sub(" ", left)) and not after.search(tag.sub(" ", right))

    return texts.map(lambda t: None if t is None else any(firm(t, m) for p in needs for m in p.finditer(t))).astype(object)


def restricted_location(scope: Column) -> Column:
    """Whether a remote location names a place that is neither wide nor the home country."""
    narrow = found(scope, (*R.PAKISTAN_EXCLUSION_PATTERNS, *R.RESTRICTED_REGION_PATTERNS, *R.GLOBAL_SCOPE_LIMITATION_PATTERNS))
    wide = is_global_location(scope) | found(scope, (R.HOME, *R.REGIONAL_UNCONFIRMED_PATTERNS, *R.TIMEZONE_CONSTRAINT_PATTERNS)) | whole(scope, R.GENERIC_REMOTE_LOCATION_PATTERNS)
    return found(scope, r"\bremote\b") & (narrow | ~wide)


def classify(jobs: DataFrame, title: Column, location: Column, description: Column, **evidence: Column) -> DataFrame:
    """``jobs`` with the status of each posting and the reason; ``evidence`` gives any of the fields in ``EVIDENCE`` (countries: of the posting and its locations)."""
    kept = [F.col(f"`{c}`") for c in jobs.columns if c.lower() not in (STATUS, REASON)]
    given = {n: evidence.get(n, F.lit(None)).cast(t) for n, t in EVIDENCE.items()}
    text = lambda c: F.btrim(F.coalesce(c.cast("string"), F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    listed = lambda c: F.coalesce(c, F.array().cast("array<string>"))
    rows = jobs.select(
        F.struct(*kept).alias("_row"),
        text(title).alias("title"),
        text(location).alias("place"),
        F.lower(text(description)).alias("description"),
        F.lower(text(given["eligibility"])).alias("eligibility"),
        plain(text(given["workplace_type"])).alias("kind"),
        given["is_remote"].alias("is_remote"),
        (F.lower(text(given["scope_kind"])) == "posting_location_unverified").alias("unverified"),
        F.filter(F.transform(listed(given["countries"]), lambda c: F.lower(F.trim(c))), lambda c: c != "").alias("countries"),
        text(given["primary_label"]).alias("primary_label"),
        F.lower(F.array_join(F.filter(F.transform(listed(given["labels"]), F.trim), lambda c: c != ""), " | ")).alias("labels"),
    )
    some = lambda *names: F.filter(F.array(*names), lambda x: x != "")
    rows = rows.withColumns(
        {
            "said": F.array_join(some("description", "eligibility"), " "),
            "scope": F.array_join(F.array_distinct(some(F.lower("place"), "labels")), " | "),
            "primary": F.when(F.col("primary_label") != "", F.col("primary_label")).otherwise(F.col("place")),
            "remote": (F.col("kind") == "remote") | F.coalesce("is_remote", F.lit(False)),
            "onsite": F.col("kind").isin("hybrid", "on site", "onsite") | ~F.coalesce("is_remote", F.lit(True)),
            "legal": legal_countries(F.col("description")),
        }
    )
    c = F.col
    rows = rows.withColumns(
        {
            "remote_place": found(c("scope"), r"\bremote\b"),
            "world_label": found(c("primary"), R.GLOBAL_REMOTE_LOCATION_PATTERNS),
            "world": is_global_location(F.when(c("remote") & (c("primary") != "") & ~found(c("primary"), r"\bremote\b"), F.concat(F.lit("remote "), c("primary"))).otherwise(c("primary"))),
            "title_remote": says_remote(c("title")),
            "claim": global_claim(c("said")),
        }
    )
    rows = rows.withColumn("signal", c("remote_place") | c("remote") | c("title_remote") | c("world_label") | c("claim") | found(c("said"), R.ROLE_REMOTE_CLAIM_PATTERNS))
    rows = rows.withColumn("far", F.when((c("remote") | c("world_label")) & (c("scope") != "") & ~c("remote_place"), F.concat(F.lit("remote "), c("scope"))).otherwise(c("scope")))
    rows = rows.withColumn("us_only", F.coalesce(_required(F.when(c("signal") & found(c("said"), R.US_SPECIFIC_ELIGIBILITY_RESTRICTION_PATTERNS), c("said"))), F.lit(False)))
    rows = rows.withColumns({"wide_said": found(c("said"), of_regions(R.REGION_REQUIRED, R.REGIONAL_UNCONFIRMED_PATTERNS)) | found(c("said"), R.TIMEZONE_CONSTRAINT_PATTERNS)})

    both = F.concat_ws(" ", "scope", "said")
    title_near = lambda regions: found(c("title"), of_regions(R.REGION_ONLY, regions)) | c("title_remote") & found(c("title"), of_regions(R.REGION_REMOTE, regions))
    title_narrow = title_near(R.RESTRICTED_REGION_PATTERNS) | found(c("title"), (*of_regions(R.REGION_ALONE, R.RESTRICTED_REGION_PATTERNS), *R.US_STATE_TITLE_PATTERNS))
    countries_count = c("signal") & (F.size("countries") > 0) & ~c("unverified")
    any_country = lambda test: countries_count & F.exists("countries", test)
    at_home_or_world = lambda x: found(x, R.HOME) | plain(x).isin(*R.GLOBAL_VALUES) | found(x, R.GLOBAL_REMOTE_CLAIM_PATTERNS)
    home_named = found(c("scope"), R.HOME) | found(c("said"), R.PAKISTAN_ELIGIBILITY_PATTERNS) | c("title_remote") & found(c("title"), of_regions(R.REGION_REMOTE, (R.HOME,))) | F.coalesce(found(c("legal"), R.HOME), F.lit(False))
    wide_place = found(c("far"), (*R.REGIONAL_UNCONFIRMED_PATTERNS, *R.TIMEZONE_CONSTRAINT_PATTERNS))
    rules = [
        (c("us_only"), "restricted_remote", "status or clearance of the United States is required"),
        (c("signal") & found(F.concat_ws(" ", "scope", F.array_join("countries", " | "), "said"), R.PAKISTAN_EXCLUSION_PATTERNS), "restricted_remote", "Pakistan is excluded"),
        (c("signal") & found(both, R.GLOBAL_SCOPE_LIMITATION_PATTERNS), "restricted_remote", "remote work is narrower than worldwide"),
        (c("signal") & title_narrow, "restricted_remote", "the title limits the role to a region outside Pakistan"),
        (c("signal") & title_near(R.REGIONAL_UNCONFIRMED_PATTERNS), "regional_unconfirmed", "the title limits the role to a broad region"),
        (c("signal") & c("legal").isNotNull() & ~found(c("legal"), R.HOME), "restricted_remote", "the countries of legal work do not include Pakistan"),
        (c("onsite") | found(c("description"), (*R.REMOTE_NEGATION_PATTERNS, *R.ONSITE_CLAIM_PATTERNS)) | found(c("place"), R.ONSITE_CLAIM_PATTERNS) & ~c("world"), "onsite_explicit", "onsite or hybrid work is required"),
        (any_country(lambda x: found(x, R.RESTRICTED_REGION_PATTERNS)), "restricted_remote", "a country of the posting lies outside Pakistan"),
        (any_country(lambda x: found(x, R.REGIONAL_UNCONFIRMED_PATTERNS)), "regional_unconfirmed", "the posting names a broad region only"),
        (countries_count & ~F.exists("countries", at_home_or_world), "restricted_remote", "all countries of the posting lie outside Pakistan"),
        (~c("world") & ~c("unverified") & restricted_location(c("far")), "restricted_remote", "the remote location is restricted"),
        (c("signal") & (found(c("said"), of_regions(R.REGION_REQUIRED, R.RESTRICTED_REGION_PATTERNS)) | other_restriction(c("said"))), "restricted_remote", "applicants must be in a place outside Pakistan"),
        (c("signal") & c("world") & c("wide_said"), "regional_unconfirmed", "a region or time zone narrows a worldwide location"),
        (c("signal") & (c("scope") != "") & ~c("remote_place") & ~c("remote") & ~c("world"), "restricted_remote", "remote work is paired with one location"),
        (c("signal") & home_named, "pakistan_explicit", "Pakistan is named"),
        (c("signal") & found(c("title"), R.TITLE_GLOBAL), "global_explicit", "the title says worldwide remote"),
        (c("world") | is_global_location(c("far")), "global_explicit", "the location says worldwide remote"),
        (c("signal") & (wide_place | c("wide_said")), "regional_unconfirmed", "a region or time zone is named, but not Pakistan"),
        (c("claim"), "global_explicit", "the text says worldwide remote"),
        (c("signal"), "remote_unclear", "remote, but countries are not named"),
    ]
    out = F.struct(F.lit("no_remote_evidence").alias(STATUS), F.lit("no evidence of remote or onsite work").alias(REASON))
    for holds, status, reason in reversed(rules):
        out = F.when(holds, F.struct(F.lit(status).alias(STATUS), F.lit(reason).alias(REASON))).otherwise(out)
    return rows.withColumn("_out", out).select("_row.*", "_out.*")
