"""Company identity: slugs, domain claims, and fail-closed matching."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import text, urls
from millrace.operators.ranks import numbered_within


def unique_slugs(rows: DataFrame, name: str, order: str, taken: DataFrame | None = None) -> DataFrame:
    """The rows with ``slug``: base, base-2, base-3 … in ``order``; numbering goes on after the slugs in ``taken`` (column slug)."""
    out = rows.withColumn("_base", text.slugify(F.col(name)))
    out, number = numbered_within(out, ["_base"], [F.col(order)], "_number"), F.col("_number")
    if taken is not None:
        base = F.regexp_replace("slug", "-[0-9]+$", "")
        used = taken.select("slug", F.explode(F.array_distinct(F.array("slug", base))).alias("_base"))
        last = F.coalesce(F.nullif(F.regexp_extract("slug", "-([0-9]+)$", 1), F.lit("")).try_cast("int"), F.lit(1))
        used = used.groupBy("_base").agg(F.max(F.when(F.col("slug") == F.col("_base"), 1).otherwise(last)).alias("_used"))
        out = out.join(used, "_base", "left")
        number = number + F.coalesce("_used", F.lit(0))
    return out.withColumn("slug", F.when(number == 1, F.col("_base")).otherwise(F.concat_ws("-", "_base", number))).drop("_base", "_used", "_number")


def surviving_claims(companies: DataFrame, key: str, name: str, website: str) -> DataFrame:
    """The companies with ``domain`` and ``claim``: kept, or withdrawn where several claim one domain, unless exactly one of them has a matching name."""
    domain = urls.primary_domain(F.col(website))
    label = F.regexp_replace(F.regexp_extract(F.col("domain"), r"^([^.]+)", 1), "[^a-z0-9]", "")
    plain = F.regexp_replace(F.lower(F.regexp_replace(F.col(name), r"(?i)[ ,]+(inc|llc|ltd|corp|co)\.?$", "")), "[^a-z0-9]", "")
    fits = (plain == label) | F.concat(F.lit("get"), plain).eqNullSafe(label) | F.concat(F.lit("go"), plain).eqNullSafe(label) | F.concat(F.lit("try"), plain).eqNullSafe(label)
    rows = companies.withColumn("domain", domain).withColumn("_fits", fits)
    counts = rows.where(F.col("domain").isNotNull()).groupBy("domain").agg(F.count(F.lit(1)).alias("_claims"), F.count_if("_fits").alias("_fitting"))
    rows = rows.join(counts, "domain", "left")
    kept = (F.col("_claims") == 1) | ((F.col("_fitting") == 1) & F.col("_fits"))
    return rows.withColumn("claim", F.when(F.col("domain").isNull(), "none").when(kept, "kept").otherwise("withdrawn")).drop("_fits", "_claims", "_fitting")


def resolve(candidates: DataFrame, companies: DataFrame) -> DataFrame:
    """candidates (candidate_id, name, domain) with company_id and resolution. Fails closed: only a name and a domain that agree resolve.

    ``existing_exact_name``: one company has the name, and the domains are compatible. ``ambiguous_name``: several have it, or
    one that no domain corroborates. ``identity_conflict``: the name's company has another domain, or the domain's company another name.
    ``ambiguous_domain``: no company has the name, several the domain. ``new_company_domain_candidate``: neither is known. ``unresolved_no_domain``: the name is not, and there is no domain.
    Companies are found by equi-joins, by name and by exploded domain suffixes in both directions; only counts and one company a candidate travel on.
    """
    known = companies.select("company_id", F.lower(text.collapse(F.col("name"))).alias("_name"), urls.identity_domain(F.col("domain")).alias("_domain"))
    rows = candidates.select("candidate_id", F.lower(text.collapse(F.col("name"))).alias("_name"), urls.identity_domain(F.col("domain")).alias("_d"))
    names = known.groupBy("_name").agg(F.count(F.lit(1)).alias("_names"), F.min("company_id").alias("_id"), F.min("_domain").alias("_stored"))
    out = rows.join(names, "_name", "left")
    with_domain = rows.where(F.col("_d").isNotNull())
    below = with_domain.select("candidate_id", F.explode(urls.domain_suffixes(F.col("_d"), 1)).alias("_domain"))
    stored = known.where(F.col("_domain").isNotNull())
    above = stored.select(F.explode(urls.domain_suffixes(F.col("_domain"), 1)).alias("_d"), "company_id", "_domain").where("_d <> _domain").groupBy("_d").agg(F.count_distinct("company_id").alias("n"))
    exact = stored.groupBy("_domain").agg(F.count(F.lit(1)).alias("n"))
    found = below.join(exact, "_domain").select("candidate_id", "n").union(with_domain.join(above, "_d").select("candidate_id", "n"))
    out = out.join(found.groupBy("candidate_id").agg(F.sum("n").alias("_domains")), "candidate_id", "left")
    corroborated = F.col("_d").isNotNull() & F.col("_stored").isNotNull()
    how = (
        F.when(F.col("_names") > 1, "ambiguous_name")
        .when((F.col("_names") == 1) & ~corroborated, "ambiguous_name")
        .when((F.col("_names") == 1) & urls.domains_compatible(F.col("_d"), F.col("_stored")), "existing_exact_name")
        .when(F.col("_names") == 1, "identity_conflict")
        .when(F.col("_d").isNull(), "unresolved_no_domain")
        .when(F.col("_domains") > 1, "ambiguous_domain")
        .when(F.col("_domains") == 1, "identity_conflict")
        .otherwise("new_company_domain_candidate")
    )
    out = out.select("candidate_id", how.alias("resolution"), F.when(how == "existing_exact_name", F.col("_id")).alias("company_id"))
    return candidates.join(out, "candidate_id").select(*candidates.columns, "company_id", "resolution")
