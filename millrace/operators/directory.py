"""A directory's companies enter the registry in their order, without unsafe merging.

A batch gives companies with the directory's own ids. What a row does depends on the rows before it: a company that the directory knows already may move to another
domain, and a later row may then claim the one that it left. But only rows that touch one domain or one id depend on each other. So rows are grouped into conflict
components, and each component is folded in the batch's order; components run side by side.

1. A website must be safe evidence (``websites.company_website``). Of several rows that claim one domain only the one whose name fits it keeps its claim; if none or several fit, none does.
2. A row belongs to the company that has its id as a source of this directory. A row without one takes the only company that has both its domain and its name, if that has no such source yet.
   Names alone never merge.
3. If another company holds the claimed domain at that time, the row loses its website and keeps the conflict as evidence.
4. A row without a company makes one, under its slug or the next one free; other rows bring their company's name and website up to date (the old website stays where there is no new one).

The stored companies of a domain enter as counts, however many they are; those that the batch touches as rows of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import text, websites
from millrace.operators.components import connected
from millrace.operators.ranks import numbered
from millrace.sources.versions import cut

COMPANIES = "company_id long, name string, normalized_name string, slug string, website string, primary_domain string, identity_state string"
SOURCES = "company_id long, provider string, external_id string, source_url string, status string, conflict string"
_DECIDED = "position long, external_id string, handle string, action string, name string, website string, domain string, claimed_website string, claimed_domain string"


def claims(batch: DataFrame) -> DataFrame:
    """The batch with claimed_website and claimed_domain (safe evidence), and website and domain: what is left of them after claims of one domain by several rows."""
    rows = batch.withColumn("claimed_website", websites.company_website(F.col("name"), F.col("website")))
    rows = rows.withColumn("claimed_domain", websites.website_domain(F.col("claimed_website")))
    # Written, since both sides of the join below would work out all patterns.
    rows = cut(rows.withColumn("_fits", websites.name_fits_domain(F.col("name"), F.col("claimed_domain"))), "claimed")
    counts = rows.where("claimed_domain IS NOT NULL").groupBy("claimed_domain").agg(F.count(F.lit(1)).alias("_claims"), F.count_if("_fits").alias("_fitting"))
    kept = (F.col("_claims") == 1) | ((F.col("_fitting") == 1) & F.col("_fits"))
    rows = rows.join(counts, "claimed_domain", "left")
    return rows.withColumns({"website": F.when(kept, F.col("claimed_website")), "domain": F.when(kept, F.col("claimed_domain"))}).drop("_fits", "_claims", "_fitting")


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by component: the touched companies (position null) first, then the batch's rows in order."""
    component, fold = None, None
    for batch in batches:
        found = []
        for row in batch.to_pylist():
            if row["component"] != component:
                component, fold = row["component"], _Component()
            if row["position"] is None:
                fold.touch(row)
            else:
                found.append(fold.enter(row))
        if found:
            names = [c.split()[0] for c in _DECIDED.split(", ")]
            kinds = [pa.int64(), *[pa.string()] * (len(names) - 1)]
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in found], k) for n, k in zip(names, kinds)], names)


class _Component:
    """The companies that a component's rows touch, as they stand after the rows so far. A handle is a stored company's id, or the position of the row that made it."""

    def __init__(self):
        self.now: dict[str, tuple[str | None, str, str | None]] = {}  # handle: domain, normalised name, website
        self.holders: dict[str, set[str]] = {}  # by domain
        self.owner: dict[str, str] = {}  # handle by directory id

    def touch(self, row: dict[str, Any]) -> None:
        self._set(f"c{row['company_id']}", row["domain"], row["folded"], row["website"])

    def _set(self, handle: str, domain: str | None, folded: str, website: str | None) -> None:
        if handle in self.now and self.now[handle][0]:
            self.holders[self.now[handle][0]].discard(handle)
        self.now[handle] = (domain, folded, website)
        if domain:
            self.holders.setdefault(domain, set()).add(handle)

    def enter(self, row: dict[str, Any]) -> dict[str, Any]:
        key, domain, website, folded = row["external_id"], row["domain"], row["website"], row["folded"]
        handle = self.owner.get(key) or (f"c{row['company_id']}" if row["company_id"] is not None else None)
        action, rest = "updated", row["others"]
        if handle is None and domain and folded:
            alike = row["alike"] + sum(self.now[h][1] == folded for h in self.holders.get(domain, ()))
            if alike == 1 and row["alike"] == 1 and not row["alike_known"]:
                handle, action, rest = f"c{row['alike_id']}", "matched", rest - 1
        taken = bool(domain) and rest + len(self.holders.get(domain, set()) - {handle}) > 0
        if taken:
            domain = website = None
        if handle is None:
            handle, action = f"n{row['position']}", "created"
        elif website is None:
            domain, _, website = self.now.get(handle) or (row["domain"], folded, row["alike_website"])
        self._set(handle, domain, folded, website)
        self.owner[key] = handle
        lost = taken or row["domain"] is None and row["claimed_domain"] is not None
        evidence = {c: row[c] if lost else None for c in ("claimed_website", "claimed_domain")}
        return {**row, **evidence, "handle": handle, "action": action, "domain": domain, "website": website}


def decide(batch: DataFrame, companies: DataFrame, sources: DataFrame, provider: str) -> DataFrame:
    """For each row of the batch (position, external_id, name, website): the company (handle), the action (created, matched, updated) and its website after it; claimed_website and
    claimed_domain where they were refused. A written table."""
    own = sources.where(F.col("provider") == provider).select("external_id", "company_id")
    stored = companies.select("company_id", F.col("normalized_name").alias("folded"), F.col("website").alias("stored_website"), F.col("primary_domain").alias("stored_domain"))
    rows = claims(batch).withColumn("folded", text.normalize_company_name(F.col("name")))
    rows = cut(rows.join(own, "external_id", "left").join(stored.select("company_id", "stored_domain"), "company_id", "left"), "claims")

    touched = cut(stored.join(rows.where("company_id IS NOT NULL").select("company_id").distinct(), "company_id", "left_semi"), "touched")
    # Edges lead from a row to the first one of its id, to the one that claims the domain its company holds, and to the first one of its company.
    first = rows.groupBy("external_id").agg(F.min("position").alias("u"))
    edges = rows.select("external_id", F.col("position").alias("v")).join(first, "external_id").select("u", "v")
    claimed = rows.where("domain IS NOT NULL").select(F.col("domain").alias("stored_domain"), F.col("position").alias("u"))
    edges = edges.union(rows.select("stored_domain", F.col("position").alias("v")).join(claimed, "stored_domain").select("u", "v"))
    heads = rows.where("company_id IS NOT NULL").groupBy("company_id").agg(F.min("position").alias("u"))
    edges = edges.union(rows.select("company_id", F.col("position").alias("v")).join(heads, "company_id").select("u", "v"))
    parts = cut(connected(edges), "components").select(F.col("node").alias("position"), "component")
    rows = rows.join(parts, "position", "left").withColumn("component", F.coalesce("component", "position"))

    rest = stored.where("stored_domain IS NOT NULL").join(touched.select("company_id"), "company_id", "left_anti")
    known = own.select("company_id").distinct().withColumn("known", F.lit(True))
    named = rest.join(known, "company_id", "left").groupBy("stored_domain", "folded")
    named = named.agg(F.count(F.lit(1)).alias("alike"), F.min("company_id").alias("alike_id"), F.min_by("stored_website", "company_id").alias("alike_website"), F.max(F.coalesce("known", F.lit(False))).alias("alike_known"))
    held = rest.groupBy("stored_domain").agg(F.count(F.lit(1)).alias("others"))
    asked = rows.drop("stored_domain").join(held.withColumnRenamed("stored_domain", "domain"), "domain", "left")
    asked = asked.join(named.withColumnRenamed("stored_domain", "domain"), ["domain", "folded"], "left").fillna(0, ["others", "alike"]).fillna(False, ["alike_known"])
    columns = ["component", "position", "external_id", "name", "folded", "website", "domain", "claimed_website", "claimed_domain", "company_id", "others", "alike", "alike_id", "alike_website", "alike_known"]
    of = rows.join(heads, "company_id").where("position = u").select("company_id", "component")
    standing = touched.join(of, "company_id").select("component", "company_id", "folded", F.col("stored_website").alias("website"), F.col("stored_domain").alias("domain"))
    dealt = asked.select(*columns).unionByName(standing, allowMissingColumns=True).repartition("component").sortWithinPartitions("component", F.col("position").asc_nulls_first())
    return cut(dealt.mapInArrow(_fold, _DECIDED), "decided")


def free_slugs(made: DataFrame, taken: DataFrame, provider: str) -> DataFrame:
    """position, slug of new companies (position, external_id, slug): the slug asked for, if it is free and the row is the first to ask; else with the directory's id behind it, and then numbered.

    What rows of the batch get as they asked counts as taken for the others.
    """
    suffix = F.concat_ws("-", F.lit(provider), F.col("external_id"))
    rows = made.select("position", suffix.alias("suffix"), F.coalesce(F.nullif(F.lower(F.trim("slug")), F.lit("")), suffix).alias("base"))
    taken = taken.select("slug").distinct()
    first = rows.groupBy("base").agg(F.min("position").alias("first")).join(taken.withColumnRenamed("slug", "base"), "base", "left_anti")
    plain = rows.join(first, "base").where("position = first").select("position", F.col("base").alias("slug"))
    others = rows.join(plain.select("position"), "position", "left_anti").withColumn("stem", F.concat_ws("-", "base", "suffix"))
    used = cut(taken.union(plain.select("slug")), "slugs")
    # The numbers in use behind a stem; the stem itself is number 1.
    tail = F.regexp_extract("slug", "-([0-9]+)$", 1).try_cast("long")
    numbers = used.select(F.col("slug").alias("stem"), F.lit(1).cast("long").alias("n")).union(used.where(tail >= 2).select(F.regexp_replace("slug", "-[0-9]+$", ""), tail))
    numbers = numbers.join(others.select("stem").distinct(), "stem", "left_semi")
    # The least free one: 1, or one more than the first in use whose follower is free.
    free = others.join(numbers_after(numbers), "stem", "left")
    return plain.union(free.select("position", F.when(F.coalesce("n", F.lit(1)) == 1, F.col("stem")).otherwise(F.concat_ws("-", "stem", "n"))))


def numbers_after(numbers: DataFrame) -> DataFrame:
    """stem, n: the least number from 1 on that is not among a stem's numbers (stem, n)."""
    following = numbers.select("stem", (F.col("n") + 1).alias("n")).union(numbers.select("stem").distinct().withColumn("n", F.lit(1).cast("long")))
    return following.distinct().join(numbers, ["stem", "n"], "left_anti").groupBy("stem").agg(F.min("n").alias("n"))


def upsert(batch: DataFrame, companies: DataFrame, sources: DataFrame, provider: str, url: str) -> dict[str, DataFrame]:
    """The next ``companies`` and ``sources``, and ``decisions`` (what each row did, with its company's id). batch: position (a number of its own for each row), external_id, name, website, slug.

    ``url`` is put before a row's slug to make its source's address.
    """
    decided = decide(batch, companies, sources, provider)
    made = decided.where("action = 'created'").select("position", "external_id").join(batch.select("position", "slug"), "position")
    most = companies.agg(F.max("company_id")).first()[0] or 0
    ids = numbered(made.select("position"), [F.col("position")], "number").select(F.concat(F.lit("n"), F.col("position")).alias("handle"), (F.col("number") + most).alias("new_id"))
    slugs = free_slugs(made, companies, provider).select(F.concat(F.lit("n"), F.col("position")).alias("handle"), F.col("slug").alias("new_slug"))
    company = F.coalesce("new_id", F.expr("CAST(substr(handle, 2) AS BIGINT)")).alias("company_id")
    decisions = cut(decided.join(ids, "handle", "left").select("*", company).drop("new_id"), "decisions")
    last = decisions.groupBy("company_id").agg(F.max_by(F.struct("handle", "name", "website", "domain"), "position").alias("r")).select("company_id", "r.*")
    values = last.join(slugs, "handle", "left").select(
        "company_id", "name", text.normalize_company_name(F.col("name")).alias("normalized_name"), "new_slug", "website", F.col("domain").alias("primary_domain"), F.lit(True).alias("_touched")
    )
    both = companies.alias("a").join(values.alias("b"), "company_id", "full_outer")
    new = F.col("_touched").isNotNull()
    next_companies = both.select(
        "company_id",
        *[F.when(new, F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")).alias(c) for c in ("name", "normalized_name")],
        F.coalesce("a.slug", "new_slug").alias("slug"),
        *[F.when(new, F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")).alias(c) for c in ("website", "primary_domain")],
        F.when(new, "verified").otherwise(F.col("identity_state")).alias("identity_state"),
    )
    conflict = F.struct(F.lit("website_domain_conflict").alias("kind"), "claimed_website", "claimed_domain")
    mine = decisions.join(batch.select("position", F.lower(F.trim("slug")).alias("slug")), "position").select(
        "position", "company_id", "external_id", F.concat(F.lit(url), F.coalesce("slug", F.lit(""))).alias("source_url"), F.when(F.col("claimed_domain").isNotNull(), F.to_json(conflict)).alias("conflict")
    )
    mine = mine.groupBy("external_id").agg(F.max_by(F.struct("company_id", "source_url", "conflict"), "position").alias("r"))
    mine = mine.select("r.company_id", F.lit(provider).alias("provider"), "external_id", "r.source_url", F.lit("active").alias("status"), "r.conflict")
    others = sources.join(mine.select("provider", "external_id"), ["provider", "external_id"], "left_anti")
    return {"companies": next_companies, "sources": others.select(*mine.columns).unionByName(mine), "decisions": decisions.drop("handle")}
