"""Job boards' saved JSON as one normalized schema.

Each function takes payloads (source_id, payload: the board's JSON text) and gives a row for each job: source_id and ``JOB``. Parsing is ``from_json`` with
a schema, so only the fields named here are read. A job without an id or a title makes its snapshot invalid; such rows come out with ``problem``
set, and ``lifecycle.snapshot_problems`` turns the snapshot away.
"""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import text, times
from millrace.functions.canonical import hashed_content, quoted
from millrace.operators.provider_evidence import evidence

BOARD_A = "jobs array<struct<id: string, title: string, absolute_url: string, content: string, location: string, departments: array<struct<name: string>>, offices: array<struct<name: string>>, first_published: string, updated_at: string>>"
BOARD_B = (
    "jobs array<struct<id: string, title: string, location: string, secondaryLocations: array<struct<location: string>>, department: string, team: string, isListed: boolean, isRemote: boolean, workplaceType: string,"
    " descriptionHtml: string, descriptionPlain: string, publishedAt: string, employmentType: string, jobUrl: string, applyUrl: string, compensation: string>>"
)
BOARD_C = (
    "array<struct<id: string, createdAt: double, text: string, categories: struct<location: string, commitment: string, department: string, team: string, allLocations: array<string>>, description: string, descriptionPlain: string,"
    " lists: array<struct<text: string, content: string>>, additional: string, additionalPlain: string, salaryDescription: string, salaryDescriptionPlain: string, hostedUrl: string, applyUrl: string, workplaceType: string, salaryRange: string>>"
)
VENDOR = (
    "data array<struct<id: string, job_title: string, date_posted: string, discovered_at: string, description: string, employment_statuses: array<string>, final_url: string, url: string, source_url: string, remote: boolean, hybrid: boolean,"
    " seniority: string, locations: array<struct<display_name: string>>, company_object: struct<id: string, name: string, domain: string>>>"
)
JOB = ("external_job_id", "title", "posting_url", "apply_url", "location", "department", "employment_type", "description_text", "source_published_at", "source_updated_at", "content_hash", "problem")


@F.pandas_udf(T.StringType())
def unescape(values: pd.Series) -> pd.Series:
    """HTML entities; Spark has no function for them."""
    return values.map(html.unescape, na_action="ignore")


def clean(raw: Column) -> Column:
    """Text of HTML: tags go, entities are read, white space is collapsed; null if nothing is left."""
    return F.nullif(text.collapse(unescape(F.regexp_replace(raw, "<[^>]+>", " "))), F.lit(""))


def _optional(value: Column) -> Column:
    return F.nullif(F.trim(value), F.lit(""))


def _joined(items: Column, distinct: bool = True) -> Column:
    kept = F.filter(F.transform(items, _optional), lambda x: x.isNotNull())
    return F.nullif(F.array_join(F.array_distinct(kept) if distinct else kept, " / "), F.lit(""))


def _list(column: Column) -> Column:
    return F.coalesce(column, F.array())


def _finish(jobs: DataFrame, fields: dict[str, Column], hashed: list[str]) -> DataFrame:
    rows = jobs.select("source_id", *[c.alias(n) for n, c in fields.items()])
    rows = rows.withColumn("content_hash", F.sha2(F.to_json(F.struct(*hashed)), 256))
    problem = F.when(F.col("external_job_id").isNull(), "job without an id").when(F.col("title").isNull(), "job without a title")
    return rows.withColumn("problem", problem).select("source_id", *JOB)


def board_a(payloads: DataFrame, provider: str = "board_a") -> DataFrame:
    """With ``structured_evidence``. The content hash is that of the canonical JSON of what a posting says, evidence included, so that it is the same wherever it is made."""
    raw = payloads.select("source_id", F.explode(F.from_json("payload", "jobs array<string>")["jobs"]).alias("raw"))
    jobs = raw.select("source_id", "raw", F.from_json(F.concat(F.lit('{"jobs":['), "raw", F.lit("]}")), BOARD_A)["jobs"][0].alias("j")).select("source_id", "raw", "j.*")
    jobs = jobs.withColumn("structured_evidence", evidence("board_a", provider)("raw"))
    location = F.when(F.startswith(F.trim("location"), F.lit("{")), F.get_json_object("location", "$.name")).otherwise(F.col("location"))
    departments = F.coalesce(_joined(_list(F.col("departments.name")), False), _joined(_list(F.col("offices.name")), False))
    fields = {
        "external_job_id": _optional(F.col("id")),
        "title": _optional(F.col("title")),
        "posting_url": _optional(F.col("absolute_url")),
        "apply_url": F.lit(None).cast("string"),
        "location": _optional(location),
        "department": departments,
        "employment_type": F.lit(None).cast("string"),
        "description_text": clean(F.col("content")),
        "source_published_at": times.parse_iso(F.col("first_published")),
        "source_updated_at": times.parse_iso(F.col("updated_at")),
    }
    rows = jobs.select("source_id", "structured_evidence", *[c.alias(n) for n, c in fields.items()])
    said = {n: quoted(F.col(n)) for n in ("title", "description_text", "location", "department", "employment_type", "posting_url", "apply_url")}
    rows = rows.withColumn("content_hash", hashed_content(said | {"structured_evidence": F.col("structured_evidence")}))
    problem = F.when(F.col("external_job_id").isNull(), "job without an id").when(F.col("title").isNull(), "job without a title")
    return rows.withColumn("problem", problem).select("source_id", *JOB, "structured_evidence")


def board_b(payloads: DataFrame) -> DataFrame:
    """Unlisted jobs are left out."""
    jobs = payloads.select("source_id", F.inline(F.from_json("payload", BOARD_B)["jobs"])).where(F.coalesce("isListed", F.lit(True)))
    fields = {
        "external_job_id": _optional(F.col("id")),
        "title": _optional(F.col("title")),
        "posting_url": _optional(F.col("jobUrl")),
        "apply_url": _optional(F.col("applyUrl")),
        "location": _joined(F.concat(F.array("location"), _list(F.col("secondaryLocations.location")))),
        "department": _joined(F.array("department", "team")),
        "employment_type": _optional(F.col("employmentType")),
        "description_text": _optional(F.col("descriptionPlain")),
        "source_published_at": times.parse_iso(F.col("publishedAt")),
        "source_updated_at": F.lit(None).cast("timestamp"),
        "compensation": F.col("compensation"),
    }
    return _finish(jobs, fields, ["title", "description_text", "location", "department", "employment_type", "posting_url", "apply_url", "compensation"])


def board_c(payloads: DataFrame) -> DataFrame:
    jobs = payloads.select("source_id", F.inline(F.from_json("payload", BOARD_C)))

    def folded(items):
        return F.nullif(F.array_join(text.distinct_folded(F.filter(F.transform(items, _optional), lambda x: x.isNotNull())), " / "), F.lit(""))

    # Entities in the lists are read once, on the joined text of their items.
    lists = clean(F.array_join(F.transform(_list(F.col("lists")), lambda x: F.concat_ws(" ", _optional(x["text"]), _optional(x["content"]))), " "))
    description = _optional(F.concat_ws(" ", _optional(F.col("descriptionPlain")), lists, _optional(F.col("additionalPlain")), _optional(F.col("salaryDescriptionPlain"))))
    fields = {
        "external_job_id": _optional(F.col("id")),
        "title": _optional(F.col("text")),
        "posting_url": _optional(F.col("hostedUrl")),
        "apply_url": _optional(F.col("applyUrl")),
        "location": folded(F.concat(F.array("categories.location"), _list(F.col("categories.allLocations")))),
        "department": folded(F.array("categories.department", "categories.team")),
        "employment_type": _optional(F.col("categories.commitment")),
        "description_text": description,
        "source_published_at": times.from_epoch_millis(F.col("createdAt").try_cast("bigint")),
        "source_updated_at": F.lit(None).cast("timestamp"),
        "pay": F.concat_ws(" ", "salaryRange", "salaryDescriptionPlain"),
    }
    return _finish(jobs, fields, ["title", "description_text", "location", "department", "employment_type", "posting_url", "apply_url", "pay"])


def vendor(payloads: DataFrame) -> DataFrame:
    """Vendor search results; company columns beside the job's. A job without a company id has a problem."""
    jobs = payloads.select("source_id", F.inline(F.from_json("payload", VENDOR)["data"]))
    company = {"company_id": _optional(F.col("company_object.id")), "company_name": _optional(F.col("company_object.name")), "company_domain": _optional(F.lower("company_object.domain"))}
    fields = {
        "external_job_id": _optional(F.col("id")),
        "title": _optional(F.col("job_title")),
        "posting_url": text.first_text("source_url", "url"),
        "apply_url": text.first_text("final_url", "url"),
        "location": _joined(_list(F.col("locations.display_name"))),
        "department": F.lit(None).cast("string"),
        "employment_type": _joined(_list(F.col("employment_statuses"))),
        "description_text": _optional(F.col("description")),
        "source_published_at": times.parse_iso(F.col("date_posted")),
        "source_updated_at": times.parse_iso(F.col("discovered_at")),
    }
    rows = jobs.select("source_id", *[c.alias(n) for n, c in (fields | company).items()])
    rows = rows.withColumn("content_hash", F.sha2(F.to_json(F.struct("title", "description_text", "location", "employment_type", "posting_url", "apply_url")), 256))
    problem = F.when(F.col("external_job_id").isNull(), "job without an id").when(F.col("title").isNull(), "job without a title").when(F.col("company_id").isNull(), "job without a company")
    return rows.withColumn("problem", problem).select("source_id", *JOB, *company)
