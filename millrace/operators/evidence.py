"""Evidence that postings and companies carry: canonical records, countries named in metadata, joined context, the angle of a prototype."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions import text

# Names of metadata fields that list countries.
COUNTRY_FIELDS = (
    "allowed countries",
    "allowed country",
    "countries",
    "country",
    "eligible countries",
    "eligible country",
    "hiring countries",
    "hiring country",
    "location countries",
    "location country",
    "work countries",
    "work country",
)
# The angle of a prototype by what a company's text contains; the first that holds decides.
ANGLES = (
    (("open source", "developer tools", "infrastructure"), "Build a repo PR, SDK/plugin, or runnable integration demo with docs and a Loom."),
    (("security", "compliance"), "Build an audit-trail workflow or security automation demo against a realistic sample app."),
    (("customer support", "customer success"), "Build an AI triage/insights demo from sample support tickets and show before/after workflow time."),
    (("fintech", "finance", "payments"), "Build a reconciliation/risk dashboard with explainable flags and exportable audit evidence."),
    (("healthcare",), "Build a HIPAA-conscious intake/ops workflow demo using synthetic patient/provider data."),
    (("recruiting", "human resources"), "Build a candidate/job matching or workflow automation prototype with transparent scoring."),
    (("ai", "agent"), "Build a focused AI agent demo that automates one painful user workflow end to end."),
)
OTHER_ANGLE = "Build a narrow workflow prototype tied to their one-liner, with a 60-second Loom and repo."

_NONE = "array<string>"


def canonical_records(records: Column, fields: Sequence[str]) -> Column:
    """Sorted JSON texts of an array of structs, without repeats: text fields in order of name, trimmed, absent where blank; records without any value are left out."""

    def encoded(record):
        return F.to_json(F.struct(*[F.nullif(F.trim(record[f]), F.lit("")).alias(f) for f in sorted(fields)]))

    return F.coalesce(F.array_sort(F.array_distinct(F.filter(F.transform(records, encoded), lambda r: r != "{}"))), F.array().cast(_NONE))


def metadata_countries(metadata: Column) -> Column:
    """Countries of metadata (array of structs name, value): a value is text with , ; or | between countries, or a JSON list of such texts. First spellings, in order."""
    named = F.filter(metadata, lambda m: F.trim(F.lower(m["name"])).isin(*COUNTRY_FIELDS))

    def values(m):
        listed = F.when(F.startswith(m["value"], F.lit("[")), F.from_json(m["value"], _NONE)).otherwise(F.array(m["value"]))
        return F.flatten(F.transform(F.filter(listed, lambda v: v.isNotNull()), lambda v: F.split(v, r"[,;|]")))

    found = F.transform(F.flatten(F.transform(named, lambda m: F.coalesce(values(m), F.array().cast(_NONE)))), text.collapse)
    return text.distinct_folded(F.coalesce(F.filter(found, lambda v: v != ""), F.array().cast(_NONE)))


def job_context(fields: Sequence[Column], skills: Column | None = None) -> Column:
    """The fields that are not empty, in order, and the skills, joined by spaces."""
    parts = [F.nullif(f, F.lit("")) for f in fields]
    return F.concat_ws(" ", *parts, *([] if skills is None else [skills]))


def prototype_angle(blob: Column) -> Column:
    """The angle for a company's text in lower case; null counts as empty."""
    blob, out = F.coalesce(blob, F.lit("")), F.lit(OTHER_ANGLE)
    for words, angle in reversed(ANGLES):
        out = F.when(blob.rlike("|".join(words)), angle).otherwise(out)
    return out
