"""Structured evidence of boards' postings as JSON in canonical form: where, for whom and by which requisition a posting is, without inferring who may apply.

A payload is one posting's JSON. What is built from it is told by a table of fields (``SHAPES``): each has a name and a reader from the payload. Records are compacted (null members go), made distinct and put in
the order of their canonical text; strings are made distinct whatever their case and put in the order of their folded form.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable
from typing import Any

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from millrace.functions.canonical import dumps, each

Reader = Callable[[dict], Any]
VERSION = 1
# Names that a requisition's id goes by, in the order in which they count.
REQUISITION_KEYS = ("requisition_id", "requisitionId", "requisitionID", "requisition_number", "requisitionNumber", "req_id", "reqId", "job_code", "jobCode")
# Parts of a custom field's name that make it say who may apply; and the names of fields that list countries.
ELIGIBILITY_NAMES = ("authorisation", "authorization", "citizen", "country", "countries", "eligib", "location", "region", "remote", "residen", "sponsor", "time zone", "timezone", "visa")
COUNTRY_NAMES = {f"{a}{b}" for a in ("", "allowed ", "eligible ", "hiring ", "location ", "work ") for b in ("countries", "country")}


def said(value: Any) -> str | None:
    """A value as trimmed text; null if nothing is left."""
    return (str(value).strip() or None) if value is not None else None


def compact(**members: Any) -> dict:
    return {k: v for k, v in members.items() if v is not None}


def records(items: Iterable[dict | None]) -> list[dict]:
    """Those that are not empty, one of each, in the order of their text (not escaped)."""
    return [json.loads(t) for t in sorted({json.dumps(i, sort_keys=True, separators=(",", ":"), ensure_ascii=False) for i in items if i})]


def strings(values: Iterable[Any]) -> list[str]:
    """One spelling, the first, of each text, in the order of the folded form."""
    found: dict[str, str] = {}
    for text in filter(None, map(said, values)):
        found.setdefault(text.casefold(), text)
    return [found[k] for k in sorted(found)]


def objects(value: Any) -> list[dict]:
    return [i for i in value if isinstance(i, dict)] if isinstance(value, list) else []


def countries_in(value: Any) -> list[str]:
    """All country names in a field's value, however it is nested."""
    if isinstance(value, str):
        return [p for p in re.split(r"\s*[,;|]\s*", value) if p]
    inner = value.values() if isinstance(value, dict) else value if isinstance(value, list) else ()
    return [c for v in inner for c in countries_in(v)]


def requisition(p: dict) -> str | None:
    return next(filter(None, (said(p.get(k)) for k in REQUISITION_KEYS)), None)


def custom_fields(p: dict) -> list[dict]:
    """A field's null value is kept: it is not the same as no value."""
    return records(compact(name=said(i.get("name")), value_type=said(i.get("value_type"))) | ({"value": i["value"]} if "value" in i else {}) for i in objects(p.get("metadata")))


def label(value: Any) -> dict | None:
    return compact(label=said(value.get("name") if isinstance(value, dict) else value)) or None


def place(name: Any, address: Any) -> dict | None:
    """A location's label with what its postal address says."""
    postal = address if isinstance(address, dict) else {}
    postal = postal["postalAddress"] if isinstance(postal.get("postalAddress"), dict) else postal
    return compact(label=said(name), locality=said(postal.get("addressLocality")), region=said(postal.get("addressRegion")), country=said(postal.get("addressCountry"))) or None


def other_places(p: dict) -> list[dict]:
    return records(place(i.get("location"), i.get("address")) for i in objects(p.get("secondaryLocations")))


def places_b(p: dict) -> list[dict]:
    return [*filter(None, [place(p.get("location"), p.get("address"))]), *other_places(p)]


def workplace(value: Any) -> str | None:
    text = re.sub(r"[^a-z0-9]+", "_", (said(value) or "").casefold()).strip("_")
    return ("on_site" if text == "onsite" else text) or None


def truth(value: Any) -> bool | None:
    return value if isinstance(value, bool) else None


def speaks_of_applicants(field: dict) -> bool:
    return any(t in (field.get("name") or "").casefold() for t in ELIGIBILITY_NAMES)


SHAPES: dict[str, dict[str, Reader]] = {
    "board_a": {
        "requisition_id": requisition,
        "workplace": lambda p: {},
        "primary_location": lambda p: label(p.get("location")),
        "secondary_locations": lambda p: [],
        "offices": lambda p: records(compact(name=said(i.get("name")), location=said(i.get("location"))) for i in objects(p.get("offices"))),
        "countries": lambda p: strings(c for f in custom_fields(p) if (f.get("name") or "").casefold().strip() in COUNTRY_NAMES for c in countries_in(f.get("value"))),
        "provider_metadata": custom_fields,
        "eligibility_signals": lambda p: [{"kind": "provider_metadata", **f} for f in custom_fields(p) if speaks_of_applicants(f)],
        "application": lambda p: compact(is_listed=True, posting_url=said(p.get("absolute_url")), language=said(p.get("language")), application_deadline=said(p.get("application_deadline"))),
    },
    "board_b": {
        "requisition_id": requisition,
        "workplace": lambda p: compact(type=workplace(p.get("workplaceType")), is_remote=truth(p.get("isRemote"))),
        "primary_location": lambda p: place(p.get("location"), p.get("address")),
        "secondary_locations": other_places,
        "offices": lambda p: [],
        "countries": lambda p: strings(i.get("country") for i in places_b(p)),
        "provider_metadata": lambda p: [],
        "eligibility_signals": lambda p: [],
        "application": lambda p: compact(is_listed=truth(p.get("isListed")), posting_url=said(p.get("jobUrl")), apply_url=said(p.get("applyUrl"))),
    },
}


def evidence(shape: str, provider: str) -> Callable:
    """A vectorised UDF from a payload to its evidence, for a board of one of SHAPES. What is no JSON object gives null."""
    fields = SHAPES[shape]

    def build(payload: Any) -> str | None:
        return dumps({"schema_version": VERSION, "provider": provider} | {name: read(payload) for name, read in fields.items()}) if isinstance(payload, dict) else None

    @F.pandas_udf(StringType())
    def made(values: pd.Series) -> pd.Series:
        return each(values, build)

    return made
