"""JSON in one form for each value, its digests, and its plain text.

The form: keys in the order of their code points, no spaces, nulls kept, everything beyond ASCII escaped, numbers as a double or an integer of any size is written shortest.
``to_json`` has none of these, and VARIANT keeps no difference between 1 and 1.0; so these are vectorised UDFs around the JSON reader, a row at a time inside a batch. A repeated key keeps its last
value. What is no JSON gives null.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def dumps(value: Any) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"))


def each(values: pd.Series, change: Callable[[Any], str | None]) -> pd.Series:
    """``change`` of each JSON text; null for nulls and for what is no JSON."""

    def one(text):
        if text is None:
            return None
        try:
            return change(json.loads(text))
        except (ValueError, RecursionError):
            return None

    return pd.Series([one(t) for t in values], dtype=object)


@F.pandas_udf(StringType())
def canonical_json(values: pd.Series) -> pd.Series:
    return each(values, dumps)


@F.pandas_udf(StringType())
def json_sha256(values: pd.Series) -> pd.Series:
    """SHA-256 of the canonical form, in lower-case hex."""
    return each(values, lambda v: hashlib.sha256(dumps(v).encode()).hexdigest())


def plain(value: Any) -> str:
    """A value's text: keys and values in their order, one space between; nothing for nulls and empty values, true and false as in JSON."""
    if isinstance(value, bool):
        return dumps(value)
    if isinstance(value, dict):
        parts = (f"{k} {plain(v)}".strip() for k, v in value.items())
    elif isinstance(value, list):
        parts = map(plain, value)
    else:
        return "" if value is None else str(value).strip()
    return " ".join(p for p in parts if p)


@F.pandas_udf(StringType())
def json_text(values: pd.Series) -> pd.Series:
    return each(values, plain)


def hashed_content(fields: dict[str, Column]) -> Column:
    """SHA-256 of an object's canonical form. Values are JSON texts (as ``quoted`` gives for strings); null stands for null and is kept."""
    members = [F.concat(F.lit(json.dumps(k) + ":"), F.coalesce(v, F.lit("null"))) for k, v in fields.items()]
    return json_sha256(F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}")))


def quoted(text: Column) -> Column:
    """A string as JSON; null stays null."""
    return F.when(text.isNotNull(), F.regexp_extract(F.to_json(F.struct(text.alias("v"))), r"(?s)^\{\"v\":(.*)\}$", 1))
