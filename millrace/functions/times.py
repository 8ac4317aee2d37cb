"""Times as Column functions. Nothing here reads the clock: ``as_of`` is a parameter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_iso(text: Column) -> Column:
    """ISO-8601 with or without a zone (then the session's, UTC); null if it cannot be read."""
    return F.trim(text).try_cast("timestamp")


def age_days(as_of: Column, *times: Column) -> Column:
    """Whole days from the first known time to as_of, not negative."""
    seconds = F.timestamp_diff("SECOND", F.coalesce(*times), as_of)
    return F.when(seconds.isNotNull(), F.floor(F.greatest(seconds, F.lit(0)) / 86400).cast("int"))


def freshness_band(age: Column) -> Column:
    return F.when(age.isNull(), "unknown").when(age <= 7, "0_7_days").when(age <= 30, "8_30_days").when(age <= 90, "31_90_days").when(age <= 180, "91_180_days").otherwise("over_180_days")


def from_epoch_millis(ms: Column) -> Column:
    """Null before 2000-01-01."""
    return F.when(ms >= 946684800000, F.timestamp_millis(ms))


def backoff_seconds(attempt: Column, retry_after: Column, first: int = 5, most: int = 300) -> Column:
    """first * 2^(attempt - 1), at least what the server asked for, at most ``most``."""
    own = F.least(F.lit(first) * F.pow(F.lit(2), F.least(attempt - 1, F.lit(30))), F.lit(most))
    return F.least(F.greatest(own, F.coalesce(retry_after, F.lit(0))), F.lit(most)).cast("int")


MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
HTTP_DATE = r"^\s*(?:[A-Za-z]{3},\s*)?(\d{1,2}) ([A-Za-z]{3}) (\d{4}) (\d{2}:\d{2}:\d{2}) (?:GMT|UTC|[+-]0000)\s*$"


def retry_after(value: Column, now: Column) -> Column:
    """Seconds to wait, at least 0, as a number of seconds or an HTTP date in GMT says it; null for anything else. ``now`` is UTC without a zone."""

    def piece(k):
        return F.regexp_extract(value, HTTP_DATE, k)

    month = F.nullif(F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(piece(2))), F.lit(0))
    at = F.concat(piece(3), F.lit("-"), F.lpad(month.cast("string"), 2, "0"), F.lit("-"), F.lpad(piece(1), 2, "0"), F.lit(" "), piece(4)).try_cast("timestamp_ntz")
    seconds = F.coalesce(value.try_cast("double"), F.timestamp_diff("SECOND", now, at).cast("double"))
    return F.when(seconds.isNotNull(), F.greatest(seconds, F.lit(0.0)))
