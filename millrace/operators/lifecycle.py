"""The life of postings under complete and observation-only snapshots.

``apply_snapshot`` is a function from (current table, snapshot) to (next table, counters); the caller writes the next table as a new
version. Both sides meet in one full outer join on (source, external id).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MISSES_TO_CLOSE = 2
KEY = ("source_id", "external_job_id")
STATE = ("status", "consecutive_misses", "content_hash", "first_seen_at", "last_seen_at", "last_changed_at", "closed_at")


def diff(current: DataFrame, snapshot: DataFrame, keys: Sequence[str], hash_column: str) -> DataFrame:
    """keys, known, seen, same_hash: a row for each key of either side."""
    a = current.select(*keys, F.lit(True).alias("known"), F.col(hash_column).alias("_old"))
    b = snapshot.select(*keys, F.lit(True).alias("seen"), F.col(hash_column).alias("_new"))
    both = a.join(b, list(keys), "full_outer")
    return both.select(*keys, F.coalesce("known", F.lit(False)).alias("known"), F.coalesce("seen", F.lit(False)).alias("seen"), F.col("_old").eqNullSafe(F.col("_new")).alias("same_hash"))


def diff_counters(changes: DataFrame) -> DataFrame:
    """added, updated, unchanged, missed of ``diff``."""
    known, seen, same = F.col("known"), F.col("seen"), F.col("same_hash")
    return changes.agg(
        F.count_if(seen & ~known).alias("added"),
        F.count_if(seen & known & ~same).alias("updated"),
        F.count_if(seen & known & same).alias("unchanged"),
        F.count_if(known & ~seen).alias("missed"),
    )


def apply_snapshot(current: DataFrame, snapshot: DataFrame, as_of: str, complete: bool = True, public: Sequence[str] = ("title", "location", "posting_url")) -> tuple[DataFrame, DataFrame]:
    """The next state of every job of the snapshot's sources, and one row of counters.

    current: KEY, STATE and the public columns. snapshot: KEY, content_hash and the public columns, each key once.
    An observation-only snapshot (``complete`` false) says nothing about the jobs that it lacks.
    """
    now = F.lit(as_of).cast("timestamp")
    a = current.select(*KEY, *STATE, *public, F.lit(True).alias("_known"))
    b = snapshot.select(*KEY, F.col("content_hash").alias("_hash"), *[F.col(c).alias(f"_{c}") for c in public], F.lit(True).alias("_seen"))
    both = a.join(b, list(KEY), "full_outer")
    known, seen = F.coalesce("_known", F.lit(False)), F.coalesce("_seen", F.lit(False))
    closed = known & (F.col("status") == "closed")
    changed = seen & known & ~F.col("content_hash").eqNullSafe(F.col("_hash"))
    reopened = seen & closed
    absent = known & ~seen if complete else F.lit(False)
    misses = F.when(seen, 0).when(absent & ~closed, F.col("consecutive_misses") + 1).otherwise(F.col("consecutive_misses"))
    closes = absent & ~closed & (misses >= MISSES_TO_CLOSE)
    judged = both.select(
        *KEY,
        F.when(seen, F.lit("active")).when(closes, F.lit("closed")).otherwise(F.col("status")).alias("status"),
        misses.cast("int").alias("consecutive_misses"),
        F.when(seen, F.col("_hash")).otherwise(F.col("content_hash")).alias("content_hash"),
        F.when(known, F.col("first_seen_at")).otherwise(now).alias("first_seen_at"),
        F.when(seen, now).otherwise(F.col("last_seen_at")).alias("last_seen_at"),
        F.when(~known | changed | reopened, now).otherwise(F.col("last_changed_at")).alias("last_changed_at"),
        F.when(seen, F.lit(None)).when(closes, now).otherwise(F.col("closed_at")).alias("closed_at"),
        *[F.when(seen, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in public],
        F.struct(
            (seen & ~known).alias("added"),
            changed.alias("updated"),
            (seen & known & ~changed).alias("unchanged"),
            absent.alias("missed"),
            closes.alias("closed"),
            reopened.alias("reactivated"),
        ).alias("_did"),
    )
    names = ("added", "updated", "unchanged", "missed", "closed", "reactivated")
    counters = judged.agg(*[F.count_if(F.col(f"_did.{n}")).alias(f"jobs_{n}") for n in names])
    return judged.drop("_did"), counters


def snapshot_problems(header: DataFrame, snapshot: DataFrame) -> DataFrame:
    """source_id, outcome, problems: whether each snapshot may be applied. header: source_id, expected_source_id, is_complete, http_status, errors (array).

    ``succeeded`` needs completeness, a matching source, no errors, status 200 (or none), and non-blank unique ids and titles; what is left is
    ``partial`` if the status was 200, else ``failed``. Such runs change no job.
    """
    blank = F.trim(F.coalesce("external_job_id", F.lit(""))) == ""
    untitled = F.trim(F.coalesce("title", F.lit(""))) == ""
    jobs = snapshot.groupBy("source_id", "external_job_id").agg(F.count(F.lit(1)).alias("n"), F.max(blank).alias("blank"), F.max(untitled).alias("untitled"))
    jobs = jobs.groupBy("source_id").agg(F.max(F.col("n") > 1).alias("repeated"), F.max("blank").alias("blank"), F.max("untitled").alias("untitled"))
    checked = header.join(jobs, "source_id", "left")
    tests = {
        "incomplete": ~F.col("is_complete"),
        "wrong_source": ~F.col("source_id").eqNullSafe(F.col("expected_source_id")),
        "adapter_errors": F.size(F.coalesce("errors", F.array())) > 0,
        "http_status": F.col("http_status").isNotNull() & (F.col("http_status") != 200),
        "repeated_id": F.coalesce("repeated", F.lit(False)),
        "blank_id": F.coalesce("blank", F.lit(False)),
        "blank_title": F.coalesce("untitled", F.lit(False)),
    }
    problems = F.array_compact(F.array(*[F.when(t, F.lit(n)) for n, t in tests.items()]))
    outcome = F.when(F.size("problems") == 0, "succeeded").when(F.col("http_status") == 200, "partial").otherwise("failed")
    return checked.withColumn("problems", problems).select("source_id", outcome.alias("outcome"), "problems")


def presence_history(presence: DataFrame, key: str, day: str, last_day: Column, misses_to_close: int = MISSES_TO_CLOSE) -> DataFrame:
    """The lifecycle over a whole history of daily complete snapshots, from the days on which each key was seen: first_day, last_day, closures, reactivations, missed, misses, status."""
    seen = presence.select(key, day).distinct()
    following = F.lead(day).over(Window.partitionBy(key).orderBy(day))
    gaps = seen.select(key, F.col(day).alias("_day"), (F.coalesce(following, F.date_add(last_day, 1)) - F.col(day)).alias("_apart"), following.isNull().alias("_last"))
    gap = F.extract(F.lit("DAY"), "_apart").cast("int") - 1
    gaps = gaps.withColumn("_gap", gap)
    closes = F.col("_gap") >= misses_to_close
    return gaps.groupBy(key).agg(
        F.min("_day").alias("first_day"),
        F.max("_day").alias("last_day"),
        F.count_if(closes).alias("closures"),
        F.count_if(closes & ~F.col("_last")).alias("reactivations"),
        F.sum("_gap").alias("missed"),
        F.max(F.when(F.col("_last"), F.least("_gap", F.lit(misses_to_close)))).alias("misses"),
        F.max(F.when(F.col("_last"), F.when(closes, "closed").otherwise("active"))).alias("status"),
    )
