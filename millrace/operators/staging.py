"""The work queue as functions from state to state; the caller writes each next state as a new version. One writer at a time: row locks have no counterpart here."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WORK = "normalized_url string, stage string, state string, priority int, attempt_count int, max_attempts int, available_at timestamp, lease_owner string, lease_token string, lease_expires_at timestamp, last_error string"
STAGES = ("fetch", "parse", "enrich", "promote", "done")


def load_work(work: DataFrame, observed: DataFrame, as_of: str, max_attempts: int = 4) -> DataFrame:
    """The queue with the observed URLs: new ones are ready to be fetched, known ones keep their state and the greater priority."""
    fresh = observed.where("normalized_url IS NOT NULL").groupBy("normalized_url").agg(F.max("priority").alias("_priority"))
    both = work.join(fresh, "normalized_url", "full_outer")
    new = F.col("stage").isNull()
    values = {"stage": F.lit("fetch"), "state": F.lit("ready"), "attempt_count": F.lit(0), "max_attempts": F.lit(max_attempts), "available_at": F.lit(as_of).cast("timestamp")}
    out = both.withColumns({k: F.when(new, v).otherwise(F.col(k)) for k, v in values.items()})
    return out.withColumn("priority", F.greatest("priority", "_priority")).select(*work.columns)


def new_observations(known: DataFrame, observed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Observations whose (run_id, key) is new, one each; and the keys that come with two different payloads."""
    key = ["run_id", "observation_key"]
    conflicts = observed.groupBy(*key).agg(F.countDistinct("payload").alias("payloads")).where("payloads > 1")
    first = observed.groupBy(*key).agg(F.min_by(F.struct("*"), F.struct("payload", "url")).alias("_row")).select("_row.*")
    return first.join(known.select(*key), key, "left_anti"), conflicts


def expire(work: DataFrame, as_of: str) -> DataFrame:
    """Leases past their time go back to retry, or are dead after the last attempt."""
    now = F.lit(as_of).cast("timestamp")
    over = F.coalesce((F.col("state") == "leased") & (F.col("lease_expires_at") <= now), F.lit(False))
    dead = F.col("attempt_count") >= F.col("max_attempts")
    return _release(work.withColumns({"_over": over}), "_over", F.when(dead, "dead").otherwise("retry"), now, F.lit("lease_expired")).drop("_over")


def _release(work, flag, state, available, error):
    on = F.col(flag)
    cleared = {c: F.when(~on, F.col(c)) for c in ("lease_owner", "lease_token", "lease_expires_at")}
    return work.withColumns({"state": F.when(on, state).otherwise(F.col("state")), "available_at": F.when(on, available).otherwise(F.col("available_at")), "last_error": F.when(on, error).otherwise(F.col("last_error"))} | cleared)


def claim(work: DataFrame, stage: str, limit: int, as_of: str, lease_seconds: int, owner: str, token: str) -> DataFrame:
    """The queue with the next ``limit`` items of a stage leased: by priority, then the longest available, then the URL. The limit is the feature: a batch of a worker."""
    if stage not in STAGES[:-1]:
        raise ValueError(f"nothing is claimed in stage {stage!r}")
    if limit < 1 or lease_seconds < 1 or not owner.strip():
        raise ValueError("a claim needs at least one item, one second and an owner's name")
    now = F.lit(as_of).cast("timestamp")
    work = expire(work, as_of)
    states = ("ready", "verified", "retry") if stage == "promote" else ("ready", "retry")
    due = work.where((F.col("stage") == stage) & F.col("state").isin(*states) & (F.col("available_at") <= now) & (F.col("attempt_count") < F.col("max_attempts")))
    chosen = due.orderBy(F.desc("priority"), "available_at", "normalized_url").limit(limit).select("normalized_url", F.lit(True).alias("_claimed"))
    out = work.join(chosen, "normalized_url", "left")
    on = F.coalesce("_claimed", F.lit(False))
    return out.withColumns(
        {
            "state": F.when(on, "leased").otherwise(F.col("state")),
            "attempt_count": F.col("attempt_count") + on.cast("int"),
            "lease_owner": F.when(on, F.lit(owner)).otherwise(F.col("lease_owner")),
            "lease_token": F.when(on, F.concat_ws(":", F.lit(token), F.col("normalized_url"))).otherwise(F.col("lease_token")),
            "lease_expires_at": F.when(on, now + F.expr(f"INTERVAL {int(lease_seconds)} SECONDS")).otherwise(F.col("lease_expires_at")),
        }
    ).select(*work.columns)


def settle(work: DataFrame, results: DataFrame, as_of: str) -> DataFrame:
    """The queue after workers' results: normalized_url, lease_token, outcome (ok, failed, quarantined), error, retry_after (seconds). Only results that hold the current lease count."""
    from millrace.functions.times import backoff_seconds

    now = F.lit(as_of).cast("timestamp")
    out = work.join(results.select("normalized_url", F.col("lease_token").alias("_token"), "outcome", "error", "retry_after"), "normalized_url", "left")
    current = F.coalesce((F.col("state") == "leased") & (F.col("_token") == F.col("lease_token")) & (F.col("lease_expires_at") > now), F.lit(False))
    out = out.withColumn("_ok", current & (F.col("outcome") == "ok")).withColumn("_over", current & (F.col("outcome") != "ok"))
    wait = F.make_dt_interval(secs=backoff_seconds(F.col("attempt_count"), F.col("retry_after")))
    failed = F.when(F.col("outcome") == "quarantined", "quarantined").when(F.col("attempt_count") >= F.col("max_attempts"), "dead").otherwise("retry")
    out = _release(out, "_over", failed, now + wait, F.col("error"))
    following = F.lit(STAGES[-1])
    for a, b in zip(STAGES, STAGES[1:]):
        following = F.when(F.col("stage") == a, b).otherwise(following)
    out = _release(out, "_ok", F.when(following == STAGES[-1], "done").otherwise("ready"), now, F.lit(None).cast("string"))
    attempts = F.when(F.col("_ok"), 0).otherwise(F.col("attempt_count"))
    return out.withColumns({"stage": F.when(F.col("_ok"), following).otherwise(F.col("stage")), "attempt_count": attempts}).select(*work.columns)


def requeue(work: DataFrame, states: tuple[str, ...], as_of: str, reset_attempts: bool = False) -> DataFrame:
    """Items in these states are ready again. Attempts are kept unless reset (dead items start anew), so an exhausted quarantined item stays unclaimable."""
    on = F.col("state").isin(*states)
    reset = on & (F.lit(reset_attempts) | (F.col("state") == "dead"))
    out = work.withColumn("attempt_count", F.when(reset, 0).otherwise(F.col("attempt_count"))).withColumn("_on", on)
    return _release(out, "_on", F.lit("ready"), F.lit(as_of).cast("timestamp"), F.lit(None).cast("string")).select(*work.columns)


def latest_context(observed: DataFrame) -> DataFrame:
    """Each URL's latest observation."""
    order = Window.partitionBy("normalized_url").orderBy(F.desc("observed_at"), F.desc("observation_key"))
    return observed.where("normalized_url IS NOT NULL").withColumn("_k", F.row_number().over(order)).where("_k = 1").drop("_k")


def quarantine_duplicates(candidates: DataFrame) -> DataFrame:
    """Candidates with candidate_key and state: an id that one source brings more than once is quarantined, each row under a key of its own."""
    w = Window.partitionBy("source_id", "external_job_id")
    n, k = F.count(F.lit(1)).over(w), F.row_number().over(w.orderBy("title", F.xxhash64(*candidates.columns)))
    base = F.concat_ws(":", "source_id", "external_job_id")
    return candidates.withColumns({"candidate_key": F.when(n > 1, F.concat(base, F.lit(":duplicate-"), k.cast("string"))).otherwise(base), "state": F.when(n > 1, "quarantined").otherwise("ready")})
