"""The application pool: lanes, scores, ranks, limits per lane, and the summary of the whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import times, urls

# Fixed values of the pool's rules.
ROLE_SCORES = {"strong": 60, "possible": 35, "weak": 5, "exclude": -60}
REMOTE_SCORES = {
    "pakistan_explicit": 52,
    "global_explicit": 48,
    "regional_unconfirmed": 16,
    "remote_unclear": 10,
    "restricted_remote": -55,
    "onsite_explicit": -65,
    "no_remote_evidence": -35,
}
APPLY_REMOTE = ("pakistan_explicit", "global_explicit")
VERIFY_REMOTE = ("regional_unconfirmed", "remote_unclear")
TARGET_ROLES = ("strong", "possible")
AGGREGATOR = r"(^|\.)(glassdoor\.com|indeed\.com|linkedin\.com)$"
NO_AGE = 1_000_000


def points(key: Column, table: dict[str, int]) -> Column:
    """Table lookup as one CASE; 0 for others."""
    out = F.lit(0)
    for name, value in table.items():
        out = F.when(key == name, value).otherwise(out)
    return out


def age_points(age: Column) -> Column:
    return F.when(age.isNull(), -5).when(age <= 7, 25).when(age <= 30, 15).when(age <= 90, 5).when(age > 180, -15).otherwise(0)


def preferred_url() -> Column:
    """The application URL, unless it is an aggregator's and the posting is not; only public ones count."""

    def public(name):
        return F.when(urls.normalize_public_url(F.trim(name)).isNotNull(), F.trim(name))

    def aggregator(url):
        return urls.host(url).rlike(AGGREGATOR)

    apply, posting = public("apply_url"), public("posting_url")
    return F.when(apply.isNotNull() & posting.isNotNull() & aggregator(apply) & ~aggregator(posting), posting).otherwise(F.coalesce(apply, posting))


def lane(url: Column, age: Column, max_age_days: int | None) -> Column:
    """struct(lane, reason); the first rule that holds decides."""

    def say(name, reason):
        return F.struct(F.lit(name).alias("lane"), F.lit(reason).alias("reason"))

    remote = F.coalesce("remote_eligibility_status", F.lit(""))
    old = age > max_age_days if max_age_days is not None else F.lit(False)
    return (
        F.when(F.coalesce(F.nullif("status", F.lit("")), F.lit("active")) != "active", say("excluded", "job is not active"))
        .when(~F.coalesce("role_match_status", F.lit("")).isin(*TARGET_ROLES), say("excluded", "role is outside the strong or possible target lanes"))
        .when(url.isNull(), say("excluded", "no public posting or application URL is available"))
        .when(F.coalesce(old, F.lit(False)), say("excluded", "posting is older than the application freshness window"))
        .when(remote.isin(*APPLY_REMOTE), say("application", "role has explicit Pakistan or worldwide remote evidence"))
        .when(remote.isin(*VERIFY_REMOTE), say("verification", "role is remote but geographic eligibility needs verification"))
        .when(remote == "restricted_remote", say("excluded", "remote eligibility is explicitly restricted"))
        .when(remote == "onsite_explicit", say("excluded", "role explicitly requires onsite or hybrid work"))
        .otherwise(say("excluded", "role lacks usable remote eligibility evidence"))
    )


def priority(age: Column) -> Column:
    link = F.when(F.coalesce("apply_url", F.lit("")) != "", 10).when(F.coalesce("posting_url", F.lit("")) != "", 5).otherwise(-20)
    managed = F.when(F.coalesce("lifecycle_managed", F.lit(False)), 10).otherwise(0)
    return points(F.col("role_match_status"), ROLE_SCORES) + points(F.col("remote_eligibility_status"), REMOTE_SCORES) + managed + link + age_points(age)


def classify(jobs: DataFrame, as_of: str, max_age_days: int | None = 90) -> DataFrame:
    """The jobs with application_lane, application_lane_reason, application_url, freshness_age_days, freshness_band and priority_score."""
    if max_age_days is not None and max_age_days < 0:
        raise ValueError("max_age_days must not be negative")
    stamps = [times.parse_iso(F.col(c)) for c in ("source_published_at", "source_updated_at", "observed_at", "last_changed_at") if c in jobs.columns]
    out = jobs.withColumn("application_url", preferred_url()).withColumn("freshness_age_days", times.age_days(F.lit(as_of).cast("timestamp"), *stamps))
    age = F.col("freshness_age_days")
    out = out.withColumns({"_lane": lane(F.col("application_url"), age, max_age_days), "freshness_band": times.freshness_band(age), "priority_score": priority(age)})
    return out.withColumns({"application_lane": F.col("_lane.lane"), "application_lane_reason": F.col("_lane.reason")}).drop("_lane")


def top_per_lane(rows: DataFrame, lane: str, score: str, age: str, ties: list[Column | str], most: int) -> DataFrame:
    """Each lane's best ``most`` rows with their rank: by score, then youngest, then ``ties`` (end them with a unique key). Spark keeps ``most`` rows a task before the shuffle (a window's group limit)."""
    order = [F.col(score).desc(), F.coalesce(age, F.lit(NO_AGE)).asc(), *ties]
    return rows.withColumn("lane_rank", F.row_number().over(Window.partitionBy(lane).orderBy(*order))).where(F.col("lane_rank") <= most)


def distribution(rows: DataFrame, column: str) -> DataFrame:
    """value, n: counts by value; null and '' are ``unknown``."""
    value = F.coalesce(F.nullif(F.col(column).cast("string"), F.lit("")), F.lit("unknown"))
    return rows.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("n"))
