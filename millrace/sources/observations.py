"""URL observations from files, as rows for the staging operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text, times, urls

FIELDS = ("url", "observed_url", "observation_key", "observed_at", "priority")
MOST_PAYLOAD_BYTES = 900_000


def read_rows(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """CSV with a header, JSON lines (.jsonl, .ndjson) or a JSON array, by suffix; the named columns, all as text. Broken rows stop the job."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    if path.endswith(".csv"):
        rows = spark.read.option("header", True).option("mode", "FAILFAST").option("enforceSchema", False).option("multiLine", True).option("escape", '"')
        return rows.schema(schema).csv(path)
    return spark.read.option("mode", "FAILFAST").option("multiLine", path.endswith(".json")).schema(schema).json(path)


def observations(rows: DataFrame, source: str) -> DataFrame:
    """source, url, normalized_url, host, observation_key, observed_at, priority, payload, error.

    Columns that are not an observation's own become its payload, without nulls and empty text. A bad URL or priority is kept, with ``error``. A
    payload above the bound is replaced by its size and digest. The key is the given one, else a digest of source, URL and payload.
    """
    extra = [c for c in rows.columns if c not in FIELDS]
    own = {c: F.col(c) if c in rows.columns else F.lit(None).cast("string") for c in FIELDS}
    url = text.first_text(own["url"], own["observed_url"])
    payload = F.to_json(F.struct(*[F.nullif(F.col(c).cast("string"), F.lit("")).alias(c) for c in sorted(extra)])) if extra else F.lit("{}")
    out = rows.select(url.alias("url"), own["observation_key"].alias("_key"), own["observed_at"].alias("_at"), own["priority"].alias("_priority"), payload.alias("payload"))
    too_long = F.octet_length("payload") > MOST_PAYLOAD_BYTES
    out = out.withColumn("payload", F.when(too_long, F.to_json(F.struct(F.octet_length("payload").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256")))).otherwise(F.col("payload")))
    normal, priority = urls.normalize_work_url(F.col("url")), F.coalesce(text.safe_int(F.col("_priority")), F.lit(0))
    bad_priority = (F.col("_priority").isNotNull() & text.safe_int(F.col("_priority")).isNull()) | (F.abs(priority) > 1_000_000)
    error = F.when(normal.isNull(), "invalid_observation_url").when(bad_priority, "invalid_priority").when(F.col("_at").isNotNull() & times.parse_iso(F.col("_at")).isNull(), "invalid_timestamp")
    digest = F.sha2(F.concat_ws("\0", F.lit(source), F.coalesce(normal, "url"), "payload"), 256)
    given = F.nullif(F.trim("_key"), F.lit(""))
    key = F.when(given.isNull(), digest).when(F.char_length(given) > 512, F.sha2(F.concat_ws("\0", F.lit(source), given, "url"), 256)).otherwise(given)
    return out.select(
        F.lit(source).alias("source"), "url", F.when(error.isNull(), normal).alias("normalized_url"), urls.host(normal).alias("host"), key.alias("observation_key"),
        times.parse_iso(F.col("_at")).alias("observed_at"), priority.alias("priority"), "payload", error.alias("error"),
    )
