"""Sinks: new table versions from upserts, checks, and queue exports."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.versions import Versions


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], action: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """The next version of ``old``: rows of ``new`` (each key once) insert or replace; ``keep`` columns stay as they were in rows that exist. Plain Parquet has no MERGE, so the result is written as a new version."""
    a, b = old.withColumn("_a", F.lit(True)).alias("a"), new.withColumn("_b", F.lit(True)).alias("b")
    both = a.join(b, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys], "full_outer")
    fresh = F.col("_b").isNotNull()
    columns = []
    for c in old.columns:
        if c not in new.columns:
            columns.append(F.col(f"a.{c}").alias(c))
        elif c in keep:
            columns.append(F.when(F.col("_a").isNotNull(), F.col(f"a.{c}")).otherwise(F.col(f"b.{c}")).alias(c))
        else:
            columns.append(F.when(fresh, F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")).alias(c))
    if action:
        columns.append(F.when(F.col("_a").isNull(), "inserted").when(~fresh, "kept").otherwise("updated").alias(action))
    return both.select(*columns)


def insert_new(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``old`` and those rows of ``new`` whose key it lacks."""
    return old.unionByName(new.join(old.select(*keys), list(keys), "left_anti"))


def checked(rows: DataFrame, checks: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass all checks, and those that do not, with ``failed``: the names of the checks that are false or null."""
    failed = F.array_compact(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in checks.items()]))
    marked = rows.withColumn("failed", failed)
    return marked.where(F.size("failed") == 0).drop("failed"), marked.where(F.size("failed") > 0)


def flat_for_csv(rows: DataFrame) -> DataFrame:
    """Lists of text joined by '; ', other nested values as JSON."""
    out = []
    for name, kind in rows.dtypes:
        if kind == "array<string>":
            out.append(F.concat_ws("; ", name).alias(name))
        elif kind.startswith(("array", "struct", "map")):
            out.append(F.to_json(name).alias(name))
        else:
            out.append(F.col(name))
    return rows.select(*out)


def write_queue(rows: DataFrame, path: str) -> int:
    """The queue as JSON lines and as CSV in a version of its own, which one pointer publishes when both are there; the version before stays readable meanwhile. Returns the version."""
    versions = Versions(rows.sparkSession, path)
    start, folder = versions.latest(), f"{path.rstrip('/')}/data/{uuid.uuid4().hex}"
    rows.write.json(f"{folder}/json")
    flat_for_csv(rows).write.option("header", True).option("escape", '"').csv(f"{folder}/csv")
    versions.publish(start + 1, {"json": f"{folder}/json", "csv": f"{folder}/csv"})
    return start + 1


def queue_paths(spark: SparkSession, path: str) -> dict[str, str]:
    """Where the latest version's ``json`` and ``csv`` lie."""
    versions = Versions(spark, path)
    return versions.manifest(versions.latest())


def store_bodies(store: DataFrame, bodies: DataFrame) -> DataFrame:
    """Bodies by content hash: those that the store lacks. bodies: body (binary)."""
    hashed = bodies.withColumn("body_sha256", F.sha2("body", 256)).dropDuplicates(["body_sha256"])
    return hashed.join(store.select("body_sha256"), "body_sha256", "left_anti")
