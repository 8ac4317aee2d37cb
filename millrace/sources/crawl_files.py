"""Crawl files: an index table whose partitions are added by name and pruned in the plan, and a CSV reader that fails closed."""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")
PART = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")


def identifier(name: str) -> str:
    """A table's name, with or without a database, if it needs no quotes; else an error."""
    if not all(NAME.fullmatch(p) for p in name.split(".")) or name.count(".") > 1:
        raise ValueError(f"not an identifier: {name!r}")
    return name


def part(value: str) -> str:
    if not PART.fullmatch(value):
        raise ValueError(f"not a partition's name: {value!r}")
    return value


def create_index(spark: SparkSession, table: str, schema: str, folder: str) -> None:
    """An index table over ``folder``, partitioned by crawl and subset; it starts without partitions."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {identifier(table)} ({schema}, crawl STRING, subset STRING) USING parquet PARTITIONED BY (crawl, subset) LOCATION '{folder}'")


def add_partition(spark: SparkSession, table: str, crawl: str, subset: str, location: str | None = None) -> None:
    """Make a crawl's subset known; a second time it changes nothing."""
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"ALTER TABLE {identifier(table)} ADD IF NOT EXISTS PARTITION (crawl = '{part(crawl)}', subset = '{part(subset)}'){at}")


class BadFile(Exception):
    """A file is not of the form that its reader asks for."""


def header_of(spark: SparkSession, path: str) -> list[str]:
    """The names in the first line of the file at ``path`` (one file)."""
    first = spark.read.text(path).limit(1).collect()
    if not first:
        raise BadFile(f"{path} is empty")
    return next(csv.reader(io.StringIO(first[0][0].removeprefix("﻿"))))


def strict_csv(spark: SparkSession, path: str, required: Sequence[str], reserved: Sequence[str] = ()) -> DataFrame:
    """The rows of one CSV file, all columns as text. Repeated or blank names, names in ``reserved``, and missing columns of ``required`` are errors at once; a row with more or fewer values than the header is one when it is read."""
    names = header_of(spark, path)
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated or any(not n.strip() for n in names):
        raise BadFile(f"{path} has repeated or blank column names: {repeated}")
    if missing := [n for n in required if n not in names]:
        raise BadFile(f"{path} lacks {', '.join(missing)}")
    if taken := [n for n in names if n in reserved]:
        raise BadFile(f"{path} has reserved names: {', '.join(taken)}")
    schema = ", ".join(f"`{n}` string" for n in names)
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").option("multiLine", True).option("escape", '"').csv(path)


def candidates(spark: SparkSession, path: str, crawl: str, order: int) -> DataFrame:
    """A crawl's candidate file as evidence of ``operators.crawl``: tokens must not be blank and counts must be numbers above zero, or reading fails."""
    needed = ["board_token", "example_observed_url", "observation_count", "first_observed_at", "last_observed_at"]
    rows = strict_csv(spark, path, needed, reserved=["crawl_id", "input_order"])
    count = F.col("observation_count").try_cast("long")
    bad = (F.trim(F.coalesce("board_token", F.lit(""))) == "") | ~F.coalesce(count > 0, F.lit(False))
    checked = F.when(bad, F.raise_error(F.concat(F.lit("bad candidate in "), F.lit(path), F.lit(": "), F.coalesce("board_token", F.lit(""))))).otherwise(F.trim("board_token"))
    times = [F.col(c).try_cast("timestamp").alias(c) for c in ("first_observed_at", "last_observed_at")]
    return rows.select(F.lit(order).alias("input_order"), F.lit(part(crawl)).alias("crawl_id"), checked.cast("string").alias("board_token"), "example_observed_url", count.alias("observation_count"), *times)
