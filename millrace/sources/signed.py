"""Signed outputs: tables whose content has a digest that does not depend on how their rows are laid out, and readers that refuse what was changed.

A row's digest is the SHA-256 of its columns as JSON; a table's is the sum of its rows' digests, limb by limb, with the number of rows. So it is the same for any number of files and any order,
repeated rows count as often as they are there, and it is one aggregation that is combined before the shuffle. Digests are those of the files as written, read again, and are published with the version (last, or
not at all).
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import crawl
from millrace.operators.ranks import numbered
from millrace.sources.versions import Conflict, Versions


class Changed(Exception):
    """A table's content is not what its manifest says."""


def digest(rows: DataFrame) -> tuple[int, str]:
    """The number of rows, and the digest of their content: columns in the order of their names, nulls told from empty text."""
    columns = sorted(rows.columns)
    parts = [F.coalesce(F.to_json(F.struct(F.col(f"`{c}`").alias("v"))), F.lit("")) for c in columns]
    hashed = F.sha2(F.to_json(F.array(F.lit(json.dumps(columns)), *parts)), 256)
    limbs = [F.sum(F.conv(F.substring(hashed, 1 + 16 * k, 16), 16, 10).cast("decimal(38,0)")) for k in range(4)]
    n, *sums = rows.agg(F.count(F.lit(1)), *limbs).first()
    return n, ":".join(f"{int(s or 0):x}" for s in sums)


def commit(versions: Versions, tables: dict[str, DataFrame], expected: int | None = None) -> int:
    """Write the tables, sign what lies there, and publish all of them with their signatures as one version."""
    start = versions.latest() if expected is None else expected
    if start != versions.latest():
        raise Conflict(f"version {start} is not the latest, which is {versions.latest()}")
    found, own = versions.manifest(start), uuid.uuid4().hex
    signatures = json.loads(found.pop("_signatures", "{}"))
    for name, rows in tables.items():
        path = f"{versions.folder}/data/{own}/{name}"
        rows.write.parquet(path)
        found[name], signatures[name] = path, digest(versions.spark.read.parquet(path))
    versions.publish(start + 1, found | {"_signatures": json.dumps(signatures, sort_keys=True)})
    return start + 1


def signatures(versions: Versions, version: int | None = None) -> dict[str, tuple[int, str]]:
    found = versions.manifest(versions.latest() if version is None else version)
    return {k: tuple(v) for k, v in json.loads(found.get("_signatures", "{}")).items()}


def read(versions: Versions, version: int | None = None) -> dict[str, DataFrame]:
    """The tables of a version, each checked against its signature."""
    at = versions.latest() if version is None else version
    signed, tables = signatures(versions, at), {}
    for name, path in versions.manifest(at).items():
        if name == "_signatures":
            continue
        tables[name] = versions.spark.read.parquet(path)
        if name in signed and digest(tables[name]) != signed[name]:
            raise Changed(f"{name} of version {at} is not what was signed")
    return tables


def publish_union(versions: Versions, evidence: DataFrame) -> int:
    """The union of crawls as three signed tables: ``union`` (a row a token), ``evidence`` (a row for each input and token, numbered by input, then token) and ``inputs`` (what each input added)."""
    folded = crawl.fold_tokens(evidence)
    ordered = numbered(folded, [F.col("input_order"), F.col("board_token"), F.col("crawl_id")], "row")
    return commit(versions, {"union": crawl.union_of_crawls(evidence), "evidence": ordered, "inputs": crawl.marginal(evidence)})
