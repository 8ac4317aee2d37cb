"""Exact dedup by skew-safe combining (DataFrame functions only).

1. Local: rows are grouped by (digest, content, salt). The salt is that of the scan's
   partition, so Spark's map-side aggregation leaves at most one row for each text and
   task; a text that a third of all rows share becomes one row a task before anything moves.
2. Salted: the shuffle by (digest, content, salt) merges those into at most ``salts`` rows a text.
3. Global: the salt winners are merged by (digest, content).

The content is a grouping key at every stage, so texts are the same group only when they
are equal, whatever their digests. The winners without their texts are then a table of one
narrow row for each distinct text. Documents find their winner by digest in a join that
adaptive execution splits where one digest is hot. If the table shows a digest with two
contents, documents are joined by digest and content instead.

Defined results: null text counts as empty. The row with the largest doc_id stays; a null
doc_id is smaller than every other, and a group with null doc_ids only has a null keep_id.
Rows that repeat a doc_id within a group are all marked kept if that doc_id is the group's
largest, and ``keep`` leaves them all; ``keep_one`` leaves one row of each group, groups of null doc_ids too. An empty table gives an
empty result. Other columns are ignored by ``assign`` and carried by ``keep`` and ``keep_one``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, cut, row_hash

SALTS = 16


def ascii_lower(text: Column) -> Column:
    """A-Z only. ``lower`` is the same, and much faster, where all characters are ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def normalised(text: str = "text") -> Column:
    return ascii_lower(F.coalesce(F.col(text), F.lit("")))


def sha256(content: Column) -> Column:
    return F.unhex(F.sha2(content, 256))


def winners(docs: DataFrame, digest=sha256, salts: int = SALTS) -> DataFrame:
    """digest, content, keep_id, group_size: a row for each distinct normalised text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised().alias("content"))
    rows = rows.select("doc_id", "content", digest(F.col("content")).alias("digest"), F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt"))
    salted = rows.groupBy("digest", "content", "salt").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return salted.groupBy("digest", "content").agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))


def _found(docs: DataFrame, digest, salts: int) -> DataFrame:
    """_row, doc_id, content, digest, keep_id, group_size: each document with its winner; columns that are not selected are not shuffled."""
    won = winners(docs, digest, salts)
    by_digest = won.groupBy("digest").agg(F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size"), F.count(F.lit(1)).alias("contents"))
    slim = cut(by_digest, "winners")
    rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").cast("long").alias("doc_id"), normalised().alias("content"))
    rows = rows.withColumn("digest", digest(F.col("content")))
    if slim.where("contents > 1").isEmpty():
        return rows.join(slim.drop("contents"), "digest")
    return rows.join(won, ["digest", "content"])


def assign(docs: DataFrame, digest=sha256, salts: int = SALTS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: a row for each document, dropped ones too."""
    sha = F.lower(F.hex("digest")) if digest is sha256 else F.sha2("content", 256)
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return _found(docs, digest, salts).select("doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"), kept.alias("kept"), sha.alias("text_sha256"))


def keep(docs: DataFrame, digest=sha256, salts: int = SALTS) -> DataFrame:
    """The documents that stay, with all their columns."""
    return _found(docs, digest, salts).where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).select("_row.*")


def keep_one(docs: DataFrame, digest=sha256, salts: int = SALTS) -> DataFrame:
    """One row of each group, with all its columns: that with the largest doc_id, of those the one with the least hash over its columns.

    Only groups with more than one row can have ties; they are merged by digest and content, in each task before anything moves.
    """
    stay = _found(docs, digest, salts).where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    alone = stay.where("group_size = 1").select("_row.*")
    rows = stay.where("group_size > 1").groupBy("digest", normalised("_row.text").alias("content"))
    return alone.union(rows.agg(F.min_by("_row", row_hash(docs, "_row.")).alias("_row")).select("_row.*"))
