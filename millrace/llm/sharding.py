"""Sharding by a Feistel permutation with cycle walking over global row numbers (DataFrame functions only).

1. Equal (doc_id, size, text_crc32) rows are folded to one row with a count before anything is
   numbered, so repeated rows cannot make a bucket hot.
2. Rows fall into hash buckets; a bucket's first number is the rows of all buckets before it, and
   a row's is its place in its bucket. This numbers all rows from 0 without a global sort; the
   numbers depend on the rows only, not on files or partitions.
3. The numbers go through a keyed Feistel network over Z_a x Z_b with a = ceil(sqrt(n)) and
   b = ceil(n / a). Its domain has fewer than a numbers beyond n; a row sent there walks on, by the
   permutation itself, until it is back among the n (cycle walking). ``walk_bound`` finds the
   longest such walk from those few numbers, so the walk in the plan is long enough by proof.
4. With x the permuted number, shard = x mod shards and slot = x div shards: the inverse
   permutation finds the row of any (shard, slot) with no index.

Law: ``rows``; counts differ by one at most. There are no groups here: equal texts are
numbered like any other rows. Null text: size 1, the CRC of no bytes. Null doc_id: a value like any other. Repeated
rows get distinct slots. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, shuffle_partitions

ROUNDS = 4
SEED = 20240229
ROWS_A_BUCKET = 1_000_000
CHUNK = 100_000


def round_value(x: Column, k: Column, seed: int, modulus: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed).cast("long"), k, x), F.lit(modulus).cast("long"))


def feistel(x: Column, a: int, b: int, seed: int = SEED, rounds: int = ROUNDS) -> Column:
    """The permutation of 0 .. a*b-1: x = left * b + right, and each round changes both halves in turn."""

    def one_round(state: Column, k: Column) -> Column:
        left = F.pmod(state["l"] + round_value(state["r"], k * 2, seed, a), F.lit(a).cast("long"))
        right = F.pmod(state["r"] + round_value(left, k * 2 + 1, seed, b), F.lit(b).cast("long"))
        return F.struct(left.alias("l"), right.alias("r"))

    wide = F.lit(b).cast("long")
    start = F.struct(((x - F.pmod(x, wide)) / wide).cast("long").alias("l"), F.pmod(x, wide).alias("r"))
    if a * b >= 1 << 52:
        raise ValueError("more rows than the halves can be split exactly")
    return F.aggregate(F.sequence(F.lit(0).cast("long"), F.lit(rounds - 1).cast("long")), start, one_round, lambda s: s["l"] * wide + s["r"])


def halves(n: int) -> tuple[int, int]:
    a = max(1, math.isqrt(max(0, n - 1)) + 1)
    return a, max(1, -(-n // a))


def walk_bound(spark: SparkSession, n: int, seed: int = SEED) -> int:
    """The most passes after the first that a number below n needs to come back below n; looks at the fewer than sqrt(n) + 1 numbers beyond n."""
    a, b = halves(n)
    if a * b == n:
        return 0
    beyond = spark.range(n, a * b).select(F.col("id").alias("begun"), F.col("id").alias("x"))
    passes = 0
    while not beyond.isEmpty():
        passes += 1
        # A cycle of numbers beyond n only is back where it began; no number below n leads into it.
        beyond = cut(beyond.select("begun", feistel(F.col("x"), a, b, seed).alias("x")), "walks").where(F.col("x") >= n).where("x <> begun")
    return passes


def permute(x: Column, n: int, passes: int, seed: int = SEED) -> Column:
    a, b = halves(n)
    first = feistel(x, a, b, seed)
    if not passes:
        return first
    return F.aggregate(F.sequence(F.lit(1), F.lit(passes)), first, lambda y, _: F.when(y < n, y).otherwise(feistel(y, a, b, seed)))


def numbered(docs: DataFrame) -> tuple[DataFrame, int]:
    """doc_id, size, text_crc32, number: every row once; and the number of rows."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    key = ["doc_id", "size", "text_crc32"]
    folded = cut(rows.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")), "rows")
    total = folded.agg(F.sum("copies").alias("n"), F.max("copies").alias("most")).first()
    n, most = total["n"] or 0, total["most"] or 0
    buckets = max(1024, -(-n // ROWS_A_BUCKET))
    folded = folded.withColumn("bucket", F.pmod(F.xxhash64(*key), F.lit(buckets).cast("long")))
    before = folded.groupBy("bucket").agg(F.sum("copies").alias("in_bucket"))
    before = before.select("bucket", (F.sum("in_bucket").over(Window.orderBy("bucket")) - F.col("in_bucket")).alias("before"))
    inside = F.sum("copies").over(Window.partitionBy("bucket").orderBy(*key).rowsBetween(Window.unboundedPreceding, 0)) - F.col("copies")
    # At most ``buckets`` rows: 1024, or one for each million documents.
    placed = folded.withColumn("inside", inside).join(F.broadcast(before), "bucket")
    placed = placed.withColumn("first", F.col("before") + F.col("inside"))
    if most == 1:
        return placed.select(*key, F.col("first").alias("number")), n
    placed = placed.select(*key, "first", "copies", F.explode(F.expr(f"sequence(0L, (copies - 1) div {CHUNK}L)")).alias("chunk"))
    if most > CHUNK:
        placed = placed.repartition(shuffle_partitions(docs.sparkSession), "first", "chunk")
    each = F.explode(F.expr(f"sequence(chunk * {CHUNK}L, least(copies, (chunk + 1) * {CHUNK}L) - 1)")).alias("copy")
    return placed.select(*key, "first", each).select(*key, (F.col("first") + F.col("copy")).alias("number")), n


def assign(docs: DataFrame, shards: int = 16, seed: int = SEED) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: a row for each document."""
    rows, n = numbered(docs)
    spot = permute(F.col("number"), n, walk_bound(docs.sparkSession, n, seed), seed) if n else F.col("number")
    rows = rows.select("doc_id", "size", "text_crc32", spot.alias("spot"))
    wide = F.lit(shards).cast("long")
    return rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.pmod("spot", wide).cast("int").alias("shard"),
        F.expr(f"spot div {shards}L").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = 16, seed: int = SEED) -> None:
    """The documents themselves as Parquet, a folder for each shard, with their slots; rows that agree in doc_id, size and CRC are told apart by rank."""
    key = ["doc_id", "size", "text_crc32"]
    rank = Window.partitionBy(*key)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = rows.withColumn("rank", F.row_number().over(rank.orderBy(F.xxhash64("_row.text"))))
    spots = assign(docs, shards, seed).withColumn("rank", F.row_number().over(rank.orderBy("shard", "slot")))
    same = [rows[c].eqNullSafe(spots[c]) for c in (*key, "rank")]
    found = rows.join(spots, same).select("_row", spots["shard"].alias("_shard"), spots["slot"].alias("_slot"))
    found.repartition("_shard", F.expr("_slot div 1000000")).sortWithinPartitions("_shard", "_slot").select("_shard", "_slot", "_row.*").write.partitionBy("_shard").parquet(path)
