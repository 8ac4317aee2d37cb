"""What the corpus operators share: the shared folder, tables cut from their lineage, sizes."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: Bytes that separate words: the complement of the class [^\x20\x09-\x0D].
SPACES = b" \t\n\x0b\x0c\r"
LOWER_TABLE = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``. Where that is unset, a local master (tests) gets a temporary folder; a cluster is an error, since its machines do not share one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        base = tempfile.mkdtemp(prefix="spark-millrace-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/millrace-{uuid.uuid4().hex}"


#: The tables that ``cut`` made, for those who know when they are done with.
MADE: list[str] = []


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables that nothing reads any more."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: its rows are fixed, its lineage is gone, and a lost executor costs a re-read."""
    path = f"{shared_dir(df.sparkSession)}/{name}"
    MADE.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_hash(df: DataFrame, prefix: str = "") -> Column:
    """A hash over the columns of ``df`` (maps have none); ``prefix`` names the struct that holds them."""
    return F.xxhash64(*[F.col(f"{prefix}`{n}`") for n, t in df.dtypes if "map<" not in t])


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
