"""File ingestion that resumes: a file stream whose checkpoint says which files are committed."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from millrace.sources.tables import SCHEMAS


def shared_folder(spark: SparkSession) -> str:
    """Below ``spark.checkpoint.dir``, which all machines share. Where that is unset, a local master (tests) gets a temporary folder; a cluster is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        base = tempfile.mkdtemp(prefix="spark-millrace-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/ingest-{uuid.uuid4().hex}"


def run_once(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, pattern: str | None = None, files_a_batch: int = 1000) -> None:
    """Take up every file that the checkpoint does not know, then stop. Each file is committed to the target exactly once, so a run that was cut off is repeated without loss or repeats."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    writer = reader.parquet(source).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()


def ingest_files(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The table through the stream, in two runs of one checkpoint; the second finds nothing new."""
    folder = shared_folder(spark)
    single = "parquet" in table
    for _ in range(2):
        run_once(spark, f"{sf_dir}/{table}.parquet" if single else sf_dir, SCHEMAS[table], f"{folder}/rows", f"{folder}/checkpoint", f"{table}.parquet")
    return spark.read.schema(SCHEMAS[table]).parquet(f"{folder}/rows")
