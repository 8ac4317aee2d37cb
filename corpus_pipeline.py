"""The corpus pipeline: quality rules, exact dedup, SimHash near-dedup, substring dedup, best-fit packing.

Each stage gets the documents that the one before it left, with all their columns; ``run`` writes each
stage's rows to the shared folder and reads them again. The last stage returns the packed pieces.

The near-dedup stage takes five-word shingles and a similarity of 0.8 or more: candidates come from SimHash
fingerprints by Golay keys and from MinHash bands, and their similarity is verified. Of each group the row with the smallest doc_id stays; exact dedup too leaves
one row of each group. The tests hold the stages against brute-force versions, since SQL has neither the fingerprints nor the tokenizer.
"""

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import exact_dedup, near_copies, packing, quality, substring_dedup
from millrace.llm.common import MADE, cut, read, remove

#: Words that a Python worker remembers while packing, and bytes that it encodes at once; small, since the workers live on beside the other stages.
MEMO_PARTS = 100_000
CHUNK_BYTES = 2 << 20


#: Bytes and rows that go to a Python worker at once. Each task has such a batch on both sides of the pipe, beside the heap that all stages share.
BATCH = {"spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20), "spark.sql.execution.arrow.maxRecordsPerBatch": "2000"}


#: Tables that the stage before made for itself.
_LEFT: list[str] = []


def bounded(stage):
    """The stage, with BATCH set in the session; it stays set, since the rows that a stage returns are made later.

    A stage is called when the result of the one before has been written, so what that one wrote for itself is deleted first.
    """

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for key, value in BATCH.items():
            spark.conf.set(key, value)
        remove(spark, _LEFT)
        before = len(MADE)
        found = stage(spark, docs, sf_dir)
        _LEFT[:] = MADE[before:]
        return found

    return run


@bounded
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep(docs)


@bounded
def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_one(docs)


@bounded
def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_copies.keep(docs)


@bounded
def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring_dedup.apply(docs)


@bounded
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.run(docs, memo_parts=MEMO_PARTS, chunk_bytes=CHUNK_BYTES)


STAGES = [("quality_rules", quality_rules), ("exact_dedup", exact), ("simhash_near_dedup", near), ("substring_dedup", substrings), ("best_fit_packing", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs, name)
    return docs
