"""A corpus for training, from documents to packed sequences, in stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read
again as the `docs` of the next. All but the last return the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapflow.llm.decontaminate import clean_documents
from snapflow.llm.line_dedup import without_repeats
from snapflow.llm.packing import pack
from snapflow.llm.quality_rules import apply_rules
from snapflow.llm.simhash import keep_one
from snapflow.sources.tables import settle

#: No SQL: xxhash64 fingerprints and token ids have none in DuckDB.
ORACLE_SQL = None


def _counted(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The columns, in order, with n_chars made anew where there is one."""
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        docs = docs.withColumn("n_chars", F.length("text").cast(kind))
    return docs.select(*columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, without lines that are their host's boilerplate."""
    return _counted(apply_rules(docs), docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that stand earlier; one of which too few words are left goes."""
    return _counted(without_repeats(docs), docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by their fingerprints."""
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no more than a trace of the benchmark."""
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences."""
    return pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", dedup_lines),
    ("simhash_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *before, (_, last) = STAGES
    for name, stage in before:
        docs = settle(stage(spark, docs, sf_dir), name)
    return last(spark, docs, sf_dir)
