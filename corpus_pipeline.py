"""From documents to packed training sequences: every stage is one operator of ``citymart.llm``.

Each stage takes the rows its predecessor kept, written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citymart.llm.mixing import mix_documents
from citymart.llm.names import unused
from citymart.llm.packing import pack_documents
from citymart.llm.queries import TOKENIZER
from citymart.llm.secrets import mask_secrets
from citymart.llm.simhash import drop_duplicates
from citymart.llm.toxicity import fit, reject_toxic
from citymart.session import staged_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.7; the model is fitted on the labelled ones among ``docs``."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return reject_toxic(docs, fit(docs, labels, label_col="toxic"), threshold=0.7)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies."""
    return drop_duplicates(docs, words=3, bits=2)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked and their lengths counted anew."""
    masked = mask_secrets(docs, mark="[secret]")
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        masked = masked.withColumn("n_chars", F.length("text").cast(kind)).select(*docs.columns)
    return masked


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in mixed order, sources weighed by the square root of their size."""
    return mix_documents(docs, alpha=0.5)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, placed in sequences of 2048 tokens that are numbered in the stored order."""
    file, row, place = unused(docs, "file"), unused(docs, "row"), docs.metadataColumn("_metadata")
    docs = docs.select("*", place["file_name"].alias(file), place["row_index"].alias(row))
    return pack_documents(docs, TOKENIZER, size=2048, end_id=1, order=(file, row))


STAGES = [
    ("toxicity", toxicity),
    ("simhash near-dedup", near_duplicates),
    ("secret scans", secret_scan),
    ("mixing sources", mixing),
    ("packing", packing),
]

#: Tokenising, hashing and scoring have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        path = staged_path(spark, name.replace(" ", "-"))
        function(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
