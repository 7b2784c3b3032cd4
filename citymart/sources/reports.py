"""Validation reports and run logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_report(report: DataFrame, path: str) -> None:
    """Store a one-row report as one indented JSON document under the folder ``path``.

    Unknown values are left out of the document.
    """
    document = F.to_json(F.struct("*"), {"pretty": "true"})
    report.select(document.alias("value")).coalesce(1).write.mode("overwrite").text(path)


def read_reports(spark: SparkSession, pattern: str) -> DataFrame:
    """All reports that match a path pattern, newest first, with path and time of change."""
    return (
        spark.read.option("multiLine", True)
        .json(pattern)
        .select(
            "*",
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_modification_time").alias("file_modified"),
        )
        .orderBy(F.desc("file_modified"), "file_path")
    )


def log_lines(lines: DataFrame) -> DataFrame:
    """Lines of text files, read at once or as a stream, with what is known of their file."""
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_name").alias("name"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def list_logs(spark: SparkSession, pattern: str) -> DataFrame:
    """Log files that match a path pattern, newest first, without reading them."""
    return (
        spark.read.format("binaryFile")
        .load(pattern)
        .select(
            F.element_at(F.split("path", "/"), -1).alias("name"),
            "path",
            F.col("length").alias("size"),
            F.col("modificationTime").alias("modified"),
        )
        .orderBy(F.desc("modified"), "path")
    )


def search_logs(spark: SparkSession, pattern: str, term: str) -> DataFrame:
    """Log lines that contain ``term``, whatever the letter case."""
    hit = F.contains(F.lower("value"), F.lit(term.lower()))
    return log_lines(spark.read.text(pattern)).filter(hit).select("path", "name", F.col("value").alias("line"))
