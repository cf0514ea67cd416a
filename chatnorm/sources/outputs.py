"""Fingerprints of records written by earlier runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import fingerprint


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether anything can be listed at a path."""
    try:
        return not (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .load(path)
            .select("path")
            .limit(1)
            .isEmpty()
        )
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error):
            return False
        raise


def read_output(spark: SparkSession, paths: str | list[str], fmt: str) -> DataFrame:
    """Conversation and reasoning of output that lies in a folder or in single files."""
    if fmt == "parquet":
        reader = spark.read.option("recursiveFileLookup", True)
        rows = reader.parquet(paths) if isinstance(paths, str) else reader.parquet(*paths)
    else:
        rows = spark.read.options(
            header=True, multiLine=True, quote='"', escape='"', recursiveFileLookup=True
        ).csv(paths)
    return rows.select("conversation", "reasoning", "_metadata")


def parquet_fingerprints(spark: SparkSession, path: str) -> DataFrame:
    """Reads the two columns it needs and nothing else."""
    return read_output(spark, path, "parquet").select(
        fingerprint(F.col("conversation"), F.col("reasoning")).alias("fp")
    )


def csv_fingerprints(spark: SparkSession, path: str) -> DataFrame:
    return read_output(spark, path, "csv").select(
        fingerprint(F.col("conversation"), F.col("reasoning")).alias("fp")
    )


def existing_fingerprints(
    spark: SparkSession, csv_path: str | None, parquet_path: str | None
) -> DataFrame:
    """Distinct fingerprints of all existing output (either path may be missing)."""
    found = spark.createDataFrame([], "fp STRING")
    if csv_path and path_exists(spark, csv_path):
        found = found.unionByName(csv_fingerprints(spark, csv_path))
    if parquet_path and path_exists(spark, parquet_path):
        found = found.unionByName(parquet_fingerprints(spark, parquet_path))
    return found.distinct()
