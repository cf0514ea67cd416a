"""Record and table sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..types import RECORD_COLUMNS

FORMATS = ("csv", "parquet", "both")
CSV_OPTIONS = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "emptyValue": "",
    "nullValue": "",
}


def write_csv(records: DataFrame, path: str, mode: str = "append") -> None:
    """The five columns as CSV with a header in each file."""
    records.select(*RECORD_COLUMNS).write.mode(mode).options(**CSV_OPTIONS).csv(path)


def write_parquet(records: DataFrame, path: str, mode: str = "append") -> None:
    records.select(*RECORD_COLUMNS).write.mode(mode).option("compression", "snappy").parquet(path)


def write_records(
    records: DataFrame, output_format: str, csv_path: str, parquet_path: str, mode: str = "append"
) -> None:
    """Exported records to CSV, Parquet or both.

    Pass a DataFrame that reads a written table when both formats are wanted, so that the second
    write only reads files again.
    """
    if output_format not in FORMATS:
        raise ValueError(f"output_format must be one of {FORMATS}")
    if output_format in ("parquet", "both"):
        write_parquet(records, parquet_path, mode)
    if output_format in ("csv", "both"):
        write_csv(records, csv_path, mode)


def write_table(df: DataFrame, path: str, fmt: str, mode: str = "errorifexists") -> None:
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.options(**CSV_OPTIONS).csv(path)
    else:
        writer.parquet(path)


def text_columns(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
