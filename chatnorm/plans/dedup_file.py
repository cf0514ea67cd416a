"""De-duplicate a CSV or Parquet table on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.dedup import dedup_counts, drop_duplicates
from ..sinks.writers import write_table
from ..sources.readers import read_csv, read_parquet
from ..types import ORDINAL
from .session import file_system


def infer_format(path: str) -> str:
    lower = path.rstrip("/").lower()
    for fmt in ("csv", "parquet"):
        if lower.endswith(f".{fmt}"):
            return fmt
    raise ValueError(f"Neither a .csv nor a .parquet path: {path}")


def load_table(spark: SparkSession, path: str) -> DataFrame:
    """A table by its extension, with the positions of its rows."""
    reader = read_csv if infer_format(path) == "csv" else read_parquet
    return reader(spark, [path])


def default_output_path(path: str) -> str:
    stem, _, extension = path.rstrip("/").rpartition(".")
    return f"{stem}_dedup.{extension}"


def dedup_file(
    spark: SparkSession,
    path: str,
    output: str | None = None,
    subset: list[str] | None = None,
    keep: str = "first",
    ignore_case: bool = False,
    strip_whitespace: bool = False,
    inplace: bool = False,
    preserve_order: bool = False,
) -> DataFrame:
    """Write the table without duplicates; returns the counts before, after and removed.

    ``inplace`` writes beside the input and then swaps the folders, because a job cannot
    overwrite the files it reads; a swap that was stopped is ended by the next call. ``preserve_order`` sorts the result by input position, which
    costs one more shuffle.
    """
    fmt = infer_format(path)
    target = default_output_path(path) if output is None else output
    if inplace:
        target = default_output_path(path) + ".swap"
    _Swap(spark, path).finish()
    table = load_table(spark, path)
    options = {"subset": subset, "ignore_case": ignore_case, "strip_whitespace": strip_whitespace}
    order = ORDINAL if subset or preserve_order else None
    result = drop_duplicates(table, keep=keep, order_by=order, **options)
    if preserve_order:
        result = result.orderBy(*ORDINAL)
    counts = dedup_counts(table, keep=keep, **options).collect()
    write_table(result.drop(*ORDINAL), target, fmt if inplace else infer_format(target), "overwrite")
    if inplace:
        _Swap(spark, path).begin(target)
    return spark.createDataFrame(counts)


class _Swap:
    """Puts a finished folder in the place of an old one, so that a start after a stop at any point can end it.

    A journal beside the old folder names the new one from the moment the new one is whole until the swap is done.
    What is there tells which steps are left: the old folder steps aside, the new one takes its place, the
    old one goes, and the journal goes.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.fs, self.place = file_system(spark, self.path)
        self.backup, self.journal = (file_system(spark, f"{self.path}{end}")[1] for end in (".old", ".journal"))

    def begin(self, new: str) -> None:
        stream = self.fs.create(self.journal, True)
        stream.write(bytearray(new.encode()))
        stream.close()
        self.finish()

    def finish(self) -> None:
        """Do what is left of a swap, if there is one."""
        if not self.fs.exists(self.journal):
            return
        named = self.spark.read.text(self.journal.toString(), wholetext=True).first()
        name = named.value if named else ""
        new = file_system(self.spark, name)[1] if name else None  # nothing: it stopped before the name was written
        if new is not None and self.fs.exists(new):
            if self.fs.exists(self.place):
                self.fs.delete(self.backup, True)  # of an earlier swap
                self._move(self.place, self.backup)
            self._move(new, self.place)
        self.fs.delete(self.backup, True)
        self.fs.delete(self.journal, False)

    def _move(self, old, new) -> None:
        if not self.fs.rename(old, new):
            raise OSError(f"could not move {old.toString()} to {new.toString()}")
