"""A maintained index of the fingerprints of earlier output.

Without it every run parses all output that was ever written. The index lies beside an output folder and holds, in
Parquet, one row per fingerprint and stream run, dealt over a fixed number of buckets by Spark's own hash, and the
list of output files that it covers (path, length, time of change). :func:`refresh` parses only files that are not
covered yet. A covered file that is gone or has changed makes the index be built anew.

A join of rows that are dealt by ``fp`` into as many partitions reads each bucket where it is needed: the
history isn't shuffled, however long it is. ``buckets`` defaults to ``spark.sql.shuffle.partitions``.

An append leaves one more file per bucket. After ``COMPACT_AFTER`` of them the buckets are rewritten, bucket by bucket
and so without a shuffle, as a new generation; readers take the newest generation that is complete.

Order of an append: fingerprints first, then the files they came from. A run that stops in between leaves files
uncovered, which the next one parses again; fingerprints that are there twice do no harm and go at compaction.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import fingerprint
from ..plans.generations import Generations
from ..types import local_frame
from .outputs import path_exists, read_output

COMPACT_AFTER = 16
_FILES = "path STRING, length BIGINT, modified BIGINT"


@dataclass(frozen=True)
class FingerprintIndex:
    """``rows`` has ``fp BINARY, run STRING, batch BIGINT``: the stream run and batch that wrote it, or nulls."""

    rows: DataFrame
    buckets: int

    def others(self, run: str | None = None, before: int = 0) -> DataFrame:
        """Fingerprints written by anything but a stream run, or by its batches ``before`` one."""
        rows = self.rows
        if run is not None:
            rows = rows.where(F.col("run").isNull() | (F.col("run") != run) | (F.col("batch") < before))
        return rows.select("fp")

    def unseen(self, keys: DataFrame, run: str | None = None, before: int = 0) -> DataFrame:
        """Rows of ``keys`` (with a binary ``fp``, dealt by it) whose fingerprint is not in the index.

        Rows dealt into another number of partitions are dealt anew; the index stays where it is. Not an anti
        join, which the optimizer would push below an aggregate that makes ``keys`` distinct, where a
        fingerprint on a third of all rows would meet the index in one task.
        """
        if int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")) != self.buckets:
            keys = keys.repartition(self.buckets, "fp")
        known = self.others(run, before).withColumnRenamed("fp", "__known")
        return keys.join(known, F.col("fp") == F.col("__known"), "left").where("__known IS NULL").drop("__known")


def index_root(output: str) -> str:
    return f"{output.rstrip('/')}.fingerprints"


def _listed(spark: SparkSession, output: str) -> DataFrame:
    """Output files; only the listing is read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(output)
    return found.select("path", "length", F.unix_micros("modificationTime").alias("modified"))


def _written_by(path: Column) -> list[Column]:
    """Stream run and batch that a path names."""
    run, batch = (F.regexp_extract(path, "/run=([^/]+)/batch_id=([0-9]+)/", i) for i in (1, 2))
    return [F.when(run != "", run).alias("run"), F.when(run != "", batch).cast("long").alias("batch")]


def _table(spark: SparkSession, generation: str, buckets: int) -> str:
    """The bucketed table over a generation. Its definition is made again in each session that needs it."""
    name = f"fingerprints_{hashlib.sha1(generation.encode()).hexdigest()}"
    location = f"{generation}/buckets-{buckets}".replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (fp BINARY, run STRING, batch BIGINT) USING parquet "
        f"CLUSTERED BY (fp) SORTED BY (fp) INTO {buckets} BUCKETS LOCATION '{location}'"
    )
    spark.catalog.refreshTable(name)
    return name


def _append(spark: SparkSession, generation: str, buckets: int, rows: DataFrame) -> None:
    """One file per bucket: each task has the rows of one."""
    rows.select("fp", "run", "batch").write.insertInto(_table(spark, generation, buckets))


def _buckets_of(generations: Generations, generation: str) -> int:
    return next(int(n.removeprefix("buckets-")) for n in generations.names(generation) if n.startswith("buckets-"))


def _parsed(spark: SparkSession, files: list[str], fmt: str, buckets: int) -> DataFrame:
    """Distinct fingerprints of output files, dealt into buckets."""
    rows = read_output(spark, files, fmt).select(
        F.unhex(fingerprint(F.col("conversation"), F.col("reasoning"))).alias("fp"),
        *_written_by(F.col("_metadata.file_path")),
    )
    return rows.distinct().repartition(buckets, "fp")


def refresh(
    spark: SparkSession,
    output: str,
    fmt: str,
    buckets: int | None = None,
    compact_after: int = COMPACT_AFTER,
    without: str | None = None,
) -> FingerprintIndex | None:
    """Bring the index of an output folder (``fmt`` csv or parquet) up to date; None where there is no output.

    One writer at a time maintains the index of an output folder; readers need not wait for it. Files whose path
    holds ``without`` are left for later: what a batch that may be run again writes.
    """
    if not path_exists(spark, output):
        return None
    generations = Generations(spark, index_root(output))
    now = _listed(spark, output)
    if without:
        now = now.where(~F.col("path").contains(without))
    generation = generations.current()
    if generation is not None:
        covered = spark.read.schema(_FILES).parquet(f"{generation}/files")
        if not covered.join(now, covered.columns, "left_anti").isEmpty():
            generation = None  # a file went or changed: what it gave can't be told from the rest
    if generation is None:
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        generation = generations.new()
        _add(spark, generation, buckets, fmt, now)
        generations.publish(generation)
    else:
        buckets = _buckets_of(generations, generation)
        covered = spark.read.schema(_FILES).parquet(f"{generation}/files")
        _add(spark, generation, buckets, fmt, now.join(covered, now.columns, "left_anti"))
        if generations.count(f"{generation}/files") > compact_after:
            generation = _compacted(spark, generations, generation, buckets)
    generations.clean()
    return FingerprintIndex(spark.table(_table(spark, generation, buckets)), buckets)


def _add(spark: SparkSession, generation: str, buckets: int, fmt: str, files: DataFrame) -> None:
    # The driver has listed these files, so their names fit there.
    listed = files.collect()
    if not listed:
        return
    _append(spark, generation, buckets, _parsed(spark, [r.path for r in listed], fmt, buckets))
    local_frame(spark, [tuple(r) for r in listed], _FILES).coalesce(1).write.mode("append").parquet(f"{generation}/files")


def _compacted(spark: SparkSession, generations: Generations, generation: str, buckets: int) -> str:
    """A new generation with one file per bucket. Buckets are read and written by the same task."""
    new = generations.new()
    rows = spark.table(_table(spark, generation, buckets)).distinct()
    _append(spark, new, buckets, rows)
    spark.read.schema(_FILES).parquet(f"{generation}/files").coalesce(1).write.parquet(f"{new}/files")
    generations.publish(new)
    return new
