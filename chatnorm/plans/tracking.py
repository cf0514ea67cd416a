"""Run log, registry of processed datasets, and the summary of a run."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import json_fields, json_items, strip, utc_text
from ..sources.outputs import path_exists
from ..types import REGISTRY_DDL, RUN_LOG_COLUMNS, SYSTEM_ID, local_frame
from .generations import Generations
from .session import remove_folder

# Statuses that end the work on a dataset.
REGISTRY_DONE = ["added", "skipped", "resumed_skip", "duplicate_input"]
LOG_DONE = ["added", "skipped"]
SKIPPED = ["skipped", "duplicate_input", "resumed_skip"]

#: Files of marks behind a snapshot of the registry after which a new one is made.
COMPACT_AFTER = 32

_LOG_DDL = ", ".join(
    f"{c} {'BIGINT' if c == 'records_written' else 'STRING'}" for c in RUN_LOG_COLUMNS
)


# --- run log -------------------------------------------------------------------------------------


def log_rows(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Log entries with the current UTC time."""
    values = [tuple(r.get(c) for c in RUN_LOG_COLUMNS) for r in rows]
    return local_frame(spark, values, _LOG_DDL).withColumn(
        "timestamp_utc", utc_text(F.current_timestamp())
    )


def export_log(log: DataFrame) -> DataFrame:
    """The nine log columns as text, nulls as empty text."""
    return log.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in RUN_LOG_COLUMNS]
    )


def append_log(log: DataFrame, path: str) -> None:
    export_log(log).coalesce(1).write.mode("append").options(
        header=True, quote='"', escape='"', emptyValue=""
    ).csv(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        return local_frame(spark, [], _LOG_DDL)
    text = spark.read.options(header=True, multiLine=True, quote='"', escape='"').csv(path)
    return text.select(
        *[
            F.col(c).try_cast("bigint").alias(c)
            if c == "records_written"
            else F.coalesce(F.col(c), F.lit("")).alias(c)
            for c in RUN_LOG_COLUMNS
        ]
    )


def done_in_log(log: DataFrame) -> DataFrame:
    """Ids a run log reports as finished."""
    dataset_id, status = strip(F.col("dataset_id")), F.lower(strip(F.col("status")))
    return (
        log.where(
            status.isin(*LOG_DONE) & (dataset_id != "") & (dataset_id != SYSTEM_ID)
        )
        .select(dataset_id.alias("dataset_id"))
        .distinct()
    )


def done_in_checkpoint(spark: SparkSession, path: str) -> DataFrame:
    """Ids in a checkpoint file (JSON list); a missing or unreadable file gives none."""
    if not path_exists(spark, path):
        return local_frame(spark, [], "dataset_id STRING")
    texts = spark.read.text(path, wholetext=True)
    return texts.select(F.explode(json_items(strip(F.col("value")))).alias("dataset_id")).distinct()


def done_ids(*frames: DataFrame) -> DataFrame:
    united = frames[0]
    for frame in frames[1:]:
        united = united.union(frame)
    return united.distinct()


# --- registry ------------------------------------------------------------------------------------


def latest_per_key(df: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    """Last value per key. Partial maxima are taken before the shuffle."""
    return df.groupBy(*keys).agg(F.max_by(value, F.struct(*order)).alias(value))


def mark(
    spark: SparkSession, path: str, marks: list[tuple[str, str, str]], compact_after: int = COMPACT_AFTER
) -> None:
    """Append (domain, dataset_id, status); the last mark of a pair counts."""
    if not marks:
        return
    now = datetime.now(timezone.utc)
    rows = [(dataset, domain, status, now, i) for i, (domain, dataset, status) in enumerate(marks)]
    local_frame(spark, rows, REGISTRY_DDL).coalesce(1).write.mode("append").parquet(path)
    compact_registry(spark, path, compact_after)


class _Registry:
    """An append log of marks, and beside it snapshots of their last state.

    A snapshot (a generation) has one mark per pair and the names of the log files that went into it, so what is
    read is the newest snapshot and the files behind it: as much after a thousand runs as after a few.
    Files may be added while a snapshot is made; they are not among its names and stay to be read.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.generations = Generations(spark, f"{self.path}.snapshots")
        self.snapshot = self.generations.current()
        files = [n for n in self.generations.names(self.path) if not n.startswith(("_", "."))]
        covered = self.covered(self.snapshot)
        self.files, self.tail = files, [n for n in files if n not in covered]

    def covered(self, generation: str | None) -> set[str]:
        if generation is None:
            return set()
        return {r.name for r in self.spark.read.schema("name STRING").parquet(f"{generation}/covered").collect()}

    def marks(self) -> DataFrame:
        rows = local_frame(self.spark, [], REGISTRY_DDL)
        reader = self.spark.read.schema(REGISTRY_DDL)
        if self.snapshot is not None:
            rows = rows.unionByName(reader.parquet(f"{self.snapshot}/marks"))
        if self.tail:
            rows = rows.unionByName(reader.parquet(*[f"{self.path}/{n}" for n in self.tail]))
        return rows


def compact_registry(spark: SparkSession, path: str, after: int = COMPACT_AFTER) -> None:
    """Make a new snapshot once the log has more than ``after`` files behind the last one.

    Files that the snapshot before it already had are removed; a reader that began before the switch
    reads that one, and no longer needs them.
    """
    registry = _Registry(spark, path)
    if len(registry.tail) <= after:
        return
    generations, new = registry.generations, registry.generations.new()
    last = F.max_by(F.struct("status", "marked_at", "seq"), F.struct("marked_at", "seq")).alias("m")
    latest = registry.marks().groupBy("dataset_id", "domain").agg(last).select("dataset_id", "domain", "m.*")
    latest.write.parquet(f"{new}/marks")
    names = local_frame(spark, [(n,) for n in registry.files], "name STRING")
    names.coalesce(1).write.parquet(f"{new}/covered")
    generations.publish(new)
    for name in registry.covered(registry.snapshot) & set(registry.files):
        remove_folder(spark, f"{registry.path}/{name}")
    generations.clean()


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Latest status per (domain, dataset_id)."""
    if not path_exists(spark, path):
        return local_frame(spark, [], "domain STRING, dataset_id STRING, status STRING")
    marks = _Registry(spark, path).marks()
    return latest_per_key(marks, ["domain", "dataset_id"], "status", ["marked_at", "seq"])


def read_registry_json(spark: SparkSession, path: str) -> DataFrame:
    """A registry kept as one JSON object ``dataset_id -> {domain -> status}``; malformed -> empty."""
    if not path_exists(spark, path):
        return local_frame(spark, [], "domain STRING, dataset_id STRING, status STRING")
    return registry_entries(spark.read.text(path, wholetext=True), "value")


def registry_entries(texts: DataFrame, value: str) -> DataFrame:
    return (
        texts.select(F.explode(json_fields(strip(F.col(value)))).alias("dataset_id", "states"))
        .select("dataset_id", F.explode(json_fields(F.col("states"))).alias("domain", "status"))
        .select("domain", "dataset_id", "status")
    )


# --- what is left to do --------------------------------------------------------------------------


def without_registered(catalog: DataFrame, registry: DataFrame) -> DataFrame:
    done = registry.where(F.col("status").isin(*REGISTRY_DONE)).select("domain", "dataset_id")
    return catalog.join(done, ["domain", "dataset_id"], "left_anti")


def registered(catalog: DataFrame, registry: DataFrame) -> DataFrame:
    done = registry.where(F.col("status").isin(*REGISTRY_DONE)).select("domain", "dataset_id")
    return catalog.join(done, ["domain", "dataset_id"], "left_semi")


def without_done(catalog: DataFrame, done: DataFrame) -> DataFrame:
    return catalog.join(done, "dataset_id", "left_anti")


# --- counts --------------------------------------------------------------------------------------


def status_counts(outcomes: DataFrame, *, rollup: bool = True) -> DataFrame:
    """Per-domain counts of dataset outcomes; with ``rollup`` also the total (domain null).

    ``outcomes``: ``domain, dataset_id, status, records_written, duplicates_filtered``.
    """
    def n(*statuses: str):
        return F.count_if(F.col("status").isin(*statuses))

    grouped = outcomes.rollup("domain") if rollup else outcomes.groupBy("domain")
    return grouped.agg(
        F.count(F.lit(1)).alias("datasets_total"),
        n("added", "failed", "deferred", "skipped").alias("datasets_started"),
        n("added").alias("datasets_added"),
        n(*SKIPPED).alias("datasets_skipped"),
        n("deferred").alias("datasets_deferred"),
        n("failed").alias("datasets_failed"),
        n("duplicate_input").alias("duplicate_datasets_skipped"),
        F.coalesce(F.sum("records_written"), F.lit(0)).alias("records_written"),
        F.coalesce(F.sum("duplicates_filtered"), F.lit(0)).alias("record_duplicates_filtered"),
    )


def summary(outcomes: DataFrame, progress_name: str, places: DataFrame) -> DataFrame:
    """One row: ``progress_name, totals, domains``; the array has one short entry per domain,
    with its counts and the paths in ``places``."""
    counts = status_counts(outcomes)
    numbers = [c for c in counts.columns if c != "domain"]
    paths = [c for c in places.columns if c != "domain"]
    total = F.struct(F.count("domain").alias("domains"), *[
        F.max(F.when(F.col("domain").isNull(), F.col(c))).alias(c) for c in numbers
    ])
    per_domain = F.array_sort(
        F.collect_list(F.when(F.col("domain").isNotNull(), F.struct("domain", *numbers, *paths)))
    )
    return counts.join(places, "domain", "left").agg(
        F.lit(progress_name).alias("progress_name"), total.alias("totals"), per_domain.alias("domains")
    )
