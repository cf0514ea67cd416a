"""Structured Streaming form of the run: convert, drop known records, write micro-batches."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.messages import conversation_json
from ..operators.convert import convert_json, convert_table
from ..operators.dedup import fingerprint
from ..sinks.writers import write_records
from ..sources.fingerprint_index import FingerprintIndex
from ..types import JSON_ROW, RECORD_COLUMNS, Mapping


def stream_records(rows: DataFrame, mapping: Mapping, domain: str) -> DataFrame:
    """Stream of raw rows -> stream of exported records with fingerprint and domain."""
    if JSON_ROW in rows.columns:
        from ..types import mappings_frame

        keyed = rows.withColumn("dataset_id", F.lit(mapping.dataset_id))
        records = convert_json(
            keyed,
            mappings_frame(rows.sparkSession, [mapping]),
            deep=mapping.conversation_type == "multi_turn",
        )
    else:
        records = convert_table(rows, mapping)
    return records.select(
        conversation_json(F.col("conversation")).alias("conversation"), *RECORD_COLUMNS[1:]
    ).select(
        *RECORD_COLUMNS,
        F.lit(domain).alias("domain"),
        fingerprint(F.col("conversation"), F.col("reasoning")).alias("fp"),
    )


def drop_seen(records: DataFrame, within: str | None = None, event_time: str | None = None) -> DataFrame:
    """Drop records seen earlier in the stream; :func:`drop_known` takes care of other runs. The state is one key per record and is kept for
    ever; with ``within`` (and an ``event_time`` column) it expires."""
    if within:
        return records.withWatermark(event_time, within).dropDuplicatesWithinWatermark(["domain", "fp"])
    return records.dropDuplicates(["domain", "fp"])


def drop_known(records: DataFrame, indexes: list[FingerprintIndex], run: str) -> DataFrame:
    """Drop records that earlier output has, whoever wrote it. Comes before :func:`drop_seen`, so that
    known records never enter its state.

    What the stream ``run`` wrote itself doesn't count: a batch that is run again after a failure must
    give its rows again, and its earlier batches are in the state.
    """
    fp = F.unhex("fp")
    for index in indexes:
        known = index.others(run).withColumnRenamed("fp", "__known")
        records = records.join(known, fp == F.col("__known"), "left_anti")
    return records


def run_name(checkpoint: str) -> str:
    """Name of the run that a checkpoint folder belongs to."""
    return hashlib.sha256(checkpoint.encode()).hexdigest()[:16]


def start(
    records: DataFrame,
    checkpoint: str,
    output_format: str,
    csv_path: str,
    parquet_path: str,
    progress: Callable[[int, int], None] | None = None,
    run: str | None = None,
) -> StreamingQuery:
    """Write each micro-batch to one or two sinks and stop when the input is used up.

    Each batch of a run has its own folder, which a repeated batch overwrites, so a batch that is
    run again after a failure leaves no second copy, and runs leave each other's rows alone. Give
    every run its own ``checkpoint``; starting again with the same one resumes it. ``run`` names
    the folder of a run (default: derived from its checkpoint). ``progress`` gets (batch id, rows).
    """
    run = run or run_name(checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        observation = Observation()
        counted = batch.observe(observation, F.count(F.lit(1)).alias("rows"))
        both = output_format == "both"
        batch_rows = counted.persist() if both else counted
        try:
            write_records(
                batch_rows,
                output_format,
                f"{csv_path}/run={run}/batch_id={batch_id}",
                f"{parquet_path}/run={run}/batch_id={batch_id}",
                mode="overwrite",
            )
        finally:
            if both:
                batch_rows.unpersist()
        if progress is not None:
            progress(batch_id, observation.get["rows"])

    return (
        records.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def use_rocksdb(spark) -> None:
    """Keep streaming state in RocksDB, outside the JVM heap."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
