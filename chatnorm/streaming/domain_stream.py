"""Many datasets of a domain in one file stream: mapped, capped, without duplicates, counted.

Every micro-batch is a small run over the rows of its files. What it has to know of earlier batches lies in tables that
they left beside the checkpoint, one folder a batch, so a batch that is run again after a failure meets the same state
and writes the same rows over its own:

* **Mappings** are read again for each batch, so datasets may be added while the stream runs. Rows of a dataset
  without a mapping are parked, and taken up by the first batch that finds one.
* **Cap per dataset**: earlier batches have counted what they took. The rest is cut exactly as in a batch run, at
  the block in which the cap is reached, and never in one task per dataset.
* **Duplicates** within the batch by aggregation, and against all output, of this and other runs, by the
  fingerprint index, whose buckets stay where they are.
* **Counters** per dataset and batch: records taken, duplicates, records written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..operators.cap import cap_rows
from ..operators.convert import convert_json, export_records
from ..operators.dedup import fingerprint, record_counts
from ..plans.session import remove_folder, shared_folder, written
from ..sinks.writers import write_records
from ..sources.fingerprint_index import refresh
from ..sources.outputs import path_exists
from ..sources.readers import numbered
from ..types import JSON_ROW, ORD_BLOCK, ORD_FILE, ORD_ROW, ORD_SPLIT, ORDINAL, local_frame
from .stream import run_name

COUNTERS = "dataset_id STRING, taken BIGINT, duplicates BIGINT, written BIGINT"
_PLACES = f"dataset_id STRING, {ORD_SPLIT} INT, {ORD_FILE} STRING, {ORD_BLOCK} BIGINT, {ORD_ROW} BIGINT"
_PARKED = f"{JSON_ROW} STRING, {_PLACES}"


def dataset_of(root: str, depth: int = 2) -> Column:
    """Dataset of a row by its file: the first ``depth`` folders below the data root."""
    path = F.url_decode(F.replace(ORD_FILE, F.lit("+"), F.lit("%2B")))  # the place is a URL
    start = F.lit(root.split(":", 1)[-1].strip("/") + "/")
    below = F.substr(path, F.position(start, path) + F.length(start))
    return F.array_join(F.slice(F.split(below, "/"), 1, depth), "/")


class BatchTables:
    """Tables beside a checkpoint with a folder for each batch."""

    def __init__(self, spark: SparkSession, checkpoint: str) -> None:
        self.spark, self.root = spark, checkpoint.rstrip("/") + "-batches"

    def write(self, name: str, batch_id: int, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(f"{self.root}/{name}/batch_id={batch_id}")

    def read(self, name: str, ddl: str, before: int | None = None) -> DataFrame:
        """Rows of all batches, or of those before one."""
        path = f"{self.root}/{name}"
        if not path_exists(self.spark, path):
            return local_frame(self.spark, [], f"{ddl}, batch_id INT")
        rows = self.spark.read.schema(f"{ddl}, batch_id INT").parquet(path)
        return rows if before is None else rows.where(F.col("batch_id") < before)


def start_domain(
    rows: DataFrame,
    read_mappings: Callable[[SparkSession], DataFrame],
    checkpoint: str,
    output_format: str,
    csv_path: str,
    parquet_path: str,
    cap: int | None = None,
    deduplicate: bool = True,
    deep: bool = True,
) -> StreamingQuery:
    """Process what there is of a stream of JSON rows (``dataset_id``, ordinals) and stop.

    ``read_mappings`` gives the mapping table as it is now. Starting again with the same ``checkpoint``
    goes on; runs with checkpoints of their own may share an output.
    """
    run = run_name(checkpoint)
    outputs = [(f, p) for f, p in (("csv", csv_path), ("parquet", parquet_path)) if output_format in (f, "both")]

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        tables, work = BatchTables(spark, checkpoint), shared_folder(spark)
        try:
            mappings = written(read_mappings(spark), f"{work}/mappings")
            arrived = numbered(batch).select("dataset_id", JSON_ROW, *ORDINAL)
            incoming = _with_parked(arrived, tables, mappings, batch_id)
            records = export_records(convert_json(incoming, mappings, keep=ORDINAL, deep=deep), keep=ORDINAL)
            fp = F.unhex(fingerprint(F.col("conversation"), F.col("reasoning")))
            staged = written(records.withColumn("fp", fp), f"{work}/staged")
            if cap is not None:
                earlier = tables.read("counters", COUNTERS, batch_id)
                taken = written(earlier.groupBy("dataset_id").agg(F.sum("taken").alias("taken")), f"{work}/taken")
                staged = cap_rows(staged, cap, ["dataset_id"], [ORD_SPLIT, ORD_FILE, ORD_BLOCK], ORD_ROW, taken)
            duplicates = local_frame(spark, [], _PLACES)
            if deduplicate:
                duplicates = written(_duplicates(spark, staged, outputs, run, batch_id), f"{work}/duplicates")
            kept = staged.join(duplicates.select(*ORDINAL), ORDINAL, "left_anti")
            own = f"run={run}/batch_id={batch_id}"
            write_records(kept, output_format, f"{csv_path}/{own}", f"{parquet_path}/{own}", mode="overwrite")
            tables.write("counters", batch_id, record_counts(staged, duplicates))
        finally:
            remove_folder(spark, work)

    writer = rows.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def _with_parked(arrived: DataFrame, tables: BatchTables, mappings: DataFrame, batch_id: int) -> DataFrame:
    """Rows of the batch, with rows parked earlier whose dataset has a mapping now for the first time.

    Rows without a mapping are parked. Datasets that a batch had a mapping for are noted with it, so that
    parked rows are taken up once.
    """
    known = mappings.select("dataset_id").distinct()
    had = tables.read("known", "dataset_id STRING", batch_id).select("dataset_id").distinct()
    parked = tables.read("parked", _PARKED, batch_id).drop("batch_id")
    again = parked.join(known.join(had, "dataset_id", "left_anti"), "dataset_id", "left_semi")
    tables.write("parked", batch_id, arrived.join(known, "dataset_id", "left_anti"))
    tables.write("known", batch_id, known)
    return arrived.unionByName(again.select(arrived.columns))


def _duplicates(spark: SparkSession, staged: DataFrame, outputs: list, run: str, batch_id: int) -> DataFrame:
    """Places of the records that are not the first of their fingerprint, or that other output has."""
    keys = staged.select("dataset_id", "fp", *ORDINAL)
    firsts = keys.groupBy("fp").agg(F.min(F.struct(*ORDINAL)).alias("place"))
    for fmt, path in outputs:
        index = refresh(spark, path, fmt, without=f"/run={run}/batch_id={batch_id}/")
        if index is not None:
            firsts = index.unseen(firsts, run, before=batch_id)
    return keys.drop("fp").join(firsts.select("place.*"), ORDINAL, "left_anti")


def counters(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``dataset_id, batches, taken, duplicates, written`` of a run up to now."""
    rows = BatchTables(spark, checkpoint).read("counters", COUNTERS)
    return rows.groupBy("dataset_id").agg(
        F.count_distinct("batch_id").alias("batches"), *(F.sum(c).alias(c) for c in ("taken", "duplicates", "written"))
    )


class ProgressListener(StreamingQueryListener):
    """Passes (run id, batch, input rows, rows a second) of every batch of a session's streams to ``report``."""

    def __init__(self, report: Callable[[str, int, int, float], None]) -> None:
        self.report = report

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        self.report(str(p.runId), p.batchId, p.numInputRows, p.processedRowsPerSecond)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass
