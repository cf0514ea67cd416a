"""The normalisation run: select, skip, detect, convert, cap, de-duplicate, write, track."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cap import cap_rows
from ..operators.convert import convert_json, convert_table, export_records, union_all
from ..operators.dedup import fingerprint, record_counts
from ..operators.detect import detect_mappings, json_cells
from ..operators.proposals import check_task_type, resolve_mappings, validate_proposals
from ..sources.catalog import output_name, resolve_catalog, select_domains
from ..sources.fingerprint_index import FingerprintIndex, refresh
from ..sources.readers import Dataset, DatasetDeferred, open_dataset, sample_json
from ..sinks.writers import FORMATS, write_records
from ..types import (
    JSON_ROW,
    ORD_BLOCK,
    ORD_FILE,
    ORD_ROW,
    ORD_SPLIT,
    ORDINAL,
    SYSTEM_ID,
    Mapping,
    local_frame,
    mappings_frame,
)
from . import tracking
from .session import remove_folder, shared_folder, written

# A row's place in a domain: dataset first, then the position inside the dataset. Unique.
PLACE = ["dataset_pos", *ORDINAL]

# Datasets converted by one job. Bounds the number of scans in one plan.
DATASETS_PER_JOB = 32

# Datasets whose samples are on the driver at the same time.
DATASETS_PER_DETECTION = 128


@dataclass(frozen=True)
class RunOptions:
    progress_name: str = "default"
    output_format: str = "csv"
    deduplicate: bool = True
    resume: bool = False
    ignore_registry: bool = False
    max_rows_per_dataset: int | None = None
    sample_rows: int = 12
    csv_multiline: bool = True
    output_csv_file: str = "combined_dataset.csv"
    output_parquet_file: str = "combined_dataset.parquet"
    run_log_file: str = "pipeline_progress_log.csv"
    # State of runs made elsewhere: a JSON list of finished ids (used with ``resume``), and a JSON
    # object ``dataset_id -> {domain -> status}``.
    checkpoint_file: str | None = None
    registry_file: str | None = None


@dataclass
class _Work:
    """A dataset on its way through a run."""

    dataset_id: str
    pos: int
    dataset: Dataset | None = None
    samples: list[str] = field(default_factory=list)
    mapping: Mapping | None = None


# --- record-level part: DataFrames only ----------------------------------------------------------


def stage_records(frames: list[DataFrame]) -> DataFrame:
    """Converted records in their exported form with fingerprint and place."""
    exported = [export_records(f, keep=PLACE) for f in frames]
    return union_all(exported).withColumn(
        "fp", F.unhex(fingerprint(F.col("conversation"), F.col("reasoning")))
    )


def duplicate_places(staged: DataFrame, known: list[FingerprintIndex] = ()) -> DataFrame:
    """Places of the records to leave out: those that are not the first of their fingerprint, and
    those already in earlier output.

    Only fingerprints and places are shuffled, never texts. The first place per fingerprint is a
    partial aggregate, so one fingerprint on a third of all rows costs one row per task. They meet
    the indexes of earlier output bucket by bucket. The last anti join is on the place, which is
    unique and spreads evenly.
    """
    place = F.struct(*PLACE)
    keys = staged.select("dataset_id", "fp", *PLACE)
    firsts = keys.groupBy("fp").agg(F.min(place).alias("place"))
    for index in known:
        firsts = index.unseen(firsts)
    return keys.select("dataset_id", *PLACE).join(firsts.select("place.*"), PLACE, "left_anti")


def keep_new(staged: DataFrame, duplicates: DataFrame) -> DataFrame:
    """Staged records without the duplicates. ``duplicates`` is a written table of known size: the
    planner broadcasts it when small, and otherwise shuffles both sides on the unique place."""
    return staged.join(duplicates.select(*PLACE), PLACE, "left_anti")


# --- datasets ------------------------------------------------------------------------------------


def _convert(spark: SparkSession, works: list[_Work], files=None) -> list[DataFrame]:
    """One lazy frame per typed dataset, one for all JSON datasets together."""
    frames, json_rows, json_mappings = [], [], []
    for w in works:
        dataset = w.dataset
        if files is not None:
            dataset = replace(dataset, files=tuple(files))
        rows = dataset.read(spark).withColumn("dataset_pos", F.lit(w.pos))
        if JSON_ROW in rows.columns:
            json_rows.append(rows.withColumn("dataset_id", F.lit(w.dataset_id)))
            json_mappings.append(w.mapping)
        else:
            frames.append(convert_table(rows, w.mapping, keep=PLACE))
    if json_rows:
        multi_turn = any(m.conversation_type == "multi_turn" for m in json_mappings)
        frames.append(
            convert_json(
                union_all(json_rows), mappings_frame(spark, json_mappings), keep=PLACE, deep=multi_turn
            )
        )
    return frames


def _stage(spark, works: list[_Work], cap: int | None, folder: str) -> dict[str, Exception]:
    """Write the converted records of all datasets below ``folder``; errors per dataset.

    Datasets are converted in batches; when a batch fails, its datasets are tried one by one so
    that one unreadable dataset does not take the others with it.
    """
    failed: dict[str, Exception] = {}
    if cap is not None:
        for w in works:
            try:
                _stage_capped(spark, w, cap, f"{folder}/{w.pos}")
            except Exception as error:  # noqa: BLE001
                failed[w.dataset_id] = error
        return failed
    for start in range(0, len(works), DATASETS_PER_JOB):
        batch = works[start : start + DATASETS_PER_JOB]
        try:
            stage_records(_convert(spark, batch)).write.parquet(f"{folder}/batch-{start}")
            continue
        except Exception as error:  # noqa: BLE001
            if len(batch) == 1:
                failed[batch[0].dataset_id] = error
                continue
        for w in batch:
            try:
                stage_records(_convert(spark, [w])).write.parquet(f"{folder}/single-{w.pos}")
            except Exception as error:  # noqa: BLE001
                failed[w.dataset_id] = error
    return failed


def _stage_capped(spark, work: _Work, cap: int, folder: str) -> None:
    """Convert the files of one dataset in order, twice as many each time, until there are ``cap``
    records; the exact cut is made afterwards by ``cap_rows``."""
    files, done, step, found = list(work.dataset.files), 0, 1, 0
    while done < len(files) and (found < cap or done == 0):
        path = f"{folder}/from-{done}"
        part = files[done : done + step]
        stage_records(_convert(spark, [work], part)).write.parquet(path)
        found += spark.read.parquet(path).count()
        done, step = done + step, step * 2


def _staged(spark: SparkSession, folder: str, failed: set[str]) -> DataFrame:
    staged = spark.read.option("recursiveFileLookup", True).parquet(folder)
    return staged.where(~F.col("dataset_id").isin(*failed)) if failed else staged


def _status_of(error: Exception) -> tuple[str, str, str]:
    if isinstance(error, DatasetDeferred):
        return "deferred", str(error), error.reason
    return "failed", "Could not be read, converted or written", str(error)


def output_paths(head, out_root: str, options: RunOptions) -> tuple[str, str, str]:
    """CSV, Parquet and run-log folder of a domain (``head`` is any of its catalogue rows)."""
    names = (
        head.output_csv_file or options.output_csv_file,
        head.output_parquet_file or options.output_parquet_file,
        head.run_log_file or options.run_log_file,
    )
    return tuple(
        f"{out_root.rstrip('/')}/{output_name(name, head.slug, options.progress_name)}"
        for name in names
    )


# --- one domain ----------------------------------------------------------------------------------


def run_domain(
    spark: SparkSession,
    catalog: DataFrame,
    domain: str,
    data_root: str,
    out_root: str,
    options: RunOptions,
    proposals: DataFrame | None = None,
) -> list[tuple]:
    """Process the datasets of one domain; returns one outcome per listed dataset."""
    listed = catalog.where(F.col("domain") == domain)
    head = listed.first()
    check_task_type(head.task_type)
    csv_path, parquet_path, log_path = output_paths(head, out_root, options)
    registry_path = f"{out_root.rstrip('/')}/dataset_registry"
    cap = (
        head.max_rows_per_dataset
        if head.max_rows_per_dataset is not None
        else options.max_rows_per_dataset
    )
    outcomes: list[tuple] = []
    log: list[dict] = []
    marks: list[tuple[str, str, str]] = []

    def note(work_id: str, status: str, written: int | None = 0, message="", error="", w=None, dup=0):
        dataset = w.dataset if w else None
        log.append(
            {
                "domain": domain,
                "dataset_id": work_id,
                "status": status,
                "config_name": dataset.config_name if dataset else None,
                "split_name": ",".join(dataset.splits) if dataset else None,
                "records_written": written,
                "message": message,
                "error": error,
            }
        )
        if work_id != SYSTEM_ID and status != "started":
            outcomes.append((domain, work_id, status, written or 0, dup))
            if status in ("added", "skipped", "resumed_skip", "failed"):
                marks.append((domain, work_id, status))

    def flush():
        if log:
            tracking.append_log(tracking.log_rows(spark, log), log_path)
        tracking.mark(spark, registry_path, marks)
        log.clear()
        marks.clear()

    # 1. What is left to do. The catalogue lists datasets, not rows, and is small.
    todo = listed.where("NOT is_repeat")
    if not options.ignore_registry:
        registry = tracking.read_registry(spark, registry_path)
        if options.registry_file:
            earlier = tracking.read_registry_json(spark, options.registry_file)
            registry = registry.unionByName(
                earlier.join(registry, ["domain", "dataset_id"], "left_anti")
            )
        for row in tracking.registered(todo, registry).orderBy("pos").collect():
            note(row.dataset_id, "duplicate_input",
                 message="Already finished for this domain in an earlier run")
        todo = tracking.without_registered(todo, registry)
    if options.resume:
        done = tracking.done_in_log(tracking.read_log(spark, log_path))
        if options.checkpoint_file:
            done = tracking.done_ids(
                done, tracking.done_in_checkpoint(spark, options.checkpoint_file)
            )
        n_done = done.count()
        note(SYSTEM_ID, "resume", n_done, f"{n_done} datasets are finished")
        for row in todo.join(done, "dataset_id", "left_semi").orderBy("pos").collect():
            note(row.dataset_id, "resumed_skip",
                 message="Already finished in this named run")
        todo = tracking.without_done(todo, done)
    works = [_Work(r.dataset_id, int(r.pos)) for r in todo.orderBy("pos").collect()]
    for row in listed.where("is_repeat").orderBy("pos").collect():
        note(row.dataset_id, "duplicate_input",
             message="Listed before in this domain")
    for w in works:
        note(w.dataset_id, "started", None, f"Started in domain {domain}")
    flush()

    # 2. Open and sample the datasets; one job per batch derives the mappings from the samples.
    relevant = []
    for start in range(0, len(works), DATASETS_PER_DETECTION):
        ready = []
        for w in works[start : start + DATASETS_PER_DETECTION]:
            try:
                w.dataset = open_dataset(spark, data_root, w.dataset_id, options.csv_multiline)
                w.samples = sample_json(spark, w.dataset, options.sample_rows)
                ready.append(w)
            except Exception as error:  # noqa: BLE001
                status, message, reason = _status_of(error)
                note(w.dataset_id, status, 0, message, reason, w)
        mappings = _mappings(spark, ready, head.task_type, proposals)
        for w in ready:
            w.samples, w.mapping = [], mappings.get(w.dataset_id)
            if w.mapping is not None and w.mapping.is_target_dataset:
                relevant.append(w)
            else:
                note(w.dataset_id, "skipped", 0,
                     f"Sample does not fit task type {head.task_type}", w=w)

    # 3. Convert once into a written table, then work on fingerprints and places.
    total = filtered = 0
    work = shared_folder(spark)
    try:
        failed = _stage(spark, relevant, cap, f"{work}/staged")
        added = [w for w in relevant if w.dataset_id not in failed]
        for w in relevant:
            if w.dataset_id in failed:
                status, message, reason = _status_of(failed[w.dataset_id])
                note(w.dataset_id, status, 0, message, reason, w)
        if added:
            counts, dups = {}, {}
            try:
                counts, dups = _write_domain(
                    spark, f"{work}/staged", work, set(failed), cap, csv_path, parquet_path, options
                )
            except Exception as error:  # noqa: BLE001
                status, message, reason = _status_of(error)
                for w in added:
                    note(w.dataset_id, status, 0, message, reason, w)
                added = []
            for w in added:
                n_dup = dups.get(w.dataset_id, 0)
                n_new = counts.get(w.dataset_id, 0) - n_dup
                total, filtered = total + n_new, filtered + n_dup
                note(w.dataset_id, "added", n_new,
                     f"Converted and written; {n_dup} duplicates left out", w=w, dup=n_dup)
    finally:
        remove_folder(spark, work)
    note(SYSTEM_ID, "completed", total,
         f"Domain finished; {filtered} duplicates left out")
    flush()
    return outcomes


def _write_domain(
    spark, staged_path: str, work: str, failed: set[str], cap, csv_path, parquet_path, options
) -> tuple[dict[str, int], dict[str, int]]:
    """Cap, de-duplicate and write the staged records; converted and dropped counts per dataset."""
    staged = _staged(spark, staged_path, failed)
    if cap is not None:
        staged = cap_rows(staged, cap, ["dataset_id"], [ORD_SPLIT, ORD_FILE, ORD_BLOCK], ORD_ROW)
    if not options.deduplicate:
        write_records(staged, options.output_format, csv_path, parquet_path)
        return _counts(staged, staged.limit(0))
    wants = options.output_format
    outputs = [(fmt, path) for fmt, path in (("csv", csv_path), ("parquet", parquet_path)) if wants in (fmt, "both")]
    known = [index for fmt, path in outputs if (index := refresh(spark, path, fmt))]
    duplicates = written(duplicate_places(staged, known), f"{work}/duplicates")
    write_records(keep_new(staged, duplicates), wants, csv_path, parquet_path)
    return _counts(staged, duplicates)


def _counts(staged: DataFrame, duplicates: DataFrame) -> tuple[dict[str, int], dict[str, int]]:
    """Records and duplicates per dataset, from one job."""
    rows = record_counts(staged, duplicates).collect()
    return {r.dataset_id: r.taken for r in rows}, {r.dataset_id: r.duplicates for r in rows}


def _mappings(spark, works: list[_Work], task_type: str, proposals) -> dict[str, Mapping]:
    rows = [(w.dataset_id, task_type, i, text) for w in works for i, text in enumerate(w.samples)]
    if not rows:
        return {}
    samples = local_frame(
        spark, rows, f"dataset_id STRING, task_type STRING, row_pos INT, {JSON_ROW} STRING"
    )
    detected = detect_mappings(json_cells(samples))
    validated = None
    if proposals is not None:
        columns = samples.groupBy("dataset_id").agg(
            F.min_by(F.json_object_keys(JSON_ROW), "row_pos").alias("columns")
        )
        wanted = proposals.select(
            "dataset_id", F.lit(task_type).alias("task_type"), "response"
        )
        validated = validate_proposals(wanted, columns)
    return {
        r.dataset_id: Mapping.from_row(r) for r in resolve_mappings(detected, validated).collect()
    }


# --- all domains ---------------------------------------------------------------------------------


def run(
    spark: SparkSession,
    domains: DataFrame | None,
    data_root: str,
    out_root: str,
    options: RunOptions = RunOptions(),
    only: list[str] | None = None,
    proposals: DataFrame | None = None,
) -> DataFrame | None:
    """Run all (or the named) domains and write the summary.

    ``domains`` comes from ``sources.catalog.read_domains``; None takes the legacy CSV of dataset
    ids below ``data_root``. Returns one outcome per dataset, or None when nothing is listed.
    """
    if options.output_format not in FORMATS:
        raise ValueError(f"output_format must be one of {FORMATS}")
    if domains is not None:
        domains = select_domains(domains, only)
    catalog = written(resolve_catalog(spark, data_root, domains))
    names = [r.domain for r in catalog.groupBy("domain").agg(F.min("entry").alias("e")).orderBy("e").collect()]
    if not names:
        return None
    rows: list[tuple] = []
    for name in names:
        rows += run_domain(spark, catalog, name, data_root, out_root, options, proposals)
    outcomes = local_frame(
        spark,
        rows,
        "domain STRING, dataset_id STRING, status STRING, records_written BIGINT, duplicates_filtered BIGINT",
    )
    heads = catalog.dropDuplicates(["domain"]).collect()
    places = local_frame(
        spark,
        [(h.domain, *output_paths(h, out_root, options)) for h in heads],
        "domain STRING, csv_path STRING, parquet_path STRING, run_log_path STRING",
    )
    summary_path = f"{out_root.rstrip('/')}/{output_name('pipeline_summary.json', options.progress_name)}"
    tracking.summary(outcomes, options.progress_name, places).coalesce(1).write.mode("overwrite").json(summary_path)
    return outcomes
