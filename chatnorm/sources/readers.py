"""Dataset files -> rows with their position.

Layout below a data root: ``<dataset_id>/<config>/<split>/files`` or, with one split only,
``<dataset_id>/files``. Every reader adds the ordinal columns of ``types.ORDINAL``. JSON and JSON
Lines rows stay JSON text (column ``types.JSON_ROW``); CSV and Parquet rows are typed.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import json_fields, json_items, strip, variant_kind
from ..types import JSON_ROW, ORD_BLOCK, ORD_FILE, ORD_ROW, ORD_SPLIT, ORDINAL
from .blocks import file_length, input_block
from .csv_blocks import read_csv_blocks
from .json_blocks import json_objects

# Fixed values.
SUFFIXES = [".jsonl", ".json", ".csv", ".parquet"]
IGNORED_ENDINGS = ["dataset_infos.json", "state.json"]
WRAPPER_KEYS = ["data", "rows", "items", "examples", "records"]
RAW_CONFIG = "__raw__"

# Parquet files are cut into blocks of 2**20 rows; text files use the start of their input block.
BLOCK_BITS = 20



class DatasetDeferred(RuntimeError):
    """The dataset cannot be read now; a later run tries again."""

    def __init__(self, message: str, reason: str) -> None:
        super().__init__(message)
        self.reason = reason


# --- listing -----------------------------------------------------------------------------------


def is_data_file(path: Column) -> Column:
    """Supported suffix in any case (gzip allowed for text), not hidden, not a metadata file."""
    lower = F.lower(path)
    supported = F.lit(False)
    for suffix in SUFFIXES:
        supported = supported | lower.endswith(suffix)
    supported = supported | lower.endswith(".jsonl.gz")
    for ending in IGNORED_ENDINGS:
        supported = supported & ~lower.endswith(ending)
    return supported & ~path.contains("/.")


def list_data_files(spark: SparkSession, folder: str) -> DataFrame:
    """Sorted data files below a folder. Only the listing is read, never the content."""
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(folder)
        .select("path", "length")
    )
    return found.where(is_data_file(F.col("path"))).orderBy("path")


def file_format(path: str) -> str | None:
    lower = path.lower().removesuffix(".gz")
    return next((s[1:] for s in SUFFIXES if lower.endswith(s)), None)


# --- one reader per format -----------------------------------------------------------------------


def _position(df: DataFrame, split_pos: int, row: Column, block: Column, *columns) -> DataFrame:
    return df.select(
        *columns,
        F.lit(split_pos).alias(ORD_SPLIT),
        F.col("_metadata.file_path").alias(ORD_FILE),
        block.cast("long").alias(ORD_BLOCK),
        row.alias(ORD_ROW),
    )


def _task_position(df: DataFrame, split_pos: int, *columns) -> DataFrame:
    return _position(
        df, split_pos, F.monotonically_increasing_id(), F.col("_metadata.file_block_start"), *columns
    )


def json_lines(lines: DataFrame, value: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Text lines -> JSON rows; blank and malformed lines and lines with no object are skipped."""
    line = strip(F.col(value))
    return (
        lines.withColumn(JSON_ROW, line)
        .where(F.col(JSON_ROW).startswith("{"))
        .where(json_fields(F.col(JSON_ROW)).isNotNull())
        .select(JSON_ROW, *(keep or []))
    )


def json_documents(docs: DataFrame, value: str = "value", keep: list[str] | None = None) -> DataFrame:
    """JSON documents -> JSON rows: a list of objects, an object that wraps such a list under a
    known key, or any other object as one row. Malformed documents give none."""
    keep = keep or []
    doc = F.col("__doc")
    wrapped = F.coalesce(
        *[
            F.when(
                F.try_variant_get("__parsed", f"$.{key}", "array<variant>").isNotNull(),
                F.get_json_object(doc, f"$.{key}"),
            )
            for key in WRAPPER_KEYS
        ]
    )
    found = (
        docs.select(*keep, strip(F.col(value)).alias("__doc"))
        .withColumn("__parsed", F.when(doc.startswith("{"), F.try_parse_json(doc)))
        .withColumn("__list", F.when(doc.startswith("["), doc).otherwise(wrapped))
    )
    objects = F.zip_with(
        json_items(F.col("__list")),
        F.from_json("__list", "array<variant>"),
        lambda text, v: F.when(
            text.startswith("{") & (F.coalesce(variant_kind(v), F.lit("OBJECT")) == "OBJECT"), text
        ),
    )
    rows = F.when(F.col("__list").isNotNull(), objects).when(
        doc.startswith("{"), F.when(json_fields(doc).isNotNull(), F.array(doc))
    )
    return found.select(*keep, F.posexplode(rows).alias("__item", JSON_ROW)).where(
        F.col(JSON_ROW).isNotNull()
    )


def read_jsonl(spark: SparkSession, paths: list[str], split_pos: int = 0) -> DataFrame:
    lines = _task_position(spark.read.text(paths), split_pos, "value")
    return json_lines(lines, keep=ORDINAL)


def read_json(
    spark: SparkSession, paths: list[str], split_pos: int = 0, first_rows: bool = False
) -> DataFrame:
    """JSON documents. One that fits into one input block is one row of one task; larger ones are cut into
    their objects by a task per block (``json_blocks``), which has the same rows of every well-formed document."""
    block = input_block(spark)
    large = [] if first_rows else [p for p in paths if file_length(spark, p) > block]
    frames = []
    if small := [p for p in paths if p not in set(large)]:
        docs = _task_position(spark.read.text(small, wholetext=True), split_pos, "value")
        rows = json_documents(docs, keep=ORDINAL)
        frames.append(rows.withColumn(ORD_ROW, F.col("__item").cast("long")).drop("__item"))
    if large:
        rows = json_objects(spark, large, WRAPPER_KEYS).withColumn(ORD_SPLIT, F.lit(split_pos))
        frames.append(json_lines(rows, "text", keep=ORDINAL))
    return union_by_name(frames)


CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"', "inferSchema": False}


def read_csv(
    spark: SparkSession, paths: list[str], split_pos: int = 0, multiline: bool = True, first_rows: bool = False
) -> DataFrame:
    """CSV with a header, all values text. Spark applies the first header to all files of a read,
    so files are grouped by their header first.

    With ``multiline`` (the default, since a quoted value may hold line breaks) a file that fits into
    one input block is read by one task, and a larger one by a task per block (``csv_blocks``). Both
    give the same rows. ``multiline=False`` saves the look at quotes where no value has line
    breaks. ``first_rows`` reads any file from its beginning, for a reader that soon stops.
    """
    options = {**CSV_OPTIONS, "multiLine": multiline}
    block = input_block(spark)
    groups: dict[tuple, list[str]] = {}
    for path in paths:
        header = tuple(spark.read.options(**options).csv(path).columns)
        in_blocks = multiline and not first_rows and file_length(spark, path) > block
        groups.setdefault((header, in_blocks), []).append(path)
    frames = []
    for (header, in_blocks), files in groups.items():
        if in_blocks:
            rows = read_csv_blocks(spark, files, list(header), CSV_OPTIONS)
            frames.append(rows.withColumn(ORD_SPLIT, F.lit(split_pos)).select(*[f"`{c}`" for c in header], *ORDINAL))
            continue
        schema = ", ".join("`" + c.replace("`", "``") + "` STRING" for c in header)
        df = spark.read.options(**options).schema(schema).csv(files)
        frames.append(_task_position(df, split_pos, *[F.col(f"`{c}`") for c in df.columns]))
    return unite(frames)


def read_parquet(spark: SparkSession, paths: list[str], split_pos: int = 0) -> DataFrame:
    """Parquet rows. Columns are those of all files, not only of the first."""
    df = spark.read.option("mergeSchema", len(paths) > 1).parquet(*paths)
    row = F.col("_metadata.row_index")
    return _position(df, split_pos, row, F.shiftright(row, BLOCK_BITS), *[F.col(f"`{c}`") for c in df.columns])


_READERS = {"jsonl": read_jsonl, "parquet": read_parquet}


def read_files(
    spark: SparkSession, paths: list[str], split_pos: int = 0, csv_multiline: bool = True, first_rows: bool = False
) -> DataFrame:
    """Files of any supported format; one reader per format, other suffixes give no rows.

    Formats that differ in kind (JSON text and typed) meet as JSON text.
    """
    by_format: dict[str, list[str]] = {}
    for path in paths:
        if (fmt := file_format(path)) is not None:
            by_format.setdefault(fmt, []).append(path)
    if not by_format:
        raise ValueError("no file of a known format")
    return unite(
        [
            read_csv(spark, files, split_pos, csv_multiline, first_rows)
            if fmt == "csv"
            else read_json(spark, files, split_pos, first_rows)
            if fmt == "json"
            else _READERS[fmt](spark, files, split_pos)
            for fmt, files in by_format.items()
        ]
    )


def as_json_rows(df: DataFrame) -> DataFrame:
    """Typed rows as JSON text, nulls written out."""
    if JSON_ROW in df.columns:
        return df
    names = [c for c in df.columns if c not in ORDINAL]
    text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in names]), {"ignoreNullFields": "false"})
    return df.select(text.alias(JSON_ROW), *ORDINAL)


def unite(frames: list[DataFrame]) -> DataFrame:
    """Bag union of splits or formats. Missing columns become null; columns of different types,
    or a mix of typed and JSON rows, become JSON text."""
    if len(frames) > 1:
        types: dict[str, set] = {}
        for frame in frames:
            for f in frame.schema:
                types.setdefault(f.name, set()).add(f.dataType.simpleString())
        if any(JSON_ROW in f.columns for f in frames) or any(len(t) > 1 for t in types.values()):
            frames = [as_json_rows(f) for f in frames]
    return union_by_name(frames)


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    united = frames[0]
    for frame in frames[1:]:
        united = united.unionByName(frame, allowMissingColumns=True)
    return united


# --- datasets ------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Dataset:
    """A dataset that can be read: its splits in order, with their files in name order."""

    dataset_id: str
    config_name: str | None
    splits: tuple[str, ...]
    files: tuple[tuple[int, str], ...]  # (split position, path)
    csv_multiline: bool = True

    def paths(self, split_pos: int | None = None) -> list[str]:
        return [p for s, p in self.files if split_pos is None or s == split_pos]

    def read(self, spark: SparkSession) -> DataFrame:
        if self.config_name == RAW_CONFIG:
            return read_files(spark, self.paths(), 0, self.csv_multiline)
        return unite(
            [
                read_files(spark, self.paths(pos), pos, self.csv_multiline)
                for pos in sorted({pos for pos, _ in self.files})
            ]
        )


def plan_dataset(folder: str, dataset_id: str, paths: list[str]) -> Dataset:
    """Work out config and splits from the listed files: the first config only, all its splits,
    blank split names dropped. Files directly below the dataset folder form one raw input."""
    base = folder.rstrip("/")
    start = base.split(":", 1)[-1].lstrip("/")
    layout: dict[tuple[str, str], list[str]] = {}
    flat: list[str] = []
    for path in sorted(paths):
        parts = path.split(start + "/", 1)[-1].split("/")
        if len(parts) >= 3 and parts[1].strip():
            layout.setdefault((parts[0], parts[1].strip()), []).append(path)
        else:
            flat.append(path)
    if not layout:
        if not flat:
            raise ValueError(f"dataset {dataset_id} has no file of a known format")
        return Dataset(dataset_id, RAW_CONFIG, tuple(p.rsplit("/", 1)[-1] for p in flat),
                       tuple((0, p) for p in flat))
    config = min(c for c, _ in layout)
    splits = [s for c, s in layout if c == config]
    files = [(i, p) for i, s in enumerate(splits) for p in layout[config, s]]
    return Dataset(dataset_id, config, tuple(splits), tuple(files))


def open_dataset(
    spark: SparkSession, data_root: str, dataset_id: str, csv_multiline: bool = True
) -> Dataset:
    """List and probe one dataset; falls back to its raw files, and defers when these fail too."""
    folder = f"{data_root.rstrip('/')}/{dataset_id}"
    paths = [r.path for r in list_data_files(spark, folder).select("path").collect()]
    dataset = replace(plan_dataset(folder, dataset_id, paths), csv_multiline=csv_multiline)
    try:
        dataset.read(spark)
        return dataset
    except Exception as error:
        return raw_fallback(spark, dataset, error)


def raw_fallback(spark: SparkSession, dataset: Dataset, error: Exception) -> Dataset:
    """What to do after a failed read, by the class of its message."""
    from ..functions.errors import AUTH_FRAGMENTS, JSON_FRAGMENT, SCHEMA_FRAGMENTS

    text = str(error)
    if any(f in text.lower() for f in AUTH_FRAGMENTS):
        raise DatasetDeferred("The storage asked for authentication.", "hf_auth_required") from error
    if not any(f in text for f in [*SCHEMA_FRAGMENTS, JSON_FRAGMENT]):
        raise error
    raw = replace(
        dataset, config_name=RAW_CONFIG, files=tuple((0, p) for p in sorted(dataset.paths()))
    )
    try:
        raw.read(spark)
        return raw
    except Exception as raw_error:
        raise DatasetDeferred(
            "Both the split reader and the raw-file fallback failed.", "raw_fallback_failed"
        ) from raw_error


def _any_case(suffix: str) -> str:
    """A suffix as a glob that takes it in any case."""
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in suffix)


# File names of each format, as globs of Spark's file sources.
GLOBS = {s[1:]: f"*{_any_case(s)}" for s in SUFFIXES} | {
    "jsonl": f"*{{{_any_case('.jsonl')},{_any_case('.jsonl.gz')}}}"
}


def stream_files(
    spark: SparkSession,
    folder: str,
    fmt: str,
    schema: T.StructType | str | None = None,
    max_files: int = 1000,
    glob: str | None = None,
) -> DataFrame:
    """Files of one format below a folder as a stream, in the shape the batch reader gives them, with their
    place: JSON Lines and JSON documents as JSON text, CSV and Parquet typed.

    Files of other formats and metadata files are left alone. Without a ``schema``, CSV and Parquet take that
    of the files that are there at the start; a CSV file with another header then makes the stream fail,
    where a reader that goes by position would mix up columns. The row within a block of a text file is not
    known in a stream (null); :func:`numbered` adds it to a micro-batch.
    """
    if fmt not in GLOBS:
        raise ValueError(f"unknown format {fmt!r}; known are {', '.join(sorted(GLOBS))}")
    options = {"recursiveFileLookup": True, "pathGlobFilter": glob or GLOBS[fmt]}
    reader = spark.readStream.option("maxFilesPerTrigger", max_files).options(**options)
    data = is_data_file(F.col("_metadata.file_path"))
    unknown, block = F.lit(None).cast("long"), F.col("_metadata.file_block_start")
    if fmt == "jsonl":
        return json_lines(_position(reader.text(folder).where(data), 0, unknown, block, "value"), keep=ORDINAL)
    if fmt == "json":
        docs = _position(reader.text(folder, wholetext=True).where(data), 0, unknown, block, "value")
        return json_documents(docs, keep=ORDINAL).withColumn(ORD_ROW, F.col("__item").cast("long")).drop("__item")
    if fmt == "csv":
        options |= {**CSV_OPTIONS, "multiLine": True, "enforceSchema": False}
        rows = reader.options(**options).schema(schema or spark.read.options(**options).csv(folder).schema).csv(folder)
        return _position(rows.where(data), 0, unknown, block, *[F.col(f"`{c}`") for c in rows.columns])
    rows = reader.schema(schema or spark.read.options(**options).parquet(folder).schema).parquet(folder)
    row = F.col("_metadata.row_index")
    columns = [F.col(f"`{c}`") for c in rows.columns]
    return _position(rows.where(data), 0, row, F.shiftright(row, BLOCK_BITS), *columns)


def numbered(batch: DataFrame) -> DataFrame:
    """Rows of a micro-batch with the row numbers that the stream could not give."""
    return batch.withColumn(ORD_ROW, F.coalesce(ORD_ROW, F.monotonically_increasing_id()))


def stream_dataset(
    spark: SparkSession, folder: str, schemas: dict[str, T.StructType | str] | None = None, max_files: int = 1000
) -> DataFrame:
    """Files of all formats below a folder as one stream of JSON rows, dispatched by suffix.

    Formats that have a schema in ``schemas`` or files at the start are read; CSV and Parquet files of a format
    that is neither named nor there yet would need a schema, so name it if they are to come later.
    """
    schemas = schemas or {}
    there = {file_format(r.path) for r in list_data_files(spark, folder).select("path").collect()}
    formats = [fmt for fmt in GLOBS if fmt in ("jsonl", "json") or fmt in schemas or fmt in there]
    return unite([as_json_rows(stream_files(spark, folder, fmt, schemas.get(fmt), max_files)) for fmt in formats])


# --- samples -------------------------------------------------------------------------------------


def sample_json(spark: SparkSession, dataset: Dataset, n: int = 12) -> list[str]:
    """First ``n`` rows of a dataset as JSON text.

    Files are opened one after the other in dataset order until there are enough rows, so the cost
    does not depend on the size of the dataset.
    """
    rows: list[str] = []
    for split_pos, path in dataset.files:
        one = as_json_rows(sample_safe(read_files(spark, [path], split_pos, dataset.csv_multiline, first_rows=True)))
        rows += [r[0] for r in one.select(JSON_ROW).limit(n - len(rows)).collect()]
        if len(rows) >= n:
            break
    return rows


def sample_safe(df: DataFrame) -> DataFrame:
    """Values that are not text must not look like text in a JSON sample: dates and binaries are
    replaced by a number that only says whether there is a value."""
    changed = {
        f.name: F.when(F.col(f"`{f.name}`").isNotNull(), F.lit(1))
        for f in df.schema
        if f.dataType.typeName() in ("timestamp", "timestamp_ntz", "date", "binary")
        and f.name not in ORDINAL
    }
    return df.withColumns(changed) if changed else df
