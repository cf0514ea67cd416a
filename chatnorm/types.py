"""Schemas and constants shared by the whole package."""

from __future__ import annotations

from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Task types.
TASK_TYPES = ("code_generation", "math", "natural_language")
CONVERSATION_TYPES = ("single_turn", "multi_turn")

MESSAGE = T.StructType(
    [T.StructField("role", T.StringType()), T.StructField("content", T.StringType())]
)
CONVERSATION = T.ArrayType(MESSAGE)

# The written columns in their order.
RECORD_COLUMNS = ["conversation", "language", "reasoning", "metadata", "dataset_id"]

# Position of a raw row inside its dataset. Readers add these columns; the
# tuple (split, file, block, row) orders the rows of one dataset and is unique.
ORD_SPLIT, ORD_FILE, ORD_BLOCK, ORD_ROW = "__split_pos", "__file", "__block", "__row"
ORDINAL = [ORD_SPLIT, ORD_FILE, ORD_BLOCK, ORD_ROW]
ORDINAL_DDL = f"{ORD_SPLIT} INT, {ORD_FILE} STRING, {ORD_BLOCK} BIGINT, {ORD_ROW} BIGINT"

# Readers of JSON text put the whole row into this column.
JSON_ROW = "__json"

# The columns of a mapping.
MAPPING_DDL = (
    "dataset_id STRING, is_target_dataset BOOLEAN, task_type STRING, conversation_type STRING, "
    "user_field STRING, input_field STRING, assistant_field STRING, messages_field STRING, "
    "reasoning_field STRING, language STRING, language_field STRING, metadata_fields ARRAY<STRING>"
)

# The columns of the run log, and the id of its own entries.
RUN_LOG_COLUMNS = [
    "domain",
    "timestamp_utc",
    "dataset_id",
    "status",
    "config_name",
    "split_name",
    "records_written",
    "message",
    "error",
]
SYSTEM_ID = "__system__"

REGISTRY_DDL = "dataset_id STRING, domain STRING, status STRING, marked_at TIMESTAMP, seq BIGINT"

# Metadata keys that the engine writes itself; a mapped field of the same name is ignored.
RESERVED_METADATA = ("dataset_id", "task_type", "language_source", "source_fields")


@dataclass(frozen=True)
class Mapping:
    """Which columns of one dataset hold the prompt, the answer, the messages and so on."""

    dataset_id: str
    task_type: str
    is_target_dataset: bool = True
    conversation_type: str | None = None
    user_field: str | None = None
    input_field: str | None = None
    assistant_field: str | None = None
    messages_field: str | None = None
    reasoning_field: str | None = None
    language: str = "unknown"
    language_field: str | None = None
    metadata_fields: tuple[str, ...] = field(default_factory=tuple)

    @staticmethod
    def from_row(row) -> "Mapping":
        values = row.asDict()
        values = {k: values[k] for k in Mapping.__dataclass_fields__ if k in values}
        values["metadata_fields"] = tuple(values.get("metadata_fields") or ())
        values["language"] = values.get("language") or "unknown"
        return Mapping(**values)

    def as_tuple(self) -> tuple:
        return (
            self.dataset_id,
            self.is_target_dataset,
            self.task_type,
            self.conversation_type,
            self.user_field,
            self.input_field,
            self.assistant_field,
            self.messages_field,
            self.reasoning_field,
            self.language,
            self.language_field,
            list(self.metadata_fields),
        )


def local_frame(spark, rows: list[tuple], ddl: str):
    """DataFrame over a short driver-side list.

    Built from an Arrow table, so the planner knows its size (a list turned into an RDD has an
    unknown size, and joins with it would shuffle the other side).
    """
    schema = T.StructType.fromDDL(ddl)
    arrow = to_arrow_schema(schema)
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    arrays = [pa.array(list(c), type=f.type) for c, f in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), schema)


def mappings_frame(spark, mappings):
    """A mappings DataFrame, one short row per dataset."""
    return local_frame(spark, [m.as_tuple() for m in mappings], MAPPING_DDL)
