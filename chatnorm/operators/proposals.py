"""Mappings proposed as free text (for example by a model or a person), checked against the data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.language import normalize_language
from ..functions.text import json_fields, json_value, json_variants, strip, variant_kind
from ..types import CONVERSATION_TYPES, TASK_TYPES

_TEXT_FIELDS = [
    "user_field",
    "input_field",
    "assistant_field",
    "messages_field",
    "reasoning_field",
    "language_field",
]
_CHECKED_FIELDS = ["user_field", "assistant_field", "messages_field", "language_field"]
# Texts that count as a boolean.
_TRUE_TEXTS = ["1", "on", "t", "true", "y", "yes"]
_FALSE_TEXTS = ["0", "off", "f", "false", "n", "no"]


def json_object_in(text: Column) -> Column:
    """JSON object in a free text: the text itself, without a code fence, or its widest ``{...}``."""
    s = strip(text)
    fenced = F.trim(s, F.lit("`"))
    unfenced = F.when(
        s.startswith("```"),
        F.when(fenced.startswith("json"), strip(fenced.substr(F.lit(5), F.length(fenced)))).otherwise(
            fenced
        ),
    ).otherwise(s)
    widest = F.regexp_extract(unfenced, r"(?s)\{.*\}", 0)
    return (
        F.when(json_fields(unfenced).isNotNull(), unfenced)
        .when(json_value(unfenced).isNotNull(), F.lit(None).cast("string"))
        .when(json_fields(widest).isNotNull(), widest)
    )


def validate_proposals(
    proposals: DataFrame, columns: DataFrame, reject_missing_type: bool = True
) -> DataFrame:
    """Decision and reason per proposal.

    ``proposals``: ``dataset_id, task_type, response``; ``columns``: ``dataset_id, columns`` with
    the column names of each dataset. ``decision`` is ``accept`` or ``heuristic``.
    """
    p = (
        proposals.withColumn("__object", json_object_in(F.col("response")))
        .withColumn("__v", json_variants(F.col("__object")))
        .withColumn("__k", F.transform_values("__v", lambda _, v: variant_kind(v)))
    )
    kinds = {
        n: F.col("__k")[n]
        for n in ["is_target_dataset", "task_type", "conversation_type", "language",
                  "metadata_fields", *_TEXT_FIELDS]
    }
    given = {n: kind.isNotNull() & (kind != "VOID") for n, kind in kinds.items()}

    def text(name: str) -> Column:
        return F.when(
            kinds[name] == "STRING", F.try_variant_get(F.col("__v")[name], "$", "string")
        )

    flag = F.col("__v")["is_target_dataset"]
    flag_text = F.lower(F.try_variant_get(flag, "$", "string"))
    numeric = F.try_variant_get(flag, "$", "double")
    is_target = (
        F.when(kinds["is_target_dataset"] == "BOOLEAN", F.try_variant_get(flag, "$", "boolean"))
        .when(
            kinds["is_target_dataset"] == "STRING",
            F.when(flag_text.isin(*_TRUE_TEXTS), F.lit(True)).when(
                flag_text.isin(*_FALSE_TEXTS), F.lit(False)
            ),
        )
        .when(numeric == 1, F.lit(True))
        .when(numeric == 0, F.lit(False))
    )
    names = F.try_variant_get(F.col("__v")["metadata_fields"], "$", "array<variant>")
    names_are_text = F.forall(names, lambda n: F.coalesce(variant_kind(n) == "STRING", F.lit(False)))
    well_typed = reduce(
        lambda a, b: a & b,
        [
            is_target.isNotNull(),
            F.coalesce(text("task_type").isin(*TASK_TYPES), F.lit(False)),
            ~given["conversation_type"]
            | F.coalesce(text("conversation_type").isin(*CONVERSATION_TYPES), F.lit(False)),
            ~F.map_contains_key("__v", "language") | (F.coalesce(kinds["language"], F.lit("")) == "STRING"),
            ~F.map_contains_key("__v", "metadata_fields")
            | F.coalesce(
                (F.coalesce(kinds["metadata_fields"], F.lit("")) == "ARRAY") & names_are_text,
                F.lit(False),
            ),
            *[
                ~given[n] | (F.coalesce(kinds[n], F.lit("STRING")) == "STRING")
                for n in _TEXT_FIELDS
            ],
        ],
    )
    parsed = p.select(
        "dataset_id",
        F.col("task_type").alias("__wanted"),
        F.when(F.col("__v").isNotNull(), well_typed).alias("__well_typed"),
        is_target.alias("is_target_dataset"),
        text("task_type").alias("task_type"),
        text("conversation_type").alias("conversation_type"),
        *[F.nullif(text(n), F.lit("")).alias(n) for n in _TEXT_FIELDS],
        normalize_language(F.coalesce(text("language"), F.lit("unknown"))).alias("language"),
        F.coalesce(
            F.transform(names, lambda n: F.try_variant_get(n, "$", "string")),
            F.array().cast("array<string>"),
        ).alias("metadata_fields"),
    ).join(columns.select("dataset_id", "columns"), "dataset_id", "left")

    unknown = reduce(
        lambda a, b: a | b,
        [
            F.col(n).isNotNull() & ~F.coalesce(F.array_contains("columns", F.col(n)), F.lit(False))
            for n in _CHECKED_FIELDS
        ],
    )
    kind = F.col("conversation_type")
    reason = (
        F.when(F.col("__well_typed").isNull(), F.lit("no_json_object"))
        .when(~F.col("__well_typed"), F.lit("bad_types"))
        .when(~F.col("is_target_dataset"), F.lit("not_target"))
        .when(F.col("task_type") != F.col("__wanted"), F.lit("task_mismatch"))
    )
    if reject_missing_type:
        reason = reason.when(kind.isNull(), F.lit("missing_conversation_type"))
    reason = (
        reason.when(
            (kind == "single_turn")
            & (F.col("user_field").isNull() | F.col("assistant_field").isNull()),
            F.lit("incomplete_single_turn"),
        )
        .when((kind == "multi_turn") & F.col("messages_field").isNull(), F.lit("incomplete_multi_turn"))
        .when(unknown, F.lit("unknown_field"))
        .otherwise(F.lit("ok"))
    )
    return (
        parsed.withColumn("reason", reason)
        .withColumn(
            "decision",
            F.when(F.col("reason").isin("ok", "not_target"), F.lit("accept")).otherwise(
                F.lit("heuristic")
            ),
        )
        .drop("__well_typed", "__wanted", "columns")
    )


def resolve_mappings(detected: DataFrame, validated: DataFrame | None) -> DataFrame:
    """Accepted proposals, else the detected mapping of the dataset."""
    if validated is None:
        return detected
    accepted = validated.where("decision = 'accept'")
    fields = [c for c in detected.columns if c != "dataset_id"]
    both = detected.alias("d").join(accepted.alias("p"), "dataset_id", "left")
    use = F.col("p.decision").isNotNull()
    return both.select(
        "dataset_id",
        *[F.when(use, F.col(f"p.{c}")).otherwise(F.col(f"d.{c}")).alias(c) for c in fields],
    )


def check_task_type(task_type: str) -> None:
    if task_type not in TASK_TYPES:
        raise ValueError(f"unknown task type {task_type!r}")
