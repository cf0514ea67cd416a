"""Raw rows -> conversation records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import messages as msg
from ..functions.language import normalize_language
from ..functions.paths import first_part, json_path, quoted, resolve
from ..functions.scoring import MAX_CONTEXT_LENGTH, bracketed
from ..functions.text import (
    is_json_collection,
    is_nested,
    json_fields,
    json_string,
    json_variants,
    python_float_text,
    raw_json_text,
    strip,
    to_text,
    variant_kind,
)
from ..types import CONVERSATION, JSON_ROW, ORDINAL, RECORD_COLUMNS, RESERVED_METADATA, Mapping

MAX_METADATA_LENGTH = 500


def user_prompt(primary: Column, additional: Column) -> Column:
    """Both parts joined by a blank line; blank parts are left out."""
    return F.concat_ws(
        "\n\n",
        F.when(F.coalesce(strip(primary), F.lit("")) != "", primary),
        F.when(F.coalesce(strip(additional), F.lit("")) != "", additional),
    )


def is_noisy_auxiliary(text: Column, dtype: T.DataType | None = None) -> Column:
    """Auxiliary text too long to be context, or a serialised collection."""
    if dtype is not None and is_nested(dtype):
        return text.isNotNull()
    s = strip(text)
    return F.coalesce((F.length(s) > MAX_CONTEXT_LENGTH) | bracketed(s), F.lit(False))


def metadata_value(c: Column, dtype: T.DataType | None = None) -> Column:
    """JSON text of a metadata value; null for a value that is left out.

    Numbers and booleans stay as they are, short texts are stripped, collections are left out.
    """
    if dtype is not None and is_nested(dtype):
        return F.lit(None).cast("string")
    if isinstance(dtype, T.BooleanType):
        return c.cast("string")
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        text = python_float_text(c)
        for spelling, name in (("nan", "NaN"), ("inf", "Infinity"), ("-inf", "-Infinity")):
            text = F.when(text == spelling, F.lit(name)).otherwise(text)
        return text
    if isinstance(dtype, T.IntegralType):
        return c.cast("string")
    s = to_text(c, dtype)
    return F.when(
        (s != "") & (F.length(s) <= MAX_METADATA_LENGTH) & ~is_json_collection(s), json_string(s)
    )


def metadata_json(
    dataset_id: Column,
    task_type: Column,
    language_source: Column,
    source_fields: list[Column],
    extra: list[tuple[str, Column]],
) -> Column:
    """The metadata object of a record as JSON text; ``extra`` values are JSON text or null."""
    fixed = _fixed_metadata(
        dataset_id, task_type, language_source, F.array(*source_fields)
    )
    parts = [F.concat(F.lit(f"{_literal(name)}: "), value) for name, value in extra]
    return F.concat(F.lit("{"), F.concat_ws(", ", fixed, *parts), F.lit("}"))


def _fixed_metadata(dataset_id, task_type, language_source, source_fields) -> Column:
    return F.concat(
        F.lit('"dataset_id": '), json_string(dataset_id),
        F.lit(', "task_type": '), json_string(task_type),
        F.lit(', "language_source": '), json_string(language_source),
        F.lit(', "source_fields": ['),
        F.array_join(F.transform(source_fields, json_string), ", "),
        F.lit("]"),
    )


def _literal(name: str) -> str:
    escaped = name.replace("\\", "\\\\").replace('"', '\\"')
    for char, short in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        escaped = escaped.replace(char, short)
    return f'"{escaped}"'


def _no_conversation() -> Column:
    return F.array().cast(CONVERSATION)


def _two_turns(user: Column, answer: Column) -> Column:
    return F.array(
        F.struct(F.lit("user").alias("role"), user.alias("content")),
        F.struct(F.lit("assistant").alias("role"), answer.alias("content")),
    )


def _no_empty_turn(conversation: Column) -> Column:
    return F.forall(conversation, lambda m: m["content"] != "")


def _with_conversation(df: DataFrame, conversation: Column, complete) -> DataFrame:
    """Add the conversation and keep the rows that have a complete one.

    Exploding a list of at most one conversation builds it once per row. A plain filter on a
    computed column would be pushed below the projection and parse every payload a second time.
    """
    kept = F.filter(F.array(conversation), complete)
    return df.select("*", F.explode(kept).alias("__conversation"))


def _present(df: DataFrame, names: list[str]) -> list[str]:
    return [n for n in names if n in df.columns]


def convert_table(df: DataFrame, mapping: Mapping, keep: list[str] | None = None) -> DataFrame:
    """Typed rows of one dataset -> records. The mapping becomes literals of the projection.

    ``keep`` names further columns to carry along (default: the ordinal columns that exist).
    """
    keep = _present(df, ORDINAL) if keep is None else keep
    schema = df.schema

    def value(path: str | None) -> tuple[Column, T.DataType]:
        found = resolve(schema, path)
        return found if found is not None else (F.lit(None).cast("string"), T.StringType())

    def text(path: str | None) -> Column:
        return to_text(*value(path))

    if mapping.conversation_type == "single_turn":
        extra_value, extra_type = value(mapping.input_field)
        extra_text = to_text(extra_value, extra_type)
        noisy = F.lit(True) if is_nested(extra_type) else is_noisy_auxiliary(extra_text)
        user = user_prompt(text(mapping.user_field), F.when(~noisy, extra_text))
        conversation = _two_turns(user, text(mapping.assistant_field))
        complete = _no_empty_turn
        sources = [mapping.user_field, mapping.input_field, mapping.assistant_field]
    elif mapping.conversation_type == "multi_turn":
        found = resolve(schema, mapping.messages_field)
        if found is None:
            conversation = _no_conversation()
        elif msg.is_message_array(found[1]):
            conversation = msg.normalize_typed(*found)
        else:
            df = df.withColumn("__payload", msg.payload_text(*found)).withColumn(
                "__list", msg.quick_message_list(F.col("__payload"))
            )
            conversation = msg.normalize_list(
                msg.deep_message_list(F.col("__payload"), F.col("__list"))
            )
        complete = msg.is_complete_conversation
        sources = [mapping.messages_field]
    else:
        conversation, complete, sources = _no_conversation(), msg.is_complete_conversation, []

    if mapping.language_field:
        language = normalize_language(text(mapping.language_field))
    else:
        language = normalize_language(F.lit(mapping.language))
    names = dict.fromkeys(n for n in mapping.metadata_fields if n not in RESERVED_METADATA)
    extra = [
        (n, metadata_value(quoted(n), schema[n].dataType)) for n in names if n in schema.names
    ]
    return _with_conversation(df, conversation, complete).select(
        F.col("__conversation").alias("conversation"),
        language.alias("language"),
        F.nullif(text(mapping.reasoning_field), F.lit("")).alias("reasoning"),
        metadata_json(
            F.lit(mapping.dataset_id),
            F.lit(mapping.task_type),
            F.lit(mapping.language_field or "schema.language"),
            [F.lit(s).cast("string") for s in sources],
            extra,
        ).alias("metadata"),
        F.lit(mapping.dataset_id).alias("dataset_id"),
        *keep,
    )


_TEXT_FIELDS = ["user", "input", "assistant", "reasoning", "language"]


def convert_json(
    df: DataFrame,
    mappings: DataFrame,
    value_col: str = JSON_ROW,
    on: str | list[str] = "dataset_id",
    keep: list[str] | None = None,
    deep: bool = True,
) -> DataFrame:
    """JSON rows of many datasets -> records, in one scan.

    ``df`` has the JSON text of each row and the columns ``on``; ``mappings`` one row per dataset.
    The join is left to the planner: it broadcasts the mappings as long as they are small.
    ``deep=False`` leaves out the Python step of the deep search, for data without such payloads.
    """
    keys = [on] if isinstance(on, str) else on
    keep = _present(df, ORDINAL) if keep is None else keep
    prepared = mappings.where("is_target_dataset").select(
        *keys,
        *([] if "dataset_id" in keys else ["dataset_id"]),
        "task_type",
        "conversation_type",
        F.col("language").alias("__dataset_language"),
        F.col("language_field").alias("__language_source"),
        F.array_except(
            F.coalesce(F.col("metadata_fields"), F.array().cast("array<string>")),
            F.array(*map(F.lit, RESERVED_METADATA)),
        ).alias("__metadata_fields"),
        F.when(
            F.col("conversation_type") == "single_turn",
            F.array("user_field", "input_field", "assistant_field"),
        )
        .otherwise(F.array("messages_field"))
        .alias("__sources"),
        F.transform(F.array(*[f"{f}_field" for f in _TEXT_FIELDS]), _place).alias("__places"),
        _place(F.col("messages_field")).alias("__messages"),
    )
    carried = list(dict.fromkeys([*keys, *keep]))
    rows = (
        df.select(*carried, F.col(value_col).alias(JSON_ROW))
        .join(prepared, keys)
        .withColumn("__fields", json_fields(F.col(JSON_ROW)))
        .withColumn(
            "__texts", F.transform("__places", lambda p: raw_json_text(_raw(p), _kind(p)))
        )
        .withColumn("__raw_messages", _raw(F.col("__messages")))
    )

    def text(field: str) -> Column:
        return F.get("__texts", F.lit(_TEXT_FIELDS.index(field)))

    extra_text = text("input")
    user = user_prompt(text("user"), F.when(~is_noisy_auxiliary(extra_text), extra_text))
    is_single = F.col("conversation_type") == "single_turn"
    is_multi = F.col("conversation_type") == "multi_turn"
    rows = rows.withColumn(
        "__list", F.when(is_multi, msg.quick_message_list(F.col("__raw_messages")))
    )
    messages = F.col("__list")
    if deep:
        messages = msg.deep_message_list(F.when(is_multi, F.col("__raw_messages")), messages)
    conversation = F.when(is_single, _two_turns(user, text("assistant"))).when(
        is_multi, msg.normalize_list(messages)
    )
    kept = _with_conversation(
        rows,
        conversation,
        lambda c: (is_single & _no_empty_turn(c)) | (is_multi & msg.is_complete_conversation(c)),
    )
    language = F.when(F.col("__language_source").isNotNull(), text("language")).otherwise(
        F.col("__dataset_language")
    )
    extra = F.filter(
        F.transform("__metadata_fields", _json_metadata_member), lambda m: m.isNotNull()
    )
    fixed = _fixed_metadata(
        F.col("dataset_id"),
        F.col("task_type"),
        F.coalesce(F.col("__language_source"), F.lit("schema.language")),
        F.col("__sources"),
    )
    return kept.withColumn("__language_text", language).select(
        F.col("__conversation").alias("conversation"),
        normalize_language(F.col("__language_text")).alias("language"),
        F.nullif(text("reasoning"), F.lit("")).alias("reasoning"),
        F.concat(
            F.lit("{"), F.array_join(F.concat(F.array(fixed), extra), ", "), F.lit("}")
        ).alias("metadata"),
        "dataset_id",
        *[c for c in carried if c != "dataset_id"],
    )


def _place(path: Column) -> Column:
    """Where a dotted path leads: a top-level key, and JSON paths for the rest of it."""
    return F.struct(
        first_part(path).alias("key"),
        json_path(path).alias("rest"),
        json_path(path, digits_are_indexes=False).alias("rest_by_name"),
    )


def _raw(place: Column) -> Column:
    member = F.col("__fields")[place["key"]]
    nested = F.when(
        member.startswith("{") | member.startswith("["),
        F.coalesce(
            F.call_function("get_json_object", member, place["rest"]),
            F.call_function("get_json_object", member, place["rest_by_name"]),
        ),
    )
    return F.when(place["rest"].isNull(), member).otherwise(nested)


def _kind(place: Column) -> Column:
    member = json_variants(F.col(JSON_ROW))[place["key"]]
    nested = F.coalesce(
        F.try_variant_get(member, place["rest"], "variant"),
        F.try_variant_get(member, place["rest_by_name"], "variant"),
    )
    kind = F.when(place["rest"].isNull(), variant_kind(member)).otherwise(variant_kind(nested))
    return F.coalesce(kind, F.lit("STRING"))


def _json_metadata_member(name: Column) -> Column:
    raw = F.col("__fields")[name]
    kind = F.coalesce(variant_kind(json_variants(F.col(JSON_ROW))[name]), F.lit("STRING"))
    text = strip(raw)
    plain = F.when(
        (text != "") & (F.length(text) <= MAX_METADATA_LENGTH) & ~is_json_collection(text),
        json_string(text),
    )
    value = (
        F.when(raw.isNull() | kind.isin("OBJECT", "ARRAY", "VOID"), F.lit(None).cast("string"))
        .when(kind == "STRING", plain)
        .otherwise(raw)
    )
    return F.concat(json_string(name), F.lit(": "), value)


def export_records(records: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The five written string columns."""
    return records.select(
        msg.conversation_json(F.col("conversation")).alias("conversation"),
        *RECORD_COLUMNS[1:],
        *(keep or []),
    )


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
