"""Message lists: finding them, and bringing them to ``array<struct<role,content>>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..types import CONVERSATION
from .deep_search import message_list_finder, message_path_finder
from .text import (
    JSON_OPTIONS,
    bind,
    is_nested,
    json_items,
    json_string,
    literal_map,
    raw_json_text,
    strip,
    to_text,
    variant_kind,
)

# Fixed values.
ROLE_LABELS = {
    "human": "user",
    "user": "user",
    "prompt": "user",
    "assistant": "assistant",
    "model": "assistant",
    "gpt": "assistant",
    "bot": "assistant",
}
ROLE_KEYS = ["role", "from", "speaker"]
CONTENT_KEYS = ["content", "value", "text"]
MESSAGE_KEYS = ROLE_KEYS + CONTENT_KEYS
PAYLOAD_KEYS = [
    "messages", "conversation", "conversations", "chat", "chats", "dialog", "dialogue",
]

_ITEMS = "array<struct<m:map<string,string>,t:map<string,variant>>>"


def role_alias(role: Column, role_mapping: dict[str, str] | None = None) -> Column:
    """Known spellings of a role become ``user`` / ``assistant``; other roles stay."""
    if role_mapping is None:
        pairs = ROLE_LABELS
    else:
        pairs = {s.lower(): name for s, name in role_mapping.items()}
    lower = F.lower(role)
    return F.coalesce(literal_map(pairs)[lower], lower) if pairs else lower


def _keep_two_sides(messages: Column) -> Column:
    kept = F.filter(
        messages,
        lambda m: m["role"].isin("user", "assistant") & (m["content"] != ""),
    )
    return F.coalesce(kept, F.array().cast(CONVERSATION))


def is_complete_conversation(messages: Column) -> Column:
    """At least two messages, one of each side."""
    return (
        (F.size(messages) >= 2)
        & F.exists(messages, lambda m: m["role"] == "user")
        & F.exists(messages, lambda m: m["role"] == "assistant")
    )


def conversation_json(messages: Column) -> Column:
    """The exported JSON text of a conversation."""
    one = F.transform(
        messages,
        lambda m: F.concat(
            F.lit('{"role": '), json_string(m["role"]),
            F.lit(', "content": '), json_string(m["content"]), F.lit("}"),
        ),
    )
    return F.concat(F.lit("["), F.array_join(one, ", "), F.lit("]"))


# --- typed columns -----------------------------------------------------------------------------


def normalize_typed(
    c: Column,
    dtype: T.DataType,
    role_path: str = "",
    content_path: str = "",
    role_mapping: dict[str, str] | None = None,
) -> Column:
    """Message list held in a column of the given type."""
    if not is_message_array(dtype):
        return normalize_json(payload_text(c, dtype), role_path, content_path, role_mapping)
    item_type = dtype.elementType

    def one(item: Column) -> Column:
        role = _typed_value(item, item_type, role_path, ROLE_KEYS)
        content = _typed_value(item, item_type, content_path, CONTENT_KEYS)
        return F.struct(role_alias(role, role_mapping).alias("role"), content.alias("content"))

    messages = F.transform(F.filter(c, lambda i: i.isNotNull()), one)
    return bind(messages, _keep_two_sides)


def is_message_array(dtype: T.DataType) -> bool:
    """List of objects, which is normalised without a detour through JSON."""
    return isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, (T.StructType, T.MapType))


def payload_text(c: Column, dtype: T.DataType) -> Column:
    """JSON text of a payload column; null for a type that cannot hold messages."""
    if isinstance(dtype, T.StringType):
        return c
    if is_nested(dtype):
        return F.to_json(c, {"ignoreNullFields": "false"})
    return F.lit(None).cast("string")


def _typed_value(item: Column, item_type: T.DataType, path: str, keys: list[str]) -> Column:
    """Text at ``path``, or of the first of ``keys`` with a value that is not empty or zero."""
    if path:
        found = _walk_typed(item, item_type, path.split("."))
        return F.lit("") if found is None else to_text(*found)
    options = []
    for key in keys:
        found = _walk_typed(item, item_type, [key])
        if found is not None:
            value, dtype = found
            options.append(F.when(_typed_truthy(value, dtype), to_text(value, dtype)))
    return F.coalesce(*options, F.lit("")) if options else F.lit("")


def _walk_typed(item: Column, dtype: T.DataType, parts: list[str]):
    for part in parts:
        if isinstance(dtype, T.StructType) and part in dtype.fieldNames():
            item, dtype = item.getField(part), dtype[part].dataType
        elif isinstance(dtype, T.MapType) and isinstance(dtype.keyType, T.StringType):
            item, dtype = item[part], dtype.valueType
        elif isinstance(dtype, T.ArrayType) and part.isdigit():
            item, dtype = F.get(item, F.lit(int(part))), dtype.elementType
        else:
            return None
    return item, dtype


def _typed_truthy(value: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return value != ""
    if isinstance(dtype, T.BooleanType):
        return value
    if isinstance(dtype, T.NumericType):
        return value != 0
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        return F.size(value) > 0
    return value.isNotNull()


def looks_like_messages_typed(c: Column, dtype: T.DataType) -> Column:
    """Whether the value is a non-empty list whose first item has a message key."""
    if isinstance(dtype, T.StringType):
        return looks_like_messages_json(c)
    found = F.lit(False)
    if isinstance(dtype, T.ArrayType):
        first = F.get(c, F.lit(0))
        if isinstance(dtype.elementType, T.StructType):
            if set(dtype.elementType.fieldNames()) & set(MESSAGE_KEYS):
                found = first.isNotNull()
        elif isinstance(dtype.elementType, T.MapType):
            found = F.arrays_overlap(F.map_keys(first), F.array(*map(F.lit, MESSAGE_KEYS)))
    return F.coalesce(found, F.lit(False))


# --- JSON text ---------------------------------------------------------------------------------


def looks_like_messages_json(c: Column) -> Column:
    s = strip(c)
    first = F.get(json_items(s), F.lit(0))
    typed_first = F.try_variant_get(F.try_parse_json(s), "$[0]", "variant")
    keys = F.array(*map(F.lit, MESSAGE_KEYS))
    found = F.when(
        s.startswith("[") & first.startswith("{"),
        F.arrays_overlap(F.json_object_keys(first), keys)
        & (F.coalesce(variant_kind(typed_first), F.lit("OBJECT")) == "OBJECT"),
    )
    return F.coalesce(found, F.lit(False))


def _payload_list(text: Column) -> Column:
    """JSON list under the first known key that holds a list."""
    return bind(
        F.try_parse_json(text),
        lambda doc: F.coalesce(
            *[
                F.when(
                    F.try_variant_get(doc, f"$.{key}", "array<variant>").isNotNull(),
                    F.get_json_object(text, f"$.{key}"),
                )
                for key in PAYLOAD_KEYS
            ]
        ),
    )


def quick_message_list(c: Column) -> Column:
    """JSON list text of the messages: the value itself when it is a list, or the list under a
    known key when it is an object. Null where only a deep search can tell."""
    return bind(
        strip(c),
        lambda s: F.when(s.startswith("["), F.when(json_items(s).isNotNull(), s)).when(
            s.startswith("{"), _payload_list(s)
        ),
    )


def deep_message_list(c: Column, quick: Column, quick_is_column: bool = True) -> Column:
    """``quick``, or the list that a depth-first search finds in an object without a known key.

    The search is an Arrow UDF. When ``quick`` is a plain column, only the objects it missed reach
    Python, all other rows as null; when it is an expression, Python sees every object (Spark does
    not accept lambdas in the input of a Python function).
    """
    is_object = strip(c).startswith("{")
    asked = F.when(quick.isNull() & is_object, c) if quick_is_column else F.when(is_object, c)
    return F.coalesce(quick, message_list_finder(PAYLOAD_KEYS)(asked))


def _items(list_text: Column) -> Column:
    """Object items of a JSON list as (raw members, typed members).

    Typed members are only parsed when some member could be read in two ways.
    """
    return bind(list_text, _items_of)


def _items_of(list_text: Column) -> Column:
    def uniform(raw: Column) -> Column:
        unclear = F.exists(
            raw,
            lambda m: F.exists(
                F.map_values(m),
                lambda v: v.isin("true", "false", "0", "-0", "0.0", "-0.0")
                | v.startswith("{")
                | v.startswith("["),
            ),
        )
        typed = F.when(
            unclear, F.from_json(list_text, "array<map<string,variant>>", JSON_OPTIONS)
        )
        typed = F.coalesce(typed, F.array().cast("array<map<string,variant>>"))
        return F.zip_with(raw, typed, lambda m, t: F.struct(m.alias("m"), t.alias("t"))).cast(_ITEMS)

    objects = F.filter(
        F.zip_with(
            json_items(list_text),
            F.from_json(list_text, "array<variant>", JSON_OPTIONS),
            lambda i, k: F.when(
                i.startswith("{") & (F.coalesce(variant_kind(k), F.lit("OBJECT")) == "OBJECT"), i
            ),
        ),
        lambda i: i.isNotNull(),
    )
    mixed = F.transform(
        objects,
        lambda i: F.struct(
            F.from_json(i, "map<string,string>", JSON_OPTIONS).alias("m"),
            F.from_json(i, "map<string,variant>", JSON_OPTIONS).alias("t"),
        ),
    ).cast(_ITEMS)
    all_objects = F.from_json(list_text, "array<map<string,string>>", JSON_OPTIONS)
    return F.filter(F.coalesce(bind(all_objects, uniform), mixed), lambda i: i["m"].isNotNull())


def _json_value(item: Column, path: str, keys: list[str]) -> Column:
    if path:
        head, *rest = path.split(".")
        raw, typed = item["m"][head], item["t"][head]
        if rest:
            steps = "$" + "".join(f"[{p}]" if p.isdigit() else f"['{p}']" for p in rest)
            raw, typed = F.get_json_object(raw, steps), F.try_variant_get(typed, steps, "variant")
        return raw_json_text(raw, F.coalesce(variant_kind(typed), F.lit("STRING")))
    options = []
    for key in keys:
        raw = item["m"][key]
        kind = F.coalesce(variant_kind(item["t"][key]), F.lit("STRING"))
        empty = (raw == "") | (
            raw.isin("false", "0", "-0", "0.0", "-0.0", "[]", "{}") & (kind != "STRING")
        )
        options.append(F.when(raw.isNotNull() & ~empty, raw_json_text(raw, kind)))
    return F.coalesce(*options, F.lit(""))


def normalize_list(
    list_text: Column,
    role_path: str = "",
    content_path: str = "",
    role_mapping: dict[str, str] | None = None,
) -> Column:
    """JSON list text -> user/assistant messages with content."""

    def one(item: Column) -> Column:
        role = _json_value(item, role_path, ROLE_KEYS)
        return F.struct(
            role_alias(role, role_mapping).alias("role"),
            _json_value(item, content_path, CONTENT_KEYS).alias("content"),
        )

    return bind(F.transform(_items(list_text), one), _keep_two_sides)


def normalize_json(
    c: Column,
    role_path: str = "",
    content_path: str = "",
    role_mapping: dict[str, str] | None = None,
    deep: bool = True,
) -> Column:
    """Message list anywhere inside a JSON text -> user/assistant messages with content.

    ``operators.convert`` keeps the quick list in a column first, which spares Python most rows.
    """
    quick = quick_message_list(c)
    found = deep_message_list(c, quick, quick_is_column=False) if deep else quick
    return normalize_list(found, role_path, content_path, role_mapping)


def message_path(c: Column) -> Column:
    """Dotted path of the first message list inside a JSON text; null when there is none."""
    return message_path_finder(MESSAGE_KEYS)(c)
