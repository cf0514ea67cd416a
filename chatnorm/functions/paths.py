"""Dotted field paths such as ``answer.0.text`` over typed rows and over JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def resolve(schema: T.StructType, path: str | None) -> tuple[Column, T.DataType] | None:
    """Column and type behind a path of a typed row, or None when the schema has no such place.

    A column whose own name contains a dot cannot be addressed.
    """
    if not path:
        return None
    column, dtype = None, schema
    for part in path.split("."):
        if isinstance(dtype, T.StructType):
            if part not in dtype.fieldNames():
                return None
            column = quoted(part) if column is None else column.getField(part)
            dtype = dtype[part].dataType
        elif isinstance(dtype, T.ArrayType) and part.isdigit():
            column, dtype = F.get(column, F.lit(int(part))), dtype.elementType
        elif isinstance(dtype, T.MapType) and isinstance(dtype.keyType, T.StringType):
            column, dtype = column[part], dtype.valueType
        elif isinstance(dtype, T.VariantType):
            step = f"$[{part}]" if part.isdigit() else f'$["{part}"]'
            column = F.try_variant_get(column, step, "variant")
        else:
            return None
    return column, dtype


def first_part(path: Column) -> Column:
    return F.nullif(F.substring_index(path, ".", 1), F.lit(""))


def json_path(path: Column, digits_are_indexes: bool = True) -> Column:
    """JSON path of everything after the first part of a dotted path; null when nothing is left."""
    parts = F.split(path, r"\.")
    tail = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))

    def step(p: Column) -> Column:
        by_name = F.concat(F.lit("['"), p, F.lit("']"))
        if not digits_are_indexes:
            return by_name
        return F.when(p.rlike("^[0-9]+$"), F.concat(F.lit("["), p, F.lit("]"))).otherwise(by_name)

    return F.when(
        F.size(parts) > 1, F.concat(F.lit("$"), F.array_join(F.transform(tail, step), ""))
    )


def json_get(text: Column, path: str | None) -> Column:
    """Raw JSON text (or string value) at a dotted path of a JSON object text; null on a miss."""
    if not path:
        return F.lit(None).cast("string")
    head, *rest = path.split(".")
    steps = "".join(f"[{p}]" if p.isdigit() else f"['{p}']" for p in rest)
    by_name = "".join(f"['{p}']" for p in rest)
    found = F.get_json_object(text, f"$['{head}']{steps}")
    if steps != by_name:
        found = F.coalesce(found, F.get_json_object(text, f"$['{head}']{by_name}"))
    return found
