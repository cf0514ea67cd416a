"""Exact de-duplication of records and of any table."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.messages import conversation_json
from ..functions.text import strip
from ..types import ORDINAL


def fingerprint(conversation_text: Column, reasoning: Column) -> Column:
    """SHA-1 of the exported conversation and the reasoning; null and empty reasoning are equal."""
    return F.sha1(
        F.concat(
            F.coalesce(conversation_text, F.lit("")),
            F.lit("\n<SEP>\n"),
            F.coalesce(reasoning, F.lit("")),
        )
    )


def record_fingerprint(conversation: Column, reasoning: Column) -> Column:
    return fingerprint(conversation_json(conversation), reasoning)


def first_per_key(df: DataFrame, keys: list, order: list) -> DataFrame:
    """First row per key. The rank filter is applied before the shuffle as well, so each task
    sends at most one row per key and a key that fills a third of the table stays harmless."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def first_records(records: DataFrame, order: list, domain: str = "domain", fp: str = "fp") -> DataFrame:
    """First record of each fingerprint within a domain."""
    return first_per_key(records, [domain, fp], order)


def unseen_records(
    records: DataFrame, existing: DataFrame, keys: tuple[str, ...] = ("domain", "fp")
) -> DataFrame:
    """Records whose fingerprint is not in earlier output. Apply after ``first_records``, whose
    result has each key once and is already partitioned by it."""
    return records.join(existing.select(*keys), list(keys), "left_anti")


def record_counts(records: DataFrame, duplicates: DataFrame) -> DataFrame:
    """``dataset_id, taken, duplicates, written`` from one aggregation over two tables with a ``dataset_id``."""
    both = records.select("dataset_id", F.lit(0).alias("left_out")).unionByName(
        duplicates.select("dataset_id", F.lit(1).alias("left_out"))
    )
    taken, left_out = F.count_if(F.col("left_out") == 0), F.count_if(F.col("left_out") == 1)
    return both.groupBy("dataset_id").agg(
        taken.alias("taken"), left_out.alias("duplicates"), (taken - left_out).alias("written")
    )


def _comparable(c: Column, dtype: T.DataType, ignore_case: bool, strip_whitespace: bool) -> Column:
    if isinstance(dtype, T.StringType):
        c = strip(c) if strip_whitespace else c
        return F.lower(c) if ignore_case else c
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return c + F.lit(0.0)  # one zero
    if isinstance(dtype, T.MapType):
        return F.array_sort(F.map_entries(c))
    return c


def dedup_key(
    df: DataFrame,
    subset: list[str] | None = None,
    ignore_case: bool = False,
    strip_whitespace: bool = False,
) -> Column:
    """One fixed-size key per row; nulls are equal to each other.

    A digest keeps the sort and shuffle keys short when the key columns hold long texts.
    """
    unknown = [c for c in subset or [] if c not in df.columns]
    if unknown:
        raise ValueError(f"Unknown key column {unknown[0]!r}")
    if not subset and (ignore_case or strip_whitespace):
        warnings.warn("ignore_case and strip_whitespace only apply to a column subset", stacklevel=2)
        ignore_case = strip_whitespace = False
    names = subset or [c for c in df.columns if c not in ORDINAL]
    values = [
        _comparable(
            F.col(f"`{n}`"), df.schema[n].dataType, ignore_case, strip_whitespace
        ).alias(f"c{i}")
        for i, n in enumerate(names)
    ]
    if len(names) == 1 and isinstance(df.schema[names[0]].dataType, T.IntegralType):
        return values[0]
    options = {
        "ignoreNullFields": "false",
        "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
        "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
    }
    return F.unhex(F.sha2(F.to_json(F.struct(*values), options), 256))


def drop_duplicates(
    df: DataFrame,
    subset: list[str] | None = None,
    keep: str = "first",
    ignore_case: bool = False,
    strip_whitespace: bool = False,
    order_by: list[str] | None = None,
) -> DataFrame:
    """Rows of ``df`` without duplicates; the values returned are the uncleaned ones.

    ``keep`` is ``first``, ``last`` or ``none`` (drop every member of a duplicated group).
    ``order_by`` defaults to the ordinal columns of the readers. Without a subset and an order
    the ordinal columns are dropped.
    """
    if keep not in ("first", "last", "none"):
        raise ValueError("keep must be 'first', 'last' or 'none'")
    columns = df.columns
    if not subset and not order_by and not (ignore_case or strip_whitespace) and _groupable(df):
        # Members of a group are equal, so any of them will do: a hash aggregate, no sort.
        values = df.drop(*ORDINAL)
        if keep != "none":
            return values.dropDuplicates()
        return values.groupBy(*map(_quoted, values.columns)).count().where("count = 1").drop("count")
    keyed = df.withColumn("__key", dedup_key(df, subset, ignore_case, strip_whitespace))
    if keep == "none":
        # A plain aggregate: partial counts leave at most one row per key and task.
        return (
            keyed.groupBy("__key")
            .agg(F.count(F.lit(1)).alias("n"), F.first(F.struct(*map(_quoted, columns))).alias("r"))
            .where("n = 1")
            .select("r.*")
        )
    order = order_by or [c for c in ORDINAL if c in columns]
    if not order:
        keyed = keyed.withColumn("__pos", F.monotonically_increasing_id())
        order = ["__pos"]
    direction = F.asc if keep == "first" else F.desc
    return first_per_key(keyed, ["__key"], [direction(c) for c in order]).select(
        *map(_quoted, columns)
    )


def _groupable(df: DataFrame) -> bool:
    return not any(
        word in f.dataType.simpleString() for f in df.schema for word in ("map<", "variant")
    )


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def dedup_counts(
    df: DataFrame,
    subset: list[str] | None = None,
    keep: str = "first",
    ignore_case: bool = False,
    strip_whitespace: bool = False,
) -> DataFrame:
    """Rows before, after and removed, from one narrow aggregate on the key alone."""
    groups = df.groupBy(dedup_key(df, subset, ignore_case, strip_whitespace).alias("k")).count()
    kept = F.count_if(F.col("count") == 1) if keep == "none" else F.count(F.lit(1))
    return groups.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("rows_before"), kept.alias("rows_after")
    ).withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))
