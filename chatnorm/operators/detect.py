"""Which columns hold what: profiles of columns, and mappings derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scoring
from ..functions.language import LANGUAGE_COLUMNS, normalize_language
from ..functions.messages import looks_like_messages_json, looks_like_messages_typed
from ..functions.paths import quoted
from ..functions.text import (
    json_fields,
    json_variants,
    raw_json_text,
    strip,
    to_text,
    variant_kind,
)
from ..types import JSON_ROW, MAPPING_DDL, TASK_TYPES

_DATASET = ["dataset_id", "task_type"]
_NUMBERS = ["prompt", "answer", "len", "plain_len"]


def value_scores(text: str, lower: str, task_type: str) -> dict[str, Column]:
    """Numbers per value of a text column; null where the value is not a non-blank string.

    All arguments are SQL text of plain columns (``task_type`` may be a literal).
    """

    def where_present(sql: str) -> Column:
        return F.expr(f"if({text} IS NOT NULL, {sql}, NULL)")

    return {
        "prompt": where_present(scoring.task_prompt_score_sql(text, task_type, lower)),
        "answer": where_present(scoring.task_answer_score_sql(text, task_type, lower)),
        "len": F.length(text),
        "plain_len": where_present(
            f"if({scoring.vectorish_sql(text, stripped=True)}, NULL, length({text}))"
        ),
    }


def column_stats(scores: dict[str, Column], message_like: Column) -> Column:
    """Aggregates over the values of one column, as a struct.

    All members are counts and means of numbers, so the aggregate stays a hash aggregate with
    partial results.
    """
    return F.struct(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(message_like).alias("n_messages"),
        F.count(scores["len"]).alias("n_text"),
        F.avg(scores["prompt"]).alias("prompt"),
        F.avg(scores["answer"]).alias("answer"),
        F.avg(scores["len"]).alias("avg_len"),
        F.count(scores["plain_len"]).alias("n_plain"),
        F.avg(scores["plain_len"]).alias("plain_len"),
    )


def is_context_column(stats: Column) -> Column:
    """Mostly plain text of moderate length."""
    enough = stats["n_plain"] >= F.greatest(F.lit(1), F.floor(stats["n_text"] / 2))
    return (
        (stats["n_text"] > 0)
        & enough
        & F.coalesce(stats["plain_len"] <= scoring.MAX_CONTEXT_LENGTH, F.lit(False))
    )


def profile_table(
    df: DataFrame, task_type: str, group: list[str] | None = None, columns: list[str] | None = None
) -> DataFrame:
    """Statistics of every column over all rows: one pass, no row multiplication.

    Result: one row per group and column (``col_pos``, ``col`` and the members of
    :func:`column_stats`).
    """
    return profile_tasks(df, (task_type,), group, columns).drop("task_type")


def profile_tasks(
    df: DataFrame,
    task_types: tuple[str, ...] = TASK_TYPES,
    group: list[str] | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """The statistics of :func:`profile_table` for several task types, with the column ``task_type``, in one pass.

    Scores of a value that more than one task type needs, the code score above all, are computed once.
    """
    group = group or []
    names = columns or [c for c in df.columns if c not in group]
    types = [df.schema[n].dataType for n in names]
    texts = [i for i, t in enumerate(types) if isinstance(t, T.StringType)]
    # Projections in steps, so that the text, its lower-case form and the scores are each computed
    # once per row and value; the aggregate then sees numbers only.
    rows = df.select(
        *group,
        *[F.nullif(strip(quoted(names[i])), F.lit("")).alias(f"__t{i}") for i in texts],
        *[looks_like_messages_typed(quoted(n), t).alias(f"__m{i}") for i, (n, t) in enumerate(zip(names, types))],
    )
    if texts:
        code = {f"__code{i}": F.expr(scoring.code_score_sql(f"__t{i}")) for i in texts}
        rows = rows.withColumns({f"__l{i}": F.lower(f"__t{i}") for i in texts} | code)
        scores = {}
        for i in texts:
            text, lower, code = f"__t{i}", f"__l{i}", f"__code{i}"
            vectorish = scoring.vectorish_sql(text, stripped=True)
            for name, sql in (
                ("prompt", scoring.prompt_score_sql(text, lower, code)),
                ("math", scoring.math_score_sql(text, lower)),
                ("words", scoring.natural_language_score_sql(text, lower, code)),
                ("plain", f"if({vectorish}, NULL, length({text}))"),
            ):
                scores[f"__{name}{i}"] = F.expr(f"if({text} IS NOT NULL, {sql}, NULL)")
            scores[f"__len{i}"] = F.length(text)
        rows = rows.withColumns(scores)
    of_task = {"code_generation": ("prompt", "code"), "math": ("math", "math")}

    def numbers(i: int, task: str) -> dict[str, Column]:
        if i not in texts:
            return {k: F.lit(None).cast("double") for k in _NUMBERS}
        prompt, answer = of_task.get(task, ("words", "words"))
        there = F.col(f"__t{i}").isNotNull()
        members = {"prompt": prompt, "answer": answer, "len": "len", "plain_len": "plain"}
        return {k: F.when(there, F.col(f"__{v}{i}")) for k, v in members.items()}

    stats = [
        F.struct(
            F.lit(task).alias("task_type"),
            F.lit(i).alias("col_pos"),
            F.lit(name).alias("col"),
            column_stats(numbers(i, task), F.col(f"__m{i}")).alias("s"),
        )
        for task in task_types
        for i, name in enumerate(names)
    ]
    found = rows.groupBy(*group).agg(F.array(*stats).alias("stats")).select(*group, F.explode("stats").alias("x"))
    return found.select(*group, "x.task_type", "x.col_pos", "x.col", "x.s.*")


def table_cells(df: DataFrame, dataset_id: str, task_type: str, order: list[str]) -> DataFrame:
    """Sample rows of one typed dataset as cells (row position, column, text)."""
    names = [c for c in df.columns if c not in order]
    cells = []
    for pos, name in enumerate(names):
        c, dtype = quoted(name), df.schema[name].dataType
        text = F.nullif(strip(c), F.lit("")) if isinstance(dtype, T.StringType) else F.lit(None)
        cells.append(
            F.struct(
                F.lit(pos).alias("col_pos"),
                F.lit(name).alias("col"),
                text.cast("string").alias("text"),
                _language_value(F.lit(name), F.when(c.isNotNull(), to_text(c, dtype))).alias(
                    "language"
                ),
                looks_like_messages_typed(c, dtype).alias("message_like"),
            )
        )
    return df.select(
        F.lit(dataset_id).alias("dataset_id"),
        F.lit(task_type).alias("task_type"),
        F.struct(*order).alias("row_pos"),
        F.explode(F.array(*cells)).alias("cell"),
    ).select("dataset_id", "task_type", "row_pos", "cell.*")


def _language_value(name: Column, value: Column) -> Column:
    return F.when(F.lower(name).isin(*LANGUAGE_COLUMNS), value)


def json_cells(samples: DataFrame, value_col: str = JSON_ROW) -> DataFrame:
    """Sample rows of many datasets, as JSON text, as cells.

    ``samples`` has ``dataset_id, task_type, row_pos`` and the JSON text; the columns of a dataset
    are the keys of its first row, and a later row without a key counts as null there.
    """
    rows = samples.withColumn("__fields", json_fields(F.col(value_col))).where(
        F.col("__fields").isNotNull()
    )
    columns = rows.groupBy("dataset_id").agg(
        F.min_by(F.json_object_keys(value_col), "row_pos").alias("columns")
    )
    cells = (
        rows.join(columns, "dataset_id")
        .withColumn("__typed", json_variants(F.col(value_col)))
        .select("*", F.posexplode("columns").alias("col_pos", "col"))
        .withColumn("__raw", F.col("__fields")[F.col("col")])
        .withColumn(
            "__kind",
            F.coalesce(
                variant_kind(F.col("__typed")[F.col("col")]),
                F.when(F.col("__raw").isNotNull(), F.lit("STRING")),
            ),
        )
    )
    is_text = F.col("__kind") == "STRING"
    return cells.select(
        *_DATASET,
        "row_pos",
        "col_pos",
        "col",
        F.when(is_text, F.nullif(strip(F.col("__raw")), F.lit(""))).alias("text"),
        _language_value(
            F.col("col"),
            F.when(F.col("__raw").isNotNull(), raw_json_text(F.col("__raw"), F.col("__kind"))),
        ).alias("language"),
        looks_like_messages_json(F.col("__raw")).alias("message_like"),
    )


def detect_mappings(cells: DataFrame) -> DataFrame:
    """One mapping per dataset of the cells. All datasets are handled in one job.

    Two aggregates: cells -> columns, columns -> datasets. The array built per dataset has one
    short entry per column.
    """
    lowered = cells.withColumn("__lower", F.lower("text"))
    scores = value_scores("text", "__lower", "task_type")
    numbers = {k: F.col(f"__{k}") for k in scores}
    stats = (
        lowered.withColumns({f"__{k}": v for k, v in scores.items()})
        .groupBy(*_DATASET, "col_pos", "col")
        .agg(
            column_stats(numbers, F.col("message_like")).alias("s"),
            F.min_by("language", F.when(F.col("language").isNotNull(), F.col("row_pos"))).alias(
                "language"
            ),
        )
    )
    columns = stats.groupBy(*_DATASET).agg(
        F.array_sort(
            F.collect_list(F.struct("col_pos", "col", "language", "s.*"))
        ).alias("columns")
    )
    return choose_mapping(columns)


def choose_mapping(columns: DataFrame) -> DataFrame:
    """Datasets with an array of column statistics -> mappings."""

    def best(candidates: Column, score: str) -> Column:
        ranked = F.transform(
            candidates,
            lambda c: F.struct(c[score].alias("score"), (-c["col_pos"]).alias("early"), c.alias("c")),
        )
        return F.array_max(ranked)["c"]

    def others(candidates: Column, *taken: Column) -> Column:
        return F.filter(
            candidates, lambda c: ~F.coalesce(c["col_pos"].isin(*[t["col_pos"] for t in taken]), F.lit(False))
        )

    first_of = lambda condition: F.get(F.filter("columns", condition), F.lit(0))
    chosen = (
        columns.withColumn("lang", first_of(lambda c: c["language"].isNotNull()))
        .withColumn(
            "messages",
            first_of(
                lambda c: c["n_messages"] >= F.greatest(F.lit(1), F.floor(c["n_rows"] / 2))
            ),
        )
        .withColumn("texts", F.filter("columns", lambda c: c["n_text"] > 0))
        .withColumn("assistant", best(F.col("texts"), "answer"))
        .withColumn("user", best(others(F.col("texts"), F.col("assistant")), "prompt"))
        .withColumn(
            "extra", best(others(F.col("texts"), F.col("assistant"), F.col("user")), "prompt")
        )
    )
    multi = F.col("messages").isNotNull()
    single = F.coalesce(
        ~multi
        & (F.col("assistant.answer") >= scoring.MIN_SCORE)
        & (F.col("user.prompt") >= scoring.MIN_SCORE),
        F.lit(False),
    )
    extra_fits = F.coalesce(
        (F.col("extra.prompt") >= scoring.MIN_SCORE) & is_context_column(F.col("extra")),
        F.lit(False),
    )
    target = multi | single
    fields = {
        "dataset_id": F.col("dataset_id"),
        "is_target_dataset": target,
        "task_type": F.col("task_type"),
        "conversation_type": F.when(multi, F.lit("multi_turn")).when(single, F.lit("single_turn")),
        "user_field": F.when(single, F.col("user.col")),
        "input_field": F.when(single & extra_fits, F.col("extra.col")),
        "assistant_field": F.when(single, F.col("assistant.col")),
        "messages_field": F.col("messages.col"),
        "reasoning_field": F.lit(None).cast("string"),
        "language": F.when(
            target & F.col("lang").isNotNull(), normalize_language(F.col("lang.language"))
        ).otherwise(F.lit("unknown")),
        "language_field": F.when(target, F.col("lang.col")),
        "metadata_fields": F.array().cast("array<string>"),
    }
    names = [f.name for f in T.StructType.fromDDL(MAPPING_DDL)]
    return chosen.select(*[fields[n].alias(n) for n in names])
