"""Shared inputs of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scoring
from ..plans.session import file_system


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def table_files(spark: SparkSession, sf_dir: str, name: str) -> tuple[str, str]:
    """Folder and name pattern of a table's files, for streams: a table is one file or a folder of part files."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    fs, hadoop_path = file_system(spark, path)
    return (path, "*") if fs.getFileStatus(hadoop_path).isDirectory() else (sf_dir, f"{name}.parquet")


def gathered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conv_id, messages``: the turns of a conversation in order. A conversation is one record
    and has to fit into one row, here as in every input that stores it as a list."""
    turns = table(spark, sf_dir, "conversations")
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content"))))
    return turns.groupBy("conv_id").agg(
        F.transform(ordered, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias(
            "messages"
        )
    )


def turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conv_id, turn, question, answer``: each user turn with the assistant turn after it."""
    turns = table(spark, sf_dir, "conversations")
    asked = turns.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("question"))
    replied = turns.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer")
    )
    return asked.join(replied, ["conv_id", "turn"])


def write_json_lines(df: DataFrame, path: str) -> None:
    """Rows as JSON Lines in ``.jsonl`` files. Only Spark's CSV writer lets one choose the suffix;
    separator and quote are characters that JSON text never holds."""
    df.select(F.to_json(F.struct("*")).alias("value")).write.options(
        sep="\x01", quote="", escapeQuotes=False, header=False, extension="jsonl"
    ).csv(path)


# The same inputs in SQL.
SQL_PAIRS = """
    SELECT u.conv_id, u.turn, u.text AS question, a.text AS answer
    FROM conversations u JOIN conversations a
      ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
    WHERE u.role = 'user' AND a.role = 'assistant'
"""


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sql_json(expr: str) -> str:
    return f"CAST(to_json({expr}) AS VARCHAR)"


def _sql_markers(expr: str, markers: list[str]) -> str:
    return " + ".join(f"CAST(contains({expr}, {sql_text(m)}) AS INT)" for m in markers)


def _sql_count(expr: str, char: str) -> str:
    return f"(length({expr}) - length(replace({expr}, {sql_text(char)}, '')))"


def sql_code_score(x: str) -> str:
    newline = f"(length({x}) - length(replace({x}, chr(10), '')))"
    return (
        f"({_sql_markers(x, scoring.CODE_MARKERS)} + {newline} * 0.05::DOUBLE"
        f" + ({_sql_count(x, '{')} + {_sql_count(x, '}')}) * 0.1::DOUBLE)"
    )


def _sql_wordy(x: str, markers: list[str], blanks: int) -> str:
    return (
        f"({_sql_markers(f'lower({x})', markers)}"
        f" + CASE WHEN {_sql_count(x, ' ')} > {blanks} THEN 1.0 ELSE 0.0 END"
        f" - CASE WHEN {sql_code_score(x)} > 3 THEN 0.5 ELSE 0.0 END)::DOUBLE"
    )


def sql_prompt_score(x: str) -> str:
    return _sql_wordy(x, scoring.PROMPT_MARKERS, 5)


def sql_language_score(x: str) -> str:
    return _sql_wordy(x, scoring.LANGUAGE_MARKERS, 7)


def sql_math_score(x: str) -> str:
    operators = f"length(regexp_replace({x}, '[^=+*/^-]', '', 'g'))"
    return f"({_sql_markers(f'lower({x})', scoring.MATH_MARKERS)} + {operators} * 0.03::DOUBLE)"


def sql_vectorish(x: str) -> str:
    digits = f"length(regexp_replace({x}, '[^0-9]', '', 'g'))"
    return (
        f"(length({x}) > 0 AND ((starts_with({x}, '[') AND ends_with({x}, ']'))"
        f" OR (starts_with({x}, '{{') AND ends_with({x}, '}}'))"
        f" OR (length({x}) > 300 AND {_sql_count(x, ',')} > 30)"
        f" OR ({digits} / greatest(1, length({x})) > 0.35 AND {_sql_count(x, ' ')} < 10)))"
    )
