"""Column profiles, detection of mappings, and checks of proposed mappings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.detect import detect_mappings, json_cells, profile_tasks
from ..operators.cap import sample_rows
from ..operators.proposals import json_object_in, resolve_mappings, validate_proposals
from ..types import JSON_ROW, TASK_TYPES
from .common import (
    SQL_PAIRS,
    sql_code_score,
    sql_language_score,
    sql_math_score,
    sql_prompt_score,
    sql_vectorish,
    table,
    turn_pairs,
)


def column_scores(spark, sf_dir):
    """Mean scores of every column of the documents per language and task type, over all rows."""
    documents = table(spark, sf_dir, "documents").select("lang", "text", "source", "n_chars")
    stats = profile_tasks(documents, TASK_TYPES, ["lang"])
    rounded = [F.round(c, 6).alias(c) for c in ("prompt", "answer", "avg_len", "plain_len")]
    return stats.select("lang", "task_type", "col", "n_rows", "n_text", "n_plain", *rounded)


def _json_datasets(spark, sf_dir):
    """Rows of several datasets as JSON text: question/answer pairs per parity of the conversation,
    all documents by language, and conversations as message lists."""
    pairs = turn_pairs(spark, sf_dir)
    coded = pairs.select(
        F.concat(F.lit("code-"), (F.col("conv_id") % 2).cast("string")).alias("dataset_id"),
        F.lit("code_generation").alias("task_type"),
        F.struct("conv_id", "turn").alias("row_pos"),
        F.to_json(
            F.struct(
                F.col("conv_id").alias("id"),
                F.concat(F.lit("Write a function for this problem: "), F.col("question")).alias("instruction"),
                F.lit("the given input").alias("input"),
                F.concat(F.lit("def f(x):\n    return x; # {}\n"), F.col("answer")).alias("output"),
                F.lit("en-US").alias("Lang"),
            )
        ).alias(JSON_ROW),
    )
    documents = table(spark, sf_dir, "documents")
    prose = documents.select(
        F.concat(F.lit("prose-"), F.coalesce("lang", F.lit(""))).alias("dataset_id"),
        F.lit("natural_language").alias("task_type"),
        F.struct(F.col("doc_id").alias("conv_id"), F.lit(0).cast(pairs.schema["turn"].dataType).alias("turn")).alias("row_pos"),
        F.to_json(F.struct("n_chars", F.col("text").alias("body"), F.col("source").alias("origin"))).alias(JSON_ROW),
    )
    turns = table(spark, sf_dir, "conversations")
    chats = turns.select(
        F.lit("chats").alias("dataset_id"),
        F.lit("math").alias("task_type"),
        F.struct("conv_id", "turn").alias("row_pos"),
        F.to_json(
            F.struct(
                "conv_id",
                F.array(F.struct("role", F.col("text").alias("content"))).alias("messages"),
            )
        ).alias(JSON_ROW),
    )
    return coded.unionByName(prose).unionByName(chats)


def schema_detect(spark, sf_dir):
    """Mappings of all datasets, from the first 12 rows of each, in one job."""
    samples = sample_rows(_json_datasets(spark, sf_dir), 12, ["dataset_id"], ["row_pos"])
    return detect_mappings(json_cells(samples)).drop("metadata_fields", "reasoning_field")


def _proposals(spark, sf_dir):
    good = (
        '{"is_target_dataset": true, "task_type": "math", "conversation_type": "single_turn", '
        '"user_field": "text", "assistant_field": "source", "language": "EN_us", "metadata_fields": ["lang"]}'
    )
    response = (
        F.when(F.col("lang") == "en",
               F.when(F.col("n_chars") % 2 == 0, F.lit("```json\n" + good + "\n```")).otherwise(
                   F.lit("Here it is: " + good + " - done.")))
        .when(F.col("lang") == "fr",
              F.lit(good.replace('"math"', '"code_generation"')))
        .when(F.col("lang") == "de",
              F.when(F.col("n_chars") % 2 == 0, F.lit(good.replace('"assistant_field": "source", ', ""))).otherwise(
                  F.lit(good.replace('"user_field": "text"', '"user_field": "nope"'))))
        .when(F.col("n_chars") % 3 == 0, F.lit('{"is_target_dataset": "no", "task_type": "math"}'))
        .when(F.col("n_chars") % 3 == 1, F.col("text"))
        .otherwise(F.lit('{"is_target_dataset": true, "task_type": "math", "language": null}'))
    )
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars", "text")
    return documents.select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("dataset_id"),
        F.lit("math").alias("task_type"),
        response.alias("response"),
    )


def mapping_validate(spark, sf_dir):
    """One proposal per document, as if each were a dataset; rejected ones fall back."""
    documents = table(spark, sf_dir, "documents")
    key = F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("dataset_id")
    columns = documents.select(
        key, F.array(*[F.lit(c) for c in documents.columns]).alias("columns")
    )
    validated = validate_proposals(_proposals(spark, sf_dir), columns)
    fallback = documents.select(
        key,
        F.lit(False).alias("is_target_dataset"),
        F.lit("math").alias("task_type"),
        *[
            F.lit(None).cast("string").alias(c)
            for c in ("conversation_type", "user_field", "input_field", "assistant_field",
                      "messages_field", "reasoning_field")
        ],
        F.lit("unknown").alias("language"),
        F.lit(None).cast("string").alias("language_field"),
        F.array().cast("array<string>").alias("metadata_fields"),
    )
    resolved = resolve_mappings(fallback, validated)
    return resolved.join(validated.select("dataset_id", "decision", "reason"), "dataset_id").select(
        "dataset_id", "decision", "reason", "is_target_dataset", "conversation_type", "user_field",
        "assistant_field", "language", F.array_join("metadata_fields", ",").alias("metadata"),
    )


def relevant_datasets(spark, sf_dir):
    """Target datasets by decision and task type."""
    return (
        mapping_validate(spark, sf_dir)
        .groupBy("reason")
        .agg(
            F.count(F.lit(1)).alias("datasets"),
            F.count_if(F.col("is_target_dataset")).alias("relevant"),
        )
    )


def json_extract(spark, sf_dir):
    """JSON object inside free text: pages with an object in a script, a fence, or none."""
    html = F.regexp_replace("html", r"[{}]", " ")
    made = F.concat(F.lit('{"url": "'), F.col("url"), F.lit('"}'))
    forms = F.array(
        html, F.concat(html, made, html), F.concat(F.lit("```json\n"), made, F.lit("\n```")), made,
        F.concat(F.lit("["), made, F.lit("]")),
    )
    return (
        table(spark, sf_dir, "pages").select("page_id", "html", "url")
        .select("page_id", F.posexplode(forms).alias("form", "raw"))
        .select("page_id", "form", F.get_json_object(json_object_in(F.col("raw")), "$.url").alias("url"))
    )


QUERIES = {
    "column_scores": column_scores,
    "schema_detect": schema_detect,
    "mapping_validate": mapping_validate,
    "relevant_datasets": relevant_datasets,
    "json_extract": json_extract,
}


def _sql_stats(task: str, column: str, prompt: str, answer: str) -> str:
    return f"""
        SELECT lang, '{task}' AS task_type, '{column}' AS col, count(*) AS n_rows,
          count(*) AS n_text, count(*) FILTER ({sql_vectorish(column)} = FALSE) AS n_plain,
          round(avg({prompt}), 6) AS prompt, round(avg({answer}), 6) AS answer,
          round(avg(length({column})), 6) AS avg_len,
          round(avg(length({column})) FILTER ({sql_vectorish(column)} = FALSE), 6) AS plain_len
        FROM documents GROUP BY lang"""


def _sql_column_scores() -> str:
    parts = []
    for column in ("text", "source"):
        parts.append(_sql_stats("code_generation", column, sql_prompt_score(column), sql_code_score(column)))
        parts.append(_sql_stats("math", column, sql_math_score(column), sql_math_score(column)))
        parts.append(
            _sql_stats("natural_language", column, sql_language_score(column), sql_language_score(column))
        )
    for task in TASK_TYPES:
        parts.append(f"""
            SELECT lang, '{task}', 'n_chars', count(*), 0, 0, NULL, NULL, NULL, NULL
            FROM documents GROUP BY lang""")
    return " UNION ALL ".join(parts)


_SQL_DETECT = f"""
    WITH pairs AS ({SQL_PAIRS}),
    sampled AS (
      SELECT 'code-' || conv_id % 2 AS dataset_id,
        'Write a function for this problem: ' || question AS instruction,
        'the given input' AS input,
        'def f(x):' || chr(10) || '    return x; # {{}}' || chr(10) || answer AS output
      FROM pairs
      QUALIFY row_number() OVER (PARTITION BY conv_id % 2 ORDER BY conv_id, turn) <= 12),
    cells AS (
      UNPIVOT sampled ON instruction, input, output INTO NAME col VALUE v),
    prose AS (
      SELECT 'prose-' || coalesce(lang, '') AS dataset_id, text AS body, source AS origin FROM documents
      QUALIFY row_number() OVER (PARTITION BY lang ORDER BY doc_id) <= 12),
    prose_cells AS (
      UNPIVOT prose ON body, origin INTO NAME col VALUE v),
    scored AS (
      SELECT dataset_id, col, v, {sql_prompt_score('v')} AS prompt, {sql_code_score('v')} AS answer FROM cells
      UNION ALL
      SELECT dataset_id, col, v, {sql_language_score('v')}, {sql_language_score('v')} FROM prose_cells),
    scores AS (
      SELECT dataset_id, col,
        CASE WHEN col IN ('instruction', 'body') THEN 1 WHEN col IN ('input', 'origin') THEN 2 ELSE 3 END AS pos,
        avg(prompt) AS prompt, avg(answer) AS answer,
        count(*) FILTER (NOT {sql_vectorish('v')}) >= greatest(1, count(*) // 2)
          AND avg(length(v)) FILTER (NOT {sql_vectorish('v')}) <= 1200 AS fits
      FROM scored GROUP BY dataset_id, col),
    s1 AS (SELECT dataset_id, arg_max(col, (answer, -pos)) AS a, max(answer) AS a_score FROM scores GROUP BY dataset_id),
    s2 AS (
      SELECT dataset_id, arg_max(col, (prompt, -pos)) AS u, max(prompt) AS u_score
      FROM scores JOIN s1 USING (dataset_id) WHERE col <> a GROUP BY dataset_id),
    s3 AS (
      SELECT dataset_id, arg_max(CASE WHEN prompt >= 0.8 AND fits THEN col ELSE '' END, (prompt, -pos)) AS i
      FROM scores JOIN s1 USING (dataset_id) JOIN s2 USING (dataset_id)
      WHERE col <> a AND col <> u GROUP BY dataset_id),
    chosen AS (
      SELECT *, coalesce(a_score >= 0.8 AND u_score >= 0.8, FALSE) AS fit, dataset_id LIKE 'code%' AS code
      FROM s1 LEFT JOIN s2 USING (dataset_id) LEFT JOIN s3 USING (dataset_id))
    SELECT dataset_id, fit AS is_target_dataset,
      CASE WHEN code THEN 'code_generation' ELSE 'natural_language' END AS task_type,
      CASE WHEN fit THEN 'single_turn' END AS conversation_type, CASE WHEN fit THEN u END AS user_field,
      CASE WHEN fit THEN nullif(i, '') END AS input_field, CASE WHEN fit THEN a END AS assistant_field,
      NULL::VARCHAR AS messages_field,
      CASE WHEN fit AND code THEN 'english' ELSE 'unknown' END AS language, CASE WHEN fit AND code THEN 'Lang' END AS language_field
    FROM chosen
    UNION ALL
    SELECT 'chats', TRUE, 'math', 'multi_turn', NULL, NULL, NULL, 'messages', 'unknown', NULL"""

_SQL_VALIDATE = """
    WITH r AS (
      SELECT 'd' || doc_id AS dataset_id, CASE
        WHEN lang = 'en' THEN 'ok' WHEN lang = 'fr' THEN 'task_mismatch'
        WHEN lang = 'de' AND n_chars % 2 = 0 THEN 'incomplete_single_turn'
        WHEN lang = 'de' THEN 'unknown_field'
        WHEN n_chars % 3 = 0 THEN 'not_target' WHEN n_chars % 3 = 1 THEN 'no_json_object'
        ELSE 'bad_types' END AS reason FROM documents),
    resolved AS (
      SELECT dataset_id,
        CASE WHEN reason IN ('ok', 'not_target') THEN 'accept' ELSE 'heuristic' END AS decision,
        reason, reason = 'ok' AS is_target_dataset,
        CASE WHEN reason = 'ok' THEN 'single_turn' END AS conversation_type,
        CASE WHEN reason = 'ok' THEN 'text' END AS user_field,
        CASE WHEN reason = 'ok' THEN 'source' END AS assistant_field,
        CASE WHEN reason = 'ok' THEN 'english' ELSE 'unknown' END AS language,
        CASE WHEN reason = 'ok' THEN 'lang' ELSE '' END AS metadata
      FROM r)"""

SQL = {
    "column_scores": _sql_column_scores(),
    "schema_detect": _SQL_DETECT,
    "mapping_validate": _SQL_VALIDATE + " SELECT * FROM resolved",
    "relevant_datasets": _SQL_VALIDATE + """
        SELECT reason, count(*) AS datasets, count(*) FILTER (is_target_dataset) AS relevant
        FROM resolved GROUP BY reason""",
    "json_extract": """
        SELECT page_id, f.form::INT AS form, CASE WHEN f.form IN (1, 2, 3) THEN url END AS url
        FROM pages, (SELECT unnest(range(5)) AS form) f""",
}
