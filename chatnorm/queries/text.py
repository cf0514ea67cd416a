"""Column functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import errors, language, links, messages, paths, scoring
from ..functions import text as X
from ..operators.convert import is_noisy_auxiliary
from ..sources.readers import is_data_file
from .common import (
    sql_code_score,
    sql_language_score,
    sql_math_score,
    sql_prompt_score,
    sql_vectorish,
    table,
)


def _all_texts(spark, sf_dir):
    """Every text of the tables with prose, markup and JSON."""
    documents = table(spark, sf_dir, "documents").select(F.lit("documents").alias("origin"), F.col("doc_id").alias("id"), "text")
    pages = table(spark, sf_dir, "pages").select(F.lit("pages").alias("origin"), F.col("page_id").alias("id"), F.col("html").alias("text"))
    events = table(spark, sf_dir, "events").select(
        F.lit("events").alias("origin"), F.col("event_id").alias("id"), F.col("props").alias("text")
    )
    return documents.unionByName(pages).unionByName(events)


_SQL_TEXTS = """(
    SELECT 'documents' AS origin, doc_id AS id, text FROM documents
    UNION ALL SELECT 'pages', page_id, html FROM pages
    UNION ALL SELECT 'events', event_id, props FROM events)"""


def _score(fn):
    return lambda spark, sf_dir: _all_texts(spark, sf_dir).select(
        "origin", "id", F.round(fn("text"), 6).alias("score")
    )


def _score_sql(expr: str) -> str:
    return f"SELECT origin, id, round({expr}, 6) AS score FROM {_SQL_TEXTS}"


def vectorish_text(spark, sf_dir):
    return _all_texts(spark, sf_dir).select(
        "origin", "id", scoring.is_vectorish("text").alias("vectorish")
    )


def digit_share(spark, sf_dir):
    return _all_texts(spark, sf_dir).select(
        "origin",
        "id",
        F.round(scoring.digit_ratio("text"), 6).alias("digit_ratio"),
        F.expr(scoring.occurrences("text", ",")).cast("long").alias("commas"),
        F.expr(scoring.occurrences("text", " ")).cast("long").alias("blanks"),
    )


def noisy_aux_filter(spark, sf_dir):
    return _all_texts(spark, sf_dir).select(
        "origin", "id", is_noisy_auxiliary(F.col("text")).alias("noisy")
    )


def language_normalize(spark, sf_dir):
    spellings = F.array(
        F.col("lang"),
        F.concat(F.upper("lang"), F.lit("_XX")),
        F.concat(F.lit("  "), F.col("lang"), F.lit("-latn-1 ")),
        F.col("source"),
        F.col("n_chars").cast("string"),
        F.lit(None).cast("string"),
        F.concat(F.lit("x "), F.col("lang")),
    )
    return (
        table(spark, sf_dir, "documents")
        .select("doc_id", F.posexplode(spellings).alias("spelling", "raw"))
        .select("doc_id", "spelling", language.normalize_language(F.col("raw")).alias("language"))
    )


_LANG = "CASE lang WHEN 'en' THEN 'english' WHEN 'fr' THEN 'french' WHEN 'de' THEN 'german' ELSE 'spanish' END"


def link_normalize(spark, sf_dir):
    url = F.col("url")
    forms = F.array(
        url,
        F.regexp_replace(url, r"^(https?://[^/]+)/", "$1/datasets/"),
        F.concat(F.lit(" /"), F.regexp_replace(url, r"^https?://[^/]+", ""), F.lit("/ ")),
        F.lit("  "),
    )
    return (
        table(spark, sf_dir, "pages")
        .select("page_id", F.posexplode(forms).alias("form", "link"))
        .select("page_id", "form", links.normalize_link(F.col("link")).alias("dataset_id"))
        .where("dataset_id <> ''")
    )


def role_alias(spark, sf_dir):
    spellings = {"user": ["user", "Human", "PROMPT"], "assistant": ["assistant", "GPT", "Model", "bot"]}
    raw = F.coalesce(
        *[
            F.when(
                F.col("role") == role,
                F.get(F.array(*map(F.lit, names)), (F.col("turn") % len(names)).cast("int")),
            )
            for role, names in spellings.items()
        ],
        F.upper("role"),
    )
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", raw.alias("raw_role"), messages.role_alias(raw).alias("alias")
    )


def json_path_get(spark, sf_dir):
    payload = F.concat(
        F.lit('{"a":[{"p":'), F.col("props"), F.lit('}],"x.y":2,"t":"'), F.col("event_type"), F.lit('"}')
    )
    rows = table(spark, sf_dir, "events").withColumn("payload", payload)
    return rows.select(
        "event_id",
        paths.json_get(F.col("payload"), "a.0.p.k").alias("nested"),
        paths.json_get(F.col("payload"), "a.1.p.k").alias("beyond"),
        paths.json_get(F.col("payload"), "x.y").alias("dotted_name"),
        paths.json_get(F.col("payload"), "t").alias("top"),
        paths.json_get(F.col("payload"), "").alias("no_path"),
    )


def json_text_parse(spark, sf_dir):
    """Texts that hold a JSON object or list, and those that only look like one."""
    forms = F.array(
        F.col("props"),
        F.concat(F.lit(" \n["), F.col("props"), F.lit(",1]\t")),
        F.concat(F.col("props"), F.lit(" x")),
        F.concat(F.lit("{"), F.col("event_type"), F.lit("}")),
        F.col("event_type"),
    )
    return (
        table(spark, sf_dir, "events").select("event_id", "props", "event_type")
        .select("event_id", F.posexplode(forms).alias("form", "raw"))
        .select("event_id", "form", X.is_json_collection(F.col("raw")).alias("is_json"))
    )


def value_to_text(spark, sf_dir):
    """Typed values as text: doubles of very different size, booleans, integers, padded text."""
    price = F.col("l_extendedprice")
    doubles = {"small": price / F.lit(1e9), "plain": price, "large": price * F.lit(1e9), "huge": price * F.lit(1e15)}
    flag = F.col("l_returnflag") == "R"
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag",
        "l_partkey", "l_linestatus")
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        *[X.to_text(c, T.DoubleType()).alias(name) for name, c in doubles.items()],
        X.to_text(flag, T.BooleanType()).alias("flag"),
        X.to_text(F.col("l_partkey"), T.LongType()).alias("whole"),
        X.to_text(F.concat(F.lit("\t "), F.col("l_linestatus"), F.lit(" \n"))).alias("padded"),
    )


def error_triage(spark, sf_dir):
    message = (
        F.when(F.col("event_type") == "error",
               F.concat(F.lit("429 Too Many Requests. Retry-After: "), F.col("value").cast("string")))
        .when(F.col("event_type") == "view",
              F.concat(F.lit("busy, please try again in "), F.col("value").cast("string"), F.lit(" secs")))
        .when(F.col("event_type") == "click", F.lit("Feature type 'Json' not found. Available feature types: []"))
        .when(F.col("event_type") == "signup", F.lit("Please pass a HF_TOKEN or log in"))
        .otherwise(F.lit("JSON parse error: column changed"))
    )
    odd = F.col("user_id") % 2 == 1
    raw_error = F.when(odd, F.lit("no files"))
    no_error = F.col("value") > 50
    error = F.when(~no_error, F.col("message"))
    return (
        table(spark, sf_dir, "events")
        .withColumn("message", message)
        .select(
            "event_id",
            errors.error_class(F.col("message")).alias("error_class"),
            errors.retry_after_seconds(F.col("message")).alias("retry_after"),
            errors.outcome_status(error, raw_error, odd).alias("status"),
            errors.deferred_reason(error, raw_error).alias("reason"),
        )
    )


def data_file_select(spark, sf_dir):
    """Which paths of a listing are data files."""
    endings = [".jsonl", ".JSON", ".csv", ".Parquet", ".md", "/.hidden.json", "/dataset_infos.json", "/state.json"]
    path = F.concat(
        F.lit("data/"),
        F.regexp_replace(F.col("url"), r"^https?://([^/?#]+).*$", "$1/"),
        F.col("page_id").cast("string"),
    )
    return (
        table(spark, sf_dir, "pages")
        .select(F.explode(F.transform(F.array(*map(F.lit, endings)), lambda e: F.concat(path, e))).alias("path"))
        .where(is_data_file(F.col("path")))
    )


def utc_stamp(spark, sf_dir):
    """Log timestamps as ISO text, and domain slugs."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("stamp"),
        X.domain_slug(F.concat(F.lit(" Domain "), F.upper("event_type"), F.lit(" X "))).alias("slug"),
    )


QUERIES = {
    "score_code": _score(scoring.code_score),
    "score_prompt": _score(scoring.prompt_score),
    "score_math": _score(scoring.math_score),
    "score_nl": _score(scoring.natural_language_score),
    "vectorish_text": vectorish_text,
    "digit_share": digit_share,
    "noisy_aux_filter": noisy_aux_filter,
    "language_normalize": language_normalize,
    "link_normalize": link_normalize,
    "role_alias": role_alias,
    "json_path_get": json_path_get,
    "json_text_parse": json_text_parse,
    "value_to_text": value_to_text,
    "error_triage": error_triage,
    "data_file_select": data_file_select,
    "utc_stamp": utc_stamp,
}

_PATH = r"regexp_extract(link, '^https?://[^/?#]*([^?#]*)', 1)"

SQL = {
    "score_code": _score_sql(sql_code_score("text")),
    "score_prompt": _score_sql(sql_prompt_score("text")),
    "score_math": _score_sql(sql_math_score("text")),
    "score_nl": _score_sql(sql_language_score("text")),
    "vectorish_text": f"SELECT origin, id, {sql_vectorish('text')} AS vectorish FROM {_SQL_TEXTS}",
    "digit_share": f"""
        SELECT origin, id,
          round(length(regexp_replace(text, '[^0-9]', '', 'g')) / greatest(1, length(text)), 6) AS digit_ratio,
          length(text) - length(replace(text, ',', '')) AS commas,
          length(text) - length(replace(text, ' ', '')) AS blanks
        FROM {_SQL_TEXTS}""",
    "noisy_aux_filter": f"""
        SELECT origin, id, length(text) > 1200
          OR (text LIKE '[%' AND text LIKE '%]') OR (text LIKE '{{%' AND text LIKE '%}}') AS noisy
        FROM {_SQL_TEXTS}""",
    "language_normalize": f"""
        SELECT doc_id, s.spelling::INT AS spelling,
          CASE WHEN s.spelling IN (0, 1, 2) THEN {_LANG}
               WHEN s.spelling = 3 THEN 'src'
               WHEN s.spelling IN (4, 5) THEN 'unknown'
               ELSE 'x_' || lang END AS language
        FROM documents, (SELECT unnest(range(7)) AS spelling) s""",
    "link_normalize": f"""
        WITH forms AS (
          SELECT page_id, 0 AS form, url AS link FROM pages
          UNION ALL SELECT page_id, 1, regexp_replace(url, '^(https?://[^/]+)/', '\\1/datasets/') FROM pages
          UNION ALL SELECT page_id, 2, regexp_replace(url, '^https?://[^/]+', '') FROM pages),
        parts AS (
          SELECT *, list_filter(string_split({_PATH}, '/'), lambda x: x <> '') AS p FROM forms),
        ids AS (
          SELECT page_id, form::INT AS form, CASE
            WHEN form = 2 THEN trim(link, '/')
            WHEN len(p) >= 3 AND p[1] = 'datasets' THEN p[2] || '/' || p[3]
            WHEN len(p) >= 2 THEN p[1] || '/' || p[2]
            ELSE trim({_PATH}, '/') END AS dataset_id
          FROM parts)
        SELECT * FROM ids WHERE dataset_id <> ''""",
    "role_alias": """
        SELECT conv_id, turn,
          CASE role WHEN 'user' THEN (['user', 'Human', 'PROMPT'])[turn % 3 + 1]
                    WHEN 'assistant' THEN (['assistant', 'GPT', 'Model', 'bot'])[turn % 4 + 1]
                    ELSE upper(role) END AS raw_role,
          role AS alias
        FROM conversations""",
    "json_path_get": """
        SELECT event_id, json_extract_string(props, '$.k') AS nested, NULL::VARCHAR AS beyond,
          NULL::VARCHAR AS dotted_name, event_type AS top, NULL::VARCHAR AS no_path
        FROM events""",
    "json_text_parse": """
        SELECT event_id, f.form::INT AS form, f.form IN (0, 1) AS is_json
        FROM events, (SELECT unnest(range(5)) AS form) f""",
    "value_to_text": """
        SELECT l_orderkey, l_linenumber,
          CAST(l_extendedprice / 1e9::DOUBLE AS VARCHAR) AS small,
          CAST(l_extendedprice AS VARCHAR) AS plain,
          CAST(l_extendedprice * 1e9::DOUBLE AS VARCHAR) AS large,
          CAST(l_extendedprice * 1e15::DOUBLE AS VARCHAR) AS huge,
          CASE WHEN l_returnflag = 'R' THEN 'True' ELSE 'False' END AS flag,
          CAST(l_partkey AS VARCHAR) AS whole, l_linestatus AS padded
        FROM lineitem""",
    "error_triage": """
        WITH m AS (
          SELECT *, CASE event_type
            WHEN 'error' THEN 'rate_limited' WHEN 'click' THEN 'unsupported_schema'
            WHEN 'signup' THEN 'auth_required' ELSE 'other' END AS error_class,
            user_id % 2 = 1 AS odd, value > 50 AS fine,
            event_type IN ('click', 'purchase') AS needs_raw FROM events)
        SELECT event_id, error_class,
          CASE WHEN event_type IN ('error', 'view') THEN value END AS retry_after,
          CASE WHEN NOT fine AND event_type = 'signup' THEN 'deferred'
               WHEN NOT fine AND needs_raw AND odd THEN 'deferred'
               WHEN NOT fine AND NOT needs_raw THEN 'failed'
               WHEN odd THEN 'added' ELSE 'skipped' END AS status,
          CASE WHEN fine THEN NULL WHEN event_type = 'signup' THEN 'hf_auth_required'
               WHEN needs_raw AND odd THEN 'raw_fallback_failed' END AS reason
        FROM m""",
    "data_file_select": """
        SELECT 'data/' || regexp_replace(url, '^https?://([^/?#]+).*$', '\\1/') || page_id || e.ending AS path
        FROM pages, (SELECT unnest(['.jsonl', '.JSON', '.csv', '.Parquet']) AS ending) e""",
    "utc_stamp": """
        SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS stamp,
          'domain_' || event_type || '_x' AS slug
        FROM events""",
}
