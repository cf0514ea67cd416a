"""Dataset lists, file contents and run tracking, over tables turned into such inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import tracking
from ..sources.catalog import links_to_ids, missing_domains, parse_domains
from ..sources.readers import json_documents, json_lines, unite
from ..types import JSON_ROW
from .common import table


def dataset_catalog(spark, sf_dir):
    """Distinct dataset ids per domain from page links, in order of first appearance."""
    links = table(spark, sf_dir, "pages").select(
        F.regexp_extract("url", "^(https?)", 1).alias("domain"), "url", "page_id"
    )
    return links_to_ids(links, "url", "page_id", ["domain"]).select(
        "domain", "dataset_id", F.col("page_id").alias("pos")
    )


def domain_config(spark, sf_dir):
    """One configuration text per document, with good and bad domain entries."""
    text = F.concat(
        F.lit('{"domains": [{"name": " My '), F.col("lang"),
        F.lit(' ", "task_type": "MATH", "dataset_ids": [" a/b", "", "c", "a/b"], "max_rows_per_dataset": " '),
        F.col("n_chars").cast("string"),
        F.lit('"}, {"name": "'), F.col("source"),
        F.lit('", "task_type": "code_generation", "csv_path": "x.csv", "max_rows_per_dataset": ""}, '
              '{"task_type": "math", "dataset_ids": []}, {"name": "n", "task_type": "poetry"}, '
              '{"name": "n", "task_type": "math"}, {"name": "n", "task_type": "math", "dataset_ids": "a"}, 7]}'),
    )
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    configs = documents.select("doc_id", text.alias("value"))
    return parse_domains(configs, keys=["doc_id"]).select(
        "doc_id",
        "entry",
        "domain",
        "slug",
        "task_type",
        F.array_join("dataset_ids", "|").alias("ids"),
        "csv_path",
        "max_rows_per_dataset",
        F.col("error").isNotNull().alias("bad"),
    )


def domain_missing(spark, sf_dir):
    """Requested names that no domain has, sorted."""
    domains = table(spark, sf_dir, "documents").select(F.upper("lang").alias("domain")).distinct()
    wanted = table(spark, sf_dir, "events").select(F.col("event_type").alias("name")).union(
        table(spark, sf_dir, "documents").select("lang")
    )
    return missing_domains(domains, wanted.distinct())


def split_union(spark, sf_dir):
    """The languages of the documents as splits with different columns, read as one dataset. Documents in any
    other language or without one are in the last split."""
    documents = table(spark, sf_dir, "documents").withColumn("n_chars", F.col("n_chars"))

    def split(pos, which, *columns):
        return documents.where(which).select(*columns, F.lit(pos).alias("split_pos"), F.col("lang").alias("split"))

    united = unite(
        [
            split(0, "lang = 'en'", "doc_id", "source", "n_chars"),
            split(1, "lang = 'fr'", "doc_id", "source"),
            split(2, "lang = 'de'", "doc_id", "n_chars"),
            split(3, "lang IS NULL OR lang NOT IN ('en', 'fr', 'de')", "doc_id"),
        ]
    )
    return united.select("doc_id", "source", "n_chars", "split_pos", "split")


def jsonl_load(spark, sf_dir):
    """Documents as JSON Lines among blank, broken, list and number lines."""
    row = F.to_json(F.struct("doc_id", "text", "lang"))
    lines = F.array(
        F.concat(F.lit("  "), row, F.lit("\r")),
        F.lit(""),
        F.concat(row, F.lit("]")),
        F.concat(F.lit("["), row, F.lit("]")),
        F.col("n_chars").cast("string"),
        F.lit('{"doc_id": '),
    )
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "n_chars")
    text = documents.select(F.explode(lines).alias("value"))
    rows = json_lines(text).select(F.from_json(JSON_ROW, "doc_id BIGINT, text STRING, lang STRING").alias("r"))
    return rows.select("r.doc_id", "r.lang", F.sha1("r.text").alias("digest"))


def json_document_load(spark, sf_dir):
    """One JSON document per document row in every accepted and refused form."""
    row = F.to_json(F.struct("doc_id", "lang"))
    wrapped = [F.concat(F.lit(f'{{"n": 1, "{key}": ['), row, F.lit(', 5, "x"]}')) for key in
               ("data", "rows", "items", "examples", "records")]
    forms = F.array(
        F.concat(F.lit("["), row, F.lit(", [1], "), row, F.lit("]")),
        *wrapped,
        row,
        F.concat(row, F.lit("}")),
        F.lit('"text"'),
        F.concat(F.lit('{"data": 3, "doc_id": '), F.col("doc_id").cast("string"), F.lit("}")),
    )
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang").select(F.posexplode(forms).alias("form", "value"))
    rows = json_documents(docs, keep=["form"])
    value = F.from_json(JSON_ROW, "doc_id BIGINT, lang STRING")
    return rows.select("form", F.col("__item").alias("item"), value.alias("r")).select(
        "form", "item", "r.doc_id", "r.lang"
    )


# Events read as run-log entries: the user is a dataset, the event type a status.
_STATUS = {"purchase": "added", "click": "skipped", "view": "started", "signup": "failed", "error": "deferred"}


def _log(spark, sf_dir):
    status = F.create_map(*[F.lit(v) for pair in _STATUS.items() for v in pair])[F.col("event_type")]
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("dom"), (F.col("event_id") % 3).cast("string")).alias("domain"),
        F.concat(F.lit("ds"), F.col("user_id").cast("string")).alias("dataset_id"),
        status.alias("status"),
        F.floor("value").cast("long").alias("records_written"),
        "event_id",
        "ts",
    )


def latest_status(spark, sf_dir):
    return tracking.latest_per_key(
        _log(spark, sf_dir), ["domain", "dataset_id"], "status", ["ts", "event_id"]
    )


def skip_done(spark, sf_dir):
    """Datasets left after the registry check and, in a resumed run, after the done ids of the run log (entries
    of all domains, those of few records taken as not done) and of a checkpoint (ids with a very large entry)."""
    log = _log(spark, sf_dir)
    catalog = log.select("domain", "dataset_id").distinct()
    registry = tracking.latest_per_key(log, ["domain", "dataset_id"], "status", ["ts", "event_id"])
    left = tracking.without_registered(catalog, registry)
    unfinished = (F.col("records_written") <= 200) & F.col("status").isin("added", "skipped")
    status = F.when(unfinished, "started").otherwise(F.upper("status"))
    quick = tracking.done_in_log(log.withColumn("status", status))
    listed = log.where("records_written > 300")
    return tracking.without_done(left, tracking.done_ids(quick, listed.select("dataset_id")))


def skip_report(spark, sf_dir):
    """The other side of the registry check: what is reported as duplicate input."""
    log = _log(spark, sf_dir)
    registry = tracking.latest_per_key(log, ["domain", "dataset_id"], "status", ["ts", "event_id"])
    return tracking.registered(log.select("domain", "dataset_id").distinct(), registry)


def run_summary(spark, sf_dir):
    """Outcome counts per domain and in total."""
    outcomes = _log(spark, sf_dir).withColumn(
        "duplicates_filtered", F.when(F.col("status") == "added", F.col("event_id") % 7)
    )
    return tracking.status_counts(outcomes).withColumn(
        "domain", F.coalesce("domain", F.lit("(all)"))
    )


def log_export(spark, sf_dir):
    """The nine text columns of the run log; nulls become empty text."""
    log = _log(spark, sf_dir).select(
        "domain",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp_utc"),
        "dataset_id",
        "status",
        F.lit(None).cast("string").alias("config_name"),
        F.when(F.col("status") == "added", F.lit("train,test")).alias("split_name"),
        F.when(F.col("status") == "added", F.col("records_written")).alias("records_written"),
        F.col("event_id").cast("string").alias("message"),
        F.when(F.col("status") == "failed", F.lit("boom")).alias("error"),
    )
    return tracking.export_log(log)


def registry_import(spark, sf_dir):
    """Registries kept as JSON objects, one per event, with a broken and a non-object text."""
    text = F.when(
        F.col("event_type") == "view", F.lit('{"ds1": ')
    ).when(
        F.col("event_type") == "error", F.lit('["ds1"]')
    ).otherwise(
        F.concat(
            F.lit('{"ds'), F.col("event_id").cast("string"), F.lit('": {"math": "added", "nl": "'),
            F.col("event_type"), F.lit('"}}'),
        )
    )
    texts = table(spark, sf_dir, "events").select("event_id", "event_type").select(text.alias("value"))
    return tracking.registry_entries(texts, "value")


QUERIES = {
    "dataset_catalog": dataset_catalog,
    "domain_config": domain_config,
    "domain_missing": domain_missing,
    "split_union": split_union,
    "jsonl_load": jsonl_load,
    "json_document_load": json_document_load,
    "latest_status": latest_status,
    "skip_done": skip_done,
    "skip_report": skip_report,
    "run_summary": run_summary,
    "log_export": log_export,
    "registry_import": registry_import,
}

_SQL_STATUS = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _STATUS.items())
_SQL_LOG = f"""log AS (
    SELECT 'dom' || event_id % 3 AS domain, 'ds' || user_id AS dataset_id,
      CASE event_type {_SQL_STATUS} END AS status, floor(value)::BIGINT AS records_written,
      event_id, ts FROM events),
    latest AS (
      SELECT domain, dataset_id, arg_max(status, (ts, event_id)) AS status FROM log GROUP BY ALL)"""
_PATH = "regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1)"

SQL = {
    "dataset_catalog": f"""
        WITH parts AS (
          SELECT regexp_extract(url, '^(https?)', 1) AS domain, page_id,
            list_filter(string_split({_PATH}, '/'), lambda x: x <> '') AS p FROM pages),
        ids AS (
          SELECT domain, page_id, CASE
            WHEN len(p) >= 3 AND p[1] = 'datasets' THEN p[2] || '/' || p[3]
            WHEN len(p) >= 2 THEN p[1] || '/' || p[2] ELSE coalesce(p[1], '') END AS dataset_id FROM parts)
        SELECT domain, dataset_id, min(page_id) AS pos FROM ids WHERE dataset_id <> '' GROUP BY ALL""",
    "domain_config": """
        SELECT doc_id, e.entry::INT AS entry,
          CASE e.entry WHEN 1 THEN 'My ' || lang WHEN 2 THEN source WHEN 3 THEN '' WHEN 7 THEN '' ELSE 'n' END AS domain,
          CASE e.entry WHEN 1 THEN 'my_' || lang WHEN 2 THEN source WHEN 3 THEN '' WHEN 7 THEN '' ELSE 'n' END AS slug,
          CASE e.entry WHEN 2 THEN 'code_generation' WHEN 4 THEN 'poetry' WHEN 7 THEN '' ELSE 'math' END AS task_type,
          CASE e.entry WHEN 1 THEN 'a/b|c' WHEN 3 THEN '' END AS ids,
          CASE WHEN e.entry = 2 THEN 'x.csv' END AS csv_path,
          CASE WHEN e.entry = 1 THEN n_chars::INT END AS max_rows_per_dataset,
          e.entry > 2 AS bad
        FROM documents, (SELECT unnest(range(1, 8)) AS entry) e""",
    "domain_missing": "SELECT DISTINCT event_type AS name FROM events",
    "split_union": """
        SELECT doc_id, CASE WHEN lang IN ('en', 'fr') THEN source END AS source,
          CASE WHEN lang IN ('en', 'de') THEN n_chars END AS n_chars,
          CASE lang WHEN 'en' THEN 0 WHEN 'fr' THEN 1 WHEN 'de' THEN 2 ELSE 3 END AS split_pos,
          lang AS split FROM documents""",
    "jsonl_load": "SELECT doc_id, lang, sha1(text) AS digest FROM documents",
    "json_document_load": """
        SELECT f.form::INT AS form, f.item::INT AS item, doc_id,
          CASE WHEN f.form <> 9 THEN lang END AS lang
        FROM documents, (
          SELECT unnest([0, 0, 1, 2, 3, 4, 5, 6, 9]) AS form, unnest([0, 2, 0, 0, 0, 0, 0, 0, 0]) AS item) f""",
    "latest_status": f"WITH {_SQL_LOG} SELECT * FROM latest",
    "skip_done": f"""
        WITH {_SQL_LOG}
        SELECT DISTINCT domain, dataset_id FROM log c
        WHERE NOT EXISTS (
            SELECT 1 FROM latest r WHERE r.domain = c.domain AND r.dataset_id = c.dataset_id
              AND r.status IN ('added', 'skipped', 'resumed_skip', 'duplicate_input'))
          AND NOT EXISTS (
            SELECT 1 FROM log d WHERE d.dataset_id = c.dataset_id
              AND (d.records_written > 300 OR (d.records_written > 200 AND d.status IN ('added', 'skipped'))))""",
    "skip_report": f"""
        WITH {_SQL_LOG} SELECT domain, dataset_id FROM latest WHERE status IN ('added', 'skipped')""",
    "run_summary": f"""
        WITH {_SQL_LOG}
        SELECT coalesce(domain, '(all)') AS domain, count(*) AS datasets_total,
          count(*) FILTER (status <> 'started') AS datasets_started,
          count(*) FILTER (status = 'added') AS datasets_added,
          count(*) FILTER (status = 'skipped') AS datasets_skipped,
          count(*) FILTER (status = 'deferred') AS datasets_deferred,
          count(*) FILTER (status = 'failed') AS datasets_failed,
          0::BIGINT AS duplicate_datasets_skipped,
          sum(records_written)::BIGINT AS records_written,
          coalesce(sum(event_id % 7) FILTER (status = 'added'), 0)::BIGINT AS record_duplicates_filtered
        FROM log GROUP BY ROLLUP (domain)""",
    "log_export": f"""
        WITH {_SQL_LOG}
        SELECT domain, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp_utc, dataset_id, status,
          '' AS config_name, CASE WHEN status = 'added' THEN 'train,test' ELSE '' END AS split_name,
          CASE WHEN status = 'added' THEN records_written::VARCHAR ELSE '' END AS records_written,
          event_id::VARCHAR AS message, CASE WHEN status = 'failed' THEN 'boom' ELSE '' END AS error
        FROM log""",
    "registry_import": """
        SELECT s.domain, 'ds' || event_id AS dataset_id,
          CASE WHEN s.domain = 'math' THEN 'added' ELSE event_type END AS status
        FROM events, (SELECT unnest(['math', 'nl']) AS domain) s
        WHERE event_type NOT IN ('view', 'error')""",
}
