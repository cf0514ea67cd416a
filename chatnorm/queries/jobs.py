"""Whole jobs that write files or tables and read them back."""

from __future__ import annotations

from dataclasses import replace

import pyarrow as pa
from pyspark.sql import functions as F

from ..operators.convert import convert_table, export_records
from ..operators.dedup import fingerprint
from ..plans.dedup_file import dedup_file
from ..plans.normalize import RunOptions, run
from ..plans.session import shared_folder, written
from ..sinks.writers import write_records, write_table
from ..sources.catalog import DOMAIN_DDL
from ..sources.fingerprint_index import refresh
from ..sources.outputs import existing_fingerprints
from ..sources.readers import list_data_files, read_csv, read_files, read_json, stream_dataset, stream_files
from ..streaming.domain_stream import dataset_of, start_domain
from ..streaming.stream import drop_known, drop_seen, run_name, start, stream_records
from ..types import JSON_ROW, ORD_FILE, RECORD_COLUMNS, Mapping, local_frame, mappings_frame
from .common import SQL_PAIRS, gathered, table, table_files, turn_pairs, write_json_lines
from .records import _SQL_CONVERSATION, _SQL_TWO_SIDED, _two

# Folder that Spark's writer gives to rows without a value of a partition column.
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
RECORD_DDL = ", ".join(f"{c} STRING" for c in RECORD_COLUMNS)
_DOCS = Mapping(
    "docs",
    "natural_language",
    conversation_type="single_turn",
    user_field="text",
    assistant_field="lang",
    language_field="lang",
    metadata_fields=("source",),
)


def _document_records(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("text", "lang", "source")
    return export_records(convert_table(documents, _DOCS))


def format_round_trip(spark, sf_dir):
    """Records written as CSV and Parquet and read back from both."""
    folder = shared_folder(spark)
    csv_path, parquet_path = f"{folder}/out.csv", f"{folder}/out.parquet"
    write_records(_document_records(spark, sf_dir), "both", csv_path, parquet_path)
    back = {
        "csv": spark.read.options(header=True, multiLine=True, quote='"', escape='"').csv(csv_path),
        "parquet": spark.read.parquet(parquet_path),
    }
    frames = [
        df.select(F.lit(fmt).alias("format"), F.sha1("conversation").alias("digest"), *RECORD_COLUMNS[1:])
        for fmt, df in back.items()
    ]
    return frames[0].unionByName(frames[1])


def output_fingerprints(spark, sf_dir):
    """Fingerprints of earlier output, the union of its CSV and its Parquet form."""
    folder = shared_folder(spark)
    records = _document_records(spark, sf_dir)
    labelled = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left_semi")
    write_records(records.where("language = 'english'"), "csv", f"{folder}/out.csv", f"{folder}/out.parquet")
    # Also what the CSV has, where it is labelled: the two overlap.
    for part in (records.where("language <> 'english'"), export_records(convert_table(labelled, _DOCS))):
        write_records(part, "parquet", f"{folder}/out.csv", f"{folder}/out.parquet")
    return existing_fingerprints(spark, f"{folder}/out.csv", f"{folder}/out.parquet")


def _first_run(records):
    """What the earlier of two runs writes; the later one gets all records."""
    return records.where("language IN ('english', 'german')")


def fingerprint_index(spark, sf_dir):
    """Two runs over one output, as CSV and as Parquet. The second run drops what the index of the first knows,
    writes the rest, and brings the index up to date: each fingerprint with the run that wrote it."""
    folder = shared_folder(spark)
    outputs = {"csv": f"{folder}/out.csv", "parquet": f"{folder}/out.parquet"}
    records = _document_records(spark, sf_dir)
    write_records(_first_run(records), "both", *outputs.values())
    indexes = [refresh(spark, path, fmt) for fmt, path in outputs.items()]
    staged = written(records.withColumn("fp", F.unhex(fingerprint(F.col("conversation"), F.col("reasoning")))))
    new = staged.groupBy("fp").agg(*[F.first(c).alias(c) for c in RECORD_COLUMNS])
    for index in indexes:
        new = index.unseen(new)
    new = written(new)
    write_records(new, "both", *outputs.values())
    wrote = new.select("fp", F.lit(2).alias("run"))
    frames = [
        refresh(spark, path, fmt).rows.select("fp").distinct().withColumn("format", F.lit(fmt)) for fmt, path in outputs.items()
    ]
    known = frames[0].unionByName(frames[1]).join(wrote, "fp", "left")
    return known.select("format", F.lower(F.hex("fp")).alias("fp"), F.coalesce("run", F.lit(1)).alias("run"))


def raw_file_load(spark, sf_dir):
    """One dataset in three file formats and a copy of all rows in a file of another kind, which is refused:
    listed, sorted, read by format, united."""
    folder = shared_folder(spark)
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    row = F.to_json(F.struct("doc_id", "lang", "text"))
    documents.where("lang = 'en'").write.parquet(f"{folder}/data/a")
    write_table(documents.where("lang = 'fr'"), f"{folder}/data/b", "csv")
    # Text files need a known suffix, which the text writer does not give: JSON writer instead.
    write_json_lines(documents.where("lang IS NULL OR lang NOT IN ('en', 'fr')"), f"{folder}/data/c")
    documents.select(row.alias("value")).write.text(f"{folder}/data/ignored")
    paths = [r.path for r in list_data_files(spark, folder).collect()]
    value = F.from_json(JSON_ROW, "doc_id STRING, lang STRING, text STRING")
    return read_files(spark, paths).select(
        value["doc_id"].cast("bigint").alias("doc_id"),
        value["lang"].alias("lang"),
        F.sha1(value["text"]).alias("digest"),
    )


def dedup_file_job(spark, sf_dir):
    """The table tool on a Parquet file: texts that occur once."""
    folder = shared_folder(spark)
    table(spark, sf_dir, "documents").write.parquet(f"{folder}/docs.parquet")
    dedup_file(spark, f"{folder}/docs.parquet", subset=["text"], keep="none")
    return spark.read.parquet(f"{folder}/docs_dedup.parquet").select(
        "doc_id", "lang", "source", "n_chars", F.sha1("text").alias("digest")
    )


def domain_run(spark, sf_dir):
    """The whole run: two domains, JSON Lines, Parquet in two splits, a copy that is all
    duplicates, a dataset that is not relevant, and one that is missing."""
    folder = shared_folder(spark)
    data, out = f"{folder}/data", f"{folder}/out"
    chats = gathered(spark, sf_dir)
    write_json_lines(chats, f"{data}/org/chats/default/train")
    write_json_lines(chats, f"{data}/org/copy/default/train")
    pairs = turn_pairs(spark, sf_dir).select(
        "conv_id",
        F.concat(F.lit("Write a function for this problem: "), F.col("question")).alias("instruction"),
        F.lit("the given input").alias("input"),
        F.concat(F.lit("def f(x):\n    return x; # {}\n"), F.col("answer")).alias("output"),
        F.lit("en-US").alias("Lang"),
    )
    pairs.where("conv_id % 2 = 0").write.parquet(f"{data}/org/pairs/default/train")
    pairs.where("conv_id % 2 = 1").write.parquet(f"{data}/org/pairs/default/test")
    write_table(table(spark, sf_dir, "documents").select("doc_id", "lang"), f"{data}/org/docs", "csv")
    domains = local_frame(
        spark,
        [
            ("Talk", "talk", "natural_language", None, ["org/chats", "org/copy", "org/docs"],
             None, None, None, None, 1),
            ("Code", "code", "code_generation", None,
             ["https://hub.example/datasets/org/pairs", "org/missing"], None, None, None, None, 2),
        ],
        DOMAIN_DDL,
    )
    run(spark, domains, data, out, RunOptions(output_format="parquet", progress_name="check"))
    frames = [
        spark.read.parquet(f"{out}/combined_dataset_{slug}_check.parquet").withColumn("domain", F.lit(name))
        for slug, name in (("talk", "Talk"), ("code", "Code"))
    ]
    return frames[0].unionByName(frames[1])


def stream_dedup(spark, sf_dir):
    """Documents as a file stream, duplicates dropped by state, written by micro-batch; a second
    start with the same checkpoint adds nothing."""
    folder = shared_folder(spark)
    schema = table(spark, sf_dir, "documents").schema
    path, files = table_files(spark, sf_dir, "documents")
    reader = spark.readStream.schema(schema).option("pathGlobFilter", files)
    rows = reader.option("maxFilesPerTrigger", 100).parquet(path)
    for _ in range(2):
        records = drop_seen(stream_records(rows, _DOCS, "nl"))
        start(records, f"{folder}/checkpoint", "parquet", f"{folder}/csv", f"{folder}/out").awaitTermination()
    written = spark.read.schema(
        "conversation STRING, language STRING, reasoning STRING, metadata STRING, dataset_id STRING, batch_id INT"
    ).parquet(f"{folder}/out")
    return written.select("conversation", "language", "dataset_id")


def stream_incremental_dedup(spark, sf_dir):
    """Documents as a file stream over output that a batch run left: neither what that run wrote nor what the
    stream itself wrote is written again, also after a second start."""
    folder = shared_folder(spark)
    out, checkpoint = f"{folder}/out", f"{folder}/checkpoint"
    earlier = _first_run(_document_records(spark, sf_dir)).dropDuplicates(["conversation"])
    write_records(earlier, "parquet", "", f"{out}/batch")
    path, files = table_files(spark, sf_dir, "documents")
    rows = stream_files(spark, path, "parquet", table(spark, sf_dir, "documents").schema, glob=files)
    for _ in range(2):
        index = refresh(spark, out, "parquet")
        records = drop_known(stream_records(rows, _DOCS, "nl"), [index], run_name(checkpoint))
        start(drop_seen(records), checkpoint, "parquet", "", out).awaitTermination()
    frames = [
        spark.read.schema(earlier.schema).option("recursiveFileLookup", True).parquet(path).withColumn("writer", F.lit(writer))
        for writer, path in (("batch", f"{out}/batch"), ("stream", f"{out}/run={run_name(checkpoint)}"))
    ]
    return frames[0].unionByName(frames[1]).select("conversation", "language", "dataset_id", "writer")


def stream_formats(spark, sf_dir):
    """Documents as a dataset of four file formats, among files that are none, read as one file stream."""
    folder = shared_folder(spark)
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    row = F.to_json(F.struct("doc_id", "lang", "text"))
    documents.where("lang = 'en'").write.parquet(f"{folder}/data/a")
    write_table(documents.where("lang = 'fr'"), f"{folder}/data/b", "csv")
    write_json_lines(documents.where("lang = 'de'"), f"{folder}/data/c")
    # One JSON document for each source, a list of objects.
    rest = documents.join(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id")
    rest = rest.where("lang IS NULL OR lang NOT IN ('en', 'fr', 'de')").groupBy("source").agg(F.collect_list(row).alias("rows"))
    listed = F.concat(F.lit("["), F.array_join("rows", ", "), F.lit("]"))
    rest.select("source", listed.alias("value")).repartition("source").write.partitionBy("source").options(
        sep="\x01", quote="", escapeQuotes=False, header=False, extension="json"
    ).csv(f"{folder}/data/d")
    documents.select(row.alias("value")).write.text(f"{folder}/data/ignored")
    value = F.from_json(JSON_ROW, "doc_id STRING, lang STRING, text STRING")
    rows = stream_dataset(spark, f"{folder}/data", max_files=2).select(value.alias("r"))
    query = rows.select(F.col("r.doc_id").cast("bigint").alias("doc_id"), "r.lang", F.sha1("r.text").alias("digest"))
    path = f"{folder}/out"
    query.writeStream.format("parquet").options(path=path, checkpointLocation=f"{folder}/checkpoint").trigger(
        availableNow=True
    ).start().awaitTermination()
    return spark.read.schema("doc_id BIGINT, lang STRING, digest STRING").parquet(path)


def csv_block_load(spark, sf_dir):
    """Documents in CSV files whose values hold line breaks and quotes, each file read by many tasks."""
    folder = shared_folder(spark)
    quoted = F.concat(F.lit('"'), F.col("text"), F.lit('"\r\n,'), F.col("lang"))
    documents = table(spark, sf_dir, "documents").select("doc_id", quoted.alias("text"), "lang")
    write_table(documents, f"{folder}/docs", "csv")  # a file for each task that reads the table
    paths = [r.path for r in list_data_files(spark, folder).collect()]
    block = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 18))  # small files, so small blocks
    try:
        rows = written(read_csv(spark, paths).select("doc_id", "lang", F.sha1("text").alias("digest")))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    return rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), "lang", "digest")


def _write_json_documents(members, path, start, end):
    """Each task writes the ``value`` of its rows as a document of its own: lines behind a beginning and before an end."""

    def framed(batches):
        yield pa.RecordBatch.from_pydict({"value": [start]})
        yield from batches
        yield pa.RecordBatch.from_pydict({"value": [end]})

    members.mapInArrow(framed, "value STRING").write.options(
        sep="\x01", quote="", escapeQuotes=False, header=False, extension="json"
    ).csv(path)


def json_block_load(spark, sf_dir):
    """All documents as JSON documents of two forms, a list and a list wrapped among other members, each cut into its
    objects by many tasks."""
    folder = shared_folder(spark)
    rows = table(spark, sf_dir, "documents").select(
        "lang", F.to_json(F.struct("doc_id", "lang", F.concat(F.lit('}"{['), "text").alias("text"))).alias("row")
    )
    for name, which, start, end in (
        ("list", "lang = 'en'", "[", "]"),
        ("wrapped", "lang IS NULL OR lang <> 'en'", '{"n": [{"doc_id": 0}], "items": [1, ', '], "after": {"x": {"doc_id": 0}}}'),
    ):
        members = rows.where(which).select(F.concat("row", F.lit(",")).alias("value"))
        _write_json_documents(members, f"{folder}/data/{name}", start, "null" + end)
    paths = [r.path for r in list_data_files(spark, folder).collect()]
    block = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 18))  # small files, so small blocks
    try:
        found = written(read_json(spark, paths).select(JSON_ROW, ORD_FILE))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    value = F.from_json(JSON_ROW, "doc_id BIGINT, lang STRING, text STRING")
    form = F.regexp_extract(ORD_FILE, "/data/([a-z]+)/", 1)
    return found.select(value.alias("r"), form.alias("form")).select("form", "r.doc_id", "r.lang", F.sha1("r.text").alias("digest"))


_CHATS = Mapping("org/chats", "natural_language", conversation_type="multi_turn", messages_field="messages")
_PAIRS = Mapping(
    "org/pairs", "natural_language", conversation_type="single_turn", user_field="question", assistant_field="answer"
)


def _domain_stream(spark, folder, mappings, depth, max_files=2, **options):
    """One start of the stream over what lies below ``data``, with the mapping table as it is now."""
    mappings_frame(spark, mappings).write.mode("overwrite").parquet(f"{folder}/mappings")
    rows = stream_dataset(spark, f"{folder}/data", max_files=max_files)
    rows = rows.withColumn("dataset_id", dataset_of(f"{folder}/data", depth))
    start_domain(
        rows,
        lambda s: s.read.parquet(f"{folder}/mappings"),
        f"{folder}/checkpoint",
        "parquet",
        "",
        f"{folder}/out",
        deep=False,
        **options,
    ).awaitTermination()


def _land(spark, rows, path):
    """JSON Lines in at most a file for each core (and at least room for 16): a file is read by many tasks, so batches
    of a larger table get larger files, not more of them, and their fixed cost doesn't grow with it."""
    write_json_lines(rows.coalesce(max(16, spark.sparkContext.defaultParallelism)), path)


def stream_domain(spark, sf_dir):
    """Three datasets in one stream. The second has no mapping yet when its rows come in; the second start has one
    for all, and a third dataset. Duplicates of any batch are dropped."""
    folder = shared_folder(spark)
    documents = table(spark, sf_dir, "documents").select("text", "lang", "source")
    _land(spark, documents, f"{folder}/data/org/docs/default/train")
    _land(spark, gathered(spark, sf_dir), f"{folder}/data/org/chats/default/train")
    docs = replace(_DOCS, dataset_id="org/docs")
    _domain_stream(spark, folder, [docs], 2)
    _land(spark, turn_pairs(spark, sf_dir), f"{folder}/data/org/pairs/default/train")
    _domain_stream(spark, folder, [docs, _CHATS, _PAIRS], 2)
    out = spark.read.schema(local_frame(spark, [], RECORD_DDL).schema).parquet(f"{folder}/out")
    return out.select("conversation", "language", "dataset_id")


def stream_cap(spark, sf_dir):
    """At most 20 records per dataset, one for each source, exactly, over batches and starts: English and German
    documents come with the first start, the others with the second."""
    folder = shared_folder(spark)
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    mappings = [
        replace(_DOCS, dataset_id=r.id, metadata_fields=("doc_id",))
        for r in documents.select(F.concat(F.lit("source="), F.coalesce("source", F.lit(_NULL_FOLDER))).alias("id")).distinct().collect()
    ]
    early = F.coalesce(F.col("lang").isin("en", "de"), F.lit(False))
    for part, rows in enumerate((documents.where(early), documents.where(~early))):
        row = F.to_json(F.struct("doc_id", "text", "lang"))
        ordered = rows.select("source", "doc_id", row.alias("value")).repartition("source").sortWithinPartitions("source", "doc_id")
        ordered.drop("doc_id").write.mode("append").partitionBy("source").options(
            sep="\x01", quote="", escapeQuotes=False, header=False, extension="jsonl"
        ).csv(f"{folder}/data")
        _domain_stream(spark, folder, mappings, 1, max_files=16, cap=20, deduplicate=False)
    out = spark.read.schema(local_frame(spark, [], RECORD_DDL).schema).parquet(f"{folder}/out")
    return out.select(
        F.get_json_object("metadata", "$.doc_id").cast("bigint").alias("doc_id"),
        F.nullif(F.replace("dataset_id", F.lit("source=")), F.lit(_NULL_FOLDER)).alias("source"),
        F.sha1("conversation").alias("digest"),
    )


QUERIES = {
    "json_block_load": json_block_load,
    "csv_block_load": csv_block_load,
    "stream_domain": stream_domain,
    "stream_cap": stream_cap,
    "stream_formats": stream_formats,
    "fingerprint_index": fingerprint_index,
    "stream_incremental_dedup": stream_incremental_dedup,
    "format_round_trip": format_round_trip,
    "output_fingerprints": output_fingerprints,
    "raw_file_load": raw_file_load,
    "dedup_file_job": dedup_file_job,
    "domain_run": domain_run,
    "stream_dedup": stream_dedup,
}

_LANG = "CASE lang WHEN 'en' THEN 'english' WHEN 'fr' THEN 'french' WHEN 'de' THEN 'german' ELSE 'spanish' END"
_SQL_DOCS = f"""
    SELECT doc_id, {_two('text', 'lang')} AS conversation, {_LANG} AS language, NULL::VARCHAR AS reasoning,
      '{{"dataset_id": "docs", "task_type": "natural_language", "language_source": "lang", "source_fields": ["text", null, "lang"], "source": "' || source || '"}}' AS metadata,
      'docs' AS dataset_id FROM documents"""
_FP = "sha1(conversation || chr(10) || '<SEP>' || chr(10))"

_SQL_FIRST = "language IN ('english', 'german')"

SQL = {
    "json_block_load": """
        SELECT CASE WHEN lang = 'en' THEN 'list' ELSE 'wrapped' END AS form, doc_id, lang,
          sha1('}"{[' || text) AS digest FROM documents""",
    "csv_block_load": """
        SELECT doc_id, lang, sha1('"' || text || '"' || chr(13) || chr(10) || ',' || lang) AS digest FROM documents""",
    "stream_domain": f"""
        SELECT DISTINCT conversation, language, 'org/docs' AS dataset_id FROM ({_SQL_DOCS})
        UNION ALL
        SELECT DISTINCT conversation, 'unknown', 'org/chats' FROM (SELECT {_SQL_CONVERSATION} AS conversation {_SQL_TWO_SIDED})
        UNION ALL
        SELECT conversation, 'unknown', 'org/pairs' FROM (
          SELECT DISTINCT {_two('question', 'answer')} AS conversation FROM ({SQL_PAIRS}))
        WHERE conversation NOT IN (SELECT {_SQL_CONVERSATION} {_SQL_TWO_SIDED})""",
    "stream_cap": f"""
        SELECT d.doc_id, d.source, sha1(conversation) AS digest
        FROM ({_SQL_DOCS}) x JOIN documents d USING (doc_id)
        QUALIFY row_number() OVER (
          PARTITION BY d.source ORDER BY CASE WHEN d.lang IN ('en', 'de') THEN 0 ELSE 1 END, d.doc_id) <= 20""",
    "stream_formats": "SELECT doc_id, lang, sha1(text) AS digest FROM documents",
    "fingerprint_index": f"""
        SELECT f.format, {_FP} AS fp, CASE WHEN bool_or({_SQL_FIRST}) THEN 1 ELSE 2 END AS run
        FROM ({_SQL_DOCS}), (SELECT unnest(['csv', 'parquet']) AS format) f GROUP BY ALL""",
    "stream_incremental_dedup": f"""
        SELECT conversation, language, dataset_id, CASE WHEN {_SQL_FIRST} THEN 'batch' ELSE 'stream' END AS writer
        FROM ({_SQL_DOCS}) GROUP BY ALL""",
    "format_round_trip": f"""
        SELECT f.format, sha1(conversation) AS digest, language, reasoning, metadata, dataset_id
        FROM ({_SQL_DOCS}), (SELECT unnest(['csv', 'parquet']) AS format) f""",
    "output_fingerprints": f"""
        SELECT DISTINCT {_FP} AS fp FROM ({_SQL_DOCS})""",
    "raw_file_load": "SELECT doc_id, lang, sha1(text) AS digest FROM documents",
    "dedup_file_job": """
        SELECT doc_id, lang, source, n_chars, sha1(text) AS digest FROM documents
        QUALIFY count(*) OVER (PARTITION BY text) = 1""",
    "domain_run": f"""
        WITH talk AS (
          SELECT {_SQL_CONVERSATION} AS conversation {_SQL_TWO_SIDED}),
        code AS (
          SELECT DISTINCT {_two("'Write a function for this problem: ' || question || chr(10) || chr(10) || 'the given input'", "'def f(x):' || chr(10) || '    return x; # {}' || chr(10) || answer")} AS conversation
          FROM ({SQL_PAIRS}))
        SELECT DISTINCT conversation, 'unknown' AS language, NULL::VARCHAR AS reasoning,
          '{{"dataset_id": "org/chats", "task_type": "natural_language", "language_source": "schema.language", "source_fields": ["messages"]}}' AS metadata,
          'org/chats' AS dataset_id, 'Talk' AS domain FROM talk
        UNION ALL
        SELECT conversation, 'english', NULL,
          '{{"dataset_id": "org/pairs", "task_type": "code_generation", "language_source": "Lang", "source_fields": ["instruction", "input", "output"]}}',
          'org/pairs', 'Code' FROM code""",
    "stream_dedup": f"SELECT DISTINCT conversation, language, dataset_id FROM ({_SQL_DOCS})",
}
