"""Conversion of rows to conversation records."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import messages as msg
from ..operators.convert import convert_json, convert_table, export_records
from ..types import JSON_ROW, Mapping, mappings_frame
from .common import SQL_PAIRS, gathered, sql_json, table, turn_pairs

# A conversation as its exported JSON text, from ordered turns.
_SQL_CONVERSATION = f"""'[' || string_agg('{{"role": "' || role || '", "content": ' || {sql_json('text')} || '}}', ', ' ORDER BY turn) || ']'"""
_SQL_TWO_SIDED = """
    FROM conversations WHERE role IN ('user', 'assistant') GROUP BY conv_id
    HAVING count(*) >= 2 AND count(*) FILTER (role = 'user') > 0 AND count(*) FILTER (role = 'assistant') > 0"""


def multi_turn_convert(spark, sf_dir):
    mapping = Mapping(
        "chats", "natural_language", conversation_type="multi_turn", messages_field="messages"
    )
    records = convert_table(gathered(spark, sf_dir), mapping, keep=["conv_id"])
    return export_records(records, keep=["conv_id"])


def single_turn_convert(spark, sf_dir):
    """Prompt, auxiliary text and answer from three columns. Documents serve as auxiliary text of the turns of
    the conversation with their id, and each of them as that of a row of its own."""
    documents = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("conv_id"), F.col("text").alias("input"), "lang", "source"
    )
    turns = turn_pairs(spark, sf_dir)
    own = documents.withColumns({"turn": F.lit(-1), "question": F.col("source"), "answer": F.upper("lang")})
    rows = turns.join(documents, "conv_id", "left").unionByName(own)
    mapping = Mapping(
        "pairs",
        "math",
        conversation_type="single_turn",
        user_field="question",
        input_field="input",
        assistant_field="answer",
        reasoning_field="source",
        language_field="lang",
        metadata_fields=("turn",),
    )
    return export_records(convert_table(rows, mapping, keep=["conv_id", "turn"]), keep=["conv_id", "turn"])


def metadata_build(spark, sf_dir):
    """Metadata values of every kind: short and long text, numbers, booleans, lists, nulls."""
    labels = table(spark, sf_dir, "labels")
    rows = (
        table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
        .join(labels, "doc_id", "left")
        .select(
            "doc_id", "text", "lang", "source", "n_chars", "quality",
            (F.col("toxic") == 1).alias("toxic"),
            (F.col("n_chars") / F.lit(8.0)).alias("eighth"),
            F.array("lang").alias("langs"),
            F.concat(F.lit('["'), F.col("lang"), F.lit('"]')).alias("listed"),
            F.concat(F.lit(" [broken "), F.col("source")).alias("broken"),
        )
    )
    mapping = Mapping(
        "docs",
        "code_generation",
        conversation_type="single_turn",
        user_field="lang",
        assistant_field="source",
        metadata_fields=(
            "text", "lang", "n_chars", "quality", "toxic", "eighth", "langs", "listed", "broken",
            "dataset_id", "no_such_field",
        ),
    )
    return convert_table(rows, mapping, keep=["doc_id"]).select("doc_id", "metadata", "dataset_id")


def record_fingerprint(spark, sf_dir):
    from ..operators.dedup import record_fingerprint as fingerprint

    rows = gathered(spark, sf_dir)
    messages = msg.normalize_typed(F.col("messages"), rows.schema["messages"].dataType)
    return rows.select("conv_id", messages.alias("conversation")).select(
        "conv_id", fingerprint(F.col("conversation"), F.lit(None).cast("string")).alias("fp")
    )


def _json_chats(spark, sf_dir):
    """Conversations as JSON payloads of three shapes: a list, an object with a known key, and a
    list written as text deep inside an object."""
    items = F.to_json(
        F.transform(
            "messages",
            lambda m: F.struct(F.upper(m["role"]).alias("from"), m["content"].alias("value")),
        )
    )
    quoted = F.to_json(F.struct(items.alias("s")))
    text_literal = quoted.substr(F.lit(6), F.length(quoted) - 6)
    shape = F.col("conv_id") % 3
    payload = (
        F.when(shape == 0, items)
        .when(shape == 1, F.concat(F.lit('{"id":1,"meta":{"a":[1]},"dialog":'), items, F.lit("}")))
        .otherwise(F.concat(F.lit('{"data":{"part":{"n":1,"turns":'), text_literal, F.lit("}}}")))
    )
    return gathered(spark, sf_dir).select("conv_id", payload.alias("payload"))


def nested_payload_convert(spark, sf_dir):
    rows = _json_chats(spark, sf_dir)
    mapping = Mapping(
        "payloads", "natural_language", conversation_type="multi_turn", messages_field="payload"
    )
    return export_records(convert_table(rows, mapping, keep=["conv_id"]), keep=["conv_id"]).select(
        "conv_id", "conversation"
    )


def message_path_profile(spark, sf_dir):
    """Where the message lists sit inside the payloads."""
    rows = _json_chats(spark, sf_dir).select(
        (F.col("conv_id") % 3).alias("shape"), msg.message_path(F.col("payload")).alias("path")
    )
    return rows.groupBy("shape", "path").agg(F.count(F.lit(1)).alias("n"))


def message_detect(spark, sf_dir):
    """Which values look like a message list."""
    rows = _json_chats(spark, sf_dir)
    return rows.select("conv_id", msg.looks_like_messages_json(F.col("payload")).alias("message_like"))


def message_paths_given(spark, sf_dir):
    """Message lists with their own field names and roles."""
    rows = gathered(spark, sf_dir).select(
        "conv_id",
        F.to_json(
            F.transform(
                "messages",
                lambda m: F.struct(
                    F.struct(F.concat(F.lit("X-"), m["role"]).alias("kind")).alias("who"),
                    F.array(F.struct(m["content"].alias("body"))).alias("parts"),
                ),
            )
        ).alias("payload"),
    )
    messages = msg.normalize_json(
        F.col("payload"),
        role_path="who.kind",
        content_path="parts.0.body",
        role_mapping={"X-USER": "user", "x-assistant": "assistant"},
    )
    return rows.select("conv_id", msg.conversation_json(messages).alias("conversation"))


def mapped_json_convert(spark, sf_dir):
    """JSON rows of several datasets with different field names and one mapping per dataset,
    converted in a single scan."""
    pairs = turn_pairs(spark, sf_dir)
    first = pairs.select(
        F.lit("one").alias("dataset_id"), "conv_id", "turn",
        F.to_json(F.struct("question", "answer", F.lit("en_GB").alias("lang"), "turn")).alias(JSON_ROW),
    )
    second = pairs.select(
        F.lit("two").alias("dataset_id"), "conv_id", "turn",
        F.to_json(
            F.struct(
                F.struct(F.col("question").alias("q"), F.array("answer").alias("a")).alias("body"),
                (F.col("turn") == 0).alias("first"),
            )
        ).alias(JSON_ROW),
    )
    third = gathered(spark, sf_dir).select(
        F.lit("three").alias("dataset_id"), "conv_id", F.lit(0).cast("long").alias("turn"),
        F.to_json(F.struct("messages")).alias(JSON_ROW),
    )
    mappings = mappings_frame(
        spark,
        [
            Mapping("one", "math", conversation_type="single_turn", user_field="question",
                    assistant_field="answer", language_field="lang", metadata_fields=("turn", "lang")),
            Mapping("two", "math", conversation_type="single_turn", user_field="body.q",
                    assistant_field="body.a.0", input_field="first", language="FR",
                    metadata_fields=("first", "body")),
            Mapping("three", "math", conversation_type="multi_turn", messages_field="messages"),
        ],
    )
    rows = first.unionByName(second).unionByName(third)
    records = convert_json(rows, mappings, keep=["conv_id", "turn"])
    return export_records(records, keep=["conv_id", "turn"])


QUERIES = {
    "multi_turn_convert": multi_turn_convert,
    "single_turn_convert": single_turn_convert,
    "metadata_build": metadata_build,
    "record_fingerprint": record_fingerprint,
    "nested_payload_convert": nested_payload_convert,
    "message_path_profile": message_path_profile,
    "message_detect": message_detect,
    "message_paths_given": message_paths_given,
    "mapped_json_convert": mapped_json_convert,
}

_LANG = "CASE lang WHEN 'en' THEN 'english' WHEN 'fr' THEN 'french' WHEN 'de' THEN 'german' WHEN 'es' THEN 'spanish' ELSE 'unknown' END"


def _two(user: str, answer: str) -> str:
    return (
        f"""'[{{"role": "user", "content": ' || {sql_json(user)} || '}}, """
        f"""{{"role": "assistant", "content": ' || {sql_json(answer)} || '}}]'"""
    )


SQL = {
    "multi_turn_convert": f"""
        SELECT conv_id, {_SQL_CONVERSATION} AS conversation, 'unknown' AS language,
          NULL::VARCHAR AS reasoning,
          '{{"dataset_id": "chats", "task_type": "natural_language", "language_source": "schema.language", "source_fields": ["messages"]}}' AS metadata,
          'chats' AS dataset_id {_SQL_TWO_SIDED}""",
    "single_turn_convert": f"""
        SELECT p.conv_id, p.turn,
          {_two("question || CASE WHEN d.text IS NULL OR length(d.text) > 1200 THEN '' ELSE chr(10) || chr(10) || d.text END", "answer")} AS conversation,
          {_LANG} AS language, d.source AS reasoning,
          '{{"dataset_id": "pairs", "task_type": "math", "language_source": "lang", "source_fields": ["question", "input", "answer"], "turn": ' || p.turn || '}}' AS metadata,
          'pairs' AS dataset_id
        FROM (
          SELECT * FROM ({SQL_PAIRS})
          UNION ALL SELECT doc_id, -1, source, upper(lang) FROM documents) p
        LEFT JOIN documents d ON d.doc_id = p.conv_id""",
    "metadata_build": f"""
        SELECT d.doc_id, '{{"dataset_id": "docs", "task_type": "code_generation", "language_source": "schema.language", "source_fields": ["lang", null, "source"]'
          || CASE WHEN length(text) <= 500 THEN ', "text": ' || {sql_json('text')} ELSE '' END
          || ', "lang": "' || lang || '", "n_chars": ' || n_chars
          || coalesce(', "quality": ' || quality, '')
          || coalesce(', "toxic": ' || CASE WHEN toxic = 1 THEN 'true' WHEN toxic = 0 THEN 'false' END, '')
          || ', "eighth": ' || CAST(n_chars / 8.0::DOUBLE AS VARCHAR)
          || ', "broken": "[broken ' || source || '"}}' AS metadata, 'docs' AS dataset_id
        FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "record_fingerprint": f"""
        SELECT conv_id, sha1({_SQL_CONVERSATION} || chr(10) || '<SEP>' || chr(10)) AS fp
        FROM conversations WHERE role IN ('user', 'assistant') GROUP BY conv_id""",
    "nested_payload_convert": f"SELECT conv_id, {_SQL_CONVERSATION} AS conversation {_SQL_TWO_SIDED}",
    "message_path_profile": """
        SELECT conv_id % 3 AS shape,
          CASE conv_id % 3 WHEN 0 THEN NULL WHEN 1 THEN 'dialog' ELSE 'data.part.turns' END AS path,
          count(DISTINCT conv_id) AS n
        FROM conversations GROUP BY ALL""",
    "message_detect": "SELECT DISTINCT conv_id, conv_id % 3 = 0 AS message_like FROM conversations",
    "message_paths_given": f"""
        SELECT conv_id, {_SQL_CONVERSATION} AS conversation FROM conversations
        WHERE role IN ('user', 'assistant') GROUP BY conv_id""",
    "mapped_json_convert": f"""
        SELECT conv_id, turn, {_two('question', 'answer')} AS conversation, 'english' AS language,
          NULL::VARCHAR AS reasoning,
          '{{"dataset_id": "one", "task_type": "math", "language_source": "lang", "source_fields": ["question", null, "answer"], "turn": ' || turn || ', "lang": "en_GB"}}' AS metadata,
          'one' AS dataset_id FROM ({SQL_PAIRS})
        UNION ALL
        SELECT conv_id, turn,
          {_two("question || chr(10) || chr(10) || CASE WHEN turn = 0 THEN 'True' ELSE 'False' END", 'answer')},
          'french', NULL,
          '{{"dataset_id": "two", "task_type": "math", "language_source": "schema.language", "source_fields": ["body.q", "first", "body.a.0"], "first": ' || CASE WHEN turn = 0 THEN 'true' ELSE 'false' END || '}}',
          'two' FROM ({SQL_PAIRS})
        UNION ALL
        SELECT conv_id, 0, {_SQL_CONVERSATION}, 'unknown', NULL,
          '{{"dataset_id": "three", "task_type": "math", "language_source": "schema.language", "source_fields": ["messages"]}}',
          'three' {_SQL_TWO_SIDED}""",
}
