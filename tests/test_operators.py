import json
import random

import pytest
from pyspark.sql import functions as F

from chatnorm.operators.cap import cap_rows
from chatnorm.operators.convert import convert_json, convert_table, export_records
from chatnorm.operators.dedup import dedup_counts, drop_duplicates, fingerprint, first_records, unseen_records
from chatnorm.operators.detect import detect_mappings, json_cells, table_cells
from chatnorm.operators.proposals import resolve_mappings, validate_proposals
from chatnorm.types import JSON_ROW, Mapping, mappings_frame

SINGLE = dict(conversation_type="single_turn", user_field="q", input_field="i", assistant_field="a")


def turns(row):
    return [(m["role"], m["content"]) for m in row["conversation"]]


def test_single_turn_rules(spark):
    rows = [
        ("hi", "more", "yes"), ("", "only input", "yes"), ("hi", "[vector]", "yes"), ("hi", "x" * 1201, "yes"),
        ("hi", None, "yes"), ("hi", "m", " "), (None, None, "yes"), (" hi ", " m ", " yes "),
    ]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, q string, i string, a string")
    got = convert_table(df, Mapping("d", "math", **SINGLE), keep=["k"]).orderBy("k").collect()
    assert {r.k: r.conversation[0].content for r in got} == {
        0: "hi\n\nmore", 1: "only input", 2: "hi", 3: "hi", 4: "hi", 7: "hi\n\nm",
    }
    assert all(r.conversation[1].content == "yes" for r in got)


def test_multi_turn_needs_both_sides(spark):
    df = spark.createDataFrame(
        [(0, [("user", "a"), ("bot", "b")]), (1, [("user", "a"), ("user", "b")]), (2, [("system", "s"), ("user", "a")]), (3, None)],
        "k int, m array<struct<role:string,content:string>>",
    )
    mapping = Mapping("d", "math", conversation_type="multi_turn", messages_field="m")
    assert [r.k for r in convert_table(df, mapping, keep=["k"]).collect()] == [0]
    none = Mapping("d", "math", conversation_type=None, messages_field="m")
    assert convert_table(df, none, keep=["k"]).count() == 0


METADATA_ROW = {
    "q": "x", "a": "y", "null": None, "yes": True, "n": 3, "f": 1.5, "pad": " x ", "blank": "", "long": "z" * 501,
    "list_text": "[1]", "broken": "[broken", "nested": [1], "text_true": "true", "text_n": "3",
}
METADATA_EXPECTED = {"yes": True, "n": 3, "f": 1.5, "pad": "x", "broken": "[broken", "text_true": "true", "text_n": "3"}


def test_metadata_values_in_json_rows(spark):
    df = spark.createDataFrame([("d", json.dumps(METADATA_ROW))], f"dataset_id string, {JSON_ROW} string")
    mapping = Mapping("d", "math", conversation_type="single_turn", user_field="q", assistant_field="a",
                      metadata_fields=tuple(k for k in METADATA_ROW if k not in "qa") + ("dataset_id", "gone"))
    metadata = json.loads(convert_json(df, mappings_frame(spark, [mapping])).first().metadata)
    fixed = {"dataset_id": "d", "task_type": "math", "language_source": "schema.language", "source_fields": ["q", None, "a"]}
    assert metadata == {**fixed, **METADATA_EXPECTED}


def test_metadata_values_in_typed_rows(spark):
    df = spark.createDataFrame(
        [("x", "y", True, 3, 1.5, " x ", "z" * 501, "[1]", "[broken", [1])],
        "q string, a string, yes boolean, n int, f double, pad string, long string, list_text string, broken string, nested array<int>",
    )
    mapping = Mapping("d", "math", conversation_type="single_turn", user_field="q", assistant_field="a",
                      metadata_fields=("yes", "n", "f", "pad", "long", "list_text", "broken", "nested"))
    metadata = json.loads(convert_table(df, mapping).first().metadata)
    assert {k: v for k, v in metadata.items() if k in METADATA_EXPECTED} == {
        k: METADATA_EXPECTED[k] for k in ("yes", "n", "f", "pad", "broken")
    }
    assert "nested" not in metadata and "long" not in metadata and "list_text" not in metadata


def test_typed_and_json_conversion_agree(spark):
    rows = [("hi there", "[1, 2]", "answer", "en_GB", "because"), ("q", "ctx", "a", None, " "), ("", "", "a", "fr", None)]
    df = spark.createDataFrame(rows, "q string, i string, a string, lang string, why string")
    mapping = Mapping("d", "math", **SINGLE, language_field="lang", reasoning_field="why", metadata_fields=("lang",))
    typed = export_records(convert_table(df, mapping))
    as_json = df.select(F.lit("d").alias("dataset_id"), F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias(JSON_ROW))
    from_json = export_records(convert_json(as_json, mappings_frame(spark, [mapping])))
    assert sorted(map(tuple, typed.collect()), key=str) == sorted(map(tuple, from_json.collect()), key=str)
    assert typed.count() == 2


def brute_force_dedup(rows, key, keep):
    groups = {}
    for row in rows:
        groups.setdefault(key(row), []).append(row)
    if keep == "none":
        return sorted(g[0] for g in groups.values() if len(g) == 1)
    return sorted(g[0 if keep == "first" else -1] for g in groups.values())


@pytest.mark.parametrize("keep", ["first", "last", "none"])
@pytest.mark.parametrize("clean", [False, True])
def test_dedup_against_brute_force(spark, keep, clean):
    random.seed(3)
    # One value fills a third of the table.
    values = ["HOT" if random.random() < 0.34 else random.choice(["a", "A", " a ", "b", "", None, "é", "É"]) for _ in range(400)]
    rows = [(i, v if v is not None else None, i % 3) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "id int, v string, g int").repartition(5)
    norm = (lambda v: None if v is None else v.strip().lower()) if clean else (lambda v: v)
    got = drop_duplicates(df, ["v", "g"], keep, clean, clean, order_by=["id"])
    expected = brute_force_dedup(rows, lambda r: (norm(r[1]), r[2]), keep)
    assert sorted((tuple(r) for r in got.collect()), key=lambda r: r[0]) == sorted(expected, key=lambda r: r[0])
    counts = dedup_counts(df, ["v", "g"], keep, clean, clean).first()
    assert tuple(counts) == (400, len(expected), 400 - len(expected))


def test_dedup_of_full_rows_and_errors(spark):
    df = spark.createDataFrame([(1, None, [1]), (1, None, [1]), (2, 0.0, None), (2, -0.0, None)], "a int, b double, c array<int>")
    assert drop_duplicates(df).count() == 2 and drop_duplicates(df, keep="none").count() == 0
    with pytest.raises(ValueError):
        drop_duplicates(df, ["nope"])
    with pytest.warns(UserWarning):
        assert drop_duplicates(df, ignore_case=True).count() == 2
    once = drop_duplicates(df)
    assert sorted(map(str, drop_duplicates(once).collect())) == sorted(map(str, once.collect()))


def test_record_dedup_within_domains(spark):
    rows = [("x", "c1", None, 0), ("x", "c1", "", 1), ("x", "c1", "r", 2), ("y", "c1", None, 3), ("x", "c2", None, 4)]
    df = spark.createDataFrame(rows, "domain string, c string, r string, pos int").withColumn(
        "fp", fingerprint(F.col("c"), F.col("r"))
    )
    firsts = first_records(df, ["pos"])
    assert sorted(r.pos for r in firsts.collect()) == [0, 2, 3, 4]
    old = df.where("pos = 4").select("domain", "fp")
    assert sorted(r.pos for r in unseen_records(firsts, old).collect()) == [0, 2, 3]


def test_rank_filter_runs_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("'d' AS domain", "CAST(id % 3 AS STRING) AS fp", "id")
    plan = first_records(df, ["id"])._jdf.queryExecution().executedPlan().toString()
    partial, exchange = plan.index("row_number(), 1, Partial"), plan.index("Exchange hashpartitioning")
    assert plan.index("row_number(), 1, Final") < exchange < partial


@pytest.mark.parametrize("cap", [0, 1, 7, 10, 64, 1000])
def test_cap_against_brute_force(spark, cap):
    random.seed(cap)
    rows = [("big" if random.random() < 0.5 else random.choice("abc"), i // 8, i) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, block bigint, row bigint").repartition(4)
    seen, expected = {}, []
    for g, _, i in rows:
        seen[g] = seen.get(g, 0) + 1
        if seen[g] <= cap:
            expected.append(i)
    assert sorted(r.row for r in cap_rows(df, cap, ["g"], ["block"], "row").collect()) == expected


def sample(spark, rows):
    return spark.createDataFrame(rows, f"dataset_id string, task_type string, row_pos int, {JSON_ROW} string")


def test_detection(spark):
    code = {"id": 1, "instruction": "Write a function to solve this problem?", "input": "the given input",
            "output": "def f(x):\n  return x; {}\n", "Lang": None}
    rows = [("code", "code_generation", i, json.dumps({**code, "Lang": "en-us" if i > 3 else None})) for i in range(12)]
    rows += [("chat", "math", i, json.dumps({"m": "[{\"role\":\"user\"}]" if i % 2 else None, "n": i})) for i in range(12)]
    rows += [("few", "math", i, json.dumps({"a": "solve it", "n": i})) for i in range(12)]
    rows += [("low", "math", i, json.dumps({"a": "x", "b": "y"})) for i in range(3)]
    rows += [("ties", "math", 0, json.dumps({"a": "solve algebra", "b": "solve algebra", "c": "[solve algebra]", "d": 5}))]
    rows += [("late", "math", i, json.dumps({"a": "solve"} if i == 0 else {"a": "solve", "b": "solve"})) for i in range(3)]
    got = {r.dataset_id: r for r in detect_mappings(json_cells(sample(spark, rows))).collect()}
    c = got["code"]
    assert (c.user_field, c.input_field, c.assistant_field) == ("instruction", "input", "output")
    assert (c.language, c.language_field, c.conversation_type) == ("english", "Lang", "single_turn")
    assert (got["chat"].conversation_type, got["chat"].messages_field) == ("multi_turn", "m")
    assert not got["few"].is_target_dataset and not got["low"].is_target_dataset
    t = got["ties"]
    # the earlier column wins; the third one has the score but looks like a vector
    assert (t.assistant_field, t.user_field, t.input_field) == ("a", "b", None)
    assert not got["late"].is_target_dataset  # columns are those of the first row


def test_detection_of_typed_tables(spark):
    df = spark.createDataFrame(
        [(i, "solve the equation", "algebra = 1", 2.5) for i in range(3)], "pos int, problem string, answer string, x double"
    )
    got = detect_mappings(table_cells(df, "t", "math", ["pos"])).first()
    assert (got.user_field, got.assistant_field) == ("answer", "problem")


GOOD = {"is_target_dataset": True, "task_type": "math", "conversation_type": "single_turn", "user_field": "q", "assistant_field": "a"}
PROPOSALS = {
    "ok": ("```json\n" + json.dumps(GOOD) + "\n```", "ok"),
    "prose": ("Sure: " + json.dumps(GOOD) + " done", "ok"),
    "task": (json.dumps({**GOOD, "task_type": "code_generation"}), "task_mismatch"),
    "single": (json.dumps({**GOOD, "assistant_field": None}), "incomplete_single_turn"),
    "multi": (json.dumps({**GOOD, "conversation_type": "multi_turn"}), "incomplete_multi_turn"),
    "field": (json.dumps({**GOOD, "language_field": "zz"}), "unknown_field"),
    "unchecked": (json.dumps({**GOOD, "input_field": "zz", "reasoning_field": "zz"}), "ok"),
    "not": ('{"is_target_dataset": "no", "task_type": "math"}', "not_target"),
    "types": (json.dumps({**GOOD, "metadata_fields": [1]}), "bad_types"),
    "nullist": (json.dumps({**GOOD, "metadata_fields": None}), "bad_types"),
    "lang": (json.dumps({**GOOD, "language": None}), "bad_types"),
    "number": (json.dumps({**GOOD, "user_field": 3}), "bad_types"),
    "kind": (json.dumps({**GOOD, "conversation_type": None}), "missing_conversation_type"),
    "text": ("no json here", "no_json_object"),
    "list": ("[" + json.dumps(GOOD) + "]", "no_json_object"),
}


def test_proposals(spark):
    frame = spark.createDataFrame([(k, "math", v) for k, (v, _) in PROPOSALS.items()], "dataset_id string, task_type string, response string")
    columns = spark.createDataFrame([(k, ["q", "a"]) for k in PROPOSALS], "dataset_id string, columns array<string>")
    validated = validate_proposals(frame, columns)
    assert {r.dataset_id: r.reason for r in validated.collect()} == {k: r for k, (_, r) in PROPOSALS.items()}
    fallback = mappings_frame(spark, [Mapping(k, "math", is_target_dataset=False) for k in PROPOSALS])
    resolved = {r.dataset_id: r for r in resolve_mappings(fallback, validated).collect()}
    assert resolved["ok"].user_field == "q" and resolved["task"].user_field is None
