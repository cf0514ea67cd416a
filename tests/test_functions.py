import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatnorm.functions import errors, language, links, messages, paths, scoring
from chatnorm.functions import text as X


def apply(spark, values, fn, ddl="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {ddl}").coalesce(1)
    return [r[0] for r in df.select(fn(F.col("v")).alias("r")).collect()]


def test_strip_covers_unicode_blanks(spark):
    values = ["  a b ", "　x\x85", "\x1fy\n", "", None, " \t"]
    assert apply(spark, values, X.strip) == ["a b", "x", "y", "", None, ""]


def test_to_text_of_typed_values(spark):
    assert apply(spark, [True, None], lambda c: X.to_text(c, T.BooleanType()), "boolean") == ["True", ""]
    assert apply(spark, [5], lambda c: X.to_text(c, T.LongType()), "bigint") == ["5"]
    stamps = [datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2, 3, 4, 5, 500000)]
    assert apply(spark, stamps, lambda c: X.to_text(c, T.TimestampNTZType()), "timestamp_ntz") == list(map(str, stamps))
    nested = apply(
        spark, [["a,b", None]], lambda c: X.to_text(c, T.ArrayType(T.StringType())), "array<string>"
    )
    assert nested == ['["a,b", null]']


@pytest.mark.parametrize("step", [1.0, 0.1, 1 / 3, 7e-7, 1e16, 123456.789e3])
def test_float_text_is_shortest(spark, step):
    values = [step * k for k in (1, -1, 3, 7, 11, 1e3, 1e-3, 1e10)]
    assert apply(spark, values, lambda c: X.to_text(c, T.DoubleType()), "double") == list(map(repr, values))


def test_json_string_matches_json(spark):
    values = ['a"\\/b', "é\n\t\r\x08\x0c", "\x00\x0b\x1f\x7f ", "x\\u000B\x0e", ""]
    expected = [json.dumps(v, ensure_ascii=False) for v in values]
    assert apply(spark, values, X.json_string) == expected
    assert apply(spark, [None], X.json_string) == ["null"]


def test_spaced_json(spark):
    values = ['{"a":[1,{"b":"x,:\\"y"}],"c":null}', "[]", '{"k":"' + "\\n,:" * 20000 + '"}']
    expected = [json.dumps(json.loads(v), ensure_ascii=False) for v in values]
    assert apply(spark, values, X.spaced_json) == expected


def test_json_parsing_is_strict(spark):
    values = ['{"a":1}', ' {"a":1} x', '{"a":1}]', "{'a':1}", '{"a":1', "[1]", "5", None, '{"a":1},{"b":2}']
    assert apply(spark, values, lambda c: X.json_fields(c).isNotNull()) == [True] + [False] * 8
    lists = ['[1,"x",{"q":1.50},null]', "[1", "{}", "[1]]"]
    assert apply(spark, lists, X.json_items) == [["1", "x", '{"q":1.5}', None], None, None, None]


def test_language_labels(spark):
    values = ["en", "en_US", "pt-br", "EN", "", None, "12", "python", "mixed", " Fr ", "zh-Hans", "Deutsch 2"]
    assert apply(spark, values, language.normalize_language) == [
        "english", "english", "pt_br", "english", "unknown", "unknown", "unknown", "python",
        "multilingual", "french", "chinese", "deutsch",
    ]


def test_links(spark):
    values = [
        "https://h/datasets/o/n?x=1", "https://h/datasets/o/n/tree/main", "https://h/o/n",
        "https://h/datasets/n", "/o/n/", "", None, " https://h/a//b;p=1 ", "http://h", "HTTP://h/a/b",
    ]
    assert apply(spark, values, links.normalize_link) == [
        "o/n", "o/n", "o/n", "datasets/n", "o/n", "", "", "a/b", "", "HTTP://h/a/b",
    ]


def test_error_messages(spark):
    values = [
        "429 Too Many Requests. Retry-After: 3.5", "please try again in 7 secs",
        "Feature type 'Json' not found", "feature type 'json' not found", "Please pass a HF_TOKEN", None,
        "please try again in 7 seconds or retry after=2",
    ]
    assert apply(spark, values, errors.error_class) == [
        "rate_limited", "other", "unsupported_schema", "other", "auth_required", "other", "other",
    ]
    assert apply(spark, values, errors.retry_after_seconds) == [3.5, 7.0, None, None, None, None, 2.0]


def test_scores(spark):
    df = spark.createDataFrame(
        [("def f(x): return x; {}\n",), ("Write and explain a b c d e?",), ("solve = + 1",), ("",), (None,)],
        "v string",
    ).coalesce(1)
    rows = df.select(
        F.round(scoring.code_score("v"), 6),
        F.round(scoring.prompt_score("v"), 6),
        F.round(scoring.math_score("v"), 6),
        F.round(scoring.natural_language_score("v"), 6),
    ).collect()
    # def, return, {, }, ; plus one newline and two braces
    assert tuple(rows[0]) == (5.25, -0.5, 0.0, -0.5)
    # write, explain, ? and six blanks; natural language needs more than seven blanks
    assert tuple(rows[1]) == (0.0, 4.0, 0.0, 2.0)
    assert tuple(rows[2]) == (0.0, 1.0, 1.06, 0.0)
    assert [tuple(r) for r in rows[3:]] == [(0.0,) * 4] * 2


def test_vectorish(spark):
    values = ["[1, 2]", "{a}", "plain words", "1234567 8", "², ³ ¹", "a,b" * 40 + "x" * 300, "", None, " [x] "]
    df = spark.createDataFrame([(v,) for v in values], "v string").coalesce(1)
    got = [r[0] for r in df.select(scoring.is_vectorish("v")).collect()]
    assert got == [True, True, False, True, True, True, False, False, True]


def test_dotted_paths(spark):
    row = '{"a":[{"b":1}],"x.y":2,"o":{"0":"k"}}'
    df = spark.createDataFrame([(row,)], "v string")
    got = df.select(*[paths.json_get(F.col("v"), p).alias(str(i)) for i, p in
                      enumerate(["a.0.b", "a.1.b", "x.y", "", "o.0", "a.b"])]).first()
    assert tuple(got) == ("1", None, None, None, "k", None)
    typed = spark.createDataFrame([([{"b": 1}], {"k": "v"})], "a array<struct<b:int>>, m map<string,string>")
    column, dtype = paths.resolve(typed.schema, "a.0.b")
    assert typed.select(column).first()[0] == 1 and dtype == T.IntegerType()
    assert typed.select(paths.resolve(typed.schema, "a.1.b")[0]).first()[0] is None
    assert paths.resolve(typed.schema, "a.b") is None and paths.resolve(typed.schema, "") is None


MESSAGE_CASES = [
    ('[{"from":"human","value":"q"},{"from":"gpt","value":"a"}]', [("user", "q"), ("assistant", "a")]),
    ('{"id":1,"chat":[{"role":"user","content":"q"},{"role":"Bot","text":"a"}]}', [("user", "q"), ("assistant", "a")]),
    ('{"a":{"b":"[{\\"role\\":\\"user\\",\\"content\\":\\"x\\"}]"}}', [("user", "x")]),
    ('["x", {"role":"user","content":"q"}, {"speaker":"bot","text":"a"}]', [("user", "q"), ("assistant", "a")]),
    ('["{\\"role\\":\\"user\\",\\"content\\":\\"x\\"}", {"role":"user","content":"y"}]', [("user", "y")]),
    ('[{"role":"","from":"user","content":"","value":false,"text":true}]', [("user", "True")]),
    ('[{"role":"user","content":[{"t":"x"}, 1]},{"role":"system","content":"s"}]', [("user", '[{"t": "x"}, 1]')]),
    ('[{"role":"user","content":"[]"},{"role":"user","content":[]}]', [("user", "[]")]),
    ('{"messages":[],"chat":[{"role":"user","content":"q"}]}', []),
    ('{"chat":"[{\\"role\\":\\"user\\",\\"content\\":\\"q\\"}]"}', [("user", "q")]),
    ('{"p":["a"],"q":[{"role":"user","content":"q"}]}', []),
    ("plain", []), (None, []), ("[broken", []), ('[{"role":"user","content":"  "}]', []),
]


def test_message_lists(spark):
    got = apply(spark, [c for c, _ in MESSAGE_CASES], messages.normalize_json)
    assert [[(m.role, m.content) for m in row] for row in got] == [e for _, e in MESSAGE_CASES]


def test_message_paths(spark):
    values = ['{"a":{"b":[{"role":"x"}]}}', '{"a":[[{"k":1}],[{"text":1}]]}', "[1]", '[{"role":1}]', None,
              '{"a":"[{\\"from\\":1}]"}']
    assert apply(spark, values, messages.message_path) == ["a.b", "a.1", None, None, None, "a"]


def test_looks_like_messages(spark):
    values = ['[{"role":"x"}]', ' [{"text":1},2]', '[{"k":1}]', '{"role":1}', "[]", '["{\\"role\\":1}"]', "x", None]
    assert apply(spark, values, messages.looks_like_messages_json) == [True, True] + [False] * 6


def test_typed_messages(spark):
    schema = "array<struct<speaker:string,role:string,content:string,value:bigint>>"
    df = spark.createDataFrame([([("bot", None, "", 7), ("x", "Human", "hi", 0), (None, "system", "s", 1)],)], f"m {schema}")
    got = df.select(messages.normalize_typed(F.col("m"), df.schema["m"].dataType)).first()[0]
    assert [(m.role, m.content) for m in got] == [("assistant", "7"), ("user", "hi")]
