import csv
import json

import pytest
from pyspark.sql import functions as F

from chatnorm.plans import tracking
from chatnorm.plans.dedup_file import default_output_path, dedup_file, infer_format
from chatnorm.plans.normalize import RunOptions, run
from chatnorm.sinks.writers import write_records
from chatnorm.sources import catalog as C
from chatnorm.sources import readers as R
from chatnorm.sources.outputs import existing_fingerprints
from chatnorm.streaming.stream import drop_seen, start, stream_records
from chatnorm.types import JSON_ROW, RECORD_COLUMNS, Mapping


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def json_rows(df):
    return [json.loads(r[0]) for r in df.orderBy(*R.ORDINAL).select(JSON_ROW).collect()]


def test_json_lines(spark, tmp_path):
    lines = ['{"a": 1}', "", "  ", '{"a": ', "[1]", '[{"a": 2}]', "5", ' {"a": 3} ', '{"a": 4} x']
    path = write(tmp_path / "x.jsonl", "\n".join(lines))
    assert json_rows(R.read_jsonl(spark, [path])) == [{"a": 1}, {"a": 3}]


@pytest.mark.parametrize(
    "text, rows",
    [
        ('[{"a": 1}, 2, {"a": 3}]', [{"a": 1}, {"a": 3}]),
        ('{"n": 1, "rows": [{"a": 1}, "x"]}', [{"a": 1}]),
        ('{"rows": {"a": 1}}', [{"rows": {"a": 1}}]),
        ('{"items": [], "a": 1}', []),
        ('{"examples": [{"a": 2}], "data": [{"a": 1}]}', [{"a": 1}]),
        ("{broken", []),
        ("3", []),
    ],
)
def test_json_documents(spark, tmp_path, text, rows):
    assert json_rows(R.read_json(spark, [write(tmp_path / "x.json", text)])) == rows


def test_csv_values_are_text(spark, tmp_path):
    path = tmp_path / "x.csv"
    with path.open("w", newline="", encoding="utf-8") as f:
        csv.writer(f).writerows([["id", "t"], ["007", 'a "q"\nb\\n,c'], ["8", "é"]])
    rows = R.read_csv(spark, [str(path)]).orderBy(*R.ORDINAL).collect()
    assert [(r.id, r.t) for r in rows] == [("007", 'a "q"\nb\\n,c'), ("8", "é")]


def test_files_with_other_columns(spark, tmp_path):
    paths = [write(tmp_path / "c/1.csv", "a,b\n1,2\n"), write(tmp_path / "c/2.csv", "b,a\n3,4\n"),
             write(tmp_path / "c/3.csv", "a,c\n5,6\n")]
    rows = R.read_csv(spark, paths).orderBy(*R.ORDINAL).select("a", "b", "c").collect()
    assert [tuple(r) for r in rows] == [("1", "2", None), ("4", "3", None), ("5", None, "6")]
    one, two = str(tmp_path / "p1.parquet"), str(tmp_path / "p2.parquet")
    spark.createDataFrame([(1,)], "a int").write.parquet(one)
    spark.createDataFrame([(2, 3)], "a int, b int").write.parquet(two)
    assert sorted(map(tuple, R.read_parquet(spark, [one, two]).select("a", "b").collect()), key=str) == [(1, None), (2, 3)]


def test_listing_and_layout(spark, tmp_path):
    for name in ["d/default/train/b.jsonl", "d/default/train/a.JSONL", "d/default/test/c.jsonl", "d/other/train/x.jsonl",
                 "d/default/dataset_infos.json", "d/default/train/state.json", "d/README.md", "d/.cache/h.json"]:
        write(tmp_path / name, json.dumps({"n": name}))
    listed = [r.path.split("/d/")[1] for r in R.list_data_files(spark, str(tmp_path / "d")).collect()]
    assert listed == ["default/test/c.jsonl", "default/train/a.JSONL", "default/train/b.jsonl", "other/train/x.jsonl"]
    dataset = R.open_dataset(spark, str(tmp_path), "d")
    assert dataset.config_name == "default" and dataset.splits == ("test", "train")
    names = [r["n"].split("/")[-1] for r in json_rows(dataset.read(spark))]
    assert names == ["c.jsonl", "a.JSONL", "b.jsonl"]
    assert len(R.sample_json(spark, dataset, 2)) == 2


def test_formats_meet_as_json(spark, tmp_path):
    write(tmp_path / "m/a.csv", "k,v\n1,x\n")
    write(tmp_path / "m/b.jsonl", '{"k": 2}\n')
    spark.createDataFrame([(3, "z")], "k int, v string").coalesce(1).write.parquet(str(tmp_path / "m/p"))
    dataset = R.open_dataset(spark, str(tmp_path), "m")
    assert dataset.config_name == R.RAW_CONFIG
    assert json_rows(dataset.read(spark)) == [{"k": "1", "v": "x"}, {"k": 2}, {"k": 3, "v": "z"}]
    with pytest.raises(Exception):
        R.open_dataset(spark, str(tmp_path), "missing")


def test_fallback_classes(spark, tmp_path):
    write(tmp_path / "f/a.jsonl", '{"k": 2}\n')
    dataset = R.open_dataset(spark, str(tmp_path), "f")
    assert R.raw_fallback(spark, dataset, ValueError("JSON parse error: x")).config_name == R.RAW_CONFIG
    with pytest.raises(R.DatasetDeferred) as deferred:
        R.raw_fallback(spark, dataset, ValueError("please pass a HF_TOKEN"))
    assert deferred.value.reason == "hf_auth_required"
    gone = R.Dataset("g", None, ("a",), ((0, str(tmp_path / "no.txt")),))
    with pytest.raises(R.DatasetDeferred) as deferred:
        R.raw_fallback(spark, gone, ValueError("Available feature types: []"))
    assert deferred.value.reason == "raw_fallback_failed"
    with pytest.raises(KeyError):
        R.raw_fallback(spark, dataset, KeyError("other"))


def test_domain_config(spark, tmp_path):
    write(tmp_path / "links.csv", "link\nhttps://h/datasets/o/n\n\nhttps://h/o/n?x=1\n/p/q/\n")
    config = {"domains": [
        {"name": "Code Gen", "task_type": "CODE_GENERATION", "csv_path": "links.csv", "dataset_ids": ["ignored/x"]},
        {"name": "m", "task_type": "math", "dataset_ids": [" a/b ", "", "a/b", "https://h/datasets/a/b"], "max_rows_per_dataset": "5"},
    ]}
    domains = C.read_domains(spark, write(tmp_path / "domains.json", json.dumps(config)))
    rows = C.resolve_catalog(spark, str(tmp_path), domains).orderBy("entry", "pos").collect()
    assert [(r.slug, r.dataset_id, r.is_repeat, r.max_rows_per_dataset) for r in rows] == [
        ("code_gen", "o/n", False, None), ("code_gen", "p/q", False, None), ("m", "a/b", False, 5), ("m", "a/b", True, 5),
    ]
    assert [r.domain for r in C.select_domains(domains, [" M "]).collect()] == ["m"]
    with pytest.raises(ValueError, match="a, z"):
        C.select_domains(domains, ["z", "a", "m"])
    write(tmp_path / "datasets.csv", "dataset_id,x\n o/n ,1\no/n,2\n")
    legacy = C.resolve_catalog(spark, str(tmp_path), None).collect()
    assert [(r.domain, r.dataset_id) for r in legacy] == [("code_generation", "o/n")]
    with pytest.raises(ValueError):
        C.read_links(spark, str(tmp_path / "datasets.csv"))


@pytest.mark.parametrize(
    "entry", [{"task_type": "math", "dataset_ids": []}, {"name": "x", "task_type": "poetry", "dataset_ids": []},
              {"name": "x", "task_type": "math"}, {"name": "x", "task_type": "math", "dataset_ids": "a"}, 5]
)
def test_bad_domain_config(spark, tmp_path, entry):
    with pytest.raises(ValueError, match="entry #1"):
        C.read_domains(spark, write(tmp_path / "d.json", json.dumps({"domains": [entry]})))
    with pytest.raises(ValueError):
        C.read_domains(spark, write(tmp_path / "e.json", '{"domains": []}'))


def test_output_names():
    assert C.output_name("combined.csv", "math", "default") == "combined_math.csv"
    assert C.output_name("combined.csv", "math", "run1") == "combined_math_run1.csv"
    assert C.output_name("combined.csv", "", "default") == "combined.csv"


def test_dedup_file(spark, tmp_path):
    path = write(tmp_path / "t.csv", 'k,v\nA,1\n"a ",2\nb,3\nA,4\n')
    counts = dedup_file(spark, path, subset=["k"], ignore_case=True, strip_whitespace=True, preserve_order=True).first()
    assert tuple(counts) == (4, 2, 2)
    back = spark.read.options(header=True).csv(default_output_path(path)).collect()
    assert [tuple(r) for r in back] == [("A", "1"), ("b", "3")]
    folder = str(tmp_path / "p.parquet")
    spark.createDataFrame([(1,), (1,), (2,)], "a int").write.parquet(folder)
    dedup_file(spark, folder, inplace=True)
    assert sorted(r.a for r in spark.read.parquet(folder).collect()) == [1, 2]
    with pytest.raises(ValueError):
        infer_format("x.txt")


def test_written_csv_reads_back_in_python(spark, tmp_path):
    row = ('[{"role": "user", "content": "a\\n\\"b\\", \\\\c"}]', "english", None, '{"x": " , "}', "d")
    df = spark.createDataFrame([row], ", ".join(f"{c} string" for c in RECORD_COLUMNS)).coalesce(1)
    write_records(df, "both", str(tmp_path / "o.csv"), str(tmp_path / "o.parquet"))
    (part,) = (tmp_path / "o.csv").glob("part-*.csv")
    with part.open(newline="", encoding="utf-8") as f:
        (got,) = csv.DictReader(f)
    assert got == dict(zip(RECORD_COLUMNS, [*row[:2], "", *row[3:]]))
    assert tuple(spark.read.parquet(str(tmp_path / "o.parquet")).first()) == row
    assert existing_fingerprints(spark, str(tmp_path / "o.csv"), str(tmp_path / "o.parquet")).count() == 1
    assert existing_fingerprints(spark, str(tmp_path / "no.csv"), None).count() == 0


# --- runs ----------------------------------------------------------------------------------------


def make_data(root):
    def chat(i):
        return {"messages": [{"from": "human", "value": f"q{i}"}, {"from": "gpt", "value": f"a{i}"}]}

    def lines(items):
        return "".join(json.dumps(x) + "\n" for x in items)

    write(root / "o/chats/default/train/0.jsonl", lines(chat(i) for i in [0, 1, 1, 2]))
    write(root / "o/chats/default/valid/0.jsonl", lines(chat(i) for i in [2, 3]))
    write(root / "o/again/data.json", json.dumps({"rows": [chat(3), chat(4), {"messages": None}]}))
    write(root / "o/plain/data.csv", "id,name\n1,x\n2,y\n")
    config = {"domains": [{"name": "Chat", "task_type": "natural_language",
                           "dataset_ids": ["o/chats", "o/again", "o/plain", "o/none", "https://h/datasets/o/chats"]}]}
    return write(root / "domains.json", json.dumps(config))


def contents(df):
    return sorted(json.loads(r.conversation)[0]["content"] for r in df.collect())


def statuses(outcomes):
    return {(r.dataset_id, r.status): (r.records_written, r.duplicates_filtered) for r in outcomes.collect()}


def test_run_and_rerun(spark, tmp_path):
    config = make_data(tmp_path / "data")
    domains = C.read_domains(spark, config)
    data, out = str(tmp_path / "data"), str(tmp_path / "out")
    options = RunOptions(output_format="both")
    first = statuses(run(spark, domains, data, out, options))
    assert first == {
        ("o/chats", "added"): (4, 2), ("o/again", "added"): (1, 1), ("o/plain", "skipped"): (0, 0),
        ("o/none", "failed"): (0, 0), ("o/chats", "duplicate_input"): (0, 0),
    }
    parquet = f"{out}/combined_dataset_chat.parquet"
    csv_out = spark.read.options(header=True, multiLine=True, escape='"').csv(f"{out}/combined_dataset_chat.csv")
    assert contents(spark.read.parquet(parquet)) == contents(csv_out) == ["q0", "q1", "q2", "q3", "q4"]
    summary = spark.read.json(f"{out}/pipeline_summary.json").first()
    assert summary.totals.records_written == 5 and summary.totals.datasets_failed == 1
    assert summary.domains[0].parquet_path == f"{out}/combined_dataset_chat.parquet"
    assert summary.totals.record_duplicates_filtered == 3 and summary.domains[0].datasets_total == 5
    log = tracking.read_log(spark, f"{out}/pipeline_progress_log_chat.csv")
    assert {r.status for r in log.collect()} == {"started", "added", "skipped", "failed", "duplicate_input", "completed"}

    again = statuses(run(spark, domains, data, out, options))
    assert {k for k in again} == {
        ("o/chats", "duplicate_input"), ("o/again", "duplicate_input"), ("o/plain", "duplicate_input"), ("o/none", "failed"),
    }
    assert contents(spark.read.parquet(parquet)) == ["q0", "q1", "q2", "q3", "q4"]

    resumed = statuses(run(spark, domains, data, out, RunOptions(output_format="both", resume=True, ignore_registry=True)))
    assert ("o/chats", "resumed_skip") in resumed and ("o/plain", "resumed_skip") in resumed

    # Without registry and resume all is read again, and all of it is known.
    forced = statuses(run(spark, domains, data, out, RunOptions(output_format="parquet", ignore_registry=True)))
    assert forced[("o/chats", "added")] == (0, 6) and forced[("o/again", "added")] == (0, 2)
    assert spark.read.parquet(parquet).count() == 5


def test_run_with_cap_and_without_dedup(spark, tmp_path):
    domains = C.read_domains(spark, make_data(tmp_path / "data"))
    data, out = str(tmp_path / "data"), str(tmp_path / "out")
    options = RunOptions(output_format="parquet", max_rows_per_dataset=3, progress_name="capped", deduplicate=False)
    got = statuses(run(spark, domains, data, out, options))
    assert got[("o/chats", "added")] == (3, 0) and got[("o/again", "added")] == (2, 0)
    assert contents(spark.read.parquet(f"{out}/combined_dataset_chat_capped.parquet")) == ["q0", "q1", "q1", "q3", "q4"]
    nothing = RunOptions(output_format="parquet", max_rows_per_dataset=0, progress_name="zero", ignore_registry=True)
    assert statuses(run(spark, domains, data, out, nothing))[("o/chats", "added")] == (0, 0)


def test_failed_write_is_logged_and_retried(spark, tmp_path, monkeypatch):
    from chatnorm.plans import normalize

    domains = C.read_domains(spark, make_data(tmp_path / "data"))
    data, out = str(tmp_path / "data"), str(tmp_path / "out")
    options = RunOptions(output_format="parquet")
    with monkeypatch.context() as patched:
        def broken(*args, **kwargs):
            raise OSError("disk")

        patched.setattr(normalize, "write_records", broken)
        got = statuses(run(spark, domains, data, out, options))
    assert ("o/chats", "failed") in got and ("o/again", "failed") in got
    assert statuses(run(spark, domains, data, out, options))[("o/chats", "added")] == (4, 2)


def test_run_takes_over_earlier_state(spark, tmp_path):
    domains = C.read_domains(spark, make_data(tmp_path / "data"))
    registry = write(tmp_path / "registry.json", '{"o/chats": {"Chat": "added", "Other": "failed"}, "o/plain": {"Chat": "failed"}}')
    checkpoint = write(tmp_path / "checkpoint.json", '["o/again"]')
    options = RunOptions(output_format="parquet", resume=True, registry_file=registry, checkpoint_file=checkpoint)
    got = statuses(run(spark, domains, str(tmp_path / "data"), str(tmp_path / "out"), options))
    assert set(got) == {("o/chats", "duplicate_input"), ("o/again", "resumed_skip"), ("o/plain", "skipped"), ("o/none", "failed")}


def test_run_with_proposals(spark, tmp_path):
    domains = C.read_domains(spark, make_data(tmp_path / "data"))
    proposal = {"is_target_dataset": True, "task_type": "natural_language", "conversation_type": "single_turn",
                "user_field": "id", "assistant_field": "name", "language": "fr"}
    proposals = spark.createDataFrame([("o/plain", json.dumps(proposal))], "dataset_id string, response string")
    got = statuses(run(spark, domains, str(tmp_path / "data"), str(tmp_path / "out"), RunOptions(output_format="parquet"), proposals=proposals))
    assert got[("o/plain", "added")] == (2, 0)
    rows = spark.read.parquet(f"{tmp_path}/out/combined_dataset_chat.parquet").where("dataset_id = 'o/plain'").collect()
    assert {r.language for r in rows} == {"french"}


def test_tracking_files(spark, tmp_path):
    path = write(tmp_path / "checkpoint.json", '["b", "a"]')
    assert sorted(r[0] for r in tracking.done_in_checkpoint(spark, path).collect()) == ["a", "b"]
    broken = write(tmp_path / "broken.json", '["b", ')
    assert tracking.done_in_checkpoint(spark, broken).count() == 0
    assert tracking.done_in_checkpoint(spark, str(tmp_path / "none.json")).count() == 0
    registry = write(tmp_path / "registry.json", '{"d": {"x": "added", "y": "failed"}}')
    assert tracking.read_registry_json(spark, registry).count() == 2
    folder = str(tmp_path / "registry")
    tracking.mark(spark, folder, [("x", "d", "failed"), ("x", "d", "added")])
    assert [tuple(r) for r in tracking.read_registry(spark, folder).collect()] == [("x", "d", "added")]
    tracking.mark(spark, folder, [("x", "d", "failed")])
    assert tracking.read_registry(spark, folder).first().status == "failed"


# --- streaming -----------------------------------------------------------------------------------


def test_stream_resumes_and_equals_batch(spark, tmp_path):
    def drop(name, keys):
        text = "".join(json.dumps({"q": f"q{k}", "a": "a"}) + "\n" for k in keys)
        write(tmp_path / "in" / name, text)

    mapping = Mapping("d", "math", conversation_type="single_turn", user_field="q", assistant_field="a")
    progress = []

    def go():
        rows = R.stream_files(spark, str(tmp_path / "in"), "jsonl", max_files=1)
        records = drop_seen(stream_records(rows, mapping, "dom"))
        start(records, str(tmp_path / "ck"), "both", str(tmp_path / "csv"), str(tmp_path / "pq"),
              lambda batch, n: progress.append(n)).awaitTermination()

    drop("1.jsonl", [0, 1, 1, 2])
    drop("2.jsonl", [2, 3])
    go()
    assert contents(spark.read.parquet(str(tmp_path / "pq"))) == ["q0", "q1", "q2", "q3"]
    drop("3.jsonl", [0, 3, 4])
    go()
    assert contents(spark.read.parquet(str(tmp_path / "pq"))) == ["q0", "q1", "q2", "q3", "q4"]
    assert sum(progress) == 5
    back = spark.read.options(header=True, multiLine=True, escape='"', recursiveFileLookup=True).csv(str(tmp_path / "csv"))
    assert back.count() == 5
