"""Many datasets in one stream: mappings that come later, exact caps, failures, and counters."""

import json
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from chatnorm.sources.readers import stream_dataset
from chatnorm.streaming import domain_stream
from chatnorm.streaming.domain_stream import ProgressListener, counters, dataset_of, start_domain
from chatnorm.types import ORD_FILE, Mapping, mappings_frame

ONE = Mapping("o/a", "math", conversation_type="single_turn", user_field="q", assistant_field="a")


class Job:
    def __init__(self, spark, folder, name="cp"):
        self.spark, self.folder, self.checkpoint, self.mappings, self.time = spark, folder, str(folder / name), [], 0

    def add(self, dataset, name, numbers):
        path = self.folder / "data" / dataset / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("".join(json.dumps({"q": f"q{n}", "a": "x"}) + "\n" for n in numbers))
        self.time += 10
        os.utime(path, (1_700_000_000 + self.time,) * 2)  # the stream takes files in order of age

    def run(self, max_files=1, **options):
        rows = stream_dataset(self.spark, str(self.folder / "data"), max_files=max_files)
        rows = rows.withColumn("dataset_id", dataset_of(str(self.folder / "data")))
        out = str(self.folder / "out")
        start_domain(
            rows, lambda s: mappings_frame(s, self.mappings), self.checkpoint, "parquet", "", out, deep=False, **options
        ).awaitTermination()

    def written(self):
        rows = self.spark.read.option("recursiveFileLookup", True).parquet(str(self.folder / "out"))
        question = F.get_json_object("conversation", "$[0].content")
        return sorted((r.dataset_id, int(r.q[1:])) for r in rows.select("dataset_id", question.alias("q")).collect())


def test_cap_cuts_exactly_across_batches_and_starts(spark, tmp_path):
    job = Job(spark, tmp_path)
    job.mappings = [ONE, replace(ONE, dataset_id="o/b")]
    job.add("o/a", "1.jsonl", range(5))
    job.add("o/b", "1.jsonl", range(2))
    job.add("o/a", "2.jsonl", range(5, 10))
    job.run(cap=7, deduplicate=False)
    assert job.written() == [("o/a", n) for n in range(7)] + [("o/b", n) for n in range(2)]
    job.add("o/a", "3.jsonl", range(10, 20))
    job.add("o/b", "2.jsonl", range(2, 20))
    job.run(cap=7, deduplicate=False, max_files=2)
    assert job.written() == [(d, n) for d in ("o/a", "o/b") for n in range(7)]
    assert {r.dataset_id: (r.taken, r.duplicates, r.written) for r in counters(spark, job.checkpoint).collect()} == {
        "o/a": (7, 0, 7), "o/b": (7, 0, 7)
    }


def test_rows_wait_for_their_mapping_and_are_taken_once(spark, tmp_path):
    job = Job(spark, tmp_path)
    job.add("o/a", "1.jsonl", range(3))
    job.add("o/b", "1.jsonl", range(10, 13))
    job.mappings = [ONE]
    job.run()
    assert job.written() == [("o/a", n) for n in range(3)]
    job.mappings = [ONE, replace(ONE, dataset_id="o/b"), replace(ONE, dataset_id="o/none", is_target_dataset=False)]
    job.add("o/a", "2.jsonl", range(3, 5))
    job.add("o/none", "1.jsonl", range(50, 55))
    job.run()
    job.add("o/b", "2.jsonl", [13])
    job.run()
    assert job.written() == [("o/a", n) for n in range(5)] + [("o/b", n) for n in range(10, 14)]


@pytest.mark.parametrize("breaks_after", ["write_records", "record_counts"])
def test_a_batch_that_failed_writes_the_same_rows_again(spark, tmp_path, monkeypatch, breaks_after):
    job = Job(spark, tmp_path)
    job.mappings = [ONE]
    job.add("o/a", "1.jsonl", [1, 1, 2, 3])
    job.run()
    job.add("o/a", "2.jsonl", [3, 4, 4, 5])
    real = getattr(domain_stream, breaks_after)

    def broken(*args, **kwargs):
        real(*args, **kwargs)
        raise OSError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(domain_stream, breaks_after, broken)
        with pytest.raises(Exception, match="stopped"):
            job.run()
    job.run()
    assert job.written() == [("o/a", n) for n in range(1, 6)]
    assert [(r.taken, r.duplicates, r.written) for r in counters(spark, job.checkpoint).collect()] == [(8, 3, 5)]


def test_output_of_other_runs_counts(spark, tmp_path):
    first = Job(spark, tmp_path, "cp1")
    first.mappings = [ONE]
    first.add("o/a", "1.jsonl", range(4))
    first.run()
    second = Job(spark, tmp_path, "cp2")
    second.mappings, second.time = [ONE], 500
    second.add("o/a", "2.jsonl", range(2, 6))
    second.run(max_files=1)
    assert second.written() == [("o/a", n) for n in range(6)]


def test_datasets_are_named_by_their_folders(spark):
    paths = ["file:///x/data/o/a%20b+c/default/f.jsonl", "file:///x/data/o/x/f.jsonl"]
    rows = spark.createDataFrame([(p,) for p in paths], f"{ORD_FILE} string")
    assert [r[0] for r in rows.select(dataset_of("/x/data/")).collect()] == ["o/a b+c", "o/x"]
    assert [r[0] for r in rows.select(dataset_of("file:/x/data", 1)).collect()] == ["o", "o"]


def test_a_listener_reports_batches(spark, tmp_path):
    seen = []
    listener = ProgressListener(lambda *report: seen.append(report))
    spark.streams.addListener(listener)
    try:
        job = Job(spark, tmp_path)
        job.mappings = [ONE]
        job.add("o/a", "1.jsonl", range(4))
        job.run()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    finally:
        spark.streams.removeListener(listener)
    assert [(batch, rows > 0) for _, batch, rows, _ in seen if rows] == [(0, True)]
