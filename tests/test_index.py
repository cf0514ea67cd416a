"""The fingerprint index: upkeep, loss of files, compaction, and plans that leave the history in place."""

import re
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from chatnorm.operators.dedup import fingerprint
from chatnorm.plans.generations import Generations
from chatnorm.sinks.writers import write_records
from chatnorm.sources import fingerprint_index
from chatnorm.sources.fingerprint_index import index_root, refresh
from chatnorm.sources.outputs import existing_fingerprints
from chatnorm.types import RECORD_COLUMNS


def records(spark, numbers):
    text = F.concat(F.lit('[{"role": "user", "content": "a\\n,""'), F.col("id").cast("string"), F.lit('"}]'))
    reasoning = F.when(F.col("id") % 3 == 0, F.lit("be\ncause"))
    return spark.createDataFrame([(i,) for i in numbers], "id bigint").select(
        text.alias("conversation"), F.lit("english").alias("language"), reasoning.alias("reasoning"),
        F.lit("{}").alias("metadata"), F.lit("d").alias("dataset_id"),
    )


def prints(df):
    return sorted(r[0] for r in df.select(F.lower(F.hex("fp"))).distinct().collect())


def expected(spark, numbers):
    rows = records(spark, numbers)
    return sorted(r[0] for r in rows.select(fingerprint(F.col("conversation"), F.col("reasoning"))).distinct().collect())


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_only_new_files_are_parsed(spark, tmp_path, monkeypatch, fmt):
    out, parsed = str(tmp_path / f"out.{fmt}"), []
    real = fingerprint_index._parsed
    monkeypatch.setattr(fingerprint_index, "_parsed", lambda s, files, *a: parsed.append(len(files)) or real(s, files, *a))
    assert refresh(spark, out, fmt) is None
    for run, numbers in enumerate((range(10), range(5, 20), range(20, 25))):
        write_records(records(spark, numbers).coalesce(1), fmt, out, out)
        index = refresh(spark, out, fmt, buckets=3)
        assert index.buckets == 3
        assert parsed == [1] * (run + 1)
    assert prints(index.rows) == expected(spark, range(25))
    assert prints(index.rows) == sorted(r.fp for r in existing_fingerprints(spark, out if fmt == "csv" else None, out if fmt != "csv" else None).collect())
    refresh(spark, out, fmt)
    assert parsed == [1, 1, 1]
    keys = spark.createDataFrame([(bytes.fromhex(x),) for x in expected(spark, range(20, 40))], "fp binary")
    assert prints(index.unseen(keys)) == expected(spark, range(25, 40))


def test_a_changed_or_missing_file_builds_the_index_anew(spark, tmp_path):
    out = str(tmp_path / "out.parquet")
    write_records(records(spark, range(4)).coalesce(1), "parquet", "", out)
    write_records(records(spark, range(4, 8)).coalesce(1), "parquet", "", out)
    refresh(spark, out, "parquet", buckets=2)
    victim = sorted(Path(out).glob("part-*"))[0]
    left = [r[0] for r in spark.read.parquet(str(sorted(Path(out).glob("part-*"))[1])).select(fingerprint(F.col("conversation"), F.col("reasoning"))).collect()]
    victim.unlink()
    assert prints(refresh(spark, out, "parquet").rows) == sorted(left)
    shutil.rmtree(out)
    write_records(records(spark, range(50, 53)), "parquet", "", out)
    assert prints(refresh(spark, out, "parquet").rows) == expected(spark, range(50, 53))


def test_compaction_leaves_one_file_per_bucket(spark, tmp_path):
    out = str(tmp_path / "out.parquet")
    for i in range(4):
        write_records(records(spark, range(i, i + 30)).coalesce(1), "parquet", "", out)
        index = refresh(spark, out, "parquet", buckets=2, compact_after=2)
    generations = Generations(spark, index_root(out))
    assert len(generations.complete()) == 2  # the current one and the one before it
    assert generations.count(f"{generations.current()}/buckets-2") <= 4
    assert prints(index.rows) == expected(spark, range(33))
    assert index.rows.count() < 4 * 30


def test_an_interrupted_append_is_made_up_for(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out.parquet")
    write_records(records(spark, range(4)), "parquet", "", out)
    refresh(spark, out, "parquet", buckets=2)
    write_records(records(spark, range(4, 8)), "parquet", "", out)
    real = fingerprint_index._append

    def broken(*args):
        real(*args)
        raise OSError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(fingerprint_index, "_append", broken)
        with pytest.raises(OSError):
            refresh(spark, out, "parquet")
        with pytest.raises(OSError):  # a first generation that was never published is not seen
            refresh(spark, str(out), "parquet")
    assert prints(refresh(spark, out, "parquet").rows) == expected(spark, range(8))


@pytest.mark.parametrize("buckets", [2, 4, 16])
def test_the_history_is_not_shuffled(spark, tmp_path, buckets):
    out = str(tmp_path / "out.parquet")
    write_records(records(spark, range(100)), "parquet", "", out)
    index = refresh(spark, out, "parquet", buckets=buckets)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keys = records(spark, range(50, 150)).select(F.unhex(fingerprint(F.col("conversation"), F.col("reasoning"))).alias("fp"))
        new = index.unseen(keys.groupBy("fp").agg(F.count("*").alias("n")))
        plan = new._jdf.queryExecution().executedPlan().toString()
        assert f"SelectedBucketsCount: {buckets} out of {buckets}" in plan
        above = operators_above_history(plan)
        assert "SortMergeJoin" in above[-1] and not any("Exchange" in line for line in above), above
        # The keys are aggregated before they meet the history.
        assert plan.index("SortMergeJoin") < plan.index("HashAggregate")
        assert new.count() == 50
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def operators_above_history(plan):
    """Operators from the bucketed scan up to the join."""
    lines = [line for line in plan.splitlines() if re.match(r"[ :]*[+:]- ", line)]
    depth_of = lambda line: len(line) - len(line.lstrip(" +-:"))
    scan = next(i for i, line in enumerate(lines) if "SelectedBucketsCount" in line)
    found, depth = [], depth_of(lines[scan])
    for line in reversed(lines[:scan]):
        if depth_of(line) < depth:
            depth = depth_of(line)
            found.append(line)
            if "Join" in line:
                break
    return found


def test_generations_show_whole_ones_only(spark, tmp_path):
    generations = Generations(spark, str(tmp_path / "g"))
    assert generations.current() is None
    first = generations.new()
    spark.range(3).write.parquet(f"{first}/t")
    assert generations.current() is None
    generations.publish(first)
    assert generations.current() == first
    left_over = generations.new()
    spark.range(4).write.parquet(f"{left_over}/t")
    assert generations.current() == first
    made = []
    for _ in range(3):
        made.append(generations.new())
        spark.range(5).write.parquet(f"{made[-1]}/t")
        generations.publish(made[-1])
        generations.clean()
    assert generations.current() == made[-1]
    assert [f"{generations.root}/{n}" for n in generations.complete()] == made[-2:]
    assert not Path(left_over).exists()


def test_record_columns_are_those_of_the_output(spark):
    assert records(spark, [1]).columns == RECORD_COLUMNS
