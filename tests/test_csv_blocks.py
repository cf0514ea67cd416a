"""The block-wise CSV reader against Spark's reader, which reads a file by one task."""

import random

import pytest
from pyspark.sql import functions as F

from chatnorm.sources import csv_blocks
from chatnorm.sources import readers as R
from chatnorm.types import ORD_BLOCK, ORD_FILE, ORD_ROW


@pytest.fixture
def small_blocks(spark):
    settings = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def cell(r):
    return [
        "", '""', f"plain {r.randrange(99)}", '"' + 'multi\nline, "" q\n' * r.randrange(1, 9) + '"', 'mid"quote', '"a"b', '"x,y"',
        '"' + "long\n" * r.randrange(200) + '"', '"end ""quoted"""', " blank ", '" q "" "',
    ][r.randrange(11)]


def text_of(seed, line_end, everywhere):
    r = random.Random(seed)
    rows = [",".join(cell(r) for _ in range(3)) for _ in range(r.randrange(1, 70))]
    text = ("﻿" if seed % 3 == 0 else "") + 'a,"b\nb",c' + line_end + line_end.join(rows)
    text += line_end * (seed % 4)
    text = text.replace(line_end, line_end * 2, seed % 5)
    if seed % 7 == 0:
        text += '\n"open, to the end\n of file'
    return text.replace("\r\n", "\n").replace("\n", line_end) if everywhere else text


@pytest.mark.parametrize("line_end, everywhere", [("\n", True), ("\r\n", True), ("\r\n", False)])
def test_blocks_give_the_rows_of_the_single_task_reader(spark, tmp_path, small_blocks, line_end, everywhere):
    paths = []
    for seed in range(8):
        paths.append(str(tmp_path / f"f{seed}.csv"))
        with open(paths[-1], "w", newline="") as f:
            f.write(text_of(seed, line_end, everywhere))
    blocks = 0
    for path in paths:
        whole = spark.read.options(**R.CSV_OPTIONS, multiLine=True).csv(path)
        columns = [f"`{c}`" for c in whole.columns]
        rows = csv_blocks.read_csv_blocks(spark, [path], whole.columns, R.CSV_OPTIONS)
        mine = rows.orderBy(ORD_BLOCK, ORD_ROW).select(*columns).collect()
        assert list(map(tuple, mine)) == list(map(tuple, whole.collect()))
        blocks = max(blocks, rows.select(ORD_BLOCK).distinct().count())
    assert blocks > 5
    both = csv_blocks.read_csv_blocks(spark, paths, ["a", "b\nb", "c"], R.CSV_OPTIONS)
    counts = {r[0].rsplit("/", 1)[-1]: r["count"] for r in both.groupBy(ORD_FILE).count().collect()}
    for path in paths:
        n = spark.read.options(**R.CSV_OPTIONS, multiLine=True).csv(path).count()
        assert counts.get(path.rsplit("/", 1)[-1], 0) == n


def test_one_file_is_read_by_many_tasks(spark, tmp_path, small_blocks):
    path = str(tmp_path / "big.csv")
    with open(path, "w") as f:
        f.write("k,t\n" + "".join(f'{i},"a\nb{i}"\n' for i in range(400)))
    rows = R.read_csv(spark, [path])
    assert rows.select(ORD_BLOCK).distinct().count() > 8
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert sorted((int(r.k), r.t) for r in rows.collect()) == [(i, f"a\nb{i}") for i in range(400)]
    assert rows.select(ORD_FILE, ORD_BLOCK, ORD_ROW).distinct().count() == 400
    ordered = rows.orderBy(ORD_BLOCK, ORD_ROW).select("k").collect()
    assert [int(r.k) for r in ordered] == list(range(400))
    first = R.read_csv(spark, [path], first_rows=True)
    assert [int(r.k) for r in first.limit(3).collect()] == [0, 1, 2]


def stepped(line, inside):
    """The same, character by character."""
    state = "in" if inside else "start"
    for c in line:
        if state == "in":
            state = "quote" if c == '"' else "in"
        elif state == "quote" and c == '"':
            state = "in"
        elif c == ",":
            state = "start"
        elif state == "start" and c == '"':
            state = "in"
        else:
            state = "plain"
    return state == "in"


def test_states_of_lines():
    r = random.Random(2)
    for _ in range(20_000):
        line = "".join(r.choice('",a ') for _ in range(r.randrange(12)))
        for inside in (False, True):
            assert csv_blocks.ends_inside(line, inside) == stepped(line, inside), line


def test_lines_take_linear_time():
    for unit in ('""', '"', ",", '",', '","', 'a"', '"a"b,'):
        for inside in (False, True):
            csv_blocks.ends_inside(unit * (2_000_000 // len(unit)), inside)
