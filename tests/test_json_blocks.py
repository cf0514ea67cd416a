"""JSON documents cut into objects by blocks against the reader that takes a document as one row."""

import json
import random

import pytest
from pyspark.sql import functions as F

from chatnorm.sources import json_blocks
from chatnorm.sources import readers as R
from chatnorm.types import JSON_ROW, ORD_BLOCK, ORD_FILE, ORD_ROW


@pytest.fixture
def small_blocks(spark):
    settings = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def value(r, depth=0):
    kind = r.randrange(9 if depth < 4 else 5)
    if kind == 0:
        return r.choice([1, -2.5, True, None])
    if kind < 5:
        return "".join(r.choice(['"', "\\", "}", "{", "[", "]", "é", "a", "\n", ", ", '": [']) for _ in range(r.randrange(30)))
    if kind < 7:
        return [value(r, depth + 1) for _ in range(r.randrange(4))]
    return {r.choice("abcde}{"): value(r, depth + 1) for _ in range(r.randrange(4))}


def item(r):
    return r.choice([lambda: {"k": r.randrange(10**6), "v": value(r)}, lambda: value(r), lambda: [[{"no": 1}], {"no": 2}], lambda: {}])()


def document(seed):
    r = random.Random(seed)
    items = [item(r) for _ in range(r.randrange(0, 60))]
    kind = seed % 6
    if kind < 2:
        return items
    if kind == 2:
        return {"n": 1, "meta": {"x": {"no": 1}, "y": [{"no": 2}]}, "rows": items, "after": {"z": {"no": 3}}, "other": [{"no": 4}]}
    if kind == 3:  # of several lists, the one under the first known key
        return {"examples": [{"no": 1}], "x": [{"no": 2}], "data": items, "rows": [{"no": 3}] * 5}
    if kind == 4:
        return {"data": {"no": 1}, "items": [1], "n": items}
    return {"k": items, "long": "}" * r.randrange(900), "data": 5}


def test_blocks_give_the_objects_of_the_single_row_reader(spark, tmp_path, small_blocks):
    paths = []
    for seed in range(24):
        paths.append(str(tmp_path / f"f{seed}.json"))
        text = json.dumps(document(seed), ensure_ascii=seed % 2 == 0, indent=[None, 1][seed % 4 > 1])
        with open(paths[-1], "w", encoding="utf-8") as f:
            f.write(("" if seed % 5 else " \n") + text + "\n" * (seed % 3))
    whole = R.json_documents(spark.read.text(paths, wholetext=True).withColumn("f", F.col("_metadata.file_path")), keep=["f"])
    expected = sorted((r.f, json.dumps(json.loads(r[JSON_ROW]))) for r in whole.collect())
    rows = json_blocks.json_objects(spark, paths, R.WRAPPER_KEYS)
    found = rows.collect()
    assert sorted((r[ORD_FILE], json.dumps(json.loads(r.text))) for r in found) == expected
    assert len({(r[ORD_FILE], r[ORD_BLOCK], r[ORD_ROW]) for r in found}) == len(found)
    assert max(r[ORD_BLOCK] for r in found) > 2000
    for path in (paths[0], paths[1], paths[2], paths[3]):
        ordered = json_blocks.json_objects(spark, [path], R.WRAPPER_KEYS).orderBy(ORD_BLOCK, ORD_ROW).collect()
        in_order = [r[JSON_ROW] for r in whole.where(F.col("f").endswith(path)).orderBy("__item").collect()]
        assert [json.loads(r.text) for r in ordered] == [json.loads(t) for t in in_order]


def test_large_documents_are_cut_and_small_ones_are_not(spark, tmp_path, small_blocks):
    big, small = tmp_path / "big.json", tmp_path / "small.json"
    big.write_text(json.dumps({"data": [{"k": i, "t": "}\n" * (i % 40)} for i in range(300)]}))
    small.write_text(json.dumps([{"k": 1000, "t": ""}]))
    rows = R.read_json(spark, [str(big), str(small)])
    assert rows.select(ORD_BLOCK).distinct().count() > 8
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin [__file" not in plan.split("Union")[0]
    key = F.get_json_object(JSON_ROW, "$.k").cast("int")
    assert sorted(r[0] for r in rows.select(key).collect()) == [*range(300), 1000]
    ordered = rows.where(F.col(ORD_FILE).contains("big")).orderBy(ORD_BLOCK, ORD_ROW).select(key.alias("k")).collect()
    assert [r.k for r in ordered] == list(range(300))
    assert R.read_json(spark, [str(big)], first_rows=True).count() == 300


@pytest.mark.parametrize("end", ["", "]", '{"a": "', "]]", "}]"])
def test_documents_that_do_not_end_give_nothing(spark, tmp_path, small_blocks, end):
    path = tmp_path / "f.json"
    path.write_text(json.dumps([{"k": i} for i in range(200)])[:-1] + end)
    assert json_blocks.json_objects(spark, [str(path)], R.WRAPPER_KEYS).count() == (200 if end == "]" else 0)


def test_texts_take_linear_time():
    for unit in ('"', "\\", '\\"', "[", "{", '""', "]", '"a": ['):
        for inside in (False, True):
            json_blocks.change(unit * (2_000_000 // len(unit)), inside)
