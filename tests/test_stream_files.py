"""File streams of every format against the batch readers."""

import gzip
import json

import pytest

from chatnorm.sources import readers as R
from chatnorm.types import JSON_ROW


def lay_out(folder):
    folder.mkdir(parents=True)
    (folder / "a.jsonl").write_text('{"k": "1"}\n\nbroken\n{"k": "2"}\n')
    (folder / "A2.JSONL").write_text('{"k": "3"}\n')
    with gzip.open(folder / "z.jsonl.gz", "wt") as f:
        f.write('{"k": "4"}\n')
    (folder / "b.json").write_text(json.dumps([{"k": "5"}, 7, {"k": "6\n"}], indent=1))
    (folder / "B2.Json").write_text('{"items": [{"k": "7"}]}')
    (folder / "c.csv").write_text('k,v\n"8\n,""x""",1\n9,\n')
    (folder / "state.json").write_text('{"k": "no"}')
    (folder / "dataset_infos.json").write_text('[{"k": "no"}]')
    (folder / "_hidden.jsonl").write_text('{"k": "no"}\n')
    (folder / "other.txt").write_text('{"k": "no"}\n')


def drained(stream, tmp_path):
    out = str(tmp_path / "out")
    stream.writeStream.format("parquet").options(path=out, checkpointLocation=str(tmp_path / "cp")).trigger(
        availableNow=True
    ).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out)


@pytest.mark.parametrize("fmt", ["jsonl", "json", "csv", "parquet"])
def test_a_stream_gives_what_the_batch_reader_gives(spark, tmp_path, fmt):
    folder = tmp_path / "in"
    lay_out(folder)
    spark.createDataFrame([("10", 1.5)], "k string, w double").write.parquet(str(folder / "p"))
    paths = [r.path for r in R.list_data_files(spark, str(folder)).collect() if R.file_format(r.path) == fmt]
    batch = R.read_files(spark, paths)
    stream = R.stream_files(spark, str(folder), fmt, max_files=1)
    assert stream.schema.names == batch.schema.names
    value = [c for c in batch.columns if c not in R.ORDINAL]
    assert sorted(map(tuple, drained(stream, tmp_path).select(value).collect()), key=str) == sorted(
        map(tuple, batch.select(value).collect()), key=str
    )


def test_all_formats_in_one_stream(spark, tmp_path):
    folder = tmp_path / "in"
    lay_out(folder)
    spark.createDataFrame([("10", 1.5)], "k string, w double").write.parquet(str(folder / "p"))
    rows = drained(R.stream_dataset(spark, str(folder)), tmp_path).collect()
    assert sorted(json.loads(r[JSON_ROW])["k"] for r in rows) == sorted(
        ["1", "2", "3", "4", "5", "6\n", "7", '8\n,"x"', "9", "10"]
    )


def test_unknown_formats_are_refused(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for fmt in ("xml", "txt", "JSONL", ""):
        with pytest.raises(ValueError, match="unknown format"):
            R.stream_files(spark, str(tmp_path / "in"), fmt)


def test_a_csv_file_with_another_header_stops_the_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("k,v\n1,2\n")
    stream = R.stream_files(spark, str(folder), "csv")
    (folder / "b.csv").write_text("v,k\n2,1\n")
    with pytest.raises(Exception, match="b.csv"):
        drained(stream, tmp_path)
