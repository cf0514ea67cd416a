"""The files, and so the batches, of a domain stream do not grow in number with the part files of its tables."""

import json
import os
from glob import glob

from chatnorm.queries import all_queries, jobs

PARTS = 24


def test_more_part_files_make_no_more_batches(spark, tmp_path, monkeypatch):
    documents = [(f"text {i}", "en", "web", i) for i in range(PARTS)]
    frame = spark.createDataFrame(documents, "text string, lang string, source string, doc_id bigint")
    frame.repartitionByRange(PARTS, "doc_id").write.parquet(f"{tmp_path}/documents.parquet")
    turns = [(c, t, r, f"{r} {c}") for c in range(3) for t, r in enumerate(["user", "assistant"] * 2)]
    conversations = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    conversations.write.parquet(f"{tmp_path}/conversations.parquet")
    found = []

    def listed(spark, folder, *args, **kwargs):
        os.makedirs(f"{folder}/out", exist_ok=True)
        found.append({name: glob(f"{folder}/data/org/{name}/default/train/*.jsonl") for name in ("docs", "chats", "pairs")})

    monkeypatch.setattr(jobs, "shared_folder", lambda spark: f"{tmp_path}/job")
    monkeypatch.setattr(jobs, "_domain_stream", listed)
    # Each part file is a partition of its own.
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        all_queries()["stream_domain"](spark, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(found) == 2 and len(found[0]["docs"]) <= 16
    rows = {name: [json.loads(line) for f in files for line in open(f)] for name, files in found[1].items()}
    assert sorted(r["text"] for r in rows["docs"]) == sorted(d[0] for d in documents)
    assert (len(rows["chats"]), len(rows["pairs"])) == (3, 6)
