"""The queries on large files write them by as many tasks as read the table."""

import duckdb
import pytest

from chatnorm.queries import all_queries, all_sql, jobs
from chatnorm.sources.readers import list_data_files
from oracle import differences


@pytest.mark.parametrize(("name", "files"), [("json_block_load", 12), ("csv_block_load", 6)])
def test_no_task_writes_the_whole_table(spark, tmp_path, monkeypatch, name, files):
    rows = [(k, f'text {k} "}}' + "é\n, " * (40000 if k == 5 else k), ["en", "fr", "it"][k % 3], "web", k) for k in range(60)]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    documents.repartition(6).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(jobs, "shared_folder", lambda _: f"{tmp_path}/work")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 27))  # a task for each part file
    try:
        mine = all_queries()[name](spark, str(tmp_path)).toPandas()
        assert list_data_files(spark, f"{tmp_path}/work").count() == files
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert differences(mine, connection.execute(all_sql()[name]).df()) is None


@pytest.mark.parametrize("name", ["json_block_load", "csv_block_load"])
def test_an_empty_table_gives_no_rows(spark, tmp_path, name):
    documents = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    assert all_queries()[name](spark, str(tmp_path)).count() == 0
