"""Queries on tables that are folders of part files, as Spark writes them, and on tables of one file."""

import os
import shutil

import duckdb
import pytest

from chatnorm.queries import all_queries, all_sql
from oracle import differences

ROWS = [
    (1, "one", "en", "web", 3), (2, "two", "fr", "web", 3), (3, "three", "de", "book", 5), (4, "four", "es", "web", 4),
    (5, "one", "en", "web", 3), (6, "two", "fr", "web", 3), (7, "seven", "es", "web", 5),
]


@pytest.mark.parametrize("parts", [1, 3])
@pytest.mark.parametrize("name", ["stream_dedup", "stream_incremental_dedup"])
def test_a_stream_reads_all_files_of_a_table(spark, tmp_path, name, parts):
    path = f"{tmp_path}/documents.parquet"
    documents = spark.createDataFrame(ROWS, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    documents.repartition(parts).write.parquet(path if parts > 1 else f"{tmp_path}/written")
    if parts == 1:
        (file,) = [f for f in os.listdir(f"{tmp_path}/written") if f.startswith("part-")]
        shutil.copy(f"{tmp_path}/written/{file}", path)
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}{'/*.parquet' if parts > 1 else ''}'")
    mine = all_queries()[name](spark, str(tmp_path)).toPandas()
    assert differences(mine, connection.execute(all_sql()[name]).df()) is None
