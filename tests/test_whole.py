"""Queries on tables with values that the test data doesn't hold."""

import duckdb
import pytest

from chatnorm.queries import all_queries, all_sql
from oracle import differences

ROWS = [
    (1, "one", "en", "web", 3), (2, "two", "fr", "web", 3), (3, "three", "de", "book", 5), (4, "four", "es", "web", 4),
    (5, "five", "it", "book", 4), (6, "six", "pt", "web", 3), (7, "seven", None, "web", 5),
]


@pytest.mark.parametrize("name", ["split_union", "raw_file_load"])
def test_languages_beyond_the_four(spark, tmp_path, name):
    documents = spark.createDataFrame(ROWS, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    mine = all_queries()[name](spark, str(tmp_path)).toPandas()
    assert differences(mine, connection.execute(all_sql()[name]).df()) is None
    assert 5 in set(mine["doc_id"])
