"""What the block-wise readers share: lines with their place, states of blocks, records that go over blocks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.session import file_system
from ..types import ORD_BLOCK, ORD_FILE, ORD_ROW


def file_length(spark: SparkSession, path: str) -> int:
    fs, hadoop_path = file_system(spark, path)
    return fs.getFileStatus(hadoop_path).getLen()


def input_block(spark: SparkSession) -> int:
    """Bytes of a file that one task reads at most."""
    return _bytes(spark, spark.conf.get("spark.sql.files.maxPartitionBytes"))


def _bytes(spark: SparkSession, text: str) -> int:
    """A size as settings write it (``64m``, ``10MB``, ``-1``)."""
    if text.strip().startswith("-"):
        return -1
    return spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text.strip())


#: Bytes that a row of block states takes at most, beside the name of its file.
STATE_BYTES = 200


def beside_texts(spark: SparkSession, states: DataFrame, paths: list[str]) -> DataFrame:
    """One short row per block, to be joined to the texts of the blocks: broadcast as long as the number of blocks,
    which follows from the lengths of the files, keeps them below ``autoBroadcastJoinThreshold``. Else the planner
    joins by shuffling."""
    most = _bytes(spark, spark.conf.get("spark.sql.autoBroadcastJoinThreshold"))
    block = input_block(spark)
    size = sum((file_length(spark, p) // block + 1) * (STATE_BYTES + 2 * len(p)) for p in paths)
    return F.broadcast(states) if size <= most else states


def block_lines(spark: SparkSession, paths: list[str], separator: str) -> DataFrame:
    """``file, block, row, size, value``: the texts between separators, in order within a block; bytes of the file."""
    return spark.read.text(paths, lineSep=separator).select(
        F.col("_metadata.file_path").alias(ORD_FILE),
        F.col("_metadata.file_block_start").alias(ORD_BLOCK),
        F.monotonically_increasing_id().alias(ORD_ROW),
        F.col("_metadata.file_size").alias("size"),
        "value",
    )


def block_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], dict[str, pa.Array]]]:
    """Consecutive rows of one block: ``(file, block)`` and their columns. A block may come in several runs."""
    for batch in batches:
        columns = dict(zip(batch.schema.names, batch.columns, strict=True))
        files, blocks = columns[ORD_FILE], columns[ORD_BLOCK]
        start = 0
        while start < batch.num_rows:
            key = files[start].as_py(), blocks[start].as_py()
            low, high = start, batch.num_rows - 1
            while low < high:  # rows of a block are neighbours: halve towards its last one
                middle = (low + high + 1) // 2
                if (files[middle].as_py(), blocks[middle].as_py()) == key:
                    low = middle
                else:
                    high = middle - 1
            yield key, {name: column.slice(start, low + 1 - start) for name, column in columns.items()}
            start = low + 1


def block_states(ends: DataFrame) -> DataFrame:
    """Adds ``begins, stops`` to one row per block: whether it begins and ends inside quotes.

    ``if_outside`` and ``if_inside`` say how it ends for either beginning. A block either ends the same way for
    both, or keeps the beginning, or turns it round. So a block begins as the last one of the first kind before
    it ended (outside, at the start of a file), turned round once for each block in between that does so.
    """
    order = Window.partitionBy(ORD_FILE).orderBy(ORD_BLOCK)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    fixed = F.col("if_outside") == F.col("if_inside")
    turns = F.when(~fixed & F.col("if_outside"), 1).otherwise(0)
    turned = ends.withColumn("turned", F.sum(turns).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    last = F.last(F.when(fixed, F.struct("if_outside", "turned")), ignorenulls=True).over(before)
    since = F.coalesce(F.sum(turns).over(before), F.lit(0)) - F.coalesce(last["turned"], F.lit(0))
    begins = F.coalesce(last["if_outside"], F.lit(False)).cast("int").bitwiseXOR((since % 2).cast("int")) == 1
    stops = F.when(F.col("begins"), F.col("if_inside")).otherwise(F.col("if_outside"))
    return turned.withColumn("begins", begins).withColumn("stops", stops).drop("turned")


def parts_of_records(pieces: DataFrame, joint: str) -> DataFrame:
    """``file, block, row, text`` of records whose ``pieces`` lie in several blocks, with the place of the first.

    A record begins with a piece of kind ``tail`` and goes on with those of kind ``head`` in the blocks behind it.
    Heads before the first tail of a file belong to nothing.
    """
    order = Window.partitionBy(ORD_FILE).orderBy(ORD_BLOCK, ORD_ROW)
    tails = F.sum(F.when(F.col("kind") == "tail", 1).otherwise(0)).over(order)
    parts = F.array_sort(F.collect_list(F.struct(ORD_BLOCK, ORD_ROW, "text")))
    joined = pieces.withColumn("record", tails).where("record > 0").groupBy(ORD_FILE, "record").agg(parts.alias("parts"))
    return joined.select(
        ORD_FILE,
        F.col("parts")[0][ORD_BLOCK].alias(ORD_BLOCK),
        F.col("parts")[0][ORD_ROW].alias(ORD_ROW),
        F.array_join(F.transform("parts", lambda p: p["text"]), joint).alias("text"),
    )
