"""Row cap and samples per dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.session import written


def cap_rows(
    df: DataFrame, cap: int, group: list[str], block: list[str], row: str, taken: DataFrame | None = None
) -> DataFrame:
    """First ``cap`` rows of each group in (block, row) order.

    ``block`` columns cut a group into runs of bounded length, ``row`` orders the rows of a run.
    A group may be far larger than one task: rows are counted per block, the block in which the
    cap is reached is found on those counts, and only that block is ranked. The last kept position
    per group (one short row each) then filters the rows in place, without a shuffle of them
    while that table is small enough to broadcast.

    ``taken`` (group columns and ``taken``) has rows of the groups that count already.
    """
    if cap <= 0:
        return df.where(F.lit(False))
    if taken is not None:
        df = df.join(taken.where(F.col("taken") >= cap), group, "left_anti")
    counts = df.groupBy(*group, *block).agg(F.count(F.lit(1)).alias("__n"))
    so_far = F.sum("__n").over(
        Window.partitionBy(*group).orderBy(*block).rowsBetween(Window.unboundedPreceding, 0)
    )
    if taken is not None:
        counts = counts.join(taken, group, "left")
        so_far = so_far + F.coalesce("taken", F.lit(0))
    edges = written(
        counts.withColumn("__upto", so_far)
        .where((F.col("__upto") >= cap) & (F.col("__upto") - F.col("__n") < cap))
        .select(*group, *block, (F.lit(cap) - F.col("__upto") + F.col("__n")).alias("__need"))
    )
    in_edge = df.select(*group, *block, row).join(edges, [*group, *block])
    position = F.struct(*block, row)
    last = written(
        in_edge.withColumn(
            "__rank", F.row_number().over(Window.partitionBy(*group).orderBy(row))
        )
        .where(F.col("__rank") == F.col("__need"))
        .select(*group, position.alias("__last"))
    )
    joined = df.join(last, group, "left")
    return joined.where(F.col("__last").isNull() | (position <= F.col("__last"))).drop("__last")


def sample_rows(df: DataFrame, n: int, group: list[str], order: list[str]) -> DataFrame:
    """First ``n`` rows per group of a table that holds many datasets (``n`` is small)."""
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("sample_pos", rank).where(F.col("sample_pos") <= n)
