"""Mixing sources to target weights by entropy balancing. DataFrame operations only.

Documents get rates ``exp(lambda * size / mean size)``, at most ``most_copies``: of all rates that give a
source its target number of words, those that lie nearest to equal ones in the sense of entropy. Each
source's lambda solves the convex dual; Newton steps for all sources at once run as aggregations over
the cells (source, size) with their numbers of documents, safeguarded by a bracket. Rates of a cell are
equal, so rounding to copies goes by cells first (systematic sampling along growing size, which keeps
words near their expectation, then single copies moved where that brings the words nearer the target)
and then by rank within the cell, in the order of a hash of the id.

A cell may hold a third of all rows: ranks are taken in ``BUCKETS`` parts of a cell, whose counts are
added up before.

Defined results: a null text has size 0; documents of size 0 are taken 0 times. A null source is a source
of its own and comes last. Rows that repeat an id, source and size are as many documents; which of them
is taken when only some are doesn't matter, as they are equal. Null ids rank first. Other columns are
not looked at. Sources without words have target 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import table, written

# Weights of the sources in code-point order, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
BUCKETS = 1024
_WORD = r"[^\x20\x09-\x0D]+"
TOLERANCE = 1e-6
STEPS = 60


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size``: number of words of the whole text."""
    size = F.coalesce(F.regexp_count("text", F.lit(_WORD)), F.lit(0)).cast("long")
    return docs.select("doc_id", "source", size.alias("size"))


def _key() -> Column:
    """A source as a value that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))


def targets(
    sizes: DataFrame, total_share: float = 1.5, most_copies: float = 2.0, weights: tuple[float, ...] = WEIGHTS
) -> DataFrame:
    """``source, key, docs, source_size, target`` of each source of ``source, size, n``.

    A source's target is its weight times a common level, at most ``most_copies`` times its size. The
    sources that reach their most come first in the order of most per weight, so the level follows
    from running sums.
    """
    sources = sizes.groupBy("source").agg(F.sum("n").alias("docs"), F.sum(F.col("size") * F.col("n")).alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    listed = F.array(*map(F.lit, weights))
    sources = sources.withColumn("weight", F.element_at(listed, (place % len(weights) + 1).cast("int")))
    most = F.lit(most_copies) * F.col("source_size")
    by_most = Window.orderBy(most / F.col("weight"), F.col("source").asc_nulls_last())
    before, everything = by_most.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = F.lit(total_share) * F.sum("source_size").over(everything) - F.coalesce(F.sum(most).over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    sources = sources.withColumn("most", most).withColumn("level", left / open_weight)
    is_full = F.col("most") <= F.col("level") * F.col("weight")
    level = F.max(F.when(~is_full, F.col("level"))).over(everything)
    target = F.when(is_full, F.col("most")).otherwise(level * F.col("weight"))
    return sources.select("source", _key().alias("key"), "docs", "source_size", target.cast("double").alias("target"))


def rates(cells: DataFrame, sources: DataFrame, most_copies: float = 2.0) -> DataFrame:
    """``key, lambda, full`` of each source with words: Newton's iterations on the dual."""
    smallest = cells.groupBy("key").agg(F.min("size").alias("smallest"))
    state = sources.where("source_size > 0").join(smallest, "key")
    mean = F.col("source_size") / F.col("docs")
    share, least = F.col("target") / F.col("source_size"), F.col("smallest") / mean
    state = state.select(
        "key",
        "target",
        mean.alias("mean"),
        (F.col("target") >= most_copies * F.col("source_size") * (1 - 1e-12)).alias("full"),
        F.when(share < 1, F.log(share) / least).otherwise(0.0).alias("low"),
        (F.log(F.lit(most_copies)) / least).alias("high"),
        F.lit(0.0).alias("lambda"),
        F.lit(1.0).alias("gap"),
    )
    state = written(state)
    for _ in range(STEPS):
        x = F.col("size") / F.col("mean")
        tilt = F.exp(F.least(F.col("lambda") * x, F.lit(50.0)))
        words = F.col("n") * F.col("size")
        sums = (
            cells.join(state.select("key", "mean", "lambda"), "key")
            .groupBy("key")
            .agg(
                F.sum(words * F.least(tilt, F.lit(most_copies))).alias("taken"),
                F.sum(F.when(tilt < most_copies, words * x * tilt).otherwise(0.0)).alias("slope"),
            )
        )
        over = F.col("taken") - F.col("target")
        low = F.when(over < 0, F.greatest("low", "lambda")).otherwise(F.col("low"))
        high = F.when(over > 0, F.least("high", "lambda")).otherwise(F.col("high"))
        newton = F.col("lambda") - over / F.col("slope")
        inside = (F.col("slope") > 0) & (newton > F.col("new_low")) & (newton < F.col("new_high"))
        state = written(
            state.join(sums, "key")
            .withColumns({"new_low": low, "new_high": high})
            .select(
                "key",
                "target",
                "mean",
                "full",
                F.col("new_low").alias("low"),
                F.col("new_high").alias("high"),
                F.when(over == 0, F.col("lambda"))
                .when(inside, newton)
                .otherwise((F.col("new_low") + F.col("new_high")) / 2)
                .alias("lambda"),
                (F.abs(over) / F.col("target")).alias("gap"),
            )
        )
        worst = state.where("NOT full").agg(F.max("gap")).first()[0]
        if worst is None or worst < TOLERANCE:
            break
    return state.select("key", "mean", "lambda", "full", F.col("target").alias("wanted"))


def cell_copies(cells: DataFrame, solved: DataFrame, most_copies: int = 2, moves: int = 4) -> DataFrame:
    """``key, size, n, copies``: copies that each cell (source, size, n) takes in all."""
    rate = F.when(F.col("full"), F.lit(float(most_copies))).otherwise(
        F.least(F.lit(float(most_copies)), F.exp(F.least(F.col("lambda") * F.col("size") / F.col("mean"), F.lit(50.0))))
    )
    up_to = Window.partitionBy("key").orderBy("size").rowsBetween(Window.unboundedPreceding, 0)
    cells = (
        cells.join(solved, "key")
        .withColumn("rate", rate)
        .withColumn("rest", F.col("rate") - F.floor("rate"))
        .withColumn("extra_sum", F.floor(F.round(F.sum(F.col("n") * F.col("rest")).over(up_to), 6) + 0.5))
        .withColumn("extra", F.col("extra_sum") - F.coalesce(F.lag("extra_sum").over(Window.partitionBy("key").orderBy("size")), F.lit(0)))
        .select("key", "wanted", "size", "n", (F.col("n") * F.floor("rate") + F.col("extra")).cast("long").alias("copies"))
    )
    for _ in range(moves):
        cells = written(cells)
        missing = cells.groupBy("key", "wanted").agg(F.sum(F.col("copies") * F.col("size")).alias("taken"))
        missing = missing.select("key", (F.col("wanted") - F.col("taken")).alias("missing"))
        open_ = F.when(F.col("missing") > 0, F.col("copies") < most_copies * F.col("n")).otherwise(F.col("copies") > 0)
        off = F.abs(F.col("size") - F.abs("missing"))
        best = (
            cells.join(missing, "key")
            .where(open_ & (off < F.abs("missing")))
            .groupBy("key")
            .agg(F.min(F.struct(off.alias("off"), "size", F.signum("missing").alias("by"))).alias("m"))
            .select("key", F.col("m.size").alias("size"), F.col("m.by").cast("long").alias("by"))
        )
        cells = cells.join(best, ["key", "size"], "left").select(
            "key", "wanted", "size", "n", (F.col("copies") + F.coalesce("by", F.lit(0))).alias("copies")
        )
    return written(cells).select("key", "size", "n", "copies")


def mix(sizes: DataFrame, total_share: float = 1.5, most_copies: int = 2) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies`` of each row of ``doc_id, source, size``."""
    rows = written(sizes.withColumn("key", _key()).withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS))))
    parts = written(rows.groupBy("source", "key", "size", "bucket").agg(F.count("*").alias("n")))
    by_size = written(parts.groupBy("source", "key", "size").agg(F.sum("n").alias("n")))
    sources = written(targets(by_size, total_share, most_copies))
    cells = by_size.where("size > 0").select("key", "size", "n")
    copies = cell_copies(cells, rates(cells, sources, most_copies), most_copies)

    # Copies of a cell: each document takes the whole part, the first ones in hash order one more.
    earlier = Window.partitionBy("key", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    shares = (
        parts.where("size > 0")
        .select("key", "size", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier"))
        .join(copies, ["key", "size"])
        .select(
            "key",
            "size",
            "bucket",
            F.floor(F.col("copies") / F.col("n")).alias("each"),
            (F.col("copies") % F.col("n") - F.col("earlier")).alias("more"),
        )
    )
    rank = F.row_number().over(Window.partitionBy("key", "size", "bucket").orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id"))
    ranked = rows.where("size > 0").withColumn("rank", rank)
    taken = ranked.join(shares, ["key", "size", "bucket"]).select(
        "doc_id", "key", "source", "size", (F.col("each") + (F.col("rank") <= F.col("more")).cast("long")).alias("copies")
    )
    empty = rows.where("size = 0").select("doc_id", "key", "source", "size", F.lit(0).cast("long").alias("copies"))
    return (
        taken.unionByName(empty)
        .join(sources.select("key", "source_size", "target"), "key")
        .select("doc_id", "source", "size", "source_size", "target", "copies")
    )


def mixed(docs: DataFrame) -> DataFrame:
    """``docs`` with each row as often as the mix takes it, all columns as they are."""
    taken = mix(sized(docs)).groupBy("doc_id", "source", "size").agg(F.max("copies").alias("copies")).where("copies > 0")
    taken = written(taken.select(F.col("doc_id").alias("_i"), _key().alias("_k"), F.col("size").alias("_n"), "copies"))
    size = F.coalesce(F.regexp_count("text", F.lit(_WORD)), F.lit(0)).cast("long")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), F.col("doc_id").alias("_id"), _key().alias("_key"), size.alias("_size"))
    same = F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_key") == F.col("_k")) & (F.col("_size") == F.col("_n"))
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    # ``taken`` has a row for each document, so it is never one to broadcast, however few there are.
    return rows.join(taken.hint("merge"), same).select("_row", times.alias("_times")).select("_row.*")


def op5_mixing(spark, sf_dir: str) -> DataFrame:
    mixed = mix(sized(table(spark, sf_dir, "documents")))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")
