"""What each of five filters removes under every order of applying them.

Every document gets the mask of the filters it fails. Its removal step under an order is the first filter of
the order that is in the mask. In lexicographic order, the orders that begin with a given prefix are
consecutive: a prefix of length s covers an interval of (5 - s)! ranks, which begins at the rank that its
Lehmer digits give. A mask is removed at step s by the prefixes whose last filter is in the mask and whose
others are not. So the number of documents of a mask is added at the lower ends of these intervals and
taken away at their upper ends, and a prefix sum over the 120 ranks gives what each step of each order removes.
Documents never meet orders: only the counts of at most 32 masks a part do.

Copies are found by digest. Equal texts share the mask of the other filters, so documents are counted by
(digest, part, mask, labels) before anything else, and a text that a third of all rows hold is a few rows a task.

Defined results: a null text is empty, a null lang is the part ``''``. A row with a null id has no label,
is no copy of anything, and makes no row a copy. Rows that repeat an id and text are as many documents, none of
them a copy of another. Of several labels of an id, the largest counts; null labels are 0. An empty table gives
no rows. Other columns are not looked at.
"""

from __future__ import annotations

import itertools
from math import factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written

FILTERS = "ABCDE"
#: Parts that rows without an id are dealt over, as they have no key to be joined by.
SALTS = 1024
_BLANKS = r"[\x20\x09-\x0D]+"


def intervals(filters: str = FILTERS) -> list[tuple[int, int, int, int]]:
    """``mask, step, low, high``: ranks of the orders that remove a mask (bit i: filter i) at a step (from 1)."""
    n, found = len(filters), []
    for step in range(1, n + 1):
        width = factorial(n - step)
        for prefix in itertools.permutations(range(n), step):
            left, low = list(range(n)), 0
            for place, item in enumerate(prefix):
                low += left.index(item) * factorial(n - 1 - place)
                left.remove(item)
            free = [i for i in range(n) if i not in prefix]
            for chosen in itertools.product((0, 1), repeat=len(free)):
                mask = 1 << prefix[-1] | sum(bit << i for bit, i in zip(chosen, free, strict=True))
                found.append((mask, step, low, low + width))
    return found


def failures(docs: DataFrame) -> DataFrame:
    """``doc_id, part, digest, mask``: the filters A to D that a text fails, as bits."""
    text = F.coalesce("text", F.lit(""))
    read = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), text.alias("text"))
    split = read.withColumn("words", F.array_remove(F.split("text", _BLANKS), ""))
    counted = split.select(
        "doc_id",
        "part",
        "text",
        F.size("words").cast("long").alias("n"),
        F.size(F.array_distinct("words")).cast("long").alias("different"),
    )
    failing = (
        F.col("n") < 200,
        100 * F.col("different") < 50 * F.col("n"),
        100 * F.regexp_count("text", F.lit("[A-Z]")).cast("long") > 3 * F.length("text").cast("long"),
        F.col("text").rlike("[#$%&*|]"),
    )
    mask = sum((F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(failing)), F.lit(0))
    return counted.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), mask.alias("mask"))


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: documents of each part by the filters A to E that they fail."""
    salt = F.when(F.col("doc_id").isNull(), 1 + F.pmod(F.xxhash64("digest"), F.lit(SALTS))).otherwise(0)
    rows = failures(docs).withColumn("salt", salt)
    rows = rows.groupBy("doc_id", "salt", "part", "digest", "mask").agg(F.count("*").alias("n"))
    rows = rows.withColumn("id", F.coalesce("doc_id", F.lit(0)))

    def flag(name: str) -> Column:
        return F.max(F.coalesce(F.col(name) == 1, F.lit(False))).alias(name)

    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("id")).agg(flag("quality"), flag("toxic"))
    known = known.withColumn("salt", F.lit(0).cast("long"))
    rows = rows.join(known, ["id", "salt"], "left")
    # Of rows with one digest, part, mask and labels: how many have the smallest id, and how many have none.
    keys = ["digest", "part", "mask", F.coalesce("quality", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("bad")]
    groups = rows.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        F.min("doc_id").alias("least"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))).alias("nameless"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "part", "n"))).alias("first"),
    )
    least = F.min("least").over(Window.partitionBy("digest"))
    firsts = F.when(F.col("least") == least, F.col("first")["n"]).otherwise(0)
    groups = groups.withColumn("passed", F.coalesce(firsts, F.lit(0)) + F.coalesce("nameless", F.lit(0)))
    copy = 1 << FILTERS.index("E")
    both = F.array(
        F.struct(F.col("mask").alias("mask"), F.col("passed").alias("n")),
        F.struct((F.col("mask") + copy).alias("mask"), (F.col("n") - F.col("passed")).alias("n")),
    )
    counted = groups.select("part", "good", "bad", F.explode(both).alias("x")).where("x.n > 0")
    return counted.groupBy("part", F.col("x.mask").alias("mask")).agg(
        F.sum("x.n").alias("n"),
        F.sum(F.when(F.col("good"), F.col("x.n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("bad"), F.col("x.n")).otherwise(0)).alias("toxic"),
    )


def _local(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    return spark.createDataFrame(pa.table(dict(zip(names, map(list, zip(*rows, strict=True)), strict=True))))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``."""
    spark, n = docs.sparkSession, len(FILTERS)
    counts = written(mask_counts(docs, labels))
    orders = ["".join(order) for order in itertools.permutations(FILTERS)]
    covered = _local(spark, intervals(), ["mask", "step", "low", "high"])
    sums = ("n", "good", "toxic")
    ends = F.array(
        F.struct(F.col("low").alias("rank"), *(F.col(c).alias(c) for c in sums)),
        F.struct(F.col("high").alias("rank"), *((-F.col(c)).alias(c) for c in sums)),
    )
    changes = counts.join(covered, "mask").select("part", "step", F.explode(ends).alias("x")).select("part", "step", "x.*")
    parts = counts.groupBy("part").agg(
        F.sum("n").alias("all"),
        F.array(*(F.sum(F.when(F.col("mask").bitwiseAND(1 << i) != 0, F.col("n")).otherwise(0)) for i in range(n))).alias("fails"),
        F.array(*(F.sum(F.when(F.col("mask") == 1 << i, F.col("n")).otherwise(0)) for i in range(n))).alias("alone"),
    )
    places = parts.select("part", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step")).select(
        "part", "step", F.explode(F.sequence(F.lit(0), F.lit(len(orders) - 1))).alias("rank")
    )
    for c in sums:
        places = places.withColumn(c, F.lit(0).cast("long"))
    changes = changes.where(F.col("rank") < len(orders)).unionByName(places).groupBy("part", "step", "rank").agg(
        *(F.sum(c).alias(c) for c in sums)
    )
    up_to = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    taken = changes.select("part", "step", "rank", *(F.sum(c).over(up_to).alias(c) for c in sums))
    earlier = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    taken = taken.withColumn("gone", F.sum("n").over(earlier))
    taken = taken.join(_local(spark, list(enumerate(orders)), ["rank", "filter_order"]), "rank").join(parts, "part")
    taken = taken.withColumn("place", F.expr(f"locate(substr(filter_order, step, 1), '{FILTERS}')"))
    return taken.select(
        "part",
        "filter_order",
        F.col("step").cast("int").alias("step"),
        (F.col("all") - F.col("gone")).alias("kept"),
        F.col("n").alias("removed"),
        (F.element_at("fails", F.col("place")) - F.col("n")).alias("redundant"),
        F.element_at("alone", F.col("place")).alias("unique_fails"),
        F.col("good").alias("good_lost"),
        F.col("toxic").alias("toxic_lost"),
        F.sum("n").over(Window.partitionBy("part", "place")).alias("shapley"),
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP12_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words FROM d),
least AS (SELECT t, min(doc_id) AS first FROM d GROUP BY t),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad
      FROM labels GROUP BY doc_id),
x AS (SELECT part, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad,
        CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
        || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
        || CASE WHEN 100 * length(regexp_replace(w.t, '[^A-Z]', '', 'g')) > 3 * length(w.t) THEN 'C' ELSE '' END
        || CASE WHEN regexp_matches(w.t, '[#$%&*|]') THEN 'D' ELSE '' END
        || CASE WHEN w.doc_id > first THEN 'E' ELSE '' END AS fails
      FROM w JOIN least USING (t) LEFT JOIN l ON l.doc_id = w.doc_id),
m AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(bad) AS bad FROM x GROUP BY part, fails),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
o AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
      FROM f a, f b, f c, f d, f e
      WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS f, substr(filter_order, 1, step - 1) AS before
      FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
r AS (SELECT part, filter_order, step, f,
        sum(CASE WHEN translate(fails, before || f, '') = translate(fails, before, '') OR translate(fails, before, '') <> fails
                 THEN 0 ELSE n END) AS removed,
        sum(CASE WHEN contains(fails, f) AND translate(fails, before, '') <> fails THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN fails = f THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN contains(fails, f) AND translate(fails, before, '') = fails THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN contains(fails, f) AND translate(fails, before, '') = fails THEN bad ELSE 0 END) AS toxic_lost,
        sum(CASE WHEN translate(fails, before || f, '') = fails THEN n ELSE 0 END) AS kept
      FROM m, s GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
  redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
  toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM r
"""
