"""Near duplicates by min-max hashing of word shingles.

A document's set holds its distinct shingles of five words. Under each of ``PERMUTATIONS`` random orders
of the shingles both the least and the greatest one are kept, so a hash evaluation gives two signature
values, each equal between two documents with a probability equal to the similarity of their sets. Each of
``BANDS`` bands takes ``BAND_ROWS`` of the values, no value twice, and puts documents into buckets; documents of
similarity 0.75 share none of the buckets with a probability of about 4e-6. Lower similarities than that are refused.
One bit of each value is kept as well: of a pair with the least similarity, more bits than a limit differ with a
probability below ``UNLIKELY``; of pairs of similarity 0.6, 99 of 100 exceed it, and of those that are half alike, as
texts that merely share a passage, nearly all. Of sets that are not much larger than ``MARK_BITS``, marks (a bit of a fixed
number for each shingle) bound the intersection from above, closely and without error, and rule out pairs a little
below the least similarity too. They are told apart before any text is read. Candidates are confirmed on their full sets.

Groups may hold a third of all rows. So documents with equal sets are one node (their smallest id), and
within a bucket candidates are not all pairs: first each member meets the one that shares most buckets with others, then only
members that are still in different components meet the next members, 32 times as many in each round,
until every member has been met or the bucket is one component; two that share several buckets meet in one of them. No link between components is lost
this way. A node that meets very many others is salted.

Tables that a step writes for the next ones are removed as soon as they have been read.

Defined results: null and empty texts, and such of white space alone, have no shingles, are linked with
nothing and form components of their own. With fewer than five words the whole sequence is the one
shingle. Null ids are returned with a null component and kept. Rows that repeat an id are one document
that has several texts, linked if any of them is. Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.session import remove_folder, shared_folder
from .common import mix64, slices, table, written

WORDS = 5
PERMUTATIONS = 512
BANDS = 64
BAND_ROWS = 6
#: How unlikely it may be that the signature bits rule a pair of the least similarity out.
UNLIKELY = 1e-6
#: Words of 64 signature bits, and the least similarity that the bands are made for.
BIT_WORDS = 2 * PERMUTATIONS // 64
#: Bits that the shingles of a set are marked in.
MARK_BITS = 2048
LEAST_PERCENT = 75
GROWTH = 32
#: Sets whose signatures a worker holds at a time.
SETS_AT_ONCE = 512
#: Characters of text that a worker takes apart at a time (a longer text alone).
SLICE = 1 << 18
SALT_ROWS = 256

_ODD = np.random.Generator(np.random.PCG64(20240731))
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACES = _ODD.integers(0, 1 << 63, WORDS + 1, np.uint64) * np.uint64(2) + np.uint64(1)
_SCALE = _ODD.integers(0, 1 << 31, PERMUTATIONS, np.uint32) * np.uint32(2) + np.uint32(1)
_SHIFT = _ODD.integers(0, 1 << 32, PERMUTATIONS, np.uint32)
_BAND = _ODD.integers(0, 1 << 63, BAND_ROWS + 1, np.uint64) * np.uint64(2) + np.uint64(1)
_MEMBERS = _ODD.permutation(2 * PERMUTATIONS)[: BANDS * BAND_ROWS].reshape(BANDS, BAND_ROWS)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True

_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, by position."""
    if len(_powers.get("up", ())) < n:
        size = max(n, 2 * SLICE)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for name, x in (("up", _BASE), ("down", inverse)):
            steps = np.full(size, x, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"], _powers["down"]


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of the texts as 64-bit hashes: text numbers and hashes, sorted by both."""
    encoded = [t.encode() for t in texts]
    raw = np.frombuffer(b"\n".join(encoded), np.uint8)
    starts = np.cumsum([0] + [len(e) + 1 for e in encoded])[:-1]
    solid = np.concatenate([[False], ~_BLANK[raw], [False]])
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    first, last = edges[::2], edges[1::2]
    if not len(first):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    up, down = _power(len(raw))
    sums = np.concatenate([[np.uint64(0)], np.cumsum((_LOWER[raw].astype(np.uint64) + np.uint64(1)) * up[: len(raw)])])
    word = mix64((sums[last] - sums[first]) * down[first])
    text = np.searchsorted(starts, first, "right") - 1
    n_words = np.bincount(text, minlength=len(texts))

    n = len(word) - WORDS + 1
    owner, found = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if n > 0:
        inside = np.flatnonzero(text[:n] == text[WORDS - 1 :])
        found = np.zeros(len(inside), np.uint64)
        for k in range(WORDS):
            found += word[inside + k] * _PLACES[k]
        owner = text[inside]
    few = np.flatnonzero((n_words > 0) & (n_words < WORDS))
    if len(few):
        begin = np.cumsum(n_words) - n_words
        short = np.zeros(len(few), np.uint64)
        for k in range(WORDS - 1):
            has = n_words[few] > k
            short[has] += word[begin[few[has]] + k] * _PLACES[k]
        short += n_words[few].astype(np.uint64) * _PLACES[WORDS]
        owner, found = np.concatenate([owner, few]), np.concatenate([found, short])
    found = mix64(found)
    order = np.lexsort((found, owner))
    owner, found = owner[order], found[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (found[1:] != found[:-1])
    return owner[new], found[new]


def signatures(starts: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Least and greatest values of the sets that begin at ``starts``: a row per set, a column per value."""
    values = np.empty((len(starts), 2 * PERMUTATIONS), np.uint32)
    short = (found >> np.uint64(32)).astype(np.uint32)  # orders of 32 bits are twice as fast
    order = np.empty_like(short)
    for p in range(PERMUTATIONS):
        np.multiply(short, _SCALE[p], out=order)
        order += _SHIFT[p]
        values[:, 2 * p] = np.minimum.reduceat(order, starts)
        values[:, 2 * p + 1] = np.maximum.reduceat(order, starts)
    return mix64(values.astype(np.uint64) + np.arange(1, 2 * PERMUTATIONS + 1, dtype=np.uint64) * _BASE)


def band_keys(values: np.ndarray) -> np.ndarray:
    """Bucket keys of signatures: a row per set, a column per band."""
    keys = np.arange(BANDS, dtype=np.uint64) * _BAND[BAND_ROWS] + np.zeros((len(values), 1), np.uint64)
    for row in range(BAND_ROWS):
        keys += values[:, _MEMBERS[:, row]] * _BAND[row]
    return mix64(keys)


def bit_words(values: np.ndarray) -> np.ndarray:
    """One bit of each signature value: a row per set, ``BIT_WORDS`` words of 64 bits."""
    bits = (values & np.uint64(1)).reshape(len(values), BIT_WORDS, 64)
    return (bits << np.arange(64, dtype=np.uint64)).sum(2, dtype=np.uint64)


def mark_words(sizes: np.ndarray, found: np.ndarray) -> np.ndarray:
    """A bit for each shingle of the sets that lie one after the other in ``found``: a row per set, words of 64 bits."""
    marks = np.zeros((len(sizes), MARK_BITS), bool)
    marks[np.repeat(np.arange(len(sizes)), sizes), (found % np.uint64(MARK_BITS)).astype(np.int64)] = True
    return np.packbits(marks, axis=1, bitorder="little").view(np.uint64)


def binomial_limit(unlike: float) -> int:
    """The number of bits that a pair exceeds with a probability below ``UNLIKELY``, if values differ with ``unlike``."""
    n, p = 2 * PERMUTATIONS, unlike / 2  # half of the values that differ agree in a bit
    tail, limit = 0.0, n
    while limit >= 0 and tail + (chance := math.comb(n, limit) * p**limit * (1 - p) ** (n - limit)) < UNLIKELY:
        tail, limit = tail + chance, limit - 1
    return limit


_PROFILE = "i bigint, n bigint, k1 bigint, k2 bigint, bits array<bigint>, marks array<bigint>, bands array<bigint>"


def _lists(rows: np.ndarray, has: np.ndarray) -> pa.Array:
    """A list for each row; empty where there is none."""
    ends = np.concatenate([[0], np.cumsum(has * rows.shape[1])])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(rows.reshape(-1).view(np.int64)))


def profiles(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``i, n, k1, k2, bits, marks, bands`` of each row: size and digest of its set, signature bits, marks of its
    shingles, and its bucket keys (none if it is empty)."""

    def profiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "t", SLICE):
            owner, found = shingles(texts)
            n = np.bincount(owner, minlength=len(texts))
            full = np.flatnonzero(n)
            starts = (np.cumsum(n) - n)[full]
            k = np.zeros((2, len(texts)), np.uint64)
            bits, bands = [np.zeros((0, BIT_WORDS), np.uint64)], [np.zeros((0, BANDS), np.uint64)]
            marks = [np.zeros((0, MARK_BITS // 64), np.uint64)]
            if len(full):
                k[0, full] = np.add.reduceat(mix64(found), starts)
                k[1, full] = np.add.reduceat(mix64(found ^ _BASE), starts)
            for at in range(0, len(full), SETS_AT_ONCE):
                own = starts[at : at + SETS_AT_ONCE]
                end = starts[at + SETS_AT_ONCE] if at + SETS_AT_ONCE < len(starts) else len(found)
                values = signatures(own - own[0], found[own[0] : end])
                bits.append(bit_words(values))
                marks.append(mark_words(n[full[at : at + SETS_AT_ONCE]], found[own[0] : end]))
                bands.append(band_keys(values))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n.astype(np.int64)),
                    *[pa.array(x.view(np.int64)) for x in k],
                    _lists(np.concatenate(bits), n > 0),
                    _lists(np.concatenate(marks), n > 0),
                    _lists(np.concatenate(bands), n > 0),
                ],
                ["i", "n", "k1", "k2", "bits", "marks", "bands"],
            )

    named = df.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t"))
    return named.mapInArrow(profiled, _PROFILE)


class _Scratch:
    """Tables between the steps, which go as soon as they have been read."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def written(self, df: DataFrame) -> DataFrame:
        path = f"{shared_folder(self.spark)}/table"
        table = written(df, path)
        self.paths[id(table)] = table, path
        return table

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            remove_folder(self.spark, self.paths.pop(id(table))[1])

    def drop_all(self) -> None:
        self.drop(*(table for table, _ in list(self.paths.values())))


def connected(links: DataFrame, scratch: _Scratch) -> DataFrame:
    """``node, root`` (smallest node reachable) of the nodes of links ``a, b``; by alternating large and small stars."""
    edges = scratch.written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    while not _stars(edges):
        # Large star: what lies above a node is linked with the least node around it.
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = around.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # Small star: a node and what lies below it are linked with the least of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        last = edges
        edges = scratch.written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        scratch.drop(last)
    roots = scratch.written(edges.select(F.col("u").alias("node"), F.col("v").alias("root")))
    scratch.drop(edges)
    return roots


def _stars(edges: DataFrame) -> bool:
    """Whether every node is linked with one smaller node at most, and with none if a larger one is linked with it:
    then the smaller node is the root of its component."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up"))
    )
    counts = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return counts.where("down > 1 OR (down = 1 AND up = 1)").isEmpty()


class _Texts:
    """Texts of the documents that have a candidate, bucketed by id so that later joins don't move them."""

    def __init__(self, spark: SparkSession, texts: DataFrame):
        self.spark = spark
        self.folder = folder = shared_folder(spark)
        self.name = "texts_" + folder.rsplit("/", 1)[1]
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        texts.write.option("path", f"{folder}/{self.name}").option("compression", "zstd").bucketBy(buckets, "i").saveAsTable(self.name)

    def confirmed(self, pairs: DataFrame, percent: int) -> DataFrame:
        """The pairs ``a, b`` whose sets have at least ``percent`` of their union in common."""
        texts = self.spark.table(self.name)
        salts = pairs.groupBy("a").agg(F.ceil(F.count("*") / SALT_ROWS).alias("salts"))
        dealt = pairs.join(salts, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("salts")))
        members = dealt.join(texts.select(F.col("i").alias("b"), F.col("t").alias("tb")), "b").select("a", "salt", "b", "tb")
        firsts = (
            salts.join(texts.select(F.col("i").alias("a"), F.col("t").alias("ta")), "a")
            .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)))
            .select("a", "salt", "ta")
        )

        def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            last, own = None, np.zeros(0, np.uint64)
            for batch in batches:
                for part, texts_b in slices(iter([batch]), "tb", SLICE):
                    owner, found = shingles(texts_b)
                    ends = np.searchsorted(owner, np.arange(len(texts_b) + 1))
                    keep = []
                    for k in range(part.num_rows):
                        text_a = part.column(2)[k].as_py() or ""
                        if text_a != last:
                            last, own = text_a, shingles([text_a])[1]
                        other = found[ends[k] : ends[k + 1]]
                        common = len(np.intersect1d(own, other, assume_unique=True))
                        union = len(own) + len(other) - common
                        keep.append(union > 0 and 100 * common >= percent * union)
                    yield part.select([0, 1]).filter(pa.array(keep, pa.bool_()))

        both = members.join(firsts, ["a", "salt"]).select("a", "b", "ta", "tb")
        return both.mapInArrow(similar, "a bigint, b bigint").distinct()

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        remove_folder(self.spark, self.folder)


def _close(percent: int) -> Column:
    """Whether neither the sizes nor the signature bits nor the marks of ``one`` and ``other`` rule a pair out.

    Common shingles have marks that both sets have; those of a set beyond its number of marks may share one."""
    bits = [F.bit_count(F.col("one.bits")[k].bitwiseXOR(F.col("other.bits")[k])) for k in range(BIT_WORDS)]
    sizes = F.least("one.n", "other.n"), F.greatest("one.n", "other.n")
    marks = [F.bit_count(F.col("one.marks")[k].bitwiseAND(F.col("other.marks")[k])) for k in range(MARK_BITS // 64)]
    common = sum(marks[1:], marks[0]) + F.least("one.beyond", "other.beyond")  # at most
    by_bits = sum(bits[1:], bits[0]) <= binomial_limit(1 - percent / 100)
    by_marks = (100 + percent) * common >= percent * (sizes[0] + sizes[1])
    return (100 * sizes[0] >= percent * sizes[1]) & by_bits & by_marks


#: What a pair is judged by before its texts are read.
_JUDGED = ("n", "bits", "marks", "beyond")


def _profiled(pairs: DataFrame, own: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` that may be close."""
    one, other = (own.select(F.col("node").alias(c), F.struct(*_JUDGED).alias(name)) for c, name in (("a", "one"), ("b", "other")))
    return pairs.join(one, "a").join(other, "b").where(_close(percent)).select("a", "b").distinct()


def components(df: DataFrame, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of each row."""
    if percent < LEAST_PERCENT:
        raise ValueError(f"the bands are made for similarities of {LEAST_PERCENT} percent and more")
    scratch = _Scratch(df.sparkSession)
    try:
        result = written(_components(df, percent, id_col, text_col, scratch))
    finally:
        scratch.drop_all()
    return result.select(
        F.col("i").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.col("root").alias("component_id"),
        F.col("i").eqNullSafe(F.col("root")).alias("kept"),
    )


def _components(df: DataFrame, percent: int, id_col: str, text_col: str, scratch: _Scratch) -> DataFrame:
    """``i, n, root`` of each row."""
    rows = scratch.written(profiles(df, id_col, text_col))
    full = rows.where("n > 0 AND i IS NOT NULL")
    # One node per set: its smallest id.
    sets = full.groupBy("k1", "k2", "n").agg(F.min("i").alias("node"))
    members = scratch.written(full.select("i", "n", "k1", "k2").join(sets, ["k1", "k2", "n"]))
    alone = scratch.written(rows.where("n = 0 OR i IS NULL").select("i", "n", F.col("i").alias("root")))
    nodes = full.join(members.where("i = node").select("i", "k1", "k2", "n", "node").distinct(), ["i", "k1", "k2", "n"])
    entries = nodes.select("node", F.explode("bands").alias("band"))
    shared = entries.groupBy("band").agg(F.min("node").alias("a"), F.max("node").alias("b"), F.count("*").alias("mates"))
    buckets = scratch.written(entries.join(shared.where("a <> b").select("band", "mates"), "band"))
    # Members that share most buckets come first: the source of a group of copies is nearer to them than they are to each other.
    degrees = buckets.groupBy("node").agg(F.sum("mates").alias("degree"))
    marked = F.aggregate("marks", F.lit(0), lambda total, word: total + F.bit_count(word))
    texts_of = nodes.select("node", "n", "bits", "marks", (F.col("n") - marked).alias("beyond"), "bands")
    own = scratch.written(texts_of.join(degrees, "node").dropDuplicates(["node", "n", "bits", "marks"]))
    scratch.drop(rows)
    firsts = buckets.select("band", "node").join(own.select("node", "degree").distinct(), "node").groupBy("band")
    firsts = firsts.agg(F.max(F.struct("degree", -F.col("node"))).alias("f")).select("band", (-F.col("f.col2")).alias("first"))

    # The hint deals the texts by id, so a task writes only the buckets it holds, one file each.
    involved = own.select(F.col("node").alias("i")).distinct().hint("merge")
    spark = df.sparkSession
    texts = _Texts(spark, df.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t")).join(involved, "i"))
    try:
        pairs = buckets.join(firsts, "band").where("node <> first")
        pairs = pairs.select(F.least("first", "node").alias("a"), F.greatest("first", "node").alias("b")).distinct()
        tested = scratch.written(_profiled(pairs, own, percent))
        links = scratch.written(texts.confirmed(tested, percent))
        met, roots = 1, connected(links, scratch)
        while True:
            labelled = buckets.join(roots, "node", "left").select("band", "node", F.coalesce("root", "node").alias("root"))
            open_ = (
                labelled.groupBy("band")
                .agg(F.min("root").alias("least"), F.max("root").alias("most"), F.count("*").alias("mates"))
                .where((F.col("least") != F.col("most")) & (F.col("mates") > met))
                .select("band")
            )
            # All buckets of a text: two that share several meet in the least one only.
            profile = own.select("node", "degree", "bands", F.struct(*_JUDGED).alias("one"))
            labelled = labelled.join(open_, "band").distinct().join(profile, "node").where("array_contains(bands, band)")
            labelled = scratch.written(labelled)
            if labelled.isEmpty():
                break
            rank = F.row_number().over(Window.partitionBy("band").orderBy(F.desc("degree"), "node"))
            meeting = F.array_min(F.array_intersect("bands", "other_bands"))
            ranked = labelled.withColumn("rank", rank)
            next_ones = F.col("rank").between(met + 1, GROWTH * met)
            following = (
                ranked.where(next_ones)
                .select(
                    "band",
                    F.col("node").alias("second"),
                    F.col("one").alias("other"),
                    F.col("root").alias("other_root"),
                    F.col("bands").alias("other_bands"),
                )
            )
            once = ~next_ones | (F.col("node") < F.col("second"))  # two of the next ones would meet twice
            pairs = (
                ranked.join(following, "band")
                .where((F.col("root") != F.col("other_root")) & once & _close(percent) & (F.col("band") == meeting))
                .select(F.least("node", "second").alias("a"), F.greatest("node", "second").alias("b"))
                .distinct()
            )
            pairs = scratch.written(pairs.join(tested, ["a", "b"], "left_anti"))
            scratch.drop(labelled)
            met = GROWTH * met
            if pairs.isEmpty():
                scratch.drop(pairs)
                continue
            found = scratch.written(texts.confirmed(pairs, percent))
            tested = tested.unionByName(pairs)
            if not found.isEmpty():
                links = links.unionByName(found)
                scratch.drop(roots)
                roots = connected(links, scratch)
    finally:
        texts.drop()
    return members.join(roots, "node", "left").select("i", "n", F.coalesce("root", "node").alias("root")).unionByName(alone)


def drop_near_copies(df: DataFrame, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` without the rows that :func:`components` doesn't keep, all columns as they are."""
    dropped = components(df, percent, id_col, text_col).where("NOT kept").select(F.col("doc_id").alias("id"))
    rows = df.select(F.struct("*").alias("row"))  # whatever its columns are called
    key = F.col("row").getField(id_col).cast("long")
    return rows.join(written(dropped.distinct()), key == F.col("id"), "left_anti").select("row.*")


def op7_near_dedup(spark, sf_dir: str) -> DataFrame:
    return components(table(spark, sf_dir, "documents"))
