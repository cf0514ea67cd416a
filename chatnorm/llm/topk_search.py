"""Exact top-k search by inner product over a bit-sliced index.

The index cuts the vectors into blocks of about ``BLOCK_ROWS`` rows. A block keeps, of each component, one
bitmap per binary digit of its quantised values (a bit per row, rows in the order of their ids). The scores of
a query against a whole block are a sum of these bitmaps, each weighted with a power of two: bitmaps of equal
weight are added three by three with AND, OR and XOR into sums and carries until one bitmap per digit of the
score is left. The best k rows are then selected from the most significant digit down; rows that are still
tied at the end have equal scores and are taken in the order of their ids. Blocks are independent, so a
query's k best are those of the k best of its blocks.

The query set is stated by the caller; it is cut into chunks, and each chunk meets each block once.

Defined results: vectors that are null or hold a null, NaN or infinite component take no part, and neither do
rows with a null id, nor vectors whose quantised form is 2**31 long or longer, as scores might not fit into 64 bits. Shorter vectors count as filled up with zeros. Rows with the id of the query are its own
and are left out; repeated rows of another id are as many candidates. Without candidates a query has no rows.
Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import table, written

BLOCK_ROWS = 16_384
CHUNK_ROWS = 256
SCALE = 256
#: Quantised vectors are shorter than this.
MOST_NORM = 2.0**31

_INDEX = "block bigint, ids binary, low binary, digits binary, slices binary"
_CHUNKS = "chunk bigint, ids binary, vectors binary"


def quantised(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``id, v``: whole numbers ``floor(scale * x)`` of the vectors that take part."""
    v = F.transform(vector_col, lambda x: x.cast("double"))
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # Then all scores fit into 64 bits.
    whole = whole & (F.aggregate("v", F.lit(0.0), lambda total, x: total + (scale * x) * (scale * x)) < MOST_NORM**2)
    return (
        df.select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
        .where(F.col("id").isNotNull() & F.col("v").isNotNull() & whole)
        .select("id", F.transform("v", lambda x: F.floor(x * scale)).alias("v"))
    )


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of whole numbers as a matrix, filled up with zeros."""
    offsets, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(offsets)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = values[offsets[0] : offsets[-1]]
    return out


def build_index(vectors: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Index of ``id, v``, one row per block: sorted ids, least value and number of digits of each component, slices."""
    blocks = max(1, -(-vectors.count() // block_rows))

    def sliced(part: pa.Table) -> pa.Table:
        part = part.combine_chunks().sort_by("id")
        v, ids = _matrix(part.column("v").combine_chunks()), part.column("id").to_numpy()
        low = v.min(0) if v.size else np.zeros(v.shape[1], np.int64)
        v = (v - low).astype(np.uint64)
        digits = np.array([int(x).bit_length() for x in v.max(0)], np.int64) if v.size else np.zeros(0, np.int64)
        words = -(-len(ids) // 64)
        slices = np.zeros((int(digits.sum()), words * 8), np.uint8)
        at = 0
        for j, n in enumerate(digits):
            for b in range(int(n)):
                bits = np.packbits(((v[:, j] >> np.uint64(b)) & np.uint64(1)).astype(np.uint8), bitorder="little")
                slices[at, : len(bits)] = bits
                at += 1
        row = [[part.column("block")[0].as_py()], [ids.tobytes()], [low.tobytes()], [digits.tobytes()], [slices.tobytes()]]
        return pa.table(dict(zip(["block", "ids", "low", "digits", "slices"], row, strict=True)))

    keyed = vectors.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    return keyed.groupBy("block").applyInArrow(sliced, _INDEX)


def query_chunks(queries: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Queries ``id, v``, one row per chunk."""
    chunks = max(1, -(-queries.count() // chunk_rows))

    def chunked(part: pa.Table) -> pa.Table:
        part = part.combine_chunks()
        chunk, ids = part.column("chunk")[0].as_py(), part.column("id").to_numpy().tobytes()
        vectors = _matrix(part.column("v").combine_chunks()).tobytes()
        return pa.table({"chunk": [chunk], "ids": [ids], "vectors": [vectors]})

    keyed = queries.withColumn("chunk", F.pmod(F.xxhash64("id", F.lit(7)), F.lit(chunks)))
    return keyed.groupBy("chunk").applyInArrow(chunked, _CHUNKS)


class Block:
    """A block of the index in memory."""

    def __init__(self, ids: bytes, low: bytes, digits: bytes, slices: bytes):
        self.ids = np.frombuffer(ids, np.int64)
        self.low, self.digits = np.frombuffer(low, np.int64), np.frombuffer(digits, np.int64)
        self.words = -(-len(self.ids) // 64)
        plain = np.frombuffer(slices, np.uint64).reshape(-1, self.words)
        bits = np.zeros(self.words * 64, np.uint8)
        bits[: len(self.ids)] = 1
        self.rows = np.packbits(bits, bitorder="little").view(np.uint64)
        self.n_slices = len(plain)
        #: Slices, then their complements, which count for negative components of a query.
        self.slices = np.concatenate([plain, ~plain & self.rows])
        self.first = np.cumsum(self.digits) - self.digits

    def score_slices(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Bitmaps of the digits of all scores, from the least, and a constant to add."""
        n = min(len(query), len(self.digits))
        q, low, digits, first = query[:n], self.low[:n], self.digits[:n], self.first[:n]
        size = np.abs(q)
        constant = int((q * low).sum()) - int((size * ((1 << digits) - 1))[q < 0].sum())
        levels: dict[int, list[np.ndarray]] = {}
        for c in range(int(size.max(initial=0)).bit_length()):
            use = np.flatnonzero((size >> c) & 1)
            for b in range(int(digits[use].max(initial=0))):
                own = use[digits[use] > b]
                levels.setdefault(c + b, []).append(first[own] + b + np.where(q[own] < 0, self.n_slices, 0))
        out, weight, carried = [], 0, []
        while weight <= max(levels, default=-1) or carried:
            rows = [self.slices[np.concatenate(levels[weight])]] if weight in levels else []
            stack = np.concatenate(rows + carried) if rows or carried else np.zeros((0, self.words), np.uint64)
            carried = []
            while len(stack) > 1:
                if len(stack) == 2:
                    a, b = stack[:1], stack[1:]
                    carried.append(a & b)
                    stack = a ^ b
                else:
                    m = len(stack) // 3
                    a, b, c = stack[:m], stack[m : 2 * m], stack[2 * m : 3 * m]
                    ab = a ^ b
                    carried.append((a & b) | (c & ab))
                    stack = np.concatenate([ab ^ c, stack[3 * m :]])
            out.append(stack[0] if len(stack) else np.zeros(self.words, np.uint64))
            weight += 1
        return out, constant

    def top(self, own_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows other than the query's own."""
        digits, constant = self.score_slices(query)
        tied = self.rows.copy()
        a, b = np.searchsorted(self.ids, [own_id, own_id + 1])
        for i in range(a, b):
            tied[i // 64] &= ~(np.uint64(1) << np.uint64(i % 64))
        sure = np.zeros_like(tied)
        for bitmap in reversed(digits):
            more = sure | (tied & bitmap)
            n = int(np.bitwise_count(more).sum())
            if n > k:
                tied = tied & bitmap
            else:
                sure, tied = more, tied & ~bitmap
                if n == k:
                    tied = np.zeros_like(tied)
                    break

        def places(bitmap: np.ndarray) -> np.ndarray:
            return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))

        best = places(sure)
        best = np.concatenate([best, places(tied)[: k - len(best)]])
        scores = np.full(len(best), constant, np.int64)
        for weight, bitmap in enumerate(digits):
            scores += ((bitmap[best // 64] >> (best % 64).astype(np.uint64)) & np.uint64(1)).astype(np.int64) << weight
        return self.ids[best], scores


def search(index: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best rows of the index for each query ``id, v``."""
    index, chunks = written(index), written(query_chunks(queries))
    n_blocks, n_chunks = index.count(), chunks.count()
    if not n_blocks or not n_chunks:
        return queries.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    # Block and chunk numbers may have gaps; every pair of those that exist is met once.
    last_block = index.agg(F.max("block")).first()[0]
    last_chunk = chunks.agg(F.max("chunk")).first()[0]
    left = index.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(last_chunk))))
    right = chunks.select("chunk", F.col("ids").alias("query_ids"), "vectors").withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(last_block)))
    )
    pairs = left.join(right, ["block", "chunk"]).select("ids", "low", "digits", "slices", "query_ids", "vectors")

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, low, digits, slices, query_ids, vectors = (c[i].as_py() for c in batch.columns)
                block = Block(ids, low, digits, slices)
                own = np.frombuffer(query_ids, np.int64)
                matrix = np.frombuffer(vectors, np.int64).reshape(len(own), -1)
                found = [block.top(int(q), v, k) for q, v in zip(own, matrix, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(own, [len(f[0]) for f in found])),
                        pa.array(np.concatenate([f[0] for f in found])),
                        pa.array(np.concatenate([f[1] for f in found])),
                    ],
                    ["query_id", "vec_id", "score"],
                )

    best = pairs.mapInArrow(searched, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op9_topk_search(spark, sf_dir: str) -> DataFrame:
    vectors = quantised(table(spark, sf_dir, "embeddings"))
    return search(build_index(vectors), vectors.where("id % 50 = 0"))


OP9_SQL = """
    WITH e AS (
        SELECT vec_id AS id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    ), s AS (
        SELECT q.id AS query_id, c.id AS vec_id,
               CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
        FROM e q JOIN e c ON c.id <> q.id WHERE q.id % 50 = 0
    ), r AS (
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s
    )
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
