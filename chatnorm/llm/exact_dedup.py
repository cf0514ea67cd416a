"""Exact duplicates by an index of digests held in cuckoo filters.

The index is a table ``digest, keep_id, group_size`` of live digests, partitioned by digest. A task that
changes it loads its part into a cuckoo filter: two candidate buckets per digest, a 16-bit fingerprint
and the stored entry in each slot. A fingerprint hit is verified against the stored digest; a filter
that overflows is built again with twice the buckets from its stored entries. Digests can be inserted and
deleted.

Copies within an Arrow batch are merged before they are shuffled, so a text on a third of all rows sends
one row per batch to its part.

Defined results: null counts as the empty text, which is a text like any other. Of equal texts the row
with the largest id stays; null ids lose to all others and have ``keep_id`` null if there is no other.
Rows that repeat an id and a text share the fate of that id. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table, written

SLOTS = 4
KICKS = 200

_INDEX = "digest binary, keep_id bigint, group_size bigint"


class CuckooIndex:
    """Live digests with an entry each. ``entries`` lie beside the fingerprints, bucket by bucket."""

    def __init__(self, buckets: int = 16):
        self._clear(buckets)

    def _clear(self, buckets: int) -> None:
        self.buckets, self.size = buckets, 0
        self.marks = bytearray(2 * SLOTS * buckets)
        self.entries: list[list | None] = [None] * (SLOTS * buckets)

    def _mark(self, digest: bytes) -> bytes:
        mark = digest[:2]
        return mark if mark != b"\0\0" else b"\0\1"

    def _home(self, digest: bytes) -> int:
        return int.from_bytes(digest[2:10], "little") & (self.buckets - 1)

    def _other(self, bucket: int, mark: bytes) -> int:
        return bucket ^ ((int.from_bytes(mark, "little") * 0x5BD1E995) & (self.buckets - 1))

    def _slot(self, digest: bytes) -> int:
        """Slot of a live digest, else -1. Fingerprints are looked at first, then the stored digest."""
        mark, home = self._mark(digest), self._home(digest)
        for bucket in (home, self._other(home, mark)):
            for slot in range(SLOTS * bucket, SLOTS * (bucket + 1)):
                if self.marks[2 * slot : 2 * slot + 2] == mark and self.entries[slot][0] == digest:
                    return slot
        return -1

    def get(self, digest: bytes) -> list | None:
        slot = self._slot(digest)
        return None if slot < 0 else self.entries[slot]

    def insert(self, digest: bytes, *values) -> None:
        """Add a digest that is not live."""
        waiting: list[list] = [[digest, *values]]
        while waiting:
            left = self._place(waiting.pop())
            if left is not None:  # no slot for it: twice the buckets, filled again from the stored entries
                waiting += [left, *self.live()]
                self._clear(2 * self.buckets)

    def _place(self, entry: list) -> list | None:
        mark, bucket = self._mark(entry[0]), self._home(entry[0])
        for b in (bucket, self._other(bucket, mark)):
            for slot in range(SLOTS * b, SLOTS * (b + 1)):
                if self.entries[slot] is None:
                    self._put(slot, mark, entry)
                    self.size += 1
                    return None
        for kick in range(KICKS):
            slot = SLOTS * bucket + kick % SLOTS
            out = self.entries[slot]
            self._put(slot, mark, entry)
            entry, mark = out, self._mark(out[0])
            bucket = self._other(bucket, mark)
            for slot in range(SLOTS * bucket, SLOTS * (bucket + 1)):
                if self.entries[slot] is None:
                    self._put(slot, mark, entry)
                    self.size += 1
                    return None
        return entry

    def _put(self, slot: int, mark: bytes, entry: list | None) -> None:
        self.marks[2 * slot : 2 * slot + 2] = mark
        self.entries[slot] = entry

    def delete(self, digest: bytes) -> list | None:
        """Take a digest out; its entry, or None if it was not live."""
        slot = self._slot(digest)
        if slot < 0:
            return None
        entry = self.entries[slot]
        self._put(slot, b"\0\0", None)
        self.size -= 1
        return entry

    def live(self) -> list[list]:
        return [e for e in self.entries if e is not None]


def digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, digest``: SHA-256 of the UTF-8 text (null: empty) of each row."""
    return df.select(
        F.col(id_col).cast("long").alias("doc_id"), F.unhex(F.sha2(F.coalesce(text_col, F.lit("")), 256)).alias("digest")
    )


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Copies within a batch as one row with the largest id and their number."""
    for batch in batches:
        if batch.num_rows:
            groups = pa.Table.from_batches([batch]).group_by("digest").aggregate([("doc_id", "max"), ([], "count_all")])
            out = groups.select(["digest", "doc_id_max", "count_all"]).rename_columns(["digest", "keep_id", "group_size"])
            yield from out.cast(pa.schema([("digest", pa.binary()), ("keep_id", pa.int64()), ("group_size", pa.int64())])).to_batches()


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One part of the index after its changes: stored rows first, then insertions, then deletions."""
    index = CuckooIndex()
    for batch in batches:
        for digest, keep, n, kind in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            entry = index.get(digest)
            if kind == 2:
                if entry is not None:
                    entry[2] -= n
                    if entry[2] <= 0 or keep is None or keep == entry[1]:
                        index.delete(digest)
            elif entry is None:
                index.insert(digest, keep, n)
            elif keep is not None and (entry[1] is None or keep > entry[1]):
                # A newer copy takes the place of the live one.
                index.delete(digest)
                index.insert(digest, keep, n + entry[2])
            else:
                entry[2] += n
    live = index.live()
    for start in range(0, len(live), 10_000):
        part = live[start : start + 10_000]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([e[0] for e in part], pa.binary()),
                pa.array([e[1] for e in part], pa.int64()),
                pa.array([e[2] for e in part], pa.int64()),
            ],
            ["digest", "keep_id", "group_size"],
        )


def change_index(index: DataFrame | None, inserted: DataFrame | None = None, deleted: DataFrame | None = None) -> DataFrame:
    """The index after rows ``doc_id, digest`` were inserted and then others deleted.

    A deletion lowers the size of its group. The digest goes when no copy is left or when the kept row
    itself is deleted; its other copies have to be inserted again to become live.
    """
    parts = []
    if index is not None:
        parts.append(index.select("digest", "keep_id", "group_size", F.lit(0).alias("kind")))
    for kind, rows in ((1, inserted), (2, deleted)):
        if rows is not None:
            merged = rows.select("doc_id", "digest").mapInArrow(_merged, _INDEX)
            parts.append(merged.withColumn("kind", F.lit(kind)))
    changes = parts[0]
    for part in parts[1:]:
        changes = changes.unionByName(part)
    dealt = changes.repartition("digest")
    if len(parts) > 1:
        dealt = dealt.sortWithinPartitions("kind")
    return dealt.mapInArrow(_applied, _INDEX)


def classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, digest, keep_id, group_size, kept`` of each row of ``df``."""
    rows = written(digests(df, id_col, text_col))
    index = change_index(None, rows)
    return rows.join(index, "digest").select(
        "doc_id", "digest", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept")
    )


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` without the rows that :func:`classes` drops, all columns as they are."""
    found = classes(df, id_col, text_col)
    dropped = found.where(~F.col("kept")).select(F.col("doc_id").alias("id"), "digest")
    rows = df.select(F.struct("*").alias("row"))  # whatever its columns are called
    text = F.coalesce(F.col("row").getField(text_col), F.lit(""))
    same = F.col("row").getField(id_col).cast("long").eqNullSafe(F.col("id")) & (F.unhex(F.sha2(text, 256)) == F.col("digest"))
    return rows.join(written(dropped.distinct()), same, "left_anti").select("row.*")


def op4_exact_dedup(spark, sf_dir: str) -> DataFrame:
    found = classes(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


OP4_SQL = """
    WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, text_sha256
    FROM d WINDOW w AS (PARTITION BY text_sha256)
"""
