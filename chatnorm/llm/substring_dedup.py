"""Removal of passages that repeat an earlier document, by phrases around rolling-hash triggers.

This is the first half of prefix-free parsing: there is no parse, no suffix array of it and no corpus order, as
only the least id of equal strings is asked for.

A byte goes if it is covered by a string of ``LENGTH`` bytes that also starts in a document with a smaller id.

Parsing: a rolling hash runs over windows of ``TRIGGER`` bytes; a window is a trigger where its hash is the
least of those in some string of ``LENGTH`` bytes. So every such string holds a trigger at a place that its
bytes alone decide. A phrase is what the strings around a trigger can reach: up to ``LENGTH`` - ``TRIGGER``
bytes on either side. Equal strings lie in phrases with equal triggers.

Dictionary and parse: phrases are dealt out as hashes with the ids of their documents; a trigger's own part gets
no more than two rows a block. The strings of a hot trigger (more than ``HOT`` phrases) are dealt by two 64-bit hashes
of their own, once a block, and the least id of each counts, so no task depends on one trigger's frequency.
Of a phrase that occurs in several documents, all but the first are settled at once: the whole phrase
repeats. What is left is the dictionary: the first occurrence of each phrase whose trigger other
phrases share. Only for these are the bytes fetched. The strings of a phrase fall into classes by how far behind their
start the trigger lies; those of a class have a longer window in common, and go no further unless several ids share
it. The other suffixes of at least ``LENGTH`` bytes of all phrases with one trigger are sorted by prefix refinement
(a suffix array of that part of the dictionary, to the depth that matters). Suffixes that agree to that depth stand
together, and the least id among their phrases in the parse tells which repeat.

Highly repetitive text costs little beyond its first copy: repeats within a block of text are merged before
anything is shuffled, those between blocks travel as hashes. Text itself is never shuffled: it is written
once in blocks, bucketed by block, and what is found is joined to it. A block sends a row to each part, so blocks are
large, and parts grow with the root of the text up to ``PART_BYTES``: rows, each with costs of its own, stay few.

Defined results: null and empty texts have no bytes. Matches never cross documents. Null ids count as
larger than all others. Rows with equal ids don't remove each other's bytes. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.session import shared_folder
from .common import mix64, slices, table, written

LENGTH = 50
TRIGGER = 20
REACH = LENGTH - TRIGGER
BLOCK_CHARS = 4_000_000
#: Least and greatest number of bytes of text for each part that triggers are dealt out to.
PART_BYTES = 8 << 20, 32 << 20
#: Bytes that go out in one Arrow batch, about.
SENT_BYTES = 4 << 20
#: Bytes that are hashed at a time, so that the arrays stay in a core's cache.
STEP = 1 << 15
#: Strings of a phrase are told apart by this many places of the trigger at a time.
CLASS = 8
NO_ID = (1 << 63) - 1
#: Phrases of a trigger, counted per block, from which its strings are dealt by their own hashes.
HOT = 2_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_TOP = np.uint64((1 << 64) - (1 << 24))
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        for name, x in (("up", int(_BASE)), ("down", pow(int(_BASE), -1, 1 << 64))):
            steps = np.full(max(n, 1 << 20), x, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"], _powers["down"]


def _sums(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums ``s`` and factors ``f``: the polynomial hash of the bytes from a to b is ``(s[b] - s[a]) * f[a]``."""
    up, down = _power(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    terms = raw.astype(np.uint64)
    terms += np.uint64(1)
    terms *= up[: len(raw)]
    np.cumsum(terms, out=sums[1:])
    return sums, down


def _changes(x: np.ndarray) -> np.ndarray:
    """Whether a value differs from the one before it."""
    new = np.ones(len(x), bool)
    new[1:] = x[1:] != x[:-1]
    return new


def _ordered(*keys: np.ndarray) -> np.ndarray:
    """The order by the first key, which isn't negative, then by the others.

    The key's upper bits are sorted with the places below them, which is far quicker than an argsort; only where these bits
    are equal the keys are looked at.
    """
    n = len(keys[0])
    top = keys[0].astype(np.uint64)
    top <<= np.uint64(64 - int(top.max(initial=1)).bit_length())
    low = np.uint64((1 << n.bit_length()) - 1)
    top &= ~low
    top |= np.arange(n, dtype=np.uint64)
    top.sort()
    order = (top & low).astype(np.int64)
    first = keys[0][order]
    if len(keys) == 1 and np.all(first[1:] >= first[:-1]):
        return order
    same = np.zeros(n + 1, bool)
    top &= ~low
    same[1:-1] = top[1:] == top[:-1]
    tied = np.flatnonzero(same[1:] | same[:-1])
    if len(tied):
        own = order[tied]
        order[tied] = own[np.lexsort([k[own] for k in reversed(keys)])]
    return order


def _by_part(part: np.ndarray) -> np.ndarray:
    return np.argsort(part.astype(np.uint16) if part.max(initial=0) < 1 << 16 else part, kind="stable")


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays of one length, each cut into planes of equal bytes, compressed."""
    n, at = len(arrays[0]), 8
    out = np.empty(8 + n * sum(a.itemsize for a in arrays), np.uint8)
    out[:8].view(np.int64)[0] = n
    for a in map(np.ascontiguousarray, arrays):
        columns = a.view(np.uint8).reshape(n, a.itemsize)
        for j in range(a.itemsize):
            out[at : at + n] = columns[:, j]
            at += n
    return _squeezed(out.tobytes())


def _squeezed(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _opened(blob: bytes) -> bytes:
    return pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), "zstd", asbytes=True)


def _unpacked(blob: bytes, *kinds) -> list[np.ndarray]:
    raw = _opened(blob)
    n, at, out = int.from_bytes(raw[:8], "little"), 8, []
    for kind in map(np.dtype, kinds):
        plane = np.frombuffer(raw, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(plane.T).view(kind).reshape(n))
        at += n * kind.itemsize
    return out


class Parsed:
    """Triggers and phrases of documents that lie one after the other in ``raw``."""

    def __init__(self, ids: np.ndarray, ends: np.ndarray, raw: np.ndarray):
        self.ids, self.ends, self.raw = ids, ends, raw
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        begins = np.ones(len(raw), bool)  # of strings
        for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
            begins[max(a, b - LENGTH + 1) : b] = False
        marks = np.zeros(len(raw), bool)
        width, low = REACH + 1, ~_TOP
        number = np.arange(STEP + width, dtype=np.uint64)
        for at in range(0, len(raw) - LENGTH + 1, STEP):
            # Windows from here, and of each string that begins here the least.
            stop = min(len(raw) - TRIGGER + 1, at + STEP + width - 1)
            sums, down = _sums(raw[at : stop + TRIGGER - 1])
            v = sums[TRIGGER:] - sums[:-TRIGGER]
            v *= down[: len(v)]
            v = mix64(v)
            v &= _TOP
            v |= number[: len(v)]
            size = 1
            while 2 * size <= width:
                v = np.minimum(v[:-size], v[size:])
                size *= 2
            v = np.minimum(v[: len(v) - (width - size)], v[width - size :])
            v = v[begins[at : at + len(v)]]
            marks[at + (v[_changes(v)] & low).astype(np.int64)] = True
        self.places = np.flatnonzero(marks)
        self.doc = np.searchsorted(ends, self.places, "right")
        self.a = np.maximum(self.places - REACH, starts[self.doc])
        self.b = np.minimum(self.places + LENGTH, ends[self.doc])
        trigger, phrase = self.hashed(self.a, (self.places, self.places + TRIGGER), (self.a, self.b))
        self.trigger = trigger >> np.uint64(16)
        shape = (self.places - self.a).astype(np.uint64) * np.uint64(128) + (self.b - self.places).astype(np.uint64)
        self.phrase = mix64(phrase ^ shape * _BASE)
        # Phrases of this block: entries sorted by trigger, phrase and id; of equal ones the least id counts.
        self.id = ids[self.doc]
        self.order = _ordered(self.trigger, self.phrase, self.id)
        t, f = self.trigger[self.order], self.phrase[self.order]
        new = _changes(t) | _changes(f)
        self.new = np.flatnonzero(new)
        self.group = np.cumsum(new) - 1  # of each entry in that order

    def hashed(self, base: np.ndarray, *ranges: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
        """Hashes of ranges of bytes. ``base`` ascends, and a range lies at most ``REACH + LENGTH`` bytes behind its base."""
        out = [np.empty(len(base), np.uint64) for _ in ranges]
        bounds = np.searchsorted(base, np.arange(0, len(self.raw) + STEP, STEP)).tolist()
        for k, (i, j) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
            if i < j:
                at = k * STEP
                sums, down = _sums(self.raw[at : at + STEP + REACH + LENGTH])
                for to, (a, b) in zip(out, ranges, strict=True):
                    start = a[i:j] - at
                    to[i:j] = mix64((sums[b[i:j] - at] - sums[start]) * down[start])
        return out

    def phrase_parts(self, n: int) -> np.ndarray:
        """Part of each group by its phrase."""
        return _part_of(self.phrase[self.order[self.new]], n)

    def firsts(self) -> tuple[np.ndarray, np.ndarray]:
        """The first group of each trigger, and the trigger's number of each group."""
        t = self.trigger[self.order[self.new]]
        new = _changes(t)
        return np.flatnonzero(new), np.cumsum(new) - 1

    def strings(self, entries: np.ndarray) -> tuple[np.ndarray, ...]:
        """Places, documents' numbers and two hashes of the strings of ``LENGTH`` bytes in some phrases."""
        n = np.maximum(self.b[entries] - self.a[entries] - LENGTH + 1, 0)
        place = np.arange(int(n.sum())) + np.repeat(self.a[entries] - (np.cumsum(n) - n), n)
        doc = np.repeat(self.doc[entries], n)
        place, first = np.unique(place, return_index=True)
        one, two = self.hashed(place, (place, place + LENGTH), (place, place + LENGTH // 2))
        return place, doc[first], one, mix64(two ^ one * _BASE)


def _parts(total: int) -> int:
    """Number of parts for so many bytes of text."""
    return max(8, -(-total // min(max(320 * math.isqrt(total), PART_BYTES[0]), PART_BYTES[1])))


def _part_of(hashes: np.ndarray, n: int) -> np.ndarray:
    # Triggers are the least of several hashes, so their own top bits would crowd the first parts.
    return ((mix64(hashes) >> np.uint64(40)) * np.uint64(n) >> np.uint64(24)).astype(np.int64)


def _cuts(part: np.ndarray) -> list[tuple[int, int, int]]:
    """Part, start and end of the runs of equal parts."""
    if not len(part):
        return []
    at = np.flatnonzero(_changes(part)).tolist()
    return [(int(part[a]), a, b) for a, b in zip(at, [*at[1:], len(part)], strict=True)]


def _block(row) -> Parsed:
    ids, ends, raw = (np.frombuffer(x, k) for x, k in zip(row, (np.int64, np.int64, np.uint8), strict=True))
    return Parsed(ids, ends, raw)


def _sent(block: int, rows: list[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    """What a block has for each part, in batches of a bounded size."""
    ends = np.cumsum([len(blob) for _, blob in rows]) // SENT_BYTES
    for _, i, j in _cuts(ends):
        parts, blobs = zip(*rows[i:j], strict=True)
        arrays = [pa.array([block] * (j - i), pa.int64()), pa.array(parts, pa.int64()), pa.array(blobs, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, ["block", "part", "blob"])


def _joined(doc: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...]:
    """Overlapping and touching ranges of a document as one."""
    if not len(a):
        return doc, a, b
    order = np.lexsort((a, doc))
    doc, a, b = doc[order], a[order], b[order]
    reach = np.maximum.accumulate(b + doc * (1 << 40)) - doc * (1 << 40)  # ranges of later documents reach further
    new = np.ones(len(a), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (a[1:] > reach[:-1])
    first = np.flatnonzero(new)
    return doc[first], a[first], np.maximum.reduceat(b, first)


def _settled(part: pa.Table, hot_from: int) -> pa.Table:
    """Codes of the entries of one part. Even parts hold triggers (0 nothing to compare, 2 bytes are needed, 3 the
    trigger is hot), odd parts phrases (1 the whole phrase repeats).

    Triggers come as 32 bits, which tell them apart within a part; where two are taken for one, bytes are compared
    that need not be. A phrase counts as a repeat on 96 bits, 64 of them its own."""
    number = part.column("part")[0].as_py()
    blobs = [_unpacked(x.as_py(), np.uint32, np.uint64, np.int64, np.int32) for x in part.column("blob")]
    sizes = np.array([len(b[0]) for b in blobs])
    trigger, phrase, ident, n = (np.concatenate([b[i] for b in blobs]) for i in range(4))
    if number % 2:
        order = _ordered(phrase, trigger)
        d, new = ident[order], _changes(phrase[order]) | _changes(trigger[order])
    else:
        order = _ordered(trigger)
        d, new = ident[order], _changes(trigger[order])
    at, of = np.flatnonzero(new), np.cumsum(new) - 1
    if number % 2:
        code = (d > np.minimum.reduceat(d, at)[of]).astype(np.uint8)
    else:
        f = phrase[order]
        docs_differ = np.minimum.reduceat(d, at) != np.maximum.reduceat(d, at)
        phrases_differ = np.minimum.reduceat(f, at) != np.maximum.reduceat(f, at)
        hot = np.add.reduceat(n[order], at, dtype=np.int64) > hot_from
        code = np.where(docs_differ & phrases_differ, np.where(hot, 3, 2), 0).astype(np.uint8)[of]
    back = np.empty(len(code), np.uint8)
    back[order] = code
    cuts = np.split(back, np.cumsum(sizes)[:-1])
    return pa.table({"block": part.column("block"), "part": part.column("part"), "codes": pa.array([_squeezed(c.tobytes()) for c in cuts], pa.binary())})


def _least(part: pa.Table) -> pa.Table:
    """Places of strings of hot triggers in one part that repeat an earlier document: the least id of each string."""
    blobs = [_unpacked(x.as_py(), np.uint64, np.uint64, np.int64, np.int32, np.int64) for x in part.column("blob")]
    source = np.repeat(np.arange(len(blobs)), [len(b[0]) for b in blobs])
    one, two, ident, doc, place = (np.concatenate([b[i] for b in blobs]) for i in range(5))
    hit = _repeats(one, two, ident)
    ranges, blocks = [], []
    for k, block in enumerate(part.column("block").to_pylist()):
        own = hit & (source == k)
        if own.any():
            ranges.append(_packed(doc[own], place[own], place[own] + LENGTH))
            blocks.append(block)
    return pa.table({"block": pa.array(blocks, pa.int64()), "ranges": pa.array(ranges, pa.binary())})


def _repeats(one: np.ndarray, two: np.ndarray, ident: np.ndarray) -> np.ndarray:
    """Whether an entry's two hashes also belong to a smaller id."""
    order = _ordered(one, two, ident)
    new = _changes(one[order]) | _changes(two[order])
    hit = np.zeros(len(order), bool)
    hit[order] = ident[order] > ident[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    return hit


def _repeated_suffixes(raw: np.ndarray, at: np.ndarray, trigger: np.ndarray, ident: np.ndarray) -> np.ndarray:
    """Whether the ``LENGTH`` bytes at each place also stand at a place with the same trigger and a smaller id.

    A hash of all bytes and the trigger leaves little: what sorts beside its own id only is done. Equality is that of the
    bytes. Where those of equal hashes differ, prefix refinement, 8 bytes at a time, tells them apart.
    """
    hit = np.zeros(len(at), bool)
    if not len(at):
        return hit
    sums, down = _sums(raw)
    words = np.ndarray(len(raw) - 7, np.uint64, raw, strides=(1,)).copy()  # at every byte the 8 from there
    steps = [*range(0, LENGTH - 8, 8), LENGTH - 8]

    def split(word: np.ndarray, left: np.ndarray, group: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = _ordered(word) if group is None else np.lexsort((word, group))
        new = _changes(word[order]) if group is None else _changes(word[order]) | _changes(group[order])
        d = ident[left[order]]
        first, of = np.flatnonzero(new), np.cumsum(new) - 1
        low = np.minimum.reduceat(d, first)
        several = (low != np.maximum.reduceat(d, first))[of]
        return left[order[several]], of[several], low[of[several]]

    left, group, least = split(mix64((sums[at + LENGTH] - sums[at]) * down[at] ^ trigger * _BASE), np.arange(len(at)), None)
    if not len(left):
        return hit
    new = _changes(group)
    lead = left[np.flatnonzero(new)[np.cumsum(new) - 1]]  # each is compared with the first of its hash
    differs = trigger[left] != trigger[lead]
    for k in steps:
        differs |= words[at[left] + k] != words[at[lead] + k]
    apart = np.isin(group, group[differs])
    hit[left[~apart]] = least[~apart] < ident[left[~apart]]
    left, group = left[apart], group[apart]
    for k in (-1, *steps):
        if not len(left):
            return hit
        left, group, least = split(trigger[left] if k < 0 else words[at[left] + k], left, group)
    hit[left] = least < ident[left]
    return hit


def _classes(raw: np.ndarray, begin: np.ndarray, size: np.ndarray, offset: np.ndarray, ident: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of phrases in ``raw`` that have their trigger at ``offset`` the numbers, first places and counts of strings that may repeat.

    Strings that begin ``CLASS * k`` to ``CLASS * k + CLASS - 1`` bytes before the trigger share the bytes between the start of
    the last and the end of the first. If these stand with one id only, so do the strings.
    """
    sums, down = _sums(raw)
    kept = []
    for k in range(-(-(REACH + 1) // CLASS)):
        last = np.minimum(offset - CLASS * k, size - LENGTH)
        first = np.maximum(offset - CLASS * k - CLASS + 1, 0)
        own = np.flatnonzero(first <= last)
        if not len(own):
            continue
        a = begin[own] + offset[own] - CLASS * k
        window = mix64((sums[a + LENGTH - CLASS + 1] - sums[a]) * down[a])
        order = _ordered(window)
        new, d = _changes(window[order]), ident[own[order]]
        at = np.flatnonzero(new)
        several = np.minimum.reduceat(d, at) != np.maximum.reduceat(d, at)
        own = own[order[several[np.cumsum(new) - 1]]]
        kept.append((own, first[own], last[own] - first[own] + 1))
    if not kept:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*kept, strict=True))


def _compared(part: pa.Table) -> pa.Table:
    """Ranges of the dictionary's phrases in one part that repeat an earlier document."""
    heads, texts, source = [], [], []
    for k, x in enumerate(part.column("blob")):
        raw = _opened(x.as_py())
        n = int.from_bytes(raw[:8], "little")
        heads.append(_unpacked(raw[8 : 8 + n], np.uint64, np.int64, np.int32, np.int64, np.int32, np.int32))
        texts.append(np.frombuffer(raw, np.uint8, offset=8 + n))
        source.append(np.full(len(heads[-1][0]), k))
    trigger, ident, doc, start, size, offset = (np.concatenate([h[i] for h in heads]) for i in range(6))
    raw, source = np.concatenate(texts), np.concatenate(source)
    begin = np.cumsum(size, dtype=np.int64) - size
    order = _ordered(trigger)
    bounds = np.flatnonzero(_changes(trigger[order]))
    found: list[tuple[np.ndarray, np.ndarray]] = []  # entries and places
    # Triggers are taken together up to a bounded number of bytes.
    weights = np.add.reduceat(size[order].astype(np.int64), bounds) if len(bounds) else np.zeros(0, np.int64)
    lots = np.cumsum(weights) // 800_000
    for lot in np.unique(lots):
        groups = np.flatnonzero(lots == lot)
        end = bounds[groups[-1] + 1] if groups[-1] + 1 < len(bounds) else len(order)
        entries = order[bounds[groups[0]] : end]
        sizes = size[entries].astype(np.int64)
        ahead = np.cumsum(sizes) - sizes  # bytes of the lot before each phrase
        own = raw[np.arange(int(sizes.sum())) + np.repeat(begin[entries] - ahead, sizes)]
        which, first, n = _classes(own, ahead, sizes, offset[entries].astype(np.int64), ident[entries])
        if not len(which):
            continue
        entry = np.repeat(which, n)
        place = np.arange(len(entry)) + np.repeat(first - (np.cumsum(n) - n), n)
        at, entry = ahead[entry] + place, entries[entry]
        hit = _repeated_suffixes(own, at, trigger[entry], ident[entry])
        found.append((entry[hit], place[hit]))
    entry, place = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2
    a = start[entry] + place
    ranges, blocks = [], []
    for k, block in enumerate(part.column("block").to_pylist()):
        own = source[entry] == k
        if own.any():
            doc_k, a_k, b_k = _joined(doc[entry[own]].astype(np.int64), a[own], a[own] + LENGTH)
            ranges.append(_packed(doc_k.astype(np.int32), a_k.astype(np.int64), b_k.astype(np.int64)))
            blocks.append(block)
    return pa.table({"block": pa.array(blocks, pa.int64()), "ranges": pa.array(ranges, pa.binary())})


def without_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (the bytes that stay) of each row."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    name = "blocks_" + folder.rsplit("/", 1)[1]

    def blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch, texts in slices(batches, "t", BLOCK_CHARS):
            ids = np.array([NO_ID if i is None else i for i in batch.column(0).to_pylist()], np.int64)
            encoded = [t.encode() for t in texts]
            ends = np.cumsum([len(e) for e in encoded], dtype=np.int64)
            row = [[number], [ids.tobytes()], [ends.tobytes()], [b"".join(encoded)], [int(ends[-1])]]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, row)), ["block", "ids", "ends", "raw", "size"])
            number += 1

    plain = df.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t"))
    blocks = plain.mapInArrow(blocked, "block bigint, ids binary, ends binary, raw binary, size bigint")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = blocks.write.option("path", f"{folder}/{name}").option("compression", "zstd")
    writer.bucketBy(buckets, "block").saveAsTable(name)
    blocks = spark.table(name)
    total = blocks.agg(F.sum("size")).first()[0] or 0
    parts = _parts(total)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                parsed = _block([batch.column(c)[k].as_py() for c in (1, 2, 3)])
                groups = parsed.order[parsed.new]
                first, of = parsed.firsts()
                lots = []
                if len(groups):
                    # A trigger sends the least and the greatest of its ids and phrases here, a row for each,
                    # whatever its frequency; its count rides on the first.
                    ids, phrases = parsed.id[groups], parsed.phrase[groups]
                    n = np.bincount(of)
                    low, high = np.minimum.reduceat(ids, first), np.maximum.reduceat(ids, first)
                    more = np.flatnonzero(n > 1)
                    t = parsed.trigger[groups[first]]
                    t, short = np.concatenate([t, t[more]]), phrases >> np.uint64(16)
                    rows = [short[first], np.maximum.reduceat(short, first)[more]], [low, high[more]], [n.astype(np.int32), np.zeros(len(more), np.int32)]
                    lots.append((0, _part_of(t, parts), [(t >> np.uint64(16)).astype(np.uint32), *map(np.concatenate, rows)]))
                    own = (parsed.trigger[groups] >> np.uint64(16)).astype(np.uint32)
                    lots.append((1, parsed.phrase_parts(parts), [own, phrases, ids, np.zeros(len(groups), np.int32)]))
                out = []
                for kind, part, rows in lots:
                    order = _by_part(part)
                    rows = [r[order] for r in rows]
                    out += [(2 * p + kind, _packed(*(r[a:b] for r in rows))) for p, a, b in _cuts(part[order])]
                yield from _sent(batch.column(0)[k].as_py(), out)

    hashes = blocks.select("block", "ids", "ends", "raw").mapInArrow(dealt, "block bigint, part bigint, blob binary")
    codes = hashes.groupBy("part").applyInArrow(lambda part: _settled(part, hot), "block bigint, part bigint, codes binary")
    codes = codes.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("part", "codes"))).alias("codes"))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                parsed = _block([batch.column(c)[k].as_py() for c in (1, 2, 3)])
                lists = batch.column(4)[k].as_py()
                by_trigger, by_phrase = (
                    np.frombuffer(b"".join(_opened(x["codes"]) for x in lists if x["part"] % 2 == kind), np.uint8) for kind in (0, 1)
                )
                groups = parsed.order[parsed.new]
                first, of = parsed.firsts()
                t = parsed.trigger[groups[first]]
                t = np.concatenate([t, t[np.bincount(of) > 1]]) if len(t) else t
                code, repeated = np.empty(len(t), np.uint8), np.empty(len(groups), np.uint8)
                code[_by_part(_part_of(t, parts))] = by_trigger
                repeated[_by_part(parsed.phrase_parts(parts))] = by_phrase
                code = np.where(repeated == 1, 1, code[of])
                least = parsed.id[parsed.order[parsed.new]]
                later = parsed.id[parsed.order] > least[parsed.group]
                code = np.where(later, 1, code[parsed.group])
                whole = parsed.order[code == 1]
                doc, a, b = _joined(parsed.doc[whole], parsed.a[whole], parsed.b[whole])
                out = [(-1, _packed(doc.astype(np.int32), a, b))]
                place, in_doc, one, two = parsed.strings(parsed.order[code == 3])
                if len(place):
                    # Strings of hot triggers are dealt by their own hashes; a block sends the first of each.
                    ident = parsed.ids[in_doc]
                    gone = _repeats(one, two, ident)
                    out.append((-1, _packed(in_doc[gone].astype(np.int32), place[gone], place[gone] + LENGTH)))
                    kept = np.flatnonzero(~gone)
                    part = _part_of(one[kept], parts)
                    order = _by_part(part)
                    kept = kept[order]
                    for p, a, b in _cuts(part[order]):
                        e = kept[a:b]
                        out.append((parts + p, _packed(one[e], two[e], ident[e], in_doc[e].astype(np.int32), place[e])))
                own = parsed.order[code == 2]
                part = _part_of(parsed.trigger[own], parts)
                order = _by_part(part)
                own = own[order]
                for p, a, b in _cuts(part[order]):
                    e = own[a:b]
                    size = (parsed.b[e] - parsed.a[e]).astype(np.int32)
                    offset = (parsed.places[e] - parsed.a[e]).astype(np.int32)
                    head = _packed(parsed.trigger[e], parsed.id[e], parsed.doc[e].astype(np.int32), parsed.a[e], size, offset)
                    at = np.arange(int(size.sum())) + np.repeat(parsed.a[e] - (np.cumsum(size) - size), size)
                    out.append((p, _squeezed(len(head).to_bytes(8, "little") + head + parsed.raw[at].tobytes())))
                yield from _sent(batch.column(0)[k].as_py(), out)

    both = blocks.join(codes, "block").select("block", "ids", "ends", "raw", "codes")
    found = written(both.mapInArrow(coded, "block bigint, part bigint, blob binary"))
    compared = found.where(F.col("part").between(0, parts - 1)).groupBy("part").applyInArrow(_compared, "block bigint, ranges binary")
    least = found.where(F.col("part") >= parts).groupBy("part").applyInArrow(_least, "block bigint, ranges binary")
    whole = found.where("part < 0").select("block", F.col("blob").alias("ranges"))
    ranges = whole.unionByName(compared).unionByName(least).groupBy("block").agg(F.collect_list("ranges").alias("ranges"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                ids, ends, raw = (np.frombuffer(batch.column(c)[k].as_py(), t) for c, t in ((0, np.int64), (1, np.int64), (2, np.uint8)))
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                lists = [_unpacked(x, np.int32, np.int64, np.int64) for x in batch.column(3)[k].as_py() or ()]
                doc, a, b = (np.concatenate([x[i] for x in lists]) if lists else np.zeros(0, np.int64) for i in range(3))
                doc, a, b = _joined(doc.astype(np.int64), a, b)
                keep = np.ones(len(raw), bool)
                for i, j in zip(a.tolist(), b.tolist(), strict=True):
                    keep[i:j] = False
                removed = np.zeros(len(ids), np.int64)
                np.add.at(removed, doc, b - a)
                spans = np.bincount(doc, minlength=len(ids)).astype(np.int64)
                kept = [raw[s:e][keep[s:e]].tobytes() for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, mask=ids == NO_ID), pa.array(ends - starts), pa.array(removed), pa.array(spans), pa.array(kept, pa.binary())],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
                )

    both = blocks.join(written(ranges), "block", "left").select("ids", "ends", "raw", "ranges")
    return both.mapInArrow(cut, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")


def op8_substring_dedup(spark, sf_dir: str) -> DataFrame:
    found = without_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(rows: list[tuple[int, bytes]]) -> dict[int, tuple[int, int, int, str]]:
    """The same results for few rows with distinct ids, string by string."""
    least: dict[bytes, int] = {}
    for i, raw in rows:
        for p in range(len(raw) - LENGTH + 1):
            s = raw[p : p + LENGTH]
            least[s] = min(i, least.get(s, i))
    out = {}
    for i, raw in rows:
        gone = bytearray(len(raw))
        for p in range(len(raw) - LENGTH + 1):
            if least[raw[p : p + LENGTH]] < i:
                gone[p : p + LENGTH] = b"\1" * LENGTH
        kept = bytes(c for c, g in zip(raw, gone, strict=True) if not g)
        spans = sum(1 for p in range(len(gone)) if gone[p] and (p == 0 or not gone[p - 1]))
        out[i] = len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()
    return out
