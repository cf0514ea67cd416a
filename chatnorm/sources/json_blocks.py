"""JSON documents of any size, a list of objects or an object that wraps such a list, read by many tasks.

A document may be one line, so blocks are read as texts between closing braces, which the text source finds from any
place in a file. An object always ends at such a brace; at most one object of the list begins in a text. What a text
means depends on how deep it lies and whether it begins inside a string, so, as for CSV:

1. Each block tells, for both cases (it begins outside or inside a string), whether it ends inside, and by how
   much the depth changes.
2. A scan over the blocks of a file gives the state and depth at which each block begins.
3. With that known, every block is cut into the objects that lie directly in the list; those that go over the end of
   a block are put together by their place.

In a wrapping object, step 3 also notes where the lists and objects directly in it begin; the list under the first of the
known keys counts, and objects elsewhere are left out. An object that wraps no such list is one row. A document
whose brackets or strings don't end gives no rows, and objects that don't parse are left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..types import ORD_BLOCK, ORD_FILE, ORD_ROW
from .blocks import beside_texts, block_lines, block_runs, block_states, parts_of_records

_STRING_REST = re.compile(r'(?:[^"\\]++|\\.)*+("?)', re.DOTALL)
#: A string, or the beginning of one that the text doesn't end; brackets.
_TOKEN = re.compile(r'"(?:[^"\\]++|\\.)*+("?)|[\[\]{]', re.DOTALL)
_KEY = re.compile(r'"((?:[^"\\]++|\\.)*+)"\s*+:\s*+\Z', re.DOTALL)
_STATE = (
    f"{ORD_FILE} string, {ORD_BLOCK} bigint, if_outside boolean, if_inside boolean, "
    "change_outside bigint, change_inside bigint, opener string, bytes bigint, size bigint"
)
_PIECE = f"{ORD_FILE} string, {ORD_BLOCK} bigint, {ORD_ROW} bigint, text string, kind string"


def tokens(text: str, inside: bool) -> Iterator[tuple[int, str]]:
    """Brackets outside strings with their places; ends with ``(length, '"')`` if the text ends inside a string."""
    start = 0
    if inside:
        rest = _STRING_REST.match(text)
        if not rest[1]:
            yield len(text), '"'
            return
        start = rest.end()
    for m in _TOKEN.finditer(text, start):
        if m[0][0] != '"':
            yield m.start(), m[0]
        elif not m[1]:
            yield len(text), '"'
            return


def change(text: str, inside: bool) -> tuple[bool, int]:
    """Whether a text ends inside a string, and its change of depth without the brace that ends it."""
    depth = 0
    for _, token in tokens(text, inside):
        if token == '"':
            return True, depth
        depth += -1 if token == "]" else 1
    return False, depth


def _block_changes(chunks: DataFrame) -> DataFrame:
    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[tuple[str, int], list] = {}
        for key, columns in block_runs(batches):
            texts = columns["value"].to_pylist()
            state = blocks.setdefault(key, [False, True, 0, 0, _opener(texts[0]), 0, columns["size"][0].as_py()])
            for text in texts:
                for i in (0, 1):
                    state[i], by = change(text, state[i])
                    state[2 + i] += by - (not state[i])  # the closing brace, unless it is in a string
            state[5] += (pc.sum(pc.binary_length(columns["value"])).as_py() or 0) + len(texts)
        rows = [(*key, *state) for key, state in blocks.items()]
        kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
        names = [f.split()[0] for f in _STATE.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    return chunks.mapInArrow(folded, _STATE)


def _opener(text: str) -> str:
    return text.lstrip("\ufeff \t\r\n")[:1]


def block_places(chunks: DataFrame) -> DataFrame:
    """``file, block, begins, depth, depth_after, opener, open_end`` of the blocks of documents that end as they should.

    ``open_end``: something follows the last brace of the file. There a brace has been counted that isn't there.
    """
    states = block_states(_block_changes(chunks))
    order = Window.partitionBy(ORD_FILE).orderBy(ORD_BLOCK)
    up_to, all_of = order.rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy(ORD_FILE)
    is_last = F.col(ORD_BLOCK) == F.max(ORD_BLOCK).over(all_of)
    states = states.withColumns({"is_last": is_last, "open_end": F.sum("bytes").over(all_of) > F.col("size")})
    by = F.when(F.col("begins"), F.col("change_inside")).otherwise(F.col("change_outside"))
    missing = F.when(F.col("is_last") & F.col("open_end") & ~F.col("stops"), 1).otherwise(0)
    states = states.withColumn("by", by + missing).withColumn("depth_after", F.sum("by").over(up_to))
    states = states.withColumns({"depth": F.col("depth_after") - F.col("by"), "opener": F.first("opener").over(up_to)})
    ends_well = F.max(F.when(F.col("is_last"), ~F.col("stops") & (F.col("depth_after") == 0))).over(all_of)
    states = states.withColumn("ends_well", ends_well).where("ends_well AND opener IN ('[', '{')")
    return states.select(ORD_FILE, ORD_BLOCK, "begins", "depth", "depth_after", "opener", "open_end")


class _Cutter:
    """Cuts the texts of one block after the other into objects of the list at ``level``."""

    def __init__(self, key: tuple[str, int], begins: bool, depth: int, level: int) -> None:
        self.key, self.inside, self.depth, self.level = key, begins, depth, level
        self.held: list[str] | None = [] if depth > level else None  # texts of the object that is being read
        self.head = depth > level  # an earlier block has its beginning
        self.first = -1  # the row in which it begins; a head lies before all rows of the block

    def add(self, row: int, text: str) -> list[tuple]:
        """Take a text; the object that ends with it, and notes on what begins directly in a wrapping object."""
        found, opened = [], None
        for at, token in tokens(text, self.inside):
            if token == '"':
                self.inside = True
                break
            if token == "]":
                self.depth -= 1
                if self.depth == self.level:  # what was held was a list in the list, whose beginning lies in an earlier block
                    self.held, self.head = None, False
                continue
            if self.depth == self.level and token == "{" and self.held is None:
                opened = at
            elif self.depth == 1 and self.level == 2:
                key = _KEY.search(text[:at])
                found.append((*self.key, row, f"{at} {token}{key[1] if key else ''}", "note"))
            self.depth += 1
        else:
            self.inside = False
        if opened is not None:
            self.held, self.first, self.head = [text[opened:]], row, False
        elif self.held is not None:
            self.held.append(text)
        if not self.inside:
            self.depth -= 1
            if self.depth == self.level and self.held is not None:
                found.append(self.piece("closing" if self.head else "whole"))
                self.held, self.head = None, False
        return found

    def piece(self, kind: str) -> tuple:
        return (*self.key, self.first, "}".join([*self.held, ""]), kind)

    def rest(self) -> list[tuple]:
        """What goes on in the next block."""
        if not self.held:
            return []
        return [self.piece("head" if self.head else "tail")]


def _cut(kinds: set[str]):
    """Objects of the blocks, pieces of them and notes, of the ``kinds`` asked for."""
    names = [ORD_FILE, ORD_BLOCK, ORD_ROW, "text", "kind"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        cutter, size = None, 0

        def made() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * 5
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        for key, columns in block_runs(batches):
            if cutter is None or key != cutter.key:
                out += [x for x in cutter.rest() if x[4] in kinds] if cutter else []
                begins, depth, opener = (columns[c][0].as_py() for c in ("begins", "depth", "opener"))
                cutter = _Cutter(key, begins, depth, 1 if opener == "[" else 2)
            for row, text in zip(columns[ORD_ROW].to_pylist(), columns["value"].to_pylist(), strict=True):
                out += [x for x in cutter.add(row, text) if x[4] in kinds]
                size += len(text)
                if size > 1 << 20:
                    yield made()
                    size = 0
        out += [x for x in cutter.rest() if x[4] in kinds] if cutter else []
        yield made()

    return cut


def json_objects(spark: SparkSession, paths: list[str], wrapper_keys: list[str]) -> DataFrame:
    """``file, block, row, text`` of the objects in the documents."""
    place, block = [ORD_FILE, ORD_BLOCK, ORD_ROW], [ORD_FILE, ORD_BLOCK]
    chunks = block_lines(spark, paths, "}")
    states = block_places(chunks).persist(StorageLevel.MEMORY_AND_DISK)
    entry = states.select(*block, "begins", "depth", "opener")
    # The order within a block matters. A broadcast join keeps it, a shuffle join wouldn't.
    known = chunks.join(beside_texts(spark, entry, paths), block).sortWithinPartitions(*place)
    whole = known.mapInArrow(_cut({"whole"}), _PIECE).select(*place, "text")
    # Blocks that begin or end within an object of the list; of wrapping objects all, for the notes.
    level = F.when(F.col("opener") == "[", 1).otherwise(2)
    partial = states.where((F.col("depth") > level) | (F.col("depth_after") > level) | (F.col("opener") == "{"))
    partial = beside_texts(spark, partial.select(entry.columns), paths)
    partial = chunks.join(partial, block).sortWithinPartitions(*place)
    parts = partial.mapInArrow(_cut({"tail", "head", "closing", "note"}), _PIECE)
    objects = whole.unionByName(parts_of_records(_closed(parts.where("kind <> 'note'")), ""))
    lists = _lists(parts.where("kind = 'note'"), wrapper_keys)
    spans = states.select(*block, "opener").join(lists, ORD_FILE, "left")
    row = F.struct(ORD_BLOCK, ORD_ROW)
    in_list = (row >= F.col("since")) & (F.col("until").isNull() | (row < F.col("until")))
    listed = objects.join(beside_texts(spark, spans, paths), block).where((F.col("opener") == "[") | in_list).select(*place, "text")
    return listed.unionByName(_alone(chunks, states, lists))


def _closed(pieces: DataFrame) -> DataFrame:
    """Pieces up to the one that ends their object. What follows belongs to a list in the list, which has no tail."""
    order = Window.partitionBy(ORD_FILE).orderBy(ORD_BLOCK, ORD_ROW)
    run = F.sum(F.when(F.col("kind") == "tail", 1).otherwise(0)).over(order)
    within = Window.partitionBy(ORD_FILE, "run").orderBy(ORD_BLOCK, ORD_ROW).rowsBetween(Window.unboundedPreceding, -1)
    closed = F.coalesce(F.sum(F.when(F.col("kind") == "closing", 1).otherwise(0)).over(within), F.lit(0))
    return pieces.withColumn("run", run).withColumn("closed", closed).where("closed = 0").drop("run", "closed")


def _lists(notes: DataFrame, wrapper_keys: list[str]) -> DataFrame:
    """``file, since, until``: the list that counts in each wrapping object.

    Objects of a list begin in its own text or behind it, and before the text of the next note: in a text, all
    notes come before the one object that may begin there.
    """
    row, at = F.struct(ORD_BLOCK, ORD_ROW), F.substring_index("text", " ", 1).cast("int")
    order = Window.partitionBy(ORD_FILE).orderBy(ORD_BLOCK, ORD_ROW, at)
    opener = F.substr("text", F.position(F.lit(" "), "text") + 1)
    spans = notes.select(ORD_FILE, opener.alias("opener"), row.alias("since"), F.lead(row).over(order).alias("until"))
    rank = F.array_position(F.array(*(F.lit(f"[{key}") for key in wrapper_keys)), F.col("opener"))
    ranked = spans.withColumn("rank", rank).where("rank > 0")
    return ranked.groupBy(ORD_FILE).agg(F.min(F.struct("rank", "since", "until")).alias("s")).select(ORD_FILE, "s.since", "s.until")


def _alone(chunks: DataFrame, states: DataFrame, lists: DataFrame) -> DataFrame:
    """Objects that wrap no known list: one row each, as it has to fit into one."""
    single = states.where(f"{ORD_BLOCK} = 0 AND opener = '{{'").join(lists, ORD_FILE, "left_anti").select(ORD_FILE, "open_end")
    texts = F.array_sort(F.collect_list(F.struct(ORD_BLOCK, ORD_ROW, "value")))
    grouped = chunks.join(single, ORD_FILE).groupBy(ORD_FILE, "open_end").agg(texts.alias("texts"))
    text = F.array_join(F.transform("texts", lambda t: t["value"]), "}")
    text = F.concat(text, F.when(F.col("open_end"), "").otherwise("}"))
    first = F.lit(0).cast("long")
    return grouped.select(ORD_FILE, first.alias(ORD_BLOCK), first.alias(ORD_ROW), text.alias("text"))
