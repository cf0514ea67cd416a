"""CSV files with line breaks in quoted values, read by many tasks.

A line break ends a record only outside quotes, and whether a block of a file begins inside quotes depends on all blocks
before it. So the file is read in three steps, none of which needs more than its block:

1. Each block tells, for both cases (it begins outside or inside quotes), whether it ends inside.
2. A scan over the blocks of a file, one short row each, composes these to the case that holds for each block.
3. With that known, every block is cut into records. Records that go over the end of a block come out in pieces, which
   are put together by their place; all others are whole.

Step 1 is kept (persisted) as a table of one row per block. Records are parsed by ``from_csv``, so values are those of
Spark's reader with the same options. As there, a file whose first line ends with CR LF has LF for all of them. Files
whose lines end with CR alone are not split.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..types import ORD_BLOCK, ORD_FILE, ORD_ROW
from .blocks import beside_texts, block_lines, block_runs, block_states, parts_of_records

#: Text inside quotes up to a quote that isn't doubled, and a field outside of them. A quote counts as one only at
#: the beginning of a field; what follows the closing quote belongs to the field up to the separator.
_INSIDE = r'(?:[^"]++|"")*+'
_FIELD = rf'(?:"{_INSIDE}"[^,]*+|[^",][^,]*+|)'
_OPENS = re.compile(rf'(?:{_FIELD},)*+"{_INSIDE}\Z')
_STAYS = re.compile(rf'{_INSIDE}(?:\Z|"[^,]*+,(?:{_FIELD},)*+"{_INSIDE}\Z)')

_PIECE = f"{ORD_FILE} string, {ORD_BLOCK} bigint, {ORD_ROW} bigint, text string, kind string"


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a line ends inside quotes."""
    if '"' not in line:
        return inside
    return bool((_STAYS if inside else _OPENS).match(line))


_ENDS = f"{ORD_FILE} string, {ORD_BLOCK} bigint, if_outside boolean, if_inside boolean, crlf boolean"


def block_ends(lines: DataFrame) -> DataFrame:
    """``file, block, if_outside, if_inside``: how each block ends for either beginning; ``crlf``: its first line's end."""

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends: dict[tuple[str, int], list[bool]] = {}
        for key, columns in block_runs(batches):
            texts = columns["value"].to_pylist()
            state = ends.setdefault(key, [False, True, texts[0].endswith("\r")])
            for line in texts:
                if '"' in line:
                    state[:2] = ends_inside(line, state[0]), ends_inside(line, state[1])
        rows = [(*key, *state) for key, state in ends.items()]
        columns = list(zip(*rows, strict=True)) or [()] * 5
        types = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_()]
        names = [ORD_FILE, ORD_BLOCK, "if_outside", "if_inside", "crlf"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return lines.mapInArrow(folded, _ENDS)


class _Cutter:
    """Cuts the lines of one block after the other into records."""

    def __init__(self, key: tuple[str, int], begins: bool, crlf: bool) -> None:
        self.key, self.inside, self.crlf = key, begins, crlf
        self.head = begins  # a head goes on with a record of an earlier block
        self.header = key[1] == 0  # the first record of a file is not a row
        self.held: list[str] = []  # lines of the record that is being read
        self.first = 0  # row of the first of them

    def add(self, row: int, line: str) -> tuple | None:
        """Take a line; a row of ``_PIECE`` if it ends a record, or the head of one."""
        if self.header and not self.held:
            line = line.removeprefix("\ufeff")
        if self.crlf:
            line = line.removesuffix("\r")
        if not self.held:
            self.first = row
        self.held.append(line)
        self.inside = ends_inside(line, self.inside)
        return None if self.inside else self.piece("head" if self.head else "whole")

    def piece(self, kind: str) -> tuple | None:
        text, header = "\n".join(self.held), self.header
        self.held.clear()
        self.head = False
        if kind != "head":
            if not text:
                return None
            self.header = False
            if header:
                return None
        return (*self.key, self.first, text, kind)

    def rest(self) -> tuple | None:
        """What goes on in the next block."""
        return self.piece("head" if self.head else "tail") if self.held else None


def _cut(pieces: bool):
    """Whole records of the blocks, or the ``pieces`` of those that go over the end of a block."""
    names = [ORD_FILE, ORD_BLOCK, ORD_ROW, "text", "kind"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        cutter, size = None, 0

        def add(piece: tuple | None) -> None:
            if piece is not None and (piece[4] != "whole") == pieces:
                out.append(piece)

        def made() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * 5
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        for key, columns in block_runs(batches):
            if cutter is None or key != cutter.key:
                add(cutter and cutter.rest())
                cutter = _Cutter(key, columns["begins"][0].as_py(), columns["crlf"][0].as_py())
            for row, line in zip(columns[ORD_ROW].to_pylist(), columns["value"].to_pylist(), strict=True):
                add(cutter.add(row, line))
                size += len(line)
                if size > 1 << 20:
                    yield made()
                    size = 0
        add(cutter and cutter.rest())
        yield made()

    return cut


def csv_records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``file, block, row, text`` of each record but the headers; the place is that of its first line."""
    lines = block_lines(spark, paths, "\n")
    first = Window.partitionBy(ORD_FILE).orderBy(ORD_BLOCK).rowsBetween(Window.unboundedPreceding, 0)
    states = block_states(block_ends(lines)).withColumn("crlf", F.first("crlf").over(first))
    states = states.select(ORD_FILE, ORD_BLOCK, "begins", "stops", "crlf").persist(StorageLevel.MEMORY_AND_DISK)
    place = [ORD_FILE, ORD_BLOCK, ORD_ROW]
    # The order within a block matters. A broadcast join keeps it, a shuffle join wouldn't.
    block = [ORD_FILE, ORD_BLOCK]
    known = lines.join(beside_texts(spark, states, paths), block).sortWithinPartitions(*place)
    whole = known.mapInArrow(_cut(pieces=False), _PIECE).select(*place, "text")
    over = lines.join(beside_texts(spark, states.where("begins OR stops"), paths), block).sortWithinPartitions(*place)
    pieces = over.mapInArrow(_cut(pieces=True), _PIECE)
    return whole.unionByName(parts_of_records(pieces, "\n"))


def read_csv_blocks(spark: SparkSession, paths: list[str], header: list[str], options: dict) -> DataFrame:
    """Rows of CSV files that share a header, all values text, with their place."""
    schema = ", ".join("`" + c.replace("`", "``") + "` STRING" for c in header)
    settings = {k: str(v) for k, v in options.items()} | {"multiLine": "true", "lineSep": "\n"}
    parsed = F.from_csv("text", schema, settings)
    place = [ORD_FILE, ORD_BLOCK, ORD_ROW]
    return csv_records(spark, paths).select(parsed.alias("r"), *place).select("r.*", *place)
