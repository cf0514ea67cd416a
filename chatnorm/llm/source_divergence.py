"""How far the word use of each source lies from that of the other sources of its language.

Counts of a group (lang, source) are the leaves of a segment tree over the kept terms of its language. Trees are
hash-consed: two nodes with the same pair of children are one node, whichever group or place they belong to, and
a subtree without occurrences is node 0. Two groups are compared by walking down both trees at once. Equal node
pairs are met once a level and priced once; sums then go back up with the number of ways the pair is reached.
Terms stand in the order of their frequency, so the long tail of rare terms is a few nodes.

The terms of a language are dealt by hash into blocks of about ``BLOCK_ROWS`` counts; a block is one subtree of
each group and one task's work, and the values of blocks are added up. All numbers are integers.

Texts are counted by (lang, source, term) within a task before the shuffle, so a source that holds a third of all
rows sends its counts once a task.

Defined results: null lang, source and text are ``''``. Groups without kept terms have N = 0 and take part.
A language without kept terms has pairs of value 0 and no terms; one with a single source has no pairs. Repeated
rows are as many documents. Ids and other columns are not looked at. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written

LEAST_DOCS = 10
TOP = 10
SCALE = 10**9
#: Counts that a block holds on average.
BLOCK_ROWS = 200_000
#: Counts that a task gathers before it passes them on, and bytes of text that it splits at a time.
GATHERED, PART_BYTES = 400_000, 1 << 20
#: A-Z in lower case, other letters and all bytes of longer characters as they are, the rest blank.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _terms(text: bytes) -> Iterator[list[bytes]]:
    """Terms of a text, for about ``PART_BYTES`` at a time."""
    text, start = text.translate(_TERM_BYTES), 0
    while start < len(text):
        end = len(text) if start + PART_BYTES >= len(text) else text.find(b" ", start + PART_BYTES)
        end = len(text) if end < 0 else end
        yield text[start:end].split()
        start = end


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences and documents; several rows of a term have to be added."""
    names = ["lang", "source", "term", "n", "docs"]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def passed() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, docs) in groups.items():
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(n), pa.string()),
                        pa.array([source] * len(n), pa.string()),
                        pa.array(n.keys(), pa.binary()).cast(pa.string()),
                        pa.array(n.values(), pa.int64()),
                        pa.array([docs[term] for term in n], pa.int64()),
                    ],
                    names,
                )
            groups.clear()

        held = 0
        for batch in batches:
            for lang, source, text in zip(*batch.columns, strict=True):
                n, docs = groups.setdefault((lang.as_py(), source.as_py()), (Counter(), Counter()))
                held -= len(n)
                seen: set[bytes] = set()
                for terms in _terms(text.as_py()):
                    n.update(terms)
                    seen.update(terms)
                docs.update(seen)
                held += len(n)
                if held > GATHERED:
                    yield from passed()
                    held = 0
        yield from passed()

    plain = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")))
    return plain.select("lang", "source", F.col("text").cast("binary")).mapInArrow(
        counted, "lang string, source string, term string, n bigint, docs bigint"
    )


def kept_counts(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``lang, source, term, n, first``: terms in enough documents of their language; ``first`` marks one row of each."""
    counts = term_counts(docs).repartition("lang", "term")  # one shuffle serves the sums and the window
    counts = counts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term")
    first = F.row_number().over(of_term.orderBy("source")) == 1
    counts = counts.withColumns({"all": F.sum("docs").over(of_term), "first": first})
    return counts.where(F.col("all") >= least_docs).select("lang", "source", "term", "n", "first")


# Trees.


def consed(groups: np.ndarray, places: np.ndarray, leaves: np.ndarray, height: int) -> tuple[list[np.ndarray], dict[int, int]]:
    """Trees over leaves that are not 0: children ``(left, right)`` of the nodes of each level from below, and roots.

    ``groups, places, leaves`` are sorted by group and place. Node 0 of every level is a subtree without occurrences.
    """
    levels, nodes = [], leaves
    for _ in range(height):
        above = places >> 1
        new = np.ones(len(nodes), bool)
        new[1:] = (groups[1:] != groups[:-1]) | (above[1:] != above[:-1])
        pair = np.zeros((int(new.sum()), 2), np.int64)
        pair[np.cumsum(new) - 1, places & 1] = nodes
        width = int(nodes.max(initial=0)) + 1
        codes, found = np.unique(pair[:, 0] * width + pair[:, 1], return_inverse=True)
        levels.append(np.concatenate([np.zeros((1, 2), np.int64), np.stack([codes // width, codes % width], 1)]))
        groups, places, nodes = groups[new], above[new], found.reshape(-1) + 1
    return levels, dict(zip(groups.tolist(), nodes.tolist(), strict=True))


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def compared(levels: list[np.ndarray], one: int, other: int, p: np.ndarray, q: np.ndarray) -> int:
    """Sum of prices over all leaves of two trees; ``p, q``: by leaf id, what a count comes to in either group."""
    steps, pairs = [], np.array([[one, other]], np.int64)
    for children in reversed(levels):
        left, right = children[pairs[:, 0]], children[pairs[:, 1]]
        below = np.concatenate([np.stack([left[:, side], right[:, side]], 1) for side in (0, 1)])
        width = int(below[:, 1].max()) + 1
        codes, back = np.unique(below[:, 0] * width + below[:, 1], return_inverse=True)
        steps.append(back.reshape(2, -1))
        pairs = np.stack([codes // width, codes % width], 1)
    values = price(p[pairs[:, 0]], q[pairs[:, 1]])
    for back in reversed(steps):
        values = values[back[0]] + values[back[1]]
    return int(values[0])


def shares(counts: np.ndarray, total: int, kept: int) -> np.ndarray:
    """``1 + floor(SCALE * (count + 2) / (total + 2 * kept))`` of distinct counts, exactly."""
    return np.array([1 + SCALE * (c + 2) // (total + 2 * kept) for c in counts.tolist()], np.int64)


def block_values(
    sources: list[str], totals: list[int], kept: int, groups: np.ndarray, terms: list[str], names: np.ndarray, counts: np.ndarray, top: int
) -> Iterator[tuple[str, str, str, int]]:
    """Of the terms of one block: ``source, part, item, value`` for pairs of sources (each once) and best terms.

    A count is given by the index of its source in ``groups`` and of its term in ``names``.
    """
    if not terms:
        yield from ((a, "pair", b, 0) for i, a in enumerate(sources) for b in sources[i + 1 :])
        return
    all_counts = np.zeros(len(terms), np.int64)
    np.add.at(all_counts, names, counts)
    order = sorted(range(len(terms)), key=lambda i: (-all_counts[i], terms[i]))
    place = np.empty(len(terms), np.int64)
    place[order] = np.arange(len(terms))
    sort = np.lexsort((place[names], groups))
    groups, names, counts = groups[sort], names[sort], counts[sort]
    different, leaves = np.unique(counts, return_inverse=True)
    height = (len(terms) - 1).bit_length()
    levels, roots = consed(groups, place[names], leaves.reshape(-1) + 1, height)
    by_leaf = [shares(np.r_[0, different], total, kept) for total in totals]
    padded = (1 << height) - len(terms)  # leaves beyond the last term, which both trees have as 0
    for i, a in enumerate(sources):
        for j in range(i + 1, len(sources)):
            value = compared(levels, roots.get(i, 0), roots.get(j, 0), by_leaf[i], by_leaf[j])
            yield a, "pair", sources[j], value - padded * int(price(by_leaf[i][0], by_leaf[j][0]))
    whole = shares(all_counts, sum(totals), kept)
    bounds = np.searchsorted(groups, np.arange(len(sources) + 1))
    for i, source in enumerate(sources):
        own = slice(bounds[i], bounds[i + 1])
        p, q = by_leaf[i][leaves.reshape(-1)[own] + 1], whole[names[own]]
        found = np.flatnonzero(p > q)
        values = price(p[found], q[found])
        if len(found) > top:  # ties with the last of the best stay until their names decide
            enough = values >= np.partition(values, len(values) - top)[len(values) - top]
            found, values = found[enough], values[enough]
        best = sorted((-v, terms[t]) for v, t in zip(values.tolist(), names[own][found].tolist(), strict=True))
        yield from ((source, "term", term, -v) for v, term in best[:top])


def divergences(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``lang, source, part, item, value, rank``: part ``pair`` with every other source, part ``term`` with the best terms."""
    counts = written(kept_counts(docs, least_docs))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sizes = counts.groupBy("lang").agg(F.sum(F.col("first").cast("long")).alias("kept"), F.count("*").alias("rows"))
    occurring = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"))
    groups = occurring.distinct().join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
    groups = written(groups.na.fill(0, ["total", "kept", "rows"]))
    blocks = F.greatest(F.lit(1), F.ceil(F.col("rows") / block_rows)).cast("long")
    langs = groups.groupBy("lang").agg(F.max(blocks).alias("blocks"))
    dealt = counts.join(langs, "lang").select(
        "lang", F.pmod(F.xxhash64("term"), "blocks").alias("block"), "source", "term", "n", F.lit(0).cast("long").alias("kept")
    )
    # Every block needs every group of its language: rows without a term hold the group's total.
    heads = groups.withColumn("blocks", blocks).select(
        "lang",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
        "source",
        F.lit(None).cast("string").alias("term"),
        F.col("total").alias("n"),
        "kept",
    )

    def valued(key: tuple, rows: pa.Table) -> pa.Table:
        is_head = np.asarray(rows.column("term").is_null())
        head, body = rows.filter(pa.array(is_head)), rows.filter(pa.array(~is_head))
        listed = sorted(zip(head.column("source").to_pylist(), head.column("n").to_pylist(), strict=True))
        sources = [source for source, _ in listed]
        index = {source: i for i, source in enumerate(sources)}
        encoded = {c: body.column(c).combine_chunks().dictionary_encode() for c in ("source", "term")}
        where = np.array([index[s] for s in encoded["source"].dictionary.to_pylist()], np.int64)
        values = block_values(
            sources,
            [total for _, total in listed],
            head.column("kept")[0].as_py(),
            where[np.asarray(encoded["source"].indices)],
            encoded["term"].dictionary.to_pylist(),
            np.asarray(encoded["term"].indices),
            np.asarray(body.column("n")),
            top,
        )
        columns = list(zip(*values, strict=True)) or [[]] * 4
        types = [pa.string(), pa.string(), pa.string(), pa.int64()]
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        lang = pa.array([key[0].as_py()] * len(arrays[0]), pa.string())
        return pa.Table.from_arrays([lang, *arrays], ["lang", "source", "part", "item", "value"])

    values = dealt.unionByName(heads).groupBy("lang", "block").applyInArrow(
        valued, "lang string, source string, part string, item string, value bigint"
    )
    values = values.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    there = F.struct("source", "item")
    back = F.struct(F.col("item").alias("source"), F.col("source").alias("item"))
    both = F.when(F.col("part") == "pair", F.array(there, back)).otherwise(F.array(there))
    values = values.select("lang", "part", "value", F.explode(both).alias("x")).select("lang", "x.source", "part", "x.item", "value")
    place = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item"))
    return values.withColumn("rank", place).where((F.col("part") == "pair") | (F.col("rank") <= top))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergences(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
t AS (SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT id) >= 10),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
gn AS (SELECT g.lang, g.source, coalesce(sum(n), 0)::HUGEINT AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (SELECT gn.lang, gn.source, kept.term, coalesce(n, 0) AS n,
        1 + 1000000000::HUGEINT * (coalesce(n, 0) + 2) // (total + 2 * v) AS p
      FROM gn JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)),
q AS (SELECT lang, term, 1 + 1000000000::HUGEINT * (sum(n) + 2) // (any_value(a.total) + 2 * any_value(v)) AS q
      FROM c JOIN v USING (lang) JOIN (SELECT lang, sum(total) AS total FROM gn GROUP BY lang) a USING (lang) GROUP BY lang, term),
pair AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
all_pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value
      FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
      FROM (SELECT * FROM all_pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
