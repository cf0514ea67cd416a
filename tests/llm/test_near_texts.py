"""Near duplicates on texts: recall close to the least similarity, groups that are half alike, clashing columns."""

import random

import pytest

from chatnorm.llm import exact_dedup, near_dup


def shingled(text):
    w = text.split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def similarity(a, b):
    a, b = shingled(a), shingled(b)
    return len(a & b) / len(a | b)


def text(r, n):
    return [f"w{r.randrange(10**6)}" for _ in range(n)]


def neighbour(r, words, least, most):
    """A text whose similarity to another lies in a range: words behind a cut are new ones."""
    for _ in range(10_000):
        cut = int(len(words) * r.uniform(0.7, 0.95))
        other = words[:cut] + text(r, len(words) - cut)
        if least <= similarity(" ".join(words), " ".join(other)) <= most:
            return other
    raise AssertionError("no such text")


def test_recall_between_75_and_80_percent(spark):
    r = random.Random(11)
    rows, pairs = [], 400
    for k in range(pairs):
        words = text(r, r.randrange(60, 240))
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(neighbour(r, words, 0.75, 0.80)))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {x.doc_id: x.component_id for x in near_dup.components(docs).collect()}
    assert all(found[2 * k + 1] == 2 * k for k in range(pairs))


def test_texts_that_are_half_alike_are_told_apart_by_bits(spark):
    r = random.Random(12)
    shared = text(r, 130)
    rows = [(k, " ".join(shared + text(r, 65))) for k in range(300)]
    near = neighbour(r, rows[7][1].split(), 0.78, 0.9)
    rows.append((999, " ".join(near)))
    assert 0.45 < similarity(rows[0][1], rows[1][1]) < 0.55
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    tested = []
    real = near_dup._Texts.confirmed

    def counted(self, pairs, percent):
        tested.append(pairs.count())
        return real(self, pairs, percent)

    near_dup._Texts.confirmed = counted
    try:
        found = {x.doc_id: x.component_id for x in near_dup.components(docs).collect()}
    finally:
        near_dup._Texts.confirmed = real
    assert found == {k: k for k in range(300)} | {999: 7}
    assert sum(tested) < 0.02 * 300 * 299 / 2


def test_lower_similarities_are_refused(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id bigint, text string")
    with pytest.raises(ValueError, match="75"):
        near_dup.components(docs, percent=50)


def test_columns_may_have_any_name(spark):
    names = "_dropped bigint, _digest string, row string, id bigint, digest binary, doc_id bigint, text string, keep_id int"
    rows = [(i, "x", "y", 7, b"z", i, "same text of five words here", 1) for i in range(3)]
    docs = spark.createDataFrame(rows, names)
    for drop, kept in ((exact_dedup.drop_copies, 2), (near_dup.drop_near_copies, 0)):
        out = drop(docs)
        assert out.columns == docs.columns
        assert [tuple(x) for x in out.collect()] == [rows[kept]]


def test_written_tables_are_removed(spark):
    from pathlib import Path

    root = Path(spark.conf.get("spark.checkpoint.dir")) / "chatnorm"
    before = {p for p in root.iterdir() if any(p.iterdir())} if root.exists() else set()
    docs = spark.createDataFrame([(i, "a b c d e f" + " g" * (i // 2)) for i in range(6)], "doc_id bigint, text string")
    near_dup.components(docs).count()
    assert len({p for p in root.iterdir() if any(p.iterdir())} - before) <= 1  # the result
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("texts_")]


def test_components_of_any_shape(spark):
    r = random.Random(13)
    links = [(i, i + 1) for i in range(100, 160)] + [(200 + i, 200) for i in range(1, 30)] + [(300 - i, 300) for i in range(1, 9)]
    links += [(r.randrange(400, 460), r.randrange(400, 460)) for _ in range(50)] + [(7, 7), (8, 9), (9, 8)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    scratch = near_dup._Scratch(spark)
    found = near_dup.connected(spark.createDataFrame(links, "a bigint, b bigint"), scratch)
    assert {x.node: x.root for x in found.collect()} == {x: find(x) for x in root if find(x) != x}
    scratch.drop_all()
    assert near_dup.connected(spark.createDataFrame([], "a bigint, b bigint"), scratch).count() == 0
