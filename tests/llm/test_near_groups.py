"""Groups of texts that are nearly alike, but not enough to be linked."""

import random

import pytest

from chatnorm.llm import near_dup

WORDS = [f"w{k}" for k in range(200)]


def variant(r, changes):
    words = list(WORDS)
    for place in r.sample(range(4, 196, 5), changes):
        words[place] = f"x{r.random()}"
    return " ".join(words)


def sets(texts):
    return [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (t.split() for t in texts)]


@pytest.fixture
def confirmed(monkeypatch):
    counts, inner = [], near_dup._Texts.confirmed

    def counted(self, pairs, percent):
        counts.append(pairs.count())
        return inner(self, pairs, percent)

    monkeypatch.setattr(near_dup._Texts, "confirmed", counted)
    return counts


def test_pairs_of_a_group_without_links_are_told_apart_before_texts_are_read(spark, confirmed):
    r = random.Random(5)
    texts, own = [], []
    while len(texts) < 50:
        text = variant(r, 4)
        (new,) = sets([text])
        if all(len(new & other) < 0.72 * len(new | other) for other in own):
            texts.append(text)
            own.append(new)
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id bigint, text string")
    rows = near_dup.components(docs).collect()
    assert all(row.kept and row.component_id == row.doc_id for row in rows)
    assert sum(confirmed) <= len(texts)


def test_repeats_of_an_id_with_other_texts_meet_too(spark, confirmed):
    r = random.Random(6)
    one, other = "a " + variant(r, 2), "b " + variant(r, 3)
    far = " ".join(f"y{k}" for k in range(100))
    rows = [(7, one), (7, far), (7, far), (9, one + " end"), (3, far + " end"), (4, other), (4, other)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    own = sets([t for _, t in rows])
    root = {i: i for i, _ in rows}
    for _ in rows:
        for (i, _), a in zip(rows, own, strict=True):
            for (j, _), b in zip(rows, own, strict=True):
                if 100 * len(a & b) >= 75 * len(a | b):
                    root[i] = root[j] = min(root[i], root[j])
    assert {(row.doc_id, row.component_id) for row in near_dup.components(docs).collect()} == set(root.items())
