"""A line that many documents hold with varying surroundings."""

import hashlib
import random

import numpy as np

from chatnorm.llm import substring_dedup


def test_strings_of_a_hot_trigger_are_dealt_apart(spark):
    r = random.Random(5)
    line = "".join(r.choice("abcdefgh ") for _ in range(70))

    def noise():
        return "".join(r.choice("stuvwxyz ") for _ in range(r.randint(20, 90)))

    rows = [(i, noise() + line[: r.choice((40, 55, 70, 70))] + noise()) for i in range(300)] + [(900, noise() * 3), (901, "")]
    expected = substring_dedup.brute_force([(i, t.encode()) for i, t in rows])
    for hot in (3, 10**9):
        frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
        got = substring_dedup.without_repeats(frame, hot=hot).collect()
        assert len(got) == len(rows)
        for x in got:
            assert (x["n_bytes"], x["n_removed"], x["n_spans"], hashlib.sha256(x["kept"]).hexdigest()) == expected[x["doc_id"]]


def test_strings_of_a_hot_trigger_in_a_block():
    line = "a common line of more than fifty bytes that many documents hold once"
    texts = [f"{i * 7919:040d}{line}{i * 104729:060d}".encode() for i in range(200)]
    raw = np.frombuffer(b"".join(texts), np.uint8)
    parsed = substring_dedup.Parsed(np.arange(200), np.cumsum([len(t) for t in texts]), raw)
    first, of = parsed.firsts()
    assert np.bincount(of).max() == 200
    place, doc, one, two = parsed.strings(parsed.order[parsed.new][of == np.bincount(of).argmax()])
    assert len(place) == len(doc) and not np.all(substring_dedup._repeats(one, two, parsed.ids[doc]))


def test_triggers_are_dealt_evenly():
    raw = np.random.default_rng(4).integers(97, 123, 100_000).astype(np.uint8)
    parsed = substring_dedup.Parsed(np.arange(1), np.array([len(raw)]), raw)
    counts = np.bincount(substring_dedup._part_of(parsed.trigger, 16), minlength=16)
    assert counts.max() < 2 * counts.min()
