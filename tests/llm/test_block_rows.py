"""What blocks send to the parts, and the steps before strings are compared."""

import hashlib
import random

import numpy as np
import pytest

from chatnorm.llm import substring_dedup
from chatnorm.llm.substring_dedup import LENGTH, REACH, TRIGGER


def test_blocks_send_few_rows(spark, monkeypatch):
    r = random.Random(8)
    words = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 9))) for _ in range(4000)]
    rows = [(i, " ".join(r.choices(words, k=5000))) for i in range(110)]
    rows += [(200, rows[3][1][:9000]), (201, rows[5][1][1000:4000] + rows[7][1][:50])]
    tables = []
    monkeypatch.setattr(substring_dedup, "written", lambda df, f=substring_dedup.written: tables.append(f(df)) or tables[-1])
    got = {x["doc_id"]: x for x in substring_dedup.without_repeats(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)).collect()}
    assert sum(len(t) for _, t in rows) > 3_000_000
    # One block: a row for each of 8 parts, as many for strings of hot triggers, and what is settled at once.
    assert tables[0].count() <= 2 * 8 + 2
    expected = substring_dedup.brute_force([(i, t.encode()) for i, t in rows if i in (3, 5, 7, 200, 201)])
    for i in (200, 201):
        x = got[i]
        assert (x["n_bytes"], x["n_removed"], x["n_spans"], hashlib.sha256(x["kept"]).hexdigest()) == expected[i]
    assert expected[200][1] == 9000 and expected[201][1] == 3050


@pytest.mark.parametrize("gb", [0.5, 2, 10])
def test_rows_of_blocks_and_parts_stay_few(gb):
    total = int(gb * 1e9)
    parts = substring_dedup._parts(total)
    assert parts * (32 << 20) >= total
    assert 2 * parts * total / substring_dedup.BLOCK_CHARS < 200_000 * gb  # with blocks of 1 MB, parts of 8 MB: 23 800 000 at 10 GB


def _phrases(shared: int, n: int):
    """Phrases with one trigger, of which ``shared`` bytes from 12 before the trigger on are equal, too."""
    r = np.random.default_rng(shared)
    raw = r.integers(97, 123, (n, REACH + LENGTH)).astype(np.uint8)
    raw[:, REACH : REACH + TRIGGER] = 42
    raw[:, REACH - 12 : REACH - 12 + shared] = np.arange(shared)
    size = np.full(n, raw.shape[1])
    return raw.reshape(-1), np.cumsum(size) - size, size, np.full(n, REACH)


def test_phrases_that_share_less_than_a_string_go_no_further():
    for shared, some in ((TRIGGER + 12, False), (LENGTH, True), (LENGTH + 9, True)):
        raw, begin, size, offset = _phrases(shared, 300)
        which, first, n = substring_dedup._classes(raw, begin, size, offset, np.arange(300))
        assert bool(len(which)) == some
        kept = {(w, f + i) for w, f, k in zip(which.tolist(), first.tolist(), n.tolist(), strict=True) for i in range(k)}
        repeated = {(w, REACH - 12 + i) for w in range(300) for i in range(shared - LENGTH + 1)}
        assert repeated <= kept and len(kept) <= 300 * 16
        assert not len(substring_dedup._classes(raw, begin, size, offset, np.zeros(300, np.int64))[0])  # one id


def test_classes_hold_all_repeated_strings_of_cut_phrases():
    r = random.Random(6)
    line = "".join(r.choice("abcdef") for _ in range(130))
    raw, begin, size, offset, places = b"", [], [], [], []
    for _ in range(200):
        left, right = r.randint(0, REACH), r.randint(TRIGGER, LENGTH)
        if left + right >= LENGTH:
            begin.append(len(raw))
            size.append(left + right)
            offset.append(left)
            changed = list(line[40 - left : 40 + right])
            changed[r.randrange(len(changed))] = r.choice("abcdef")
            changed[left : left + TRIGGER] = line[40 : 40 + TRIGGER]
            raw += "".join(changed).encode()
    ident = np.arange(len(begin)) // 2
    which, first, n = substring_dedup._classes(np.frombuffer(raw, np.uint8), *map(np.array, (begin, size, offset)), ident)
    kept = {(w, f + i) for w, f, k in zip(which.tolist(), first.tolist(), n.tolist(), strict=True) for i in range(k)}
    ids = {}
    for w, (b, s) in enumerate(zip(begin, size, strict=True)):
        for i in range(s - LENGTH + 1):
            ids.setdefault(raw[b + i : b + i + LENGTH], set()).add(int(ident[w]))
            places.append((w, i, raw[b + i : b + i + LENGTH]))
    assert {(w, i) for w, i, x in places if len(ids[x]) > 1} <= kept <= {(w, i) for w, i, _ in places}


def test_equal_hashes_do_not_make_strings_equal(monkeypatch):
    r = np.random.default_rng(2)
    raw = r.integers(0, 2, 60 * LENGTH).astype(np.uint8)
    raw[: 20 * LENGTH] = np.tile(raw[:LENGTH], 20)
    raw[20 * LENGTH : 30 * LENGTH] = np.tile(raw[20 * LENGTH : 21 * LENGTH], 10)
    at, trigger, ident = np.arange(60) * LENGTH, (np.arange(60) % 2).astype(np.uint64), r.integers(0, 9, 60)
    keys = [(raw[a : a + LENGTH].tobytes(), int(t)) for a, t in zip(at, trigger, strict=True)]
    expected = [i > min(j for k, j in zip(keys, ident, strict=True) if k == key) for key, i in zip(keys, ident, strict=True)]
    assert substring_dedup._repeated_suffixes(raw, at, trigger, ident).tolist() == expected
    zeros = np.zeros(len(raw) + 1, np.uint64)
    monkeypatch.setattr(substring_dedup, "_sums", lambda _: (zeros, zeros))  # a hash of the trigger only
    assert substring_dedup._repeated_suffixes(raw, at, trigger, ident).tolist() == expected


def test_order_is_that_of_all_keys():
    r = np.random.default_rng(1)
    for top in (1, 5, 1 << 20, 1 << 32, (1 << 64) - 1):
        for n in (0, 1, 2, 700):
            keys = [r.integers(0, top, n, np.uint64, endpoint=True), r.integers(0, 3, n), r.integers(0, 1 << 62, n)]
            keys[0][n // 2 :] = keys[0][: n - n // 2]
            assert substring_dedup._ordered(*keys).tolist() == np.lexsort(keys[::-1]).tolist()
            assert keys[0][substring_dedup._ordered(keys[0])].tolist() == sorted(keys[0].tolist())


def test_hashes_depend_on_the_bytes_alone():
    r = np.random.default_rng(7)
    text = r.integers(97, 101, 300).astype(np.uint8)
    step = substring_dedup.STEP
    raw = r.integers(97, 101, 3 * step).astype(np.uint8)
    spots = [0, step - 150, 2 * step - 90, 3 * step - 300]
    for at in spots:
        raw[at : at + 300] = text
    parsed = substring_dedup.Parsed(np.arange(1), np.array([len(raw)]), raw)
    seen = set()
    for at in spots:
        inside = (parsed.places >= at + REACH + LENGTH) & (parsed.places < at + 300 - 2 * LENGTH)
        seen.add(tuple(zip((parsed.places[inside] - at).tolist(), parsed.trigger[inside].tolist(), parsed.phrase[inside].tolist(), strict=True)))
    assert len(seen) == 1 and len(seen.pop()) > 2
