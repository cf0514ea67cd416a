"""Repeated strings of a part of the dictionary against a search string by string."""

import numpy as np

from chatnorm.llm.substring_dedup import LENGTH, _repeated_suffixes


def test_strings_that_differ_in_their_last_byte_or_trigger_are_told_apart():
    r = np.random.Generator(np.random.PCG64(3))
    stem = r.integers(0, 256, LENGTH, np.uint8)
    raw, entries = [], []
    for k in range(400):
        text = stem.copy()
        text[r.integers(0, LENGTH)] = r.integers(0, 3)
        if k % 4 == 0:
            text[-1] = k % 3
        entries.append((len(raw) * LENGTH, int(r.integers(0, 2)), int(r.integers(0, 40))))
        raw.append(text)
    raw = np.concatenate(raw)
    at, trigger, ident = (np.array(x) for x in zip(*entries, strict=True))
    hit = _repeated_suffixes(raw, at, trigger.astype(np.uint64), ident)
    keys = [(raw[a : a + LENGTH].tobytes(), t) for a, t, _ in entries]
    least = {}
    for key, i in zip(keys, ident.tolist(), strict=True):
        least[key] = min(i, least.get(key, i))
    assert hit.tolist() == [least[key] < i for key, i in zip(keys, ident.tolist(), strict=True)]
    assert 0 < hit.sum() < len(hit)
