"""Recall of the entropy windows on random strings."""

import math
import random

import pytest

from chatnorm.llm import secrets


@pytest.mark.parametrize("length, share", [(16, 0.85), (20, 0.85), (24, 0.85), (32, 0.97)])
def test_recall_of_random_strings(length, share):
    r, lower, figures = random.Random(length), "abcdefghijklmnopqrstuvwxyz", "0123456789"
    kinds = (lower.upper() + "234567", lower + figures, lower + lower.upper() + figures, lower + lower.upper(), lower)
    for symbols in kinds:
        strings = ["".join(r.choice(symbols) for _ in range(length)) for _ in range(400)]
        found = sum(bool(secrets.entropy_spans(f"x {s} y", [])) for s in strings)
        assert found >= share * len(strings), (symbols, found)


@pytest.mark.parametrize("prefix", ["sk_live_", "ghp_", "xoxb-", "glpat-", "AIza-", "pk/"])
def test_recall_of_random_strings_behind_a_prefix(prefix):
    r, lower, figures = random.Random(prefix), "abcdefghijklmnopqrstuvwxyz", "0123456789"
    kinds = (lower.upper() + "234567", lower + figures, lower + lower.upper() + figures, lower + lower.upper(), lower)
    for symbols in kinds:
        for length in (20, 24, 32):
            strings = [prefix + "".join(r.choice(symbols) for _ in range(length)) for _ in range(300)]
            found = sum(bool(secrets.entropy_spans(f"x {s} y", [])) for s in strings)
            assert found >= 0.85 * len(strings), (symbols, length, found)


def test_names_made_of_words_are_allowed():
    for name in (
        "some-long-file-name-2024", "path/to/some/module_name", "foo_bar_baz_qux_quux", "application/x-www-form-urlencoded",
        "a=b+c/d-e_f=g+h/i-j", "MAX_CONNECTION_TIMEOUT_SECONDS", "src/main/resources/Internationalization", "README-2024-01-31-final",
    ):
        assert secrets.allowed(name), name
        assert not secrets.entropy_spans(name, [])


def joined_directly(candidate):
    """Windows of all lengths, each counted on its own, as sets of places."""
    places = set()
    for window, thresholds in secrets.THRESHOLDS.items():
        for i in range(len(candidate) - window + 1):
            part = candidate[i : i + window]
            shares = [part.count(c) / window for c in set(part)]
            least = next(t for members, t in zip(secrets.MEMBERS, thresholds, strict=True) if set(part) <= members)
            if -sum(p * math.log2(p) for p in shares) >= least - 1e-9:
                places.update(range(i, i + window))
    return places


def test_windows_of_all_lengths_are_joined_as_if_counted_directly():
    r = random.Random(8)
    for _ in range(200):
        symbols = r.choice(["abcdef0123456789", "abcdefghij", "ABCDEFGHIJKLMNOPqrstuvwxyz0123456789+/_=-", "aab"])
        s = "".join(r.choice(symbols) for _ in range(r.randrange(16, 70)))
        assert {p for a, b in secrets.all_windows(s) for p in range(a, b)} == joined_directly(s)


def test_base_spans_cover_entropy_spans_and_allowed_names_suppress_them():
    r = random.Random(10)
    key = "".join(r.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(28))
    for text, expected in (
        (f'token = "{key}"', ["assign"]), (f"see {key} there", ["entropy"]), ("a" * 40, ["hex"]), (f"sha256-{key}", []),
        ("1b4e28ba-2fa1-11d2-883f-0016d3cca427", []), ("abcdefghijklmnopqrstuvwxyz", []), ("x" * 30, []),
    ):
        base = secrets.base_spans(text)
        assert [k for _, _, k in base + secrets.entropy_spans(text, base)] == expected, text
