"""Secrets in texts: fixed patterns, and strings of high entropy in sliding windows.

Patterns (``assign``, ``access``, ``hex``) give the base spans. The method adds ``entropy`` spans: a
candidate is a run of letters, figures and ``+/_=-`` of at least 16 characters with a letter. Windows of
16, 20 and 24 characters slide over it; Shannon entropy is kept up to date by taking one character out of the
counts and one in, for each character class (hexadecimal, letters, letters and figures, all) on its own: the
entropy of a window counts for the narrowest class that holds all its characters. Windows at or above
the threshold of their class and length are joined to spans. The thresholds are those that 90 of 100 random
strings of exactly that length reach; of longer ones more are found. Candidates that the allow list names (UUIDs,
words joined by dashes and the like where every one of them looks like a word, straight runs of the alphabet or of figures, digests named as such) are left out, and
so are spans that a base span covers.

Defined results: null and empty texts have no spans. Repeated rows give repeated results, null ids are
passed on. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, table

# The base patterns.
_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")  # the runs of 32 and more among all runs
KINDS = ("assign", "access", "hex", "entropy")

_LOWER, _UPPER, _FIGURES = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Bits per character from which a window counts, by its length, for each class below. The tenth percentile of
#: 200,000 random strings of the class, or less; letters of one case with figures as for 32 symbols (base32).
THRESHOLDS = {
    16: (2.95, 2.95, 3.2, 3.2, 3.32, 3.32, 3.5, 3.57),
    20: (3.12, 3.12, 3.44, 3.44, 3.54, 3.54, 3.78, 3.82),
    24: (3.2, 3.2, 3.6, 3.6, 3.74, 3.74, 3.97, 4.0),
}
#: Members of the classes from narrow to wide.
MEMBERS = tuple(
    map(
        frozenset,
        (
            _FIGURES + "abcdef", _FIGURES + "ABCDEF", _LOWER, _UPPER, _LOWER + _FIGURES, _UPPER + _FIGURES,
            _LOWER + _UPPER, _LOWER + _UPPER + _FIGURES + "+/_=-",
        ),
    )
)
LEAST, WINDOW = min(THRESHOLDS), max(THRESHOLDS)
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST)
#: The classes with the thresholds of the longest window.
CLASSES = tuple(zip(MEMBERS, THRESHOLDS[WINDOW], strict=True))
ALLOWED = (
    re.compile(r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"),
    re.compile(r"(?:sha(?:1|256|512)|md5)[-_=][0-9A-Za-z+/=]+", re.IGNORECASE),
)
_JOINTS = re.compile(r"[-_/=+]")
_SEGMENT = re.compile(r"([A-Z]?[a-z]*|[A-Z]*)[0-9]{0,4}")
_SIX_CONSONANTS, _CROWDED = re.compile(r"[^aeiouy]{6}"), re.compile(r"[^aeiouy]{5}|[aeiouy]{4}")
#: The share of steps to the next character (``abc``, ``123``) from which a run is a straight one.
STRAIGHT = 0.5
_BITS = [0.0] + [n * math.log2(n) for n in range(1, WINDOW + 2)]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    spans = []
    for m in _ASSIGN.finditer(text):
        if m.end(2) - m.start(2) >= 8:
            spans.append((m.start(), m.end(), "assign"))
    if "AKIA" in text:
        spans += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    spans += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def plain_word(segment: str) -> bool:
    """Whether letters, with up to four figures behind them, look like a word: in one case or with a capital, and
    the longer they are, the more like a word in their vowels. A random string of 16 and more does in 1 of 10 cases."""
    if not (m := _SEGMENT.fullmatch(segment)):
        return False
    letters = m[1].lower()
    vowels, n = sum(c in "aeiouy" for c in letters), len(letters)
    if n <= 5:
        return True
    if n <= 12:
        return 5 * vowels >= n and not _SIX_CONSONANTS.search(letters)
    return n <= 20 and n <= 3 * vowels <= 2 * n and not _CROWDED.search(letters)


def allowed(candidate: str) -> bool:
    if any(p.fullmatch(candidate) for p in ALLOWED):
        return True
    segments = _JOINTS.split(candidate)
    if len(segments) > 1 and all(map(plain_word, segments)):
        return True
    steps = sum(ord(b) - ord(a) == 1 for a, b in zip(candidate, candidate[1:], strict=False))
    return steps >= STRAIGHT * (len(candidate) - 1)


def entropy_windows(candidate: str, window: int = WINDOW) -> list[tuple[int, int]]:
    """Joined windows of one length whose entropy reaches the threshold of their narrowest class (start, end)."""
    counts: dict[str, int] = {}
    thresholds = THRESHOLDS[window]
    outside = [0] * len(MEMBERS)  # characters of the window that a class lacks
    total = 0.0  # sum of n log n over the counts; entropy is log W - total / W
    spans: list[list[int]] = []

    def change(c: str, by: int) -> None:
        nonlocal total
        n = counts.get(c, 0)
        total += _BITS[n + by] - _BITS[n]
        counts[c] = n + by
        for k, members in enumerate(MEMBERS):
            if c not in members:
                outside[k] += by

    for i, c in enumerate(candidate):
        change(c, 1)
        if i >= window:
            change(candidate[i - window], -1)
        if i >= window - 1:
            entropy = math.log2(window) - total / window
            least = next(least for k, least in enumerate(thresholds) if not outside[k])
            if entropy >= least - 1e-9:
                start = i - window + 1
                if spans and start <= spans[-1][1]:
                    spans[-1][1] = i + 1
                else:
                    spans.append([start, i + 1])
    return [(a, b) for a, b in spans]


def all_windows(candidate: str) -> list[tuple[int, int]]:
    """Joined windows of all lengths."""
    spans: list[tuple[int, int]] = []
    for a, b in sorted(span for w in THRESHOLDS if w <= len(candidate) for span in entropy_windows(candidate, w)):
        if spans and a <= spans[-1][1]:
            spans[-1] = spans[-1][0], max(b, spans[-1][1])
        else:
            spans.append((a, b))
    return spans


def entropy_spans(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    found = []
    for m in _CANDIDATE.finditer(text):
        s = m.group()
        if not any(c.isalpha() for c in s) or allowed(s):
            continue
        for a, b in all_windows(s):
            a, b = a + m.start(), b + m.start()
            if not any(x <= a and b <= y for x, y, _ in base):
                found.append((a, b, "entropy"))
    return found


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def secret_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, spans`` of each row; spans are structs ``kind, start, end`` (code points, end exclusive) by start."""
    kind = df.schema[id_col].dataType.simpleString()
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "t"):
            rows = []
            for text in texts:
                base = base_spans(text)
                spans = sorted(base + entropy_spans(text, base), key=lambda s: (s[0], KINDS.index(s[2])))
                rows.append([{"kind": k, "start": a, "end": b} for a, b, k in spans])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(span))], ["i", "spans"])

    return (
        df.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
        .mapInArrow(scanned, f"i {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>")
        .withColumnRenamed("i", id_col)
    )


def op6_secret_scans(spark, sf_dir: str) -> DataFrame:
    found = secret_spans(table(spark, sf_dir, "documents"))

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def listed(spans):
        text = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(text, ",")

    base = F.filter("spans", lambda s: s["kind"] != "entropy")
    return found.select(
        "doc_id",
        number("assign"),
        number("access"),
        number("hex"),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed("spans").alias("spans"),
    )


def digest(spans: list[tuple[int, int, str]]) -> str:
    return hashlib.sha256(joined(spans).encode()).hexdigest()
