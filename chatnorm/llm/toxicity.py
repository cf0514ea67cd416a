"""Toxicity scores of texts after undoing disguised spelling (noisy channel and Viterbi).

1. A character language model: counts of letter triples over all texts, with one class for each of
   a-z, one for other letters and one for everything else.
2. Restoring: every word with a figure, a sign, a doubled letter or a format character (letters may be
   replaced or drawn out), and every run of two and more pieces of up to ``PIECE`` characters parted by
   white space, signs or format characters (letters may be set apart) is a lattice of letters it may
   stand for. Viterbi decoding finds the path that is most likely under the channel and the language
   model. Any other word has a lattice with one path and is its own restoration.
3. Scoring: words and beginnings of words of the restored text that mark toxic texts, each with the
   share of toxic ones among the training texts that have it. They are put together as independent
   causes: ``1 - (1 - p0) * product(1 - p)``.

Training takes at most ``sample_rows`` labelled rows (those whose ids have the smallest hashes; a
documented bound, so the sample can be broadcast, and so can the features, each of which several of these rows
hold), and never rows that ``held_out`` names. A feature is
kept if at least ``min_precision`` of its texts are toxic and its log-likelihood ratio exceeds what
chance gives the best of as many features as were counted.

Defined results: null and empty texts get the score of a text without marks, ``p0``. Without labelled
rows every score is 0. Several labels of an id: the largest counts; null labels and ids do not train.
Repeated rows give repeated results. Other columns of the input are not looked at.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, table, written

CLASSES = 28  # 0: no letter, 1-26: a-z, 27: another letter
OTHER = 27
CACHED_TOKENS = 300_000
#: Tokens without a mark that a scoring worker remembers.
CLEAN_TOKENS = 1_500_000
#: Pairs of counts that a training task holds before it hands them on.
HELD_FEATURES = 300_000

# The letters that a sign may stand for.
SIGNS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "{": "c", "€": "e", "£": "l", "¡": "i", "#": "h",
}
GAPS = set(".-_*~'`,/\\ ")
#: Characters that show nothing: soft hyphens, zero-width characters, marks of direction.
FORMAT = "\u00ad\u061c\u180e\u200b-\u200f\u202a-\u202e\u2060-\u2069\ufeff"
#: Characters of a piece in a run of pieces.
PIECE = 3
#: Channel: log probability that a letter is written as such, that a sign stands for a letter or for
#: itself, that a sign between letters stands for nothing, that a drawn-out letter is one or two, that a
#: doubled letter is one, that white space beside more than a single character stands for nothing.
PLAIN, SIGN, ITSELF, NOTHING, ONE, TWO, DRAWN, CLOSED = (math.log(p) for p in (0.9, 0.3, 0.1, 0.5, 0.6, 0.4, 0.3, 0.1))

_WORD = re.compile(r"[^\W\d_]+")
_EDGES = ".,;:?\"')]}>\u00ab\u00bb\u2018\u2019\u201c\u201d\u201e\u2026"
_UNSURE = re.compile(r"[^\w\s]|[\d_]|([^\W\d_])\1")
_GAP = r"[\s.\-_*~'`,/\\%s]" % FORMAT
_RUN = re.compile(rf"{_GAP}+|(.)\1*", re.DOTALL)
#: A run of pieces, in a text whose underscores, which are gaps, have become dashes.
_MEMBER = r"[\w@$!|+(<{€£¡#]"
_APART = re.compile(
    rf"{_MEMBER}(?<!\w.){_MEMBER}{{0,{PIECE - 1}}}(?:{_GAP}+{_MEMBER}{{1,{PIECE}}}(?!\w))+(?!\w)", re.DOTALL
)
_LETTERS_AND_GAPS = re.compile(rf"(?:[^\W\d]|{_GAP})*")
_GAPS = re.compile(rf"{_GAP}+")
_DOUBLED = re.compile(r"(.)\1+")
#: The beginning of a piece that leaves the decoder one state: two letters, neither of them doubled.
_SURE = re.compile(rf"(?<![^{_GAP[1:-1]}])([a-z])(?!\1)([a-z])(?!\2)")

_SINGLE = {chr(96 + k): (chr(96 + k), [((k,), PLAIN)]) for k in range(1, 27)}


def _class_of(c: str) -> int:
    """Class of a letter of a lower-cased text, or of no character."""
    return 0 if not c else ord(c) - 96 if "a" <= c <= "z" else OTHER


def letter_classes(text: str) -> np.ndarray:
    """Class of each character of a lower-cased text."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    classes = np.zeros(len(codes), np.int64)
    plain = (codes >= 97) & (codes <= 122)
    classes[plain] = codes[plain] - 96
    far = np.flatnonzero(codes > 127)
    if len(far):
        kinds, back = np.unique(codes[far], return_inverse=True)
        classes[far] = np.array([OTHER if chr(c).isalpha() else 0 for c in kinds], np.int64)[back]
    return classes


def triple_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``triple, n``: how often each triple of letter classes occurs in all texts."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES**3, np.int64)
        for _, texts in slices(batches, "t"):
            c = letter_classes("\n\n" + "\n\n".join(texts).lower() + "\n\n")
            total += np.bincount((c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:], minlength=CLASSES**3)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(total[found], pa.int64())], ["triple", "n"])

    parts = df.select(F.col(text_col).alias("t")).mapInArrow(counted, "triple int, n bigint")
    return parts.groupBy("triple").agg(F.sum("n").alias("n"))


class Restorer:
    """Viterbi decoding of disguised words under a table of log probabilities of letter triples."""

    def __init__(self, triples: dict[int, int]):
        counts = np.zeros(CLASSES**3)
        for triple, n in triples.items():
            counts[triple] = n
        counts = counts.reshape(CLASSES, CLASSES, CLASSES)
        one = counts.sum((0, 1)) + 1
        two = counts.sum(0) + 5 * one / one.sum()
        two = two / two.sum(1, keepdims=True)
        three = counts + 5 * two[None]
        self.log = np.log(three / three.sum(2, keepdims=True)).tolist()
        self._parts: dict[tuple[str, bool, bool], str] = {}

    def lattice(self, span: str) -> list[list[tuple[tuple[int, ...], float]]]:
        """For each run of a character, and each gap: the classes it may stand for and the channel's log probability."""
        return [ways for _, ways in self.columns(span)]

    def columns(self, span: str) -> list[tuple[str, list[tuple[tuple[int, ...], float]]]]:
        """The columns of the lattice with the character that each run is made of."""
        columns = []
        for m in _RUN.finditer(span):
            if (plain := _SINGLE.get(m.group())) is not None:
                columns.append(plain)
                continue
            c, run = m.group()[0], m.end() - m.start()
            if m.group(1) is None:
                before, after = span[max(m.start() - 2, 0) : m.start()], span[m.end() : m.end() + 2]
                single = not any(len(x) == 2 and x.isalnum() for x in (before, after))
                if single or not any(x.isspace() for x in m.group()):
                    columns.append((c, [((), NOTHING), ((0,), ITSELF)]))
                else:
                    columns.append((c, [((0,), PLAIN), ((), CLOSED)]))
            elif c.isalpha():
                k = ord(c) - 96 if "a" <= c <= "z" else OTHER
                if run == 1:
                    columns.append((c, [((k,), PLAIN)]))
                elif run == 2:
                    columns.append((c, [((k, k), PLAIN * 2), ((k,), DRAWN)]))
                else:
                    columns.append((c, [((k,), ONE), ((k, k), TWO)]))
            else:
                ways = [((ord(x) - 96,) * n, SIGN) for x in SIGNS.get(c, "") for n in ((1, 2) if run > 1 else (1,))]
                if c == "!" or unicodedata.category(c) in ("Cf", "Mn", "Me"):
                    ways.append(((), NOTHING))
                columns.append((c, [*ways, ((0,), ITSELF)]))
        return columns

    def decoded(self, columns: list, start: tuple[int, int], end: bool) -> str:
        """Most likely text of some columns after two classes; ``end`` tells that the span ends with them."""
        log = self.log
        best: dict[tuple[int, int], tuple[float, tuple | None]] = {start: (0.0, None)}
        for c, ways in columns:
            if len(ways) == 1 and len(best) == 1:  # all paths share this step, its probability decides nothing
                ((a, b), (score, path)), (classes, _) = *best.items(), ways[0]
                best = {(*((a, b, *classes)[-2:]),): (score, (path, classes, c))}
                continue
            step: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (score, path) in best.items():
                for classes, channel in ways:
                    x, y, s = a, b, score + channel
                    for k in classes:
                        if not (k == 0 and x == 0 and y == 0):
                            s += log[x][y][k]
                        x, y = y, k
                    if (x, y) not in step or s > step[x, y][0]:
                        step[x, y] = s, (path, classes, c)
            best = step
        _, (_, path) = max(
            ((score + log[a][b][0] * end, (score, path)) for (a, b), (score, path) in best.items()), key=lambda x: x[0]
        )
        out: list[str] = []
        while path:
            path, classes, c = path
            out.append("".join(c if k == OTHER else chr(96 + k) if k else " " for k in classes))
        return "".join(reversed(out))

    def restore(self, span: str) -> str:
        """Most likely words of a lower-cased span, parted by blanks; ties go to the first way of the lattice."""
        if span.isalpha():
            doubled = _DOUBLED.findall(span)
            if len(doubled) == 1 and (m := _DOUBLED.search(span)).end() - m.start() == 2:
                return self._one_doubled(span, m.start())
        return self.decoded(self.columns(span), (0, 0), True)

    def _one_doubled(self, word: str, at: int) -> str:
        """A word whose only doubled letter stands at ``at``. Its lattice has two paths, which differ in few steps."""
        before, k, after = (_class_of(c) for c in (word[at - 1 : at], word[at], word[at + 2 : at + 3]))
        log = self.log
        two = 2 * PLAIN + log[before][k][k] + log[k][k][after]
        return word if two >= DRAWN + log[before][k][after] else word[:at] + word[at + 1 :]

    def restore_run(self, span: str) -> str:
        """The same for a run of pieces. Two letters of one way each leave the decoder one state, so what is before
        and behind them is decoded on its own, and known parts are taken again."""
        out, start = [], 0
        for m in _SURE.finditer(span):
            out.append(self._part(span[max(start - 2, 0) : m.end()], start > 0, False))
            start = m.end()
        if start < len(span) or not out:
            out.append(self._part(span[max(start - 2, 0) :], start > 0, True))
        return "".join(out)

    def _part(self, text: str, behind: bool, end: bool) -> str:
        known = self._parts.get((text, behind, end))
        if known is None:
            columns = self.columns(text)
            if behind:
                known = self.decoded(columns[2:], (ord(text[0]) - 96, ord(text[1]) - 96), end)
            else:
                known = self.decoded(columns, (0, 0), end)
            if len(self._parts) >= CACHED_TOKENS:
                self._parts.clear()
            self._parts[text, behind, end] = known
        return known


def beginnings(word: str) -> list[str]:
    """Features of a word: itself, and its beginnings of three to six letters."""
    return [word, *("^" + word[:n] for n in range(3, min(6, len(word)) + 1))]


class Heads:
    """The first three letters of all features. A word that begins otherwise has no mark, and a stretch of letters
    and gaps that holds none of them, however its gaps and doubled letters are read, is not restored to one that has."""

    def __init__(self, features: dict[str, float]):
        self.heads = {f.removeprefix("^")[:3] for f in features}
        squeezed = {_DOUBLED.sub(r"\1", h) for h in self.heads}
        self._by_size = [(n, {h for h in squeezed if len(h) == n}) for n in sorted({len(h) for h in squeezed})]

    def may_begin(self, word: str) -> bool:
        return word[:3] in self.heads

    def may_hold(self, span: str) -> bool:
        if not _LETTERS_AND_GAPS.fullmatch(span):
            return True
        letters = _DOUBLED.sub(r"\1", _GAPS.sub("", span))
        return any(letters[i : i + n] in heads for n, heads in self._by_size for i in range(len(letters) - n + 1))


class Reader:
    """Words of texts with disguised ones restored; remembers a bounded number of tokens. With ``heads``, only what
    may be restored to a word with a mark is decoded."""

    def __init__(self, triples: dict[int, int], heads: Heads | None = None):
        self.restorer, self.heads = Restorer(triples), heads
        self._known: dict[str, tuple[str, ...]] = {}
        self._runs: dict[str, tuple[str, ...]] = {}

    def words_of(self, token: str) -> tuple[str, ...]:
        known = self._known.get(token)
        if known is None:
            words = _WORD.findall(token)
            bare = token.strip(_EDGES)
            if _UNSURE.search(bare) and (self.heads is None or self.heads.may_hold(bare)):
                words += self.restorer.restore(bare).split()
            known = tuple(words)
            if self.heads is None:  # else the caller remembers what it makes of them
                if len(self._known) >= CACHED_TOKENS:
                    self._known.clear()
                self._known[token] = known
        return known

    def spaced(self, low: str) -> list[str]:
        """Words of three letters and more that are set apart: those that aren't pieces of their run."""
        found: set[str] = set()
        for m in _APART.finditer(low.replace("_", "-")):
            span = m.group()
            words = self._runs.get(span)
            if words is None:
                words = ()
                if self.heads is None or self.heads.may_hold(span):
                    pieces = span.split()
                    words = tuple(w for w in self.restorer.restore_run(span).split() if len(w) > 2 and w not in pieces)
                if len(self._runs) >= CACHED_TOKENS:
                    self._runs.clear()
                self._runs[span] = words
            if words:
                found.update(words)
        return sorted(found)

    def words(self, text: str) -> set[str]:
        low = text.lower()
        found: set[str] = set()
        for token in set(low.split()):
            found.update(self.words_of(token))
        found.update(self.spaced(low))
        return found


@dataclass
class Model:
    triples: dict[int, int] = field(default_factory=dict)
    features: dict[str, float] = field(default_factory=dict)
    prior: float = 0.0


class Scorer:
    """Scores of texts; remembers tokens without a mark, and the marks of the others."""

    def __init__(self, model: Model):
        self.model, self.heads = model, Heads(model.features)
        self.reader = Reader(model.triples, self.heads)
        self._marks: dict[str, tuple[tuple[str, float], ...]] = {}
        self._clean: set[str] = set()

    def _of_word(self, word: str) -> float:
        if not self.heads.may_begin(word):
            return 0.0
        return max((self.model.features.get(f, 0.0) for f in beginnings(word)), default=0.0)

    def _may_have_mark(self, token: str) -> bool:
        """False only where :meth:`_of_token` has nothing; cheap for a word."""
        if not token.isalpha():
            return True
        return self.heads.may_begin(token) or bool(_DOUBLED.search(token)) and self.heads.may_hold(token)

    def _of_token(self, token: str) -> tuple[tuple[str, float], ...]:
        return tuple((w, p) for w in self.reader.words_of(token) if (p := self._of_word(w)))

    def score(self, text: str) -> float:
        low = text.lower()
        found: dict[str, float] = {}
        # What stands at the edges of a token doesn't matter, and many tokens differ in it alone.
        for token in {t.strip(_EDGES) for t in set(low.split())} - self._clean:
            marks = self._marks.get(token)
            if marks is None:
                marks = self._of_token(token) if self._may_have_mark(token) else ()
                if marks:
                    if len(self._marks) >= CACHED_TOKENS:
                        self._marks.clear()
                    self._marks[token] = marks
                else:
                    if len(self._clean) >= CLEAN_TOKENS:
                        self._clean.clear()
                    self._clean.add(token)
            found.update(marks)
        for word in self.reader.spaced(low):
            if p := self._of_word(word):
                found[word] = p
        harmless = math.log1p(-self.model.prior)
        return 1.0 - math.exp(harmless + sum(math.log1p(-found[w]) for w in sorted(found)))


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    train: Column | None = None,
    sample_rows: int = 40_000,
    min_precision: float = 0.9,
) -> Model:
    """Learn from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic). ``train`` tells which labels may be used."""
    triples = {r["triple"]: r["n"] for r in triple_counts(docs).toLocalIterator()}
    usable = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("y"))
    if train is not None:
        usable = usable.where(train)
    # At most sample_rows rows of two numbers: small enough for every executor, whatever the input.
    sample = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows).select(F.col("doc_id").alias("i"), "y")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(triples)
        held, toxic = Counter(), Counter()
        of_word: dict[str, list[str]] = {}

        def hand_on() -> pa.RecordBatch:
            columns = [pa.array(held.keys(), pa.string()), pa.array([toxic[f] for f in held], pa.int64()), pa.array(held.values(), pa.int64())]
            held.clear()
            toxic.clear()
            of_word.clear()
            return pa.RecordBatch.from_arrays(columns, ["feature", "toxic", "n"])

        for batch, texts in slices(batches, "t"):
            for y, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                features = {""}
                for w in reader.words(text):
                    if (own := of_word.get(w)) is None:
                        own = of_word[w] = beginnings(w)
                    features.update(own)
                held.update(features)
                if y:
                    toxic.update(dict.fromkeys(features, int(y)))
            if len(held) > HELD_FEATURES:
                yield hand_on()
        yield hand_on()

    counts = (
        docs.select(F.col("doc_id").alias("i"), F.col("text").alias("t"))
        .join(F.broadcast(sample), "i")
        .select(F.col("y").cast("long").alias("y"), "t")
        .mapInArrow(counted, "feature string, toxic bigint, n bigint")
        .groupBy("feature")
        .agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))
        .where("n >= 3 OR feature = ''")
    )
    counts = written(counts)  # read twice below
    a, n = F.col("toxic").cast("double"), F.col("n").cast("double")
    # The number of features counted and the totals ride along with the few features that can qualify.
    totals = counts.agg(
        F.max(F.when(F.col("feature") == "", F.struct("toxic", "n"))).alias("all"), F.count("*").alias("tried")
    ).first()
    if not totals["all"] or not totals["all"]["toxic"]:
        return Model(triples, {}, 0.0)
    toxic, rows = float(totals["all"]["toxic"]), float(totals["all"]["n"])
    rate = min(toxic / rows, 1 - 1e-6)

    def part(k: Column, of: Column) -> Column:
        return F.when(k > 0, k * F.log(k / of)).otherwise(0.0)

    ratio = 2 * (part(a, n * rate) + part(n - a, n * (1 - rate)))
    chance = 2 * math.log(max(totals["tried"], 2)) + 10
    kept = (
        counts.where("feature <> ''")
        .withColumn("p", (a + 2 * rate) / (n + 2))
        .where((a >= min_precision * n) & (ratio > chance) & (F.col("p") > rate))
        .select("feature", "p")
    )
    features = {r["feature"]: r["p"] for r in kept.collect()}
    return Model(triples, features, rate / 2)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, score`` of each row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch, texts in slices(batches, "t"):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(scorer.score, texts), pa.float64())], ["i", "score"]
            )

    return (
        docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
        .mapInArrow(scored, f"i {kind}, score double")
        .withColumnRenamed("i", id_col)
    )


def keep_harmless(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` with a score below ``threshold``, all columns as they are."""
    place = docs.columns.index(text_col)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            names = [f"c{i}" for i in range(batch.num_columns)]
            plain = pa.RecordBatch.from_arrays(batch.columns, names)
            for part, texts in slices(iter([plain]), f"c{place}"):
                yield part.filter(pa.array([scorer.score(t) < threshold for t in texts], pa.bool_()))

    named = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return named.mapInArrow(kept, named.schema).toDF(*docs.columns)


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents; learned from labelled documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"), ~held_out())
    return score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
