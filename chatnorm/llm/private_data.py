"""Personal data in texts, also where it is disguised, as spans of the source text.

Patterns (``email``, ``ip``, ``card``, ``phone``) give the base spans. The method adds spans of the same kinds: a
cascade of transducers rewrites the text, the same patterns read what comes out, and a span is mapped back through
the stages to the characters that it was made of. Every stage is a set of edits (start, end, output) of its input:

1. homoglyphs: look-alikes of other alphabets, full-width and styled forms, figures of other scripts, dashes, dots
   and blanks to ASCII; soft hyphens, zero-width and other format characters are taken out;
2. spelled figures (English, German, French, Spanish; ``double``, ``triple``, ``plus``) to figures; ``O``, ``o``, ``l``
   and ``I`` within numbers likewise;
3. ``at`` and ``dot`` in brackets, as character references or ``_at_``, and as bare words where a domain follows.

Found spans count if a rewritten character is in them. One that begins like a base span of its kind and only goes on
over a bare word is left out, since that word may be plain language. All patterns take time linear in the text:
runs are met from their beginning only, and bounded blanks stand around signs.

Defined results: null and empty texts have no spans. Repeated rows give repeated results, null ids are passed on.
Spans of different kinds may overlap. Other columns are not looked at.
"""

from __future__ import annotations

import itertools
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, table

KINDS = ("email", "ip", "card", "phone")
_SPAN = "kind:string,start:bigint,end:bigint,base:boolean,value:string"

# Base patterns.

# Characters before the @ of an email address, and what follows it.
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# The other patterns, written so that they begin at the beginning of a run only.
_DOTTED = re.compile(r"[0-9](?<![0-9].)[0-9]*+(?:\.[0-9]++){3,}+")
_FIGURES = re.compile(r"[0-9](?<![0-9].)(?<![0-9][ -].)(?:[ -]?[0-9]){11,}+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = done + len(text[done:at].rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        done = domain.end() if domain else at + 1
        at = text.find("@", done)


def addresses(text: str) -> Iterator[tuple[int, int]]:
    for m in _DOTTED.finditer(text):  # four numbers at a time, as matches don't overlap
        start, parts = m.start(), m.group().split(".")
        for i in range(0, len(parts) - 3, 4):
            end = start + sum(map(len, parts[i : i + 4])) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in parts[i : i + 4]):
                yield start, end
            start = end + 1


def luhn(figures: str) -> bool:
    doubled = [int(c) * 2 for c in figures[-2::-2]]
    return (sum(map(int, figures[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _FIGURES.finditer(text):
        figures = m.group().replace(" ", "").replace("-", "")
        if len(figures) <= 19 and luhn(figures):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            yield m.span()


_FINDERS: dict[str, Callable[[str], Iterator[tuple[int, int]]]] = {
    "email": emails, "ip": addresses, "card": cards, "phone": phones,
}


# Transducers.

Edit = tuple[int, int, str]


class Stage:
    """One rewriting of a text: the output, and the way from places of the output to places of the input."""

    def __init__(self, text: str, edits: list[Edit]):
        pieces: list[str] = []
        self._out: list[int] = []  # where each piece of the output begins
        self._came: list[tuple[int, int, bool]] = []  # from where it came, and whether it was rewritten
        done = made = 0
        for start, end, output in [*edits, (len(text), len(text), "")]:
            for piece, came in ((text[done:start], (done, start, False)), (output, (start, end, True))):
                if piece:
                    pieces.append(piece)
                    self._out.append(made)
                    self._came.append(came)
                    made += len(piece)
            done = end
        self.text = "".join(pieces)

    def _source(self, place: int) -> tuple[int, int]:
        """Where the input of the character at ``place`` begins and ends."""
        i = bisect_right(self._out, place) - 1
        start, end, rewritten = self._came[i]
        if rewritten:
            return start, end
        start += place - self._out[i]
        return start, start + 1

    def span(self, start: int, end: int) -> tuple[int, int]:
        return self._source(start)[0], self._source(end - 1)[1]


# Letters of other alphabets that look like Latin ones, in pairs.
_LOOKALIKES = (
    "аa вb сc ԁd еe һh іi јj кk ӏl мm оo рp ԛq ѕs тt ѵv ѡw хx уy АA ВB СC ЕE НH ІI ЈJ КK МM ОO РP ЅS ТT ХX УY ԜW "
    "αa βb ɡg ɩi κk ιi νv οo ρp τt υu χx γy ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX ɑa օo"
)
# Signs that look like a full stop.
_DOTS = "。．｡․‧∙⋅・·•"


@lru_cache(1)
def _glyphs() -> tuple[dict[int, str], re.Pattern, frozenset[str]]:
    """What one character becomes, a pattern of characters to take out, and all those characters."""
    become: dict[int, str] = {}
    dropped = "\ufe0e\ufe0f\u034f"  # variation selectors, grapheme joiner
    for code in itertools.chain(range(0x80, 0x3400), range(0xA000, 0xAC00), range(0xF900, 0x12000), range(0x1D400, 0x1FC00)):
        c = chr(code)
        kind = unicodedata.category(c)
        folded = unicodedata.normalize("NFKC", c)
        if kind == "Nd":
            become[code] = str(unicodedata.decimal(c))
        elif kind == "Pd" or code == 0x2212:
            become[code] = "-"
        elif kind == "Zs":
            become[code] = " "
        elif kind == "Cf":
            dropped += c
        elif len(folded) == 1 and folded.isascii() and folded.isprintable():
            become[code] = folded
    become |= {ord(pair[0]): pair[-1] for pair in _LOOKALIKES.split()}
    become |= dict.fromkeys(map(ord, _DOTS), ".")
    return become, re.compile(f"[{dropped}]+"), frozenset(map(chr, become)) | frozenset(dropped)


def glyph_edits(text: str) -> tuple[str, list[Edit]]:
    """The text with look-alikes replaced, which keeps its length, and the edits that take characters out."""
    if text.isascii():
        return text, []
    become, dropped, concerned = _glyphs()
    if concerned.isdisjoint(text):
        return text, []
    return text.translate(become), [(m.start(), m.end(), "") for m in dropped.finditer(text)]


# Spelled figures.
_SPELLED = {
    word: str(figure)
    for figure, spelled in enumerate(
        (
            "zero null zéro cero oh", "one eins un une uno", "two zwei zwo deux dos", "three drei trois tres",
            "four vier quatre cuatro", "five fünf cinq cinco", "six sechs seis", "seven sieben sept siete",
            "eight acht huit ocho", "nine neun neuf nueve",
        )
    )
    for word in spelled.split()
}
_TIMES = {"double": 2, "triple": 3, "doppel": 2, "doble": 2}
_ANY = "|".join(sorted(_SPELLED, key=len, reverse=True))
_ONE = rf"(?:(?:{'|'.join(_TIMES)})[ -])?(?:{_ANY})"
#: What may stand between spelled figures, and the end of the last one (a figure may follow it at once).
_BETWEEN, _END = r"(?:[ \t\r\n-]{1,3}|, ?)?", r"(?![^\W\d_])"


def _run_pattern() -> re.Pattern:
    """Runs of spelled figures, also after ``plus``; by first letters, which a search finds fastest."""
    starts: dict[str, list[str]] = {}
    times = (rf"{times}[ -](?:{_ANY})" for times in _TIMES)
    for start in (*sorted(_SPELLED, key=len, reverse=True), *times, rf"plus[ -]?(?:{_ONE}|(?=[0-9]))"):
        starts.setdefault(start[0], []).append(start[1:])
    first = "|".join(rf"{letter}(?<![^\W\d_].)(?:{'|'.join(rest)})" for letter, rest in starts.items())
    return re.compile(rf"(?:{first})(?:{_BETWEEN}{_ONE})*+(?:{_END}|(?<=plus)|(?<=plus[ -]))", re.DOTALL)


_RUN = _run_pattern()
_WORD = re.compile(rf"(?:({'|'.join(_TIMES)})[ -])?({_ANY})")
_NEAR_BEFORE = re.compile(r"(?:[0-9][ .-]|[0-9+]|\b(?:dot|punkt|punto|point) |[\])}>] ?)$")
_NEAR_AFTER = re.compile(r"[ .-]?[0-9]| (?:dot|punkt|punto|point)\b| ?[\[({<]")
#: Words of figures and letters that look like figures, and such letters alone beside figures.
_MIXED = re.compile(r"[0-9OolI](?<![A-Za-z0-9].)[0-9OolI]*+(?![A-Za-z0-9])", re.DOTALL)
_ALONE = re.compile(r"[OolI](?:(?<=[0-9][. -].)(?![A-Za-z0-9])|(?<![A-Za-z0-9].)(?=[. -][0-9]))", re.DOTALL)
_FIGURE_LIKE = str.maketrans("OolI", "0011")


def lowered(text: str) -> str:
    """Lower case of the same length."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c if len(c.lower()) != 1 else c.lower() for c in text)


def figure_edits(text: str, low: str) -> list[Edit]:
    edits = []
    for m in _RUN.finditer(low):
        run = m.group()
        plus = run.startswith("plus")
        words = _WORD.findall(run, 4 * plus)
        near = _NEAR_BEFORE.search(low, max(0, m.start() - 8), m.start()) or _NEAR_AFTER.match(low, m.end())
        if plus or len(words) > 1 or near:
            made = "".join(_SPELLED[word] * _TIMES.get(times, 1) for times, word in words)
            edits.append((m.start(), m.end(), "+" * plus + made))
    for pattern in (_MIXED, _ALONE):
        for m in pattern.finditer(text):
            found = m.group()
            plain = found.translate(_FIGURE_LIKE)
            if plain != found and (pattern is _ALONE or any(c.isdigit() for c in found)):
                edits.append((m.start(), m.end(), plain))
    return _apart(edits)


def _apart(edits: list[Edit]) -> list[Edit]:
    """Edits in order, without those that overlap an earlier one."""
    kept: list[Edit] = []
    for edit in sorted(edits):
        if not kept or edit[0] >= kept[-1][1]:
            kept.append(edit)
    return kept


_OPEN, _CLOSE = r"[\[({<][ \t]{0,3}", r"[ \t]{0,3}[\])}>]"
_STRONG = re.compile(
    rf"{_OPEN}(?:(?P<at>at|@|arroba|arobase|klammeraffe|ät)|(?P<dot>dot|\.|punkt|punto|point)|(?P<dash>dash|minus|-)){_CLOSE}"
)
_CODED = re.compile(
    r"(?P<at>&\#0{0,4}64;|&commat;|%40|_at_(?<=[a-z0-9]_at_)(?=[a-z0-9])| -at- | \*at\* )"
    r"|(?P<dot>&\#0{0,4}46;|&period;|%2e|_dot_(?<=[a-z0-9]_dot_)(?=[a-z0-9])| -dot- | \*dot\* )"
)
_CODES = ("&", "%", "_at_", "_dot_", " -at- ", " *at* ", " -dot- ", " *dot* ")
_LABEL = r"[a-z0-9][a-z0-9-]{0,62}"
_DOT_WORD = r"(?:dot|punkt|punto|point)"
_NEXT_DOT = rf"(?:[ \t]{{1,3}}{_DOT_WORD}[ \t]{{1,3}}[a-z0-9]|[ \t]{{0,3}}{_OPEN}(?:dot|\.|punkt|punto|point){_CLOSE})"
_BARE = re.compile(rf" (?:(?P<at>at|arroba|arobase|klammeraffe)|(?P<sign>@)|(?P<dot>{_DOT_WORD})|(?P<blank>\.)) ")
_GOES_ON = {
    "at": re.compile(rf"{_LABEL}{_NEXT_DOT}"),
    "sign": re.compile(rf"{_LABEL}(?:{_NEXT_DOT}|\.[a-z0-9]| \. [a-z])"),
    "dot": re.compile(r"[a-z0-9]"),
    "blank": re.compile(r"[a-z0-9]"),
}
#: A bare "at" before a plain domain: only after a name that is no word of the language (with a figure, dot or line).
_HANDLE = re.compile(rf" at (?={_LABEL}(?:\.{_LABEL})+)")
_BLANKS = " \t"


def _widened(text: str, start: int, end: int) -> tuple[int, int]:
    """A stretch with up to three blanks on either side."""
    least, most = max(0, start - 3), min(len(text), end + 3)
    while start > least and text[start - 1] in _BLANKS:
        start -= 1
    while end < most and text[end] in _BLANKS:
        end += 1
    return start, end


def sign_edits(text: str, low: str) -> list[Edit]:
    """Edits of ``at`` and ``dot``."""
    strong, weak = [], []
    found = [*_STRONG.finditer(low)]
    if any(code in low for code in _CODES):
        found += _CODED.finditer(low)
    for m in found:
        start, end = _widened(text, *m.span())
        strong.append((start, end, {"at": "@", "dot": ".", "dash": "-"}[m.lastgroup]))
    for m in _BARE.finditer(low):
        start, end = _widened(text, *m.span())
        if start and low[start - 1].isalnum() and _GOES_ON[m.lastgroup].match(low, end):
            # Before a dot between blanks, only lower case goes on: a sentence begins with a capital.
            if m.lastgroup != "blank" or text[end] == low[end]:
                weak.append((start, end, "@" if m.lastgroup in ("at", "sign") else "."))
    for m in _HANDLE.finditer(low):
        name = text[max(0, m.start() - 64) : m.start()]
        name = name[len(name.rstrip(_LOCAL)) :].lstrip("._%+-")
        if re.search(r"[0-9._+-]", name):
            weak.append((m.start(), m.end(), "@"))
    return _apart(strong + weak)


# Spans.

Span = tuple[int, int, str, bool, str]


def _ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def base_spans(text: str) -> list[Span]:
    return _ordered([(a, b, kind, True, text[a:b]) for kind, find in _FINDERS.items() for a, b in find(text)])


def disguised_spans(text: str, base: list[Span]) -> list[Span]:
    """Spans that only the rewritten text shows, at their places in ``text``."""
    glyphs, taken = glyph_edits(text)
    stages = [Stage(glyphs, taken)] if taken else []
    now = stages[-1].text if stages else glyphs
    low = lowered(now)
    if figures := figure_edits(now, low):
        stages.append(Stage(now, figures))
        now = stages[-1].text
        low = lowered(now)
    if signs := sign_edits(now, low):
        stages.append(Stage(now, signs))
        now = stages[-1].text
    if not stages and glyphs == text:
        return []
    ends = {(kind, a): b for a, b, kind, _, _ in base}
    found = []
    for kind, find in _FINDERS.items():
        for a, b in find(now):
            value, start, end = now[a:b], a, b
            for stage in reversed(stages):
                start, end = stage.span(start, end)
            base_end = ends.get((kind, start))
            if text[start:end] == value or base_end and (end <= base_end or _only_words(text[base_end:end])):
                continue
            found.append((start, end, kind, False, value))
    return found


def _only_words(rest: str) -> bool:
    """Whether what a span has beyond a base span may be plain language: bare words, with one spelled figure at most."""
    return rest.isascii() and not _STRONG.search(rest.lower()) and len(re.findall(rf"\b(?:{_ANY})\b", rest.lower())) < 2


def private_spans(text: str) -> list[Span]:
    """``start, end, kind, base, value`` of all spans by start; ``value`` is the identifier in its plain form."""
    base = base_spans(text)
    return _ordered(base + disguised_spans(text, base))


def find_private(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, spans``: structs ``kind, start, end, base, value`` (code points, end exclusive) by start."""
    kind = df.schema[id_col].dataType.simpleString()
    fields = [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("value", pa.string())]

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "t"):
            rows = [
                [{"kind": k, "start": a, "end": b, "base": base, "value": value} for a, b, k, base, value in private_spans(text)]
                for text in texts
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.struct(fields)))], ["i", "spans"])

    return (
        df.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
        .mapInArrow(scanned, f"i {kind}, spans array<struct<{_SPAN}>>")
        .withColumnRenamed("i", id_col)
    )


def redact(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows with every span of personal data replaced by its kind in brackets; overlapping spans by the first kind."""
    schema, place = df.schema, df.columns.index(text_col)

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, text_col):
            new = []
            for text, was in zip(texts, batch.column(place), strict=True):
                pieces, done = [], 0
                for a, b, kind, _, _ in private_spans(text):
                    if a >= done:
                        pieces += text[done:a], f"[{kind.upper()}]"
                    done = max(done, b)
                new.append("".join([*pieces, text[done:]]) if was.is_valid else None)
            yield batch.set_column(place, batch.schema.field(place), pa.array(new, batch.schema.field(place).type))

    return df.mapInArrow(cleaned, schema)


def op11_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_private(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    def listed(spans: Column) -> Column:
        text = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(text, ",")

    return found.select(
        "doc_id",
        *map(number, KINDS),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size(base)).cast("long").alias("n_disguised"),
    )
