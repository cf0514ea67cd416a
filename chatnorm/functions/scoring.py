"""Content scores that tell prompts, answers, code and vectors apart.

Scores are written as SQL text over the SQL text of a column (``"body"``, ``"lower(body)"``): one
expression string per score instead of a hundred small calls into the JVM. Give them a plain
column, so that the text is not computed again for every marker.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WHITESPACE_SQL

# Marker words per kind of text.
CODE_MARKERS = [
    "def ", "class ", "import ", "return ", "public ", "private ", "function ",
    "=>", "{", "}", ";", "```",
]
PROMPT_MARKERS = [
    "?", "write", "implement", "create", "solve", "problem", "task", "question",
    "given", "input", "output", "explain",
]
MATH_MARKERS = [
    "solve", "equation", "proof", "derivative", "integral", "algebra", "geometry",
    "calculate", "simplify", "math",
]
LANGUAGE_MARKERS = [
    "summarize", "translate", "rewrite", "classify", "answer", "question",
    "respond", "write", "explain",
]
# Digits outside the decimal-number category (superscripts, circled digits ...).
_OTHER_DIGITS = (
    r"\x{b2}\x{b3}\x{b9}\x{1369}-\x{1371}\x{19da}\x{2070}\x{2074}-\x{2079}\x{2080}-\x{2089}"
    r"\x{2460}-\x{2468}\x{2474}-\x{247c}\x{2488}-\x{2490}\x{24ea}\x{24f5}-\x{24fd}\x{24ff}"
    r"\x{2776}-\x{277e}\x{2780}-\x{2788}\x{278a}-\x{2792}\x{10a40}-\x{10a43}\x{10e60}-\x{10e68}"
    r"\x{11052}-\x{1105a}\x{1f100}-\x{1f10a}"
)
MIN_SCORE = 0.8
MAX_CONTEXT_LENGTH = 1200


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n") + "'"


def occurrences(x: str, char: str) -> str:
    return f"(length({x}) - length(replace({x}, {_literal(char)}, '')))"


def _without(x: str, chars: str) -> str:
    return f"(length({x}) - length(translate({x}, {_literal(chars)}, '')))"


def digit_ratio_sql(x: str) -> str:
    """Share of digits. Digits beyond ASCII are rare: a cheap test finds the texts that have any."""
    other = _literal(
        r"[\x{b2}\x{b3}\x{b9}\x{660}-\x{10ffff}&&[\p{Nd}" + _OTHER_DIGITS + "]]"
    )
    more = (
        f"if(length({x}) < octet_length({x}) AND {x} RLIKE {other}, regexp_count({x}, {other}), 0)"
    )
    return f"(({_without(x, '0123456789')} + {more}) / greatest(1, length({x})))"


def _markers(x: str, markers: list[str]) -> str:
    return " + ".join(f"CAST(contains({x}, {_literal(m)}) AS INT)" for m in markers)


def code_score_sql(x: str) -> str:
    braces = f"{occurrences(x, '{')} + {occurrences(x, '}')}"
    return (
        f"coalesce(CAST({_markers(x, CODE_MARKERS)} AS DOUBLE)"
        f" + {occurrences(x, chr(10))} * 0.05D + ({braces}) * 0.1D, 0D)"
    )


def _wordy(code: str, lower: str, markers: list[str], more_blanks_than: int) -> str:
    return (
        f"coalesce(CAST({_markers(lower, markers)} AS DOUBLE)"
        f" + if({occurrences(lower, ' ')} > {more_blanks_than}, 1D, 0D)"
        f" - if({code} > 3, 0.5D, 0D), 0D)"
    )


def prompt_score_sql(x: str, lower: str | None = None, code: str | None = None) -> str:
    """``code`` names a column that holds the code score, where it is known."""
    return _wordy(code or code_score_sql(x), lower or f"lower({x})", PROMPT_MARKERS, 5)


def natural_language_score_sql(x: str, lower: str | None = None, code: str | None = None) -> str:
    return _wordy(code or code_score_sql(x), lower or f"lower({x})", LANGUAGE_MARKERS, 7)


def math_score_sql(x: str, lower: str | None = None) -> str:
    return (
        f"coalesce(CAST({_markers(lower or f'lower({x})', MATH_MARKERS)} AS DOUBLE)"
        f" + {_without(x, '=+-*/^')} * 0.03D, 0D)"
    )


def task_prompt_score_sql(x: str, task_type: str, lower: str | None = None) -> str:
    """``task_type`` is SQL text too: a column, or a literal that leaves one branch."""
    return (
        f"CASE {task_type} WHEN 'code_generation' THEN {prompt_score_sql(x, lower)}"
        f" WHEN 'math' THEN {math_score_sql(x, lower)}"
        f" ELSE {natural_language_score_sql(x, lower)} END"
    )


def task_answer_score_sql(x: str, task_type: str, lower: str | None = None) -> str:
    return (
        f"CASE {task_type} WHEN 'code_generation' THEN {code_score_sql(x)}"
        f" WHEN 'math' THEN {math_score_sql(x, lower)}"
        f" ELSE {natural_language_score_sql(x, lower)} END"
    )


def vectorish_sql(x: str, stripped: bool = False) -> str:
    """Text that looks like numbers or a serialised collection rather than prose."""
    s = x if stripped else f"trim(BOTH {WHITESPACE_SQL} FROM {x})"
    return (
        f"CASE WHEN coalesce({s}, '') = '' THEN false"
        f" WHEN (startswith({s}, '[') AND endswith({s}, ']'))"
        f" OR (startswith({s}, '{{') AND endswith({s}, '}}')) THEN true"
        f" WHEN length({s}) > 300 AND {occurrences(s, ',')} > 30 THEN true"
        f" ELSE {digit_ratio_sql(s)} > 0.35 AND {occurrences(s, ' ')} < 10 END"
    )


def code_score(x: str) -> Column:
    return F.expr(code_score_sql(x))


def prompt_score(x: str) -> Column:
    return F.expr(prompt_score_sql(x))


def natural_language_score(x: str) -> Column:
    return F.expr(natural_language_score_sql(x))


def math_score(x: str) -> Column:
    return F.expr(math_score_sql(x))


def digit_ratio(x: str) -> Column:
    return F.expr(digit_ratio_sql(x))


def is_vectorish(x: str) -> Column:
    return F.expr(vectorish_sql(x))


def bracketed(s: Column) -> Column:
    return (s.startswith("[") & s.endswith("]")) | (s.startswith("{") & s.endswith("}"))
