"""Text and JSON column expressions. Everything here stays in built-in Spark functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the characters that count as outer whitespace.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)

# The same as an SQL string literal.
WHITESPACE_SQL = "'" + "".join(f"\\u{ord(c):04x}" for c in WHITESPACE) + "'"

# JSON text must be strict about quotes; NaN and repeated keys (last one wins) are accepted.
JSON_OPTIONS = {"allowSingleQuotes": "false"}
_TO_JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
}


def strip(c: Column) -> Column:
    """Remove outer Unicode whitespace; null stays null."""
    return F.trim(c, F.lit(WHITESPACE))


def python_float_text(c: Column) -> Column:
    """Shortest decimal text of a double, as ``1.0``, ``1e+16``, ``0.0001``, ``nan``, ``inf``.

    Spark's own text may carry a digit too many; fewer digits are taken when they give the same
    double back.
    """
    value = c.cast("double")
    s = value.cast("string")
    digits_15, digits_16 = F.format_string("%.14e", value), F.format_string("%.15e", value)
    exact = (
        F.when(s.contains("E") & (F.length(s) <= 16), s)
        .when(digits_15.try_cast("double") == value, digits_15)
        .when(digits_16.try_cast("double") == value, digits_16)
        .otherwise(F.format_string("%.16e", value))
    )
    pattern = r"^-?(\d)\.(\d+)[eE]([+-]?\d+)$"
    parts = bind(
        exact,
        lambda e: F.struct(
            F.regexp_extract(e, pattern, 1).alias("lead"),
            F.rtrim(F.regexp_extract(e, pattern, 2), F.lit("0")).alias("frac"),
            F.regexp_extract(e, pattern, 3).try_cast("int").alias("exp"),
        ),
    )
    sign = F.when(s.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    return (
        F.when(s == "NaN", F.lit("nan"))
        .when(s == "Infinity", F.lit("inf"))
        .when(s == "-Infinity", F.lit("-inf"))
        .when(~s.contains("E") & (F.length(s) < 16), s)
        .otherwise(F.concat(sign, bind(parts, _decimal_notation)))
    )


def bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _decimal_notation(parts: Column) -> Column:
    lead, frac, exp = parts["lead"], parts["frac"], parts["exp"]
    digits = F.concat(lead, frac)
    whole = F.when(
        F.length(frac) <= exp, F.concat(F.rpad(digits, exp + 1, F.lit("0")), F.lit(".0"))
    ).otherwise(
        F.concat(digits.substr(F.lit(1), exp + 1), F.lit("."), digits.substr(exp + 2, F.length(digits)))
    )
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exp - 1), digits)
    scientific = F.concat(
        lead,
        F.when(frac != "", F.concat(F.lit("."), frac)).otherwise(F.lit("")),
        F.when(exp < 0, F.lit("e-")).otherwise(F.lit("e+")),
        F.lpad(F.abs(exp).cast("string"), 2, "0"),
    )
    return (
        F.when((exp >= 0) & (exp < 16), whole)
        .when((exp >= -4) & (exp < 0), small)
        .otherwise(scientific)
    )


def spaced_json(c: Column) -> Column:
    """Compact JSON text -> the same with one blank after each separator outside strings."""
    between = r'\G((?:[^",:]++|"[^"\\]*+(?:\\.[^"\\]*+)*+")*+)([,:])'
    return F.regexp_replace(c, between, "$1$2 ")


def nested_json(c: Column) -> Column:
    """JSON text of an array, struct, map or variant, nulls written out."""
    return spaced_json(F.to_json(c, _TO_JSON_OPTIONS))


def json_string(c: Column) -> Column:
    """JSON string literal, non-ASCII characters kept, control characters in lower-case hex."""
    # The quotes of the literal stop the trimming of the list brackets around it.
    literal = F.rtrim(F.ltrim(F.to_json(F.array(c)), F.lit("[")), F.lit("]"))
    lowered = F.aggregate(
        F.expr("array('A', 'B', 'C', 'D', 'E', 'F')"),
        literal,
        lambda text, digit: F.regexp_replace(
            text,
            F.concat(F.lit(r"(?<!\\)((?:\\\\)*+\\u00[01])"), digit),
            F.concat(F.lit("$1"), F.lower(digit)),
        ),
    )
    return F.when(c.rlike("[\x0b\x0e\x0f\x1a-\x1f]"), lowered).otherwise(literal)


def literal_map(pairs: dict[str, str]) -> Column:
    """A constant ``map<string,string>``."""
    quoted = [v.replace("\\", "\\\\").replace("'", "\\'") for kv in pairs.items() for v in kv]
    return F.expr("map(" + ", ".join(f"'{v}'" for v in quoted) + ")")


def is_nested(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.ArrayType, T.StructType, T.MapType, T.VariantType))


def to_text(c: Column, dtype: T.DataType | None = None) -> Column:
    """Any value as stripped text, null as the empty string."""
    if dtype is None or isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        text = strip(c)
    elif isinstance(dtype, T.BooleanType):
        text = F.initcap(c.cast("string"))
    elif isinstance(dtype, (T.FloatType, T.DoubleType)):
        text = python_float_text(c)
    elif is_nested(dtype):
        text = nested_json(c)
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        zone = "xxx" if isinstance(dtype, T.TimestampType) else ""
        text = F.regexp_replace(
            F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS" + zone), r"\.000000(?=$|[+-])", ""
        )
    else:
        text = strip(c.cast("string"))
    return F.coalesce(text, F.lit(""))


def json_fields(c: Column) -> Column:
    """Top-level members of a JSON object text as ``map<string,string>``, else null.

    Nested values keep their JSON text.
    """
    return _only_value(c, "map<string,string>")


def json_variants(c: Column) -> Column:
    """As :func:`json_fields`, with typed values (``map<string,variant>``)."""
    return _only_value(c, "map<string,variant>")


def json_items(c: Column) -> Column:
    """Elements of a JSON list text as text, else null. Nested elements keep their JSON text."""
    return _only_value(c, "array<string>")


def json_value(c: Column) -> Column:
    """Any JSON text as a variant, else null."""
    return _only_value(c, "variant")


def _only_value(c: Column, dtype: str) -> Column:
    """Parse a text that is one JSON value and nothing else. Spark's parsers ignore what follows
    a complete value; wrapped like this, such a text is malformed or gives a second element."""
    wrapped = F.concat(F.lit('{"v":['), c, F.lit("]}"))
    values = F.from_json(wrapped, f"struct<v:array<{dtype}>>", JSON_OPTIONS)["v"]
    single = F.filter(F.array(values), lambda v: F.size(v) == 1)
    return F.get(F.get(single, F.lit(0)), F.lit(0))


def starts_like_json(c: Column) -> Column:
    s = F.ltrim(c, F.lit(WHITESPACE))
    return s.startswith("{") | s.startswith("[")


def is_json_collection(c: Column) -> Column:
    """True when the text is a JSON object or list."""
    s = strip(c)
    return F.coalesce(
        F.when(s.startswith("{"), json_fields(s).isNotNull())
        .when(s.startswith("["), json_items(s).isNotNull()),
        F.lit(False),
    )


def parse_json_text(c: Column) -> Column:
    """Variant of a text that is a JSON object or list; null for every other text."""
    return F.when(starts_like_json(c), F.try_parse_json(strip(c)))


def variant_kind(v: Column) -> Column:
    """``STRING``, ``BOOLEAN``, ``OBJECT``, ``ARRAY``, ``VOID`` ... of a variant value."""
    return F.regexp_extract(F.schema_of_variant(v), "^([A-Z]+)", 1)


def raw_json_text(raw: Column, kind: Column) -> Column:
    """Stripped text of one raw JSON member.

    ``raw`` is the text from :func:`json_fields`; ``kind`` tells a string from a list, object or
    boolean with the same spelling and is only evaluated where the spelling is ambiguous.
    """
    nested = raw.startswith("{") | raw.startswith("[")
    return F.coalesce(
        F.when(raw.isin("true", "false"), F.when(kind == "BOOLEAN", F.initcap(raw)).otherwise(raw))
        .when(nested, F.when(kind.isin("OBJECT", "ARRAY"), spaced_json(raw)).otherwise(strip(raw)))
        .otherwise(strip(raw)),
        F.lit(""),
    )


def domain_slug(c: Column) -> Column:
    """Lower-case name with blanks as underscores."""
    return F.replace(F.lower(strip(c)), F.lit(" "), F.lit("_"))


def utc_text(c: Column) -> Column:
    """ISO-8601 text of a timestamp (session time zone UTC)."""
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
