"""Dataset links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip


def normalize_link(c: Column) -> Column:
    """Dataset URL -> ``owner/name``; anything else loses its outer slashes; null -> ''."""
    value = F.coalesce(strip(c), F.lit(""))
    path = F.regexp_extract(value, r"(?s)^https?://[^/?#]*([^?#]*)", 1)
    path = F.trim(F.regexp_replace(path, r"(?s);[^/]*$", ""), F.lit("/"))
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    from_url = (
        F.when((F.size(parts) >= 3) & (F.get(parts, F.lit(0)) == "datasets"), _two(parts, 2))
        .when(F.size(parts) >= 2, _two(parts, 1))
        .otherwise(path)
    )
    is_url = value.startswith("http://") | value.startswith("https://")
    return F.when(is_url, from_url).otherwise(F.trim(value, F.lit("/")))


def _two(parts: Column, start: int) -> Column:
    return F.array_join(F.slice(parts, start, 2), "/")
