"""Depth-first search in JSON payloads of unknown shape.

These are the only Python helpers of the package. Each factory returns an Arrow UDF whose code is
self-contained, so executors need nothing but Python, pandas and Arrow.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _opener():
    def opened(value):
        """Lists and objects written as text are decoded; everything else stays."""
        if isinstance(value, str) and value.strip()[:1] in ("{", "["):
            try:
                return json.loads(value)
            except ValueError:
                return value
        return value

    return opened


def message_list_finder(payload_keys: list[str]):
    """UDF: JSON text -> JSON text of the first message list inside it, or null."""
    opened = _opener()

    def search(value):
        value = opened(value)
        if isinstance(value, dict):
            named = next((value[k] for k in payload_keys if isinstance(value.get(k), list)), None)
            if named is not None:
                return named
            children, otherwise = value.values(), None
        elif isinstance(value, list):
            if any(isinstance(item, dict) for item in value):
                return value
            children, otherwise = value, value
        else:
            return None
        return next(filter(None, map(search, children)), otherwise)

    def encoded(text):
        messages = search(text)
        return None if messages is None else json.dumps(messages, ensure_ascii=False)

    def batch(texts: pd.Series) -> pd.Series:
        return texts.map(encoded, na_action="ignore")

    return F.pandas_udf(batch, T.StringType())


def message_path_finder(message_keys: list[str]):
    """UDF: JSON text -> dotted path of the first message list inside it, or null."""
    opened = _opener()

    def locate(value, path=()):
        value = opened(value)
        if isinstance(value, list):
            if value and isinstance(value[0], dict) and not value[0].keys().isdisjoint(message_keys):
                return path
            children = enumerate(value)
        elif isinstance(value, dict):
            children = value.items()
        else:
            return None
        hits = (locate(child, (*path, str(name))) for name, child in children)
        return next((hit for hit in hits if hit is not None), None)

    def dotted(text):
        path = locate(text)
        return ".".join(path) if path else None

    def batch(texts: pd.Series) -> pd.Series:
        return texts.map(dotted, na_action="ignore")

    return F.pandas_udf(batch, T.StringType())
