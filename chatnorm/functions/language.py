"""Language labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import literal_map, strip

# Spelling -> label.
LANGUAGE_LABELS = {
    "en": "english",
    "eng": "english",
    "english": "english",
    "en-us": "english",
    "en-gb": "english",
    "hindi": "hindi",
    "hi": "hindi",
    "hin": "hindi",
    "spanish": "spanish",
    "es": "spanish",
    "spa": "spanish",
    "french": "french",
    "fr": "french",
    "fra": "french",
    "de": "german",
    "deu": "german",
    "german": "german",
    "zh": "chinese",
    "zho": "chinese",
    "chinese": "chinese",
    "ja": "japanese",
    "jpn": "japanese",
    "japanese": "japanese",
    "ko": "korean",
    "kor": "korean",
    "korean": "korean",
    "multilingual": "multilingual",
    "multiple": "multilingual",
    "mixed": "multilingual",
    "unknown": "unknown",
}
LANGUAGE_COLUMNS = ("language", "lang", "locale")


def _label(c: Column) -> Column:
    return literal_map(LANGUAGE_LABELS)[c]


def normalize_language(text: Column) -> Column:
    """Text (already rendered by ``to_text``, or null) -> lower-case language label."""
    tag = F.replace(F.lower(F.coalesce(strip(text), F.lit(""))), F.lit("_"), F.lit("-"))
    primary = F.when(tag.contains("-"), F.substring_index(tag, "-", 1))
    letters = F.nullif(F.trim(F.regexp_replace(tag, r"[^\p{L}]", "_"), F.lit("_")), F.lit(""))
    return F.coalesce(_label(tag), _label(primary), _label(letters), letters, F.lit("unknown"))
