"""Text normalisation for titles, summaries and review bodies."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed value: the code points Python treats as white space. Java's ``\s`` covers only the ASCII ones. Those below U+0100 stand one by
#: one, which Java looks up in a table; the others are compared only where a character lies between the first and the last of them.
WHITESPACE = (
    r"[\u0009\u000a\u000b\u000c\u000d\u001c\u001d\u001e\u001f\u0020\u0085\u00a0"
    r"[\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]]"
)


def blank_to_null(c: Column) -> Column:
    """Trim spaces; an empty result becomes null."""
    return F.nullif(F.trim(c), F.lit(""))


def text_length(c: Column) -> Column:
    """Length in code points; a missing text counts as 0."""
    return F.length(F.coalesce(c, F.lit("")))


def text_digest(c: Column) -> Column:
    """SHA-256 of the text as hex, the fingerprint used to detect changed content."""
    return F.sha2(c, 256)


@F.pandas_udf(T.StringType())
def _unescape(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


# Nondeterministic keeps the optimizer from copying the Python call into a filter below the projection.
_unescape_once = _unescape.asNondeterministic()


def decode_entities(c: Column) -> Column:
    """HTML5 entity decoding.

    Only texts holding an ampersand cross over to Python; every other row sends a null and keeps its
    text on the JVM side.
    """
    return F.coalesce(_unescape_once(F.when(F.contains(c, F.lit("&")), c)), c)


def squeeze(c: Column) -> Column:
    """Each run of Unicode white space becomes one space, ends are cut, empty becomes null."""
    return blank_to_null(F.regexp_replace(c, WHITESPACE + "+", " "))


def clean_text(c: Column) -> Column:
    """Decode entities first (``&nbsp;`` must take part in the squeeze), then squeeze white space."""
    return squeeze(decode_entities(c))


def embedding_text(summary: Column, body: Column) -> Column:
    """``summary. body`` of the cleaned parts; a missing part drops out, both missing gives null."""
    return F.nullif(F.concat_ws(". ", clean_text(summary), clean_text(body)), F.lit(""))
