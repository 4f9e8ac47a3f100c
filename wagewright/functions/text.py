"""Text columns: cleaning, normalising, scrubbing."""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Callable
from html.entities import html5

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Addresses and phone numbers that are never stored.
EMAIL = r"(?U)[\w.+-]+@[\w-]+\.[\w.-]+"
PHONE = r"(?U)(?:\+|00)\d{2}[\s./-]?\d{2,4}[\s./-]?\d{3,4}[\s./-]?\d{2,4}|\b3\d{2}[\s.-]?\d{3}[\s.-]?\d{3,4}\b"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), where the value is worked out once however often it is used: in branches Spark would do so each time."""
    return F.element_at(F.transform(F.array(value), use), 1)


def strip_accents(text: Column) -> Column:
    """Letters without their marks; compatibility forms become plain (a null is empty)."""
    text = F.coalesce(text, F.lit(""))
    # ASCII, by far the most, is left as it is; the rest goes through Arrow.
    return F.when(~text.rlike(r"[^\x00-\x7F]"), text).otherwise(_decompose(text))


@F.pandas_udf(T.StringType())
def _decompose(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)))


@F.pandas_udf(T.StringType())
def _unescape(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape)


_CLOSED = re.compile(r"&(?:#\w+|\w+);")


@F.pandas_udf(T.StringType())
def _unescape_closed(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: _CLOSED.sub(lambda m: html.unescape(m[0]) if m[0][1] == "#" or m[0][1:] in html5 else m[0], t))


def clean_html(text: Column, closed: bool = False) -> Column:
    """Entities first, then tags to blanks, then white space squeezed; a null is empty.

    closed: only entities with their semicolon count, so that one which was cut off stays as it is; else those that HTML
    knows without it count too.
    """
    text = F.coalesce(text, F.lit(""))
    plain = F.when(text.contains("&"), (_unescape_closed if closed else _unescape)(text)).otherwise(text)
    return F.trim(F.regexp_replace(F.regexp_replace(plain, "<[^>]+>", " "), r"(?U)\s+", " "))


def normalize_text(text: Column) -> Column:
    """Lower case, no accents, apostrophes closed up, all else but letters and digits one blank."""
    joined = F.regexp_replace(F.lower(strip_accents(text)), "['’`]", "")
    return F.trim(F.regexp_replace(joined, "[^a-z0-9]+", " "))


def scrub_personal_data(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), EMAIL, "[email]"), PHONE, "[phone]")


def content_hash(title: Column, description: Column) -> Column:
    return F.sha1(F.concat_ws("\n", F.coalesce(title, F.lit("")), F.coalesce(description, F.lit(""))).cast("binary"))


def keyword_context(text: Column, keyword: str, before: int = 60, after: int = 220) -> Column:
    """What stands around the first match of a pattern, white space squeezed; empty without a match."""
    at = F.regexp_instr(text, F.lit(keyword))
    start = F.greatest(at - before, F.lit(1))
    return F.when(at > 0, F.trim(F.regexp_replace(F.substring(text, start, at - start + after), r"(?U)\s+", " "))).otherwise("")


def join_notes(notes: Column, each: int = 140, total: int = 600) -> Column:
    """Different notes in order, cut to length; NULL if there are none."""
    return F.nullif(F.left(F.array_join(F.transform(F.array_distinct(notes), lambda n: F.left(n, F.lit(each))), " | "), F.lit(total)), F.lit(""))
