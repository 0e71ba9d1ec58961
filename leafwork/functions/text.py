"""Python's text semantics as Catalyst expressions.

Java's \\s, trim() and line handling differ from Python's; these columns agree with str.strip, str.splitlines and
the re module on Unicode white space.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable
from html.entities import html5
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

# Python's white space and line breaks, as Java regular expressions.
WS_CHARS = r"\t-\r\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
WS = f"[{WS_CHARS}]"
WS_LIST = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
LINE_BREAK = r"\r\n|[\n\r\x0B\x0C\x1C\x1D\x1E\x85\u2028\u2029]"
HEADING = rf"(?s)^(#{{1,6}}){WS}+(.+)\z"
PAGE_MARK = rf"^==={WS}*Page{WS}+(\p{{Nd}}+){WS}*===\z"
NOISE = rf"^[\p{{Nd}}{WS_CHARS}.\-,:;()\[\]{{}}/\\]+\z"
MD_ESCAPED = r"\\([_*`\[\]()#+\-.!|])"
# White space, headings, what trim takes off and the entities that are resolved in the queries' SQL (DuckDB, RE2).
SQL_WS = r"[\t\n\f\r ]"
SQL_HEADING = rf"^(#{{1,6}}){SQL_WS}+([^\n]+)\z"
SQL_TRIM = " \xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u202f\u205f\u3000"
SQL_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&copy;", "©"), ("&amp;", "&"))
# For Python: what ends like an entity, known or not.
CLOSED = re.compile(r"&(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);")


def strip(c: Column) -> Column:
    """str.strip: white space of all kinds off both ends."""
    return F.btrim(c, F.lit(WS_LIST))


def is_blank(c: Column) -> Column:
    """Null, or nothing but white space."""
    return c.isNull() | (strip(c) == "")


def split_lines(c: Column) -> Column:
    """str.splitlines: an array without the empty piece behind a final break."""
    parts = F.split(c, LINE_BREAK, -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def normalize(c: Column) -> Column:
    """Runs of white space become one space; none at the ends."""
    return strip(F.regexp_replace(c, f"{WS}+", " "))


def heading_level(line: Column, heading: str = HEADING) -> Column:
    """Number of # of a heading line; null if the line is none. The line is taken as it is, not stripped."""
    found = F.regexp_extract(line, heading, 1)
    return F.when(found != "", F.char_length(found))


def heading_text(line: Column) -> Column:
    """The stripped text behind the # of a heading line; empty if the line is none."""
    return strip(F.regexp_extract(line, HEADING, 2))


def page_number(line: Column) -> Column:
    """The number of a page mark; null if the line, already stripped, is none or the number is too long."""
    return F.regexp_extract(line, PAGE_MARK, 1).try_cast("int")


def is_noise_heading(text: Column) -> Column:
    """Shorter than four characters, or all digits, white space and punctuation of numbering."""
    return (F.char_length(text) < 4) | text.rlike(NOISE)


@F.pandas_udf(StringType())
def _unescape(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else html.unescape(x))


@F.pandas_udf(StringType())
def _unescape_closed(s: pd.Series) -> pd.Series:
    known = lambda m: html.unescape(m[0]) if m[1][0] == "#" or m[1] + ";" in html5 else m[0]
    return s.map(lambda x: None if x is None else CLOSED.sub(known, x))


def unescape_markdown(c: Column, closed: bool = False) -> Column:
    """HTML entities are resolved first, then backslashes before Markdown's own characters dropped.

    As in html.unescape, some entities need no semicolon (`&amp` is `&`). closed: all need one, as in CommonMark;
    what has none is text. Python is called only for text with an entity that is not among the five commonest.
    """
    simple = c
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x27;", "'"), ("&amp;", "&")):
        simple = F.replace(simple, F.lit(name), F.lit(char))
    rare = c.rlike("&(?!(lt|gt|quot|#x27|amp);)[A-Za-z#]") | c.rlike("&amp;[A-Za-z#]")
    full = _unescape_closed if closed else _unescape
    return F.regexp_replace(F.when(rare, full(F.when(rare, c))).otherwise(simple), MD_ESCAPED, "$1")


def sql_normalize(c: Column) -> Column:
    """normalize with what SQL takes as white space: no vertical tab, and other spaces at the ends only."""
    return F.btrim(F.regexp_replace(c, f"{SQL_WS}+", " "), F.lit(SQL_TRIM))


def sql_unescape(c: Column) -> Column:
    """unescape_markdown with the five named entities of the SQL, each with its semicolon; others are text."""
    for name, char in SQL_ENTITIES:
        c = F.replace(c, F.lit(name), F.lit(char))
    return F.regexp_replace(c, MD_ESCAPED, "$1")


class Rules(NamedTuple):
    """How headings are read from Markdown and compared with lines: pattern of marks and text, entities, normal form."""

    heading: str
    unescape: Callable[[Column], Column]
    normalize: Callable[[Column], Column]


PYTHON = Rules(HEADING, unescape_markdown, normalize)
SQL = Rules(SQL_HEADING, sql_unescape, sql_normalize)


@F.pandas_udf(StringType())
def decode_lossy(s: pd.Series) -> pd.Series:
    """bytes.decode('utf-8', 'ignore'): invalid bytes vanish."""
    return s.map(lambda b: None if b is None else bytes(b).decode("utf-8", "ignore"))


@F.pandas_udf(DoubleType())
def round4(s: pd.Series) -> pd.Series:
    """round(x, 4) as Python does it."""
    return s.map(lambda x: None if pd.isna(x) else round(x, 4)).astype("float64")


def exploded_lines(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """keep, line_no (from 0), line: a row for each line."""
    return df.select(*keep, F.posexplode(split_lines(F.col(text))).alias("line_no", "line"))
