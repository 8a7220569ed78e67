"""Column functions for HTML inside text."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.functions.text import as_column, strip, text

TABLE, TABLE_ROW, TABLE_CELL, TAG = r"(?is)<table.*?</table>", r"(?is)<tr.*?</tr>", r"(?is)<t[dh][^>]*>(.*?)</t[dh]>", r"<[^>]+>"
#: Entities that the pure SQL form decodes, the ampersand last (fixed values).
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ", "&amp;": "&"}


@F.pandas_udf(T.StringType())
def unescape(s: pd.Series) -> pd.Series:
    """Every HTML entity decoded."""
    return s.map(lambda x: html.unescape(x) if x is not None else None)


def unescape_common(c: Column | str) -> Column:
    """The usual entities decoded inside the JVM."""
    c = as_column(c)
    for entity, char in ENTITIES.items():
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def html_cell(c: Column | str, decode=unescape) -> Column:
    """Tags become blanks; one line."""
    return strip(F.regexp_replace(decode(F.regexp_replace(text(c), TAG, " ")), r"(?U)\s+", " "))


def html_plain(c: Column | str, decode=unescape) -> Column:
    """Tags vanish, lines stay, at most one empty line in a row."""
    return strip(F.regexp_replace(decode(F.regexp_replace(text(c), TAG, "")), r"\n{3,}", "\n\n"))


def feed_plain(c: Column | str) -> Column:
    """Short tags that a feed carries inside its text vanish."""
    return strip(F.regexp_replace(text(c), "<[^>]{1,40}>", ""))


def html_table_rows(c: Column | str) -> Column:
    """Each row with any text as its cells joined by ' | '.

    All cells of a table are decoded inside the JVM; use unescape on the result for rare entities.
    """

    def row(tr: Column) -> Column:
        return F.transform(F.regexp_extract_all(tr, F.lit(TABLE_CELL), F.lit(1)), lambda cell: html_cell(cell, unescape_common))

    rows = F.transform(F.regexp_extract_all(text(c), F.lit(TABLE_ROW), F.lit(0)), row)
    return F.transform(F.filter(rows, lambda cells: F.exists(cells, lambda x: x != "")), lambda cells: F.array_join(cells, " | "))


def clean_converted(c: Column | str) -> Column:
    """Column-width groups go, and so does a one-cell table that wraps the whole document."""
    s = F.regexp_replace(text(c), r"(?sU)<colgroup>.*?</colgroup>\s*", "")
    inner = F.regexp_extract(s, r"(?sU)^<table>\s*<tbody>\s*<tr[^>]*>\s*<td>(.*)</td>\s*</tr>\s*</tbody>\s*</table>\s*$", 1)
    return strip(F.regexp_replace(F.when(inner != "", inner).otherwise(s), r"\n{3,}", "\n\n"))
