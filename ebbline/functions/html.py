"""Links and activity tables in raw pages, by regular expression, in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ebbline.functions.text import decimal, strip, without_commas

# Header words that mark the activity table, and where its cells are.
TABLE_HEADERS = ("Month", "Avg. Players", "Peak Players")
MIN_CELLS = 5
LABEL_CELL, AVG_CELL, PEAK_CELL = 0, 1, 4

# Entities that occur in the supported pages, ampersand last.
ENTITIES = (
    ("&nbsp;", "\xa0"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'),
    ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&"),
)


def anchor_ids(html: Column, prefix: str = "/app/", ident: str = r"\d+") -> Column:
    """Ids of anchors whose whole href is the prefix followed by an id."""
    return F.regexp_extract_all(
        html, F.lit(rf"""(?i:<a\b[^>]*?\shref)\s*=\s*["']?{prefix}({ident})["'\s>]"""), 1
    )


def path_ids(html: Column, prefix: str = "/app/", ident: str = r"\d+") -> Column:
    """Ids of every ``<prefix><id>/`` in the page, inside anchors or not."""
    return F.regexp_extract_all(html, F.lit(f"{prefix}({ident})/"), 1)


def attribute_ids(html: Column, attribute: str = "data-ds-appid", ident: str = r"\d+") -> Column:
    return F.regexp_extract_all(html, F.lit(f'{attribute}="({ident})"'), 1)


def page_ids(html: Column) -> Column:
    """Union of the ids in paths and in item attributes; the set of one page."""
    return F.array_union(path_ids(html), attribute_ids(html))


def element_text(inner: Column) -> Column:
    """Text of an element: its pieces between tags, stripped and joined by a blank."""

    def decoded(x: Column) -> Column:
        plain = x
        for entity, char in ENTITIES:
            plain = F.replace(plain, F.lit(entity), F.lit(char))
        return F.when(x.contains("&"), plain).otherwise(x)

    pieces = F.transform(F.split(inner, "<[^>]*>"), lambda x: strip(decoded(x)))
    return F.array_join(F.filter(pieces, lambda x: x != ""), " ")


def activity_rows(html: Column) -> Column:
    """Rows of the first activity table: ``array<struct<label, avg_players, peak_players>>``.

    Empty when the page has no such table. The trailing-window row is kept. Spark
    shares no subexpressions inside higher-order functions, so each text that is
    read more than once is an element of its own intermediate array.
    """
    tables = F.regexp_extract_all(html, F.lit(r"(?is)<table\b[^>]*>(.*?)</table>"), 1)

    def with_header(table: Column) -> Column:
        heads = F.regexp_extract_all(table, F.lit(r"(?is)<th\b[^>]*>(.*?)</th>"), 1)
        return F.struct(table.alias("body"), F.array_join(F.transform(heads, element_text), " ").alias("header"))

    def is_activity(table: Column) -> Column:
        found = F.lit(True)
        for word in TABLE_HEADERS:
            found = found & table["header"].contains(word)
        return found

    table = F.get(F.filter(F.transform(tables, with_header), is_activity), 0)["body"]
    lines = F.regexp_extract_all(table, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), 1)
    cells = F.transform(lines, lambda x: F.regexp_extract_all(x, F.lit(r"(?is)<td\b[^>]*>(.*?)</td>"), 1))
    full = F.filter(cells, lambda x: F.size(x) >= MIN_CELLS)
    texts = F.transform(
        full,
        lambda x: F.struct(
            element_text(F.get(x, LABEL_CELL)).alias("label"),
            without_commas(element_text(F.get(x, AVG_CELL))).alias("avg"),
            without_commas(element_text(F.get(x, PEAK_CELL))).alias("peak"),
        ),
    )
    rows = F.transform(
        texts,
        lambda x: F.struct(x["label"].alias("label"), decimal(x["avg"]).alias("avg_players"), decimal(x["peak"]).alias("peak_players")),
    )
    return F.coalesce(rows, F.array().cast("array<struct<label:string,avg_players:double,peak_players:double>>"))
