"""Text rules as column expressions: numbers, booleans, lists, tags.

Everything here is a pure ``Column -> Column`` function that stays in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space when text is stripped.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0 "
    "           "
    "    　"
)
# The words of a flag.
TRUE_WORDS = ("TRUE", "1", "YES", "Y")
FALSE_WORDS = ("FALSE", "0", "NO", "N")

_DECIMAL = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def strip(text: Column) -> Column:
    """Trim every white-space character at both ends, not only blanks."""
    return F.trim(text, F.lit(WHITESPACE))


def finite(value: Column) -> Column:
    """NULL for NaN and the infinities; the one form of 'missing' is NULL."""
    return F.when(F.abs(value) < float("inf"), value)


def to_number(text: Column) -> Column:
    """Lenient decimal: thousands commas dropped; blank, ``-`` and junk are NULL."""
    return decimal(without_commas(text))


def without_commas(text: Column) -> Column:
    return F.replace(strip(text), F.lit(","), F.lit(""))


def strict_number(text: Column) -> Column:
    """Decimal without thousands commas; anything else is NULL."""
    return decimal(strip(text))


def decimal(bare: Column) -> Column:
    """Stripped text as a finite double."""
    return finite(F.when(bare.rlike(_DECIMAL), bare.try_cast("double")))


def to_int(text: Column) -> Column:
    """Lenient integer; ``1.5`` and junk are NULL."""
    bare = F.trim(text)
    return F.when(bare.rlike(r"^[+-]?[0-9]+$"), bare.try_cast("int"))


def to_id(text: Column) -> Column:
    """Lenient long id; a decimal one loses its fraction."""
    bare = F.trim(text)
    whole = F.when(bare.rlike(r"^[+-]?[0-9]+$"), bare.try_cast("long"))
    return F.coalesce(whole, strict_number(bare).try_cast("long"))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def bool_label(text: Column) -> Column:
    """``TRUE`` / ``FALSE`` / ``''`` for NULL / the upper-cased input otherwise."""
    word = F.upper(strip(text.cast("string")))
    return (
        F.when(text.isNull(), "")
        .when(word.isin(*TRUE_WORDS), "TRUE")
        .when(word.isin(*FALSE_WORDS), "FALSE")
        .otherwise(word)
    )


def bool_flag(text: Column) -> Column:
    """1 / 0 / NULL from boolean text."""
    word = F.upper(F.trim(text))
    return F.when(word.isin(*TRUE_WORDS), 1).when(word.isin(*FALSE_WORDS), 0)


def clean_text(text: Column) -> Column:
    """One-line text: CR, LF and TAB become blanks, ends stripped, NULL is ``''``."""
    return strip(F.translate(F.coalesce(text, F.lit("")), "\r\n\t", "   "))


def clean_items(items: Column) -> Column:
    """Strip each item of an array and drop the empty ones; NULL array is empty."""
    stripped = F.transform(items, strip)
    return F.coalesce(F.filter(stripped, lambda x: x.isNotNull() & (x != "")), _no_items())


def parse_list(text: Column) -> Column:
    """Items of a list written as text.

    Precedence: single-quoted items, then (without outer brackets) pipe-separated,
    comma-separated, and last a single token.
    """
    whole = strip(text)
    quoted = clean_items(F.regexp_extract_all(whole, F.lit(r"'([^']+)'"), 1))
    bracketed = whole.startswith("[") & whole.endswith("]") & (F.length(whole) >= 2)
    bare = F.when(bracketed, strip(F.substr(whole, F.lit(2), F.length(whole) - 2))).otherwise(whole)
    return (
        F.when(whole.isNull() | (whole == ""), _no_items())
        .when(F.size(quoted) > 0, quoted)
        .when(bare.contains("|"), clean_items(F.split(bare, r"\|")))
        .when(bare.contains(","), clean_items(F.split(bare, ",")))
        .when(bare == "", _no_items())
        .otherwise(F.array(bare))
    )


def pipe_join(items: Column) -> Column:
    return F.array_join(items, "|")


def pipe_items(text: Column) -> Column:
    """Items of a pipe-separated string, blanks trimmed, empties dropped."""
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), r"\|"), lambda x: F.trim(x))
    return F.filter(parts, lambda x: x != "")


def warehouse_norm(tag: Column) -> Column:
    """Tag key of the warehouse: dashes and underscores to blanks, one pass over double blanks."""
    spaced = F.replace(F.replace(F.trim(tag), F.lit("-"), F.lit(" ")), F.lit("_"), F.lit(" "))
    return F.lower(F.replace(spaced, F.lit("  "), F.lit(" ")))


def scoring_norm(tag: Column) -> Column:
    """Tag key of the scorer: blanks squeezed first, punctuation dropped after that."""
    spaced = F.translate(F.lower(tag), "_-", "  ")
    squeezed = F.regexp_replace(spaced, r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]+", " ")
    return F.trim(F.regexp_replace(squeezed, r"[^\p{L}\p{N}_\s]", ""))


def comma_items(text: Column) -> Column:
    """Items of a comma-separated string; NULL gives an empty array."""
    return clean_items(F.split(text, ","))


def safe_log(value: Column) -> Column:
    """Natural log; NULL at zero, below zero and for NULL."""
    return F.when(value > 0, F.ln(value))


def _no_items() -> Column:
    return F.array().cast("array<string>")
