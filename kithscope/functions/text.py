"""Text cleaning and formatting as built-in Column expressions."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed set: characters removed from free text (backslash, quotes, comma, controls 0-31 and 127).
STRIPPED_CHARS = "\\\"'," + "".join(map(chr, range(32))) + chr(127)
# Fixed set: white space cut at both ends, which includes U+00A0 and U+FEFF.
EDGE_CHARS = "\t\n\x0b\x0c\r \u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000\ufeff"

LATIN_LETTERS = string.ascii_letters


def trim_all(text: Column) -> Column:
    return F.btrim(text, F.lit(EDGE_CHARS))


def normalize_text(text: Column) -> Column:
    """Drop separators, quotes and control characters; words across a newline join."""
    return trim_all(F.translate(text, STRIPPED_CHARS, ""))


def non_empty(text: Column) -> Column:
    return text.isNotNull() & (text != "")


def normalize_or_null(text: Column) -> Column:
    """Missing or empty text stays null instead of turning into an empty string."""
    return F.when(non_empty(text), normalize_text(text))


def first_category(professional: Column) -> Column:
    return F.try_element_at(professional["category"], F.lit(1))["name"]


def split_tags(tags: Column) -> Column:
    return F.filter(F.transform(F.split(tags, ","), trim_all), lambda t: t != "")


def export_file_stem(keyword: Column) -> Column:
    """File stem of a keyword export: no leading @, runs of other characters become one underscore."""
    bare = F.regexp_replace(keyword, "^@", "")
    safe = F.regexp_replace(bare, "[^a-zA-Z0-9_-]", "_")
    return F.lower(F.regexp_replace(safe, "_+", "_"))


def label_file_stem(keyword: Column) -> Column:
    """File stem of a label export: every other character becomes one underscore, case stays."""
    return F.regexp_replace(keyword, "[^a-zA-Z0-9_-]", "_")


def preview(text: Column, length: int, fallback: str = "No bio") -> Column:
    filled = F.when(non_empty(text), text).otherwise(F.lit(fallback))
    return F.replace(F.substring(filled, 1, length), F.lit("\n"), F.lit(" "))


def one_line(text: Column, length: int = 500) -> Column:
    """Cell text of a CSV export: newlines become blanks, then cut to a length."""
    return F.substring(F.replace(F.coalesce(text, F.lit("")), F.lit("\n"), F.lit(" ")), 1, length)


def quote_cell(text: Column, triggers: str) -> Column:
    """Double-quote a cell when it holds one of the trigger characters (a regex class)."""
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(text.rlike(triggers), quoted).otherwise(text)


def csv_cell(text: Column) -> Column:
    return quote_cell(text, '[,"\\n\\r]')


def table_cell(text: Column) -> Column:
    """Cell of a flat batch table: newlines to one blank, trimmed, quoted on comma, quote or tab."""
    return quote_cell(trim_all(F.regexp_replace(text, "[\\n\\r]+", " ")), '[,"\\t]')


def label_word(label: Column) -> Column:
    return F.coalesce(label.cast("string"), F.lit("null"))


def fixed_decimals(x: Column, digits: int) -> Column:
    """Number as text with a fixed count of decimals."""
    return F.format_string(f"%.{digits}f", x)


def strip_code_fence(text: Column) -> Column:
    """Remove one leading and one trailing code fence around an answer."""
    bare = trim_all(text)
    opened = F.regexp_replace(bare, "^```(json)?", "")
    return trim_all(F.regexp_replace(opened, "```$", ""))


def latin_share(text: Column) -> Column:
    """Share of basic Latin letters among all characters; 0 for missing or empty text."""
    others = F.length(F.translate(text, LATIN_LETTERS, ""))
    return F.when(non_empty(text), F.lit(1.0) - others / F.length(text)).otherwise(F.lit(0.0))
