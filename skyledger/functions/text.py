"""Text expressions: lookup keys, path cleaning, query extraction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PATH_SEPARATOR = " -> "

# Unicode white space plus the four ASCII separators U+001C..U+001F.
_SPACE = r"[\s\x1c-\x1f]"


def strip(c: Column) -> Column:
    """Cut white space of any kind from both ends (``trim`` cuts spaces only)."""
    return F.regexp_replace(c, rf"(?U)\A{_SPACE}+|{_SPACE}+\z", "")


def unquote(c: Column) -> Column:
    return F.replace(c, F.lit('"'), F.lit(""))


def lookup_key(c: Column) -> Column:
    """The form in which codes are compared on both sides of a lookup."""
    return F.trim(F.upper(c))


def not_blank(c: Column) -> Column:
    return c.isNotNull() & (F.trim(c) != "")


def clean_path(c: Column) -> Column:
    """Drop an airport that repeats the one before it in ``A -> A -> B``."""
    stops = F.transform(F.split(c, PATH_SEPARATOR), strip)
    kept = F.filter(
        stops,
        lambda stop, i: (i == 0) | (stop != F.get(stops, i - 1)),
    )
    return F.when(c.isNotNull(), F.array_join(kept, PATH_SEPARATOR))


def extract_select(c: Column) -> Column:
    """The text from its first ``SELECT`` on; all of it when there is none."""
    start = F.greatest(F.instr(F.upper(c), "SELECT"), F.lit(1))
    return strip(F.substring(c, start, F.length(c)))
