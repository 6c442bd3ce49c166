"""Column functions on text. Blanks follow the Unicode definition, as ``str.split`` does."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANK = r"[\s\x1c-\x1f]"


def _column(text: Column | str) -> Column:
    return F.col(text) if isinstance(text, str) else text


def strip(text: Column | str) -> Column:
    """Drop leading and trailing blanks of every kind, tabs and line ends included."""
    return F.regexp_replace(_column(text), rf"(?U)^{BLANK}+|{BLANK}+$", "")


def words(text: Column | str) -> Column:
    """Blank-separated words; an all-blank text has none."""
    return F.filter(F.split(_column(text), rf"(?U){BLANK}+"), lambda w: w != "")


def truncate_words(text: Column | str, n: int) -> Column:
    """The first ``n`` words joined by single blanks."""
    return F.array_join(F.slice(words(text), 1, n), " ")


def normalize_line(text: Column | str) -> Column:
    """One line: stripped, every run of blanks and line ends a single blank."""
    return F.regexp_replace(strip(text), rf"(?U){BLANK}+", " ")


def terms(text: Column | str) -> Column:
    """Lower-cased runs of letters, in order and with repeats."""
    return F.regexp_extract_all(F.lower(_column(text)), F.lit(r"(\p{L}+)"), F.lit(1))


def decode_response(payload: Column | str) -> Column:
    """The ``response`` field of a generator's JSON answer, empty when absent."""
    return F.coalesce(F.get_json_object(_column(payload), "$.response"), F.lit(""))
