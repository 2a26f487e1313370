"""String expressions with the exact splitting, trimming and number rules of the log formats."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# Characters removed from text before words are counted.
WORD_PUNCTUATION = ";；.!',"

# Trimming removes every character up to and including the space (U+0000 to U+0020).
BLANKS = "".join(chr(c) for c in range(0x21))

_INTEGER = r"^[+-]?[0-9]+\z"


def as_col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def split_fields(column: Column | str, delimiter: str) -> Column:
    """Split on a one-character delimiter and drop trailing empty fields.

    An empty string has one empty field; a string made of delimiters only has none. Most strings do not
    end in the delimiter and are split as they are.
    """
    text, pattern = as_col(column), re.escape(delimiter)
    body = F.rtrim(text, F.lit(delimiter))
    return (F.when(~F.endswith(text, F.lit(delimiter)), F.split(text, pattern))
            .when(body == "", F.array().cast("array<string>"))
            .otherwise(F.split(body, pattern)))


def trim_blanks(column: Column | str) -> Column:
    return F.trim(as_col(column), F.lit(BLANKS))


def strict_int(column: Column | str) -> Column:
    """INT from digits with an optional sign; NULL for anything else, blanks included."""
    text = as_col(column)
    return F.when(text.rlike(_INTEGER), text.try_cast("int"))


def strict_long(column: Column | str) -> Column:
    text = as_col(column)
    return F.when(text.rlike(_INTEGER), text.try_cast("bigint"))


def normalize_text(column: Column | str) -> Column:
    """Lower case without punctuation."""
    return F.regexp_replace(F.lower(as_col(column)), f"[{re.escape(WORD_PUNCTUATION)}]", "")


def referrer_host(column: Column | str) -> Column:
    """Host of a referrer URL, or '' when no path or query follows the host."""
    parts = split_fields(F.replace(as_col(column), F.lit("//"), F.lit("/")), "/")
    return F.when(F.size(parts) > 2, F.get(parts, F.lit(1))).otherwise(F.lit(""))


def composite_key(*columns: Column | str) -> Column:
    return F.concat_ws("_", *[as_col(c) for c in columns])
