"""Scalar functions for reports, also under their SQL names."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F

from weblens.functions.text import as_col

def str_len(column: Column | str) -> Column:
    """Length in characters."""
    return F.length(as_col(column).cast("string"))


# A decimal number as text: sign, digits before and after the point, exponent.
_NUMBER = r"^\s*([+-]?)(?=[.]?[0-9])([0-9]*)(?:[.]([0-9]*))?(?:[eE]([+-]?[0-9]{1,4}))?\s*$"

# Each function names one step, so that no step is written (or computed) twice; Catalyst inlines them all.
_STEPS = {
    # Digits without point, and how many of them stand before it.
    "weblens_digits(s STRING)": (
        "STRUCT<negative: BOOLEAN, digits: STRING, point: INT>",
        f"""CASE WHEN s RLIKE r'{_NUMBER}' THEN named_struct(
          'negative', regexp_extract(s, r'{_NUMBER}', 1) = '-',
          'digits', concat(regexp_extract(s, r'{_NUMBER}', 2), regexp_extract(s, r'{_NUMBER}', 3)),
          'point', length(regexp_extract(s, r'{_NUMBER}', 2)) + coalesce(try_cast(regexp_extract(s, r'{_NUMBER}', 4) AS INT), 0)) END"""),
    # Enough zeros on both sides for the point and the last kept place to be inside, and one in front for a carry.
    "weblens_padded(n STRUCT<negative: BOOLEAN, digits: STRING, point: INT>, scale INT)": (
        "STRUCT<negative: BOOLEAN, digits: STRING, keep: INT>",
        """named_struct('negative', n.negative,
          'digits', concat('0', repeat('0', greatest(0, -n.point, -scale - n.point)), n.digits,
                           repeat('0', greatest(0, n.point - length(n.digits), n.point + scale - length(n.digits)))),
          'keep', 1 + greatest(0, -n.point, -scale - n.point) + n.point + scale)"""),
    # Kept digits, one more at the last place if the first dropped digit is 5 or more: a run of nines at the end turns to zeros.
    "weblens_carried(kept STRING)": (
        "STRING",
        """concat(substring(kept, 1, length(rtrim('9', kept)) - 1),
          CAST(CAST(substring(kept, length(rtrim('9', kept)), 1) AS INT) + 1 AS STRING), repeat('0', length(kept) - length(rtrim('9', kept))))"""),
    "weblens_rounded(n STRUCT<negative: BOOLEAN, digits: STRING, keep: INT>)": (
        "STRUCT<negative: BOOLEAN, digits: STRING>",
        """named_struct('negative', n.negative, 'digits', CASE WHEN substring(n.digits, n.keep + 1, 1) >= '5'
          THEN weblens_carried(left(n.digits, n.keep)) ELSE left(n.digits, n.keep) END)"""),
    "weblens_whole(digits STRING, scale INT)": (
        "STRING",
        """CASE WHEN ltrim('0', left(digits, length(digits) - greatest(scale, 0))) = '' THEN '0'
          ELSE concat(ltrim('0', left(digits, length(digits) - greatest(scale, 0))), repeat('0', greatest(-scale, 0))) END"""),
    "weblens_unsigned(digits STRING, scale INT)": (
        "STRING",
        """concat(weblens_whole(digits, scale), CASE WHEN rtrim('0', right(digits, greatest(scale, 0))) = '' THEN ''
          ELSE concat('.', rtrim('0', right(digits, greatest(scale, 0)))) END)"""),
    "weblens_signed(n STRUCT<negative: BOOLEAN, digits: STRING>, scale INT)": (
        "STRING",
        """CASE WHEN n.negative AND ltrim('0', n.digits) <> '' THEN concat('-', weblens_unsigned(n.digits, scale))
          ELSE weblens_unsigned(n.digits, scale) END"""),
    "format_double(s STRING, scale INT)": (
        "STRING", "weblens_signed(weblens_rounded(weblens_padded(weblens_digits(s), scale)), scale)"),
}


def format_double(column: Column | str, scale: int) -> Column:
    """Plain decimal text, rounded half up to ``scale`` digits (tens and so on if negative), without trailing zeros.

    The digits themselves are rounded, so numbers of any length keep them all. NULL for text that is no number, and
    for exponents of more than four digits. It is the SQL function ``format_double`` of the active session.
    """
    register_sql_functions(SparkSession.active())
    return F.call_function("format_double", as_col(column).cast("string"), F.lit(scale))


def register_sql_functions(spark: SparkSession) -> None:
    """Make ``strLen``, ``format_double`` and ``self_avg`` available to ``spark.sql``.

    All three are SQL functions that Catalyst inlines. SQL function bodies may not hold aggregates, so
    ``self_avg`` takes the two aggregates of its buffer: ``self_avg(sum(x), count(x))``.
    """
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION strLen(s STRING) RETURNS INT RETURN length(s)")
    for head, (kind, body) in _STEPS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURNS {kind} RETURN {body}")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION self_avg(total DOUBLE, n BIGINT) RETURNS DOUBLE "
        "RETURN CASE WHEN n = 0 THEN double('NaN') ELSE total / n END")
