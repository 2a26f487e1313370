"""Log time stamps.

Well-formed values take the fast path (one shape test and one parse). A value that only a lenient calendar
accepts (hour 25, day 31 in a short month, text after the seconds) is read field by field and rolls
over. Anything else is epoch 0, or NULL with ``on_error="null"``.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from weblens.functions.text import as_col

# The time formats of the log files and of the results.
CLF_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"
LOG_FORMAT = "yyyy-MM-dd HH:mm:ss"
COMPACT_FORMAT = "yyyyMMddHHmmss"
MONTHS = "JanFebMarAprMayJunJulAugSepOctNovDec"

_LOG_SHAPE = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\z"
_LOG_FIELDS = r"^(\d{1,4})-(\d{1,4})-(\d{1,6}) (\d{1,6}):(\d{1,6}):(\d{1,6})"
_CLF_FIELDS = (r"^(\d{1,6})/([A-Za-z]{3})/(\d{1,4}):(\d{1,6}):(\d{1,6}):(\d{1,6}) "
               r"([+-]\d{2})(\d{2})")


def _wall_clock(year: Column, month: Column, day: Column,
                hour: Column, minute: Column, second: Column) -> Column:
    """TIMESTAMP_NTZ from fields that may overflow into the next larger unit."""
    first = F.add_months(F.make_date(year, F.lit(1), F.lit(1)), month - 1)
    return first.cast("timestamp_ntz") + F.make_dt_interval(day - 1, hour, minute, second)


def _fields(text: Column, pattern: str, *groups: int) -> list[Column]:
    return [F.regexp_extract(text, pattern, g).try_cast("int") for g in groups]


def _or_default(parsed: Column, on_error: str) -> Column:
    if on_error == "null":
        return parsed
    if on_error == "epoch":
        return F.coalesce(parsed, F.timestamp_seconds(F.lit(0)))
    raise ValueError(f"on_error must be 'epoch' or 'null', not {on_error!r}")


def log_timestamp(column: Column | str, on_error: str = "epoch") -> Column:
    """TIMESTAMP of ``yyyy-MM-dd HH:mm:ss`` in the session time zone."""
    text = as_col(column)
    strict = F.when(text.rlike(_LOG_SHAPE), text.try_cast("timestamp"))
    lenient = _wall_clock(*_fields(text, _LOG_FIELDS, 1, 2, 3, 4, 5, 6)).cast("timestamp")
    return _or_default(F.coalesce(strict, lenient), on_error)


def clf_timestamp(column: Column | str, on_error: str = "epoch") -> Column:
    """TIMESTAMP of ``[dd/MMM/yyyy:HH:mm:ss Z]``, with or without the brackets."""
    text = F.translate(as_col(column), "[]", "")
    day, year, hour, minute, second, zone_h, zone_m = _fields(text, _CLF_FIELDS, 1, 3, 4, 5, 6, 7, 8)
    at = F.position(F.initcap(F.regexp_extract(text, _CLF_FIELDS, 2)), F.lit(MONTHS))
    month = F.when((at > 0) & (at % 3 == 1), (at + 2) / 3).cast("int")
    zone_m = F.when(F.regexp_extract(text, _CLF_FIELDS, 7).startswith("-"), -zone_m).otherwise(zone_m)
    utc = _wall_clock(year, month, day, hour - zone_h, minute - zone_m, second)
    lenient = F.convert_timezone(F.lit("UTC"), F.current_timezone(), utc).cast("timestamp")
    return _or_default(F.coalesce(F.try_to_timestamp(text, F.lit(CLF_FORMAT)), lenient), on_error)


def normalize_clf_time(column: Column | str, on_error: str = "epoch") -> Column:
    """``[10/Nov/2016:00:01:02 +0800]`` as ``yyyy-MM-dd HH:mm:ss`` in the session time zone."""
    return F.date_format(clf_timestamp(column, on_error), LOG_FORMAT)


def normalize_click_time(column: Column | str, on_error: str = "epoch") -> Column:
    """``yyyy-MM-dd HH:mm:ss`` as ``yyyyMMddHHmmss``."""
    return F.date_format(log_timestamp(column, on_error), COMPACT_FORMAT)
