"""Parsing of raw log lines.

Every parser takes a DataFrame with a ``value`` column of lines and returns one row per line: the line,
the parsed fields, and ``reason``, which is NULL for a good line. ``accepted`` and ``rejected`` take the
two sides apart; ``clean_*`` do both.

The fields go through ``inline``: Spark does not push a filter below a generator, so the line is parsed
once per row instead of again in every pushed-down condition.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.types import StructType

from weblens import schemas
from weblens.functions.text import split_fields, strict_int, strict_long, trim_blanks
from weblens.functions.times import normalize_click_time
from weblens.operators.geo import with_region

SITE = "http://www.example.com/"


class Cleaned(NamedTuple):
    good: DataFrame
    rejects: DataFrame


def _field(i: int, column: str = "fields") -> Column:
    return F.get(F.col(column), F.lit(i))


def _with_fields(lines: DataFrame, delimiter: str) -> DataFrame:
    return lines.select("value", split_fields("value", delimiter).alias("fields"))


def _parsed(df: DataFrame, *fields: Column) -> DataFrame:
    return (df.select("value", F.struct(*fields).alias("parsed"))
            .select("value", F.inline(F.array("parsed"))))


def accepted(parsed: DataFrame, schema: StructType) -> DataFrame:
    return parsed.filter(F.col("reason").isNull()).select(*schema.fieldNames())


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reason").isNotNull()).select("value", "reason")


def observe_rejects(parsed: DataFrame, observation: Observation) -> DataFrame:
    """Count lines and rejects while the good rows are written, without a second scan."""
    return parsed.observe(
        observation, F.count(F.lit(1)).alias("lines"), F.count("reason").alias("rejects"))


# --- access log: time, url, traffic, ip ---------------------------------------------------------

#: What a line says itself; the region is looked up afterwards.
ACCESS_FIELDS = StructType([f for f in schemas.CLEAN_ACCESS if f.name != "city"])


def parse_access(lines: DataFrame, site: str = SITE) -> DataFrame:
    """Type and id come from the path after the site prefix: ``<site>video/17`` is (video, 17).

    A path with fewer than two parts has type '' and id 0.
    """
    url, at = F.col("url"), F.locate(site, F.col("url"))
    df = (_with_fields(lines, "\t")
          .select("value", "fields", _field(0).alias("time"), _field(1).alias("url"),
                  strict_long(_field(2)).alias("traffic"), _field(3).alias("ip"))
          .withColumn("path", F.when(at > 0, F.substring(url, at + len(site), F.length(url))))
          .withColumn("parts", split_fields("path", "/")))
    typed = F.size("parts") > 1
    df = (df.withColumn("cmsType", F.when(typed, _field(0, "parts")).otherwise(""))
          .withColumn("cmsId", F.when(typed, strict_long(_field(1, "parts")))
                      .otherwise(F.lit(0).cast("bigint"))))
    reason = (F.when(F.size("fields") < 4, "missing_field")
              .when(F.col("traffic").isNull(), "bad_traffic")
              .when(F.col("path").isNull(), "no_site_prefix")
              .when(F.col("cmsId").isNull(), "bad_id")
              .when(F.length("time") < 10, "short_time"))
    day = F.replace(F.substring("time", 1, 10), F.lit("-"), F.lit(""))
    return _parsed(df, url, F.col("cmsType"), F.col("cmsId"), F.col("traffic"), F.col("ip"),
                   F.col("time"), day.alias("day"), reason.alias("reason"))


def accepted_access(parsed: DataFrame, ranges: DataFrame) -> DataFrame:
    """Good access rows with the region of their address as ``city``."""
    located = with_region(accepted(parsed, ACCESS_FIELDS), ranges, "ip", "city")
    return located.select(*schemas.CLEAN_ACCESS.fieldNames())


def clean_access(lines: DataFrame, ranges: DataFrame, site: str = SITE) -> Cleaned:
    parsed = parse_access(lines, site)
    return Cleaned(accepted_access(parsed, ranges), rejected(parsed))


# --- page views: time, url, guid, ... -----------------------------------------------------------

def parse_page_views(lines: DataFrame) -> DataFrame:
    """The date is the first ten characters of the untrimmed time; url and guid may be empty."""
    df = _with_fields(lines, "\t")
    time = _field(0)
    reason = (F.when(F.size("fields") < 3, "missing_field")
              .when(F.length(trim_blanks(time)) == 0, "blank_time")
              .when(F.length(time) < 10, "short_time"))
    return _parsed(df, F.substring(time, 1, 10).alias("date"), trim_blanks(_field(1)).alias("url"),
                   trim_blanks(_field(2)).alias("guid"), reason.alias("reason"))


def clean_page_views(lines: DataFrame) -> Cleaned:
    parsed = parse_page_views(lines)
    return Cleaned(accepted(parsed, schemas.PAGE_VIEW), rejected(parsed))


# --- "key value" lines --------------------------------------------------------------------------

def parse_key_value(lines: DataFrame) -> DataFrame:
    df = (_with_fields(lines, " ")
          .select("value", "fields", trim_blanks(_field(0)).alias("key"),
                  strict_int(trim_blanks(_field(1))).alias("number")))
    reason = (F.when(F.size("fields") != 2, "field_count")
              .when(F.col("number").isNull(), "bad_value"))
    return (df.select(F.col("value").alias("line"),
                      F.struct("key", F.col("number").alias("value"),
                               reason.alias("reason")).alias("parsed"))
            .select("line", F.inline(F.array("parsed"))))


def clean_key_value(lines: DataFrame) -> Cleaned:
    parsed = parse_key_value(lines)
    rejects = (parsed.filter(F.col("reason").isNotNull())
               .select(F.col("line").alias("value"), "reason"))
    return Cleaned(accepted(parsed, schemas.KEY_VALUE), rejects)


# --- click stream: ip, time, "GET <url> HTTP/1.1", status, referer ------------------------------

def parse_clicks(lines: DataFrame, on_bad_time: str = "epoch") -> DataFrame:
    """Course id is the number before the first dot of path part 2 when the path starts with /class.

    Other URLs have course 0 and count as clicks, whatever their status. A bad time is epoch 0, or a
    reject with ``on_bad_time="reject"``.
    """
    df = (_with_fields(lines, "\t")
          .withColumn("url", F.get(split_fields(_field(2), " "), F.lit(1)))
          .withColumn("page", F.get(split_fields("url", "/"), F.lit(2)))
          .withColumn("statusCode", strict_int(_field(3)))
          .withColumn("time", normalize_click_time(
              _field(1), "null" if on_bad_time == "reject" else on_bad_time)))
    course = (F.when(F.col("url").startswith("/class"),
                     strict_int(F.substring_index("page", ".", 1)))
              .otherwise(F.lit(0)))
    df = df.withColumn("courseId", course)
    reason = (F.when(F.size("fields") < 5, "missing_field")
              .when(F.col("url").isNull(), "bad_request")
              .when(F.col("courseId").isNull(), "bad_course")
              .when(F.col("statusCode").isNull(), "bad_status")
              .when(F.col("time").isNull(), "bad_time"))
    return _parsed(df, _field(0).alias("ip"), F.col("time"), F.col("courseId"), F.col("statusCode"),
                   _field(4).alias("referer"), reason.alias("reason"))


def clean_clicks(lines: DataFrame, on_bad_time: str = "epoch") -> Cleaned:
    parsed = parse_clicks(lines, on_bad_time)
    return Cleaned(accepted(parsed, schemas.CLICK), rejected(parsed))
