"""Raw log lines, CSV rows and reference tables derived by Spark from the given tables.

The definitions are in ``FIXTURES.md``; nothing is written here, the lines are part of each query's plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from weblens.operators.clean import SITE


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tsv(*fields: Column) -> Column:
    return F.concat_ws("\t", *fields).alias("value")


def _text(number: Column | str) -> Column:
    return (F.col(number) if isinstance(number, str) else number).cast("string")


def _stamp(fmt: str) -> Column:
    return F.date_format("ts", fmt)


LOG_TIME = "yyyy-MM-dd HH:mm:ss"


def _is(event_type: str) -> Column:
    return F.col("event_type") == event_type


def _fault(n: int) -> Column:
    """Every error event has one of five faults."""
    return _is("error") & (F.floor("value") % 5 == n)


def user_ip(user: str = "user_id") -> Column:
    u = F.col(user)
    octets = [F.floor(u / 65536) % 256, F.floor(u / 256) % 256, u % 256]
    return F.concat_ws(".", F.lit("10"), *[_text(o) for o in octets])


def access_lines(events: DataFrame) -> DataFrame:
    """F1."""
    user = _text("user_id")
    path = (F.when(_is("view"), F.concat(F.lit("video/"), user))
            .when(_is("purchase"), F.concat(F.lit("video/"), _text(F.col("user_id") % 20)))
            .when(_is("click"), F.concat(F.lit("article/"), user))
            .when(_is("signup"), F.lit("user"))
            .when(_fault(0), F.concat(F.lit("video/x"), user))
            .otherwise(F.concat(F.lit("video/"), user)))
    site = F.when(_fault(2), "http://other.example.org/").otherwise(SITE)
    time = F.when(_fault(3), _stamp("HH:mm:ss")).otherwise(_stamp(LOG_TIME))
    traffic = F.when(_fault(1), "n/a").otherwise(_text(F.floor(F.col("value") * 100)))
    ip = F.when(_fault(4), "").otherwise(user_ip())
    return events.select(_tsv(time, F.concat(site, path), traffic, ip))


def ip_ranges(spark: SparkSession) -> DataFrame:
    """F2: sixteen ranges of ten addresses from 10.0.0.0 on."""
    lo = F.lit(10 * 256 ** 3) + F.col("id") * 10
    return spark.range(16).select(lo.alias("lo"), (lo + 9).alias("hi"),
                                  F.concat(F.lit("R"), _text("id")).alias("region"))


def clf_times(events: DataFrame) -> DataFrame:
    """views are stamped in a +0800 zone, errors are not times at all."""
    there = F.expr("ts + INTERVAL 8 HOURS")
    stamped = "dd/MMM/yyyy:HH:mm:ss"
    raw = (F.when(_is("error"), "junk")
           .when(_is("view"), F.concat(F.lit("["), F.date_format(there, stamped), F.lit(" +0800]")))
           .otherwise(F.concat(F.lit("["), _stamp(stamped), F.lit(" +0000]"))))
    return events.select(raw.alias("raw"))


def click_times(events: DataFrame) -> DataFrame:
    return events.select(F.when(_is("error"), "junk").otherwise(_stamp(LOG_TIME)).alias("raw"))


def page_view_lines(events: DataFrame) -> DataFrame:
    """F4."""
    url = F.when(_is("signup"), "").otherwise(F.col("event_type"))
    guid = F.when(_is("error"), "").otherwise(_text("user_id"))
    return events.select(_tsv(_stamp(LOG_TIME), url, guid, F.lit("x")))


def taxi_trips(events: DataFrame) -> DataFrame:
    """F5."""
    return events.select(
        F.col("user_id").cast("int").alias("id"),
        F.concat(F.lit("30."), _text(F.floor("value"))).alias("lat"),
        F.concat(F.lit("104."), _text("user_id")).alias("lon"),
        _stamp("HH:mm:ss").alias("time"))


def key_value_lines(lineitem: DataFrame, value: str = "l_extendedprice") -> DataFrame:
    """F6."""
    key = F.concat("l_returnflag", "l_linestatus")
    return lineitem.select(F.concat_ws(" ", key, _text(F.floor(value))).alias("value"))


def document_lines(documents: DataFrame) -> DataFrame:
    """F7."""
    return documents.select(F.explode(F.split("text", "\n")).alias("value"))


def emp(customer: DataFrame) -> DataFrame:
    """F8."""
    return customer.select(F.col("c_custkey").alias("empno"), F.col("c_name").alias("ename"),
                           F.col("c_nationkey").alias("deptno"), F.col("c_acctbal").alias("sal"))


def dept(nation: DataFrame) -> DataFrame:
    return nation.select(F.col("n_nationkey").alias("deptno"), F.col("n_name").alias("dname"))


def referer() -> Column:
    return (F.when(_is("view"), "http://cn.bing.com/search?q=x")
            .when(_is("click"), "https://www.sogou.com/web?query=x")
            .when(_is("purchase"), "https://www.sogou.com")
            .when(_is("signup"), "-")
            .otherwise("https://m.example.org/a/b"))


def click_lines(events: DataFrame) -> DataFrame:
    """F10; ``late`` tells the second file of the stream from the first."""
    user = _text("user_id")
    url = (F.when(_is("click"), F.concat(F.lit("/classroom/"), user, F.lit(".html")))
           .when(_is("purchase"), F.lit("/list"))
           .when(_is("error"), F.lit("/learn/1"))
           .otherwise(F.concat(F.lit("/class/"), user, F.lit(".html"))))
    status = F.when(_is("signup"), "404").when(_is("error"), "500").otherwise("200")
    request = F.concat(F.lit('"GET '), url, F.lit(' HTTP/1.1"'))
    line = _tsv(user_ip(), _stamp(LOG_TIME), request, status, referer())
    return events.select(line, (F.dayofmonth("ts") > 15).alias("late"))
