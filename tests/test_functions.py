"""Column expressions against plain Python models of the same rules."""

import random
import re
from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal, localcontext

import pytest
from pyspark.sql import functions as F

from weblens.functions import net, numbers, text, times
from weblens.functions.aggregates import AlgebraicAggregate, self_avg, self_avg_in_pandas


def evaluate(spark, values, expression, kind="STRING"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, v {kind}")
    return [r.x for r in df.select("i", expression.alias("x")).orderBy("i").collect()]


def model_split(value, delimiter):
    if value == "":
        return [""]
    parts = value.split(delimiter)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def random_text(rng, alphabet, size):
    return "".join(rng.choice(alphabet) for _ in range(rng.randrange(size)))


@pytest.mark.parametrize("delimiter", ["\t", " ", "/", "."])
def test_split_fields_matches_model(spark, delimiter):
    rng = random.Random(7)
    values = ["", delimiter, delimiter * 3, f"a{delimiter * 2}b{delimiter * 2}", "plain", None]
    values += [random_text(rng, "ab;é" + delimiter * 3, 12) for _ in range(400)]
    got = evaluate(spark, values, text.split_fields("v", delimiter))
    assert got == [None if v is None else model_split(v, delimiter) for v in values]


def test_split_fields_sizes(spark):
    got = evaluate(spark, ["", "   ", "a  b  "], F.size(text.split_fields("v", " ")))
    assert got == [1, 0, 3]


def test_trim_blanks_removes_control_characters(spark):
    got = evaluate(spark, [" \t\x00a b\x1f\r ", " a", " \n "], text.trim_blanks("v"))
    assert got == ["a b", " a", ""]


def test_strict_numbers(spark):
    values = ["12", "-7", "+3", " 12", "12 ", "", "1.5", "1e3", "x1", "2147483648", "12\n",
              "9223372036854775808", None]
    assert evaluate(spark, values, text.strict_int("v")) == [
        12, -7, 3] + [None] * 10
    assert evaluate(spark, values, text.strict_long("v"))[9] == 2147483648
    assert evaluate(spark, values, text.strict_long("v"))[11] is None


def test_normalize_text(spark):
    assert evaluate(spark, ["It's, a.b;c；D!"], text.normalize_text("v")) == ["its abcd"]


def test_referrer_host(spark):
    cases = {
        "https://www.sogou.com/web?query=x": "www.sogou.com",
        "http://cn.bing.com/search?q=x": "cn.bing.com",
        "https://www.sogou.com": "", "https://www.sogou.com/": "", "-": "", "": "",
        "https://m.example.org/a/b": "m.example.org", "a/b/c": "b",
    }
    assert evaluate(spark, list(cases), text.referrer_host("v")) == list(cases.values())


def test_composite_keys(spark):
    df = spark.createDataFrame([("20181209", "cn.bing.com", 88)], "day STRING, host STRING, id INT")
    row = df.select(text.composite_key("day", "id").alias("a"),
                    text.composite_key("day", "host", "id").alias("b")).first()
    assert tuple(row) == ("20181209_88", "20181209_cn.bing.com_88")


def test_clf_time(spark):
    values = ["[10/Nov/2016:00:01:02 +0800]", "10/Nov/2016:00:01:02 +0000", "junk", "",
              "[31/Feb/2016:25:00:00 +0000]", "[10/nov/2016:00:01:02 -0130] tail", None]
    assert evaluate(spark, values, times.normalize_clf_time("v")) == [
        "2016-11-09 16:01:02", "2016-11-10 00:01:02", "1970-01-01 00:00:00", "1970-01-01 00:00:00",
        "2016-03-03 01:00:00", "2016-11-10 01:31:02", "1970-01-01 00:00:00"]
    assert evaluate(spark, ["junk"], times.normalize_clf_time("v", "null")) == [None]


def test_clf_time_uses_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        values = ["[10/Nov/2016:00:01:02 +0800]", "[9/Nov/2016:24:01:02 +0800] x", "junk"]
        assert evaluate(spark, values, times.normalize_clf_time("v")) == [
            "2016-11-10 00:01:02", "2016-11-10 00:01:02", "1970-01-01 08:00:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_click_time(spark):
    values = ["2018-12-05 17:01:01", "junk", "2018-12-05", "2018-12-05 17:01:01.123 x",
              "2018-13-32 24:60:61", "2018-1-5 7:1:1", " 2018-12-05 17:01:01", "2018-02-30 00:00:00"]
    assert evaluate(spark, values, times.normalize_click_time("v")) == [
        "20181205170101", "19700101000000", "19700101000000", "20181205170101",
        "20190202010101", "20180105070101", "19700101000000", "20180302000000"]
    assert evaluate(spark, ["junk"], times.normalize_click_time("v", "null")) == [None]
    with pytest.raises(ValueError):
        times.normalize_click_time("v", "drop")


def test_click_time_rolls_over_like_a_calendar(spark):
    rng = random.Random(3)
    fields = [(rng.randrange(1990, 2030), rng.randrange(0, 30), rng.randrange(0, 70),
               rng.randrange(0, 99), rng.randrange(0, 99), rng.randrange(0, 99)) for _ in range(300)]
    values = ["%04d-%02d-%02d %02d:%02d:%02d" % f for f in fields]
    expected = []
    for y, mo, d, h, mi, s in fields:
        first = datetime(y + (mo - 1) // 12, (mo - 1) % 12 + 1, 1)
        at = first + timedelta(days=d - 1, hours=h, minutes=mi, seconds=s)
        expected.append(at.strftime("%Y%m%d%H%M%S"))
    assert evaluate(spark, values, times.normalize_click_time("v")) == expected


def test_ipv4(spark):
    values = ["0.0.0.0", "255.255.255.255", "10.0.1.2", "1.2.3", "1.2.3.4.5", "256.1.1.1", "a.b.c.d",
              " 1.2.3.4", "1.2.3.4 ", "1..3.4", "", None]
    assert evaluate(spark, values, net.ipv4_to_long("v")) == [
        0, 2 ** 32 - 1, (10 << 24) + 258] + [None] * 9


def model_format(value, scale):
    with localcontext() as context:
        context.prec = 400
        rounded = Decimal(value).quantize(Decimal(1).scaleb(-scale), ROUND_HALF_UP)
    plain = format(rounded, "f")
    if "." in plain:
        plain = plain.rstrip("0").rstrip(".")
    return re.sub(r"^-0$", "0", plain)


@pytest.mark.parametrize("scale", [-3, -1, 0, 1, 2, 8, 18, 19, 25, 30])
def test_format_double_matches_model(spark, scale):
    rng = random.Random(scale)
    values = ["2175.0", "1500.04", "1500.05", "0", "0.00", "-0.04", "100", "1E+3", "-2.5", "2.5"]
    values += [f"{rng.uniform(-1e6, 1e6):.{rng.randrange(6)}f}" for _ in range(200)]
    values += ["9" * n + "." + "9" * m for n in range(4) for m in (1, 17, 18, 19, 30)] + ["0.4999999999999999999", "0.5", "-.5", "5.", " 7 "]
    values += ["".join(rng.choice("0123456789") for _ in range(30)) + "." + "".join(rng.choice("059") for _ in range(30)) for _ in range(100)]
    values += [f"{rng.choice('+-')}{rng.randrange(10 ** 9)}e{rng.randrange(-40, 40)}" for _ in range(100)] + ["-0.0", "1E-30", "1.0E10", "0e9"]
    expected = [model_format(v.strip(), scale) for v in values]
    assert evaluate(spark, values, numbers.format_double("v", scale)) == expected

    numbers.register_sql_functions(spark)
    sql = F.expr(f"format_double(v, {scale})")
    assert evaluate(spark, values, sql) == expected


def test_format_double_edges(spark):
    assert evaluate(spark, ["x", None], numbers.format_double("v", 2)) == [None, None]
    assert evaluate(spark, [2175.0, 1500.04], numbers.format_double("v", 1), "DOUBLE") == [
        "2175", "1500"]
    assert evaluate(spark, ["12355"], numbers.format_double("v", -1)) == ["12360"]
    assert evaluate(spark, ["0.4999999999999999999"], numbers.format_double("v", 0)) == ["0"]
    assert evaluate(spark, ["", ".", "e5", "1e", "1.2.3", "--1", "NaN", "Infinity", "1e99999", "１"], numbers.format_double("v", 2)) == [None] * 10
    assert evaluate(spark, [float("nan"), float("inf"), 1e300, 5e-324], numbers.format_double("v", 1), "DOUBLE") == [
        None, None, "1" + "0" * 300, "0"]


def test_sql_functions_are_inlined(spark):
    numbers.register_sql_functions(spark)
    plan = (spark.range(3).selectExpr("strLen(id) AS n")
            ._jdf.queryExecution().optimizedPlan().toString())
    assert "length(" in plan and "strLen(" not in plan


def test_self_avg_of_nothing_is_nan(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", None), ("b", None)],
                               "k STRING, v DOUBLE")
    got = {r.k: r.x for r in df.groupBy("k").agg(self_avg("v").alias("x")).collect()}
    assert got["a"] == 1.5 and got["b"] != got["b"]
    in_pandas = {r.k: r.avg for r in self_avg_in_pandas(df, "k", "v").collect()}
    assert in_pandas["a"] == 1.5 and in_pandas["b"] != in_pandas["b"]


def test_algebraic_aggregate_keeps_partial_aggregation(spark):
    spread = AlgebraicAggregate({"lo": F.min, "hi": F.max}, lambda s: s["hi"] - s["lo"])
    df = spark.range(100).groupBy((F.col("id") % 3).alias("k")).agg(spread("id").alias("spread"))
    assert {r.k: r.spread for r in df.collect()} == {0: 99, 1: 96, 2: 96}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "partial_max" in plan
