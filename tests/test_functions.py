import datetime as dt

import pytest
from pyspark.sql import functions as F

from hydrocal.functions import (
    adjusted_depth,
    file_stem,
    months_before,
    parse_date_time,
    parse_day_first,
    raw_depth,
    report_ts,
    round2,
    strip_tags,
    to_number,
)


def one(spark, expr, value, ddl="s string"):
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("x")).collect()[0]["x"]


@pytest.mark.parametrize(
    "text,expected",
    [
        ("01/02/2024 03:04:05", dt.datetime(2024, 2, 1, 3, 4, 5)),
        ("1/2/2024 3:04:05", dt.datetime(2024, 2, 1, 3, 4, 5)),
        ("31/02/2024 00:00:00", None),
        ("05/01/24 00:00:00", None),
        ("05/01/2024 00:00:00 ", None),
        ("5/1/2024 24:00:00", None),
        ("5/1/2024 23:59:60", None),
        ("05/01/02024 00:00:00", None),
        ("05/01/2024", None),
        ("2024-01-05 00:00:00", None),
        ("29/02/2024 12:00:00", dt.datetime(2024, 2, 29, 12, 0, 0)),
        ("05/01/2024  07:08:09", dt.datetime(2024, 1, 5, 7, 8, 9)),
        (None, None),
    ],
)
def test_parse_day_first(spark, text, expected):
    assert one(spark, parse_day_first(F.col("s")), text) == expected


def test_parse_date_time_null_propagates(spark):
    df = spark.createDataFrame([("01/02/2024", None), ("01/02/2024", "03:04:05")], "d string, t string")
    got = [r.x for r in df.select(parse_date_time(F.col("d"), F.col("t")).alias("x")).collect()]
    assert got == [None, dt.datetime(2024, 2, 1, 3, 4, 5)]


@pytest.mark.parametrize(
    "text,expected",
    [
        ("abc", None),
        ("", None),
        ("NaN", None),
        ("nan", None),
        ("NA", None),
        ("1.5d", None),
        ("1.5F", None),
        ("1e3", 1000.0),
        (" 1.5 ", 1.5),
        ("-0.1", -0.1),
        ("inf", float("inf")),
        ("1,5", None),
    ],
)
def test_to_number(spark, text, expected):
    assert one(spark, to_number(F.col("s")), text) == expected


@pytest.mark.parametrize("x,expected", [(0.575, 0.57), (8.345, 8.35), (0.125, 0.12), (3.048, 3.05)])
def test_round2_half_even_binary(spark, x, expected):
    assert one(spark, round2(F.col("s")), x, "s double") == expected


def test_raw_and_adjusted_depth_normal_case(spark):
    df = spark.createDataFrame([(10.0, 1010.0, 1000.0, "default"), (250.0, 1010.0, None, "divide_by_100")],
                               "lvl double, baro double, bom double, t string")
    out = df.select(raw_depth(F.col("lvl"), F.col("t")).alias("raw"), "baro", "bom")
    out = out.select("raw", adjusted_depth(F.col("raw"), F.col("baro"), F.col("bom"), 1.0).alias("adj")).collect()
    assert (out[0].raw, out[0].adj) == (3.05, 3.15)
    assert (out[1].raw, out[1].adj) == (2.5, None)


def test_adjusted_depth_specific_gravity(spark):
    df = spark.createDataFrame([(3.05, 1010.0, 1000.0)], "raw double, baro double, bom double")
    got = df.select(adjusted_depth(F.col("raw"), F.col("baro"), F.col("bom"), 1.025).alias("x")).collect()[0].x
    assert got == round(3.05 + 0.70307 * (10 * 0.0145038) / 1.025, 2)
    none = df.select(adjusted_depth(F.col("raw"), F.col("baro"), F.col("bom"), None).alias("x")).collect()[0].x
    assert none is None


@pytest.mark.parametrize(
    "path,stem",
    [("/data/A.csv", "A"), ("A.CSV", "A"), ("dir/a.b.csv", "a.b"), (".env", ".env"), ("noext", "noext"), ("x.", "x")],
)
def test_file_stem(spark, path, stem):
    assert one(spark, file_stem(F.col("s")), path) == stem


def test_months_before_clamps_month_end(spark):
    got = one(spark, months_before(F.col("s").cast("timestamp_ntz"), 2), "2026-04-30 10:00:00")
    assert got == dt.datetime(2026, 2, 28, 10, 0, 0)


def test_report_ts_twelve_hour(spark):
    df = spark.createDataFrame([("2026-03-05 00:10:00",), ("2026-03-05 13:00:00",)], "s string")
    got = [r.x for r in df.select(report_ts(F.col("s").cast("timestamp_ntz")).alias("x")).collect()]
    assert got == ["05/03/2026 12:10:00 AM", "05/03/2026 01:00:00 PM"]


def test_strip_tags(spark):
    assert one(spark, strip_tags(F.col("s")), " <span> 1012.<b>5</b> </span>&nbsp;") == "1012.5"
    assert one(spark, strip_tags(F.col("s")), "a &amp;lt; b<!-- c -->") == "a &lt; b"


def test_package_is_shipped_once_per_application(tmp_path):
    import subprocess
    import sys
    from types import SimpleNamespace

    from hydrocal.session import ship_package

    sent = []
    sc = SimpleNamespace(applicationId="app-x", master="yarn", addPyFile=sent.append)
    for _ in range(2):
        ship_package(SimpleNamespace(sparkContext=sc))
    ship_package(SimpleNamespace(sparkContext=SimpleNamespace(applicationId="app-y", master="local[8]", addPyFile=sent.append)))
    assert len(sent) == 1
    code = f"import sys; sys.path.insert(0, {sent[0]!r}); import hydrocal.sources.csv_text as m; print(m.__file__)"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert sent[0] in out.stdout
