import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from hydrocal.operators.barometer import attach_baro, daily_barometer, unpivot_ampm
from hydrocal.operators.dedup import first_per_site_day
from hydrocal.operators.depth import adjust_depth, convert_depth, flag_dry
from hydrocal.operators.gaps import missing_site_placeholders, replace_stale
from hydrocal.operators.merge import merge_level_baro, union_by_name, unique_baro
from hydrocal.schemas import DRY_COMMENT
from hydrocal.sources.site_config import manifest_from_json, site_config

T = dt.datetime
READ = "site string, ts timestamp_ntz, level_ft double, baro_hpa double, comment string, src_file string"


def test_first_per_site_day_keeps_earliest(spark):
    df = spark.createDataFrame(
        [
            ("A", T(2026, 2, 1, 12, 0), 2.0, 1000.0, "", "A.csv"),
            ("A", T(2026, 2, 1, 0, 10), 1.0, 1000.0, "", "A.csv"),
            ("A", T(2026, 2, 2, 0, 0), 3.0, 1000.0, "", "A.csv"),
            ("B", T(2026, 2, 1, 5, 0), 9.0, 1000.0, "", "B.csv"),
        ],
        READ,
    )
    out = first_per_site_day(df)
    assert rows(out, "site", "ts", "level_ft") == [
        ("A", T(2026, 2, 1, 0, 10), 1.0),
        ("A", T(2026, 2, 2, 0, 0), 3.0),
        ("B", T(2026, 2, 1, 5, 0), 9.0),
    ]
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_same_site_ts_tie_break_is_deterministic(spark):
    df = spark.createDataFrame(
        [("A", T(2026, 2, 1, 1), 5.0, 1000.0, "", "b.csv"), ("A", T(2026, 2, 1, 1), 7.0, 990.0, "", "a.csv")], READ
    )
    assert rows(first_per_site_day(df), "src_file", "level_ft") == [("a.csv", 7.0)]


def test_daily_barometer_prefers_morning_and_drops_bad(spark):
    w = spark.createDataFrame(
        [
            ("01/04/2026", "12:00:00", "1013.2"),
            ("01/04/2026", "18:00:00", "1011.0"),
            ("02/04/2026", "18:00:00", "1009.5"),
            ("31/04/2026", "12:00:00", "1000.0"),
            ("03/04/2026", "12:00:00", "abc"),
        ],
        "date_text string, time_text string, hpa_text string",
    )
    assert rows(daily_barometer(w), "day", "bom_hpa") == [
        (dt.date(2026, 4, 1), 1013.2),
        (dt.date(2026, 4, 2), 1009.5),
    ]


def test_attach_baro_keeps_rows_and_broadcasts(spark):
    daily = spark.createDataFrame(
        [("A", T(2026, 4, 1, 9), 1.0, 1000.0, "", "A.csv"), ("A", T(2026, 4, 5, 9), 1.0, 1000.0, "", "A.csv")], READ
    )
    baro = spark.createDataFrame([(dt.date(2026, 4, 1), 1005.0)], "day date, bom_hpa double")
    out = attach_baro(daily, baro)
    assert rows(out, "ts", "bom_hpa") == [(T(2026, 4, 1, 9), 1005.0), (T(2026, 4, 5, 9), None)]
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()
    empty = spark.createDataFrame([], "day date, bom_hpa double")
    assert rows(attach_baro(daily, empty), "bom_hpa") == [(None,), (None,)]


def test_convert_depth_lookup_with_default(spark):
    daily = spark.createDataFrame(
        [("A", T(2026, 4, 1), 10.0, 1.0, "", "A.csv"), ("B", T(2026, 4, 1), 250.0, 1.0, "", "B.csv"),
         ("C", T(2026, 4, 1), 10.0, 1.0, "", "C.csv")],
        READ,
    )
    cfg = site_config(spark, '{"B": {"depth_conversion_type": "divide_by_100"}, "C": {"depth_conversion_type": "metres"}}')
    out = convert_depth(daily, cfg)
    assert rows(out, "site", "depth_raw_m", "unknown_conversion") == [("A", 3.05, False), ("B", 2.5, False), ("C", 3.05, True)]


def test_convert_depth_duplicate_config_entries_do_not_fan_out(spark):
    daily = spark.createDataFrame([("B", T(2026, 4, 1), 250.0, 1.0, "", "B.csv")], READ)
    cfg = spark.createDataFrame([("B", "divide_by_100"), ("B", "default")], "site string, depth_conversion_type string")
    out = convert_depth(daily, cfg)
    assert rows(out, "site", "conversion_type", "depth_raw_m") == [("B", "divide_by_100", 2.5)]


def test_site_config_bad_documents(spark):
    assert site_config(spark, "{bad").count() == 0
    assert site_config(spark, "[1, 2]").count() == 0
    cfg = site_config(spark, '{"A": "text", "B": {"depth_conversion_type": "divide_by_100"}, "C": {}}')
    assert rows(cfg, "site", "depth_conversion_type") == [("A", "default"), ("B", "divide_by_100"), ("C", "default")]


def test_manifest_from_json(spark):
    doc = spark.createDataFrame([('[{"name": "S1", "nav_option": "x", "main_csv": "S1.csv", "baro_csv": "baroS1.csv"}]',)], "d string")
    assert rows(manifest_from_json(doc, "d"), "name", "main_csv", "baro_csv") == [("S1", "S1.csv", "baroS1.csv")]


def test_missing_sites_placeholder_text(spark):
    exp = spark.createDataFrame([("A",), ("K",)], "site string")
    seen = spark.createDataFrame([("A",)], "site string")
    for run, text in [(T(2026, 12, 5, 8, 30), "05/12/2026 08:30:00"), (T(2026, 12, 28, 17, 0), "28/12/2026 17:00:00")]:
        out = missing_site_placeholders(exp, seen, run)
        got = out.collect()
        assert len(got) == 1 and got[0].site == "K"
        assert got[0].ts == dt.datetime(run.year, run.month, run.day)
        assert got[0].comment == f"Site CSV file not found on {text}"


def test_replace_stale_boundary(spark):
    run = T(2026, 4, 30, 10, 0, 0)
    df = spark.createDataFrame(
        [
            ("A", T(2026, 2, 28, 10, 0, 0), 1.0, 1.0, "", "A.csv", None),
            ("B", T(2026, 2, 28, 9, 59, 59), 1.0, 1.0, "", "B.csv", None),
            ("B", T(2026, 2, 27, 9, 0, 0), 1.0, 1.0, "", "B.csv", None),
            ("C", T(2026, 1, 1), 1.0, 1.0, "Placeholder: kept", "C.csv", None),
        ],
        READ + ", flag string",
    )
    out = replace_stale(df, run)
    got = rows(out, "site", "ts", "comment", "flag", "level_ft")
    assert got == [
        ("A", T(2026, 2, 28, 10, 0, 0), "", None, 1.0),
        ("B", T(2026, 4, 30), "No telemetry data received for April 2026 on 30/04/2026 10:00:00", "placeholder", None),
        ("C", T(2026, 1, 1), "Placeholder: kept", None, 1.0),
    ]


def test_flag_dry_and_adjust_with_densities(spark):
    df = spark.createDataFrame(
        [("A", T(2026, 4, 1), 0.0, 1010.0, "", "A.csv", 1000.0), ("B", T(2026, 4, 1), 0.01, 1010.0, "x", "B.csv", 1000.0),
         ("C", T(2026, 4, 1), 10.0, 1010.0, "", "C.csv", 1000.0)],
        READ + ", bom_hpa double",
    ).withColumn("flag", F.lit(None).cast("string"))
    d = flag_dry(convert_depth(df))
    assert rows(d, "site", "comment", "flag") == [("A", DRY_COMMENT, "dry"), ("B", "x", None), ("C", "", None)]
    sea = adjust_depth(d, water_density=1025.0)
    assert rows(sea.where("site = 'C'"), "depth_adj_m") == [(round(3.05 + 0.70307 * (10 * 0.0145038) / 1.025, 2),)]
    assert rows(adjust_depth(d, reference_density=0.0), "depth_adj_m") == [(None,)] * 3
    assert rows(adjust_depth(d, water_density=-1.0), "depth_adj_m") == [(None,)] * 3


def test_merge_level_baro_cases(spark):
    level = spark.createDataFrame(
        [("S", "01/02/2026", "00:00:00", "1", "999", None, "S.csv"), ("S", "01/02/2026", "01:00:00", "2", None, None, "S.csv"),
         ("S", None, None, "3", None, None, "S.csv")],
        "site string, date_text string, time_text string, level_text string, baro_text string, comment string, src_file string",
    )
    baro = spark.createDataFrame(
        [("S", "01/02/2026", "00:00:00", "1010.5"), ("S", "01/02/2026", "00:00:00", "1009.0"), ("S", None, None, "1000.0")],
        "site string, date_text string, time_text string, baro_text string",
    )
    out = merge_level_baro(level, baro)  # duplicate barometer keys fan out
    assert rows(out, "level_text", "baro_text") == [("1", "1009.0"), ("1", "1010.5"), ("2", None), ("3", "1000.0")]
    out = merge_level_baro(level, unique_baro(baro))
    assert rows(out, "level_text", "baro_text") == [("1", "1009.0"), ("2", None), ("3", "1000.0")]


def test_union_by_name_fills_missing(spark):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([(2, 2.5)], "k int, b double")
    assert rows(union_by_name(a, b), "k", "a", "b") == [(1, "x", None), (2, None, 2.5)]


def test_unpivot_ampm_rules(spark):
    cells = lambda d, am, pm, n=22: [d] + [""] * 14 + [am] + [""] * 5 + [pm] if n == 22 else ([d] + [""] * 14 + [am])[:n]
    df = spark.createDataFrame(
        [(1, cells("1", "1013.2", "1011.0")), (2, cells("Mean", "1", "1")), (3, cells("2", "0", "abc")),
         (4, cells("3", "1012.0", "x", 16)), (5, cells("4", "", "1008.5")), (6, cells("²", "1000", "1000"))],
        "id int, cells array<string>",
    )
    out = unpivot_ampm(df, 4, 2026, keys=["id"])
    assert rows(out, "id", "date_text", "time_text", "hpa_text") == [
        (1, "01/04/2026", "12:00:00", "1013.2"),
        (1, "01/04/2026", "18:00:00", "1011.0"),
        (4, "03/04/2026", "12:00:00", "1012.0"),
        (5, "04/04/2026", "18:00:00", "1008.5"),
    ]


def test_checked_join_falls_back_above_limit(spark):
    from hydrocal.operators.joins import checked_join, fits_broadcast, fits_broadcast_all

    left = spark.createDataFrame([("A", 1), ("B", 2)], "site string, v int")
    right = spark.createDataFrame([("A", "x"), ("B", "y")], "site string, t string")
    assert fits_broadcast(right, 1000) and not fits_broadcast(right, 100)
    assert fits_broadcast_all([right, left.limit(1), left.limit(0)], 100) == [False, True, True]
    long_text = spark.createDataFrame([("A", "x" * 2000)], "site string, t string")
    assert not fits_broadcast(long_text, 1000)  # one row, but its text counts
    plan = checked_join(left, right, "site", "left", max_bytes=100)._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" not in plan
    plan = checked_join(left, right, "site", "left", max_bytes=1000)._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_skew_join_equals_the_plain_join_and_spreads_heavy_keys(spark):
    """A third of the left rows share NULL keys, another key holds a sixth: no task gets the most of them."""
    from hydrocal.operators.joins import heavy_hitters, skew_join

    n = 60_000
    i = F.col("id")
    key = F.when(i % 3 == 0, F.lit(None)).when(i % 6 == 1, F.lit("hot")).otherwise((i % 5000).cast("string"))
    left = spark.range(n).select(i, key.alias("site"), F.when(i % 3 != 0, "d").alias("date_text"))
    right = spark.createDataFrame([(None, None, 1), (None, None, 2), ("hot", "d", 3), ("17", "d", 4), ("x", "d", 5), (None, "d", 6)], "site string, date_text string, v int")
    keys = ["site", "date_text"]
    assert len(heavy_hitters(left, keys, 1000)) == 2 and heavy_hitters(left, keys, n) == {}
    plain = left.join(right.select(F.col("site").alias("s"), F.col("date_text").alias("d"), "v"), F.col("site").eqNullSafe(F.col("s")) & F.col("date_text").eqNullSafe(F.col("d")), "left").select("id", "v")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # nothing else may deal rows anew
    try:
        shares = {}
        for rows_a_task in (1000, 10 * n):
            out = skew_join(left, right, keys, rows_a_task).withColumn("task", F.spark_partition_id())
            assert sorted(map(tuple, out.select("id", "v").na.fill(-1).collect())) == sorted(map(tuple, plain.na.fill(-1).collect()))
            counts = [r["count"] for r in out.groupBy("task").count().collect()]
            shares[rows_a_task] = max(counts) / sum(counts)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert shares[1000] < 0.25 < 0.4 < shares[10 * n]
    assert out.columns == ["id", "site", "date_text", "v", "task"]
