"""Invariants on generated inputs."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hydrocal.operators.barometer import attach_baro
from hydrocal.operators.clean import tag_stages
from hydrocal.operators.dedup import first_per_site_day
from hydrocal.plans.validate import file_day_summary, file_outcomes

BASE = dt.datetime(2026, 3, 1)
READ = "site string, ts timestamp_ntz, level_ft double, baro_hpa double, comment string, src_file string"
SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

reading = st.tuples(
    st.sampled_from(["A", "B", "C"]),
    st.integers(min_value=0, max_value=4 * 24 * 60),  # minutes after BASE
    st.floats(min_value=-5, max_value=50, allow_nan=False).map(lambda x: round(x, 2)),
    st.sampled_from(["a.csv", "b.csv"]),
)


def to_rows(items):
    return [(s, BASE + dt.timedelta(minutes=m), lv, 1000.0, "", f) for s, m, lv, f in items]


@SETTINGS
@given(st.lists(reading, min_size=1, max_size=40))
def test_keep_first_is_unique_subset_and_earliest(spark, items):
    data = to_rows(items)
    out = [tuple(r) for r in first_per_site_day(spark.createDataFrame(data, READ)).collect()]
    keys = [(r[0], r[1].date()) for r in out]
    assert len(keys) == len(set(keys))
    assert set(keys) == {(r[0], r[1].date()) for r in data}
    assert all(r in data for r in out)
    for r in out:
        assert r[1] == min(d[1] for d in data if d[0] == r[0] and d[1].date() == r[1].date())


@SETTINGS
@given(st.lists(reading, min_size=1, max_size=40), st.lists(st.integers(0, 5), max_size=6))
def test_barometer_join_preserves_rows(spark, items, days):
    daily = spark.createDataFrame(to_rows(items), READ)
    baro = spark.createDataFrame([(BASE.date() + dt.timedelta(days=d), 1000.0 + d) for d in set(days)], "day date, bom_hpa double")
    assert attach_baro(daily, baro).count() == daily.count()


text = st.one_of(st.just("01/03/2026"), st.just("31/02/2026"), st.just("1/3/26"), st.none())
num = st.one_of(st.just("1.5"), st.just("-2"), st.just("abc"), st.just(""), st.none(), st.just("1e3"))


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["x.csv", "y.csv"]), text, num, num), min_size=1, max_size=30))
def test_stage_counts_cover_every_row(spark, items):
    raw = spark.createDataFrame(
        [(None, d, "08:00:00", lv, b, None, f) for f, d, lv, b in items],
        "site string, date_text string, time_text string, level_text string, baro_text string, comment string, src_file string",
    ).withColumn("site", F.col("src_file"))
    outcomes = {r.src_file: r for r in file_outcomes(file_day_summary(tag_stages(raw))).collect()}
    for f in {i[0] for i in items}:
        o = outcomes[f]
        n = sum(1 for i in items if i[0] == f)
        assert o.n_bad_datetime + o.n_bad_numeric + o.n_negative + o.n_kept == n
        assert (o.reason is None) == (o.n_kept > 0)
