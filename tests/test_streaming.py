import datetime as dt

from conftest import rows
from hydrocal.streaming.daily import run_first_per_site_day

T = dt.datetime
SCHEMA = "site string, ts timestamp_ntz, level_ft double, baro_hpa double, comment string, src_file string"


def test_stream_keep_first_over_several_batches(spark, tmp_path):
    src = tmp_path / "in"
    batches = [
        [("A", T(2026, 3, 1, 12), 2.0, 1000.0, "", "A.csv"), ("B", T(2026, 3, 1, 9), 5.0, 1000.0, "", "B.csv")],
        # late but within a day of lateness: becomes A's first reading of 1 March
        [("A", T(2026, 3, 1, 6), 1.0, 1000.0, "", "A.csv"), ("A", T(2026, 3, 4, 6), 3.0, 1000.0, "", "A.csv")],
        # weeks late: kept, whatever came before
        [("B", T(2026, 2, 1, 6), 9.0, 1000.0, "", "B.csv"), ("B", T(2026, 3, 5, 6), 4.0, 1000.0, "", "B.csv")],
    ]
    for i, b in enumerate(batches):
        spark.createDataFrame(b, SCHEMA).coalesce(1).write.parquet(str(src / f"part{i}"))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(src))
    baro = spark.createDataFrame([(dt.date(2026, 3, 1), 1001.0)], "day date, bom_hpa double")
    out = run_first_per_site_day(spark, stream, work_dir=str(tmp_path / "work"), daily_baro=baro)
    assert rows(out.where("bom_hpa IS NOT NULL"), "site") == [("A",), ("B",)]
    assert rows(out, "site", "ts", "level_ft") == [
        ("A", T(2026, 3, 1, 6), 1.0),
        ("A", T(2026, 3, 4, 6), 3.0),
        ("B", T(2026, 2, 1, 6), 9.0),
        ("B", T(2026, 3, 1, 9), 5.0),
        ("B", T(2026, 3, 5, 6), 4.0),
    ]


def test_stream_reads_a_table_that_is_a_folder(spark, tmp_path):
    """Part files in a folder give the same rows as one file, in any order and number of batches."""
    from hydrocal.operators.dedup import first_per_site_day
    from hydrocal.sources import standins as S

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(4).write.parquet(str(tmp_path / "events.parquet"))
    out = run_first_per_site_day(spark, S.logger_readings_stream(spark, str(tmp_path)))
    batch = first_per_site_day(S.logger_readings(spark, str(tmp_path)))
    cols = ["site", "ts", "level_ft", "baro_hpa"]
    assert rows(out, *cols) == rows(batch, *cols) and out.count() > 300


def _batches(n=9):
    import random

    rng = random.Random(3)
    day = lambda: T(2026, 3, rng.randint(1, 5), rng.randint(0, 3))
    value = lambda x: None if rng.random() < 0.3 else x
    row = lambda: (value(rng.choice("AB")), value(day()), value(rng.choice([1.0, 2.0])), value(rng.choice([900.0, 901.0])), value("x"), value("A.csv"))
    return [[row() for _ in range(40)] for _ in range(n)]


def _batch_answer(spark, batches):
    from hydrocal.operators.dedup import first_per_site_day

    df = spark.createDataFrame([r for b in batches for r in b], SCHEMA)
    return rows(first_per_site_day(df), "site", "ts", "level_ft", "baro_hpa", "comment", "src_file")


def _settled(log):
    return rows(log.settled(), "site", "ts", "level_ft", "baro_hpa", "comment", "src_file")


def test_nulls_are_last_as_in_the_batch(spark):
    from hydrocal.streaming.daily import firsts_of, flatten_firsts

    same = [("A", T(2026, 3, 1, 6), 1.0, p, "", "A.csv") for p in (None, 900.0)]
    got = flatten_firsts(firsts_of(spark.createDataFrame(same, SCHEMA))).first()
    assert got.baro_hpa == 900.0


def test_snapshots_replays_and_crashes_equal_the_batch(spark, tmp_path, monkeypatch):
    import pytest

    from hydrocal.streaming import daily

    batches = _batches()
    log = daily.FirstsLog(spark, str(tmp_path / "log"))
    assert _settled(log) == []
    for i, b in enumerate(batches):
        if i in (3, 5):
            log.compact(i)
        if i == 6:  # stopped after the snapshot, before the marker
            with monkeypatch.context() as m:
                m.setattr(daily.FirstsLog, "mark", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
                with pytest.raises(RuntimeError, match="killed"):
                    log.compact(i)
            assert log.committed() == (1, 4) and _settled(log) == _batch_answer(spark, batches[:i])
        if i == 7:  # a marker that was not written to its end does not count; the merge is done again
            (tmp_path / "log" / "marker" / "2").write_text('{"version": 2, "up')
            assert log.committed() == (1, 4) and _settled(log) == _batch_answer(spark, batches[:i])
            log.compact(i)
            assert log.committed() == (2, 6)
        df = spark.createDataFrame(b, SCHEMA)
        log.write_segment(df, i)
        if i % 2:
            log.write_segment(df, i)  # a replay
        assert _settled(log) == _batch_answer(spark, batches[: i + 1]), i
    # what the snapshot holds is not read from the log again, and old segments go
    read = {f.rsplit("/", 2)[1] for f in log.settled().inputFiles() if "/log/log/" in f}
    assert read == {"7", "8"} and log.segments(-1) == [5, 6, 7, 8]
    # days that no new segment touches keep their version
    late = spark.createDataFrame([("Z", T(2026, 3, 9, 1), 1.0, 1.0, "", "")], SCHEMA)
    log.compact(9)
    log.write_segment(late, 9)
    log.compact(10)
    versions = {r.day: r.version for r in log._manifest(log.committed()[0]).collect()}
    assert versions[dt.date(2026, 3, 9)] == 4 and versions[dt.date(2026, 3, 1)] == 3
    assert _settled(log) == sorted(_batch_answer(spark, [*batches, [("Z", T(2026, 3, 9, 1), 1.0, 1.0, "", "")]]), key=lambda t: tuple((v is not None, v) for v in t))


def test_stream_compacts_on_its_way_and_resumes(spark, tmp_path):
    from hydrocal.streaming import daily

    batches, src, work = _batches(7), tmp_path / "in", str(tmp_path / "work")

    def feed(part):
        for i, b in part:
            spark.createDataFrame(b, SCHEMA).coalesce(1).write.parquet(str(src / f"part{i}"))
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(src))
        return run_first_per_site_day(spark, stream, work_dir=work, compact_every=2)

    cols = ["site", "ts", "level_ft", "baro_hpa", "comment", "src_file"]
    assert rows(feed(list(enumerate(batches))[:4]), *cols) == _batch_answer(spark, batches[:4])
    assert rows(feed(list(enumerate(batches))[4:]), *cols) == _batch_answer(spark, batches)
    assert daily.FirstsLog(spark, work).committed()[0] >= 2
