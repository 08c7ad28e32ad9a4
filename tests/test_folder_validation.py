"""End-to-end: a landing folder of exports -> validation -> reports (FIXTURES.md cases)."""

import csv
import datetime as dt
import glob

import pytest

from conftest import rows
from hydrocal.plans.validate import validate
from hydrocal.schemas import (
    DRY_COMMENT,
    MAIN_REPORT_COLUMNS,
    SRC_BARO,
    SRC_LEVEL,
    UPLOAD_REPORT_COLUMNS,
)
from hydrocal.sinks.reports import report_main, report_upload, write_reports
from hydrocal.sources.csv_folder import read_pairs, read_site_folder
from hydrocal.sources.site_config import site_config

T = dt.datetime
HDR = f"Date,Time,{SRC_LEVEL},{SRC_BARO}\n"
RUN = T(2026, 3, 28, 17, 0, 0)


def write(path, text):
    path.write_text(text)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("landing")
    write(d / "A.csv", HDR + "01/03/2026,12:00:00,11,1010\n01/03/2026,00:10:00,10,1010\n02/03/2026,08:00:00,-0.1,1010\n"
          "03/03/2026,08:00:00,0,1000\n04/03/2026,08:00:00,abc,1000\n31/02/2026,08:00:00,5,1000\n")
    write(d / "B.csv", f"Time,{SRC_BARO},extra,Date,{SRC_LEVEL}\n08:00:00,1000,q,05/03/2026,250\n")
    write(d / "C.csv", f"Date,Time,{SRC_LEVEL}\n05/03/2026,08:00:00,1\n")
    write(d / "D.csv", HDR)
    write(d / "E.csv", "")
    write(d / "baroA.csv", f"Date,Time,{SRC_BARO}\n01/03/2026,00:10:00,1000\n")
    write(d / "F.CSV", HDR + "06/03/2026,08:00:00,10,1010\n")
    write(d / "G.csv", HDR + "31/02/2026,08:00:00,1,1000\n1/2/26 08:00:00,x,1,1000\n")
    write(d / "H.csv", HDR + "06/03/2026,08:00:00,NaN,1000\n06/03/2026,09:00:00,1.5d,1000\n")
    write(d / "I.csv", HDR + "06/03/2026,08:00:00,-1,1000\n")
    write(d / "J.csv", HDR + "06/03/2026,08:00:00,1,1000,surplus\n07/03/2026,08:00:00,1,1000\n")
    write(d / "notes.txt", "ignored\n")
    return str(d)


@pytest.fixture(scope="module")
def result(spark, folder):
    cfg = site_config(
        spark,
        '{"A": {"depth_conversion_type": "default"}, "B": {"depth_conversion_type": "divide_by_100"},'
        ' "F": {"depth_conversion_type": "metres"}, "K": {"depth_conversion_type": "default"}}',
    )
    weather = spark.createDataFrame(
        [("01/03/2026", "12:00:00", "1000.0"), ("05/03/2026", "18:00:00", "1001.0"), ("28/03/2026", "12:00:00", "990")],
        "date_text string, time_text string, hpa_text string",
    )
    inp = read_site_folder(spark, folder)
    return inp, validate(inp.raw, RUN, weather=weather, site_cfg=cfg, files=inp.files)


def test_listing_status(result):
    inp, _ = result
    st = {r.site: r.status for r in inp.files.collect()}
    assert st == {"A": "ok", "B": "ok", "C": "rejected", "D": "ok", "E": "zero_bytes", "F": "ok", "G": "ok",
                  "H": "ok", "I": "ok", "J": "ok"}


def test_final_rows(result):
    _, v = result
    got = {(r.site, r.ts): r for r in v.final.collect()}
    on = " on 28/03/2026 17:00:00"
    run_day = T(2026, 3, 28)
    # A: 00:10 kept over 12:00; external 1000 joined; bad rows dropped; level 0 flagged dry
    a1 = got[("A", T(2026, 3, 1, 0, 10))]
    assert (a1.depth_raw_m, a1.bom_hpa, a1.depth_adj_m, a1.comment) == (3.05, 1000.0, 3.15, "")
    a3 = got[("A", T(2026, 3, 3, 8))]
    assert (a3.depth_raw_m, a3.comment, a3.flag) == (0.0, DRY_COMMENT, "dry")
    assert ("A", T(2026, 3, 2, 8)) not in got  # negative level dropped
    # B: reordered header read by name, divide_by_100, PM value used for the day
    b = got[("B", T(2026, 3, 5, 8))]
    assert (b.depth_raw_m, b.baro_hpa, b.bom_hpa) == (2.5, 1000.0, 1001.0)
    # F: upper-case extension and unknown conversion type -> feet
    assert got[("F", T(2026, 3, 6, 8))].depth_raw_m == 3.05
    # placeholders with their reasons; the run day has an external value (Q9)
    assert got[("D", run_day)].comment == "CSV file was empty" + on
    assert got[("E", run_day)].comment == "Empty file" + on
    assert got[("G", run_day)].comment == "No valid Date/Time entries found" + on
    assert got[("H", run_day)].comment == "No valid numeric data found" + on
    assert got[("I", run_day)].comment == f"No data found with {SRC_LEVEL} >= 0" + on
    assert got[("K", run_day)].comment == "Site CSV file not found" + on
    assert got[("K", run_day)].bom_hpa == 990.0 and got[("K", run_day)].depth_adj_m is None
    # rejected files vanish without placeholder: C (missing column), J (malformed row)
    assert not [k for k in got if k[0] in ("C", "J", "baroA")]
    assert len(got) == v.final.count()


def test_rejected_files_and_status(result):
    from hydrocal.operators.quality import site_status

    _, v = result
    assert sorted(r.site for r in v.rejected_files.collect()) == ["C", "J"]
    st = {r.site: r.status for r in site_status(v.final, v.rejected_files).collect()}
    assert st["C"] == st["J"] == "failed"
    assert st["A"] == "flagged" and st["B"] == "data" and st["K"] == "flagged"


def test_quality_table(result):
    _, v = result
    q = {r.site: r for r in v.quality.collect()}
    assert (q["A"].n_bad_datetime, q["A"].n_bad_numeric, q["A"].n_negative, q["A"].n_kept) == (1, 1, 1, 3)
    assert q["F"].unknown_conversion and not q["A"].unknown_conversion
    assert (q["G"].n_bad_datetime, q["G"].n_kept) == (2, 0)


def test_reports(spark, result, tmp_path):
    _, v = result
    main = report_main(v.final)
    up = report_upload(v.final)
    assert main.columns == MAIN_REPORT_COLUMNS
    assert up.columns == UPLOAD_REPORT_COLUMNS
    assert main.count() == v.final.count()
    assert up.count() == v.final.where("depth_adj_m IS NOT NULL").count()
    assert rows(up, "Sample Point", "Date Time (dd/mm/yyyy hh24:mi:ss)", "LEVEL - DEPTH TO WATER - m (INPUT)") == [
        ("A", "01/03/2026 12:10:00 AM", 3.15),
        ("B", "05/03/2026 08:00:00 AM", 2.49),
    ]
    out = str(tmp_path / "out")
    write_reports(v.final, out, single_file=True)
    [main_csv] = glob.glob(f"{out}/main_report/*.csv")
    with open(main_csv) as fh:
        lines = list(csv.reader(fh))
    assert lines[0] == MAIN_REPORT_COLUMNS
    assert len(lines) - 1 == v.final.count()
    sites = [r[0] for r in lines[1:]]
    assert sites == sorted(sites)
    assert ["A", "01/03/2026 12:10:00 AM", "1000.0", "1010.0", "3.05", "3.15", ""] in lines


def test_upload_written_even_when_empty(spark, tmp_path):
    raw = spark.createDataFrame([], "site string, date_text string, time_text string, level_text string, "
                                "baro_text string, comment string, src_file string")
    v = validate(raw, RUN, expected_sites=spark.createDataFrame([("K",)], "site string"))
    out = str(tmp_path / "o")
    write_reports(v.final, out, single_file=True)
    [up] = glob.glob(f"{out}/upload_report/*.csv")
    assert open(up).read().splitlines() == [",".join(UPLOAD_REPORT_COLUMNS)]


def test_nothing_consolidated_writes_nothing(spark, tmp_path):
    raw = spark.createDataFrame([], "site string, date_text string, time_text string, level_text string, "
                                "baro_text string, comment string, src_file string")
    v = validate(raw, RUN)
    out = str(tmp_path / "none")
    assert write_reports(v.final, out) is False
    assert glob.glob(f"{out}/*") == []


def test_type_guard(spark):
    bad = spark.createDataFrame([(1,)], "date_text int")
    with pytest.raises(TypeError):
        validate(bad, RUN)
    with pytest.raises(ValueError):
        validate(bad.withColumnRenamed("date_text", "other"), RUN)


def test_read_pairs_merges_level_and_baro(spark, tmp_path):
    d = tmp_path / "pairs"
    d.mkdir()
    write(d / "S1.csv", f"Date,Time,{SRC_LEVEL}\n01/03/2026,00:00:00,10\n01/03/2026,01:00:00,11\n")
    write(d / "baroS1.csv", f"Date,Time,{SRC_BARO}\n01/03/2026,00:00:00,1010\n01/03/2026,00:00:00,1012\n")
    write(d / "S2.csv", f"Date,Time,{SRC_LEVEL}\n01/03/2026,00:00:00,10\n")
    write(d / "S3.csv", f"Date,Time,{SRC_LEVEL},{SRC_BARO}\n01/03/2026,00:00:00,10,999\n")
    write(d / "baroS3.csv", f"Date,Time,{SRC_BARO}\n01/03/2026,00:00:00,1005\n")
    manifest = spark.createDataFrame(
        [("S1", "S1.csv", "baroS1.csv"), ("S2", "S2.csv", "baroS2.csv"), ("S3", "S3.csv", "baroS3.csv")],
        "name string, main_csv string, baro_csv string",
    )
    inp = read_pairs(spark, str(d), manifest)
    st = {r.site: r.status for r in inp.files.collect()}
    assert st == {"S1": "ok", "S2": "rejected", "S3": "ok"}
    got = sorted((r.level_text, r.baro_text) for r in inp.raw.collect())
    assert got == [("10", "1005"), ("10", "1010"), ("11", None)]


def test_same_stem_files_feed_one_site(spark, tmp_path):
    d = tmp_path / "stems"
    d.mkdir()
    write(d / "A.csv", HDR + "01/03/2026,09:00:00,10,1010\n02/03/2026,09:00:00,10,1010\n")
    write(d / "A.CSV", f"Date,Time,{SRC_LEVEL},{SRC_BARO},{'OTHER - Comments - Text'}\n"
          '01/03/2026,08:00:00,20,1010,"checked, ok"\n')
    inp = read_site_folder(spark, str(d))
    v = validate(inp.raw, RUN, files=inp.files)
    got = sorted((r.site, r.ts, r.level_ft, r.comment) for r in v.final.collect())
    assert got == [("A", T(2026, 3, 1, 8), 20.0, "checked, ok"), ("A", T(2026, 3, 2, 9), 10.0, "")]


def test_file_names_with_special_characters(spark, tmp_path):
    d = tmp_path / "names"
    d.mkdir()
    write(d / "Site 1.csv", HDR + "01/03/2026,08:00:00,10,1010\n")
    write(d / "B#%+.csv", HDR + "01/03/2026,08:00:00,10,1010\n")
    write(d / "E mpty.csv", "")
    inp = read_site_folder(spark, str(d))
    assert {r.site: r.status for r in inp.files.collect()} == {"Site 1": "ok", "B#%+": "ok", "E mpty": "zero_bytes"}
    v = validate(inp.raw, RUN, files=inp.files)
    assert sorted(r.site for r in v.final.collect()) == ["B#%+", "E mpty", "Site 1"]


def test_folder_reader_on_odd_files(spark, tmp_path):
    """Blank first lines, doubled quotes, a header-only file that lacks a column, surplus fields next to
    an unused column, a quoted section over two lines and one that nothing closes."""
    from hydrocal.schemas import SRC_BARO, SRC_COMMENT, SRC_DATE, SRC_LEVEL, SRC_TIME

    head = [SRC_DATE, SRC_TIME, SRC_LEVEL, SRC_BARO, SRC_COMMENT]
    line = ",".join(f'"{h}"' for h in head)
    row = '01/02/2026,10:00:00,1.5,1000,'
    files = {
        "blank.csv": f"\n\n{line}\n{row}ok\n",
        "quotes.csv": f'{line}\n{row}"say ""hi"", there"\n',
        "back.csv": f'{line}\n{row}"a\\b"\n',
        "bare.csv": f"{SRC_DATE},{SRC_TIME}\n",
        "lacks.csv": f"{SRC_DATE},{SRC_TIME}\n01/02/2026,10:00:00\n",
        "surplus.csv": f"{line},Temp\n{row}x,9\n{row}x,9,9\n",
        "lines.csv": f'{line}\n{row}"two\nlines"\n',
        "open.csv": f'{line}\n{row}"two\nlines\n',
        "only_blank.csv": "\n\n",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    inp = read_site_folder(spark, str(tmp_path))
    status = {r.site: r.status for r in inp.files.collect()}
    assert status == {"blank": "ok", "quotes": "ok", "back": "ok", "bare": "ok", "lacks": "rejected", "surplus": "ok", "open": "ok", "lines": "ok", "only_blank": "zero_bytes"}
    raw = {}
    for r in inp.raw.collect():
        raw.setdefault(r.src_file.rsplit("/", 1)[-1], []).append((r.comment, r.malformed))
    assert raw["blank.csv"] == [("ok", False)]
    assert raw["quotes.csv"] == [('say "hi", there', False)]
    assert raw["lines.csv"] == [("two\nlines", False)]
    assert raw["back.csv"] == [("a\\b", False)]
    assert any(m for _, m in raw["surplus.csv"]) and any(m for _, m in raw["open.csv"])


def test_report_files_read_back(spark, tmp_path):
    import csv
    import glob

    from hydrocal.sinks.reports import write_csv

    values = ['say "hi", there', " lead ", "a\\b", "", "x"]
    write_csv(spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string"), f"{tmp_path}/r", single_file=True)
    [path] = glob.glob(f"{tmp_path}/r/*.csv")
    with open(path, newline="") as fh:
        got = list(csv.reader(fh))
    assert got[0] == ["i", "v"] and [v for _, v in got[1:]] == values
