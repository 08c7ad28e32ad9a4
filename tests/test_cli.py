import glob
import json
import os

from hydrocal.__main__ import main
from hydrocal.schemas import SRC_BARO, SRC_LEVEL
from hydrocal.sinks.publish import Publication, commits, current

HDR = f"Date,Time,{SRC_LEVEL},{SRC_BARO}\n"


def page_row(day, am, pm):
    cells = [day] + ["x"] * 14 + [am] + ["y"] * 5 + [pm]
    return "<tr>" + "".join(f"<td>{c}</td>" for c in cells) + "</tr>"


def test_cli_validate(spark, tmp_path, capsys):
    land = tmp_path / "landing"
    land.mkdir()
    (land / "A.csv").write_text(HDR + "01/03/2026,00:10:00,10,1010\n02/03/2026,00:10:00,12,1010\n")
    (land / "B.csv").write_text(HDR)
    cfg = tmp_path / "cfg.json"
    cfg.write_text(json.dumps({"A": {"depth_conversion_type": "default"}, "K": {}}))
    html = "<table class='data'><tbody>" + page_row("1", "1000.0", "1001.0") + page_row("2", "", "1002.0") + "</tbody></table>"
    pages = str(tmp_path / "pages")
    spark.createDataFrame([(1, html)], "page_id int, html string").write.parquet(pages)
    out = str(tmp_path / "out")
    rc = main(["validate", "--input", str(land), "--out", out, "--run-ts", "2026-03-28 17:00:00",
               "--config", str(cfg), "--pages", pages, "--single-file"])
    assert rc == 0
    summary = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert summary == {"n_sites": 3, "n_data_sites": 1, "n_flagged_sites": 2, "n_failed_sites": 0,
                       "n_rows": 4, "n_with_bom": 2, "n_dry": 0, "n_adjusted": 2, "n_placeholders": 2}
    out = current(spark, out)
    [up] = glob.glob(f"{out}/upload_report/*.csv")
    lines = open(up).read().splitlines()
    # 12 ft -> 3.66 m; PM value 1002 used for 2 March: 3.66 + 0.70307 * (8 * 0.0145038) = 3.7416
    assert lines[1:] == ["A,01/03/2026 12:10:00 AM,3.15,,", "A,02/03/2026 12:10:00 AM,3.74,,"]
    for t in ("validated.parquet", "quality.parquet", "file_outcomes.parquet", "site_status.parquet"):
        assert spark.read.parquet(f"{out}/{t}").count() > 0


def test_cli_validate_with_manifest(spark, tmp_path, capsys):
    land = tmp_path / "pairs"
    land.mkdir()
    (land / "S1.csv").write_text(f"Date,Time,{SRC_LEVEL}\n01/03/2026,00:00:00,10\n")
    (land / "baroS1.csv").write_text(f"Date,Time,{SRC_BARO}\n01/03/2026,00:00:00,1010\n")
    (land / "S2.csv").write_text(f"Date,Time,{SRC_LEVEL}\n01/03/2026,00:00:00,10\n")  # its barometer file is missing
    manifest = tmp_path / "manifest.json"
    manifest.write_text(json.dumps([
        {"name": "S1", "nav_option": "a", "main_csv": "S1.csv", "baro_csv": "baroS1.csv"},
        {"name": "S2", "nav_option": "b", "main_csv": "S2.csv", "baro_csv": "baroS2.csv"},
    ]))
    out = str(tmp_path / "out")
    rc = main(["validate", "--input", str(land), "--out", out, "--run-ts", "2026-03-28 17:00:00",
               "--manifest", str(manifest), "--single-file"])
    assert rc == 0
    summary = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert summary == {"n_sites": 2, "n_data_sites": 1, "n_flagged_sites": 0, "n_failed_sites": 1,
                       "n_rows": 1, "n_with_bom": 0, "n_dry": 0, "n_adjusted": 0, "n_placeholders": 0}
    out = current(spark, out)
    [main_csv] = glob.glob(f"{out}/main_report/*.csv")
    assert open(main_csv).read().splitlines()[1:] == ["S1,01/03/2026 12:00:00 AM,,1010.0,3.05,,"]


def test_cli_missing_folder_writes_nothing(spark, tmp_path):
    out = str(tmp_path / "out")
    rc = main(["validate", "--input", str(tmp_path / "absent"), "--out", out, "--run-ts", "2026-03-28 17:00:00"])
    assert rc == 1
    assert glob.glob(f"{out}*") == []


def test_a_run_stopped_anywhere_leaves_the_former_outputs(spark, tmp_path, monkeypatch, capsys):
    """The writes, renames and commits of a run fail one after the other; readers find the former run, whole."""
    import pytest
    from pyspark.sql.readwriter import DataFrameWriter

    from hydrocal.sinks import publish

    land, out = tmp_path / "landing", str(tmp_path / "out")
    land.mkdir()
    (land / "A.csv").write_text(HDR + "01/03/2026,00:10:00,10,1010\n")
    args = ["validate", "--input", str(land), "--out", out, "--run-ts", "2026-03-28 17:00:00"]
    assert current(spark, out) is None and main(args) == 0
    first = current(spark, out)
    tables = sorted(p for p in os.listdir(first))
    (land / "A.csv").write_text(HDR + "01/03/2026,00:10:00,10,1010\n02/03/2026,00:10:00,10,1010\n")

    class Killed(Exception):
        pass

    real = {"parquet": DataFrameWriter.parquet, "csv": DataFrameWriter.csv}
    for stop in range(7):
        done = []

        def failing(kind, stop=stop, done=done):
            def write(self, path, *a, **k):
                if "/runs/" in path:
                    done.append(path)
                    if len(done) > stop:
                        raise Killed(path)
                return real[kind](self, path, *a, **k)

            return write

        with monkeypatch.context() as m:
            for kind in real:
                m.setattr(DataFrameWriter, kind, failing(kind))
            with pytest.raises(Killed):
                main(args)
        assert current(spark, out) == first and spark.read.parquet(f"{first}/validated.parquet").count() == 1
    with monkeypatch.context() as m:  # stopped while the commit file was written
        real_write = publish.Folder.write
        m.setattr(publish.Folder, "write", lambda self, name, text: (real_write(self, name, text[:9]), (_ for _ in ()).throw(Killed())))
        with pytest.raises(Killed):
            main(args)
    assert current(spark, out) == first and sorted(p for p in os.listdir(first)) == tables
    assert main(args) == 0
    now = current(spark, out)
    assert now != first and spark.read.parquet(f"{now}/validated.parquet").count() == 2
    assert [c["run"] for c in commits(spark, out)][-1] == now.rsplit("/", 1)[-1]
    assert len(os.listdir(f"{out}/runs")) == 2  # what was never committed is gone, the former run stays


def test_counters_come_from_the_jobs_themselves(spark, tmp_path):
    """The manifest of a run counts what its tables hold."""
    from hydrocal.operators.quality import run_metrics

    land, out = tmp_path / "landing", str(tmp_path / "out")
    land.mkdir()
    (land / "A.csv").write_text(HDR + "01/03/2026,00:10:00,10,1010\n02/03/2026,00:10:00,0,1010\n31/02/2026,1,1,1\n03/03/2026,00:10:00,x,1\n03/03/2026,00:10:00,-1,1\n")
    (land / "B.csv").write_text(HDR)
    assert main(["validate", "--input", str(land), "--out", out, "--run-ts", "2026-03-28 17:00:00"]) == 0
    [made], base = commits(spark, out), current(spark, out)
    assert made["readings"] == {"n_bad_datetime": 1, "n_bad_numeric": 1, "n_negative": 1, "n_kept": 2}
    metrics = run_metrics(spark.read.parquet(f"{base}/validated.parquet")).first().asDict()
    assert {k: made["summary"][k] for k in metrics} == metrics
    for name, rows in made["outputs"].items():
        table = spark.read.parquet(f"{base}/{name}") if name.endswith(".parquet") else spark.read.csv(f"{base}/{name}", header=True)
        assert table.count() == rows, name
    assert set(made["outputs"]) == {"validated.parquet", "main_report", "upload_report", "quality.parquet", "file_outcomes.parquet", "rows_per_site.parquet", "rejected_files.parquet", "site_status.parquet"}


def test_publication_of_an_empty_run(spark, tmp_path):
    pub = Publication(spark, str(tmp_path))
    pub.parquet("t", spark.createDataFrame([], "a int"))
    assert pub.commit()["outputs"] == {"t": 0} and current(spark, str(tmp_path)) == pub.base
