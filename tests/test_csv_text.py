"""CSV text against a reference reader: quoted line breaks, splits anywhere, large files, listing calls."""

import io
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from hydrocal.schemas import SRC_BARO, SRC_COMMENT, SRC_DATE, SRC_LEVEL, SRC_TIME
from hydrocal.sources import csv_folder, csv_text
from hydrocal.sources.csv_folder import folder_files, read_pairs, read_site_folder

HDR = f"{SRC_DATE},{SRC_TIME},{SRC_LEVEL},{SRC_BARO},{SRC_COMMENT}"


def frames(spark, folder, whole_bytes, columns=("a", "b", "c")):
    contents = csv_text.folder_contents(spark, str(folder), lambda n: n.endswith(".csv"), whole_bytes)
    rows = csv_text.parsed(contents, {f"v{i}": c for i, c in enumerate(columns)})
    out = {}
    for r in rows.where("record is not null").collect():
        out.setdefault(r.src_file.rsplit("/", 1)[-1], []).append(tuple(r[f"v{i}"] or "" for i in range(len(columns))) + (r.malformed,))
    return out


def wanted(text):
    """What pandas reads (as text), or None where it finds the file unreadable."""
    try:
        df = pd.read_csv(io.StringIO(text, newline=""), dtype=str, keep_default_na=False, index_col=False)
    except (pd.errors.ParserError, pd.errors.EmptyDataError):
        return None
    return [tuple("" if v is None else str(v) for v in row) for row in df.fillna("").itertuples(index=False)]


def odd_text(rng, rows):
    """Records with sections, doubled quotes, breaks inside sections, quotes inside fields and blank lines."""
    pieces = ["x", "12", " ", ";", "é", "'"]
    inside = pieces + ["\n", ",", '""', "\r\n", '""\n""']

    def field(first):
        kind = rng.random()
        if kind < 0.35:
            return '"' + "".join(rng.choices(inside, k=rng.randint(0, 6))) + '"'
        text = "".join(rng.choices(pieces + ['5" '], k=rng.randint(1 if first else 0, 4)))
        return text.lstrip('"')

    lines = ["a,b,c"]
    for _ in range(rows):
        lines.append("" if rng.random() < 0.1 else ",".join(field(i == 0) for i in range(rng.randint(2, 3))))
    return rng.choice(["\n", "\r\n"]).join(lines) + rng.choice(["", "\n"])


@pytest.fixture(scope="module")
def odd_files(tmp_path_factory):
    d, rng = tmp_path_factory.mktemp("odd"), random.Random(11)
    texts = {f"f{i}.csv": odd_text(rng, rng.randint(0, 40)) for i in range(60)}
    for name, text in texts.items():
        (d / name).write_bytes(text.encode())
    return d, texts


def check(got, texts):
    for name, text in texts.items():
        rows = got.get(name, [])
        assert [r[:-1] for r in rows] == wanted(text) and not any(r[-1] for r in rows), (name, text)


def test_whole_files_equal_the_reference_reader(spark, odd_files):
    d, texts = odd_files
    check(frames(spark, d, 1 << 20), texts)


@pytest.mark.parametrize("split", [37, 101, 1000])
def test_splits_anywhere_equal_the_reference_reader(spark, odd_files, split, monkeypatch):
    """Files cut into splits of a few bytes, many of them inside quoted sections that span several lines."""
    d, texts = odd_files
    monkeypatch.setattr(csv_text, "CHUNK", 25)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        contents = csv_text.folder_contents(spark, str(d), lambda n: n.endswith(".csv"), 0)
        rows = csv_text.parsed(contents, {f"v{i}": c for i, c in enumerate("abc")}).where("record is not null")
        got = {}
        for r in rows.collect():
            got.setdefault(r.src_file.rsplit("/", 1)[-1], []).append(tuple(r[f"v{i}"] or "" for i in range(3)) + (r.malformed,))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    for name, text in texts.items():
        # a section over whole splits counts as open; those that close within the next split must be right
        rows, want = got.get(name, []), wanted(text)
        if split == 1000 or not any(r[-1] for r in rows):
            assert sorted(r[:-1] for r in rows) == sorted(want), (name, text)
    assert sum(any(r[-1] for r in v) for v in got.values()) <= (20 if split == 37 else 2)


def test_split_plan_without_broadcast(spark, odd_files, monkeypatch):
    d, texts = odd_files
    monkeypatch.setattr(csv_text, "fits_broadcast", lambda df: False)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400")
    try:
        got = frames(spark, d, 0)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "134217728")
    for name, text in texts.items():
        assert sorted(r[:-1] for r in got.get(name, [])) == sorted(wanted(text)), name


def test_only_open_sections_and_surplus_fields_are_malformed(spark, tmp_path):
    texts = {
        "open.csv": 'a,b,c\n1,2,"3\n4,5,6\n', "surplus.csv": "a,b,c\n1,2,3\n1,2,3,4\n", "closed.csv": 'a,b,c\n1,2,"3\n4"\n',
        "inch.csv": 'a,b,c\n1,5" pipe,3\n', "after.csv": 'a,b,c\n1,"2"x,3\n', "short.csv": "a,b,c\n1\n",
    }
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    for size in (0, 1 << 20):
        got = frames(spark, tmp_path, size)
        assert {n for n, rows in got.items() if any(r[-1] for r in rows)} == {"open.csv", "surplus.csv"}
        for name in ("closed.csv", "inch.csv", "after.csv", "short.csv"):
            assert [r[:-1] for r in got[name]] == wanted(texts[name]), name


def test_end_states_of_lines():
    state = csv_text.inside_after
    assert not state("a,b", False) and state("a,b", True)
    assert state('a,"b', False) and not state('b",c', True) and state('b",c,"d', True)
    assert not state('a,5" x,"y"', False) and state('""', True) and not state('"""",', False) and state('"a""', False)


@pytest.mark.parametrize("whole_bytes", [0, 1 << 20])
def test_site_folder_with_comments_over_lines(spark, tmp_path, whole_bytes):
    row = "01/02/2026,10:00:00,1.5,1000,"
    (tmp_path / "A.csv").write_text(f'{HDR}\n{row}"two\nlines, ""quoted"""\n02/02/2026,10:00:00,1.5,1000,ok\n')
    (tmp_path / "B.csv").write_text(f"\n\n{HDR},Temp\n{row}x,9\n")
    (tmp_path / "C.csv").write_text(f"{HDR}\n")
    (tmp_path / "D.csv").write_text("")
    (tmp_path / "E.csv").write_text("\n \n")
    (tmp_path / "F.csv").write_text(f"{SRC_DATE},{SRC_TIME}\n1,2\n3,4\n")
    (tmp_path / "G.csv").write_text(f'{HDR}\n{row}"never closed\n')
    (tmp_path / "baroA.csv").write_text(f"{HDR}\n{row}x\n")
    inp = read_site_folder(spark, str(tmp_path), whole_bytes=whole_bytes)
    assert {r.site: r.status for r in inp.files.collect()} == {"A": "ok", "B": "ok", "C": "ok", "D": "zero_bytes", "E": "zero_bytes", "F": "rejected", "G": "ok"}
    comments = {}
    for r in inp.raw.collect():
        comments.setdefault(r.src_file[-5], []).append((r.comment, r.malformed))
    assert sorted(comments["A"]) == [("ok", False), ('two\nlines, "quoted"', False)]
    assert comments["B"] == [("x", False)] and comments["G"][0][1] and set(comments) == {"A", "B", "G"}
    from hydrocal.plans.validate import validate

    for raw, files in ((inp.rows, inp.listing), (inp.raw, inp.files)):
        v = validate(raw, "2026-03-01 00:00:00", files=files)
        got = sorted((r.site, r.comment) for r in v.final.collect())
        on = " on 01/03/2026 00:00:00"
        assert got == [("A", "ok"), ("A", 'two\nlines, "quoted"'), ("B", "x"), ("C", "CSV file was empty" + on), ("D", "Empty file" + on), ("E", "Empty file" + on)]
        assert sorted(r.site for r in v.rejected_files.collect()) == ["F", "G"]
        assert sorted(r.site for r in v.quality.collect()) == ["A", "B", "G"]


class Calls:
    """Counts messages to the JVM."""

    def __init__(self, spark, monkeypatch):
        client = spark.sparkContext._gateway._gateway_client
        real, self.n = client.send_command, 0

        def send(*a, **k):
            self.n += 1
            return real(*a, **k)

        monkeypatch.setattr(client, "send_command", send)


def test_listing_takes_as_many_calls_for_many_files(spark, tmp_path, monkeypatch):
    seen = []
    for n in (3, 1500):
        d = tmp_path / str(n)
        d.mkdir()
        for i in range(n):
            (d / f"S{i}.csv").write_text("" if i % 3 == 0 else f"{HDR}\n01/02/2026,10:00:00,1.5,1000,x\n")
        (d / "sub").mkdir()
        (d / "sub" / "T.csv").write_text("x")
        with monkeypatch.context() as m:
            calls = Calls(spark, m)
            listed = folder_files(spark, str(d))
            inp = read_site_folder(spark, str(d))
            seen.append(calls.n)
        assert listed.count() == n and listed.where("size = 0").count() == n // 3
        assert inp.raw.count() == n - n // 3
    assert seen[1] - seen[0] < 500, seen  # less than one a file; plans and freed objects vary a little


def test_headers_stay_in_the_tasks(spark, tmp_path, monkeypatch):
    """Building the plan of a folder collects nothing, and the plan has no sort, exchange or join."""
    for i in range(20):
        (tmp_path / f"S{i}.csv").write_text(f"{HDR},extra{i}\n01/02/2026,10:00:00,1.5,1000,x,y\n")
    from pyspark.sql.classic.dataframe import DataFrame

    monkeypatch.setattr(DataFrame, "collect", lambda self: pytest.fail("collect"))
    inp = read_site_folder(spark, str(tmp_path))
    monkeypatch.undo()
    plan = inp.rows._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Exchange", "Sort", "Join", "Arrow"))
    assert inp.raw.count() == 20


def test_pairs_are_a_plan_over_tables(spark, tmp_path, monkeypatch):
    level, baro = f"{SRC_DATE},{SRC_TIME},{SRC_LEVEL}\n", f"{SRC_DATE},{SRC_TIME},{SRC_BARO}\n"
    files = {
        "a.csv": level + "1,1,10\n1,2,11\n,,12\n", "baroa.csv": baro + "1,1,900\n1,1,800\n,,700\n",
        "b.csv": level + "1,1,20\n", "barob.csv": "Date\n1\n",  # without pressure
        "c.csv": HDR + "\n1,1,30,555,own\n", "baroc.csv": "",  # keeps its own
        "d.csv": HDR + "\n1,1,40,555,own\n", "barod.csv": baro,  # merged with no rows
        "e.csv": "", "baroe.csv": baro + "1,1,1\n", "f.csv": level, "barof.csv": baro + "1,1,1\n",
        "g.csv": level + "1,1,70\n", "barog.csv": baro + '1,1,"9\n', "h.csv": level + "1,1,80\n", "x.csv": level + "9,9,9\n",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    pairs = [(f"{c}.csv", f"baro{c}.csv") for c in "abcdefg"] + [("h.csv", None), ("absent.csv", "baroa.csv"), (None, "barob.csv")]
    manifest = spark.createDataFrame(pairs, "main_csv string, baro_csv string")
    calls = []
    for name in ("collect", "toPandas"):
        real = getattr(type(manifest), name)
        monkeypatch.setattr(type(manifest), name, lambda self, real=real, name=name: calls.append(self.columns) or real(self))
    inp = read_pairs(spark, str(tmp_path), manifest)
    monkeypatch.undo()
    assert all(set(c) <= {"i", "b", "top"} for c in calls), calls  # measured sizes and counts alone
    assert {r.site: r.status for r in inp.files.collect()} == {"a": "ok", "b": "rejected", "c": "ok", "d": "ok", "e": "zero_bytes", "f": "ok", "g": "rejected", "h": "rejected"}
    got = sorted((r.src_file[-5], r.level_text, r.baro_text or "") for r in inp.raw.collect())
    assert got == [("a", "10", "800"), ("a", "11", ""), ("a", "12", "700"), ("c", "30", "555"), ("d", "40", "")]
    assert csv_folder.RAW_COLUMNS == inp.raw.columns


def test_files_are_chosen_before_they_are_opened(spark, tmp_path):
    for i in range(30):
        (tmp_path / f"{'baro' if i % 3 else 'S'}{i}.csv").write_text(f"{HDR}\n01/02/2026,10:00:00,1.5,1000,x\n")
    df = csv_text.folder_contents(spark, str(tmp_path), csv_folder.is_site_file)
    df.write.format("noop").mode("overwrite").save()
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    read = scan.metrics().apply("numFiles").value()
    assert df.agg(F.count("*")).first()[0] == 10 and read in (0, 10)
