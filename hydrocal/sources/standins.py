"""Stand-in inputs built from the driver-provided tables.

These functions only render rows in the schemas the jobs expect; they do none of the jobs' work.
Role mapping:

* ``events`` rows other than ``signup`` are logger readings: ``user_id`` is the site (its file is
  ``<user_id>.csv``), ``ts`` the reading time, ``value`` the level in feet, and the logger
  pressure is ``985 + 0.4 * k`` hPa with ``k`` from ``props``.
* ``signup`` events are the external weather feed: ``990 + value / 10`` hPa.
* ``customer`` rows are configured sites: ``MACHINERY`` sites divide by 100, ``AUTOMOBILE`` sites
  carry an unknown type, ``HOUSEHOLD`` entries are not objects, the rest use the default.
* ``orders`` are readings of customer sites (``o_custkey``) at ``o_orderdate``.

Raw text rendering (``logger_raw``) writes what a faulty export would contain, decided by the
event's own fields: ``error`` events carry a two-digit year; ``k`` in [0,5) a non-numeric level,
[5,8) a level with a ``d`` suffix, [8,10) an empty pressure, [10,12) a negative level; [20,30)
non-padded dates and times; [30,35) levels in exponent notation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hydrocal.schemas import SRC_BARO, SRC_COMMENT, SRC_DATE, SRC_LEVEL, SRC_TIME
from hydrocal.session import scratch_path, table
from hydrocal.sources.csv_folder import folder_exists, folder_files

def K():
    """The integer ``k`` of an event's flat ``props`` object ``{"k": <int>}`` (a regex read: the
    stand-ins reference it many times and a JSON parser per reference is ~10x slower)."""
    return F.regexp_extract(F.col("props"), r'"k"\s*:\s*(-?[0-9]+)', 1).try_cast("int")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def _spread(df: DataFrame) -> DataFrame:
    """Rows dealt to all cores where the input has fewer splits than there are cores: pages are far larger
    than the events that they are made of."""
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    splits = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) / (128 << 20)
    return df.repartition(cores) if splits < cores else df


def logger_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).where(F.col("event_type") != "signup")


def logger_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed readings (site, ts, level_ft, baro_hpa, comment, src_file)."""
    return logger_events(spark, sf_dir).select(
        F.col("user_id").cast("string").alias("site"),
        F.col("ts"),
        F.col("value").alias("level_ft"),
        (F.lit(985.0) + F.lit(0.4) * K()).alias("baro_hpa"),
        F.lit("").alias("comment"),
        F.concat(F.col("user_id").cast("string"), F.lit(".csv")).alias("src_file"),
    )


def logger_readings_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``logger_readings`` as a file stream over the events table."""
    schema = table(spark, sf_dir, "events").schema
    stream, path = spark.readStream.schema(schema), f"{sf_dir.rstrip('/')}/events.parquet"
    if not folder_exists(spark, path):  # one file: a stream reads folders, so its name is picked
        stream, path = stream.option("pathGlobFilter", "events.parquet"), sf_dir.rstrip("/")
    ev = stream.parquet(path).where(F.col("event_type") != "signup")
    return ev.select(
        F.col("user_id").cast("string").alias("site"),
        F.col("ts"),
        F.col("value").alias("level_ft"),
        (F.lit(985.0) + F.lit(0.4) * K()).alias("baro_hpa"),
        F.lit("").alias("comment"),
        F.concat(F.col("user_id").cast("string"), F.lit(".csv")).alias("src_file"),
    )


def logger_raw(spark: SparkSession, sf_dir: str, keep_id: bool = False) -> DataFrame:
    """Raw text rows (site, date_text, time_text, level_text, baro_text, comment, src_file), plus
    ``event_id`` when ``keep_id``."""
    ev = logger_events(spark, sf_dir).withColumn("k", K())
    k = F.col("k")
    padded = ~k.between(20, 29)
    date_text = (
        F.when(F.col("event_type") == "error", F.date_format("ts", "dd/MM/yy"))
        .when(padded, F.date_format("ts", "dd/MM/yyyy"))
        .otherwise(F.date_format("ts", "d/M/yyyy"))
    )
    time_text = F.when(padded, F.date_format("ts", "HH:mm:ss")).otherwise(F.date_format("ts", "H:m:s"))
    v = F.col("value")
    level_text = (
        F.when(k < 5, F.lit("---"))
        .when(k < 8, F.concat(v.cast("string"), F.lit("d")))
        .when(k.between(10, 11), F.concat(F.lit("-"), v.cast("string")))
        .when(k.between(30, 34), F.format_string("%.6e", v))
        .otherwise(v.cast("string"))
    )
    baro = F.lit(985.0) + F.lit(0.4) * k
    baro_text = F.when(k.between(8, 9), F.lit("")).otherwise(baro.cast("string"))
    ids = ["event_id"] if keep_id else []
    return ev.select(
        *ids,
        F.lit(None).cast("string").alias("site"),
        date_text.alias("date_text"),
        time_text.alias("time_text"),
        level_text.alias("level_text"),
        baro_text.alias("baro_text"),
        F.lit(None).cast("string").alias("comment"),
        F.concat(F.col("user_id").cast("string"), F.lit(".csv")).alias("src_file"),
    )


def weather_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather feed readings as text (date_text, time_text, hpa_text)."""
    ev = _events(spark, sf_dir).where(F.col("event_type") == "signup")
    return ev.select(
        F.date_format("ts", "dd/MM/yyyy").alias("date_text"),
        F.date_format("ts", "HH:mm:ss").alias("time_text"),
        (F.lit(990.0) + F.col("value") / F.lit(10.0)).cast("string").alias("hpa_text"),
    )


def conversion_type_of_segment():
    seg = F.col("c_mktsegment")
    return (
        F.when(seg == "MACHINERY", F.lit("divide_by_100"))
        .when(seg == "AUTOMOBILE", F.lit("metres"))
        .otherwise(F.lit("default"))
    )


def config_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON configuration document per customer: ``{"<custkey>": {"depth_conversion_type": t}}``;
    ``HOUSEHOLD`` documents hold a bare string instead of an object."""
    c = table(spark, sf_dir, "customer")
    site = F.col("c_custkey").cast("string")
    obj = F.to_json(F.create_map(site, F.struct(conversion_type_of_segment().alias("depth_conversion_type"))))
    bare = F.to_json(F.create_map(site, F.lit("n/a")))
    doc = F.when(F.col("c_mktsegment") == "HOUSEHOLD", bare).otherwise(obj)
    return c.select("c_custkey", doc.alias("doc"))


def manifest_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file-pair manifest (JSON array of two pairs) per supplier, the second without a barometer
    file. Suppliers of nation 0 hold text that is not JSON; those with a negative balance an empty array."""
    s = table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey").cast("string")

    def entry(name, option, main, *baro):
        return F.struct(name.alias("name"), option.alias("nav_option"), main.alias("main_csv"), *baro)

    option = F.col("s_nationkey").cast("string")
    full = entry(F.col("s_name"), option, F.concat(key, F.lit(".csv")), F.concat(F.lit("baro"), key, F.lit(".csv")).alias("baro_csv"))
    bare = entry(F.concat(F.col("s_name"), F.lit(" B")), option, F.concat(key, F.lit("b.csv")), F.lit(None).cast("string").alias("baro_csv"))
    doc = (
        F.when(F.col("s_nationkey") == 0, F.lit("not a manifest"))
        .when(F.col("s_acctbal") < 0, F.lit("[]"))
        .otherwise(F.to_json(F.array(full, bare)))
    )
    return s.select("s_suppkey", doc.alias("doc"))


def customer_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file listing (src_file, site, status) with one file per customer: ``MACHINERY`` files have no
    bytes, ``AUTOMOBILE`` files are unreadable, the others are readable."""
    seg, site = F.col("c_mktsegment"), F.col("c_custkey").cast("string")
    status = F.when(seg == "MACHINERY", "zero_bytes").when(seg == "AUTOMOBILE", "rejected").otherwise("ok")
    return table(spark, sf_dir, "customer").select(
        F.concat(site, F.lit(".csv")).alias("src_file"), site.alias("site"), status.alias("status")
    )


def order_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as readings of customer sites."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").cast("string").alias("site"),
        F.col("o_orderdate").alias("ts"),
        F.col("o_totalprice").alias("level_ft"),
        F.lit(None).cast("double").alias("baro_hpa"),
        F.lit("").alias("comment"),
        F.concat(F.col("o_custkey").cast("string"), F.lit(".csv")).alias("src_file"),
    )


def weather_table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather-table rows (event_id, cells array<string>) as a station page would hold them: cell 0
    the day of month, cell 15 the morning hPa, cell 21 the afternoon hPa. ``view`` rows are
    summary rows (``Mean``), ``error`` rows stop after cell 15, ``click`` rows read ``0`` in the
    morning; the afternoon value is ``k`` (so ``k = 0`` reads ``0``)."""
    return _weather_cells(spark, sf_dir).select("event_id", "cells")


def _weather_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _spread(_events(spark, sf_dir)).withColumn("k", K())
    et = F.col("event_type")
    day = F.when(et == "view", F.lit("Mean")).otherwise(F.dayofmonth("ts").cast("string"))
    am = F.when(et == "click", F.lit("0")).otherwise(F.col("value").cast("string"))
    pm = F.col("k").cast("string")
    filler = [F.lit("") for _ in range(14)]
    cells = F.array(day, *filler, am, *[F.lit("") for _ in range(5)], pm)
    cells = F.when(et == "error", F.slice(cells, 1, 16)).otherwise(cells)
    return ev.select("event_id", "k", cells.alias("cells"))


def weather_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station pages (event_id, html), one per event, each with one row of a weather table. Day cells
    are those of ``weather_table_rows`` but for ``k`` of 0, 1 and 2: ``0``, ``123`` and ``31``."""
    rows = _weather_cells(spark, sf_dir)
    odd = F.when(F.col("k") == 0, "0").when(F.col("k") == 1, "123").when(F.col("k") == 2, "31").otherwise(F.col("cells")[0])
    others = F.slice("cells", F.lit(2), F.size("cells") - 1)
    cells = F.concat(F.lit("<th> "), odd, F.lit("</th><td>"), F.array_join(others, "</td><td>"), F.lit("</td>"))
    head = "<html><body><table class='menu'><tr><td>1</td></tr></table><table class=\"wide data\"><thead><tr><th>Day</th></tr></thead><tbody><tr>"
    return rows.select("event_id", F.concat(F.lit(head), cells, F.lit("</tr></tbody></table></body></html>")).alias("html"))


def odd_weather_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station pages (event_id, html) with markup that hides or breaks the table, by ``k`` modulo 7:

    0 a data table in a comment before the real one; 1 cells without end tags, so that each holds the
    text of all that follow; 2 two rows without end tags, the outer of which begins with the cells of the
    day after; 3 decimal and named references; 4 hexadecimal references, a script that writes a table and
    an attribute with ``>``; 5 a table inside a cell, whose cell counts; 6 tags and comments inside cells.
    """
    ev = _spread(_events(spark, sf_dir)).withColumn("k", K())
    kind, lit = F.col("k") % 7, F.lit
    day, am, pm = F.dayofmonth("ts").cast("string"), F.col("value").cast("string"), F.col("k").cast("string")

    def cells(day, am, pm, open_, close, fill=14):
        between = lambda n: F.repeat(F.concat(lit(open_), lit(close)), lit(n))
        return F.concat(lit(open_), day, lit(close), between(fill), lit(open_), am, lit(close), between(5), lit(open_), pm, lit(close))

    def table(*parts):
        return F.concat(lit("<table id=t class='x data'><tbody>"), *[lit(p) if isinstance(p, str) else p for p in parts], lit("</tbody></table>"))

    td = ("<td>", "</td>")
    as_numbers = lambda text, form: F.array_join(F.transform(F.split(text, ""), lambda c: F.when(c != "", F.concat(lit("&#"), F.concat(lit("x"), F.hex(F.ascii(c))) if form == "x" else F.ascii(c).cast("string"), lit(";")))), "")
    real = table("<tr>", cells(day, am, pm, *td), "</tr>")
    decoy = table("<tr>", cells(lit("7"), lit("1.5"), lit("2.5"), *td), "</tr>")
    inner = F.concat(lit("<tr><td>"), day, lit("</td><td><table><tr><td>9</td></tr></table></td>"), F.repeat(lit("<td></td>"), lit(12)), lit("<td>"), am, lit("</td>"), F.repeat(lit("<td></td>"), lit(5)), lit("<td>"), pm, lit("</td></tr>"))
    html = (
        F.when(kind == 0, F.concat(lit("<!-- "), decoy, lit(" -->"), real))
        .when(kind == 1, table("<tr>", cells(day, am, pm, "<td>", ""), "</tr>"))
        .when(kind == 2, table("<tr>", cells((F.dayofmonth("ts") + 1).cast("string"), pm, am, *td), "<tr>", cells(day, am, pm, *td)))
        .when(kind == 3, table("<tr>", cells(as_numbers(day, "d"), F.concat(lit("&nbsp;"), F.replace(am, lit("."), lit("&period;")), lit("&emsp;")), F.concat(pm, lit("&#160;")), *td), "</tr>"))
        .when(kind == 4, F.concat(lit("<script>document.write(\""), decoy, lit("\")</script><p title='a>b'>x</p>"), table("<tr>", cells(as_numbers(day, "x"), as_numbers(am, "x"), pm, *td), "</tr>")))
        .when(kind == 5, table(inner))
        .otherwise(table("<tr>", cells(F.concat(lit("<b>"), day, lit("</b><!-- 0 -->")), F.concat(lit("<i> "), am, lit(" <br/></i>")), pm, "<th>", "</th>"), "</tr>"))
    )
    return ev.select("event_id", F.concat(lit("<html><body><table class='menu'><tr><td>1</td></tr></table>"), html, lit("</body></html>")).alias("html"))


# ---- folders of files, written by Spark from the events ----

SITE_FILES, PAIR_FILES = 24, 16


def file_number() -> Column:
    """Number of a written file: the writing task's, which stands in its name."""
    return F.regexp_extract("src_file", r"part-(\d+)", 1).cast("int")


def _as_files(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """One partition, and so one file, per value of ``f``."""
    out = df.repartitionById(n, "f")
    return (out.sortWithinPartitions(*order) if order else out).drop("f")


def _comment() -> Column:
    """Every tenth reading has a comment of two lines, with quotes and a comma."""
    return F.when(K() % 10 == 0, F.concat(F.lit('seen "twice",\nreading '), F.col("event_id").cast("string")))


def site_folder(spark: SparkSession, sf_dir: str) -> str:
    """A landing folder of ``SITE_FILES`` merged site files; a reading lies in file ``user_id`` modulo their
    number, those of 22 and 23 in none. File 20 lacks the pressure column, file 21 has rows with a surplus
    field, a second file 0 ends after its header, file 23 has no bytes."""
    folder = scratch_path(spark, "landing")
    f = F.pmod("user_id", F.lit(SITE_FILES)).cast("int")
    texts = ("date_text", "time_text", "level_text", "baro_text")
    rows = logger_raw(spark, sf_dir, keep_id=True).join(_events(spark, sf_dir).select("event_id", "props", f.alias("f")), "event_id")
    names = (SRC_DATE, SRC_TIME, SRC_LEVEL, SRC_BARO)
    good = rows.where("f < 20").select("f", *[F.col(c).alias(n) for c, n in zip(texts, names)], _comment().alias(SRC_COMMENT))
    _as_files(good, SITE_FILES).write.option("header", True).option("escape", '"').csv(folder)
    line = F.concat_ws(",", F.col("date_text"), F.col("time_text"), F.col("level_text"), F.when(F.col("f") == 21, F.lit("1000,,surplus")))
    heads = [(20, ",".join(names[:3])), (21, ",".join(names)), (0, ",".join(names))]
    odd = spark.createDataFrame([(f, 0, h) for f, h in heads], "f int, place int, line string")
    odd = odd.unionByName(rows.where("f in (20, 21)").select("f", F.lit(1).alias("place"), line.alias("line")))
    lines = _as_files(odd, SITE_FILES, F.col("place")).select("line")
    lines.write.mode("append").option("sep", "\u0001").csv(folder)  # one column: lines as they are
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/part-{SITE_FILES - 1:05d}-none.csv")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path).close()
    return folder


def hourly_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a file number, and the hour as key: date_text (none where ``k`` is below 3), time_text."""
    ev = _events(spark, sf_dir).withColumn("f", F.pmod("user_id", F.lit(PAIR_FILES)).cast("int"))
    date = F.when(K() >= 3, F.date_format("ts", "dd/MM/yyyy"))
    return ev.select("f", "event_id", "event_type", "props", date.alias("date_text"), F.date_format("ts", "HH:00:00").alias("time_text"))


def pair_folder(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """A folder of ``PAIR_FILES`` level files and their barometer files, and its manifest. Of five files the
    fourth has no barometer file and the fifth one without a pressure column."""
    folder = scratch_path(spark, "pairs")
    ev = hourly_readings(spark, sf_dir)
    level = ev.where("event_type <> 'signup'").select(
        "f", F.col("date_text").alias(SRC_DATE), F.col("time_text").alias(SRC_TIME),
        (F.col("event_id") % 1000).cast("string").alias(SRC_LEVEL), _comment().alias(SRC_COMMENT))
    _as_files(level, PAIR_FILES).write.option("header", True).option("escape", '"').csv(folder)
    full = F.col("f") % 5 != 4
    pressure = F.when(full, (F.lit(900) + F.col("event_id") % 150).cast("string"))
    rows = ev.where(K() % 3 == 0).where("f % 5 <> 3")
    rows = rows.select("f", F.lit(1).alias("place"), F.concat_ws(",", F.coalesce("date_text", F.lit("")), "time_text", pressure).alias("line"))
    head = F.concat_ws(",", F.lit(SRC_DATE), F.lit(SRC_TIME), F.when(full, F.lit(SRC_BARO)))
    heads = spark.range(PAIR_FILES).select(F.col("id").cast("int").alias("f")).where("f % 5 <> 3").select("f", F.lit(0).alias("place"), head.alias("line"))
    _as_files(heads.unionByName(rows), PAIR_FILES, F.col("place")).select("line").write.mode("append").text(folder)
    files = folder_files(spark, folder)
    is_level = F.col("name").endswith(".csv")
    manifest = files.groupBy(file_number().alias("f")).agg(F.max(F.when(is_level, F.col("name"))).alias("main_csv"), F.max(F.when(~is_level, F.col("name"))).alias("baro_csv"))
    return folder, manifest.where("main_csv is not null").drop("f")
