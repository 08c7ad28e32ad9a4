"""CSV text to records and fields, with quoted line breaks.

A record ends at a line break outside a quoted section; a section opens only where a field begins
with a quote, and ``""`` inside it is one quote. Records and fields come from regular expressions whose
loops are possessive, so they run in linear time and without recursion.

Files reach the expressions in two ways:

* A file of at most ``whole_bytes`` is read as one row. Its header, its column positions and its records
  are columns of that row, so nothing about it passes through a join, a sort or the driver.
* A larger file is read in splits. What a split's lines do depends on whether its first line lies inside
  a quoted section, so a first pass makes, per split, the end state for either start state, the header
  (first split that has one) and the text up to the first record's end if the split begins inside one.
  A prefix over a file's splits fixes every start state. The second pass then hands on chunks of whole
  records: a split that begins inside a record leaves out the beginning, which the split before appends.
  A quoted section that covers a whole split, or more than ``MAX_TAIL`` characters of the next one,
  counts as not closed.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hydrocal.operators.joins import fits_broadcast
from hydrocal.session import cut_lineage

WHOLE_BYTES = 16 << 20  # files up to this size are one row
MAX_TAIL = 1 << 20
CHUNK = 1 << 20  # characters of a chunk of records

_SECTION = r'"[^"]*+(?:""[^"]*+)*+'  # a quoted section without its closing quote
_FIELD = rf'(?:{_SECTION}(?:"|\z)|(?!"))[^,\r\n]*+'
_RECORD = rf"({_FIELD}(?:,{_FIELD})*+)(?:\r\n?|\n|\z)"
_CLOSED = rf'(?:{_SECTION}"|(?!"))[^,]*+'
_WELL_FORMED = rf"^{_CLOSED}(?:,{_CLOSED})*+\z"


def records(content: Column) -> Column:
    """array<string>: the records of a text that are not blank. A section that nothing closes runs to the
    end of the text."""
    return F.filter(F.regexp_extract_all(content, F.lit(_RECORD), F.lit(1)), lambda r: r.rlike(r"\S"))


def well_formed(record: Column) -> Column:
    """All quoted sections of a record are closed."""
    return record.rlike(_WELL_FORMED)


def fields(record: Column) -> Column:
    """array<string>: the fields of a record, without the quotes around them."""
    parts = F.regexp_extract_all(F.concat(record, F.lit(",")), F.lit(rf"({_CLOSED}),"), F.lit(1))
    inner = rf'(?s)^({_SECTION})"(.*)\z'

    def plain(v: Column) -> Column:
        quoted = F.concat(F.replace(F.substr(F.regexp_extract(v, inner, 1), F.lit(2)), F.lit('""'), F.lit('"')), F.regexp_extract(v, inner, 2))
        return F.when(v.startswith('"'), quoted).otherwise(v)

    return F.transform(parts, plain)


def file_path() -> Column:
    """``_metadata.file_path`` in the listing's form. The metadata column is URI-encoded
    (``Site%201.csv``); percent sequences are decoded and a literal ``+`` is kept."""
    return decoded(F.col("_metadata.file_path"))


def decoded(url: Column) -> Column:
    return F.regexp_replace(F.url_decode(F.regexp_replace(url, r"\+", "%2B")), "^file:/+", "file:/")


# ---- large files ----

_CLOSING = re.compile(r'[^"]*+(?:""[^"]*+)*+"')
_REST = re.compile(r"[^,\r]*+")


def inside_after(line: str, inside: bool) -> bool:
    """Whether the end of ``line`` (without its line break) lies inside a quoted section."""
    if '"' not in line:
        return inside
    at = 0
    while True:
        if inside or line[at : at + 1] == '"':
            m = _CLOSING.match(line, at if inside else at + 1)
            if not m:
                return True
            at, inside = m.end(), False
        at = _REST.match(line, at).end() + 1
        if at > len(line):
            return False


SCAN = "src_file string, block long, outside boolean, inside boolean, header string, tail string"
_SCAN = pa.schema([("src_file", pa.string()), ("block", pa.int64()), ("outside", pa.bool_()), ("inside", pa.bool_()), ("header", pa.string()), ("tail", pa.string())])


def _runs(batches: Iterator[pa.RecordBatch], *more: str) -> Iterator[tuple[tuple, Iterator[str]]]:
    """Lines by split, in order: ((src_file, block, *more), lines)."""
    rows = (row for b in batches for row in zip(*(b.column(c).to_pylist() for c in ("src_file", "block", "value", *more))))
    row = next(rows, None)

    while row is not None:
        key, extra = row[:2], row[3:]

        def lines():
            nonlocal row
            while row is not None and row[:2] == key:
                yield row[2]
                row = next(rows, None)

        own = lines()
        yield (*key, *extra), own
        for _ in own:  # what the caller left
            pass


def scan_splits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First pass over a split's lines: end states, header, and the end of a record begun before it."""
    for (src_file, block), lines in _runs(batches):
        outside, inside, header, first, tail, size, closed = False, True, None, [], [], 0, False
        for line in lines:
            if header is None:
                first.append(line)
                if not inside_after(line, outside):
                    text = "\n".join(first)
                    header, first = (text, []) if text.strip() else (None, [])
            if not closed and size <= MAX_TAIL:
                tail.append(line)
                size += len(line) + 1
            outside, inside = inside_after(line, outside), inside_after(line, inside)
            closed = closed or not inside
        usable = closed and size <= MAX_TAIL
        yield pa.RecordBatch.from_pylist(
            [{"src_file": src_file, "block": block, "outside": outside, "inside": inside, "header": header, "tail": "\n".join(tail) if usable else None}],
            schema=_SCAN,
        )


PLAN = "src_file string, block long, begins boolean, header string, head boolean, more string"


def plan_splits(pdf):
    """Start states of one file's splits, in order, and what a split's last record lacks."""
    pdf = pdf.sort_values("block")
    header = next((h for h in pdf["header"] if isinstance(h, str)), None)
    begins, state = [], False
    for a, b in zip(pdf["outside"], pdf["inside"]):
        begins.append(state)
        state = bool(b if state else a)
    after = [*begins[1:], state]
    tails = [*pdf["tail"].tolist()[1:], None]
    more = [t if inside and isinstance(t, str) else None for inside, t in zip(after, tails)]
    out = pdf[["src_file", "block"]].copy()
    out["begins"], out["header"], out["more"] = begins, header, more
    has = pdf["header"].map(lambda h: isinstance(h, str))
    out["head"] = has & (has.cumsum() == 1)  # the split that holds the header
    return out


CHUNKS = "src_file string, header string, n_heads int, content string"
_CHUNKS = pa.schema([("src_file", pa.string()), ("header", pa.string()), ("n_heads", pa.int32()), ("content", pa.string())])


def cut_splits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Second pass: chunks of whole records. A record that nothing closes keeps its quote open."""
    for (src_file, _, begins, header, head, more), lines in _runs(batches, "begins", "header", "head", "more"):
        inside, skipping, held, size, heads = begins, begins, [], 0, int(head)

        def row():
            text = "\n".join(held)  # noqa: B023
            return pa.RecordBatch.from_pylist([{"src_file": src_file, "header": header, "n_heads": heads, "content": text}], schema=_CHUNKS)  # noqa: B023

        for line in lines:
            inside = inside_after(line, inside)
            if skipping:
                skipping = inside
                continue
            held.append(line)
            size += len(line)
            if size >= CHUNK and not inside and not (heads and not any(map(str.strip, held))):
                yield row()
                held, size, heads = [], 0, 0
        if inside and more is not None and not skipping:
            held.append(more)
        if held:
            yield row()


def large_files(lines: DataFrame) -> DataFrame:
    """src_file, header, n_heads (1: the header is the chunk's first record), content (chunks of whole
    records) of files read in splits.

    ``lines``: value, src_file, block, as the text source gives them (in order within a split)."""
    scanned = lines.mapInArrow(scan_splits, SCAN)
    plan = cut_lineage(scanned.groupBy("src_file").applyInPandas(plan_splits, PLAN), "splits")
    on = ["src_file", "block"]
    if fits_broadcast(plan):
        known = lines.join(F.broadcast(plan), on)
    else:
        numbered = lines.withColumn("line", F.monotonically_increasing_id())
        known = numbered.join(plan, on).repartition(*on).sortWithinPartitions(*on, "line")
    return known.select("src_file", "block", "value", "begins", "header", "head", "more").mapInArrow(cut_splits, CHUNKS)


# ---- files of a folder ----


def folder_contents(spark: SparkSession, folder: str, wanted: Callable[[Column], Column], whole_bytes: int = WHOLE_BYTES) -> DataFrame:
    """src_file, header, n_heads, content of the folder's files (not of its subfolders) whose name ``wanted``
    accepts: one row for a file of at most ``whole_bytes``, chunks for others. Files without a record have
    no header. Conditions on name and size select files before any is opened."""
    def text(**options):
        return spark.read.text(folder, **options)

    name, size = F.col("_metadata.file_name"), F.col("_metadata.file_size")
    small = text(wholetext=True).where(wanted(name) & (size <= whole_bytes))
    small = small.select(file_path().alias("src_file"), F.regexp_replace("value", "^\\ufeff", "").alias("content"))
    small = small.select("src_file", F.expr("inline(array(named_struct('content', content)))"))
    small = small.select("src_file", F.get(records(F.col("content")), F.lit(0)).alias("header"), F.lit(1).alias("n_heads"), "content")
    large = text(lineSep="\n").where(wanted(name) & (size > whole_bytes))
    large = large.select(F.col("value"), file_path().alias("src_file"), F.col("_metadata.file_block_start").alias("block"))
    if not has_files(large):
        return small
    big = large_files(large)
    bom = lambda c: F.regexp_replace(c, "^\\ufeff", "").alias(c)
    return small.unionByName(big.select("src_file", F.get(records(bom("header")), F.lit(0)).alias("header"), "n_heads", bom("content")))


def has_files(df: DataFrame) -> bool:
    """Whether the scan's conditions leave any file with a line."""
    return not df.isEmpty()


def parsed(contents: DataFrame, names: dict[str, str]) -> DataFrame:
    """One row per data record, and one for each file or chunk without any.

    Columns: the other columns of ``contents``, ``n_columns``, ``has_<key>`` (the header has the column;
    of repeated names the first counts), ``record`` (null where there is none), <key> (its text, null
    where the record is too short) and ``malformed`` (more fields than the header, or a section that is
    not closed).
    """
    keep = [c for c in contents.columns if c not in ("header", "n_heads", "content")]
    at = contents.select(*keep, "n_heads", "content", F.inline(F.array(F.struct(fields(F.col("header")).alias("_names")))))
    place = {k: F.coalesce(F.array_position("_names", n), F.lit(0)).cast("int") for k, n in names.items()}
    rows = records(F.col("content"))
    per_file = at.select(
        *keep, F.when(F.col("_names").isNull(), 0).otherwise(F.size("_names")).alias("n_columns"), *[p.alias(f"_at_{k}") for k, p in place.items()],
        F.explode_outer(F.filter(rows, lambda r, i: i >= F.col("n_heads"))).alias("record"),
    )
    split = F.struct(fields(F.col("record")).alias("_v"), (~well_formed(F.col("record"))).alias("_open"))
    cells = per_file.select(*per_file.columns, F.inline(F.array(split)))
    has = [(F.col(f"_at_{k}") > 0).alias(f"has_{k}") for k in names]
    picked = [F.get("_v", F.col(f"_at_{k}") - 1).alias(k) for k in names]
    malformed = F.coalesce((F.size("_v") > F.col("n_columns")) | F.col("_open"), F.lit(False)).alias("malformed")
    return cells.select(*keep, "n_columns", *has, "record", *picked, malformed)
