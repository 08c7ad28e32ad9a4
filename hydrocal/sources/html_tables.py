"""HTML table extraction as a Spark job over a column of pages.

Native expressions only. A page is cut into tokens (tags, comments, raw script and style sections,
text); a fold over the tokens keeps the stack of open elements the way a lenient parser does:

* an end tag closes its innermost open element and all that stands open inside it, and is ignored if
  there is none; void elements and ``<x/>`` close at once; nothing else closes implicitly, so a ``td``
  without end tag holds the following cells of its row too, and all ends with its table or the page;
* comments, declarations, scripts and styles are no text, and tags in them are none.

The fold notes from which token to which each row and cell of the first ``table.data`` reaches. Rows are
its ``tr`` elements with a ``tbody`` around them, cells their ``th`` and ``td`` elements in order, those of
inner tables included. Rows without cells are skipped.

A page whose only data table is written out in full, with plain text in its cells and nothing that hides
markup, gives the same rows by three patterns, without the fold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hydrocal.functions.text import BREAK, raw_text, strip_tags

_ATTRIBUTES = r"""(?:[^"'<>]|"[^"]*+"|'[^']*+')*+"""
# A class attribute whose list contains the word "data" (double-, single- or un-quoted).
_CLASS = r"""(?<=[\s"'/])[cC][lL][aA][sS][sS]\s*=\s*(?:"(?:[^"]*\s)?data(?:\s[^"]*)?"|'(?:[^']*\s)?data(?:\s[^']*)?'|data(?=[\s>/]))"""
_HIDES = r"(?i)<(?:!--|script|style)"

# Pages without surprises.
_PLAIN = r"""(?:[^"'<>]|"[^"<>]*"|'[^'<>]*')*+"""
_PLAIN_CELL = rf"<(?:td|th)(?:\s{_PLAIN})?>[^<]*+</(?:td|th)\s*>"
_PLAIN_ROW = rf"<tr(?:\s{_PLAIN})?>\s*+(?:{_PLAIN_CELL}\s*+)*+</tr\s*>"
_PLAIN_TABLE = (
    rf"(?i)<table(?=\s){_PLAIN}>\s*+(?:<thead>\s*+(?:{_PLAIN_ROW}\s*+)*+</thead\s*>\s*+)?+"
    rf"<tbody(?:\s{_PLAIN})?>\s*+((?:{_PLAIN_ROW}\s*+)++)</tbody\s*>\s*+</table\s*>"
)


def element_pattern(tag: str) -> str:
    """Regex capturing the inner HTML of every ``<tag ...>...</tag>`` (first closing tag wins)."""
    return rf"(?i)<{tag}\b[^>]*>([\s\S]*?)</{tag}\s*>"


def element_texts(html: Column, tag: str) -> Column:
    """array<string>: stripped text of each ``tag`` element, in document order."""
    return F.transform(F.regexp_extract_all(html, F.lit(element_pattern(tag)), F.lit(1)), strip_tags)


# ---- tokens ----

_NAME = r"[a-zA-Z][^\s/>]*+"
_TOKEN = (
    r"(?is)<!--.*?(?:-->|\z)|<(script|style)(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\z)|<[!?][^>]*>?"
    rf"|</?{_NAME}{_ATTRIBUTES}>|[^<]++|<"
)
#: Elements without content.
VOID = ["area", "base", "br", "col", "embed", "hr", "img", "input", "keygen", "link", "menuitem", "meta", "param", "source", "track", "wbr", "basefont", "bgsound", "command", "frame", "image", "isindex", "nextid", "spacer"]


def tokens(html: Column) -> Column:
    """array<struct<text, kind, name>>: ``start``, ``end`` and ``single`` tags, ``text`` and ``none``."""
    cut = F.regexp_extract_all(html, F.lit(_TOKEN), F.lit(0))
    # lower-case names, without the signs that the stack is written with; none for text
    named = F.transform(cut, lambda t: F.struct(
        t.alias("text"), F.when(t.startswith("<"), F.translate(F.lower(F.regexp_extract(t, rf"^</?({_NAME})", 1)), ";@#|", "____")).alias("name")))

    def token(t: Column) -> Column:
        text, name = t["text"], t["name"]
        kind = (
            F.when(name.isNull() | (text == "<"), "text")
            .when(name == "", "none")
            .when(text.startswith("</"), "end")
            .when(name.isin("script", "style"), "none")
            .when(text.endswith("/>") | name.isin(VOID), "single")
            .otherwise("start")
        )
        return F.struct(text.alias("text"), kind.alias("kind"), name.alias("name"))

    return F.transform(named, token)


def element_spans(toks: Column) -> Column:
    """array<struct<first, last, is_row>>: the rows and cells of the first ``table.data``, by the numbers of
    their start token and of the token that ends them, in order.

    The stack of open elements is a text, the innermost element first: ``;td@12C;tr@10R;tbody@9;table@8T``.
    Capitals mark the table, its rows and its cells. What an end tag closes is the text up to the end of
    the first element of that name.
    """
    zero = F.struct(F.lit(0).alias("at"), F.lit(0).alias("phase"), F.lit("").alias("open"), F.lit("").alias("ended"))
    before, inside, after = 0, 1, 2

    def state(s: Column, phase: Column, opened: Column, ended: Column) -> Column:
        return F.struct((s["at"] + 1).alias("at"), phase.alias("phase"), opened.alias("open"), ended.alias("ended"))

    def step(s: Column, t: Column) -> Column:
        is_in, name, number = s["phase"] == inside, t["name"], s["at"].cast("string")
        is_table = (s["phase"] == before) & (name == "table") & t["text"].rlike(_CLASS)
        mark = (
            F.when(is_in & name.isin("td", "th"), "C")
            .when(is_in & (name == "tr") & s["open"].contains(";tbody@"), "R")
            .when(is_table, "T")
            .otherwise("")
        )
        one = F.concat(F.lit(";"), name, F.lit("@"), number, mark)
        place = F.position(F.concat(F.lit(";"), name, F.lit("@")), s["open"])
        rest = F.substring_index(F.substr(s["open"], place + 1), ";", 1)  # the element itself
        closed = F.substr(s["open"], F.lit(1), place + F.length(rest))
        left = F.substr(s["open"], place + F.length(rest) + 1)
        note = lambda what: F.when(is_in, F.concat(s["ended"], what, F.lit("#"), number, F.lit("|"))).otherwise(s["ended"])
        phase = F.when(is_in & closed.contains("T"), after).otherwise(s["phase"])
        return (
            F.when((s["phase"] == after) | t["kind"].isin("text", "none"), state(s, s["phase"], s["open"], s["ended"]))
            .when(t["kind"] == "start", state(s, F.when(is_table, inside).otherwise(s["phase"]), F.concat(one, s["open"]), s["ended"]))
            .when(t["kind"] == "single", state(s, F.when(is_table, after).otherwise(s["phase"]), s["open"], note(one)))
            .when(place == 0, state(s, s["phase"], s["open"], s["ended"]))
            .otherwise(state(s, phase, left, note(closed)))
        )

    def finish(s: Column) -> Column:
        return F.when(s["phase"] == inside, F.concat(s["ended"], s["open"], F.lit("#"), s["at"].cast("string"), F.lit("|"))).otherwise(s["ended"])

    groups = F.regexp_extract_all(F.aggregate(toks, zero, step, finish), F.lit(r"([^#|]*)#(\d+)"), F.lit(0))

    def spans(group: Column) -> Column:
        last = F.substring_index(group, "#", -1).cast("int")
        marked = F.regexp_extract_all(group, F.lit(r"@(\d+[RC])"), F.lit(1))
        return F.transform(marked, lambda m: F.struct(F.regexp_extract(m, r"\d+", 0).cast("int").alias("first"), last.alias("last"), m.endswith("R").alias("is_row")))

    return F.array_sort(F.flatten(F.transform(groups, spans)))


def folded_rows(html: Column) -> Column:
    """array<array<string>>: raw cell texts of each row, by the fold."""

    def of_page(t: Column, spans: Column) -> Column:
        def cell(c: Column) -> Column:
            parts = F.slice(t, c["first"] + 2, F.greatest(c["last"] - c["first"] - 1, F.lit(0)))
            return F.array_join(F.transform(parts, lambda x: F.when(x["kind"] == "text", x["text"]).otherwise(F.lit(BREAK))), "")

        rows = F.filter(spans, lambda e: e["is_row"])
        cells = F.filter(spans, lambda e: ~e["is_row"])
        inner = lambda r: F.transform(F.filter(cells, lambda c: (c["first"] > r["first"]) & (c["first"] < r["last"])), cell)
        return F.transform(rows, inner)

    # tokens and spans are computed once: each is handed on as the one element of an array
    toks = F.transform(F.array(tokens(html)), lambda t: F.struct(t.alias("t"), element_spans(t).alias("s")))
    return F.get(F.transform(toks, lambda x: of_page(x["t"], x["s"])), F.lit(0))


def plain_rows(body: Column) -> Column:
    """The same for the rows of a ``tbody`` that ``_PLAIN_TABLE`` has matched."""
    rows = F.regexp_extract_all(body, F.lit(r"(?i)<tr\b([\s\S]*?)</tr\s*>"), F.lit(1))
    cell = F.lit(rf"(?i)<(?:td|th)(?:\s{_PLAIN})?>([^<]*+)</")
    return F.transform(rows, lambda r: F.regexp_extract_all(r, cell, F.lit(1)))


def raw_table_rows(html: Column) -> Column:
    """array<array<string>>: raw cell texts (``raw_text`` gives the text) of each row that has cells."""
    one = (F.regexp_count(html, F.lit(_CLASS)) == 1) & ~html.rlike(_HIDES)
    # from the only element of that class on, if it is a table
    body = F.when(one, F.regexp_extract(F.regexp_extract(html, rf"(?i)<table(?=\s)[^<>]*{_CLASS}[\s\S]*", 0), rf"^{_PLAIN_TABLE}", 1))
    none = F.array().cast("array<array<string>>")
    rows = F.when(~F.coalesce(html.rlike(rf"(?i)<table[\s/]"), F.lit(False)) | ~html.rlike(_CLASS), none)

    def of_body(b: Column) -> Column:
        return rows.when(b != "", plain_rows(b)).otherwise(folded_rows(html))

    # the match is made once: it is handed on as the one element of an array
    found = F.get(F.transform(F.array(body), of_body), F.lit(0))
    return F.filter(found, lambda c: F.size(c) > 0)


def table_rows(html: Column) -> Column:
    """array<array<string>>: cell texts of each row of the first ``table.data``."""
    return F.transform(raw_table_rows(html), lambda r: F.transform(r, raw_text))


def _raw_rows(pages: DataFrame, html_col: str, keys: list[str] | None) -> DataFrame:
    """``keys..., row_pos, _raw``. The page is computed once, behind a one-row generator."""
    one = pages.select(*(keys or []), F.inline(F.array(F.struct(F.col(html_col).alias("_html")))))
    return one.select(*(keys or []), F.posexplode(raw_table_rows(F.col("_html"))).alias("row_pos", "_raw"))


def html_table_rows(pages: DataFrame, html_col: str = "html", keys: list[str] | None = None) -> DataFrame:
    """One output row per table row: ``keys..., row_pos, cells``."""
    return _raw_rows(pages, html_col, keys).select(*(keys or []), "row_pos", F.transform("_raw", raw_text).alias("cells"))


def picked_cells(pages: DataFrame, picks: list[int], html_col: str = "html", keys: list[str] | None = None) -> DataFrame:
    """``keys..., cells``: of each table row the cells numbered ``picks`` (NULL where the row is too short).
    Only those are decoded and stripped."""
    cells = F.transform(F.array(*[F.get("_raw", F.lit(i)) for i in picks]), raw_text)
    return _raw_rows(pages, html_col, keys).select(*(keys or []), F.inline(F.array(F.struct(cells.alias("cells")))))


def html_items(pages: DataFrame, tag: str = "li", html_col: str = "html", keys: list[str] | None = None) -> DataFrame:
    """One output row per ``tag`` element: ``keys..., item_pos, item_text``."""
    keys = keys or []
    return pages.select(
        *keys, F.posexplode(element_texts(F.col(html_col), tag)).alias("item_pos", "item_text")
    )
