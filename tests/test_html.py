import datetime as dt
import random
from html.entities import html5
from html.parser import HTMLParser

from pyspark.sql import functions as F

from conftest import rows
from hydrocal.operators.barometer import ampm_readings, daily_barometer
from hydrocal.functions.text import decode_references
from hydrocal.sources.html_tables import VOID, html_items, html_table_rows, table_rows


def row(day, am, pm, n=23):
    cells = [f"<td>{day}</td>"] + ["<td>x</td>"] * 14 + [f"<td>{am}</td>"] + ["<td>y</td>"] * 5 + [f"<td>{pm}</td>", "<td>z</td>"]
    return "<tr>" + "".join(cells[:n]) + "</tr>"


PAGE = (
    "<html><body><table class='other'><tbody>" + row("9", "1.0", "1.0") + "</tbody></table>"
    '<table class="data wide"><thead><tr><th>Date</th></tr></thead><tbody>'
    + row("1", "1013.2", "1011.0")
    + row("2", "", "1009.5")
    + row("3", "<span> 1012.<b>5</b> </span>", "0")
    + row("Mean", "1000", "1000")
    + row("4", "1008.0", "1007.0", n=10)
    + row("31", "1000.0", "1000.0")
    + "<tr></tr></tbody></table>"
    '<table class="data"><tbody>' + row("5", "1.0", "1.0") + "</tbody></table></body></html>"
)


def test_table_rows_first_data_table_only(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, "<p>no table</p>")], "page_id int, html string")
    out = html_table_rows(pages, keys=["page_id"])
    firsts = [r.cells[0] for r in out.orderBy("row_pos").collect()]
    assert firsts == ["1", "2", "3", "Mean", "4", "31"]


def test_ampm_to_daily_barometer(spark):
    pages = spark.createDataFrame([(1, PAGE)], "page_id int, html string")
    readings = ampm_readings(pages, 4, 2026)
    assert rows(readings, "date_text", "time_text", "hpa_text") == [
        ("01/04/2026", "12:00:00", "1013.2"),
        ("01/04/2026", "18:00:00", "1011.0"),
        ("02/04/2026", "18:00:00", "1009.5"),
        ("03/04/2026", "12:00:00", "1012.5"),
        ("31/04/2026", "12:00:00", "1000.0"),
        ("31/04/2026", "18:00:00", "1000.0"),
    ]
    daily = daily_barometer(readings)
    assert rows(daily, "day", "bom_hpa") == [
        (dt.date(2026, 4, 1), 1013.2),
        (dt.date(2026, 4, 2), 1009.5),
        (dt.date(2026, 4, 3), 1012.5),
    ]


def test_html_items(spark):
    pages = spark.createDataFrame([(1, "<ul><li>a</li><li> b <i>c</i></li></ul>")], "page_id int, html string")
    assert rows(html_items(pages, keys=["page_id"]), "item_pos", "item_text") == [(0, "a"), (1, "bc")]


def test_table_markup_variants(spark):
    cells = "".join(f"<TD align=right>{c}</TD>" for c in ["x"] * 14)
    page = (
        "<HTML><TABLE CLASS=data><TBODY>"
        f"<TR><TH scope='row'> 7 </TH>{cells}<td>1012<!-- c -->.5&nbsp;</td>" + "<td>y</td>" * 5 + "<td>&#49;</td></TR>"
        "</TBODY></TABLE></HTML>"
    )
    pages = spark.createDataFrame([(1, page)], "page_id int, html string")
    [row] = html_table_rows(pages).collect()
    assert row.cells[0] == "7" and row.cells[15] == "1012.5" and len(row.cells) == 22
    assert rows(ampm_readings(pages, 4, 2026), "date_text", "time_text", "hpa_text") == [("07/04/2026", "12:00:00", "1012.5"), ("07/04/2026", "18:00:00", "1")]


def test_class_list_must_contain_data_word(spark):
    body = "<tbody><tr><td>1</td></tr></tbody>"
    pages = spark.createDataFrame(
        [(1, f'<table class="metadata">{body}</table>'), (2, f'<table class="x data y">{body}</table>')],
        "page_id int, html string",
    )
    assert rows(html_table_rows(pages, keys=["page_id"]), "page_id") == [(2,)]


# ---- against a lenient parser: the standard library's tokens, and a stack of open elements ----


class Tree(HTMLParser):
    """Elements as [name, classes, parent, children]; text strings and None (comments) are children too."""

    def __init__(self, html):
        super().__init__(convert_charrefs=False)
        self.root = self.top = ["", [], None, []]
        self.open, self.closed = [], []
        self.feed(html)
        self.close()

    def say(self, text):
        kids = self.top[3]
        if kids and isinstance(kids[-1], str):
            kids[-1] += text
        else:
            kids.append(text)

    handle_data = say

    def handle_comment(self, data):
        self.top[3].append(None)

    handle_decl = handle_pi = unknown_decl = handle_comment

    def handle_charref(self, name):
        n = int(name[1:], 16) if name[0] in "xX" else int(name)
        if 128 <= n < 256:
            self.say(bytes([n]).decode("cp1252", "ignore") or chr(n))
        else:
            self.say(chr(n) if 0 < n < 0x110000 and not 0xD800 <= n < 0xE000 else "\ufffd")

    def handle_entityref(self, name):
        self.say(html5.get(name + ";", "&" + name))

    def handle_starttag(self, name, attrs):
        self.top = ["".join(name), (dict(attrs).get("class") or "").split(), self.top, []]
        self.top[2][3].append(self.top)
        if name in VOID:
            self.handle_endtag(name)

    def handle_startendtag(self, name, attrs):
        self.handle_starttag(name, attrs)
        if name not in VOID:
            self.handle_endtag(name)

    def handle_endtag(self, name):
        at = self.top
        while at[2] is not None and at[0] != name:
            at = at[2]
        if at[2] is not None:
            self.top = at[2]

    def inner(self, at):
        for k in at[3]:
            if isinstance(k, list):
                yield k
                yield from self.inner(k)

    def text(self, at):
        return "".join(k.strip() if isinstance(k, str) else self.text(k) if k and k[0] not in ("script", "style") else "" for k in at[3])

    def rows(self):
        table = next((e for e in self.inner(self.root) if e[0] == "table" and "data" in e[1]), None)
        out = []
        for tr in self.inner(table) if table else ():
            up, bodies = tr, 0
            while tr[0] == "tr" and (up := up[2]) is not None:
                bodies += up[0] == "tbody"
            cells = [self.text(c) for c in self.inner(tr) if c[0] in ("td", "th")] if bodies else []
            if cells:
                out.append(cells)
        return out


def odd_page(rng):
    word = lambda: rng.choice(["1", " 2 ", "x", "&amp;lt;", "&#49;", "&#x31;", "&deg;", "&nbsp;", "&nosuch;", "&#150;", "&eacute", "é", "&amp;", "& ", "-5&deg;", "&copy;&reg;", "&ngE;", "&#0;", "&#1114112;"])

    def cell(depth):
        tag = rng.choice(["td", "td", "th", "TD"])
        body = "".join(rng.choice([word(), word(), "<!-- <td>9</td> -->", "<b>" + word() + "</b>", "<br>", "<br/>", "<i>", "</i>", "</p>", "<script>var a='<td>3</td>'</script>", table(depth + 1) if depth < 2 else ""]) for _ in range(rng.randint(0, 3)))
        return f"<{tag}{rng.choice(['', ' class=data', ' title=\"a>b\"'])}>{body}" + (f"</{tag}>" if rng.random() < 0.75 else "")

    def table(depth=0):
        rows = "".join("<tr>" + "".join(cell(depth) for _ in range(rng.randint(0, 4))) + rng.choice(["</tr>", "</tr>", "", "<td/>"]) for _ in range(rng.randint(0, 3)))
        body = rng.choice(["<tbody>{}</tbody>", "<tbody>{}</tbody>", "<thead><tr><th>h</th></tr></thead><tbody>{}", "{}"]).format(rows)
        return rng.choice(["<table class='data'>", '<table id="x" class="wide data">', "<TABLE CLASS=data>", "<table>", "<table class=metadata>"]) + body + rng.choice(["</table>", "</table>", "</div>", ""])

    parts = ["<p>a</p>", "<div>", "</div>", "<!-- " + table() + " -->", "<style>table.data{}</style>", "<!doctype html>", "<tbody>", "<td>", "text", table(), table(), table()]
    return "".join(rng.choices(parts, k=rng.randint(1, 6)))


def test_tables_equal_a_lenient_parser(spark):
    rng = random.Random(17)
    texts = [odd_page(rng) for _ in range(1500)]
    got = {r.i: r.rows for r in spark.createDataFrame(list(enumerate(texts)), "i int, html string").select("i", table_rows(F.col("html")).alias("rows")).collect()}
    used = 0
    for i, text in enumerate(texts):
        want = Tree(text).rows()
        used += bool(want)
        assert got[i] == want, text
    assert used > 400


def test_plain_pages_need_no_fold(spark):
    pages = [PAGE.replace("<span> 1012.<b>5</b> </span>", "1012.5").replace('<table class="data"><tbody>', "<table><tbody>"), PAGE]
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    plain, odd = [r[0] for r in df.orderBy("i").select(table_rows(F.col("html"))).collect()]
    assert plain == Tree(pages[0]).rows() and odd == Tree(pages[1]).rows() and len(plain) == 6


def test_all_named_references(spark):
    names = sorted(n for n in html5 if n.endswith(";"))
    df = spark.createDataFrame([(n, f"a&{n}b") for n in names], "name string, t string")
    assert {r.name: r.x for r in df.select("name", decode_references(F.col("t")).alias("x")).collect()} == {n: f"a{html5[n]}b" for n in names}
    cases = {"&amp;lt;": "&lt;", "&#49;013": "1013", "&#X41;": "A", "&#x1F600;": "😀", "-5&deg;": "-5°", "&nosuch;": "&nosuch", "&": "&", "a & b": "a & b", "&#;": "&#;", "&#128;": "€", "&#99999999999;": "\ufffd", "&lt": "<"}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r.t: r.x for r in df.select("t", decode_references(F.col("t")).alias("x")).collect()} == cases
