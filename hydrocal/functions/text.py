"""String Column expressions."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that count as white space at the ends of text, as in the reference's text handling.
SPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
#: Stands for a tag or comment inside a raw text: text on both sides is stripped on its own.
BREAK = "\x00"
_REFERENCE = r"^&(#[0-9]+|#[xX][0-9a-fA-F]+|[a-zA-Z][-.a-zA-Z0-9]*);?"


def _named() -> dict[str, str]:
    """Name -> text of all named references, from the standard library's table."""
    return {name[:-1]: text for name, text in html5.items() if name.endswith(";")}


def decode_references(text: Column) -> Column:
    """named, decimal and hexadecimal character references, in one pass, so that ``&amp;lt;`` stays
    ``&lt;``. Numbers from 128 to 255 mean Windows-1252 characters; numbers that are none give U+FFFD; an
    unknown name keeps its ``&`` and loses its semicolon."""
    table = _named()
    common = ("nbsp", "amp", "lt", "gt", "quot", "deg")  # met first: looking a name up in the map is a scan
    pairs = "\x02".join(f"{n}\x01{t}" for n, t in table.items() if n not in common)
    names = F.str_to_map(F.lit(pairs), F.lit("\x02"), F.lit("\x01"))  # folded into one constant
    western = F.lit("".join(bytes([i]).decode("cp1252", "ignore") or chr(i) for i in range(128, 256)))

    def piece(p: Column) -> Column:
        name = F.regexp_extract(p, _REFERENCE, 1)
        rest = F.regexp_replace(p, _REFERENCE, "")
        digits = F.when(F.lower(name).startswith("#x"), F.conv(F.substr(name, F.lit(3)), 16, 10)).otherwise(F.substr(name, F.lit(2)))
        code = digits.try_cast("int")
        valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        number = F.when(code.between(128, 255), F.substr(western, code - 127, F.lit(1))).when(valid, _character(code)).otherwise("\ufffd")
        known = F
        for n in common:
            known = known.when(name == n, F.lit(table[n]))
        known = known.otherwise(F.coalesce(F.try_element_at(names, name), F.concat(F.lit("&"), name)))
        decoded = F.when(name.startswith("#"), number).otherwise(known)
        return F.when(name == "", p).otherwise(F.concat(decoded, rest))

    return F.when(text.contains("&"), F.array_join(F.transform(F.split(text, "(?=&)"), piece), "")).otherwise(text)


def _character(code: Column) -> Column:
    """The character of a code point: its UTF-32 bytes decoded."""
    return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")


def raw_text(text: Column) -> Column:
    """Stripped, decoded text of a raw text with ``BREAK`` where tags and comments were."""
    return F.array_join(F.transform(F.split(text, BREAK), lambda x: F.trim(decode_references(x), F.lit(SPACE))), "")


def strip_tags(html: Column) -> Column:
    """text of all descendants of an element. Text between two tags or comments is decoded and
    stripped on its own, and joined without anything between."""
    return raw_text(F.regexp_replace(html, r"<!--[\s\S]*?-->|<[^>]*>", BREAK))


def base_name(path: Column) -> Column:
    """last path segment."""
    return F.regexp_extract(path, r"([^/]*)$", 1)


def file_stem(path: Column) -> Column:
    """File name without its last extension; leading dots never start an extension
    (``.env`` stays ``.env``, ``a.b.csv`` becomes ``a.b``)."""
    name = base_name(path)
    stem = F.regexp_extract(name, r"^(\.*[^.].*)\.[^.]*$", 1)
    return F.when(stem == F.lit(""), name).otherwise(stem)


def reason_text(reason: Column, run_ts: Column) -> Column:
    """``<reason> on dd/MM/yyyy HH:mm:ss``."""
    return F.concat(reason, F.lit(" on "), F.date_format(run_ts, "dd/MM/yyyy HH:mm:ss"))
