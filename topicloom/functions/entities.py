"""Character references of HTML decoded in the JVM, in one pass over a text, by the rules of the HTML standard."""

from __future__ import annotations

import json
from collections import defaultdict
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Pieces of a text: a reference, what lies between, or an ampersand alone.
PIECE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)|[^&]+|&"
#: Names that count without a semicolon, the longest first.
BARE = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
#: What numbers stand for that don't stand for themselves: those of Windows' code page, the carriage return, and zero.
MOVED = {0: "�", 0x0D: "\r"} | {c: bytes([c]).decode("cp1252", "replace").replace("�", chr(c)) for c in range(0x80, 0xA0)}
LAST = 0x10FFFF


def _mapped(found: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in found.items() for x in pair])


def _named(name: Column) -> Column:
    """What a name stands for; names are looked up by their first two letters, and then among few."""
    by_start: dict[str, dict[str, str]] = defaultdict(dict)
    for n, value in html5.items():
        by_start[n[:2]][n] = value
    every = F.from_json(F.lit(json.dumps(by_start)), "map<string,map<string,string>>")  # a constant, so it's read once
    return F.try_element_at(F.try_element_at(every, F.substring(name, 1, 2)), name)


def _numbered(piece: Column) -> Column:
    """The character of a numeric reference; nothing for numbers that are no characters."""
    hexadecimal = F.regexp_extract(piece, "^&#[xX]0*([0-9a-fA-F]*)", 1)
    decimal = F.regexp_extract(piece, "^&#0*([0-9]*)", 1)
    is_hex = F.regexp_like(piece, F.lit("^&#[xX]"))
    digits = F.when(is_hex, hexadecimal).otherwise(decimal)
    code = F.when(digits == "", F.lit(0)).when(F.length(digits) > 7, F.lit(LAST + 1)).when(is_hex, F.conv(digits, 16, 10).cast("int")).otherwise(digits.cast("int"))
    none = code.between(1, 8) | (code == 11) | code.between(14, 31) | (code == 127) | code.between(0xFDD0, 0xFDEF) | (code % 65536 >= 0xFFFE)
    whole = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return F.coalesce(F.try_element_at(_mapped(MOVED), code), F.when(code.between(0xD800, 0xDFFF) | (code > LAST), F.lit("�")).when(none, F.lit("")).otherwise(whole))


def _decoded(piece: Column) -> Column:
    name = F.substring(piece, 2, 40)
    bare = F.regexp_extract(name, f"^({'|'.join(BARE)})", 1)
    longest = F.when(bare != "", F.concat(_named(bare), F.substr(name, F.length(bare) + 1)))
    return F.when(~F.startswith(piece, F.lit("&")), piece).when(F.regexp_like(piece, F.lit("^&#([0-9]|[xX][0-9a-fA-F])")), _numbered(piece)).otherwise(F.coalesce(_named(name), longest, piece))


def unescape(value: Column) -> Column:
    """All named and numbered references decoded, each once. Texts without an ampersand stay as they are."""
    pieces = F.regexp_extract_all(value, F.lit(f"(?s){PIECE}"), 0)
    return F.when(F.contains(value, F.lit("&")), F.array_join(F.transform(pieces, _decoded), "")).otherwise(value)
