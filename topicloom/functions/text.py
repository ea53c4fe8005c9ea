"""Text expressions as Columns: white space, words, keyword matches, URLs, markup, hashes."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from topicloom.functions.entities import unescape

#: All white space of the Unicode standard and the four ASCII separators, for Java's regular expressions.
SPACE = r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
#: Parts of outlets' names that aren't shown, in the order of their removal.
ENDINGS = ("www.", ".com", ".org", ".co.uk", ".net")
#: Letters whose capital is several letters in whole texts, and the single letter that stands for it, or they themselves.
MANY = "".join(c for c in map(chr, range(0x80, 0x10000)) if len(c.upper()) > 1)
ONE = "".join("ẞ" if c == "ß" else c.title() if len(c.title()) == 1 else c for c in MANY)


def text_of(*columns: Column) -> Column:
    """Lower-cased columns joined by a space; null counts as empty."""
    return F.lower(F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in columns]))


def capitals(value: Column) -> Column:
    """A text in upper case letter by letter, so that it keeps its length: ß becomes ẞ, where ``upper`` writes SS."""
    pieces = F.regexp_extract_all(value, F.lit(f"[{MANY}]|[^{MANY}]+"), F.lit(0))
    raised = F.transform(pieces, lambda p: F.when(F.regexp_like(p, F.lit(f"[{MANY}]")), F.translate(p, MANY, ONE)).otherwise(F.upper(p)))
    return F.when(F.regexp_like(value, F.lit(f"[{MANY}]")), F.array_join(raised, "")).otherwise(F.upper(value))


def falsy(value: Column, other: Column) -> Column:
    """``value``, or ``other`` where it is null or empty."""
    return F.coalesce(F.nullif(value, F.lit("")), other)


def trim(value: Column) -> Column:
    """White space of any kind removed at both ends, which alone are looked at."""
    return F.trim(value, F.lit(SPACES))


def words(value: Column) -> Column:
    """Words between white space."""
    return F.filter(F.split(F.coalesce(value, F.lit("")), f"{SPACE}+"), lambda w: w != "")


def word_count(value: Column) -> Column:
    return F.regexp_count(F.coalesce(value, F.lit("")), F.lit(f"[^{SPACE[1:-1]}]+")).cast("long")


def truncate_words(value: Column, most: int = 50) -> Column:
    """A text of more than ``most`` words is cut and gets three full stops; a shorter one stays as it is. Only the head is split."""
    w = F.split(F.regexp_replace(F.coalesce(value, F.lit("")), f"^{SPACE}+", ""), f"{SPACE}+", most + 1)
    longer = (F.size(w) > most) & (F.element_at(w, -1) != "")
    return F.when(longer, F.concat(F.array_join(F.slice(w, 1, most), " "), F.lit("..."))).otherwise(value)


def occurrences(value: Column, keyword: str) -> Column:
    """How often a keyword stands in a text without overlaps."""
    gone = F.length(F.replace(value, F.lit(keyword), F.lit("")))
    return ((F.length(value) - gone) / F.lit(len(keyword))).cast("long")


def _either(patterns: list[str]) -> str:
    return "(?s)" + "|".join(patterns)


def _quoted(keyword: str) -> str:
    """A keyword in lower case as a pattern for itself."""
    return re.sub(r"([^\w\s])", r"\\\1", keyword.lower())


def loose_match(keywords: list[str], *columns: Column) -> Column:
    """Any keyword as a substring of the columns: one pattern, so that a text is put in lower case once."""
    return holds_any(keywords, text_of(*columns))


def holds_any(keywords: list[str], low: Column) -> Column:
    """Any keyword as a substring of a text in lower case."""
    return F.regexp_like(low, F.lit(_either([_quoted(k) for k in keywords]))) if keywords else F.lit(False)


def broad_match(include: list[str], exclude: list[str] | None, title: Column, description: Column) -> Column:
    """Any keyword to include and none to exclude in title and description."""
    found = loose_match(include, title, description)
    return found & ~loose_match(exclude, title, description) if exclude else found


def strict_match(keywords: list[str], title: Column, description: Column, empty: bool = True) -> Column:
    """A keyword in the title, or one keyword twice in the description, without overlaps. ``empty``: the verdict without keywords."""
    return strict_in(keywords, text_of(title), text_of(description), empty)


def strict_in(keywords: list[str], low_title: Column, low_description: Column, empty: bool = True) -> Column:
    """The same of texts in lower case."""
    if not keywords:
        return F.lit(empty)
    twice = F.regexp_like(low_description, F.lit(_either([f"{_quoted(k)}.*?{_quoted(k)}" for k in keywords])))
    return holds_any(keywords, low_title) | twice


def first_match(value: Column, keys: list[str]) -> Column:
    """The first configured key that is a substring; null if none is."""
    return F.coalesce(*[F.when(F.contains(value, F.lit(k)), F.lit(k)) for k in keys])


def domain(url: Column) -> Column:
    """Host part with port, every ``www.`` removed; 'unknown' if there is none or the URL is bad."""
    return falsy(F.replace(F.coalesce(F.try_parse_url(url, F.lit("AUTHORITY")), F.lit("")), F.lit("www."), F.lit("")), F.lit("unknown"))


def display_name(outlet: Column) -> Column:
    """An outlet's name without www. and endings, cut to 25 characters."""
    short = outlet
    for part in ENDINGS:
        short = F.replace(short, F.lit(part), F.lit(""))
    return F.when(F.length(short) > 25, F.concat(F.substring(short, 1, 22), F.lit("..."))).otherwise(short)


def strip_html(value: Column) -> Column:
    """Tags become spaces, then all entities are decoded, then white space is collapsed."""
    return trim(F.regexp_replace(unescape(F.regexp_replace(value, "<[^>]+>", " ")), f"{SPACE}+", " "))


def html_title(html: Column) -> Column:
    """The title of a well-formed page."""
    return trim(F.regexp_extract(html, "<title>([^<]*)</title>", 1))


def sha256_id(url: Column) -> Column:
    return F.sha2(F.coalesce(url, F.lit("")), 256)


def query_hash(query: Column) -> Column:
    """The first 12 digits of an MD5."""
    return F.substring(F.md5(query), 1, 12)


def inverted_digits(value: Column) -> Column:
    return F.translate(value, "0123456789", "9876543210")


def preview(value: Column, most: int = 100) -> Column:
    return F.when(F.length(value) > most, F.concat(F.substring(value, 1, most), F.lit("..."))).otherwise(value)


def bar(count: Column, largest: Column, width: int) -> Column:
    """Blocks in proportion to a count, one at least."""
    return F.repeat(F.lit("█"), F.greatest(F.lit(1), F.floor(count / largest * width).cast("int")))
