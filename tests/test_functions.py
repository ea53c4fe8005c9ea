"""Text and date expressions against Python's own behaviour."""

import html
import html.entities
import random
from datetime import UTC, datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from topicloom.functions import dates as D
from topicloom.functions import text as T
from topicloom.functions import udf
from topicloom.functions.entities import unescape

TEXTS = ["", " ", "a", "Ice police", "a b c \x1c d", "İstanbul ΟΔΟΣ", "x " * 50, "x " * 51, "a  b\tc\n" * 20, "w " * 60, "&amp;lt; &lt;b&gt; &#39;", None]


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"k int, v {kind}")
    return [r["o"] for r in df.select("k", expression(F.col("v")).alias("o")).orderBy("k").collect()]


def shorten(text, most=50):
    w = text.split()
    return text if len(w) <= most else " ".join(w[:most]) + "..."


def test_words_like_python(spark):
    assert column(spark, TEXTS, T.words) == [(t or "").split() for t in TEXTS]
    assert column(spark, TEXTS, T.word_count) == [len((t or "").split()) for t in TEXTS]
    assert column(spark, TEXTS, T.trim) == [None if t is None else t.strip() for t in TEXTS]
    assert column(spark, TEXTS[:-1], T.truncate_words) == [shorten(t) for t in TEXTS[:-1]]


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.text(alphabet="ab \t\n\x0b\x1f\x85\xa0 .<>&;", max_size=300), min_size=1, max_size=20))
def test_truncation_and_trim_properties(spark, texts):
    short = column(spark, texts, lambda c: T.truncate_words(c, 5))
    assert short == [shorten(t, 5) for t in texts]
    assert column(spark, texts, T.trim) == [t.strip() for t in texts]


def test_occurrences(spark):
    texts = ["aaaa", "ababab", "", "ice police icicle", None]
    for k in ("a", "aa", "ab", "ice"):
        assert column(spark, texts, lambda c: T.occurrences(c, k)) == [None if t is None else t.count(k) for t in texts]  # noqa: B023


def test_matches(spark):
    rows = [("Ice skating", ""), ("x", "ICE and ice"), ("x", "ice once, rink once"), ("police", None), (None, "rink"), ("", "")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "k int, title string, body string")
    flags = lambda c: [r[0] for r in df.orderBy("k").select(c).collect()]
    t, b = F.col("title"), F.col("body")
    assert flags(T.loose_match(["ICE"], t, b)) == [True, True, True, True, False, False]
    assert flags(T.broad_match(["ice", "rink"], ["skat"], t, b)) == [False, True, True, True, True, False]
    assert flags(T.strict_match(["ice", "rink"], t, b)) == [True, True, False, True, False, False]
    assert flags(T.strict_match([], t, b)) == [True] * 6 and flags(T.strict_match([], t, b, empty=False)) == [False] * 6
    assert flags(T.loose_match([], t, b)) == [False] * 6
    assert flags(T.first_match(t, ["skat", "Ice", "police"])) == ["skat", None, None, "police", None, None]


def test_urls_and_names(spark):
    urls = ["https://www.a.com/x", "http://u@www.b.org:80/?q#f", "a.com", "", "http://[bad", None]
    assert column(spark, urls, T.domain) == ["a.com", "u@b.org:80", "unknown", "unknown", "unknown", "unknown"]
    names = ["www.short.com", "a.co.uk", "averyveryverylongoutletname.org"]
    assert column(spark, names, T.display_name) == ["short", "a", "averyveryverylongoutle..."]
    assert column(spark, ["a", "", None], lambda c: T.falsy(c, F.lit("z"))) == ["a", "z", "z"]


def test_markup(spark):
    pages = ["<p>a&amp;b</p>  <b>c</b>", "a &lt;b&gt; c", "&amp;lt;", "x<br>y&nbsp;z"]
    assert column(spark, pages, T.strip_html) == [" ".join(html.unescape(__import__("re").sub("<[^>]+>", " ", p)).split()) for p in pages]
    assert column(spark, ["&eacute;&#x41;&amp;", None], unescape) == ["éA&", None]
    assert column(spark, ["<html><title> T </title>"], T.html_title) == ["T"]


PAGES = {
    "<title>A<b>x</b></title>": (None, None),
    "<title> A </title><title>B</title>": ("A", None),
    '<meta property="og:title" content=" "><meta name="twitter:title" content="Tw"><title>A</title>': ("Tw", None),
    '<meta property="og:title" content="Og"><meta property="og:title" content="Two"><meta property="og:description" content="od"><meta name="description" content="">': ("Og", "od"),
    '<meta name="description" content=" d &amp; e "><meta name="twitter:description" content="t">': (None, "d & e"),
}


def test_page_metadata(spark):
    assert {p: udf.page_metadata(p) for p in PAGES} == PAGES and udf.page_metadata(None) == (None, None)
    got = column(spark, list(PAGES), udf.html_metadata)
    assert [tuple(r) for r in got] == list(PAGES.values())


def test_language_is_pluggable(spark):
    texts = ["The cat is in the house and it was on the mat", "Le chat est dans la maison et il est sur le lit", "short", "zzzz qqqq xxxx wwww vvvv"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k int, t string")
    run = lambda detector: [r[0] for r in df.orderBy("k").select(udf.is_english(F.col("t"), F.lit(None).cast("string"), detector)).collect()]
    assert run(lambda t: "en" if "the" in t else None if "zz" in t else "fr") == [True, False, True, True]
    assert run(lambda t: "fr") == [False, False, True, False]


REFERENCES = [
    "&amp;lt; &lt &ltx &notit; &notin; &nosuch; & && &; &#; &#x; &#65 &#x41;B &#x110000; &#xD800; &#0; &#128; &#x81; &#13; &#1; &#11; &#xFDD0; &#x1FFFF; &#000000000000065; &#99999999999;",
    "&Eacute;&eacute &NotEqualTilde; &acE; &frac12;&frac34 &AMP &amp&amp;&amp &CounterClockwiseContourIntegral; &a.b; &lt.foo é&日; &#X1F600;",
    "no reference", "", "&", "a&b", "&#38;amp;", "&copy\n&reg\t&nbsp;x", "&\u00e9; &<&gt;>",
]


def test_references_as_the_standard_has_them(spark):
    rng = random.Random(1)
    some = rng.sample(sorted(html.entities.html5), 300)
    texts = [*REFERENCES, *["".join(rng.choice(["&", ";", "#", "x", "amp", "lt", "not", "1", "41", " ", *rng.sample(some, 2)]) for _ in range(12)) for _ in range(300)], *[f"&{n} &{n}x &#{k};&#x{k:x} " for k, n in enumerate(some)]]
    assert column(spark, texts, unescape) == [html.unescape(t) for t in texts]


#: Date strings, the second (UTC, from 1970) and the writer's day that they name; None where they can't be read.
DATES = {
    "Tue, 02 Jan 2024 23:30:00 -0500": (1704256200, "2024-01-02"),
    "Tue, 2 Jan 2024 01:00:00 GMT": (1704157200, "2024-01-02"),
    "mon, 05 JAN 2026 7:05:09 +05:30": (1767576909, "2026-01-05"),
    "Mon,  5 jan 2026 07:05:09 utc": (1767596709, "2026-01-05"),
    "2024-01-02T01:00:00+02:00": (1704150000, "2024-01-02"),
    "2024-01-02T01:00:00Z": (1704157200, "2024-01-02"),
    "2024-1-2t1:00:00z": (1704157200, "2024-01-02"),
    " 2024-01-02 03:04:05 ": (1704164645, "2024-01-02"),
    "2026-1-5": (1767571200, "2026-01-05"),
    "2024-01-02": (1704153600, "2024-01-02"),
    "2024-02-30": None,
    "02 Jan 2024 01:00:00 GMT": None,
    "2024-01-02T01:00:00.5Z": None,
    "Tue, 02 Jan 2024 01:00:00 EST": None,
    "2024-jan-02": None,
    "@2024-1-2 3:4:5 +0000": None,
    "": None,
    None: None,
    "soon": None,
}


def test_dates(spark):
    at = [v and v[0] for v in DATES.values()]
    assert column(spark, list(DATES), lambda c: F.unix_seconds(D.instant(c))) == at
    assert column(spark, list(DATES), D.wall_date) == [v and v[1] for v in DATES.values()]
    cutoff = F.lit("2024-01-02 00:00:00").cast("timestamp")
    assert column(spark, list(DATES), lambda c: D.recent(c, cutoff)) == [v is None or v >= 1704153600 for v in at]


def test_labels(spark):
    assert column(spark, ["2024-01-02T03:04:05Z"], D.stamp_label) == ["2024-01-02 03:04:05"]
    assert column(spark, ["2024-01-02 03:04:05"], lambda c: D.utc_label(c.cast("timestamp"))) == ["2024-01-02 03:04 UTC"]
    day = lambda x: F.lit(x).cast("date")
    assert [str(v) for v in column(spark, ["x"], lambda c: D.window_start(day("2024-01-01"), day("2024-01-10"), 3))] == ["2024-01-08"]
    assert [str(v) for v in column(spark, ["x"], lambda c: D.window_start(day("2024-01-09"), day("2024-01-10"), 3))] == ["2024-01-09"]


@pytest.mark.parametrize(("count", "width"), [(1, 1), (7, 3)])
def test_bar(spark, count, width):
    assert column(spark, [count], lambda c: T.bar(c, F.lit(7), width), "int") == ["█" * max(1, int(count / 7 * width))]


def test_capitals_are_letter_by_letter_as_in_sql(spark):
    import duckdb

    values = ["Straße", "ß", "ŉ\nﬁn ΐ ᾀ ᾈ ᾳ", "größer ẞ ǆ ı é a1", "plain", "", None, T.MANY]
    want = [duckdb.execute("SELECT upper(?)", [v]).fetchone()[0] for v in values]
    assert column(spark, values, T.capitals) == want
    assert want[0] == "STRAẞE"
