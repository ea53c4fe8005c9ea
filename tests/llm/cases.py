"""Small documents with the awkward cases: null, empty and very long texts, ties, repeated rows, clashing columns."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, n_words long"


def rows(extra=()):
    rng = random.Random(7)
    words = ["alpha", "beta", "gamma", "Delta", "éta", "the", "of", "İstanbul", "ſecret", "naïve", "x1", "日本語", "no break", "áb"]
    prose = lambda n: " ".join(rng.choice(words) + rng.choice(["", "", ".", ",", "\n"]) for _ in range(n))
    long, passage = prose(6000), prose(60)
    texts = [None, "", " \t\n", "!!!", "alpha", prose(3), prose(40), long, long, passage, passage + " " + prose(20), prose(20) + "\n" + passage, "a " * 300, prose(200), prose(200), "12345 ²", *extra]
    out = [(i, t, ["en", "fr", None][i % 3], ["s", "s", None, "r"][i % 4], len(t or ""), 0.5, 9) for i, t in enumerate(texts)]
    return [*out, out[9], out[9], out[0], (None, texts[6], "en", None, 1, 0.5, 9), (None, None, None, None, None, None, None)]


def frame(spark, extra=()):
    return spark.createDataFrame(rows(extra), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_text(found, given):
    """Rows of a result in the order of their ids, beside those given; both as sorted lists."""
    return sorted(map(repr, found)), sorted(map(repr, given))
