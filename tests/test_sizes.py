"""What a step holds and moves, beside its results."""

from pyspark.sql import functions as F

from topicloom.operators import languages, within


def test_texts_do_not_travel_with_their_ngrams(spark):
    long = "".join(chr(97 + k * k % 26) + chr(97 + k // 26 % 26) for k in range(15000))
    values = [(1, "a storm at sea"), (1, "a storm at sea"), (1, "other"), (None, "storms"), (2, long), (3, None), (4, "ab")]
    keys = ["storm", "sea", "a", "ab", long[500:900], long[:3], "", None, "no such"]
    texts, words = spark.createDataFrame(values, "k long, t string"), spark.createDataFrame([(w,) for w in keys], "w string")
    want = sorted({(k, w) for k, t in values for w in keys if t and w and w in t}, key=repr)
    for sent in (1 << 20, 0):  # keys sent to the tasks, and joined
        found = within.contained(texts, words, "k", "t", "w", sent=sent)
        assert sorted(map(tuple, found.collect()), key=repr) == want
    plan = within.contained(texts, words, "k", "t", "w")._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan.split("BroadcastHashJoin")[0]  # texts meet keys where they are read


def test_trigrams_are_of_whole_characters(spark):
    values = ["a😀b😀 c", "ab", "", "é\n\n ü𝒳", "x" * 5, None]
    want = {}
    for t in values:
        t = " ".join((t or "").split())
        for k in range(len(t) - 2):
            want[t[k : k + 3]] = want.get(t[k : k + 3], 0) + 1
    run, languages.RUN = languages.RUN, 3
    try:
        got = [(int(c), int(k)) for some in languages.codes_of(["abcdefghij", None, "xy", "abcd"]) for c, k in zip(*some, strict=True)]
    finally:
        languages.RUN = run
    number = lambda g: (ord(g[0]) << 42) | (ord(g[1]) << 21) | ord(g[2])
    assert got == [(number(t[k : k + 3]), n) for n, t in ((0, "abcdefghij"), (3, "abcd")) for k in range(len(t) - 2)]
    known = languages.profile(spark.createDataFrame([(t, "en") for t in values], "t string, l string"), "t", "l")
    found = {r["gram"]: r["share"] for r in known.select("gram", F.exp("log_share").alias("share")).collect()}
    total = sum(want.values()) + languages.KEPT
    assert {g: round(s * total) - 1 for g, s in found.items()} == want
