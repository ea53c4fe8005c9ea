"""Row operators, summaries and coverage against plain loops."""

import random
from collections import Counter
from datetime import date, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from topicloom.operators import coverage, languages, rows, summary, within
from topicloom.plans import articles as plans

SLOW = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
ROWS = [(0, "a", "x"), (1, "", "x"), (2, None, "y"), (3, "a", None), (4, "b", "x"), (5, "b", "z"), (6, "c", "x")]


def frame(spark, data=ROWS):
    return spark.createDataFrame(data, "pos long, url string, tag string")


def positions(df):
    return sorted(r["pos"] for r in df.collect())


def test_first_and_last(spark):
    df = frame(spark)
    assert positions(rows.first_wins(df, "url", "pos")) == [0, 4, 6]
    assert positions(rows.first_wins(df, "url", "pos", blank=True)) == [0, 1, 2, 4, 6]
    assert positions(rows.last_wins(df, "url", "pos")) == [1, 3, 5, 6]
    assert sorted(map(tuple, rows.distinct_in_order(df, "url", "pos").collect())) == [("a", 0), ("b", 4), ("c", 6)]
    once = rows.first_wins(df, "url", "pos")
    assert positions(rows.first_wins(once, "url", "pos")) == positions(once)


def test_unseen_knows_null(spark):
    store = frame(spark, [(9, None, None), (10, "c", None)])
    assert positions(rows.unseen(frame(spark), store, "url")) == [0, 1, 3, 4, 5]
    assert positions(rows.append_unseen(store, frame(spark), "url")) == [0, 1, 3, 4, 5, 9, 10]
    assert positions(rows.append_unseen(store, frame(spark), "url", dedupe_pos="pos")) == [0, 1, 4, 9, 10]
    assert positions(rows.accepted_first(frame(spark), F.col("tag") == "x", "url", "pos", store)) == [0, 4]


def test_lookup(spark):
    right = spark.createDataFrame([(0, "a", "old", 1), (1, "a", None, 2), (2, "b", "new", 3), (3, None, "n", 4)], "pos long, url string, tag string, extra int")
    kept = {r["pos"]: (r["tag"], r["extra"]) for r in rows.lookup(frame(spark), right, "url", "pos", ["tag", "extra"]).collect()}
    assert kept == {0: ("x", 2), 1: ("x", None), 2: ("y", None), 3: (None, 2), 4: ("x", 3), 5: ("z", 3), 6: ("x", None)}
    over = {r["pos"]: r["tag"] for r in rows.lookup(frame(spark), right, "url", "pos", ["tag"], override=True).collect()}
    assert over == {0: None, 1: "x", 2: "y", 3: None, 4: "new", 5: "new", 6: "x"}
    with pytest.raises(Exception, match="IntegrityError: a row without a match, c"):
        rows.checked_lookup(frame(spark).where("url in ('a', 'c')"), right, "url", "pos", ["extra"]).collect()
    assert rows.checked_lookup(frame(spark).where("url = 'a'"), right, "url", "pos", ["extra"]).count() == 2


def test_enrich_and_pending(spark):
    scraped = spark.createDataFrame([(0, "a", "t", True), (1, "b", None, False)], "pos long, url string, title string, success boolean")
    records = frame(spark).withColumn("title", F.lit("own")).withColumn("success", F.lit(None).cast("boolean"))
    out = {r["pos"]: (r["title"], r["success"], r["error"]) for r in rows.enrich(records, scraped, "url", "pos", ["title", "success"]).collect()}
    assert out[0] == ("t", True, None) and out[4] == (None, False, None) and out[1] == ("own", False, "missing url") and out[6] == ("own", None, None)
    assert positions(rows.pending(frame(spark), scraped, "url")) == [1, 2, 6]
    assert positions(rows.pending(frame(spark), scraped, "url", retry_failed=True)) == [1, 2, 4, 5, 6]


def test_merge_maps(spark):
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
    try:
        df = spark.range(1).select(rows.merge_maps(F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("2")), F.create_map(F.lit("a"), F.lit(None).cast("string"))).alias("m"))
        assert df.first()["m"] == {"a": None, "b": "2"}
    finally:
        spark.conf.unset("spark.sql.mapKeyDedupPolicy")


def sequential_reasons(data, existing):
    seen, out = set(existing), {}
    for pos, url, ok, indexed, english, broad, strict in data:
        if not ok:
            out[pos] = "not_success"
        elif not url:
            out[pos] = "missing_url"
        elif url in seen:
            out[pos] = "already_exists"
        elif not indexed:
            out[pos] = "missing_in_index"
        elif not english:
            out[pos] = "non_english"
        elif not broad:
            out[pos] = "off_topic"
        elif not strict:
            out[pos] = "not_relevant"
        else:
            out[pos] = "added"
            seen.add(url)
    return out


@SLOW
@given(seed=st.integers(0, 10**6))
def test_reasons_like_a_loop(spark, seed):
    rng = random.Random(seed)
    data = [(i, rng.choice(["a", "b", "c", "", None]), *[rng.random() < 0.7 for _ in range(5)]) for i in range(60)]
    existing = {"c"} if seed % 2 else set()
    df = spark.createDataFrame(data, "pos long, url string, ok boolean, idx boolean, en boolean, br boolean, st boolean")
    found = rows.filter_reasons(df, "url", "pos", F.col("ok"), F.col("idx"), F.col("en"), F.col("br"), F.col("st"), F.col("url").isin(*existing) if existing else None)
    assert {r["pos"]: r["reason"] for r in found.collect()} == sequential_reasons(data, existing)
    assert sum(r["n"] for r in rows.waterfall(found).collect()) == len(data)


def test_reports(spark):
    df = frame(spark)
    assert [tuple(r) for r in rows.duplicate_report(df, "url").collect()] == [("a", 2), ("b", 2)]
    assert [tuple(r) for r in rows.duplicate_report(df, "url", top=1).collect()] == [("a", 2)]
    got = rows.recover(df.where("pos > 3"), df, "url", "pos")
    assert {(r["pos"], r["src"]) for r in got.collect()} == {(4, 0), (6, 0), (0, 1)}


def test_summaries(spark):
    df = frame(spark)
    assert {r["tag"]: r["n"] for r in summary.count_by(df, F.col("tag"), "tag").collect()} == {"x": 4, "y": 1, "z": 1, "unknown": 1}
    assert [tuple(r) for r in summary.most_frequent(df, F.col("tag"), "tag", 2).collect()] == [("x", 4), (None, 1)]
    assert [r["tag"] for r in summary.most_frequent(df, F.col("tag"), "tag", pos="pos").collect()] == ["x", "y", None, "z"]
    assert summary.conditional_counts(df, x=F.col("tag") == "x", none=F.col("tag").isNull()).first().asDict() == {"total": 7, "x": 4, "none": 1}
    assert summary.completeness(df, "url", "tag").first().asDict() == {"no_url": 2, "no_tag": 1}
    stats = summary.length_stats(df, F.col("url"), F.col("tag")).first()
    assert (stats["min_description"], stats["max_description"]) == (0, 1) and abs(stats["avg_description"] - 6 / 7) < 1e-12
    assert positions(summary.head(df, "pos", 2)) == [0, 1]
    assert positions(summary.head_by_group(df, "tag", "pos", 1)) == [0, 2, 3, 5]
    parts = [df.repartition(n) for n in (1, 5)]
    one, two = (sorted(map(repr, summary.sample(x, 3, "pos", 1).collect())) for x in parts)
    assert one == two and len(one) == 3 and one != sorted(map(repr, summary.sample(df, 3, "pos", 2).collect()))
    halves = [summary.sample(df.where(c), 3, "pos", 1) for c in ("pos % 2 = 0", "pos % 2 = 1")]
    assert sorted(map(repr, summary.sample(halves[0].union(halves[1]), 3, "pos", 1).collect())) == one
    assert sorted(r["n"] for r in summary.sample_by(df, "tag", 2, "pos").groupBy("tag").count().withColumnRenamed("count", "n").collect()) == [1, 1, 1, 2]
    days = spark.createDataFrame([("2024-01-02T03",), ("",), (None,), ("2024-01-02",)], "d string")
    assert {r["day"]: r["n"] for r in summary.count_by_date(days, F.col("d")).collect()} == {"2024-01-02": 2, "unknown": 2}
    assert {r["day"]: r["n"] for r in summary.count_by_date(days, F.col("d"), prefix=False).collect()} == {"2024-01-02T03": 1, "2024-01-02": 1, "": 1, "unknown": 1}
    r = summary.date_range(days, F.col("d")).first()
    assert (r["first_day"], r["last_day"], r["n_days"], r["n"]) == ("2024-01-02", "2024-01-02", 1, 4)
    assert [x["day"] for x in spark.createDataFrame([("2024-01-01",), ("unknown",)], "day string").orderBy(summary.day_order(F.col("day"))).collect()] == ["unknown", "2024-01-01"]


def test_publication_order(spark):
    import hashlib

    data = [("2024-01-01", "u1"), ("2024-02-01", "u2"), (None, "u3"), ("2024-01-01", "u4"), ("2024-02-01", "u5")]
    df = spark.createDataFrame(data, "d string, u string").orderBy(*summary.publication_order(F.col("d"), F.col("u")))
    key = lambda r: ("".join(str(9 - int(c)) if c.isdigit() else c for c in r[0] or "0000-00-00"), hashlib.md5(r[1].encode()).hexdigest())
    assert [tuple(r) for r in df.collect()] == sorted(data, key=key)


def test_histogram_and_terms(spark):
    counts = spark.createDataFrame([("a", 10), ("b", 1), ("c", 5)], "k string, n long")
    assert {r["k"]: len(r["bar"]) for r in summary.histogram(counts, "k", 8).collect()} == {"a": 8, "b": 1, "c": 4}
    terms = spark.createDataFrame([("A b, a",), (None,), ("b a!",)], "t string")
    assert [tuple(r) for r in summary.top_terms(terms, F.col("t"), 1).collect()] == [("a", 3)]
    sizes = spark.createDataFrame([(n,) for n in (0, 3, 5, 6, 11, 30)], "n long")
    assert [r[0] for r in sizes.orderBy("n").select(summary.positions_to_check(F.col("n"))).collect()] == [[], [0, 1, 2], [0, 1, 2, 3, 4], [0, 5], [0, 5, 10], [0, 10, 15, 29]]


def day_frame(spark, days):
    return spark.createDataFrame([(d,) for d in days], "day date")


@SLOW
@given(days=st.lists(st.integers(0, 25), max_size=8))
def test_gaps_fill_the_grid(spark, days):
    start = date(2024, 1, 1)
    have = {start + timedelta(d) for d in days}
    got = {r["day"] for r in coverage.gaps(day_frame(spark, sorted(have))).collect()}
    span = {min(have) + timedelta(k) for k in range((max(have) - min(have)).days + 1)} if have else set()
    assert got == span - have
    todo = {r["day"] for r in coverage.to_collect(day_frame(spark, sorted(have)), "2024-01-01", "2024-01-26").collect()}
    assert todo == {start + timedelta(k) for k in range(26)} - have


def test_grid_of_nothing(spark):
    assert coverage.date_grid(spark, "2024-01-02", "2024-01-01").count() == 0


def test_status(spark):
    d = [date(2024, 1, k) for k in (1, 2, 3, 4)]
    have = spark.createDataFrame([("a", d[0], 5), ("b", d[0], 1), ("a", d[1], 1), ("a", d[2], 9)], "outlet string, day date, have long")
    want = spark.createDataFrame([(d[0], "a", 5), (d[0], "b", 1), (d[1], "a", 3), (d[2], "a", 9), (d[2], "b", -1)], "day date, outlet string, expected long")
    got = {r["day"]: (r["downloaded"], r["available"], r["status"]) for r in coverage.day_status(day_frame(spark, d), have, want).collect()}
    assert got == {d[0]: (6, 6, "complete"), d[1]: (1, 3, "partial"), d[2]: (9, None, "unknown"), d[3]: (0, None, "unknown"), None: (16, 9, "total")}
    done = coverage.completed(have, want, ["day", "outlet"])
    assert sorted((str(r["day"]), r["outlet"]) for r in done.collect()) == [("2024-01-01", "a"), ("2024-01-01", "b"), ("2024-01-03", "a")]
    outlets = spark.createDataFrame([("a",), ("b",)], "outlet string")
    assert coverage.work_left(day_frame(spark, d), outlets, done).count() == 5


def test_manifest(spark):
    runs = spark.createDataFrame([(date(2024, 1, 1), "09:00", "full"), (date(2024, 1, 1), "08:00", "auto"), (date(2024, 1, 4), "07:00", "auto")], "day date, time string, mode string")
    days = day_frame(spark, [date(2024, 1, 2), date(2024, 1, 5), date(2024, 1, 5)])
    m = coverage.manifest("t", "2024-01-01", runs, days, 7, "now").first()
    assert m["dates_collected"] == ["2024-01-02", "2024-01-05"] and m["gaps"] == ["2024-01-01", "2024-01-03", "2024-01-04"] and m["record_count"] == 7
    assert m["daily_runs"]["2024-01-01"].asDict() == {"count": 2, "first": "08:00", "last": "09:00", "mode": "auto"} and set(m["daily_runs"]) == {"2024-01-01", "2024-01-04"}
    assert m["coverage"].asDict() == {"start_date": "2024-01-01", "end_date": "2024-01-05", "last_updated": "now"}
    none = coverage.manifest("t", "2024-01-01", runs.limit(0), days.limit(0), 0, "now").first()
    assert none["dates_collected"] == [] and none["gaps"] == [] and none["coverage"]["end_date"] is None
    assert [str(r["day"]) for r in coverage.gaps(days, "2024-01-01", "2024-01-06").orderBy("day").collect()] == ["2024-01-01", "2024-01-03", "2024-01-04", "2024-01-06"]
    head = coverage.header(frame(spark), "t", F.col("tag"), "now").first()
    assert head["record_count"] == 7 and head["dates_collected"] == ["x", "y", "z"] and head["date_range"].asDict() == {"start": "x", "end": "z"}


def test_snapshots(spark):
    counts = spark.createDataFrame([("v3", 0, 10), ("v2", 1, 30), ("v1", 2, 30), ("v0", 3, 16)], "version string, idx long, n long")
    assert tuple(coverage.best_snapshot(counts, "version", "idx", "n").first()) == ("v2", 30)
    assert tuple(coverage.data_loss(counts, "idx").first()) == (10, 30, True, 1)
    assert tuple(coverage.data_loss(counts.where("idx = 0"), "idx").first()) == (10, 10, False, None)
    assert coverage.nth_revision(counts, "idx", 2).first()["version"] == "v1" and coverage.nth_revision(counts, "idx", 9).count() == 0
    texts = spark.createDataFrame([("v", "f", "é\nb\n")], "version string, file string, content string")
    assert tuple(coverage.change_stats(texts).first()) == ("v", "f", 2, 5)
    assert Counter(r["version"] for r in coverage.snapshot_counts(counts.union(counts), "version", "idx").collect()) == Counter(["v0", "v1", "v2", "v3"])


def test_topics_by_name():
    known = {"a": {"broad": ["x"]}, "b": {"broad": []}}
    assert plans.topic("a", known) == {"broad": ["x"], "name": "a"}
    with pytest.raises(ValueError, match="no settings for topic 'c'"):
        plans.topic("c", known)
    assert plans.active(["b", "z", "a"], known) == ({"b": known["b"], "a": known["a"]}, ["z"]) and plans.active(None, known) == (known, [])


def test_blank_keys_in_lookups(spark):
    """Rows without a key find nothing, and are all kept; an empty key is one like others."""
    left = spark.createDataFrame([(None, i) for i in range(50)] + [("", 60), ("a", 61)], "url string, pos long")
    right = spark.createDataFrame([(None, 1, "n"), ("", 2, "e"), ("a", 3, "x"), ("a", 4, "y")], "url string, pos long, extra string")
    got = {r["pos"]: r["extra"] for r in rows.lookup(left, right, "url", "pos", ["extra"]).collect()}
    assert got == dict.fromkeys(range(50)) | {60: "e", 61: "y"}


def test_collection_state(spark):
    """A hash that is missing is this query's; another query's state is forgotten; known counts stay."""
    q, day = F.lit("storm"), "2024-01-01"
    old = spark.createDataFrame([("t", None, "o", day, True, 4), ("t", "other", "p", day, True, 9), ("u", None, "o", day, True, 1)], coverage.CHECKPOINT)
    assert [r["outlet"] for r in coverage.current_state(old, "t", q).collect()] == ["o"]
    counted = spark.createDataFrame([("o", day, 7), ("p", day, 5), ("q", day, -1)], "outlet string, day string, expected long")
    other = ("u", "o", True, 1)  # stays, whatever happens to t
    seen = lambda df: sorted((r["topic"], r["outlet"], r["complete"], r["expected"]) for r in df.collect())
    state = coverage.known_counts(old, "t", q, counted)
    assert seen(state) == [("t", "o", True, 4), ("t", "p", False, 5), other]
    state = coverage.mark_complete(state, "t", q, counted.where("outlet = 'p'"))
    assert seen(state) == [("t", "o", True, 4), ("t", "p", True, 5), other]
    assert [r["outlet"] for r in coverage.to_count(state, "t", q, counted).collect()] == ["q"]


def test_rows_without_a_key_dont_meet(spark):
    """Half of all rows have no key: no task gets them all."""
    df = spark.range(40_000).select(F.when(F.col("id") % 2 == 0, F.col("id").cast("string")).alias("url"), F.col("id").alias("pos"))
    seen = df.where("id % 4 = 0" if "id" in df.columns else "pos % 4 = 0")
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        for found, n in ((rows.unseen(df, seen.where("url is not null"), "url"), 30_000), (rows.missing(df, seen, "url"), 30_000)):
            sizes = [r["n"] for r in found.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
            assert sum(sizes) == n and max(sizes) < 2 * n / 16
        assert rows.unseen(df, df.where("pos = 1"), "url").count() == 20_000 and rows.unseen(df, df.limit(0), "url").count() == 40_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_languages_held_out(spark):
    """Profiles of one half of the documents name the language of the other; short texts and unknown letters aren't judged."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang is not null and length(text) >= 20")
    known = languages.profile(docs.where("doc_id % 2 = 0"), "text", "lang")
    found = languages.detected(docs.where("doc_id % 2 = 1"), "doc_id", "text", known).join(docs.select("doc_id", "lang"), "doc_id")
    assert found.where("language = lang").count() >= 0.95 * found.count() > 300
    odd = spark.createDataFrame([(1, "short"), (2, None), (3, "日" * 40), (4, "")], "k long, t string")
    assert {r["k"]: r["language"] for r in languages.detected(odd, "k", "t", known).collect()} == dict.fromkeys((1, 2, 3, 4))
    assert all(r["english"] for r in languages.english(odd, "k", "t", known).collect())
    assert languages.detected(odd, "k", "t", known.limit(0)).where("language is not null").count() == 0


def test_contained_keys(spark):
    texts = spark.createDataFrame([(1, "a storm at the coast"), (2, "coastal"), (3, None), (4, ""), (1, "a storm at the coast"), (5, "日本の海岸 coa")], "k long, t string")
    keys = spark.createDataFrame([("coast",), ("storm at",), ("a",), ("",), (None,), ("coast",), ("日本",), ("nowhere",), ("oas",), ("海岸 coa",)], "w string")
    want = {(k, w) for k, t in ((r["k"], r["t"]) for r in texts.collect()) for w in (r["w"] for r in keys.collect()) if t and w and w in t}
    found = within.contained(texts, keys, "k", "t", "w")
    assert sorted(map(tuple, found.collect())) == sorted(want)
    assert "Cartesian" not in (plan := found._jdf.queryExecution().executedPlan().toString()) and "NestedLoop" not in plan
    assert within.contained(texts, keys.limit(0), "k", "t", "w").count() == 0 and within.contained(texts.limit(0), keys, "k", "t", "w").count() == 0


def test_counters_while_rows_are_written(spark, tmp_path):
    reasons = spark.createDataFrame([("added",)] * 3 + [("off_topic",)], "reason string")
    found, seen = rows.counted(reasons)
    found.write.parquet(str(tmp_path / "r"))
    assert sorted(map(tuple, rows.counters(spark, seen).collect())) == [("added", 3), ("off_topic", 1)]
    assert found._jdf.queryExecution().executedPlan().toString().count("Scan") == 1
