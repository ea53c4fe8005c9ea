"""Readers, writers, adapters and the streaming store."""

import gzip
import json
import pathlib

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from topicloom.sources import commits, jsonl, remote, sinks
from topicloom.streaming import store

LINES = ['{"_meta": true, "n": 1}', '{"url": "u1", "k": 1}', "", "{bad", "[1, 2]", "7", '{"url": "a b", "k": null}', '{"_manifest": true}', '{"_meta": false, "url": "u2"}', '{"url": " u1 "}']


@pytest.fixture
def lines(spark):
    return jsonl.split_lines(spark.createDataFrame([("\n".join(LINES),)], "value string"))


def urls(df):
    return [r["url"] for r in df.orderBy("pos").collect()]


def test_parse_options(spark, lines):
    assert urls(jsonl.parse(lines, "url string")) == ["u1", "a b", "u2", " u1 "]
    assert urls(jsonl.parse(lines, "url string", flags=("_meta",))) == ["u1", "a b", None, "u2", " u1 "]
    kept = jsonl.parse(lines, "url string", on_bad="keep", non_dict="keep").orderBy("pos").collect()
    assert [r["_corrupt"] for r in kept if r["_corrupt"]] == ["{bad"] and [r["_value"] for r in kept if r["_value"]] == ["[1, 2]", "7"]
    for option in ({"on_bad": "fail"}, {"non_dict": "fail"}):
        with pytest.raises(PySparkException, match="line"):
            jsonl.parse(lines, "url string", **option).collect()
    broken = jsonl.split_lines(spark.createDataFrame([("\n".join(LINES),)], "value string"), unicode=True)
    assert urls(jsonl.parse(broken, "url string")) == ["u1", "u2", " u1 "]
    assert sorted(r["url"] for r in jsonl.keys_of(lines, "url").collect()) == ["a b", "u1", "u2"]


def test_null_is_not_missing(lines):
    found = {r["pos"]: r["record"] for r in jsonl.as_maps(lines).collect()}
    assert found[6] == {"url": "a b", "k": None} and "k" not in found[9]


def test_header_lines(spark):
    text = '{"_manifest": true, "topic": "t"}\n{"url": "u"}'
    df = jsonl.split_lines(spark.createDataFrame([(text,)], "value string"))
    assert jsonl.first_header(df, "topic string").first()["topic"] == "t"
    assert jsonl.first_header(df.where("pos > 0"), "topic string").count() == 0


def test_files_and_days(spark, tmp_path):
    for day, body in (("2024-01-02", '{"url": "b"}\n{"url": "c"}\n'), ("2024-01-01", '{"url": "a"}\n'), ("_old", '{"url": "z"}\n')):
        (tmp_path / day).mkdir()
        (tmp_path / day / "articles.jsonl").write_text(body)
    (tmp_path / "2024-01-03").mkdir()
    got = jsonl.read_days(spark, str(tmp_path), "articles.jsonl", "url string")
    assert [(r["day"], r["url"]) for r in got.orderBy("day", "pos").collect()] == [("2024-01-01", "a"), ("2024-01-02", "b"), ("2024-01-02", "c")]
    assert jsonl.days_collected(spark, str(tmp_path)) == ["2024-01-01", "2024-01-02"]
    assert jsonl.read_days(spark, str(tmp_path / "none"), "x", "url string").count() == 0
    assert jsonl.read_large(spark, str(tmp_path / "2024-01-02"), "url string").count() == 2
    (tmp_path / "x.jsonl.gz").write_bytes(gzip.compress(b'{"url": "g"}\n'))
    assert jsonl.read_large(spark, str(tmp_path / "x.jsonl.gz"), "url string").first()["url"] == "g"


def test_other_inputs(spark):
    docs = lambda *t: spark.createDataFrame([(x,) for x in t], "value string")
    for text in ('{"stories": [{"url": "a"}, {"url": "b"}]}', '[{"url": "a"}, {"url": "b"}]'):
        assert [(r["pos"], r["url"]) for r in jsonl.stories(docs(text), "url string, title string").collect()] == [(0, "a"), (1, "b")]
    for text, want in (('{"urls": ["a", " b "]}', ["a", "b"]), ('["a"]', ["a"]), ('[{"url": " ", "link": "l"}, {"uri": "i"}]', ["l", "i"]), ('{"url": "u", "x": 1}', ["u"])):
        assert [r["url"] for r in jsonl.normalised_urls(docs(text)).orderBy("pos").collect()] == want
    with pytest.raises(PySparkException, match="neither"):
        jsonl.normalised_urls(docs("7")).collect()
    one = "<rss><channel><item><title>T</title><link>l</link></item></channel></rss>"
    feeds = spark.createDataFrame([("s", one), ("t", "<rss><channel></channel></rss>")], "source string, xml string")
    assert [tuple(r) for r in jsonl.rss_items(feeds).collect()] == [("s", 0, "T", "l", None, None)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("b", None), ("é", "x")], "url string, t string")
    path = str(tmp_path / "out")
    sinks.write_jsonl(df, path, {"_meta": True, "record_count": 2})
    assert json.loads((tmp_path / "out" / "_meta.json").read_text()) == {"_meta": True, "record_count": 2}
    back = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*")))
    assert '{"url":"b","t":null}' in back and "é" in back
    sinks.write_jsonl(df, path, mode="append")
    assert spark.read.json(path).where("url is not null").count() == 4
    place = str(tmp_path / "store")
    assert sinks.backup_then_write(df, place) is None
    kept = sinks.backup_then_write(commits.read(spark, place, "url string, t string").where("url = 'b'").select("url", "t"), place)
    assert kept == 1 and commits.read(spark, place, "url string").count() == 1 and commits.read(spark, place, "url string", kept).count() == 2
    sinks.write_ordered(df, str(tmp_path / "ordered"), [df["url"].desc()])
    assert [json.loads(x)["url"] for p in sorted((tmp_path / "ordered").glob("part-*")) for x in p.read_text().split("\n") if x] == ["é", "b"]
    numbered = spark.range(50).select((F.col("id") * 3).alias("p"), F.when(F.col("id") % 2 == 0, F.lit("é\n")).alias("t"))
    for rows, want in ((numbered.repartition(5), [{"t": "é\n" if k % 2 == 0 else None} for k in range(50)]), (numbered.limit(0), [])):
        sinks.write_document(rows, str(tmp_path / "doc"), "p", run="r")
        text = "".join(p.read_text() for p in sorted((tmp_path / "doc").glob("part-*")))
        assert json.loads(text) == {"_meta": {"run": "r"}, "stories": want}
    sinks.placeholder(df, str(tmp_path / "empty"), "t")
    assert spark.read.schema("url string").json(str(tmp_path / "empty" / "part-*")).count() == 0
    seen = []
    assert not sinks.publish("p") and sinks.publish("p", seen.append) and seen == ["p"]


def test_remote_sources(spark):
    def fetch(day, outlet, page):
        return [{"id": f"{day}-{outlet}-{page}", "url": "u"}], (page + 1 if page < 2 else None)

    pairs = [("d1", "a"), ("d1", "b")]
    spark.dataSource.register(remote.listing_source("listing_test", fetch, pairs))
    got = spark.read.format("listing_test").load()
    assert got.rdd.getNumPartitions() == 2 and sorted(r["id"] for r in got.collect()) == sorted(f"d1-{o}-{p}" for o in "ab" for p in range(3))
    spark.dataSource.register(remote.listing_source("count_test", lambda day, outlet: -1 if outlet == "b" else 4, pairs, count=True))
    assert sorted(map(tuple, spark.read.format("count_test").load().collect())) == [("d1", "a", 4), ("d1", "b", -1)]


def test_listings_are_tried_again(spark, tmp_path):
    """A page or count that fails is asked for again; a count that goes on failing is unknown, objects count by their fields."""
    marks = str(tmp_path)

    def flaky(name):
        """True on the first call for a name."""
        path = pathlib.Path(marks, name)
        if path.exists():
            return False
        path.touch()
        return True

    def page(day, outlet, page):
        if flaky(f"{outlet}{page}"):
            raise OSError("429")
        return [{"id": f"{outlet}{page}"}], None

    def count(day, outlet):
        if outlet == "never" or flaky(f"count-{outlet}"):
            raise OSError("429")
        return {"a": {"relevant": 3}, "b": {"relevant": 0, "count": 2}, "c": 5}[outlet]

    spark.dataSource.register(remote.listing_source("flaky_pages", page, [("d", "a"), ("d", "b")], waits=(0, 0)))
    assert sorted(r["id"] for r in spark.read.format("flaky_pages").load().collect()) == ["a0", "b0"]
    spark.dataSource.register(remote.listing_source("flaky_counts", count, [("d", x) for x in ("a", "b", "c", "never")], count=True, waits=(0, 0)))
    assert sorted((r["outlet"], r["expected"]) for r in spark.read.format("flaky_counts").load().collect()) == [("a", 3), ("b", 2), ("c", 5), ("never", -1)]


def test_cut_payloads_and_suffixes(spark, tmp_path):
    files = spark.createDataFrame([("a", "cut", True, "u1"), ("b", "whole", False, "u2"), ("c", "kept", True, None)], "file string, content string, truncated boolean, raw_url string")
    assert {r["file"]: r["content"] for r in remote.whole_content(files, lambda u: f"all of {u}").collect()} == {"a": "all of u1", "b": "whole", "c": "kept"}
    (tmp_path / "x.json").write_text('{"stories": [{"url": "a"}, {"url": "b"}]}')
    (tmp_path / "x.jsonl").write_text('{"url": "c"}\n')
    assert [r["url"] for r in jsonl.read_any(spark, str(tmp_path / "x.json"), "url string").collect()] == ["a", "b"]
    assert [r["url"] for r in jsonl.read_any(spark, str(tmp_path / "x.jsonl"), "url string").collect()] == ["c"]
    forms = {'{"urls": ["a", "b"]}': ["a", "b"], '["a"]': ["a"], '[{"url": "o"}, {"x": 1}]': ["o", None], '{"url": "one"}': ["one"], "[]": []}
    for k, (text, want) in enumerate(forms.items()):
        (tmp_path / f"y{k}.txt").write_text(text)
        assert [r["url"] for r in jsonl.read_any(spark, str(tmp_path / f"y{k}.txt"), "url string").orderBy("pos").collect()] == want
    (tmp_path / "z.ndjson").write_text('{"url": "n"}\n')
    assert jsonl.read_any(spark, str(tmp_path / "z.ndjson"), "url string").first()["url"] == "n"
    (tmp_path / "bad.json").write_text("7")
    with pytest.raises(PySparkException, match="neither"):
        jsonl.read_any(spark, str(tmp_path / "bad.json"), "url string").collect()


def test_headers_are_replaced(spark):
    lines = spark.createDataFrame([("a", 0, '{"_manifest": true, "n": 1}'), ("a", 1, "x"), ("b", 0, "y"), ("b", 1, "z"), ("c", 0, '{"_manifest": false}')], "f string, pos int, line string")
    got = sinks.with_header(lines, F.concat(F.lit('{"_manifest": true, "of": "'), "f", F.lit('"}')), "f").orderBy("f", "pos").collect()
    head = lambda f: (f, 0, f'{{"_manifest": true, "of": "{f}"}}')
    assert [tuple(r) for r in got] == [head("a"), ("a", 1, "x"), head("b"), ("b", 1, "y"), ("b", 2, "z"), head("c"), ("c", 1, '{"_manifest": false}')]


def test_day_filters_leave_folders_alone(spark, tmp_path):
    rows = spark.createDataFrame([(f"2024-01-0{d}", k) for d in range(1, 6) for k in range(3)], "d string, k long").selectExpr("cast(d AS date) AS day", "k")
    jsonl.write_day_table(rows, str(tmp_path / "t"))
    found = jsonl.read_day_table(spark, str(tmp_path / "t"), "k long").where("day = DATE '2024-01-03'")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and found.count() == 3
    for d in (1, 2):
        (tmp_path / f"2024-02-0{d}").mkdir()
        (tmp_path / f"2024-02-0{d}" / "x.jsonl").write_text('{"k": 1}\n')
    (tmp_path / "2024-02-03").mkdir()
    some = jsonl.read_days(spark, str(tmp_path), "x.jsonl", "k long", first="2024-02-02", last="2024-02-09")
    assert [r["day"] for r in some.collect()] == ["2024-02-02"] and all("2024-02-02" in f for f in some.inputFiles())


def test_scrape(spark):
    def fetch(url):
        if url == "bad":
            raise ValueError("no")
        return "<title>T</title>", url + "/", 404 if url == "gone" else 200

    df = spark.createDataFrame([("ok",), ("gone",), ("bad",)], "url string")
    got = {r["url"]: r for r in remote.scrape(df, fetch, "t", "now", tries=1).collect()}
    assert (got["ok"]["title"], got["ok"]["success"], got["ok"]["http_status"]) == ("T", True, 200)
    assert got["gone"]["error"] == "HTTP 404" and got["bad"]["error"] == "no" and not got["bad"]["success"]
    assert [remote.backoff(n, remote.LISTING_WAITS) for n in (1, 2, 5, 9)] == [40, 80, 600, 600]
    assert remote.gunzipped(gzip.compress(b"x")) == b"x" == remote.gunzipped(b"x")
    waits, tries = [], iter([ValueError(), ValueError(), 3])

    def call():
        x = next(tries)
        if isinstance(x, Exception):
            raise x
        return x

    assert remote.with_retries(call, 5, remote.PAGE_WAITS, waits.append) == 3 and waits == [1, 2]


def test_versions(spark):
    log = spark.createDataFrame([("v1", "f", "x"), ("v2", "f", "y"), ("v2", "g", "z")], "version string, file string, content string")
    assert remote.at_version(log, "v2", "f").first()["content"] == "y"


def test_streaming_store(spark, tmp_path):
    source, place, check = (str(tmp_path / n) for n in ("in", "store", "check"))
    put = lambda name, data: spark.createDataFrame(data, "pos long, url string").coalesce(1).write.mode("append").parquet(f"{source}")
    put(1, [(0, "a"), (1, "b"), (2, "b")])
    stream = lambda: spark.readStream.schema("pos long, url string").parquet(source)
    store.accumulate(stream(), place, check, pos="pos").awaitTermination()
    put(2, [(3, "b"), (4, "c"), (5, None)])
    store.accumulate(stream(), place, check, pos="pos").awaitTermination()
    put(3, [(6, None), (7, "d")])
    store.accumulate(stream(), place, check, pos="pos").awaitTermination()
    assert sorted(r["pos"] for r in store.read_store(spark, place).collect()) == [0, 1, 4, 5, 7]
    assert commits.numbers(spark, place) == [1, 2, 3]
    assert sorted(r["pos"] for r in store.read_store(spark, place, 1).collect()) == [0, 1]


def urls_frame(spark, numbers, prefix="u"):
    return spark.createDataFrame([(k, f"{prefix}{k}") for k in numbers], "pos long, url string")


def test_store_reads_touched_buckets_only(spark, tmp_path):
    place = str(tmp_path / "store")
    assert store.append(urls_frame(spark, range(400)), place, 0, buckets=64)
    head = commits.pointer(spark, place)
    batch = urls_frame(spark, [7, 1000])
    where = store.touched(batch, head, "url")
    assert 1 <= len(where) <= 3 and store.touched(urls_frame(spark, range(400)), head, "url") == sorted({int(p.name[7:]) for p in pathlib.Path(head["folders"][0]).glob("bucket=*")})
    read = store.rows_of(spark, head, where)
    assert {p.split("bucket=")[1].split("/")[0] for p in read.inputFiles()} > set(map(str, where))  # before planning, all
    plan = read._jdf.queryExecution().executedPlan()
    plan.execute()
    assert f"bucket IN ({','.join(map(str, where))})" in plan.toString() or len(where) == 1
    assert "PartitionFilters: []" not in plan.toString()
    assert read.count() < 40
    store.append(batch, place, 1)
    assert sorted(r["pos"] for r in store.read_store(spark, place).where("pos > 399 or pos = 7").collect()) == [7, 1000]


def test_store_never_misses_a_key(spark, tmp_path):
    """Batches that overlap, filters put together, a compaction with more segments; against a set."""
    place, seen = str(tmp_path / "store"), set()
    before = store.APART, store.FULL
    store.APART, store.FULL = 2, 20
    try:
        for number in range(5):
            keys = range(number * 60, number * 60 + 150)
            store.append(urls_frame(spark, keys), place, number, buckets=4)
            seen |= set(keys)
            if number == 2:
                store.compact(spark, place)
                assert commits.pointer(spark, place)["segments"] == 4
    finally:
        store.APART, store.FULL = before
    got = [r["pos"] for r in store.read_store(spark, place).collect()]
    assert sorted(got) == sorted(seen)


def test_store_survives_a_batch_that_dies(spark, tmp_path, monkeypatch):
    place = str(tmp_path / "store")
    store.append(urls_frame(spark, range(5)), place, 0)

    def dies(*a, **b):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(commits, "commit", dies)
        with pytest.raises(OSError):
            store.append(urls_frame(spark, range(3, 9)), place, 1)
    assert store.read_store(spark, place).count() == 5
    assert store.append(urls_frame(spark, range(3, 9)), place, 1) and not store.append(urls_frame(spark, range(3, 9)), place, 1)
    assert sorted(r["pos"] for r in store.read_store(spark, place).collect()) == list(range(9))
    assert store.append(urls_frame(spark, range(20, 22)), place, 0, source="other") and store.read_store(spark, place).count() == 11


def test_versions_of_a_store(spark, tmp_path, monkeypatch):
    """A write that fails before its pointer leaves the old version readable; old versions can be read and restored."""
    place = str(tmp_path / "v")
    with pytest.raises(ValueError, match="no version"):
        commits.read(spark, place, "url string")
    urls_of = lambda version=None: sorted(r["url"] for r in commits.read(spark, place, "k long, url string", version).collect())
    assert commits.replace(urls_frame(spark, [1, 2]).withColumnRenamed("pos", "k"), place, {"record_count": 2}) == 1
    with monkeypatch.context() as m:
        m.setattr(commits, "commit", lambda *a, **b: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            commits.replace(urls_frame(spark, [3]).withColumnRenamed("pos", "k"), place)
    assert urls_of() == ["u1", "u2"]
    assert commits.replace(urls_frame(spark, [3]).withColumnRenamed("pos", "k"), place, {"record_count": 3}, append=True) == 2 and urls_of() == ["u1", "u2", "u3"]
    kept = commits.read(spark, place, "k long, url string").where("k = 3").select("k", "url")
    assert commits.replace(kept, place) == 3 and urls_of() == ["u3"] and urls_of(2) == ["u1", "u2", "u3"]
    assert commits.restore(spark, place, 1) == 4 and urls_of() == ["u1", "u2"]
    with pytest.raises(commits.Conflict):
        commits.commit(spark, place, commits.pointer(spark, place, 2), [])
    with pytest.raises(ValueError):
        commits.restore(spark, place, 9)
    assert [tuple(r)[0:1] + tuple(r)[2:] for r in commits.history(spark, place).collect()] == [(4, 1, 2, 1), (3, 1, None, None), (2, 2, 3, None), (1, 1, 2, None)]
    assert not [p for p in pathlib.Path(place, "_versions").iterdir() if p.name.startswith(".") and not p.name.endswith(".crc")]


def test_streaming_counts(spark, tmp_path, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    schema = events.schema
    events.repartition(2).write.parquet(str(tmp_path / "e"))
    counts = store.counts_by_day(spark.readStream.schema(schema).parquet(str(tmp_path / "e")), late="60 days")
    query = counts.writeStream.outputMode("complete").format("memory").queryName("counts_by_day").start()
    query.processAllAvailable()
    query.stop()
    assert spark.table("counts_by_day").agg({"n": "sum"}).first()[0] == events.count()


def test_lines_of_split_files_are_numbered(spark, tmp_path):
    """Files cut into many blocks: a line's number is its place in the file, blank lines counted."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    want = []
    for f, end in enumerate(("\n", "\r\n")):
        lines = [json.dumps({"k": i, "pad": "x" * (i * 7 % 50)}) if i % 11 else "" for i in range(1500)]
        (tmp_path / f"f{f}.jsonl").write_bytes(end.join(lines).encode())
        want += [(f, i, i) for i in range(1500) if i % 11]
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
        spark.conf.set("spark.sql.files.openCostInBytes", "10")
        got = jsonl.read(spark, [f"{tmp_path}/f{f}.jsonl" for f in range(2)], "k int").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted((int(r["path"][-7]), r["pos"], r["k"]) for r in got) == want
