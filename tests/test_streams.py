"""Listings as a stream, and the state of a collection."""

import datetime as dt
import json
import pathlib

import pytest

from topicloom.sources import remote
from topicloom.streaming import collection, store


def reports(spark, path, rows):
    spark.createDataFrame(rows, collection.REPORT).coalesce(1).write.mode("append").parquet(path)


def at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def state(spark, tmp_path):
    stream = spark.readStream.schema(collection.REPORT).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    collection.follow(stream, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    found = collection.standing(collection.changes(spark, str(tmp_path / "out"))).collect()
    return sorted((r["topic"], r["outlet"], r["day"], r["complete"], r["expected"]) for r in found)


def test_collection_state(spark, tmp_path):
    """A new query forgets its own topic's pairs; today's count is forgotten when the day is over; late and repeated reports change nothing."""
    place = str(tmp_path / "in")
    reports(spark, place, [("a", "q", "o", "2024-01-05", "count", 7, at(5, 3)), ("a", "q", "o", "2024-01-01", "count", 3, at(5, 3)), ("b", "q", "o", "2024-01-01", "complete", None, at(5, 4)), ("b", "q", "p", "2024-01-01", "count", -1, at(5, 4)), ("b", "q", "p", "soon", "count", 9, at(5, 4))])
    assert state(spark, tmp_path) == [("a", "o", "2024-01-01", False, 3), ("a", "o", "2024-01-05", False, 7), ("b", "o", "2024-01-01", True, None)]
    reports(spark, place, [("a", "q", "o", "2024-01-01", "count", 4, at(5, 9)), ("a", "q", "o", "2024-01-01", "complete", None, at(5, 9)), ("a", "q", "x", "2024-01-02", "count", 1, at(7, 12))])
    assert state(spark, tmp_path) == [("a", "o", "2024-01-01", True, 3), ("a", "x", "2024-01-02", False, 1), ("b", "o", "2024-01-01", True, None)]
    reports(spark, place, [("a", "q", "o", "2024-01-05", "count", 8, at(7, 13))])
    assert ("a", "o", "2024-01-05", False, 8) in state(spark, tmp_path)
    reports(spark, place, [("a", "q2", "o", "2024-01-01", "complete", None, at(8))])
    reports(spark, place, [("a", "q", "o", "2024-01-01", "count", 3, at(7, 23))])
    assert state(spark, tmp_path) == [("a", "o", "2024-01-01", True, None), ("b", "o", "2024-01-01", True, None)]


def pages_of(marks):
    """A service of two pages a pair, which notes what it was asked."""

    def fetch(day, outlet, page):
        pathlib.Path(marks, f"{day}-{outlet}-{page}-{len(list(pathlib.Path(marks).iterdir()))}").touch()
        return [{"id": f"{day}{outlet}{page}{k}", "url": "u"} for k in range(2)], (page + 1 if page < 1 else None)

    return fetch


def asked(marks):
    return sorted({p.name.rsplit("-", 1)[0] for p in pathlib.Path(marks).iterdir()})


def test_listing_stream_goes_on(spark, tmp_path):
    """A killed query yields each record once in the store, and doesn't ask again for what it has stored."""
    marks, days, place, check = (tmp_path / n for n in ("marks", "days.json", "store", "check"))
    marks.mkdir()
    days.write_text(json.dumps([["d1", "a"], ["d1", "b"]]))
    listed = lambda path=str(days): [tuple(p) for p in json.loads(pathlib.Path(path).read_text())]
    spark.dataSource.register(remote.listing_source("listing_stream", pages_of(str(marks)), listed))

    def run(dies=False):
        def write(batch, number):
            store.append(batch, str(place), number, key="id", buckets=4)
            if dies:
                raise RuntimeError("killed after the store, before the checkpoint")

        query = spark.readStream.format("listing_stream").load().writeStream.option("checkpointLocation", str(check)).foreachBatch(write).trigger(availableNow=True).start()
        query.awaitTermination()

    with pytest.raises(Exception, match="killed"):
        run(dies=True)
    days.write_text(json.dumps([["d1", "a"], ["d1", "b"], ["d2", "a"]]))
    run()
    run()
    ids = sorted(r["id"] for r in store.read_store(spark, str(place)).collect())
    assert ids == sorted(f"{d}{o}{p}{k}" for d, o in (("d1", "a"), ("d1", "b"), ("d2", "a")) for p in range(2) for k in range(2))
    before = asked(marks)
    for p in list(marks.iterdir()):
        p.unlink()
    days.write_text(json.dumps([["d1", "a"], ["d1", "b"], ["d2", "a"], ["d2", "b"]]))
    run()
    assert len(before) == 6 and asked(marks) == ["d2-b-0", "d2-b-1"]


def test_listing_offsets_by_page():
    source = remote.listing_source("numbered", lambda d, o, p: ([{"id": f"{d}{p}"}], None), [("d1", "a"), ("d2", "a")], pages=lambda d, o: {"d1": 120, "d2": 3}[d])({})
    reader = source.streamReader(None)
    start, end = reader.initialOffset(), reader.latestOffset()
    assert end == {"day": "d2", "outlet": "a", "page": 3}
    assert [(p.day, p.first, p.last) for p in reader.partitions(start, end)] == [("d1", 0, 50), ("d1", 50, 100), ("d1", 100, 120), ("d2", 0, 3)]
    assert [(p.day, p.first, p.last) for p in reader.partitions({"day": "d1", "outlet": "a", "page": 119}, {"day": "d2", "outlet": "a", "page": 1})] == [("d1", 119, 120), ("d2", 0, 1)]
    assert reader.partitions(end, end) == [] and [r[2] for r in reader.read(remote.DayOutlet("d1", "a", 5, 8))] == ["d15", "d16", "d17"]


def test_filters_bound_the_partitions(spark):
    pairs = [(f"d{k}", o) for k in range(5) for o in "ab"]
    spark.dataSource.register(remote.listing_source("filtered", lambda d, o, p: ([{"id": f"{d}{o}"}], None), pairs, filters=True))
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        every = spark.read.format("filtered").load()
        one = every.where("day = 'd3' and outlet in ('a', 'x')")
        assert one.rdd.getNumPartitions() == 1 and [r["id"] for r in one.collect()] == ["d3a"]
        assert every.where("day = 'd3'").rdd.getNumPartitions() == 2 and every.where("day = 'd3' and id = 'd3b'").count() == 1
        assert every.where("day > 'd2'").count() == 4 and every.where("day = 'd1' and day = 'd2'").count() == 0
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")
