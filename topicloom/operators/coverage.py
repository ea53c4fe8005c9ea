"""Days that are covered, missing or incomplete; run manifests; snapshots of a store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.functions.text import query_hash
from topicloom.operators.summary import positions_to_check


def date_grid(spark: SparkSession, start: str, end: str) -> DataFrame:
    """All days from start to end; none if end is before start."""
    return spark.range(1).select(F.explode(F.when(F.lit(end).cast("date") >= F.lit(start).cast("date"), F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date")))).alias("day"))


def to_collect(collected: DataFrame, start: str, today: str) -> DataFrame:
    """Days from start to today that aren't in ``collected`` (day)."""
    return date_grid(collected.sparkSession, start, today).join(collected.select("day").distinct(), "day", "left_anti")


def gaps(collected: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Days from start (default: the first collected one) to end (default: the last) that are missing; none for no days."""
    edge = lambda day, pick: F.lit(day).cast("date") if day else pick("day")
    ends = collected.agg(edge(start, F.min).alias("a"), edge(end, F.max).alias("b"), F.count("day").alias("n")).where("n > 0 and b >= a")
    grid = ends.select(F.explode(F.sequence("a", "b")).alias("day"))
    return grid.join(collected.select("day").distinct(), "day", "left_anti")


def day_outlet_counts(df: DataFrame, outlet: str, day: str) -> DataFrame:
    return df.groupBy(outlet, day).agg(F.count(F.lit(1)).alias("have"))


def completed(have: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    """Combinations with as many rows as expected: have > 0, expected known (not negative) and reached."""
    return have.join(expected, keys).where("have > 0 and expected >= 0 and have >= expected").select(*keys)


def work_left(days: DataFrame, outlets: DataFrame, done: DataFrame) -> DataFrame:
    """All pairs of a day and a configured outlet but those done. Days and outlets are settings, not data."""
    return days.select("day").crossJoin(F.broadcast(outlets.select("outlet"))).join(done.select("day", "outlet"), ["day", "outlet"], "left_anti")


def day_status(grid: DataFrame, have: DataFrame, expected: DataFrame) -> DataFrame:
    """By day: downloaded, available (null if any count is unknown), status; and a total row with a null day.

    grid: day; have: outlet, day, have; expected: outlet, day, expected (negative: unknown). A day without any
    expected count is unknown; such days aren't in the total of what is available."""
    got = have.groupBy("day").agg(F.sum("have").alias("downloaded"))
    want = expected.groupBy("day").agg(F.sum("expected").alias("_sum"), F.max((F.col("expected") < 0).cast("int")).alias("_bad"))
    rows = grid.join(got, "day", "left").join(want, "day", "left")
    available = F.when(F.col("_bad") == 0, F.col("_sum"))
    rows = rows.select("day", F.coalesce("downloaded", F.lit(0)).alias("downloaded"), available.alias("available"))
    rows = rows.rollup("day").agg(F.sum("downloaded").alias("downloaded"), F.sum("available").alias("available"), F.grouping("day").alias("_total"))
    status = F.when(F.col("_total") == 1, "total").when(F.col("available").isNull(), "unknown").when(F.col("downloaded") >= F.col("available"), "complete").when(F.col("downloaded") > 0, "partial").otherwise("missing")
    return rows.select("day", "downloaded", "available", status.alias("status"))


def daily_runs(runs: DataFrame) -> DataFrame:
    """A manifest's runs by day: count, first and last time, and the mode of the first run. runs: day, time, mode."""
    return runs.groupBy("day").agg(F.count(F.lit(1)).alias("count"), F.min("time").alias("first"), F.max("time").alias("last"), F.min_by("mode", "time").alias("mode"))


def manifest(topic: str, start: str, runs: DataFrame, collected: DataFrame, records: int, updated: str) -> DataFrame:
    """The manifest as one row: coverage from ``start`` to the last collected day, days, runs by their own day, record
    count, gaps. runs: day, time, mode; collected: day. Without runs and days it is the empty manifest."""
    by_day = daily_runs(runs).withColumn("day", F.col("day").cast("string"))
    one = collected.agg(F.sort_array(F.collect_set(F.col("day").cast("string"))).alias("dates_collected"), F.max("day").cast("string").alias("_end"))
    maps = by_day.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("day", F.struct("count", "first", "last", "mode"))))).alias("daily_runs"))
    holes = gaps(collected, start).agg(F.sort_array(F.collect_list(F.col("day").cast("string"))).alias("gaps"))
    row = one.join(maps).join(holes)
    return row.select(F.lit(topic).alias("topic"), F.struct(F.lit(start).alias("start_date"), F.col("_end").alias("end_date"), F.lit(updated).alias("last_updated")).alias("coverage"), "dates_collected", "daily_runs", F.lit(records).alias("record_count"), "gaps")


def update_manifest(old: DataFrame, topic: str, start: str, days: DataFrame, records: int, now: str, mode: str = "adhoc") -> DataFrame:
    """A manifest (no rows: the empty one) after one more run: its days added, the run counted under its own day, ``records`` more.

    days: day (date or text) of the run; now: an ISO stamp in UTC. The first run of a day sets its mode and first time."""
    spark = days.sparkSession
    empty = manifest(topic, start, spark.createDataFrame([], "day date, time string, mode string"), spark.createDataFrame([], "day date"), 0, now)
    own = old.unionByName(empty.withColumn("_new", F.lit(1)), allowMissingColumns=True).orderBy(F.col("_new").asc_nulls_first()).limit(1).drop("_new")
    added = days.agg(F.collect_set(F.col("day").cast("string")).alias("_added"))
    today, clock = F.lit(now[:10]), F.lit(now[11:19] + "Z")
    row = own.join(added).withColumn("dates_collected", F.array_sort(F.array_union("dates_collected", "_added")))
    had = F.try_element_at("daily_runs", today)
    run = F.struct((F.coalesce(had["count"], F.lit(0)) + 1).alias("count"), F.coalesce(had["first"], clock).alias("first"), clock.alias("last"), F.coalesce(had["mode"], F.lit(mode)).alias("mode"))
    others = F.map_filter("daily_runs", lambda k, v: k != today)
    row = row.withColumn("daily_runs", F.map_concat(others, F.map_from_arrays(F.array(today), F.array(run))))
    end = F.coalesce(F.array_max("dates_collected"), F.col("coverage.end_date"))
    row = row.withColumn("coverage", F.struct(F.col("coverage.start_date").alias("start_date"), end.alias("end_date"), F.lit(now).alias("last_updated")))
    first, last = F.col("coverage.start_date").cast("date"), F.col("coverage.end_date").cast("date")
    every = F.transform(F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<date>")), lambda d: d.cast("string"))
    holes = F.when(F.size("dates_collected") > 0, F.array_except(every, "dates_collected")).otherwise(F.col("gaps"))
    return row.withColumn("gaps", holes).withColumn("record_count", (F.col("record_count") + records).cast("long")).drop("_added")


CHECKPOINT = "topic string, query_hash string, outlet string, day string, complete boolean, expected long"


def current_state(state: DataFrame, topic: str, query: Column) -> DataFrame:
    """The collection state of a topic (rows of CHECKPOINT) for its query: rows of another query's hash are forgotten; a missing
    hash is taken to be this query's."""
    own = query_hash(query)
    return state.where((F.col("topic") == topic) & F.coalesce(F.col("query_hash") == own, F.lit(True))).withColumn("query_hash", own)


def _others(state: DataFrame, topic: str) -> DataFrame:
    """Other topics' rows, which stay as they are."""
    return state.where(~F.coalesce(F.col("topic") == topic, F.lit(False)))


def mark_complete(state: DataFrame, topic: str, query: Column, done: DataFrame) -> DataFrame:
    """The state with the pairs in ``done`` (outlet, day) complete; pairs are kept once, counts stay known."""
    more = done.select(F.lit(topic).alias("topic"), query_hash(query).alias("query_hash"), "outlet", F.col("day").cast("string").alias("day"), F.lit(True).alias("complete"), F.lit(None).cast("long").alias("expected"))
    return _others(state, topic).unionByName(_once(current_state(state, topic, query).unionByName(more)))


def known_counts(state: DataFrame, topic: str, query: Column, counted: DataFrame) -> DataFrame:
    """The state with new expected counts (outlet, day, expected); failed ones (negative) aren't kept, known ones stay."""
    more = counted.where("expected >= 0").select(F.lit(topic).alias("topic"), query_hash(query).alias("query_hash"), "outlet", F.col("day").cast("string").alias("day"), F.lit(False).alias("complete"), "expected")
    own = current_state(state, topic, query)
    fresh = more.join(own.where("expected is not null").select("outlet", "day"), ["outlet", "day"], "left_anti")
    return _others(state, topic).unionByName(_once(own.unionByName(fresh.select(*own.columns))))


def to_count(state: DataFrame, topic: str, query: Column, pairs: DataFrame) -> DataFrame:
    """Pairs (outlet, day) whose expected count isn't known yet."""
    known = current_state(state, topic, query).where("expected is not null").select("outlet", F.col("day"))
    return pairs.select("outlet", F.col("day").cast("string").alias("day")).join(known, ["outlet", "day"], "left_anti")


def _once(state: DataFrame) -> DataFrame:
    return state.groupBy("topic", "query_hash", "outlet", "day").agg(F.max("complete").alias("complete"), F.max("expected").alias("expected"))


def header(df: DataFrame, topic: str, day: Column, updated: str) -> DataFrame:
    """The header row of a store: records, days, their range."""
    days = F.sort_array(F.collect_set(day))
    return df.agg(F.count(F.lit(1)).alias("record_count"), days.alias("dates_collected"), F.struct(F.min(day).alias("start"), F.max(day).alias("end")).alias("date_range")).select(F.lit(True).alias("_meta"), F.lit(topic).alias("topic"), "record_count", "dates_collected", "date_range", F.lit(updated).alias("last_updated"))


def snapshot_counts(rows: DataFrame, version: str, order: str) -> DataFrame:
    """Records of each version, with its place in the log (0: newest)."""
    return rows.groupBy(version, order).agg(F.count(F.lit(1)).alias("n"))


def best_snapshot(counts: DataFrame, version: str, order: str, by: str) -> DataFrame:
    """The version with the most, the first in the log of equal ones."""
    return counts.agg(F.max_by(version, F.struct(F.col(by), -F.col(order))).alias(version), F.max(by).alias(by))


def data_loss(counts: DataFrame, order: str) -> DataFrame:
    """One row: current and largest count, whether over half is lost, and the newest place with over 1.5 times the current count."""
    current = counts.agg(F.min_by("n", order).alias("current"), F.max("n").alias("largest"))
    found = counts.crossJoin(F.broadcast(current)).agg(F.first("current").alias("current"), F.first("largest").alias("largest"), F.min(F.when(F.col("n") > 1.5 * F.col("current"), F.col(order))).alias("first_larger"))
    return found.select("current", "largest", (F.col("largest") > 2 * F.col("current")).alias("lost"), "first_larger")


def checked_positions(revisions: DataFrame, file: str) -> DataFrame:
    """(file, n, position) of the revisions of each file to look at."""
    counts = revisions.groupBy(file).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(file, "n", F.explode(positions_to_check(F.col("n"))).alias("position"))


def nth_revision(log: DataFrame, order: str, n: int) -> DataFrame:
    """The n-th newest revision."""
    return log.orderBy(order).offset(n).limit(1)


def revisions_between(log: DataFrame, moment: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Revisions of days from start to end, both included; a missing bound is open."""
    day = F.to_date(moment)
    return log.where((day >= F.lit(start).cast("date") if start else F.lit(True)) & (day <= F.lit(end).cast("date") if end else F.lit(True)))


def restored(revisions: DataFrame, version: str) -> DataFrame:
    """All files (file, content) as they were at a version. revisions: version, file, content."""
    return revisions.where(F.col("version") == version).select("file", "content")


def line_changes(revisions: DataFrame, order: str) -> DataFrame:
    """(version, file, added, deleted): lines that a revision has more or less often than the one before it (``order``: 0 is the
    newest). Lines are counted by content, so a moved line is no change."""
    lines = revisions.select("file", order, F.explode(F.split("content", "\n")).alias("line")).groupBy("file", order, "line").agg(F.count(F.lit(1)).alias("n"))
    older = lines.select("file", (F.col(order) - 1).alias(order), "line", F.col("n").alias("old"))
    present = revisions.select("file", F.col(order), "version").distinct()
    both = lines.join(older, ["file", order, "line"], "full").join(present, ["file", order])
    more = F.coalesce("n", F.lit(0)) - F.coalesce("old", F.lit(0))
    return both.groupBy("version", "file").agg(F.sum(F.greatest(more, F.lit(0))).alias("added"), F.sum(F.greatest(-more, F.lit(0))).alias("deleted"))


def change_stats(revisions: DataFrame) -> DataFrame:
    """Lines and bytes of each file of each revision. revisions: version, file, content."""
    lines = F.length("content") - F.length(F.replace("content", F.lit("\n"), F.lit("")))
    return revisions.select("version", "file", lines.cast("long").alias("lines"), F.octet_length("content").cast("long").alias("bytes"))
