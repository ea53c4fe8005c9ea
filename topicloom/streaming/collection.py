"""The state of a collection as a stream: what is complete, and how many records are expected, by topic, outlet and day.

Reports of collectors come in any order and may come twice. The state of a (topic, outlet, day) is a value of its own,
so a busy topic is spread over tasks. It belongs to a query's hash: the first report under another hash forgets it. A
count that was taken on the day itself is of an unfinished day; a timer forgets it when that day is over, so that it is asked for again.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from topicloom.functions.text import query_hash

#: kind: complete or count (expected; negative: failed).
REPORT = "topic string, query string, outlet string, day string, kind string, expected long, at timestamp"
UPDATE = "topic string, outlet string, day string, query_hash string, complete boolean, expected long, micros long, step long"
CHANGED = Row(*[c.split()[0] for c in UPDATE.split(", ")])
STATE = "query_hash string, complete boolean, expected long, micros long, step long"


def _midnight(day: str) -> int:
    """When a day is over, in UTC, in milliseconds."""
    return int(datetime.combine(date.fromisoformat(day) + timedelta(days=1), datetime.min.time(), UTC).timestamp() * 1000)


class Collection(StatefulProcessor):
    """Folds the reports of a (topic, outlet, day) into its state; a row for each change."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", STATE)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        old = tuple(self.state.get()) if self.state.exists() else None
        state, wake = old and old[:4], None
        for r in sorted(rows, key=lambda r: (r["micros"], r["kind"], r["query_hash"], r["expected"] or 0)):
            if state is not None and r["micros"] < state[3] and r["query_hash"] != state[0]:
                continue  # a late report of a query that has been replaced
            if state is None or r["query_hash"] != state[0]:
                state = (r["query_hash"], False, None, r["micros"])
            complete, expected = state[1], state[2]
            if r["kind"] == "complete":
                complete = True
            elif r["expected"] is not None and r["expected"] >= 0 and expected is None:
                expected = r["expected"]
                if r["micros"] < 1000 * _midnight(key[2]):
                    wake = _midnight(key[2])
            state = (state[0], complete, expected, max(state[3], r["micros"]))
        if state is not None and state != (old and old[:4]):
            state = (*state, old[4] + 1 if old else 0)
            self.state.update(state)
            yield CHANGED(*key, *state)
        if wake is not None:
            self.handle.registerTimer(wake)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        if self.state.exists():
            hashed, complete, expected, micros, step = self.state.get()
            if expected is not None and not complete:
                state = (hashed, complete, None, micros, step + 1)
                self.state.update(state)
                yield CHANGED(*key, *state)

    def close(self) -> None:
        pass


def tracked(reports: DataFrame, late: str = "1 day") -> DataFrame:
    """Changes of state (UPDATE) of a stream of reports (REPORT). Reports later than the watermark are dropped; a known count stays until
    its timer, failed counts aren't kept, a missing topic, outlet or day is a key like others only where the day is a date: rows without a readable
    day are left out."""
    keyed = reports.where(F.col("day").try_cast("date").isNotNull()).withWatermark("at", late)
    keyed = keyed.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("topic", "outlet", "day")], query_hash(F.coalesce("query", F.lit(""))).alias("query_hash"), "kind", "expected", "at", F.unix_micros("at").alias("micros"))
    found = keyed.groupBy("topic", "outlet", "day").transformWithState(Collection(), UPDATE, "Update", "EventTime")
    return found.withColumn("at", F.timestamp_micros("micros")).drop("micros")


def standing(updates: DataFrame) -> DataFrame:
    """The state that the changes so far leave: the last of each key, if it belongs to its topic's latest query and says anything. Other topics' rows stay."""
    last = updates.groupBy("topic", "outlet", "day").agg(F.max_by(F.struct("query_hash", "complete", "expected", "at"), "step").alias("s")).select("topic", "outlet", "day", "s.*")
    latest = updates.groupBy("topic").agg(F.max_by("query_hash", F.struct("at", "query_hash")).alias("query_hash"))
    known = last.join(F.broadcast(latest), ["topic", "query_hash"])  # a row for each topic, which are settings
    return known.where("complete or expected is not null").select("topic", "query_hash", "outlet", "day", "complete", "expected")


def follow(reports: DataFrame, out: str, checkpoint: str, late: str = "1 day", **trigger) -> StreamingQuery:
    """Write the changes of state to ``out``, a folder for each batch, which is overwritten if the batch is tried again. Read them with ``changes``."""
    key, spark = "spark.sql.streaming.stateStore.providerClass", reports.sparkSession
    before = spark.conf.get(key, None)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")  # timers and values of one key need it
    try:
        writer = tracked(reports, late).writeStream.outputMode("update").option("checkpointLocation", checkpoint)
        return writer.foreachBatch(lambda batch, number: batch.write.mode("overwrite").parquet(f"{out}/batch={number}")).trigger(**(trigger or {"availableNow": True})).start()
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def changes(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(f"{UPDATE.replace('micros long', 'at timestamp')}, batch int").parquet(out)
