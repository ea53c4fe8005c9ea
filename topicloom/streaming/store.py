"""The growing store as a stream's sink.

Rows are kept in buckets by the hash of their key, and each bucket has a filter of its keys: bit maps, three bits
for a key, grouped by bucket and segment. A micro-batch is compared with the filters first, and only buckets that
may hold one of its keys are read, their key column alone. A version of the store names its folders, so a batch that
dies leaves nothing that counts, and one that is tried again is known by its number.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from topicloom.operators.rows import first_wins, unseen
from topicloom.sources import commits

#: Buckets of a store; a filter's bits for each segment (fixed by the bit maps' size), bits of a key, and keys of a segment when it is built.
BUCKETS, BITS, PROBES, FULL = 256, 32768, 3, 3000
#: Batches whose filters are kept apart before they are put together.
APART = 16


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _segment(key: Column, segments: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("segment")), F.lit(segments)).cast("int")


def _bits(key: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(k)), F.lit(BITS)).cast("long") for k in range(PROBES)]


def filters(rows: DataFrame, key: str, buckets: int, segments: int) -> DataFrame:
    """(bucket, segment, bits) of a frame's keys."""
    spots = rows.select(_bucket(F.col(key), buckets).alias("bucket"), _segment(F.col(key), segments).alias("segment"), F.explode(F.array(*_bits(F.col(key)))).alias("_bit"))
    return spots.groupBy("bucket", "segment").agg(F.bitmap_construct_agg("_bit").alias("bits"))


def _read(spark: SparkSession, folders: list[str], shape: StructType | str) -> DataFrame:
    """Rows of folders ``.../part={name}/bucket={number}``."""
    return spark.read.schema(shape).option("basePath", folders[0].rsplit("/", 1)[0]).parquet(*folders)


def _known_filters(spark: SparkSession, head: dict) -> DataFrame:
    every = _read(spark, head["filters"], "segment int, bits binary, part string, bucket int")
    return every.groupBy("bucket", "segment").agg(F.bitmap_or_agg("bits").alias("bits"))


def touched(batch: DataFrame, head: dict, key: str) -> list[int]:
    """Buckets that may hold a key of the batch: as many numbers as there are buckets at most."""
    asked = batch.select(F.col(key).alias("_key")).distinct()
    asked = asked.select(_bucket(F.col("_key"), head["buckets"]).alias("bucket"), _segment(F.col("_key"), head["segments"]).alias("segment"), *[b.alias(f"_b{k}") for k, b in enumerate(_bits(F.col("_key")))])
    bit = lambda b: F.conv(F.hex(F.substring(F.col("bits"), (F.expr(f"{b} div 8") + 1).cast("int"), F.lit(1))), 16, 10).cast("int").bitwiseAND(F.pow(F.lit(2), F.col(b) % 8).cast("int")) != 0
    maybe = asked.join(_known_filters(batch.sparkSession, head), ["bucket", "segment"])
    for k in range(PROBES):
        maybe = maybe.where(bit(f"_b{k}"))
    return sorted(r[0] for r in maybe.select("bucket").distinct().collect())


def rows_of(spark: SparkSession, head: dict, buckets: list[int] | None = None) -> DataFrame:
    """Rows of a version of the store, of some buckets only if they are named."""
    found = _read(spark, head["folders"], StructType.fromJson(head["schema"]).add("part", "string").add("bucket", "integer"))
    return (found if buckets is None else found.where(F.col("bucket").isin(buckets))).drop("part", "bucket")


def append(batch: DataFrame, store: str, number: int, key: str = "url", pos: str | None = None, source: str = "stream", buckets: int = BUCKETS) -> bool:
    """Add the rows whose key the store lacks; False if ``source`` has given a batch of this number before. With ``pos`` a batch is
    also deduplicated in itself. Null is a key like others. The columns must be those of the first batch."""
    spark, head = batch.sparkSession, commits.pointer(batch.sparkSession, store)
    done = head["batches"] if head else {}
    if number <= done.get(source, -1):
        return False
    fresh = batch
    if head:
        where = touched(batch, head, key)
        if where:
            fresh = unseen(batch, rows_of(spark, head, where).select(key), key)
    else:
        head = {"folders": [], "filters": [], "buckets": buckets, "segments": 1, "version": 0, "schema": json.loads(batch.schema.json())}
    if pos:
        fresh = first_wins(fresh, key, pos, blank=True)
    path, filter_path = commits.folder(store, "rows/part=r"), commits.folder(store, "filters/part=f")
    fresh.select(*[f["name"] for f in head["schema"]["fields"]]).withColumn("bucket", _bucket(F.col(key), head["buckets"])).write.partitionBy("bucket").parquet(path)
    filters(rows_of(spark, head | {"folders": [path]}), key, head["buckets"], head["segments"]).write.partitionBy("bucket").parquet(filter_path)
    known = [*head["filters"], filter_path]
    if len(known) > APART:
        whole = commits.folder(store, "filters/part=f")
        _known_filters(spark, head | {"filters": known}).write.partitionBy("bucket").parquet(whole)
        known = [whole]
    commits.commit(spark, store, head if head["version"] else None, [*head["folders"], path], None, filters=known, batches=done | {source: number}, buckets=head["buckets"], segments=head["segments"], schema=head["schema"])
    return True


def compact(spark: SparkSession, store: str, key: str = "url") -> int:
    """Put the folders of a store together, and build its filters anew, with segments for as many keys as there are; the version's number."""
    head = commits.pointer(spark, store)
    path, filter_path = commits.folder(store, "rows/part=r"), commits.folder(store, "filters/part=f")
    rows = rows_of(spark, head)
    bucket = _bucket(F.col(key), head["buckets"])
    rows.repartition(bucket).withColumn("bucket", bucket).write.partitionBy("bucket").parquet(path)
    written = rows_of(spark, head | {"folders": [path]})
    segments = max(1, -(-written.count() // (head["buckets"] * FULL)))
    filters(written, key, head["buckets"], segments).write.partitionBy("bucket").parquet(filter_path)
    return commits.commit(spark, store, head, [path], None, filters=[filter_path], batches=head["batches"], buckets=head["buckets"], segments=segments, schema=head["schema"])


def accumulate(stream: DataFrame, store: str, checkpoint: str, key: str = "url", pos: str | None = None, source: str = "stream", buckets: int = BUCKETS, **trigger) -> StreamingQuery:
    """Append to ``store`` the rows of a stream whose key it lacks. Streams that feed one store need names (``source``) of their own."""
    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda batch, number: append(batch, store, number, key, pos, source, buckets) and None).trigger(**(trigger or {"availableNow": True})).start()


def read_store(spark: SparkSession, store: str, version: int | None = None) -> DataFrame:
    """Rows of a version of the store, by default the newest."""
    return rows_of(spark, commits.pointer(spark, store, version))


def counts_by_day(events: DataFrame, ts: str = "ts", outlet: str = "event_type", late: str = "1 day") -> DataFrame:
    """Counts by (day, outlet) of a stream, with late rows up to a watermark."""
    return events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late).groupBy(F.window(ts, "1 day").alias("w"), outlet).agg(F.count(F.lit(1)).alias("n")).select(F.to_date("w.start").alias("day"), outlet, "n")
