"""Where rows go: JSON lines with a header beside them, single documents, versioned backups, publishers."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.sources import commits
from topicloom.sources.jsonl import is_header


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that driver and executors share (spark.checkpoint.dir); on one machine without it, a temporary one."""
    place = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not place:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir isn't set: executors and driver share no folder")
        place = tempfile.mkdtemp(prefix="store-")
    return f"{place.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _write_text(df: DataFrame, text: str, path: str) -> None:
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    out.write(bytearray(text.encode()))
    out.close()


def write_jsonl(df: DataFrame, path: str, header: dict | None = None, mode: str = "overwrite", keep_nulls: bool = True) -> None:
    """JSON lines in a folder, in parallel; the header goes to ``_meta.json`` in it. ``mode`` may be append."""
    df.write.mode(mode).option("ignoreNullFields", str(not keep_nulls).lower()).json(path)
    if header is not None:
        _write_text(df, json.dumps(header, ensure_ascii=False) + "\n", f"{path}/_meta.json")


def write_ordered(df: DataFrame, path: str, order: list[Column], header: dict | None = None) -> None:
    """The same in a global order: sorted ranges, files in the order of their names."""
    write_jsonl(df.orderBy(*order), path, header, keep_nulls=False)


def write_document(df: DataFrame, path: str, pos: str, **meta) -> None:
    """One JSON document {"_meta": ..., "stories": [...]} of all rows in the order of ``pos``, a row to a line, written in parallel: the files in the
    order of their names, one after another, are the document. ``pos`` isn't among the rows' fields; it must be a number."""
    first = df.agg(F.min(pos)).first()[0]
    fields = [c for c in df.columns if c != pos]
    record = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    head = json.dumps({"_meta": meta}, ensure_ascii=False)[:-1] + ', "stories": ['
    rows = df.select(F.lit(1).alias("part"), F.col(pos).cast("double").alias("pos"), F.concat(F.when(F.col(pos) == first, "").otherwise(","), record).alias("value"))
    edges = df.sparkSession.createDataFrame([(0, None, head), (2, None, "]}")], "part int, pos double, value string")
    edges.unionByName(rows).orderBy("part", "pos").select("value").write.mode("overwrite").text(path)


def with_header(lines: DataFrame, header: Column, file: str, flag: str = "_manifest") -> DataFrame:
    """Lines (file, pos, line) of files with their header line replaced, or put first where the first line is none: ``header`` is JSON from
    the file's columns, the same on all of its lines."""
    old = (F.col("pos") == 0) & is_header(F.col("line"), (flag,))
    has = lines.where(old).select(F.col(file).alias("_f")).distinct()
    rest = lines.where(~old).join(has.withColumn("_had", F.lit(True)), F.col(file) == F.col("_f"), "left")
    rest = rest.select(file, (F.col("pos") + F.when(F.col("_had"), 0).otherwise(1)).cast("int").alias("pos"), "line")
    first = lines.groupBy(file).agg(F.min(header).alias("line")).select(file, F.lit(0).alias("pos"), "line")
    return first.unionByName(rest)


def placeholder(df: DataFrame, path: str, topic: str) -> None:
    """A store without records: only its header."""
    write_jsonl(df.limit(0), path, {"_meta": True, "topic": topic, "record_count": 0})


def backup_then_write(df: DataFrame, store: str, header: dict | None = None) -> int | None:
    """Replace a store's rows and keep those it had: the number of the version that is the backup now, None for a new store. Readers see
    the old rows or the new ones, whenever this ends. Read either with ``commits.read``."""
    before = commits.pointer(df.sparkSession, store)
    commits.replace(df, store, header)
    return before["version"] if before else None


def publish(path: str, publisher: Callable[[str], None] | None = None) -> bool:
    """Hand a written path to a publisher; without one nothing happens."""
    if publisher is None:
        return False
    publisher(path)
    return True
