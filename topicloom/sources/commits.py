"""Stores that are replaced or grow all at once: rows go to folders of fresh names, a pointer names those that count.

A pointer is a small file ``_versions/{number}.json`` with the folders of a version, its header and what else the writer
notes. It is written beside and renamed into its place last, so readers see a whole version or the one before, and a writer that
dies leaves only a folder that nothing names. A second writer of the same number fails. Old pointers are the backups: their
folders aren't touched. The file system's renames must be atomic.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.sources import jsonl


class Conflict(RuntimeError):
    """Another writer has made the version."""


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    return jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def numbers(spark: SparkSession, store: str) -> list[int]:
    """Numbers of a store's versions, the oldest first."""
    files, folder = _files(spark, store), _path(spark, f"{store}/_versions")
    names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def pointer(spark: SparkSession, store: str, version: int | None = None) -> dict | None:
    """What a version's pointer says (default: the newest); None for a store without versions."""
    known = numbers(spark, store)
    if not known or (version is not None and version not in known):
        return None
    number = known[-1] if version is None else version
    source = _files(spark, store).open(_path(spark, f"{store}/_versions/{number:012d}.json"))
    text = bytes(spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(source)).decode()
    source.close()
    return json.loads(text)


def commit(spark: SparkSession, store: str, after: dict | None, folders: list[str], header: dict | None = None, now: Callable[[], datetime] = lambda: datetime.now(UTC), **notes) -> int:
    """Make the version after ``after`` (a pointer; None: the first); its number. Conflict if there is one already."""
    number = after["version"] + 1 if after else 1
    body = json.dumps({"version": number, "folders": folders, "header": header, "at": now().isoformat(), **notes}, ensure_ascii=False)
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    fresh, final = _path(spark, f"{store}/_versions/.{uuid.uuid4().hex}"), _path(spark, f"{store}/_versions/{number:012d}.json")
    out = _files(spark, store).create(fresh, False)
    out.write(bytearray(body.encode()))
    out.close()
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = gateway.new_array(kind, 1)
    options[0] = kind.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri() if final.toUri().getScheme() else _files(spark, store).getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(fresh, final, options)
    except Exception as e:
        _files(spark, store).delete(fresh, False)
        if "AlreadyExists" in str(e):
            raise Conflict(f"version {number} of {store} exists") from None
        raise
    return number


def folder(store: str, name: str) -> str:
    """A fresh folder's path in a store."""
    return f"{store.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def replace(df: DataFrame, store: str, header: dict | None = None, append: bool = False, order: list[Column] | None = None, keep_nulls: bool = True, **notes) -> int:
    """Make a version of JSON lines: of these rows, or of the newest version's and these. ``df`` may read the store. order: a global
    one, by files' names. The version's number; the one before stays readable as a backup."""
    spark, before = df.sparkSession, pointer(df.sparkSession, store)
    path = folder(store, "rows")
    (df.orderBy(*order) if order else df).write.option("ignoreNullFields", str(not keep_nulls).lower()).json(path)
    return commit(spark, store, before, [*(before["folders"] if append and before else []), path], header, **notes)


def read(spark: SparkSession, store: str, schema: str, version: int | None = None, **options) -> DataFrame:
    """Rows of a version (default: the newest) with ``path`` and ``pos``; ValueError if there is none."""
    found = pointer(spark, store, version)
    if found is None:
        raise ValueError(f"{store} has no version{'' if version is None else f' {version}'}")
    return jsonl.read(spark, found["folders"], schema, **options)


def restore(spark: SparkSession, store: str, version: int, **notes) -> int:
    """Make an old version the newest again, as a version of its own; no rows are written."""
    old = pointer(spark, store, version)
    if old is None:
        raise ValueError(f"{store} has no version {version}")
    return commit(spark, store, pointer(spark, store), old["folders"], old["header"], restored=version, **notes)


def history(spark: SparkSession, store: str) -> DataFrame:
    """(version, at, n_folders, record_count, restored) of all versions, the newest first: a row for each commit."""
    rows = [(p["version"], p["at"], len(p["folders"]), (p["header"] or {}).get("record_count"), p.get("restored")) for p in (pointer(spark, store, n) for n in numbers(spark, store))]
    return spark.createDataFrame(rows, "version long, at string, n_folders long, record_count long, restored long").orderBy(F.desc("version"))
