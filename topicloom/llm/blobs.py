"""Questions and answers between blocks of documents and parts of a table, as arrays in binary columns.

A block asks about each of its distinct keys once; keys are dealt to parts by ranges of their hashes, so that a part has all
of a key, counted once for a block; a part answers each block in the order of its questions. A row is a block's array for a
part, so the JVM handles few rows, and no key is hot.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from topicloom.llm.common import BATCH_BYTES, freeing

BLOBS = "block long, part int, a binary, b binary, c binary, d binary, e binary"
SHAPE = pa.schema([("block", pa.int64()), ("part", pa.int32()), *[(k, pa.binary()) for k in "abcde"]])


def planes(x: np.ndarray) -> bytes:
    """Whole numbers from 0 by their bytes' places, lowest first: small, and what is small mostly compresses well."""
    wide = max(1, -(-int(x.max(initial=0)).bit_length() // 8))
    return bytes([wide]) + np.ascontiguousarray(x.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :wide].T).tobytes()


def unplanes(data: bytes) -> np.ndarray:
    wide = data[0]
    some = np.frombuffer(data, np.uint8, offset=1).reshape(wide, -1)
    out = some[0].astype(np.int64)
    for k in range(1, wide):
        out |= some[k].astype(np.int64) << (8 * k)
    return out


def grouped(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each distinct key, in order, one place; of each key, its number."""
    order = np.argsort(key)
    ordered = key[order]
    new = np.ones(len(key), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    number = np.empty(len(key), np.int64)
    number[order] = np.cumsum(new, dtype=np.int64) - 1
    return order[new], number


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of runs, one run after another."""
    return np.repeat(start - np.cumsum(size) + size, size) + np.arange(int(size.sum()))


def edges_of(parts: int) -> np.ndarray:
    """The least hash of each part: parts are ranges of hashes."""
    return np.array([(p << 64) // parts for p in range(parts)], np.uint64)


def row(block: int | None, part: int | None, *blobs: bytes) -> pa.RecordBatch:
    some = [*blobs, *[None] * (5 - len(blobs))]
    return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((block, part, *some), SHAPE.types, strict=True)], schema=SHAPE)


def rows(found: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows (block, part, blobs ...) in batches of megabytes: a batch costs several times what a small row does."""
    held, size = [], 0
    for block, part, *blobs in found:
        held.append((block, part, *blobs, *[None] * (5 - len(blobs))))
        size += sum(map(len, blobs))
        if size >= BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*held, strict=True), SHAPE.types, strict=True)], schema=SHAPE)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*held, strict=True), SHAPE.types, strict=True)], schema=SHAPE)


def part_of(key: np.ndarray, parts: int) -> np.ndarray:
    """The part of each hash: equal ranges of their upper halves."""
    part = (key >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
    return part.astype(np.uint16 if parts <= 1 << 16 else np.int64)  # small numbers are sorted digit by digit


def columns(table: pa.Table, kinds: str) -> Iterator[tuple]:
    """(block, part, blobs ...) of each row, in the order of block and part. kinds: by column, u for hashes, i for planes, f for
    singles, d for doubles, b for bytes."""
    read = {"u": lambda x: np.frombuffer(x, np.uint64), "i": unplanes, "f": lambda x: np.frombuffer(x, np.float32), "d": lambda x: np.frombuffer(x, np.float64), "b": bytes}
    blocks, parts = table.column("block").to_pylist(), table.column("part").to_pylist()
    for k in sorted(range(len(blocks)), key=lambda k: (blocks[k] or 0, parts[k])):
        yield blocks[k], parts[k], *[read[kind](table.column(name)[k].as_buffer()) for name, kind in zip("abcde", kinds, strict=False)]


def save(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write rows of blobs, by kind if they have one; small row groups, so that a few blocks are a task.

    Sizes are looked at from the first row on: by default a page and a row group have 100 rows at least, here hundreds of megabytes,
    which the writer holds and every reader decodes at once."""
    writer = df.write.mode(mode).option("compression", "zstd").option("parquet.block.size", 8 << 20)
    for what in ("parquet.page.size.row.check.min", "parquet.block.size.row.check.min"):
        writer = writer.option(what, 1)
    with freeing(df.sparkSession):
        (writer.partitionBy("kind") if "kind" in df.columns else writer).parquet(path)


def move(spark: SparkSession, source: str, target: str) -> None:
    """A finished table gets its place among the answers."""
    jvm = spark.sparkContext._jvm
    a, b = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    files = a.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(b.getParent())
    if not files.rename(a, b):
        raise OSError(f"{source} can't be renamed to {target}")


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    found = jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(found)
