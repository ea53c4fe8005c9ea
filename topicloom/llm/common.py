"""What the corpus operators share: bounded slices of Arrow batches, word rules, shared storage."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession

#: Text bytes that one Python step holds at once; one longer text is a slice of its own.
SLICE_BYTES = 4 << 20

#: Bytes of an Arrow batch on its way to Python.
BATCH_BYTES = 4 << 20

#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z, on UTF-8 bytes: every other byte is a separator.
#: Bytes from 0x80 only occur inside code points above U+007F, all of which are word characters.
ALNUM_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def alnum_words(text: bytes) -> list[bytes]:
    """Lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of UTF-8 bytes."""
    return text.translate(ALNUM_TABLE).split()


def space_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 bytes: just what bytes.split() separates by."""
    return text.split()


def slices(batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES, even: bool = False) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``limit`` bytes of text at most (or one row). even: slices of about one size near the
    limit, so that a batch a little over it leaves no small rest."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        end, at = np.cumsum(size), 0
        step = max(1, int(end[-1])) / max(1, round(int(end[-1]) / limit))
        while at < batch.num_rows:
            done = end[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(end, round(step * round(done / step + 1)) if even else done + limit, "right")))
            yield batch.slice(at, to - at)
            at = to
    give_back()


def give_back() -> None:
    """Freed memory goes back to the system, where the C library can do so: workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def keep_freed() -> None:
    """Memory that arrays free stays with the process for the next ones, 256 MB at most (by default, arrays of megabytes are returned
    and cleared anew, one by one), until ``give_back``."""
    if option := getattr(ctypes.CDLL(None), "mallopt", None):
        option(-1, 256 << 20)  # what the heap's end keeps
        option(-3, 32 << 20)  # larger arrays are still returned by themselves


def texts(batch: pa.RecordBatch, text: str = "text") -> list[bytes]:
    """UTF-8 bytes of a text column; null becomes empty."""
    return [x or b"" for x in batch.column(text).cast(pa.large_binary()).to_pylist()]


def bounded(docs: DataFrame) -> DataFrame:
    """The same frame, in a session whose Arrow batches hold BATCH_BYTES at most: rows differ in size by orders of magnitude."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark = docs.sparkSession
    if spark.conf.get(key, None) != str(BATCH_BYTES):
        spark.conf.set(key, str(BATCH_BYTES))
    return docs


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; where that is unset, a temporary one on a single
    machine, and an error on a cluster."""
    place = spark.conf.get("spark.checkpoint.dir", None)
    if not place:
        place = spark.sparkContext.getCheckpointDir()
    if not place:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir isn't set: executors and driver share no folder")
        place = tempfile.mkdtemp(prefix="corpus-checkpoint-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(place)
    return place


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a path that this session wrote."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def freeing(spark: SparkSession) -> Iterator[None]:
    """Spark deletes a query's shuffle files when it ends, here: steps that go on from written tables don't need them again."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def cut(df: DataFrame) -> DataFrame:
    """Compute once and forget the lineage, by a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


class Ids(dict):
    """Numbers keys from 0 in the order of their first lookup."""

    def __missing__(self, key):
        self[key] = found = len(self)
        return found


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words (the finaliser of MurmurHash3)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


#: Words of more bytes are hashed by themselves.
LONG = 4096


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words between ASCII white space begin, and their bytes; the data ends in white space."""
    solid = np.ones(256, bool)
    solid[list(b" \t\n\v\f\r")] = False
    inside = solid[np.frombuffer(data, np.uint8)]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edge = np.append(0, edge)
    return edge[::2], edge[1::2] - edge[::2]


def eights(data: bytes) -> np.ndarray:
    """Of each byte, it and the seven after it as a number; nothing after the end."""
    return np.ndarray((len(data) + 1,), "<u8", buffer=data + bytes(8), strides=(1,))


def word_keys(data: bytes, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hashes of words in UTF-8 bytes, eight bytes at a time, all words at once."""
    view = eights(data)
    factor = np.uint64(0x9FB21C651E98DF25)
    with np.errstate(over="ignore"):
        key = mix64(size.astype(np.uint64) + np.uint64(1))
        live, at = np.flatnonzero(size <= LONG), 0
        while len(live):
            left = size[live] - at
            some = view[start[live] + at]
            short = left < 8
            some[short] &= (np.uint64(1) << (8 * left[short]).astype(np.uint64)) - np.uint64(1)
            key[live] = mix64((key[live] ^ some) * factor)
            live, at = live[left > 8], at + 8
    for k in np.flatnonzero(size > LONG):
        key[k] = xxhash.xxh3_64_intdigest(data[start[k] : start[k] + size[k]])
    return key
