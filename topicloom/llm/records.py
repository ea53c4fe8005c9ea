"""Token ids as length-delimited binary records.

A record is framed as: payload length (u64), its masked checksum (u32), payload, the
payload's masked checksum (u32), and a line feed; all little-endian. The payload is the
document id (a flag byte and i64), the width of an id in bytes (u8), and the ids. Checksums
are CRC-32, rotated by 15 bits and shifted by a constant, so that a checksum of data that
holds checksums stays sound. Files are written by Spark's own committer to any storage that
Spark writes to; a separate table, the offset index, gives each record's file, offset and
size for shuffled reads.
"""

from __future__ import annotations

import re
import string
import struct
import unicodedata
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, compress, repeat
from operator import not_

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from topicloom.llm.blobs import grouped
from topicloom.llm.common import bounded, eights, remove_path, shared_path, slices, texts, word_keys, word_spans

MASK_DELTA = 0xA282EAD8
END_ID = 1
#: Chunks of text whose ids a worker remembers.
MEMORY = 500_000
#: ASCII punctuation that no pattern of the splitter joins to letters: all but the apostrophe.
PUNCTUATION = string.punctuation.replace("'", "").encode()
#: Text bytes that are encoded at once.
PIECE = 2 << 20
HEAD, TAIL, DOC = struct.Struct("<QI"), struct.Struct("<I"), struct.Struct("<BqB")


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return b"".join((size, TAIL.pack(masked(size)), payload, TAIL.pack(masked(payload)), b"\n"))


def unframe(data: bytes | memoryview, at: int) -> tuple[memoryview, int]:
    """The payload of the record at an offset, and the next record's offset; ValueError if it is damaged."""
    view = memoryview(data)
    if at + HEAD.size > len(view):
        raise ValueError(f"record at {at}: cut off")
    size, check = HEAD.unpack_from(view, at)
    start = at + HEAD.size
    if masked(bytes(view[at : at + 8])) != check or start + size + TAIL.size + 1 > len(view):
        raise ValueError(f"record at {at}: damaged length")
    payload = view[start : start + size]
    if masked(payload) != TAIL.unpack_from(view, start + size)[0] or view[start + size + TAIL.size] != 10:
        raise ValueError(f"record at {at}: damaged payload")
    return payload, start + size + TAIL.size + 1


def pack(doc: int | None, ids: bytes, width: int) -> bytes:
    """The payload of a document's ids."""
    return DOC.pack(doc is not None, doc or 0, width) + ids


def unpack(payload: memoryview) -> tuple[int | None, np.ndarray]:
    """Document id and token ids of a payload."""
    known, doc, width = DOC.unpack_from(payload, 0)
    return (doc if known else None), np.frombuffer(payload, f"<u{width}", offset=DOC.size)


def tokenizer_path() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def parted(texts: list[bytes]) -> tuple[bytes, np.ndarray]:
    """The texts in ASCII lower case, with a space between an ASCII letter and a full stop or comma after it, one after another, a
    line feed after each; and where each ends. Texts with combining marks (U+0300 to U+037F) keep their case: a small letter may
    compose with a mark where a capital doesn't."""
    whole = b"\n".join([*texts, b""])
    if b"\xcc" in whole or b"\xcd" in whole:
        whole = b"\n".join([*[t if b"\xcc" in t or b"\xcd" in t else t.lower() for t in texts], b""])
    else:
        whole = whole.lower()
    data = np.frombuffer(whole, np.uint8)
    stop = (data == 0x2C) | (data == 0x2E)
    letter = (data | 0x20 >= 0x61) & (data | 0x20 <= 0x7A)
    place = np.flatnonzero(stop[1:] & letter[:-1]) + 1
    ends = np.cumsum([len(t) + 1 for t in texts])
    return np.insert(data, place, 0x20).tobytes(), ends + np.searchsorted(place, ends)


def first_bytes(eight: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The lowest n bytes of each number."""
    return eight & np.where(n < 8, (np.uint64(1) << (8 * np.minimum(n, 7)).astype(np.uint64)) - np.uint64(1), ~np.uint64(0))


class Encoder:
    """Ids of whole texts, from those of their chunks between ASCII white space.

    The vocabulary's normaliser and splitter never join what white space parts (canonical composition doesn't cross
    it, no pattern spans it), so a text's ids are its chunks' ids in order. Nor do they join an ASCII letter to a full stop
    or comma after it, so those are parted too, and ASCII case is dropped first. Chunks are encoded once and remembered. Runs of
    letters or of punctuation, also those of chunks of letters and then punctuation, are encoded many in a string, as each has one
    end mark; if the marks don't add up, and for other chunks, one by one. A letter is what the library's own normaliser and splitter
    leave as one piece before punctuation: U+0130, whose small form ends in a mark that joins it, is none.

    A call takes the vocabulary's special tokens as text, in chunks; ``whole`` gives them their own ids, as the library does."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        special = {t.content.encode(): np.array([i]) for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special}
        self.special = re.compile(b"(%b)" % b"|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.tokenizer.encode_special_tokens = True  # for chunks, which are in lower case
        # the same model for runs that its normaliser would leave alone and its splitter would leave whole
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.tokenizer.get_vocab()
        self.width = 2 if max(vocab.values()) < 1 << 16 else 4
        self.letters: dict[str, bool] = {}
        self.special_ids = {t: i.astype(f"<u{self.width}").tobytes() for t, i in special.items()}
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        if suffix:
            self.ends[[i for token, i in vocab.items() if token.endswith(suffix)]] = True
        self.forget()

    def forget(self) -> None:
        self.known: dict[int, int] = {}  # chunks' numbers by their hashes; beside a hash, a chunk's bytes and first eight of them are compared
        self.bytes, self.head = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        self.start, self.size, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, f"<u{self.width}")  # by chunk: first id, ids; all ids

    def _each(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks in a row, and how many each has."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast([c.decode() for c in chunks], add_special_tokens=False)]
        size = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), self.flat.dtype, int(size.sum())), size

    def _joined(self, runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same for runs of letters or of punctuation, each of which has one end mark."""
        lines = [b" ".join(runs[at : at + 256]).decode() for at in range(0, len(runs), 256)]
        same = all(unicodedata.is_normalized("NFC", x) and x.lower() == x for x in lines)
        found = (self.plain if same else self.tokenizer).encode_batch_fast(lines, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, self.flat.dtype) for e in found])
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(runs) or stops[-1] != len(ids):
            return self._each(runs)
        return ids, np.diff(stops, prepend=0)

    def lettered(self, text: str) -> bool:
        """Whether a run is made of letters only."""
        if text.isascii():
            return text.isalpha()
        for c in set(text).difference(self.letters):
            pieces = self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(c + "."))
            self.letters[c] = c.isalpha() and len(pieces) == 2 and pieces[1][0] == "."
        return all(map(self.letters.__getitem__, text))

    def learn(self, chunks: list[bytes]) -> None:
        """Encode distinct chunks that aren't known."""
        letters = list(map(bytes.isalpha, chunks))
        runs, more, split, other = list(compress(chunks, letters)), set(), [], []
        for chunk in compress(chunks, map(not_, letters)):
            if chunk.isascii():
                head = chunk.rstrip(PUNCTUATION)
                plain = not head or head.isalpha()
            else:
                core = chunk.decode().rstrip(PUNCTUATION.decode())
                head = core.encode()
                plain = not core or self.lettered(core)
            if not plain:
                other.append(chunk)
            elif not head or len(head) == len(chunk):
                more.add(chunk)
            else:
                split.append((chunk, head, chunk[len(head) :]))
        parts = list({part for _, *parts in split for part in parts})
        more.update(part for part, known in zip(parts, self.numbers(parts), strict=True) if known < 0)
        runs += more.difference(runs)
        for encode, part, all_of in ((self._joined, 20_000, runs), (self._each, 5_000, other)):
            for at in range(0, len(all_of), part):
                some = all_of[at : at + part]
                self._store(some, *encode(some))
        if split:
            place = dict(zip(parts, self.numbers(parts).tolist(), strict=True))
            parts = np.array([[place[core], place[tail]] for _, core, tail in split]).ravel()
            self._store([chunk for chunk, _, _ in split], self._ids(parts), self.size[parts].reshape(-1, 2).sum(axis=1))

    def _ids(self, index: np.ndarray) -> np.ndarray:
        """Ids of known chunks in a row."""
        size = self.size[index]
        return self.flat[np.repeat(self.start[index] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))]

    def _store(self, chunks: list[bytes], ids: np.ndarray, size: np.ndarray) -> None:
        data = b" ".join([*chunks, b""])
        start, width = word_spans(data)
        self.known.update(zip(word_keys(data, start, width).tolist(), range(len(self.start), len(self.start) + len(chunks)), strict=True))
        self.start = np.append(self.start, len(self.flat) + np.cumsum(size) - size)
        self.size = np.append(self.size, size)
        self.flat = np.append(self.flat, ids)
        self.bytes, self.head = np.append(self.bytes, width), np.append(self.head, eights(data)[start])

    def numbers(self, chunks: list[bytes]) -> np.ndarray:
        """Numbers of chunks; -1 for those that aren't known."""
        data = b" ".join([*chunks, b""])
        return np.fromiter(map(self.known.get, word_keys(data, *word_spans(data)).tolist(), repeat(-1)), np.int64, len(chunks))

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        data, ends = parted(texts)
        start, width = word_spans(data)
        if not len(start):
            return [b""] * len(texts)
        if len(self.known) > MEMORY:
            self.forget()
        keys, head = word_keys(data, start, width), eights(data)[start]
        one, number = grouped(keys)
        index = np.fromiter(map(self.known.get, keys[one].tolist(), repeat(-1)), np.int64, len(one))
        new = np.flatnonzero(index < 0)
        if len(new):
            chunks = [data[a:b] for a, b in zip(start[one[new]].tolist(), (start + width)[one[new]].tolist(), strict=True)]
            self.learn(chunks)
            index[new] = self.numbers(chunks)
        index = index[number]
        shown = np.minimum(width, 8)
        if (self.bytes[index] != width).any() or (first_bytes(self.head[index], shown) != first_bytes(head, shown)).any():  # one hash, two chunks
            return [np.array(e.ids, self.flat.dtype).tobytes() for e in self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)]
        ids = self._ids(index)
        edges = np.append(0, np.cumsum(self.size[index]))[np.append(0, np.searchsorted(start, ends))]
        return [ids[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]

    def whole(self, texts: list[bytes]) -> list[bytes]:
        """The ids that the library gives to texts by default: the exact strings of special tokens part a text, before its
        case is dropped, and have their own ids."""
        if self.special is None or not any(map(self.special.search, texts)):
            return self(texts)
        split = [self.special.split(t) for t in texts]  # text and special token in turn
        ids = iter(self([part for parts in split for part in parts[::2]]))
        return [b"".join(self.special_ids[part] if k % 2 else next(ids) for k, part in enumerate(parts)) for parts in split]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)


def file_size(spark: SparkSession) -> int:
    """Text bytes that go into a file: half of what the session reads as one partition, since a file is read back at once."""
    setting = spark.conf.get("spark.sql.files.maxPartitionBytes")
    return max(1, spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(setting) // 2)


def write_records(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end_id: int = END_ID, file_bytes: int | None = None) -> None:
    """Encode every whole text (null: empty), append ``end_id``, and write the records in ascending order of id (null
    first, then by the text's hash): file names in order, and records in each file. Ids must be integers. Repeated rows are
    repeated records, and may be in several files; a very long text is encoded at once. An empty table leaves no files."""
    tokenizer = tokenizer or tokenizer_path()
    file_bytes = file_bytes or file_size(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        end = np.array([end_id], f"<u{encode.width}").tobytes()
        for batch in slices(batches, "_text", PIECE):
            records = [frame(pack(doc, ids + end, encode.width)) for doc, ids in zip(batch.column("_id").to_pylist(), encode.whole(texts(batch, "_text")), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], names=["record"])

    source = bounded(docs).select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    size = source.agg(F.sum(F.coalesce(F.octet_length("_text"), F.lit(0)) + 16)).first()[0] or 0
    # rows that agree in id and text are alike, so any order of them will do: their places in the input part a hot id
    keys = [F.col("_id").asc_nulls_first(), F.col("_hash"), F.col("_row")]
    keyed = source.withColumn("_hash", F.xxhash64("_text")).withColumn("_row", F.monotonically_increasing_id())
    ordered = keyed.repartitionByRange(max(1, -(-size // file_bytes)), *keys).sortWithinPartitions(*keys).select("_id", "_text")
    # a text column takes bytes as they are; the line feed of a frame is the writer's separator
    ordered.mapInArrow(run, "record binary").select(F.expr("cast(substring(record, 1, length(record) - 1) as string)").alias("value")).write.mode("overwrite").option("lineSep", "\n").text(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, at, size, doc_id, n_tokens, ids_crc32) of each record; every checksum is verified. ``ids_crc32``: unsigned
    crc32 of the ids as little-endian unsigned 32-bit integers."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column("file").to_pylist(), batch.column("content"), strict=True):
                data, at, rows = memoryview(data.as_buffer()), 0, []
                while at < len(data):
                    payload, then = unframe(data, at)
                    doc, ids = unpack(payload)
                    rows.append((at, then - at, doc, len(ids), zlib.crc32(ids.astype("<u4"))))
                    at = then
                columns = list(zip(*rows, strict=True)) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(rows), pa.string()), *[pa.array(c, pa.int64()) for c in columns]], names=["file", "at", "size", "doc_id", "n_tokens", "ids_crc32"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content").mapInArrow(run, "file string, at long, size long, doc_id long, n_tokens long, ids_crc32 long")


def with_starts(records: DataFrame) -> DataFrame:
    """Add ``start``, the number of ids in all records before: sums by file, then inside each file."""
    sums = records.groupBy("file").agg(F.sum("n_tokens").alias("_n"))
    ahead = sums.select(F.col("file").alias("_f"), F.coalesce(F.sum("_n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_ahead"))
    inside = F.coalesce(F.sum("n_tokens").over(Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return records.withColumn("_in", inside).join(ahead, F.col("file") == F.col("_f")).withColumn("start", F.col("_ahead") + F.col("_in")).drop("_f", "_ahead", "_in")


def export(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Write records and the offset index under ``path`` (``records`` and ``index``); gives back the index with
    ``start``, as read from storage."""
    spark = docs.sparkSession
    write_records(docs, f"{path}/records", id_col, text_col, **options)
    read_records(spark, f"{path}/records").write.mode("overwrite").parquet(f"{path}/index")  # all ids are read once, for this
    return with_starts(spark.read.parquet(f"{path}/index"))


def fetch(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """(doc_id, ids) of the index rows in ``wanted`` (file, at): a shuffled read of records by their offsets."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, places in zip(batch.column("content"), batch.column("places").to_pylist(), strict=True):
                view = memoryview(data.as_buffer())
                got = [unpack(unframe(view, at)[0]) for at in places]
                yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.int64()), pa.array([g[1].tolist() for g in got], pa.list_(pa.int64()))], names=["doc_id", "ids"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/records").select(F.element_at(F.split("path", "/"), -1).alias("_f"), "content")
    places = wanted.groupBy("file").agg(F.collect_list("at").alias("places"))  # a file's records are bounded by its size
    return files.join(places, F.col("_f") == F.col("file")).select("content", "places").mapInArrow(run, "doc_id long, ids array<long>")


def encoded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The digest of a fresh export in the shared folder: doc_id, start, n_tokens, ids_crc32, file, at, size."""
    spark = docs.sparkSession
    path = shared_path(spark, "records")
    return export(docs, path, id_col, text_col, **options).select("doc_id", "start", "n_tokens", "ids_crc32", "file", "at", "size")


__all__ = ["Encoder", "encoded", "export", "fetch", "frame", "read_records", "remove_path", "unframe", "unpack", "with_starts", "write_records"]
