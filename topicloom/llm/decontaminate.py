"""Benchmark decontamination by training suffix arrays.

Each slice of the documents is a shard: its words, numbered by the benchmark's vocabulary,
are indexed by a suffix array, and every suffix of every benchmark item that has a window's
words is binary-searched in it. That gives all places where its window starts; from there the
longest verbatim match is found by binary search among the benchmark's suffixes. Parts of a
shard with fewer words of the benchmark's vocabulary in a row than the shortest window has can
match no window and are left out of the array.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from topicloom.llm.blobs import grouped, spread
from topicloom.llm.common import alnum_words, bounded, shared_path, slices, texts

WINDOW = 13
#: Bytes of benchmark text sent to executors at once; a larger benchmark is searched in blocks of about this size.
BLOCK_BYTES = 8 << 20
SCHEMA = "_id {id}, _th long, n_words long, hits array<struct<start:long,stop:long>>, items array<string>, longest long, longest_at long, longest_item string"


class Queries:
    """Windows and suffixes of a block of benchmark items, as arrays; items of the same words are searched for once."""

    def __init__(self, items: Iterable[tuple[str, bytes]], window: int = WINDOW):
        self.vocab: dict[bytes, int] = {}
        self.window, every, known = window, [], {}
        self.names: list[list[str]] = []
        for name, text in items:
            found = alnum_words(text)
            words = np.fromiter((self.vocab.setdefault(w, len(self.vocab)) for w in found), np.int32, len(found))
            if len(words):
                k = known.setdefault(words.tobytes(), len(every))
                if k == len(every):
                    every.append(words)
                    self.names.append([])
                self.names[k].append(name)
        del known
        self.names = [sorted(set(x)) for x in self.names]
        length = np.array([len(x) for x in every], np.int64)
        start = np.cumsum(length + 1) - length - 1
        end = np.array([-2], np.int32)
        self.flat = np.concatenate([*(y for x in every for y in (x, end)), np.full(window, -2, np.int32)])
        size = np.minimum(window, length)
        many = length - size + 1
        owner = np.repeat(np.arange(len(every)), many)
        suffix = spread(start, many)
        left = start[owner] + length[owner] - suffix
        size = size[owner]
        self.least, self.deepest = int(size.min(initial=window)), int(left.max(initial=0))
        # the suffixes in order; those that begin with one window lie together
        order = np.argsort(_ranks(self.flat.astype(np.int64), self.deepest)[suffix], kind="stable") if len(suffix) else suffix
        self.suffix, self.size, self.left, self.owner = (x[order].astype(np.int32) for x in (suffix, size, left, owner))
        same = self.size[1:] == self.size[:-1]
        for k in range(window):
            inside = k < self.size[1:]
            same &= ~inside | (self.flat[np.minimum(self.suffix[1:] + k, len(self.flat) - 1)] == self.flat[np.minimum(self.suffix[:-1] + k, len(self.flat) - 1)])
        new = np.append(np.ones(min(1, len(suffix)), bool), ~same)
        self.heads = np.flatnonzero(new).astype(np.int32)
        self.group = np.cumsum(new, dtype=np.int32) - 1

    def items(self, groups: np.ndarray) -> list[int]:
        """Items that hold any of some windows, which are numbered in order."""
        edge = np.append(self.heads, len(self.group))
        return np.unique(self.owner[spread(edge[groups].astype(np.int64), (edge[groups + 1] - edge[groups]).astype(np.int64))]).tolist()

    def words(self, text: bytes) -> np.ndarray:
        found = alnum_words(text)
        return np.fromiter(map(self.vocab.get, found, repeat(-1)), np.int64, len(found))


def _ranks(flat: np.ndarray, depth: int) -> np.ndarray:
    """Of each place the rank of the suffix that starts there, compared over ``depth`` words at least, by doubling. A negative word
    ends a suffix; suffixes that end alike are in some order."""
    name, run = grouped(np.maximum(flat, -1))[1], 1
    while run < min(depth, len(name)):
        code = name << 32
        code[: len(name) - run] |= name[run:]
        name = grouped(code)[1]
        run *= 2
    return name


def suffix_array(flat: np.ndarray, start: np.ndarray, depth: int) -> np.ndarray:
    """``start`` in the order of the suffixes of ``flat`` there, compared over ``depth`` words at least."""
    return start[np.argsort(_ranks(flat, depth)[start], kind="stable")]


def search(flat: np.ndarray, array: np.ndarray, query: np.ndarray, start: np.ndarray, size: np.ndarray, after: bool) -> np.ndarray:
    """For each query (its first ``size`` words) the first place in the suffix array that isn't before it, or that is after all of its matches."""
    low, high = np.zeros(len(start), np.int64), np.full(len(start), len(array))
    deepest = int(size.max(initial=0))
    while (low < high).any():
        mid = (low + high) // 2
        at = array[np.minimum(mid, len(array) - 1)]
        sign = np.zeros(len(start), np.int64)
        for k in range(deepest):
            open_ = np.flatnonzero((sign == 0) & (k < size))
            if not len(open_):
                break
            a, b = flat[np.minimum(at[open_] + k, len(flat) - 1)], query[np.minimum(start[open_] + k, len(query) - 1)]
            sign[open_] = np.where(b < 0, 1, np.sign(np.maximum(a, -1) - b))  # a query that has ended comes first
        up = (sign < 0) | ((sign == 0) & after)
        open_ = low < high
        low = np.where(open_ & up, mid + 1, low)
        high = np.where(open_ & ~up, mid, high)
    return low


def common_length(flat: np.ndarray, at: np.ndarray, query: np.ndarray, start: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Words that the suffixes at ``at`` and the queries share, ``most`` at most."""
    n, live = np.zeros(len(at), np.int64), np.arange(len(at))
    while len(live):
        live = live[(n[live] < most[live]) & (at[live] + n[live] < len(flat))]
        live = live[flat[at[live] + n[live]] == query[start[live] + n[live]]]
        n[live] += 1
    return n


def shard_hits(q: Queries, docs: list[np.ndarray]) -> list[tuple[list[tuple[int, int]], list[int], int, int, int]]:
    """Of each document: merged hit spans, items, and the longest verbatim match (words, its start, its item; 0, -1, -1 for none)."""
    none = ([], [], 0, -1, -1)
    out = [none] * len(docs)
    size = np.array([len(d) for d in docs], np.int64)
    base = np.cumsum(size + 1) - size - 1
    flat = np.full(int((size + 1).sum()), -1, np.int64)
    for b, d in zip(base, docs, strict=True):
        flat[b : b + len(d)] = d
    # only runs of known words that can hold a window, each with the end after it
    ends = np.flatnonzero(flat < 0)
    run = np.diff(ends, prepend=-1) - 1
    long = np.flatnonzero(run >= max(q.least, 1))
    place = spread(ends[long] - run[long], run[long] + 1)
    if not len(place) or not len(q.heads):
        return out
    some = flat[place]
    ahead = np.repeat(ends[long], run[long] + 1) - place
    array = suffix_array(some, np.flatnonzero(ahead >= q.least), min(q.deepest, int(run.max())))
    first, n = q.suffix[q.heads].astype(np.int64), q.size[q.heads].astype(np.int64)
    low = search(some, array, q.flat, first, n, False)
    high = search(some, array, q.flat, first, n, True)
    found = np.flatnonzero(high > low)
    if not len(found):
        return out
    count = (high - low)[found]
    window, at = np.repeat(found, count), array[spread(low[found], count)]
    # the longest match of each place is with one of its neighbours among the benchmark's suffixes
    starts, number = np.unique(at, return_inverse=True)
    near = search(q.flat, q.suffix, some, starts, np.full(len(starts), q.deepest), False)
    best = np.zeros((2, len(starts)), np.int64)
    for other in (near - 1, near):
        other = np.clip(other, 0, len(q.suffix) - 1)
        lengths = common_length(some, starts, q.flat, q.suffix[other].astype(np.int64), q.left[other])
        best = np.where(lengths > best[0], np.stack([lengths, q.owner[other]]), best)
    place = place[at]
    doc = np.searchsorted(base, place, "right") - 1
    order = np.lexsort((place, doc))
    window, place, doc, number = window[order], place[order], doc[order], number[order]
    for part in np.split(np.arange(len(doc)), np.flatnonzero(np.diff(doc)) + 1):
        d = int(doc[part[0]])
        spans: list[tuple[int, int]] = []
        for a, b in zip((place[part] - base[d]).tolist(), (place[part] - base[d] + n[window[part]]).tolist(), strict=True):
            if spans and a <= spans[-1][1]:
                spans[-1] = (spans[-1][0], max(spans[-1][1], b))
            else:
                spans.append((a, b))
        items = q.items(np.unique(window[part]))
        k = part[np.argmax(best[0][number[part]])]
        out[d] = (spans, items, int(best[0][number[k]]), int(place[k] - base[d]), int(best[1][number[k]]))
    return out


def block_count(benchmark: DataFrame, text_col: str, block_bytes: int) -> int:
    """How many blocks of about ``block_bytes`` the benchmark has; one for an empty one."""
    total = benchmark.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return max(1, -(-total // block_bytes))


def blocks(benchmark: DataFrame, id_col: str, text_col: str, parts: int) -> Iterator[Iterator[tuple[str, bytes]]]:
    """The benchmark's items with a text, block by block, read to the driver one after another."""
    source = benchmark.where(F.col(text_col).isNotNull()).select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("i"), F.col(text_col).alias("t"))
    for k in range(parts):
        block = source if parts == 1 else source.where(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == k)
        yield ((r["i"], r["t"].encode()) for r in block.orderBy("i", "t").toLocalIterator())


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row for each document: ``_id``, ``_th`` (hash of the text), n_words, hits (spans of hit words, merged), items
    (ids as sorted distinct strings; null is the empty string), longest match (words, start, one of its items), which has a
    window's words at least.

    Null and wordless texts have no words and no hits; items with a null or wordless text have no windows. Repeated
    documents are rows of their own, repeated item ids count once. A text of any length is searched whole. No shuffle for a
    benchmark of one block."""
    source = bounded(docs).select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_th"), F.col(text_col).alias("_text"))
    schema = SCHEMA.format(id=source.schema["_id"].dataType.simpleString())
    spark, parts = docs.sparkSession, block_count(benchmark, item_text_col, block_bytes)
    if parts == 1:
        return source.mapInArrow(_scanner(spark.sparkContext.broadcast(Queries(next(blocks(benchmark, item_col, item_text_col, 1)), window))), schema)
    # several blocks, one after another, so that the driver holds one: all documents with the first, then those that are hit
    path = shared_path(spark, "hits")
    for k, items in enumerate(blocks(benchmark, item_col, item_text_col, parts)):
        state = spark.sparkContext.broadcast(Queries(items, window))
        found = source.mapInArrow(_scanner(state), schema)
        (found.where(F.size("hits") > 0) if k else found).write.mode("append").parquet(path)
        state.destroy()
    # equal rows have equal results, so those of all blocks are put together by (id, text hash)
    every = spark.read.schema(StructType.fromDDL(schema)).parquet(path)
    best = F.min(F.struct((-F.col("longest")).alias("n"), "longest_at", "longest_item"))
    one = every.groupBy("_id", "_th").agg(F.max("n_words").alias("n_words"), F.array_sort(F.flatten(F.collect_list("hits"))).alias("_hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), best.alias("_best"))
    merged = F.expr("""aggregate(_hits, cast(array() as array<struct<start:bigint,stop:bigint>>), (a, x) -> CASE
        WHEN size(a) > 0 AND x.start <= element_at(a, -1).stop THEN concat(slice(a, 1, size(a) - 1), array(struct(element_at(a, -1).start AS start, greatest(element_at(a, -1).stop, x.stop) AS stop)))
        ELSE concat(a, array(x)) END)""")
    one = one.select(F.col("_id").alias("_i"), F.col("_th").alias("_t"), "n_words", merged.alias("hits"), "items", (-F.col("_best.n")).alias("longest"), F.col("_best.longest_at").alias("longest_at"), F.col("_best.longest_item").alias("longest_item"))
    rows = source.select("_id", "_th")
    return rows.join(one, rows["_id"].eqNullSafe(one["_i"]) & (rows["_th"] == one["_t"])).select("_id", "_th", "n_words", "hits", "items", "longest", "longest_at", "longest_item")


def _scanner(state: Broadcast):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = state.value
        for batch in slices(batches, "_text"):
            words = [q.words(t) for t in texts(batch, "_text")]
            rows = shard_hits(q, words)
            hits = pa.array([[{"start": a, "stop": b} for a, b in r[0]] for r in rows], pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))
            items = pa.array([sorted({x for i in r[1] for x in q.names[i]}) for r in rows], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_th"), pa.array(list(map(len, words)), pa.int64()), hits, items, pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] if r[2] else None for r in rows], pa.int64()), pa.array([q.names[r[4]][0] if r[2] else None for r in rows], pa.string())], names=["_id", "_th", "n_words", "hits", "items", "longest", "longest_at", "longest_item"])

    return run


def judged(found: DataFrame) -> DataFrame:
    """Add n_hit, n_items, items_sha256 and ``contaminated``: a twentieth of the words is hit at least."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, x: a + x["stop"] - x["start"])
    found = found.withColumn("n_hit", n_hit).withColumn("n_items", F.size("items").cast("long")).withColumn("items_sha256", F.sha2(F.array_join("items", ","), 256))
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def is_contaminated(n_words: int, spans: list[tuple[int, int]]) -> bool:
    hit = sum(b - a for a, b in spans)
    return hit > 0 and 20 * hit >= n_words


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents, with all their columns, that aren't contaminated. A benchmark of one block needs no shuffle: rows
    are judged where they are read. Otherwise hits of all blocks are put together first."""
    if block_count(benchmark, item_text_col, block_bytes) > 1:
        found = judged(matches(docs, benchmark, id_col, text_col, item_col, item_text_col, window, block_bytes))
        bad = found.where("contaminated").select(F.col("_id").alias("_bi"), F.col("_th").alias("_bt")).distinct()
        rows = docs.withColumn("_th", F.xxhash64(text_col))
        return rows.join(bad, rows[id_col].eqNullSafe(bad["_bi"]) & (rows["_th"] == bad["_bt"]), "left_anti").select(*docs.columns)
    state = docs.sparkSession.sparkContext.broadcast(Queries(next(blocks(benchmark, item_col, item_text_col, 1)), window))
    names = [f"_k{i}" for i in range(len(docs.columns))]
    text = names[docs.columns.index(text_col)]
    source = bounded(docs).toDF(*names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = state.value
        for batch in slices(batches, text):
            words = [q.words(t) for t in texts(batch, text)]
            keep = [not is_contaminated(len(w), hits[0]) for w, hits in zip(words, shard_hits(q, words), strict=True)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return source.mapInArrow(run, source.schema).toDF(*docs.columns)


SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
wanted AS (SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(w[i + 1:i + least(13, len(w))], ' ') AS k FROM items, unnest(range(len(w) - least(13, len(w)) + 1)) AS u(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM wanted),
places AS (SELECT r, n, i, array_to_string(w[i + 1:i + n], ' ') AS k FROM docs, sizes, unnest(range(len(w) - n + 1)) AS u(i)),
found AS (SELECT r, n, i, item FROM places JOIN wanted USING (n, k)),
hit AS (SELECT r, count(DISTINCT i + j) AS n_hit FROM (SELECT DISTINCT r, n, i FROM found), unnest(range(n)) AS u(j) GROUP BY r),
named AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM found GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""
