"""SimHash near-duplicates, compared bit-sliced.

Candidates: the 64 bits are cut into m blocks; fingerprints within the radius r agree on
at least m - r of them, so each choice of m - r blocks is a table of exact buckets. In a
bucket, fingerprints lie in lanes of 64 with vertical bit planes; a query's distances to
64 others are counted together in carry-save bitwise counters, and a lane word is
abandoned once all its counters exceed the radius.

A wide radius would need blocks too short to tell buckets apart. For it, buckets can be bands
of three least shingle hashes instead: texts that share 80 % of their shingles meet in one of
them with a probability of 99.7 %, those that share 10 % with one of 1 %; fingerprints are
compared there in the same way.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from topicloom.llm.common import bounded, cut, mix64, slices, texts

BITS, SEED = 64, 42
#: Fingerprints of a bucket that are compared in one piece; larger buckets are split into pairs of tiles.
TILE = 8192
#: Query-by-lane pairs held at once.
CHUNK = 1 << 16
#: Near copies: shingles of five words, 80 % of them shared. Such texts differ in about 10 bits, with a deviation of 3; unrelated ones
#: in 32, with one of 4. Bands, of so many least hashes each.
NEAR_SIZE, NEAR_RADIUS, NEAR_BANDS, BAND_ROWS = 5, 14, 8, 3


def shingles(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 of the shingles; of fewer words, that of the whole sequence."""
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = [0, *(gaps[: len(words) - size] + 1).tolist()]
    ends = [*gaps[size - 1 :].tolist(), len(joined)]
    return np.fromiter(map(xxhash.xxh64_intdigest, map(joined.__getitem__, map(slice, starts, ends)), repeat(SEED)), np.uint64, len(starts))


def band_keys(hashes: np.ndarray, bands: int) -> np.ndarray:
    """Keys of bands of least hashes, each under a permutation of its own (a product with an odd number)."""
    keys = np.zeros(bands, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(bands * BAND_ROWS):
            least = (hashes * (mix64(np.uint64(k + 1)) | np.uint64(1))).min()
            keys[k // BAND_ROWS] = mix64(keys[k // BAND_ROWS] + least)
    return keys


def fingerprint(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes."""
    ones = np.zeros(BITS, np.int64)
    packed = hashes.astype("<u8").view(np.uint8)
    for at in range(0, len(packed), 8 << 14):
        ones += np.unpackbits(packed[at : at + (8 << 14)], bitorder="little").reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4, bands: int = 0) -> DataFrame:
    """(doc id, hash of the text, fingerprint, keys of bands) of each row; null and wordless texts have fingerprint and keys 0."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            prints, keys = np.zeros(batch.num_rows, np.uint64), np.zeros((batch.num_rows, bands), np.uint64)
            for k, words in enumerate(t.lower().split() for t in texts(batch, "_text")):
                if words:
                    hashes = shingles(words, size)
                    prints[k], keys[k] = fingerprint(hashes), band_keys(hashes, bands)
            lists = pa.ListArray.from_arrays(np.arange(batch.num_rows + 1, dtype=np.int32) * bands, pa.array(keys.ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_th"), pa.array(prints.view(np.int64)), lists], names=["_id", "_th", "_fp", "_bands"])

    source = bounded(docs).select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_th"), F.col(text_col).alias("_text"))
    return source.mapInArrow(run, source.select("_id", "_th").schema.add("_fp", "long").add("_bands", ArrayType(LongType())))


def block_tables(count: int, radius: int, per_bucket: int = 2048) -> list[list[tuple[int, int]]]:
    """For each table its key's bit ranges: as few tables as keep buckets of ``count`` even fingerprints under ``per_bucket``."""
    for m in range(radius + 1, radius + 5):
        edges = [BITS * i // m for i in range(m + 1)]
        ranges = list(zip(edges[:-1], edges[1:], strict=True))
        if count / 2 ** (BITS * (m - radius) // m) <= per_bucket:
            break
    return [list(c) for c in combinations(ranges, m - radius)]


def table_key(fp: Column, ranges: list[tuple[int, int]]) -> Column:
    key = F.lit(0).cast("long")
    for lo, hi in ranges:
        key = F.shiftleft(key, hi - lo).bitwiseOR(F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1).cast("long")))
    return key


def near_pairs(fp: np.ndarray, group: np.ndarray, radius: int, tile: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i < j in order of place) of one group that differ in at most ``radius`` bits, for groups that lie together.

    tile: -1 to compare all; else rows of tile 0 meet rows of tile 1 only."""
    n = len(fp)
    first = np.flatnonzero(np.diff(group, prepend=group[0] - 1 if n else 0))
    size = np.diff(np.append(first, n))
    lanes = (size + 63) // 64
    lane_first = np.cumsum(lanes) - lanes
    which = np.repeat(np.arange(len(first)), size)
    rank = np.arange(n) - first[which]
    slot = lane_first[which] * 64 + rank
    bits = np.zeros((int(lanes.sum()) * 64, 8), np.uint8)
    bits[slot] = fp.astype("<u8").view(np.uint8).reshape(n, 8)
    used = np.zeros(len(bits), np.uint8)
    used[slot] = 1
    used = np.packbits(used, bitorder="little").view("<u8")
    owner = np.full(len(bits), -1)
    owner[slot] = np.arange(n)
    planes = np.packbits(np.unpackbits(bits, axis=1, bitorder="little").T.copy(), axis=1, bitorder="little").view("<u8")
    # a query meets its own lane word and those after it
    span = lanes[which] - rank // 64
    span[size[which] < 2] = 0
    ends = np.cumsum(span)
    for lo in range(0, int(ends[-1]) if n else 0, CHUNK):
        pair = np.arange(lo, min(lo + CHUNK, int(ends[-1])))
        query = np.searchsorted(ends, pair, "right")
        lane = lane_first[which[query]] + rank[query] // 64 + pair - (ends[query] - span[query])
        counters, over = [np.zeros(len(pair), np.uint64) for _ in range(max(1, radius.bit_length()))], np.zeros(len(pair), np.uint64)
        q = fp[query]
        for p in range(0, BITS, 2):
            a = planes[p][lane] ^ (np.uint64(0) - (q >> np.uint64(p) & np.uint64(1)))
            b = planes[p + 1][lane] ^ (np.uint64(0) - (q >> np.uint64(p + 1) & np.uint64(1)))
            half = a ^ b
            carry = a & b | half & counters[0]
            counters[0] ^= half
            for k in range(1, len(counters)):
                more = counters[k] & carry
                counters[k] ^= carry
                carry = more
            over |= carry
            if p % 8 == 6 and p >= 14:
                live = beyond(counters, over, radius) != ~np.uint64(0)
                if not live.all():  # abandoned: all 64 of the word are beyond the radius
                    query, lane, q, over, *counters = (x[live] for x in (query, lane, q, over, *counters))
                if not len(query):
                    break
        if len(query):
            near = ~beyond(counters, over, radius) & used[lane]
            hit = np.flatnonzero(near)
            k, s = np.nonzero(np.unpackbits(near[hit].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            i, j = query[hit[k]], owner[lane[hit[k]] * 64 + s]
            right = i < j
            if tile is not None:
                right &= (tile[i] < 0) | (tile[i] != tile[j])
            if right.any():
                yield i[right], j[right]


def beyond(counters: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose counter, lowest bits first, exceeds the radius."""
    more, same = over, ~over
    for k in range(len(counters) - 1, -1, -1):
        if radius >> k & 1:
            same = same & counters[k]
        else:
            more = more | same & counters[k]
            same = same & ~counters[k]
    return more


def forest(n: int, pairs: Iterable[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The least member of each member's component."""
    label = np.arange(n)
    for i, j in pairs:
        while True:
            a, b = label[i], label[j]
            if (a == b).all():
                break
            low, high = np.minimum(a, b), np.maximum(a, b)
            np.minimum.at(label, high, low)
            while (label != (up := label[label])).any():
                label = up
    return label


def in_tables(prints: DataFrame, tables: list[list[tuple[int, int]]]) -> DataFrame:
    """Distinct fingerprints ``_fp`` by the buckets (table ``_t``, ``_key``) of their blocks."""
    return prints.select("_fp", F.posexplode(F.array(*[table_key(F.col("_fp"), t) for t in tables])).alias("_t", "_key"))


def links(keyed: DataFrame, radius: int) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``_fp`` of buckets (``_t``, ``_key``): in each one a spanning forest of all links there."""
    hot = keyed.groupBy("_t", "_key").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > TILE).withColumn("_parts", F.ceil(F.col("_n") / TILE).cast("int"))
    keyed = keyed.join(hot.select("_t", "_key", "_parts"), ["_t", "_key"], "left")
    parts = F.coalesce("_parts", F.lit(1))
    own = F.when(parts == 1, 0).otherwise(F.pmod(F.xxhash64("_fp"), parts)).cast("int")
    keyed = keyed.select("_t", "_key", "_fp", own.alias("_own"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("_other"))
    low, high = F.least("_own", "_other"), F.greatest("_own", "_other")
    side = F.when(low == high, -1).otherwise((F.col("_own") > F.col("_other")).cast("int"))
    keyed = keyed.select("_fp", F.xxhash64("_t", "_key", low, high).alias("_group"), side.alias("_side"))

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(fp: np.ndarray, group: np.ndarray, side: np.ndarray) -> pa.RecordBatch:
            label = forest(len(fp), near_pairs(fp.view(np.uint64), group, radius, side))
            k = np.flatnonzero(label != np.arange(len(fp)))
            return pa.RecordBatch.from_arrays([pa.array(fp[k]), pa.array(fp[label[k]])], names=["a", "b"])

        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in ("_fp", "_group", "_side")))
            fp, group, side = (np.concatenate(x) for x in zip(*held, strict=True))
            last = np.searchsorted(group, group[-1])  # the last group may go on
            held = [(fp[last:], group[last:], side[last:])]
            if last:
                yield out(fp[:last], group[:last], side[:last])
        for rest in held:
            yield out(*rest)

    return keyed.repartition("_group").sortWithinPartitions("_group", "_side", "_fp").mapInArrow(compare, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node of each component with an edge, by alternating large and small stars until nothing changes."""
    now = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # what is joined is written first, apart from the sums: so Spark can split the edges of a hub
        least = cut(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")))
        large = cut(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        down = cut(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(down, "u")
        now = cut(small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(small.select("u", F.col("m").alias("v"))).distinct())
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = seen


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4, radius: int = 4, bands: int = 0) -> DataFrame:
    """(id, text hash ``_th``, ``_fp``, ``_root``: the component's least fingerprint, ``component_id``): the least id reachable over links of at most ``radius`` bits.

    Exact copies share a fingerprint and meet once. A null id never names a component with another id in it; a
    component of null ids only has a null name. Empty table: no rows; repeated rows: a row each; a text of any length is
    hashed whole. Without ``bands`` no link is missed; with them, fingerprints are compared that share one."""
    prints = cut(fingerprints(docs, id_col, text_col, size, bands))
    nodes = cut(prints.groupBy("_fp").agg(F.min("_id").alias("_low")))
    if bands:
        keyed = prints.select("_fp", F.posexplode("_bands").alias("_t", "_key")).distinct()
    else:
        keyed = in_tables(nodes.select("_fp"), block_tables(nodes.count(), radius))
    roots = components(links(keyed, radius))
    named = nodes.join(roots, nodes["_fp"] == roots["node"], "left").select("_fp", "_low", F.coalesce("root", "_fp").alias("_root"))
    named = cut(named)
    least = cut(named.groupBy("_root").agg(F.min("_low").alias("component_id")))  # apart from the join, which can then split a hot root
    names = named.join(least, "_root").select("_fp", "_root", "component_id")
    return prints.join(names, "_fp").select(F.col("_id").alias(id_col), "_th", "_fp", "_root", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = NEAR_SIZE, radius: int = NEAR_RADIUS, bands: int = NEAR_BANDS) -> DataFrame:
    """Keep one row of each component, with all columns: the one with the least id (nulls last, then by text hash); of repeated rows one."""
    found = near_duplicates(docs, id_col, text_col, size, radius, bands)
    order = F.struct(F.col(id_col).isNull().alias("n"), F.col(id_col).alias("i"), F.col("_th").alias("t"))
    heads = found.groupBy("_root").agg(F.min(order).alias("o"))
    counts = found.groupBy(F.col(id_col).alias("i"), F.col("_th").alias("t")).agg(F.count(F.lit(1)).alias("_copies"))
    best = heads.select(F.col("o.i").alias("i"), F.col("o.t").alias("t"))
    best = best.join(counts, best["i"].eqNullSafe(counts["i"]) & (best["t"] == counts["t"])).select(best["i"].alias("_hi"), best["t"].alias("_ht"), "_copies")
    kept = docs.withColumn("_th", F.xxhash64(text_col)).join(best, F.col(id_col).eqNullSafe(F.col("_hi")) & (F.col("_th") == F.col("_ht")))
    once = kept.where("_copies = 1").select(*docs.columns)
    again = kept.where("_copies > 1").dropDuplicates(["_hi", "_ht"]).select(*docs.columns)
    return once.unionByName(again)
