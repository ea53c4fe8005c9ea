"""Exact removal of repeated word sequences by relative Lempel-Ziv parsing.

The reference is the whole corpus, indexed in blocks. A document is cut into phrases: the stretch
of words under consecutive windows with one anchor in one place. An anchor is the least hash of
the k-word grams of a window (its minimizer), so equal windows have equal anchors at equal places,
and a document meets just the reference blocks of its own anchors: all others have no match of a
window's length. A block has all phrases with an anchor, each distinct one once. Its index is a
suffix array over the words; every phrase is parsed greedily, left to right, into its longest
matches with the rest of the block. A match of a window or more is a factor; where one ends, the
parse goes on at the first window that isn't inside of it. Factors are duplicate spans; those
that meet or overlap are merged. A phrase that occurs several times is one factor as a whole.

Texts and phrases are kept in blocks of documents (see ``blobs``): they ask once for each distinct
phrase, so neither a frequent anchor nor repeated rows are hot. An anchor with more than HOT
distinct phrases has its block split: they are cut into windows, dealt out by the window's hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.llm.blobs import BLOBS, SHAPE, columns, edges_of, exists, grouped, planes, row, save, spread, unplanes
from topicloom.llm.common import SLICE_BYTES, bounded, mix64, remove_path, shared_path, slices, texts

WINDOW, GRAM = 35, 8
BASE = np.uint64(0x9E3779B97F4A7C15)
#: Bits of a minimizer's key that hold its place; longer texts are parsed in runs that overlap.
PLACE_BITS = 24
#: Text bytes that a part of the questions stands for.
PART_BYTES = 4 << 20
#: Distinct phrases of an anchor that are indexed together.
HOT = 512
#: What is known of a phrase: it occurs elsewhere as a whole; its words are shown to its block; its block is split.
WHOLE, SHOWN, SPLIT = 1, 2, 4


def rolled(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words, by doubling: a run's is its halves', combined."""
    if len(words) < size:
        return np.zeros(0, np.uint64)
    power, have, run = BASE, 1, words
    done, out = 0, None
    with np.errstate(over="ignore"):
        while True:
            if size & have:
                out = run if out is None else run[: len(run) - done] * _power(done) + out[have:]
                done += have
            if have * 2 > size:
                break
            run = run[: len(run) - have] * power + run[have:]
            power = power * power
            have *= 2
        return mix64(out[: len(words) - size + 1])


def _power(n: int) -> np.uint64:
    out = 1
    for _ in range(n):
        out = out * int(BASE) % (1 << 64)
    return np.uint64(out)


def sliding_least(keys: np.ndarray, size: int) -> np.ndarray:
    """The least of each ``size`` consecutive keys."""
    run, have = keys, 1
    while have * 2 <= size:
        run = np.minimum(run[: len(run) - have], run[have:])
        have *= 2
    return np.minimum(run[: len(keys) - size + 1], run[size - have :][: len(keys) - size + 1])


def least_places(grams: np.ndarray, size: int) -> np.ndarray:
    """Where the least of each ``size`` consecutive hashes stands, the leftmost of equal ones."""
    # the place in the low bits, in runs that these can number: of equal hashes the leftmost is the least
    bits, run, out = np.uint64(PLACE_BITS), 1 << PLACE_BITS, []
    for at in range(0, len(grams) - size + 1, run - size + 1):
        some = grams[at : at + run]
        keys = (some >> bits << bits) | np.arange(len(some), dtype=np.uint64)
        out.append((sliding_least(keys, size) & np.uint64(run - 1)).astype(np.int64) + at)
    return np.concatenate(out)


class Parsed:
    """The windows and phrases of a slice's texts."""

    def __init__(self, batch: list[bytes], window: int, gram: int):
        words = [t.split() for t in batch]
        self.words = words
        self.n = np.array([*map(len, words)], np.int64)
        flat = np.fromiter((h for w in words for h in map(xxhash.xxh3_64_intdigest, w)), np.uint64, int(self.n.sum()))
        self.base = np.cumsum(self.n) - self.n
        doc = np.repeat(np.arange(len(batch)), self.n)
        count = len(flat) - window + 1
        if count <= 0:
            self.start = self.size = self.doc = np.zeros(0, np.int64)
            self.anchor = self.phrase = self.window = np.zeros(0, np.uint64)
            return
        grams = rolled(flat, gram)
        place = least_places(grams, window - gram + 1)
        whole = doc[:count] == doc[window - 1 :]
        new = np.ones(count, bool)
        new[1:] = (place[1:] != place[:-1]) | (doc[1:count] != doc[: count - 1])
        first = np.flatnonzero(new & whole)
        stop = np.flatnonzero(np.append(new[1:] | ~whole[1:], True) & whole)
        self.window = rolled(flat, window)
        self.start, self.size, self.doc = first, stop - first + 1, doc[first]
        self.anchor = grams[place[first]]
        # a phrase: the hashes of its first and last window, its size, and where its anchor stands in it
        with np.errstate(over="ignore"):
            self.phrase = mix64(self.window[first] * BASE + self.window[stop] + mix64(self.size.astype(np.uint64) * np.uint64(64) + (place[first] - first).astype(np.uint64)))


def longest_matches(words: np.ndarray, size: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each place where a window starts: phrase, place, and the words of its longest match that starts elsewhere in the block.

    words: of all phrases in a row; size: words by phrase. The suffix array is sorted by names of runs of 1, 2, 4 ... words,
    which are equal for equal runs and ordered like them; phrases end in a word of their own, so no match leaves one."""
    n = len(size)
    ends = np.cumsum(size + 1) - 1
    flat = np.empty(len(words) + n, np.int64)
    inside = np.ones(len(flat), bool)
    inside[ends] = False
    one, flat[inside] = grouped(words)
    flat[ends] = len(one) + np.arange(n)
    names, run = [flat], 1
    while run * 2 <= window:
        last = names[-1]
        code = last << 32
        code[: len(last) - run] |= last[run:]
        names.append(grouped(code)[1])
        run *= 2
    count = size - window + 1
    phrase = np.repeat(np.arange(n), count)
    start = spread(ends - size, count)
    top, reach = names[-1], int(size.max(initial=0))
    at = lambda k: top[np.minimum(start + k, len(top) - 1)]
    order = np.lexsort([at(k) for k in range((reach - 1) // run * run, -1, -run)])
    a, b = start[order[:-1]], start[order[1:]]
    common, live = np.zeros(len(a), np.int64), np.arange(len(a))
    while len(live):  # whole runs first
        same = top[np.minimum(a[live] + common[live], len(top) - 1)] == top[np.minimum(b[live] + common[live], len(top) - 1)]
        live = live[same]
        common[live] += run
    for k in range(len(names) - 2, -1, -1):
        i, j = a + common, b + common
        common += (names[k][np.minimum(i, len(top) - 1)] == names[k][np.minimum(j, len(top) - 1)]) * (1 << k)
    longest = np.zeros(len(start), np.int64)
    longest[order[1:]] = common
    longest[order[:-1]] = np.maximum(longest[order[:-1]], common)
    return phrase, start - (ends - size)[phrase], longest


def parse(words: np.ndarray, size: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The factors of a window or more of a greedy parse of each phrase against the block: phrase, start, words."""
    phrase, _, longest = longest_matches(words, size, window)
    count = size - window + 1
    end = np.cumsum(count)
    base = end - count
    at, out = base.copy(), [(np.zeros(0, np.int64),) * 3]
    live = np.flatnonzero(at < end)
    while len(live):
        here = at[live]
        found = longest[here] >= window
        out.append((live[found], (here - base[live])[found], longest[here][found]))
        at[live] += np.where(found, longest[here] - window + 1, 1)  # windows that begin inside a factor and leave it come next
        live = live[at[live] < end[live]]
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def blocks_of(source: DataFrame, path: str, parts: int, window: int, gram: int) -> None:
    """Write the blocks, and their questions about phrases. source: ``_id``, ``_text``.

    ``kind=0``: a: texts, b: their bytes, c, d, e: document, start, and number of the distinct phrase, by phrase; ids.
    ``kind=1``, by part of the anchor: a: anchors, b: phrases, c: uses in the block."""
    kind = source.schema["_id"].dataType.simpleString()
    least = edges_of(parts)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in slices(batches, "_text", SLICE_BYTES):
            data = texts(batch, "_text")
            p = Parsed(data, window, gram)
            one, number = grouped(p.phrase)
            order = np.argsort(p.anchor[one])
            rank = np.empty(len(one), np.int64)
            rank[order] = np.arange(len(one))
            one, number = one[order], rank[number]
            uses = np.bincount(number, minlength=len(one)).astype(np.int64)
            own = batch.column("_id")
            shape = planes(p.doc), planes(p.start - p.base[p.doc]), planes(number)
            yield both(0, pa.array([own.to_pylist()], pa.list_(own.type)), row(block, None, b"".join(data), planes(np.array([*map(len, data)], np.int64)), *shape))
            anchors = p.anchor[one]
            cuts = np.append(np.searchsorted(anchors, least), len(one))
            for part in np.flatnonzero(np.diff(cuts)):
                a, b = cuts[part], cuts[part + 1]
                yield both(1, pa.nulls(1, pa.list_(own.type)), row(block, int(part), anchors[a:b].tobytes(), p.phrase[one[a:b]].tobytes(), planes(uses[a:b])))
            block += 1

    def both(number: int, ids: pa.Array, rest: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), ids, *rest.columns], names=["kind", "ids", *SHAPE.names])

    save(source.mapInArrow(run, f"kind int, ids array<{kind}>, {BLOBS}"), path)


def comparer(hot: int):
    """Answers of a part of the anchors."""

    def compared(table: pa.Table) -> pa.Table:
        """By block, a: what is known of its distinct phrases of a part. The first block that asks shows a phrase."""
        found = list(columns(table, "uui"))
        anchor, phrase, uses = (np.concatenate([f[k] for f in found]) for k in (2, 3, 4))
        order = np.argsort(phrase, kind="stable")  # the first to ask comes first
        new = np.ones(len(order), bool)
        new[1:] = phrase[order[1:]] != phrase[order[:-1]]
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(new) - 1
        first = order[new]
        whole = np.bincount(number, uses, len(first)) > 1
        one, of = grouped(anchor[first])
        several = np.bincount(of, minlength=len(one))[of]  # distinct phrases of the anchor
        known = np.where(whole, WHOLE, 0)[number]
        known[first] |= np.where(several > 1, SHOWN, 0) | np.where(several > hot, SPLIT, 0)
        ends = np.cumsum([len(f[2]) for f in found])
        return pa.Table.from_batches([row(f[0], f[1], planes(x)) for f, x in zip(found, np.split(known, ends[:-1]), strict=True)])

    return compared


class Texts:
    """A block's texts and phrases, with what is known of the phrases (rows of ``compared``)."""

    def __init__(self, left: pa.Table, right: pa.Table):
        data, size, doc, start, number = (left.column(k)[0].as_buffer() for k in "abcde")
        self.block, self.data, self.size = left.column("block")[0].as_py(), memoryview(data), unplanes(size)
        self.doc, self.start, number = unplanes(doc), unplanes(start), unplanes(number)
        known = np.concatenate([np.zeros(0, np.int64), *[x for *_, x in columns(right, "i")]])
        self.known = known[number]
        # one place of each distinct phrase shows it
        at = np.flatnonzero(self.known & SHOWN)
        self.shown = at[grouped(number[at])[0]]

    def words(self, doc: int) -> list[bytes]:
        at = int(self.size[:doc].sum()) if doc else 0
        return bytes(self.data[at : at + int(self.size[doc])]).split()


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """``_id``, n_words, n_removed, kept_sha256, ``kept`` (kept words, joined by one space), ``factors`` (merged runs of removed words: start, words).

    Null and wordless texts have no words; a text under a window's length loses none; repeated rows lose all but
    the words outside of any window, and stay rows of their own. Ids of any type; a text of any length is parsed at once, in
    a block of its own beyond SLICE_BYTES. Other columns aren't looked at. The result is computed when it is read, from
    tables in the shared folder."""
    spark = docs.sparkSession
    source = bounded(docs).select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = source.schema["_id"].dataType.simpleString()
    size = source.agg(F.sum(F.coalesce(F.octet_length("_text"), F.lit(0)) + 1)).first()[0]
    schema = f"_id {kind}, n_words long, n_removed long, kept_sha256 string, kept string, factors array<struct<start:long,words:long>>"
    if not size:
        return spark.createDataFrame([], schema)
    parts = max(-(-size // PART_BYTES), 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    path, known_path, factor_path = (shared_path(spark, x) for x in ("texts", "known-phrases", "factors"))
    blocks_of(source, path, parts, window, gram)
    none = spark.createDataFrame([], BLOBS)
    some = exists(spark, f"{path}/kind=1")  # no phrases: no text has a window
    if some:
        save(spark.read.parquet(f"{path}/kind=1").groupBy("part").applyInArrow(comparer(hot), BLOBS), known_path)
        remove_path(spark, f"{path}/kind=1")

    def show(left: pa.Table, right: pa.Table) -> pa.Table:
        """A block's phrases, by part: a: words, b: words by phrase, c: place of the phrase, d: window that it begins with, e: keys."""
        t = Texts(left, right)
        least, shown = edges_of(parts), np.zeros(len(t.doc), bool)
        shown[t.shown] = True
        flat, sizes, places, firsts, keys = [], [], [], [], []
        edges = np.flatnonzero(np.diff(t.doc, prepend=-1))
        for a, b in zip(edges, np.append(edges[1:], len(t.doc)), strict=False):  # a block without a phrase has no edge
            if shown[a:b].any():
                words = np.fromiter(map(xxhash.xxh3_64_intdigest, t.words(t.doc[a])), np.uint64)
                stop = np.append(t.start[a + 1 : b], len(words) - window + 1)  # of the windows of each phrase
                grams, whole = rolled(words, gram), rolled(words, window)
                for k in np.flatnonzero(shown[a:b]):
                    i, j = int(t.start[a + k]), int(stop[k])
                    if t.known[a + k] & SPLIT:
                        pieces = [(s, s + window, whole[s]) for s in range(i, j)]
                    else:
                        pieces = [(i, j + window - 1, grams[least_places(grams[i : j + window - gram], window - gram + 1)[0] + i])]
                    for first, last, key in pieces:
                        flat.append(words[first:last])
                        sizes.append(last - first)
                        places.append(a + k)
                        firsts.append(first - i)
                        keys.append(key)
        if not flat:
            return SHAPE.empty_table()
        keys, sizes, places, firsts = np.array(keys, np.uint64), np.array(sizes), np.array(places), np.array(firsts)
        order = np.argsort(keys, kind="stable")
        cuts = np.append(np.searchsorted(keys[order], least), len(keys))
        out = []
        for part in np.flatnonzero(np.diff(cuts)):
            some = order[cuts[part] : cuts[part + 1]]
            out.append(row(t.block, int(part), np.concatenate([flat[k] for k in some]).tobytes(), planes(sizes[some]), planes(places[some]), planes(firsts[some])))
        return pa.Table.from_batches(out)

    def match(table: pa.Table) -> pa.Table:
        """By block, a: places of phrases, b: starts of factors in them, c: words of the factors."""
        found = list(columns(table, "uiii"))
        words, sizes = (np.concatenate([f[k] for f in found]) for k in (2, 3))
        phrase, start, length = parse(words, sizes, window)
        ends = np.cumsum([len(f[3]) for f in found])
        of = np.searchsorted(ends, phrase, "right")
        places, firsts = (np.concatenate([f[k] for f in found])[phrase] for k in (4, 5))
        return pa.Table.from_batches([row(f[0], f[1], planes(places[of == k]), planes((firsts + start)[of == k]), planes(length[of == k])) for k, f in enumerate(found) if (of == k).any()], SHAPE)

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        factor = right.column("factor").to_numpy(zero_copy_only=False)
        t = Texts(left, right.filter(pa.array(~factor)))
        found = list(columns(right.filter(pa.array(factor)), "iii"))
        place, first, length = (np.concatenate([np.zeros(0, np.int64), *[f[k] for f in found]]) for k in (2, 3, 4))
        doc, start = t.doc[place], t.start[place] + first
        whole = np.flatnonzero(t.known & WHOLE)
        same = np.append(t.doc[1:] == t.doc[:-1], False)
        n_words, removed, digests, kept_texts, factors = [], [], [], [], []
        by_factor, by_whole = np.argsort(doc, kind="stable"), np.searchsorted(t.doc[whole], np.arange(len(t.size) + 1))
        factor_cuts = np.searchsorted(doc[by_factor], np.arange(len(t.size) + 1))
        ends = np.cumsum(t.size)
        for d in range(len(t.size)):
            words = bytes(t.data[ends[d] - t.size[d] : ends[d]]).split()
            gone, runs = 0, []
            f, w = by_factor[factor_cuts[d] : factor_cuts[d + 1]], whole[by_whole[d] : by_whole[d + 1]]
            if len(f) or len(w):
                edge = np.zeros(len(words) + 1, np.int64)
                last = np.where(same[w], np.append(t.start[1:], 0)[w] - 1, len(words) - window)  # a phrase's last window
                np.add.at(edge, np.concatenate([start[f], t.start[w]]), 1)
                np.add.at(edge, np.concatenate([start[f] + length[f], last + window]), -1)
                out = np.cumsum(edge)[:-1] > 0
                bounds = np.flatnonzero(np.diff(out, prepend=False, append=False))
                runs = [(int(a), int(b - a)) for a, b in bounds.reshape(-1, 2)]
                gone = int(out.sum())
                words = [words[k] for k in np.flatnonzero(~out)]
            kept = b" ".join(words)
            n_words.append(len(words) + gone)
            removed.append(gone)
            digests.append(hashlib.sha256(kept).hexdigest())
            kept_texts.append(kept.decode())
            factors.append([{"start": a, "words": n} for a, n in runs])
        ids = left.column("ids").combine_chunks().flatten()
        lists = pa.array(factors, pa.list_(pa.struct([("start", pa.int64()), ("words", pa.int64())])))
        return pa.table({"_id": ids, "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "kept_sha256": digests, "kept": pa.array(kept_texts, pa.string()), "factors": lists})

    blocks, known, factors = spark.read.parquet(f"{path}/kind=0"), none, none
    if some:
        known = spark.read.schema(BLOBS).parquet(known_path)
        save(blocks.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(show, BLOBS).groupBy("part").applyInArrow(match, BLOBS), factor_path)
        factors = spark.read.schema(BLOBS).parquet(factor_path)
    answers = known.withColumn("factor", F.lit(False)).unionByName(factors.withColumn("factor", F.lit(True)))
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(cut, schema)


SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT r, i, array_to_string(w[i + 1:i + 35], ' ') AS k FROM docs, unnest(range(len(w) - 34)) AS u(i)),
often AS (SELECT k FROM windows GROUP BY k HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, i + j AS spot FROM windows JOIN often USING (k), range(35) AS u(j)),
words AS (SELECT r, i AS spot, w[i + 1] AS word FROM docs, unnest(range(len(w))) AS u(i)),
kept AS (SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY spot) AS text FROM words ANTI JOIN gone USING (r, spot) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256 FROM docs LEFT JOIN kept USING (r)
"""
