"""Ranked lexical search by inverted treaps.

A shard of the documents has a treap for each term: its postings are in search order by document
and in heap order by impact, what the term adds to the document's score. All treaps of a query's terms are walked
at once. A step has a range of documents and of each term the largest posting in it; their impacts' sum bounds
every score there, so a range that can't enter the ten highest is left out. Otherwise the document of the
largest posting is scored, and parts the range in two, into which the treaps descend.

Counts of documents and terms are taken over the whole table first; shards keep only terms that are asked for.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicloom.llm.common import alnum_words, bounded, freeing, mix64, remove_path, shared_path, slices, texts

#: Bytes of queries' text that are searched for at once; more is searched in blocks of about this size.
BLOCK_BYTES = 4 << 20
#: Postings of a shard at least, if a task has as many; cells (ranges x terms) of a step; queries that are walked together.
SHARD, CELLS, GROUP = 1 << 20, 1 << 17, 64
#: Parts into which a query's candidates are dealt before they meet.
DEALT = 64
TOP = 10


def term_weights(docs: int, df: np.ndarray) -> np.ndarray:
    """floor(1000 ln((2N + 2) / (2df + 1)))."""
    return np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)


def length_factors(docs: int, terms: int, tokens: np.ndarray) -> np.ndarray:
    """m = 100 - 90 + (90 n N) div L; Python's integers don't overflow."""
    distinct, place = np.unique(tokens, return_inverse=True)
    return np.array([10 + 90 * n * docs // terms for n in distinct.tolist()], np.int64)[place]


class Treaps:
    """The treaps of all terms of a shard: ``doc`` and ``impact`` of postings by term and document, with their children; the last place is no
    posting. Documents are numbered by rising id."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, terms: int, docs: int):
        """Postings in the order of (term, doc)."""
        size, self.docs = len(term), docs
        self.none = size
        self.doc, self.impact = np.append(doc, -1), np.append(impact, 0)
        self.key = term * docs + doc
        # equal impacts are parted by chance, so that treaps stay shallow
        with np.errstate(over="ignore"):
            chance = (mix64(np.arange(size, dtype=np.uint64)) >> np.uint64(36)).astype(np.int64)
        heap = np.append((impact << 28) | chance, np.iinfo(np.int64).max)
        at = np.arange(size)
        first = np.append(True, term[1:] != term[:-1]) if size else np.zeros(0, bool)
        last = np.append(first[1:], True) if size else first
        before = self._nearest(heap, np.where(first, size, at - 1), False)
        after = self._nearest(heap, np.where(last, size, at + 1), True)
        left_up = heap[before] < heap[after]
        parent = np.where(left_up, before, after)
        self.left, self.right = np.full(size + 1, size), np.full(size + 1, size)
        inner = parent != size
        self.right[parent[inner & left_up]] = at[inner & left_up]
        self.left[parent[inner & ~left_up]] = at[inner & ~left_up]
        self.root = np.full(terms + 1, size)
        self.root[term[~inner]] = at[~inner]

    @staticmethod
    def _nearest(heap: np.ndarray, near: np.ndarray, over: bool) -> np.ndarray:
        """The nearest posting on one side that is above in the heap: whatever a lower neighbour has passed is passed too."""
        near, live = near.copy(), np.arange(len(near))
        while len(live):
            a, b = heap[near[live]], heap[live]
            live = live[a <= b if over else a < b]
            near[live] = near[near[live]]
        return near

    def into(self, node: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The largest posting in a range of documents at or below each node."""
        node = node.copy()
        live = np.flatnonzero(node != self.none)
        while len(live):
            at = node[live]
            below, above = self.doc[at] < low[live], self.doc[at] > high[live]
            out = below | above
            live = live[out]
            node[live] = np.where(below[out], self.right[at[out]], self.left[at[out]])
            live = live[node[live] != self.none]
        return node

    def impacts(self, term: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """What terms (-1: none) add to documents' scores."""
        key = np.where(term < 0, -1, term * self.docs + doc)
        at = np.minimum(np.searchsorted(self.key, key), max(len(self.key) - 1, 0))
        return np.where(self.key[at] == key, self.impact[at], 0) if len(self.key) else np.zeros(len(key), np.int64)


def best(query: np.ndarray, score: np.ndarray, doc: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The highest of each query, equal scores by document."""
    order = np.lexsort((doc, -score, query))
    query, score, doc = query[order], score[order], doc[order]
    kept = np.arange(len(query)) - np.searchsorted(query, query) < top
    return query[kept], score[kept], doc[kept]


def walk(t: Treaps, queries: list[np.ndarray], least: np.ndarray, top: int = TOP, visits: list | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, score, document) of each query's ``top`` documents in a shard, of a score of ``least`` at least. queries: their terms."""
    widest = max(map(len, queries), default=0)
    term = np.full((len(queries), widest), -1)
    for k, q in enumerate(queries):
        term[k, : len(q)] = q
    found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    floor, edge = least.astype(np.int64), np.full(len(queries), t.docs)  # the score to reach, and up to which document if it's just reached
    stack = [(np.arange(len(queries)), np.zeros(len(queries), np.int64), np.full(len(queries), t.docs - 1), t.root[term])]
    rows = max(1, CELLS // max(widest, 1))
    while stack:
        query, low, high, node = stack.pop()
        bound = t.impact[node].sum(axis=1)
        live = (low <= high) & ((bound > floor[query]) | ((bound == floor[query]) & (low <= edge[query])))
        order = np.flatnonzero(live)
        order = order[np.argsort(bound[order], kind="stable")]
        if len(order) > rows:  # the most promising first
            rest = order[:-rows]
            stack.append((query[rest], low[rest], high[rest], node[rest]))
            order = order[-rows:]
        if not len(order):
            continue
        query, low, high, node = query[order], low[order], high[order], node[order]
        pick = np.argmax(t.impact[node], axis=1)
        doc = t.doc[node[np.arange(len(node)), pick]]
        score = t.impacts(term[query].reshape(-1), np.repeat(doc, widest)).reshape(node.shape).sum(axis=1)
        if visits is not None:
            visits.append(len(doc))
        good = score >= floor[query]
        found = best(*[np.concatenate(x) for x in zip(found, (query[good], score[good], doc[good]), strict=True)], top)
        full = np.flatnonzero(np.arange(len(found[0])) - np.searchsorted(found[0], found[0]) == top - 1)
        floor[found[0][full]] = found[1][full]
        edge[found[0][full]] = found[2][full]
        query, low, high = np.concatenate([query, query]), np.concatenate([low, doc + 1]), np.concatenate([doc - 1, high])
        node = t.into(np.concatenate([node, node]).reshape(-1), np.repeat(low, widest), np.repeat(high, widest)).reshape(len(query), -1)
        stack.append((query, low, high, node))
    return found


def shard_of(rows: list[tuple], totals: tuple[int, int], weights: np.ndarray) -> tuple[Treaps, pa.Array]:
    """Treaps of some rows of postings, and the ids of their documents in order (null last)."""
    ids = pa.concat_arrays([r[0] for r in rows])
    base = np.cumsum([0, *[len(r[0]) for r in rows]])
    tokens = np.concatenate([r[1] for r in rows])
    doc = np.concatenate([r[2] + b for r, b in zip(rows, base, strict=False)])
    term, tf = (np.concatenate([r[k] for r in rows]) for k in (3, 4))
    order = pc.sort_indices(ids, null_placement="at_end").to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    factor = length_factors(*totals, tokens)[doc] if len(doc) else doc
    impact = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * factor))
    doc = place[doc]
    by = np.lexsort((doc, term))
    return Treaps(term[by], doc[by], impact[by], len(weights), len(ids)), ids.take(pa.array(order))


class Asked:
    """The queries of a block: their distinct terms as numbers; queries of the same terms are one."""

    def __init__(self, items: list[tuple]):
        """items: (id, text)."""
        self.vocab: dict[bytes, int] = {}
        self.items: list[tuple] = []  # (number of the query, id of an item)
        numbers: dict[tuple[int, ...], int] = {}
        for name, text in items:
            terms = tuple(sorted({self.vocab.setdefault(w, len(self.vocab)) for w in alnum_words((text or "").encode())}))
            if terms:
                self.items.append((numbers.setdefault(terms, len(numbers)), name))
        self.queries = [np.array(q, np.int64) for q in numbers]


def postings(docs: DataFrame, vocab: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """A row for each slice of documents: the ids of those with a term, their lengths, and (document, term, occurrences) of the terms that are asked for."""
    source = bounded(docs).select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    state = docs.sparkSession.sparkContext.broadcast(vocab)
    kind = source.schema["_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = state.value.get
        for batch in slices(batches, "_text"):
            sizes, codes = [], []
            for text in texts(batch, "_text"):
                found = alnum_words(text)
                sizes.append(len(found))
                codes.append(np.fromiter(map(number, found, repeat(-1)), np.int64, len(found)))
            size = np.array(sizes, np.int64)
            some = np.flatnonzero(size)
            code = np.concatenate(codes) if codes else np.zeros(0, np.int64)
            owner = np.repeat(np.cumsum(size > 0) - 1, size)
            known = code >= 0
            pair, tf = np.unique((owner[known] << 32) | code[known], return_counts=True)
            ids = batch.column("_id").take(pa.array(some))
            blobs = [pa.array([x.astype("<i4").tobytes()], pa.binary()) for x in (size[some], pair >> 32, pair & 0xFFFFFFFF, tf)]
            offsets = pa.array([0, len(some)], pa.int32())
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, ids), pa.array([len(some)], pa.int64()), pa.array([int(size.sum())], pa.int64()), *blobs], names=["ids", "n_docs", "n_terms", "tokens", "doc", "term", "tf"])

    return source.mapInArrow(run, f"ids array<{kind}>, n_docs long, n_terms long, tokens binary, doc binary, term binary, tf binary")


def _numbers(column: pa.Array, k: int) -> np.ndarray:
    return np.frombuffer(column[k].as_buffer(), "<i4").astype(np.int64)


def _document_counts(table: DataFrame, terms: int) -> np.ndarray:
    """How many documents hold each term; the vocabulary is a block's, so its size is bounded."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms, np.int64)
        for batch in batches:
            for k in range(batch.num_rows):
                total += np.bincount(_numbers(batch.column("term"), k), minlength=terms)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "n"])

    df = np.zeros(terms, np.int64)
    for r in table.select("term").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        df[r["term"]] = r["n"]
    return df


def _candidates(table: DataFrame, asked: Asked, totals: tuple[int, int], weights: np.ndarray, top: int) -> DataFrame:
    """(query, part, id, score): of each shard and query the highest documents, in later shards of a task only those that reach the earlier ones' ``top``-th."""
    state = table.sparkSession.sparkContext.broadcast((asked.queries, weights))
    kind = table.schema["ids"].dataType.elementType.simpleString()

    def shards(batches: Iterable[pa.RecordBatch]) -> Iterator[list[tuple]]:
        rows, size = [], 0
        for batch in batches:
            for k in range(batch.num_rows):
                ids = batch.column("ids").slice(k, 1).flatten()
                rows.append((ids, *[_numbers(batch.column(c), k) for c in ("tokens", "doc", "term", "tf")]))
                size += len(rows[-1][2])
                if size >= SHARD:
                    yield rows
                    rows, size = [], 0
        if rows:
            yield rows

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, own = state.value
        scores = np.zeros((len(queries), top), np.int64)  # the highest so far in this task
        for rows in shards(batches):
            treaps, ids = shard_of(rows, totals, own)
            for a in range(0, len(queries), GROUP):
                query, score, doc = walk(treaps, queries[a : a + GROUP], np.maximum(scores[a : a + GROUP, -1], 1), top)
                rank = np.arange(len(query)) - np.searchsorted(query, query)
                new = np.zeros((min(GROUP, len(queries) - a), top), np.int64)
                new[query, rank] = score
                scores[a : a + GROUP] = -np.sort(-np.concatenate([scores[a : a + GROUP], new], axis=1), axis=1)[:, :top]
                yield pa.RecordBatch.from_arrays([pa.array(query + a), pa.array(doc % DEALT), ids.take(pa.array(doc)), pa.array(score)], names=["query", "part", "id", "score"])

    return table.select("ids", "tokens", "doc", "term", "tf").mapInArrow(run, f"query long, part long, id {kind}, score long")


def _searched(docs: DataFrame, asked: Asked, id_col: str, text_col: str, top: int) -> DataFrame:
    """(query, rank, id, score) of a block of queries. What is asked for is written first, so that texts are read once."""
    spark = docs.sparkSession
    path = shared_path(spark, "postings")
    with freeing(spark):
        postings(docs, asked.vocab, id_col, text_col).write.option("compression", "zstd").option("parquet.block.size", 8 << 20).parquet(path)
    table = spark.read.parquet(path)
    total = table.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).first()
    totals = (total["n"] or 0, total["l"] or 0)
    found = _candidates(table, asked, totals, term_weights(totals[0], _document_counts(table, len(asked.vocab))), top)
    order = [F.desc("score"), F.asc_nulls_last("id")]
    # a query's candidates meet in parts first
    part = found.withColumn("rank", F.row_number().over(Window.partitionBy("query", "part").orderBy(*order))).where(F.col("rank") <= top)
    result = shared_path(spark, "ranked")
    with freeing(spark):
        part.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("rank") <= top).select("query", "rank", "id", "score").write.parquet(result)
    remove_path(spark, path)
    return spark.read.parquet(result)


def search(docs: DataFrame, queries: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score) of each query's ``top`` documents with a score above 0, equal scores by ascending id, null ids last.

    Null and wordless texts have no terms: such documents aren't counted, such queries have no result. A row of queries is
    a query of its own, also if it's repeated; so is a row of documents. Whole texts count. Empty tables give no rows. Queries are collected in
    blocks of ``block_bytes`` of text, one after another; documents are read once for each block."""
    total = queries.agg(F.sum(F.octet_length(item_text_col))).first()[0] or 0
    parts = max(1, -(-total // block_bytes))
    source = queries.where(F.col(item_text_col).isNotNull()).select(F.col(item_col).alias("i"), F.col(item_text_col).alias("t"))
    kinds = f"query long, item_id {queries.schema[item_col].dataType.simpleString()}"
    every = None
    for k in range(parts):
        block = source if parts == 1 else source.where(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == k)
        asked = Asked([(r["i"], r["t"]) for r in block.orderBy("t", "i").collect()])
        items = docs.sparkSession.createDataFrame(asked.items, kinds)
        found = _searched(docs, asked, id_col, text_col, top).join(F.broadcast(items), "query").select("item_id", "rank", F.col("id").alias("doc_id"), "score")
        every = found if every is None else every.unionByName(found)
    return every


SQL = r"""
WITH lower_ AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
d AS (SELECT r, doc_id, w, len(w)::BIGINT AS n FROM lower_ WHERE len(w) > 0),
s AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM d),
tf AS (SELECT r, t, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS t FROM d) GROUP BY ALL),
weights AS (SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, s GROUP BY t, docs),
lengths AS (SELECT r, doc_id, 100 - 90 + (90 * n * docs) // terms AS m FROM d, s),
items AS (SELECT row_number() OVER () AS q, item_id, list_distinct(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS w FROM benchmark),
wanted AS (SELECT q, item_id, unnest(w) AS t FROM items),
scored AS (SELECT q, item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score FROM wanted JOIN tf USING (t) JOIN weights USING (t) JOIN lengths USING (r) GROUP BY ALL),
ranked AS (SELECT *, (row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id))::INTEGER AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
