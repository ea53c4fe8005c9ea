"""Personal data by patterns, and terms that reveal it, by information theory.

What the patterns find are protected entities. Words near their mentions are counted over the whole corpus, and so are all
words, which gives p(entity), the share of words that stand near it, and p(entity | term), the share of a term's occurrences
that do. Knowing the term tells log p(entity | term) / p(entity) of the -log p(entity) that there is to
know about the entity; the quotient is the term's disclosure of it. A term is disclosing where this reaches a threshold for an entity, with
enough different surroundings to tell, so that copies of a text prove nothing. Such terms are spans too, wherever they stand. They
are generalised to the longest of their prefixes that isn't disclosing itself, or removed.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from topicloom.llm.blobs import spread
from topicloom.llm.common import ALNUM_TABLE, bounded, freeing, mix64, shared_path, slices, texts, word_keys, word_spans

#: The patterns of the base rules, on UTF-8 bytes; an address's part before the @ is found from there.
AT = re.compile(rb"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(rb"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(rb"[0-9]++(?:[\x20-][0-9]++)*+")
PHONE = re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]")
KINDS = ("email", "ip", "card", "phone", "term")
#: Words on either side of a mention that are its context; words on either side of a word that are its surroundings.
NEAR, AROUND = 16, 2
#: Share of an entity's information that a term may not tell; different surroundings and occurrences with it that are needed to judge;
#: bits of information that an entity must hold to be worth protecting.
THRESHOLD, SURROUNDINGS, OCCURRENCES, BITS = 0.9, 3, 3, 4.0
#: Code points of the prefixes to which terms are generalised, the longer one first.
PREFIXES = (4, 2)
#: Disclosing terms that are sent to tasks as they are; of more, a bit map of 16 MB is, and what it lets through is joined.
SENT, MAP_BITS = 2_000_000, 27
#: Distinct counts that a task holds before they are put together.
HELD = 1 << 22


def luhn(digits: bytes) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        d -= 48
        total += d if k % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def base_spans(data: bytes) -> list[tuple[int, int, int, bytes]]:
    """(start, kind, end, value) of the base rules by start, then kind, in bytes. Several texts may be joined by line feeds, which no
    pattern passes. Each pattern is read in time in proportion to the data."""
    found, last = [], 0
    for m in AT.finditer(data):
        start = m.start()
        while start > last and data[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            last = m.end()
            found.append((start, 0, last, data[start:last].lower()))
    for m in IP.finditer(data):
        if all(len(p) <= 3 and (not p or int(p) <= 255) for p in (x.lstrip(b"0") for x in m.group().split(b"."))):
            found.append((m.start(), 1, m.end(), m.group()))
    for m in CARD.finditer(data):
        if m.end() - m.start() >= 12:
            digits = m.group().translate(None, b" -")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end(), digits))
    for m in PHONE.finditer(data):
        digits = m.group().translate(None, b"+ ().-")
        if 9 <= len(digits) <= 15:
            found.append((m.start(), 3, m.end(), digits))
    return sorted(found)


class Words:
    """The words of several texts, but those in base spans: where they are, their hashes, and the spans."""

    def __init__(self, docs: list[bytes]):
        self.size = np.array([len(d) for d in docs], np.int64)
        self.start = np.cumsum(self.size + 1) - self.size - 1
        data = b"\n".join([*docs, b""])
        self.spans = base_spans(data)
        self.data = data.translate(ALNUM_TABLE) + b" "
        at, size = word_spans(self.data)
        left = np.array([s[0] for s in self.spans], np.int64)
        right = np.array([s[2] for s in self.spans], np.int64)
        covered = np.zeros(len(at) + 1, np.int64)
        np.add.at(covered, np.searchsorted(at + size, left, "right"), 1)
        np.add.at(covered, np.searchsorted(at, right), -1)
        free = np.cumsum(covered)[:-1] <= 0
        self.at, self.n = at[free], size[free]
        self.key = word_keys(self.data, self.at, self.n)
        self.doc = np.searchsorted(self.start, self.at, "right") - 1
        self.entity = np.array([xxhash.xxh3_64_intdigest(value, seed=kind) for _, kind, _, value in self.spans], np.uint64)
        # the first code points of words: bytes that begin one, counted
        begins = (np.frombuffer(self.data, np.uint8) & 0xC0) != 0x80
        self.point = np.flatnonzero(begins)
        self.points = np.append(0, np.cumsum(begins))

    def prefixes(self, some: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each length of prefixes: which of ``some`` words are longer, the prefixes' bytes and hashes."""
        for length in PREFIXES:
            at, n = self.at[some], self.n[some]
            first = self.points[at]
            longer = np.flatnonzero(self.points[at + n] - first > length)
            size = self.point[first[longer] + length] - at[longer]
            yield longer, size, prefix_keys(word_keys(self.data, at[longer], size), length)

    def contexts(self) -> tuple[np.ndarray, np.ndarray]:
        """(entity's number among the spans' distinct ones, word) of each word near a mention, once."""
        if not self.spans:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        left = np.array([s[0] for s in self.spans], np.int64)
        doc = np.searchsorted(self.start, left, "right") - 1
        place = np.searchsorted(self.at, left)
        low = np.maximum(place - NEAR, np.searchsorted(self.doc, doc))
        high = np.minimum(place + NEAR, np.searchsorted(self.doc, doc, "right"))
        _, number = np.unique(self.entity, return_inverse=True)
        both = np.unique(np.repeat(number, high - low) * len(self.at) + spread(low, high - low)) if len(self.at) else np.zeros(0, np.int64)
        return both // max(len(self.at), 1), both % max(len(self.at), 1)

    def surroundings(self, word: np.ndarray) -> np.ndarray:
        """A hash of the words on both sides of each word, within its text."""
        out = np.zeros(len(word), np.uint64)
        with np.errstate(over="ignore"):
            for step in (k for k in range(-AROUND, AROUND + 1) if k):
                other = np.clip(word + step, 0, max(len(self.at) - 1, 0))
                same = (other == word + step) & (self.doc[other] == self.doc[word])
                out = mix64(out * np.uint64(0x9FB21C651E98DF25) + np.where(same, self.key[other], np.uint64(step & 7)))
        return out


def prefix_keys(key: np.ndarray, length: int) -> np.ndarray:
    """Hashes of prefixes, apart from those of whole words."""
    return mix64(key ^ np.uint64(length))


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of keys, and their counts' sums."""
    key, n = np.concatenate(keys), np.concatenate(counts)
    order = np.lexsort(key.T[::-1])
    key = key[order]
    first = np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(axis=1))) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(n[order], first) if len(first) else n[:0]


class Sums:
    """Counts of rows of hashes, put together now and then."""

    def __init__(self, width: int):
        self.keys, self.counts, self.size, self.least = [np.zeros((0, width), np.uint64)], [np.zeros(0, np.int64)], 0, HELD

    def add(self, key: np.ndarray, n: np.ndarray) -> None:
        self.keys.append(key)
        self.counts.append(n)
        self.size += len(n)
        if self.size > self.least:
            self.collect()

    def collect(self) -> tuple[np.ndarray, np.ndarray]:
        key, n = _summed(self.keys, self.counts)
        self.keys, self.counts, self.size = [key], [n], len(n)
        self.least = max(HELD, 2 * len(n))
        return key, n


COUNTS = "kind string, c long, t long, around long, n long"


def counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """What is counted, summed by task: kind ``word`` (t, n; prefixes too), ``all`` (n words), ``entity`` (c, n words near it),
    ``near`` (c, t, surroundings, n)."""
    source = bounded(docs).select(F.col(text_col).alias("_text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word, entity, near, total = Sums(1), Sums(1), Sums(3), 0
        for batch in slices(batches, "_text"):
            w = Words(texts(batch, "_text"))
            total += len(w.at)
            _, one, n = np.unique(w.key, return_index=True, return_counts=True)
            word.add(w.key[one][:, None], n)
            for longer, _, key in w.prefixes(one):
                word.add(key[:, None], n[longer])
            number, at = w.contexts()
            if len(at):
                c, around = np.unique(w.entity)[number], w.surroundings(at)
                entity.add(c[:, None], np.ones(len(c), np.int64))
                for some, key in [(slice(None), w.key[at]), *[(longer, key) for longer, _, key in w.prefixes(at)]]:
                    near.add(np.stack([c[some], key, around[some]], axis=1), np.ones(len(key), np.int64))
        rows = [("all", {}, np.array([total], np.int64))]
        for kind, sums, names in (("word", word, "t"), ("entity", entity, "c"), ("near", near, "cta")):
            key, n = sums.collect()
            rows.append((kind, {name: key[:, k] for k, name in enumerate(names)}, n))
        for kind, key, n in rows:
            for a in range(0, len(n), 1 << 16):
                part = slice(a, a + (1 << 16))
                size = len(n[part])
                yield pa.RecordBatch.from_arrays([pa.array([kind] * size), *[pa.array(key[x][part].view(np.int64)) if x in key else pa.nulls(size, pa.int64()) for x in "cta"], pa.array(n[part])], names=["kind", "c", "t", "around", "n"])

    return source.mapInArrow(run, COUNTS)


def fit(docs: DataFrame, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The disclosing terms of a corpus: t (hash of a term, or of a prefix), c (hash of the entity that it discloses most), disclosure.

    All words of all documents count, null and empty texts have none; a corpus without entities has no such terms. Entities and terms are keys
    of aggregates, combined before they are shuffled, so a frequent one isn't gathered anywhere. The result is a table in the shared folder."""
    spark = docs.sparkSession
    path = shared_path(spark, "disclosure")
    with freeing(spark):
        counts(docs, text_col).write.partitionBy("kind").parquet(f"{path}/counts")
    every = spark.read.schema(COUNTS).parquet(f"{path}/counts")
    total = every.where("kind = 'all'").agg(F.sum("n")).first()[0] or 0
    entity = every.where("kind = 'entity'").groupBy("c").agg(F.sum("n").alias("_of"))
    entity = entity.select("c", (F.log("_of") - F.lit(math.log(max(total, 1)))).alias("_log_p")).where(F.col("_log_p") <= -BITS * math.log(2))
    pairs = every.where("kind = 'near'").groupBy("c", "t", "around").agg(F.sum("n").alias("n")).groupBy("c", "t").agg(F.sum("n").alias("_both"), F.count(F.lit(1)).alias("_kinds"))
    pairs = pairs.where((F.col("_kinds") >= SURROUNDINGS) & (F.col("_both") >= OCCURRENCES)).join(entity, "c")
    # disclosing: log both - log n >= (1 - threshold) log p; what doesn't depend on n is compared before terms meet their counts
    pairs = pairs.withColumn("_s", F.log("_both") - (1 - threshold) * F.col("_log_p"))
    most = pairs.groupBy("t").agg(F.max(F.struct("_s", "c", "_both", "_log_p")).alias("_m")).select("t", "_m.*")
    word = every.where("kind = 'word'").groupBy("t").agg(F.sum("n").alias("_n"))
    found = most.join(word, "t").where(F.col("_s") >= F.log("_n") - 1e-9)
    with freeing(spark):
        found.select("t", "c", (1 - (F.log("_both") - F.log("_n")) / F.col("_log_p")).alias("disclosure")).write.parquet(f"{path}/terms")
    return spark.read.parquet(f"{path}/terms")


class Known:
    """Disclosing terms, or, if they are many, a bit map of their hashes' first bits, which lets some others through."""

    def __init__(self, terms: DataFrame, sent: int = SENT):
        self.exact = terms.count() <= sent
        if self.exact:
            self.keys = np.sort(np.array([r[0] for r in terms.select("t").collect()], np.int64).view(np.uint64))
            return
        bit = F.shiftrightunsigned("t", 64 - MAP_BITS)
        self.bits = np.zeros(1 << (MAP_BITS - 3), np.uint8)
        maps = terms.select(bit.alias("b")).groupBy(F.expr("b div 32768").alias("k")).agg(F.expr("bitmap_construct_agg(b % 32768)").alias("m"))
        for r in maps.toLocalIterator():  # of at most 16 MB in all
            self.bits[r["k"] * 4096 : (r["k"] + 1) * 4096] = np.frombuffer(bytes(r["m"]), np.uint8)

    def holds(self, key: np.ndarray) -> np.ndarray:
        if self.exact:
            at = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
            return self.keys[at] == key if len(self.keys) else np.zeros(len(key), bool)
        bit = (key >> np.uint64(64 - MAP_BITS)).astype(np.int64)
        return (self.bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1


SPAN = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("stop", pa.int64()), ("t", pa.int64()), *[(f"p{n}", pa.int64()) for n in PREFIXES], *[(f"s{n}", pa.string()) for n in PREFIXES]])
SPANS = "array<struct<start:long,kind:int,stop:long,t:long,p4:long,p2:long,s4:string,s2:string>>"


def spans_of(docs: list[bytes], known: Known) -> pa.Array:
    """Of each text its base spans and known terms, in code points by start, then kind; terms with their prefixes, and with the hashes of
    those that are known too."""
    w = Words(docs)
    hit = np.flatnonzero(known.holds(w.key))
    start = np.concatenate([np.array([s[0] for s in w.spans], np.int64), w.at[hit]])
    stop = np.concatenate([np.array([s[2] for s in w.spans], np.int64), (w.at + w.n)[hit]])
    kind = np.array([*[s[1] for s in w.spans], *[len(KINDS) - 1] * len(hit)], np.int64)
    base = len(w.spans)
    fields = {"t": pa.array([*[None] * base, *w.key[hit].view(np.int64).tolist()], pa.int64())}
    for length, (longer, size, key) in zip(PREFIXES, w.prefixes(hit), strict=True):
        ids, words = [None] * len(start), [None] * len(start)
        for at, (k, n, x) in enumerate(zip(longer.tolist(), size.tolist(), key.view(np.int64).tolist(), strict=True)):
            a = int(w.at[hit[k]])
            words[base + k] = w.data[a : a + n].decode()
            ids[base + k] = x if known.holds(key[at : at + 1])[0] else None
        fields |= {f"p{length}": pa.array(ids, pa.int64()), f"s{length}": pa.array(words, pa.string())}
    order = np.lexsort((kind, start))
    doc = np.searchsorted(w.start, start[order], "right") - 1
    point = lambda x: w.points[x[order]] - w.points[w.start[doc]]
    known_fields = {"start": pa.array(point(start)), "kind": pa.array(kind[order].astype(np.int32)), "stop": pa.array(point(stop)), **{k: v.take(pa.array(order)) for k, v in fields.items()}}
    items = pa.StructArray.from_arrays([known_fields[f.name] for f in SPAN], fields=list(SPAN))
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(len(docs) + 1)), pa.int32()), items)


def _found(rows: DataFrame, terms: DataFrame, keep_text: bool, sent: int) -> DataFrame:
    """Rows (``_text`` and any others) with ``_spans``; the text goes unless it's kept."""
    known = Known(terms, sent)
    state = rows.sparkSession.sparkContext.broadcast(known)
    names = [c for c in rows.columns if keep_text or c != "_text"]
    shape = rows.select(*names).schema.add("_spans", StructType.fromDDL(f"s {SPANS}")[0].dataType)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], spans_of(texts(batch, "_text"), state.value)], names=[*names, "_spans"])

    found = bounded(rows).mapInArrow(run, shape)
    if known.exact:
        return found
    # what the map let through is looked up; equal texts have equal spans, so one of each is asked about
    asked = found.select("_th", F.explode("_spans").alias("s")).where("s.kind = 4").select("_th", F.explode(F.array("s.t", "s.p4", "s.p2")).alias("t")).where("t is not null").distinct()
    sure = asked.join(terms.select("t"), "t").groupBy("_th").agg(F.collect_set("t").alias("_sure"))
    found = found.join(sure, "_th", "left").withColumn("_sure", F.coalesce("_sure", F.array().cast("array<long>")))
    kept = F.filter("_spans", lambda s: (s["kind"] < 4) | F.array_contains("_sure", s["t"]))
    only = lambda x: F.when(F.array_contains("_sure", x), x)
    return found.withColumn("_spans", kept).select(*names, F.col("_spans"), "_sure").withColumn("_spans", F.transform("_spans", lambda s: s.withField("p4", only(s["p4"])).withField("p2", only(s["p2"])))).drop("_sure")


def scan(docs: DataFrame, terms: DataFrame, id_col: str = "doc_id", text_col: str = "text", sent: int = SENT) -> DataFrame:
    """``_id``, n_email, n_ip, n_card, n_phone, n_term, base_sha256, spans: kind:start:end in code points, by start, then kind.

    terms: of ``fit``. Null is the empty text; a row for each row, repeated or not; a text of any length is scanned whole, in
    time in proportion to it. A word that is partly in a base span is no term."""
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_th"), F.col(text_col).alias("_text"))
    found = _found(rows, terms, False, sent)
    name = F.array(*[F.lit(k) for k in KINDS])
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"], s["stop"])), ",")
    count = lambda k: F.size(F.filter("_spans", lambda s: s["kind"] == k)).cast("long")
    return found.select("_id", *[count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)], F.sha2(written(F.filter("_spans", lambda s: s["kind"] < 4)), 256).alias("base_sha256"), written(F.col("_spans")).alias("spans"))


def sanitise(docs: DataFrame, terms: DataFrame, text_col: str = "text", sent: int = SENT) -> DataFrame:
    """The documents, with all their columns; in texts a base span becomes its kind in brackets, a disclosing term its longest prefix
    that isn't disclosing and an asterisk, or ``[term]`` without one. Null stays null. Overlapping spans become the first one's."""
    names = [f"_k{i}" for i in range(len(docs.columns))]
    text = names[docs.columns.index(text_col)]
    rows = docs.toDF(*names).withColumn("_th", F.xxhash64(text)).withColumnRenamed(text, "_text")
    found = _found(rows, terms, True, sent)
    shape = found.drop("_spans").schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            out = []
            for value, spans in zip(batch.column("_text").to_pylist(), batch.column("_spans").to_pylist(), strict=True):
                if value and spans:
                    parts, at = [], 0
                    for s in spans:
                        if s["start"] >= at:
                            parts += [value[at : s["start"]], put(s, value)]
                        at = max(at, s["stop"])
                    value = "".join([*parts, value[at:]])
                out.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()) if f.name == "_text" else batch.column(f.name) for f in batch.schema if f.name != "_spans"], names=[f.name for f in batch.schema if f.name != "_spans"])

    result = found.mapInArrow(run, shape)
    return result.select(*[F.col("_text" if n == text else n).alias(c) for n, c in zip(names, docs.columns, strict=True)])


def put(span: dict, text: str) -> str:
    """What stands in a span's place."""
    if span["kind"] < 4:
        return f"[{KINDS[span['kind']]}]"
    for length in PREFIXES:
        word = span[f"s{length}"]
        if word is not None and span[f"p{length}"] is None:
            return text[span["start"] : span["start"] + len(word)] + "*"
    return "[term]"
