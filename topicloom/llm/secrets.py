"""Secrets by patterns and by character Markov models.

Two first-order Markov models over the characters of tokens, one of random strings and one
of ordinary identifiers, are trained from labelled samples. A token of 8 characters or more is a secret if its
log-likelihood ratio exceeds the threshold for its length. Thresholds are set on labelled samples held out from the
training: random strings taken out of the base rules' patterns, and tokens that aren't secrets.
"""

from __future__ import annotations

import hashlib
import random
import re
import string
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.llm.blobs import spread
from topicloom.llm.common import bounded, slices, texts

#: The patterns of the base rules, on UTF-8 bytes; all that they match is ASCII.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
#: Runs of hexadecimal digits of 32 or more, which are the rule's matches of that length.
LONG_HEX = re.compile(rb"(?<![0-9a-f])[0-9a-f]{32,}")
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
KINDS = ("assign", "access", "hex", "markov")
CHARS = string.ascii_letters + string.digits + "+/_.=-"
#: Punctuation that isn't judged at a token's ends.
EDGES = "._=-/+"
#: Ordinary tokens that the models learn from.
ORDINARY = re.compile(rb"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{6,}")
#: Least lengths of the classes that have a threshold of their own; shorter tokens aren't judged, as the base rules take none.
LENGTHS = (8, 10, 12, 14, 16, 20, 24)
#: The sample: documents, and random strings that are made for it, of each alphabet and class of lengths.
TRAIN_DOCS, MADE = 3000, 400
#: Share of ordinary tokens that may be taken for secrets, and of secrets that may be missed, where a threshold can be set so.
FALSE_SHARE, MISSED_SHARE = 1e-4, 0.05
#: Threshold without a sample of ordinary tokens.
PRIOR = 12.0
#: Ratios are counted in steps of so many nats.
BIN = 0.25
PLACE = {ord(c): k for k, c in enumerate(CHARS)}
START = len(CHARS)
CODE = np.full(256, -1, np.int64)
CODE[list(PLACE)] = list(PLACE.values())
EDGE = np.zeros(256, bool)
EDGE[list(EDGES.encode())] = True


def base_spans(text: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base rules, by start, then kind, in bytes."""
    found = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if b"AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in LONG_HEX.finditer(text)]
    return sorted(found)


def apart(spans: list[tuple[int, int, int]]) -> Callable[[int, int], bool]:
    """Whether a run touches none of some spans, which are ordered by their start."""
    starts, ends = [s for s, _, _ in spans], list(accumulate((e for _, _, e in spans), max))

    def clear(start: int, end: int) -> bool:
        k = bisect_left(starts, end)
        return not k or ends[k - 1] <= start

    return clear


def secret_part(text: bytes, span: tuple[int, int, int]) -> bytes:
    """The random string in a base span."""
    start, kind, end = span
    return ASSIGN.match(text, start).group(2) if kind == 0 else text[start:end]


def steps(token: bytes) -> Counter:
    """Pairs of characters, the first after the start mark."""
    codes = [START, *[PLACE[c] for c in token]]
    return Counter(zip(codes[:-1], codes[1:], strict=True))


def made_strings(seed: int = 20) -> list[bytes]:
    """Labelled random strings over the usual alphabets of secrets, of all lengths, the same ones each time."""
    rng = random.Random(seed)
    alphabets = ["0123456789abcdef", string.ascii_uppercase + string.digits, string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/"]
    ends = [*[n - 1 for n in LENGTHS[1:]], 48]
    return ["".join(rng.choices(a, k=rng.randint(low, high))).encode() for low, high in zip(LENGTHS, ends, strict=True) for a in alphabets for _ in range(MADE)]


def identifiers(words: list[bytes]) -> Iterator[bytes]:
    """Labelled ordinary tokens as code and links have them, joined from words of a text."""
    for k in range(0, len(words) - 2, 3):
        a, b, c = (w.strip(EDGES.encode()).lower() for w in words[k : k + 3])
        yield (a + b"_" + b + b"_" + c, a + b.title() + c.title(), a + b"-" + b + b"-" + c, a + b"/" + b + b"/" + c + b".html", (a + b"_" + b).upper(), a.title() + b.title(), a + b.title())[k // 3 % 7]


def candidate(token: bytes) -> bytes:
    """What the models judge of a token: without punctuation at its ends; empty if it's too short."""
    token = token.strip(EDGES.encode())
    return token if len(token) >= LENGTHS[0] else b""


def before_and_after(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of characters of tokens in bytes, one token after another, the first after the start mark."""
    code = CODE[data[spread(start, size)]]
    before = np.append(START, code[:-1])
    before[np.cumsum(size) - size] = START
    return before, code


def length_class(size: np.ndarray | int) -> np.ndarray | int:
    return np.searchsorted(LENGTHS, size, "right") - 1


class Models:
    """Log-likelihood ratio of each pair of characters: random strings against ordinary identifiers. thresholds: of a secret's ratio, by class of
    lengths; recall and false_share: of held-out samples above them, by class."""

    def __init__(self, random_pairs: Counter, ordinary_pairs: Counter):
        self.ratio = np.zeros((START + 1, START + 1))
        self.thresholds = np.full(len(LENGTHS), PRIOR)
        self.recall, self.false_share = np.full(len(LENGTHS), np.nan), np.full(len(LENGTHS), np.nan)
        for sign, pairs in ((1, random_pairs), (-1, ordinary_pairs)):
            table = np.full((START + 1, START), 0.5)
            for (a, b), n in pairs.items():
                table[a, b] += n
            self.ratio[:, :START] += sign * np.log(table / table.sum(axis=1, keepdims=True))

    def scores(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Ratios of tokens in bytes, all at once."""
        if not len(start):
            return np.zeros(0)
        return np.add.reduceat(self.ratio[before_and_after(data, start, size)], np.cumsum(size) - size)

    def score(self, token: bytes) -> float:
        return float(self.scores(np.frombuffer(token, np.uint8), np.array([0]), np.array([len(token)]))[0])

    def set_threshold(self, k: int, secret: Counter, ordinary: Counter) -> None:
        """Of class ``k`` from numbers of held-out tokens by bin of their ratio: in the middle of where both shares of errors are met;
        if there is no such place, where that of ordinary tokens is."""
        bins = np.arange(min([*secret, *ordinary, 0]), max([*secret, *ordinary, 0]) + 2)
        above = lambda c: np.cumsum([c[x] for x in bins[::-1].tolist()])[::-1] / max(c.total(), 1)
        false, found = above(ordinary), above(secret)
        good = np.flatnonzero(false <= FALSE_SHARE)
        both = good[found[good] >= 1 - MISSED_SHARE]
        at = both[len(both) // 2] if len(both) else good[0]
        if ordinary.total():
            self.thresholds[k] = float(bins[at] * BIN)
        at = min(int(np.searchsorted(bins, self.thresholds[k] / BIN)), len(bins) - 1)
        self.recall[k], self.false_share[k] = float(found[at]), float(false[at])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = TRAIN_DOCS) -> Models:
    """Train on at most ``most`` documents (least hashes of their ids; of a repeated id one): strings in base spans are labelled
    random, beside those of ``made_strings``; other tokens of six characters or more, and ``identifiers`` of them, are
    labelled ordinary. Half of the documents, by hash, and strings of another seed are held out, to set the thresholds."""
    known = docs.where(F.col(text_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id")).distinct()
    chosen = F.broadcast(known.orderBy(F.xxhash64("_id"), "_id").limit(most))
    source = bounded(docs).select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).where(F.col("_text").isNotNull())
    one = source.join(chosen, "_id", "left_semi").groupBy("_id").agg(F.max("_text").alias("_text"))
    fold = lambda k: one.where(F.pmod(F.xxhash64(F.col("_id").cast("string")), F.lit(2)) == k).select("_text")

    def tokens(text: bytes) -> Iterator[tuple[int, bytes]]:
        """Labelled tokens, 1: random."""
        spans, words = base_spans(text), []
        clear = apart(spans)
        for s in spans:
            yield 1, bytes(c for c in secret_part(text, s) if c in PLACE)
        for m in ORDINARY.finditer(text):
            if clear(m.start(), m.end()):
                words.append(m.group())
                yield 0, m.group()
        for x in identifiers(words):
            yield 0, x

    def labelled(batches: Iterable[pa.RecordBatch], judged: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """The tokens of each text: labels, bytes, starts, sizes."""
        for batch in slices(batches, "_text"):
            for text in texts(batch, "_text"):
                found = [(label, x) for label, token in tokens(text) if (x := candidate(token) if judged else token)]
                size = np.array([len(x) for _, x in found], np.int64)
                yield np.array([label for label, _ in found], np.int64), np.frombuffer(b"".join(x for _, x in found), np.uint8), np.cumsum(size) - size, size

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = START + 1
        total = np.zeros(2 * width * width, np.int64)
        for label, data, start, size in labelled(batches, False):
            if len(size):
                before, code = before_and_after(data, start, size)
                total += np.bincount((np.repeat(label, size) * width + before) * width + code, minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (some // width**2, some // width % width, some % width, total[some])], names=["k", "a", "b", "n"])

    pairs: dict[int, Counter] = {0: Counter(), 1: Counter()}
    for x in made_strings():
        pairs[1].update(steps(x))
    for r in fold(0).mapInArrow(count, "k long, a long, b long, n long").groupBy("k", "a", "b").agg(F.sum("n").alias("n")).collect():  # pairs of characters
        pairs[r["k"]][r["a"], r["b"]] += r["n"]
    models = Models(pairs[1], pairs[0])
    state = docs.sparkSession.sparkContext.broadcast(models)

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for label, data, start, size in labelled(batches, True):
            value = np.floor_divide(state.value.scores(data, start, size), BIN).astype(np.int64)
            found, n = np.unique(np.stack([label, length_class(size), value]), axis=1, return_counts=True)
            seen.update(dict(zip(zip(*found.tolist(), strict=True), n.tolist(), strict=True)))
        yield pa.RecordBatch.from_arrays([*[pa.array([x[k] for x in seen], pa.int64()) for k in range(3)], pa.array([*seen.values()], pa.int64())], names=["k", "size", "bin", "n"])

    held = {(label, k): Counter() for label in (0, 1) for k in range(len(LENGTHS))}
    for x in filter(None, map(candidate, made_strings(21))):
        held[1, int(length_class(len(x)))][int(models.score(x) // BIN)] += 1
    for r in fold(1).mapInArrow(judge, "k long, size long, bin long, n long").groupBy("k", "size", "bin").agg(F.sum("n").alias("n")).collect():  # bins of ratios
        held[r["k"], r["size"]][r["bin"]] += r["n"]
    for k in range(len(LENGTHS)):
        models.set_threshold(k, held[1, k], held[0, k])
    return models


class Scanned:
    """Several texts joined by line feeds, which no token and no base span passes: spans by text, in code points."""

    def __init__(self, docs: list[bytes], models: Models):
        size = np.array([len(d) for d in docs], np.int64)
        start = np.cumsum(size + 1) - size - 1
        data = np.frombuffer(b"\n".join([*docs, b""]), np.uint8)
        base = [(s + a, k, s + b) for s, d in zip(start.tolist(), docs, strict=True) for a, k, b in base_spans(d)]
        left, kind, right = (np.array([b[k] for b in base], np.int64) for k in range(3))
        # tokens, without punctuation at their ends
        inside = np.concatenate([[False], CODE[data] >= 0, [False]])
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        at, end = edge[::2], edge[1::2]
        some = end - at >= LENGTHS[0]
        at, end = at[some], end[some]
        solid = np.flatnonzero(~EDGE[data])
        low, high = np.searchsorted(solid, at), np.searchsorted(solid, end)
        at, end, some = at[low < high], end[low < high], np.flatnonzero(low < high)
        at, end = solid[low[some]], solid[high[some] - 1] + 1
        # those of a judged length outside of base spans
        cover = np.zeros(len(data) + 2, np.int32)
        np.add.at(cover, left, 1)
        np.add.at(cover, right, -1)
        covered = np.append(0, np.cumsum(np.cumsum(cover)[:-1] > 0))
        good = (end - at >= LENGTHS[0]) & (covered[end] == covered[at])
        at, end = at[good], end[good]
        value = models.scores(data, at, end - at)
        self.doc_of = np.searchsorted(start, at, "right") - 1
        self.value = value
        hit = value > models.thresholds[length_class(end - at)]
        points = np.append(0, np.cumsum((data & 0xC0) != 0x80))
        every = [np.concatenate(x) for x in ((left, at[hit]), (kind, np.full(hit.sum(), 3)), (right, end[hit]))]
        doc = np.searchsorted(start, every[0], "right") - 1
        order = np.lexsort((every[1], every[0]))
        self.spans: list[list[tuple[int, int, int]]] = [[] for _ in docs]
        for d, a, k, b in zip(*(x[order].tolist() for x in (doc, points[every[0]] - points[start[doc]], every[1], points[every[2]] - points[start[doc]])), strict=True):
            self.spans[d].append((a, k, b))
        self.top = np.zeros(len(docs))
        np.maximum.at(self.top, self.doc_of, value)


def spans_of(text: str, models: Models) -> list[tuple[int, int, int]]:
    """All spans of a text."""
    return Scanned([text.encode()], models).spans[0]


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


SCHEMA = "_id {id}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_markov long, top_ratio double"


def scan(docs: DataFrame, models: Models, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of each whole text as kind:start:end in code points, by start, then kind. Null is the empty text; a row for each
    row, repeated or not; a text of any length is scanned at once."""
    source = bounded(docs).select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    state = docs.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            found = Scanned(texts(batch, "_text"), state.value)
            base = [[s for s in spans if s[1] < 3] for spans in found.spans]
            counts = [[sum(s[1] == k for s in spans) for spans in found.spans] for k in range(4)]
            digests = [hashlib.sha256(written(spans).encode()).hexdigest() for spans in base]
            columns = [*[pa.array(c, pa.int64()) for c in counts[:3]], pa.array(digests, pa.string()), pa.array(list(map(written, found.spans)), pa.string()), pa.array(counts[3], pa.int64()), pa.array(found.top)]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), *columns], names=["_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_markov", "top_ratio"])

    return source.mapInArrow(run, SCHEMA.format(id=source.schema["_id"].dataType.simpleString()))


def redact(docs: DataFrame, models: Models, id_col: str = "doc_id", text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """All columns of the documents, with every span in the text replaced by a mark; null stays null."""
    state = docs.sparkSession.sparkContext.broadcast(models)
    others = [c for c in docs.columns if c != text_col]
    names = [f"_k{i}" for i in range(len(others))]
    source = bounded(docs).select(*[F.col(f"`{c}`").alias(n) for c, n in zip(others, names, strict=True)], F.col(text_col).alias("_text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            out = []
            for text in batch.column("_text").to_pylist():
                if text:
                    parts, at = [], 0
                    for start, _, end in spans_of(text, state.value):
                        if start >= at:
                            parts += [text[at:start], mark]
                        at = max(at, end)
                    text = "".join([*parts, text[at:]])
                out.append(text)
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(out, pa.string())], names=[*names, "_text"])

    found = source.mapInArrow(run, source.schema)
    return found.select(*[F.col(n).alias(c) for n, c in zip(names, others, strict=True)], F.col("_text").alias(text_col)).select(*docs.columns)
