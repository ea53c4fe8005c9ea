"""Language ID by segmentation-marginalised unigrams.

Every language has a probability for each piece of a fixed public vocabulary. A word's
probability is the sum over all of its segmentations into pieces, by the forward
algorithm; a text's is the product over its words. Piece probabilities are trained by
expectation maximisation (forward-backward) on a bounded sample of labelled rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicloom.llm.blobs import spread
from topicloom.llm.common import Ids, bounded, cut, slices

#: Letter runs; digits and underscores part words.
WORD = re.compile(r"[^\W\d_]+")
#: Words of more characters, start mark included, are summed by themselves and rescaled on the way: products of so many stay above
#: the least double.
LONG = 30
#: Characters of a long word whose arcs are held together, and after how many it is rescaled.
RUN, RESCALE = 1024, 16
#: Long words that go forward together, and arcs that are held for them.
ABREAST, CELLS = 2048, 1 << 20
#: Text bytes that are scored at once.
PIECE = 2 << 20
#: Words, and bytes of words, whose lattices are held together.
TOGETHER, WORD_BYTES = 20_000, 1 << 18
#: Least probability of a piece, and that of a character without a piece.
FLOOR, UNKNOWN = 1e-9, 1e-9
SPACE = "▁"
UNDETERMINED = "und"


def vocabulary_path() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """A trie over the lower-case pieces of a sentencepiece vocabulary, as sorted edge keys."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.names = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)) and piece == piece.lower() and SPACE not in piece[1:]:
                self.names.append(piece)
        edges, ends, nodes = {}, {}, 1
        for k, piece in enumerate(self.names):
            at = 0
            for c in piece:
                key = at << 21 | ord(c)
                if key not in edges:
                    edges[key], nodes = nodes, nodes + 1
                at = edges[key]
            ends[at] = k
        self.keys = np.array(sorted(edges), np.int64)
        self.child = np.array([edges[k] for k in sorted(edges)], np.int64)
        self.piece = np.full(nodes, -1, np.int64)
        self.piece[list(ends)] = list(ends.values())
        self.longest = max(map(len, self.names), default=0)

    def step(self, node: np.ndarray, char: np.ndarray) -> np.ndarray:
        """Children by a character; -1 where there is none."""
        key = node << 21 | char
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.child[at], -1)


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


class Lattice:
    """All segmentations of a list of words: arcs by (offset of their start, length)."""

    def __init__(self, vocab: Pieces, parts: list[str]):
        self.flat = np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32).astype(np.int64)
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        stop = np.cumsum(size)
        self.begin = stop - size + np.arange(len(parts))  # in alpha each part has a place more than it has characters
        self.stop = stop + np.arange(len(parts))
        offset = np.arange(len(self.flat)) - np.repeat(stop - size, size)
        end, start = np.repeat(stop, size), np.arange(len(self.flat))
        place = start + np.repeat(np.arange(len(parts)), size)
        self.places, self.arcs = len(self.flat) + len(parts), []
        live, node = start, np.zeros(len(start), np.int64)
        single = np.zeros(len(start), bool)
        for n in range(1, min(vocab.longest, int(size.max(initial=0))) + 1):
            inside = live + n - 1 < end[live]
            live, node = live[inside], node[inside]
            node = vocab.step(node, self.flat[live + n - 1])
            there = node >= 0
            live, node = live[there], node[there]
            if not len(live):
                break
            piece = vocab.piece[node]
            whole = piece >= 0
            if n == 1:
                single[live[whole]] = True
            self._add(offset[live[whole]], place[live[whole]], n, piece[whole])
        bare = start[~single]
        self._add(offset[bare], place[bare], 1, np.full(len(bare), -1))
        self.arcs.sort(key=lambda a: a[0])

    def _add(self, offset: np.ndarray, place: np.ndarray, n: int, piece: np.ndarray) -> None:
        order = np.argsort(offset, kind="stable")
        offset, place, piece = offset[order], place[order], piece[order]
        cuts = np.flatnonzero(np.diff(offset)) + 1
        for o, p, q in zip(np.split(offset, cuts), np.split(place, cuts), np.split(piece, cuts), strict=True):
            if len(o):
                self.arcs.append((int(o[0]), p, n, q))

    def forward(self, prob: np.ndarray) -> np.ndarray:
        """prob: a row for each piece, the last for characters without a piece; a column for each language."""
        alpha = np.zeros((self.places, prob.shape[1]))
        alpha[self.begin] = 1
        for _, place, n, piece in self.arcs:
            alpha[place + n] += alpha[place] * prob[piece]
        return alpha

    def expected(self, prob: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Expected uses of each piece; weight: how often each part occurs, by language."""
        alpha = self.forward(prob)
        beta, out = np.zeros_like(alpha), np.zeros_like(prob)
        beta[self.stop] = weight / np.maximum(alpha[self.stop], 1e-300)
        for _, place, n, piece in reversed(self.arcs):
            flow = prob[piece] * beta[place + n]
            np.add.at(out, piece, alpha[place] * flow)
            beta[place] += flow
        return out


class LongWord:
    """All segmentations of one word of the training sample, of any length; a letter is a step."""

    def __init__(self, vocab: Pieces, prob: np.ndarray, word: str):
        self.vocab, self.code = vocab, np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.int64)
        self.prob = np.vstack([prob, np.zeros(prob.shape[1])])
        self.none = len(prob)

    def pieces(self, at: int, to: int) -> np.ndarray:
        """Pieces by start and length; rows of ``prob``, the last for no piece."""
        start = np.arange(at, to)
        out = np.full((to - at, self.vocab.longest), self.none)
        node, live = np.zeros(to - at, np.int64), np.arange(to - at)
        for n in range(1, self.vocab.longest + 1):
            live = live[start[live] + n <= len(self.code)]
            node[live] = self.vocab.step(node[live], self.code[start[live] + n - 1])
            live = live[node[live] >= 0]
            piece = self.vocab.piece[node[live]]
            out[live[piece >= 0], n - 1] = piece[piece >= 0]
        bare = out[:, 0] == self.none
        out[bare, 0] = self.none - 1
        return out

    def forward(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each place from the first to the end: the sum over segmentations before it, and the log of its scale."""
        ahead, scale = np.zeros((self.vocab.longest + 1, self.prob.shape[1])), np.zeros(self.prob.shape[1])
        ahead[0] = 1
        for at in range(0, len(self.code), RUN):
            arcs = self.prob[self.pieces(at, min(at + RUN, len(self.code)))]
            for k, arc in enumerate(arcs):
                yield ahead[0], scale
                here = ahead[0].copy()
                ahead[:-1] = ahead[1:]
                ahead[-1] = 0
                ahead[:-1] += here * arc
                if k % RESCALE == 0:
                    top = ahead.max(axis=0)
                    ahead, scale = ahead / top, scale + np.log(top)
        yield ahead[0], scale

    def expected(self, weight: np.ndarray, out: np.ndarray) -> None:
        """Add the expected uses of each piece. Words of the training sample only: all places are held."""
        n, longest = len(self.code), self.vocab.longest
        before = np.stack([np.log(np.maximum(here, 1e-300)) + scale for here, scale in self.forward()])
        index = self.pieces(0, n)
        behind, scale = np.zeros((longest, self.prob.shape[1])), np.zeros(self.prob.shape[1])
        behind[0] = 1
        after = np.zeros_like(before)
        for i in range(n - 1, -1, -1):
            here = (behind * self.prob[index[i]]).sum(axis=0)
            behind = np.concatenate([here[None], behind[:-1]])
            after[i] = np.log(here) + scale
            if i % RESCALE == 0:
                top = behind.max(axis=0)
                behind, scale = behind / top, scale + np.log(top)
        for k in range(min(longest, n)):
            there = np.flatnonzero(index[:, k] != self.none)
            there = there[there + k + 1 <= n]
            piece = index[there, k]
            np.add.at(out, piece, weight * self.prob[piece] * np.exp(before[there] + after[there + k + 1] - before[-1]))


def long_logs(vocab: Pieces, prob: np.ndarray, words: list[str]) -> np.ndarray:
    """Natural log of the probability of each word of any length, by language: all words go forward a letter at a step, together."""
    prob = np.vstack([prob, np.zeros(prob.shape[1])])
    none, order = len(prob) - 1, sorted(range(len(words)), key=lambda k: -len(words[k]))
    size = np.array([len(words[k]) for k in order], np.int64)
    code = np.frombuffer("".join(words[k] for k in order).encode("utf-32-le"), np.uint32).astype(np.int64)
    begin = np.cumsum(size) - size
    ahead, scale = np.zeros((len(words), vocab.longest + 1, prob.shape[1])), np.zeros((len(words), prob.shape[1]))
    ahead[:, 0] = 1
    at = 0
    while at < size.max(initial=0):
        live = int(np.searchsorted(-size, -at))  # words that are longer than ``at``: the first ones
        run = max(1, min(RUN, CELLS // (live * vocab.longest)))
        here = np.minimum(size[:live] - at, run)
        start = spread(begin[:live] + at, here)
        end = np.repeat(begin[:live] + size[:live], here)
        arcs = np.full((live, run, vocab.longest), none, np.int32)
        row, column = np.repeat(np.arange(live), here), spread(np.zeros(live, np.int64), here)
        node, open_ = np.zeros(len(start), np.int64), np.arange(len(start))
        for n in range(1, vocab.longest + 1):
            open_ = open_[start[open_] + n <= end[open_]]
            node[open_] = vocab.step(node[open_], code[start[open_] + n - 1])
            open_ = open_[node[open_] >= 0]
            piece = vocab.piece[node[open_]]
            whole = open_[piece >= 0]
            arcs[row[whole], column[whole], n - 1] = piece[piece >= 0]
        bare = arcs[row, column, 0] == none
        arcs[row[bare], column[bare], 0] = none - 1
        for k in range(run):
            m = int(np.searchsorted(-size, -(at + k)))
            if not m:
                break
            part = ahead[:m]
            before = part[:, 0].copy()
            part[:, :-1] = part[:, 1:]
            part[:, -1] = 0
            part[:, :-1] += before[:, None] * prob[arcs[:m, k]]
            if k % RESCALE == 0:
                top = part.max(axis=1)
                part /= top[:, None]
                scale[:m] += np.log(top)
        at += run
    out = np.empty((len(words), prob.shape[1]))
    out[order] = np.log(ahead[:, 0]) + scale
    return out


def word_log(vocab: Pieces, prob: np.ndarray, words: list[str]) -> np.ndarray:
    """Natural log of each word's probability, by language."""
    out = np.zeros((len(words), prob.shape[1]))
    for at in range(0, len(words), TOGETHER):
        some = [SPACE + w for w in words[at : at + TOGETHER]]
        short = [k for k, w in enumerate(some) if len(w) <= LONG]
        lattice = Lattice(vocab, [some[k] for k in short])
        out[[at + k for k in short]] = np.log(np.maximum(lattice.forward(prob)[lattice.stop], 1e-300))
        long = [k for k, w in enumerate(some) if len(w) > LONG]
        for a in range(0, len(long), ABREAST):
            part = long[a : a + ABREAST]
            out[[at + k for k in part]] = long_logs(vocab, prob, [some[k] for k in part])
    return out


def sample_rows(train: DataFrame, by: str, per_group: int, key: Column, counts: dict) -> DataFrame:
    """At most ``per_group`` rows of each group, those with the least hash of ``key``. counts: rows by group; hashes that are surely
    too large are left out where they are read, so that few rows meet in a group's task."""
    order = Window.partitionBy(by).orderBy(F.xxhash64(key), key)
    least, rows = F.lit(None).cast("long"), train.select(key, by)
    for group, n in counts.items():
        bound = (1 << 63) - 1 if n <= 8 * per_group else -(1 << 63) + (1 << 64) * 4 * per_group // n
        least = F.when(F.col(by) == group, F.lit(bound)).otherwise(least)
    ranked = lambda df: cut(df.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= per_group).select(key, by))
    found = ranked(rows.where(F.xxhash64(key) <= least))
    have = {r[by]: r["count"] for r in found.groupBy(by).count().collect()}
    return found if all(have.get(g, 0) >= min(n, per_group) for g, n in counts.items()) else ranked(rows)  # else ids repeat


class LanguageModel:
    def __init__(self, path: str, langs: list[str], prob: np.ndarray, prior: np.ndarray):
        self.path, self.langs, self.prob, self.prior = path, langs, prob, prior


def fit(train: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_lang: int = 300, rounds: int = 3, path: str | None = None) -> LanguageModel:
    """Train on rows with text and language. ``per_lang`` bounds the sample of labelled rows of a language that
    the piece probabilities are fitted on; priors count all rows. Needs the languages to be few (hundreds)."""
    path = path or vocabulary_path()
    known = bounded(train).where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(lang_col).alias("_lang"))
    counts = {r["_lang"]: r["n"] for r in known.groupBy("_lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(counts)
    vocab = pieces(path)
    size = len(vocab.names) + 1
    if not langs:
        return LanguageModel(path, [], np.zeros((size, 0)), np.zeros(0))
    chosen = F.broadcast(sample_rows(known, "_lang", per_lang, F.col("_id"), counts))  # at most per_lang ids a language

    def count_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            seen: dict[tuple[str, str], int] = {}
            for lang, text in zip(batch.column("_lang").to_pylist(), batch.column("_text").to_pylist(), strict=True):
                for w in WORD.findall(text.lower()):
                    seen[lang, w] = seen.get((lang, w), 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in seen], pa.string()), pa.array([k[1] for k in seen], pa.string()), pa.array(list(seen.values()), pa.int64())], names=["lang", "word", "n"])

    words = cut(known.join(chosen, ["_id", "_lang"], "left_semi").mapInArrow(count_words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")))
    prob = np.full((size, len(langs)), 1.0 / size)
    prob[-1] = UNKNOWN
    place = {x: k for k, x in enumerate(langs)}
    for _ in range(rounds):
        state = train.sparkSession.sparkContext.broadcast(prob)

        def expect(batches: Iterable[pa.RecordBatch], state=state) -> Iterator[pa.RecordBatch]:
            total = np.zeros((size, len(place)))
            for batch in slices(batches, "word", WORD_BYTES):
                words = [SPACE + w for w in batch.column("word").to_pylist()]
                weight = np.zeros((batch.num_rows, len(place)))
                weight[np.arange(batch.num_rows), [place[x] for x in batch.column("lang").to_pylist()]] = batch.column("n").to_numpy()
                short = [k for k, w in enumerate(words) if len(w) <= LONG]
                total += Lattice(pieces(path), [words[k] for k in short]).expected(state.value, weight[short])
                for k, w in enumerate(words):
                    if len(w) > LONG:
                        LongWord(pieces(path), state.value, w).expected(weight[k], total)
            piece, lang = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(piece, pa.int64()), pa.array(lang, pa.int64()), pa.array(total[piece, lang], pa.float64())], names=["piece", "lang", "n"])

        uses = np.zeros_like(prob)
        for r in words.mapInArrow(expect, "piece long, lang long, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n")).collect():  # pieces by languages
            uses[r["piece"], r["lang"]] = r["n"]
        uses[-1] = 0
        prob = np.maximum((uses + 0.01) / (uses.sum(axis=0) + 0.01 * size), FLOOR)
        prob[-1] = UNKNOWN
        state.unpersist()
    prior = np.log(np.array([counts[x] for x in langs], float) / sum(counts.values()))
    return LanguageModel(path, langs, prob, prior)


def predict(docs: DataFrame, model: LanguageModel, text_col: str = "text", keep: list[str] | None = None, add: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Add two columns to those in ``keep``: the language and its posterior probability.

    Whole texts are scored. Null texts, texts without a letter and all texts of a model without
    languages get ``und`` and 0. Rows, repeated or not, are judged each by itself; no shuffle.
    Columns of the names in ``add`` that the input has already are replaced."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in add]
    names = [f"_k{i}" for i in range(len(keep))]
    source = bounded(docs).select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)], F.col(text_col).alias("_text"))
    state = docs.sparkSession.sparkContext.broadcast(model)
    schema = source.select(*names).schema.add("lang_pred", "string").add("score", "double")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = state.value
        vocab = pieces(m.path)
        for batch in slices(batches, "_text", PIECE):
            ids, tokens, sizes, lettered = Ids(), [], [], []
            get = ids.__getitem__
            for text in batch.column("_text").to_pylist():
                found = WORD.findall(text.lower()) if text else []
                lettered.append(any(any(map(str.isalpha, w)) for w in found))
                tokens.append(np.fromiter(map(get, found), np.int64, len(found)))
                sizes.append(len(found))
            langs, scores = [UNDETERMINED] * batch.num_rows, np.zeros(batch.num_rows)
            if ids and m.langs:
                logs = word_log(vocab, m.prob, list(ids))
                full = [k for k, n in enumerate(sizes) if n]
                starts = np.cumsum([0, *[sizes[k] for k in full[:-1]]])
                flat = np.concatenate([tokens[k] for k in full])
                total = np.stack([np.add.reduceat(logs[flat, x], starts) for x in range(len(m.langs))], axis=1) + m.prior
                total -= total.max(axis=1, keepdims=True)
                odds = np.exp(total)
                best = odds.argmax(axis=1)
                for k, b, p in zip(full, best, odds.max(axis=1) / odds.sum(axis=1), strict=True):
                    if lettered[k]:
                        langs[k], scores[k] = m.langs[b], min(1.0, p)
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*names, "lang_pred", "score"])

    out = source.mapInArrow(run, schema)
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, keep, strict=True)], *[F.col(a).alias(b) for a, b in zip(("lang_pred", "score"), add, strict=True)])


def held_out(id_col: str = "doc_id"):
    """The fold that is never learnt from: crc32 of the id as text, modulo 4, is 2. A null id is in no fold."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", keep: list[str] | None = None, **options) -> DataFrame:
    """Learn from the labelled rows outside the held-out fold, then predict all rows.

    Nulls: a null text is ``und``; rows with a null text or language aren't learnt from. Empty table: no rows."""
    model = fit(docs.where(~held_out(id_col)), id_col, text_col, lang_col, **options)
    return predict(docs, model, text_col, keep)

