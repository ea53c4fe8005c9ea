"""Language-model scores by a probabilistic suffix tree.

A text is a run of tokens: its words, then one end. Contexts are runs of up to TOKENS preceding
tokens, so a score depends on the order of words. A context is retained if its next-token
distribution diverges from that of its suffix: next tokens seen MIN_COUNT times or more gain
GAIN_NATS at least, in sum over their occurrences. Both bounds are absolute, so the tree grows
with the corpus. Distributions are smoothed by absolute discounting, interpolated with that of
the longest retained suffix; every token is scored in the longest suffix state of its history.

In the empty state a token has its discounted count, and what the discounts leave times its
spelling: bytes from a start mark to an end mark, each in the longest state of up to DEPTH bytes
before it, by a tree of the same kind over the distinct words learnt. So a word that wasn't learnt
has the probability of its own spelling, and the probabilities of all words add up to one.

Where it runs. Texts become blocks, a table of token numbers. For each level of the tree a block
asks about its own distinct contexts and what follows them: the questions are dealt by the
context's hash, so that one task has all of a context, counted once for a block; the answers go
back to the block. Questions and answers are arrays in binary columns, a row for each block and
part. Nothing of the tree is on the driver but byte pairs after at most TOP bytes (the alphabet
bounds them). Tokens and their runs are known by hashes of 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicloom.llm.blobs import BLOBS, SHAPE, columns, edges_of, exists, move, part_of, planes, row, rows, save, spread, unplanes
from topicloom.llm.common import bounded, freeing, keep_freed, mix64, remove_path, shared_path, slices, texts, word_keys, word_spans

#: Bytes, and preceding tokens, that a context has at most.
DEPTH, TOKENS = 6, 2
DISCOUNT = 0.75
#: Least count of a listed next token, and of a context.
MIN_COUNT = 2
#: Least gain of a retained context over its suffix, in nats over all that follows it.
GAIN_NATS = 3.0
#: Spelling contexts of up to so many bytes are bounded by the alphabet, and known everywhere.
TOP = 2
#: Text bytes of a block, and of what a part of the questions stands for; bytes of distinct words whose places a part spells.
BLOCK_BYTES, PART_BYTES, SPELT_BYTES = 4 << 20, 8 << 20, 1 << 20
#: Rounds in which a level's questions are asked, at most; those about longer contexts are more. What is shuffled at once is so much less.
ROUNDS = 2
START, STOP = 0x20, 0x0A
#: Bytes that lower-cased words, or their stop, are made of.
ALPHABET = np.array([b for b in range(256) if b not in b" \t\v\f\r" and not 0x41 <= b <= 0x5A])


def sort(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of their whole-number keys (equal keys: of the places), and the keys so.

    A key and its place are one number of 64 bits, as numbers are sorted in a third of the time that places take. If a key's lowest
    bits don't fit, what is nearly sorted without them is sorted again."""
    bits = max(len(key) - 1, 0).bit_length()
    lost = max(0, int(key.max(initial=0)).bit_length() + bits - 64)
    if key.min(initial=0) < 0:
        order = np.argsort(key, kind="stable")
        return order, key[order]
    both = key.astype(np.uint64)
    both >>= np.uint64(lost)
    both <<= np.uint64(bits)
    both |= np.arange(len(key), dtype=np.uint64)
    both.sort()
    order = (both & np.uint64((1 << bits) - 1)).view(np.int64)
    ordered = key[order] if lost else (both >> np.uint64(bits)).astype(key.dtype)
    if lost and (ordered[1:] < ordered[:-1]).any():
        again = np.argsort(ordered, kind="stable")
        order, ordered = order[again], ordered[again]
    return order, ordered


def changes(ordered: np.ndarray) -> np.ndarray:
    """Of ordered keys, which aren't the one before."""
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return new


def numbered(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each distinct key, in order, its first place; of each key, its number."""
    order, ordered = sort(key)
    new = changes(ordered)
    number = np.empty(len(key), np.int64)
    number[order] = np.cumsum(new, dtype=np.int64) - 1
    return order[new], number


def member(ordered: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places in a sorted array; -1 where there is none."""
    if not len(ordered):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(ordered, keys), len(ordered) - 1)
    return np.where(ordered[at] == keys, at, -1)


def joined_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of a run of tokens, from those of its start and of its last token."""
    with np.errstate(over="ignore"):
        return mix64(mix64(left) * np.uint64(0x9FB21C651E98DF25) + right)


def words_of(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The texts in lower case, where their words begin, the words' bytes, and words by text."""
    data = b"\n".join([*texts, b""]).lower()
    start, size = word_spans(data)
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    return data, start, size, np.diff(np.searchsorted(start, ends), prepend=0)


def training(id_col: Column) -> Column:
    """Documents to learn from: crc32 of the id as text, modulo 7, isn't 2. A null id is learnt from."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 7 != 2, F.lit(True))


def blocks_of(source: DataFrame, path: str, parts: int) -> None:
    """Write the blocks, and their questions about words. source: ``_id``, ``_text``, ``_train``.

    ``kind=0``: a: token numbers (0: end; words from 1 in the order of their hashes), b: tokens by document, c: whether it is
    learnt from; ids. ``kind=1``, by part: a: hashes of words, b: their sizes, c: their bytes, d: uses in training."""
    kind = source.schema["_id"].dataType.simpleString()
    least = edges_of(parts)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_freed()
        block = TaskContext.get().partitionId() << 32
        for batch in slices(batches, "_text", BLOCK_BYTES, even=True):
            data, start, width, n = words_of(texts(batch, "_text"))
            keys = word_keys(data, start, width)
            one, number = numbered(keys)
            keys, learnt = keys[one], batch.column("_train").to_numpy(zero_copy_only=False)
            uses = np.bincount(number, np.repeat(learnt, n), len(one)).astype(np.int64)
            tokens = np.zeros(len(number) + len(n), np.int64)
            tokens[np.arange(len(number)) + np.repeat(np.arange(len(n)), n)] = number + 1
            own = batch.column("_id")
            yield both(0, pa.array([own.to_pylist()], pa.list_(own.type)), row(block, None, planes(tokens), planes(n + 1), planes(learnt)))
            start, width = start[one], width[one]
            raw, ends = np.frombuffer(data, np.uint8)[spread(start, width)].tobytes(), np.append(0, np.cumsum(width))
            cuts = np.append(np.searchsorted(keys, least), len(keys))
            asked = ((block, int(part), keys[a:b].tobytes(), planes(width[a:b]), raw[ends[a] : ends[b]], planes(uses[a:b])) for part in np.flatnonzero(np.diff(cuts)) for a, b in [cuts[part : part + 2]])
            for some in rows(asked):
                yield both(1, pa.nulls(some.num_rows, pa.list_(own.type)), some)
            block += 1

    def both(number: int, ids: pa.Array, rest: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), number, np.int32)), ids, *rest.columns], names=["kind", "ids", *SHAPE.names])

    save(source.mapInArrow(run, f"kind int, ids array<{kind}>, {BLOBS}"), path)


def vocabulary(words: DataFrame, path: str) -> None:
    """Write, by part: ``kind=0``: b: sizes, c: bytes, d: counts of the distinct words; how many, the sum of their counts, how many
    are learnt, and their bytes in n, x, y and z. ``kind=1``, by block: a: numbers of the block's words in the part."""

    def run(table: pa.Table) -> pa.Table:
        found = list(columns(table, "uibi"))
        keys, size, uses = (np.concatenate([f[k] for f in found]) for k in (2, 3, 5))
        data, part = b"".join(f[4] for f in found), found[0][1]
        one, number = numbered(keys)
        count = np.bincount(number, uses, len(one)).astype(np.int64)
        raw = np.frombuffer(data, np.uint8)[spread((np.cumsum(size) - size)[one], size[one])]
        out, at = [(None, part, b"", planes(size[one]), raw.tobytes(), planes(count))], 0
        for f in found:
            out.append((f[0], part, planes(number[at : at + len(f[2])])))
            at += len(f[2])
        whole = pa.Table.from_batches(rows(out)).add_column(0, "kind", pa.array([0] + [1] * len(found), pa.int32()))
        for name, value in (("n", len(one)), ("x", int(count.sum())), ("y", int((count > 0).sum())), ("z", len(raw))):
            whole = whole.append_column(name, pa.array([value] + [None] * len(found), pa.int64()))
        return whole

    save(words.groupBy("part").applyInArrow(run, f"kind int, {BLOBS}, n long, x long, y long, z long"), path)


def places(size: np.ndarray, data: bytes, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each byte of the words, and of their stops: its word, it with up to ``depth`` bytes before (lowest first), and how many those are."""
    keep_freed()
    n = len(size)
    raw = np.zeros(len(data) + 2 * n + 7, np.uint8)  # what eight bytes are that end at a place
    begin = np.cumsum(size + 2) - size + 5
    raw[begin], raw[begin + size + 1] = START, STOP
    raw[spread(begin + 1, size)] = np.frombuffer(data, np.uint8)
    word = np.repeat(np.arange(n), size + 1)
    place = spread(begin + 1, size + 1)
    back = np.minimum(place - begin[word], depth)
    at = np.ndarray((len(raw) - 7,), ">u8", buffer=raw, strides=(1,))[place - 7].astype(np.int64)
    return word, at & ((1 << 8 * (back + 1)) - 1), back  # a start mark stands in no word: distinct histories differ


class Spelt:
    """The distinct places of words: ``at``: up to DEPTH bytes of history and the byte, ``back``: bytes of history; where the
    words' bytes stand among them, and whose they are."""

    def __init__(self, size: np.ndarray, data: bytes):
        self.word, at, back = places(size, data, DEPTH)
        one, self.where = numbered(mix64(at.astype(np.uint64)))  # hashes, distinct as their places are, differ in their upper bits
        self.at, self.back = at[one], back[one]


class Level:
    """Spelling contexts of one depth: sorted (context, byte) pairs with counts; totals of the contexts, and which are retained."""

    def __init__(self, pairs: np.ndarray, n: np.ndarray):
        one, where = numbered(pairs)
        self.pairs, self.n = pairs[one], np.bincount(where, n, len(one))
        context = self.pairs >> 8  # in order, as pairs are
        new = changes(context)
        self.of, self.contexts = np.cumsum(new) - 1, context[new]
        self.total = np.bincount(self.of, self.n, len(self.contexts))
        self.rest = 1 - np.bincount(self.of, self.n - DISCOUNT, len(self.contexts)) / self.total
        self.kept = np.ones(len(self.contexts), bool)

    def gains(self, below: Level, bits: int) -> np.ndarray:
        at = member(below.pairs, self.pairs & ((1 << bits) - 1))
        return np.bincount(self.of, self.n * np.log(self.n / self.total[self.of] * below.total[below.of[at]] / below.n[at]), len(self.contexts))


def spelling(top: list[tuple[np.ndarray, np.ndarray]], at: np.ndarray, back: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Natural log of places' bytes. c: words learnt that have the place. top: pairs and counts of depths to TOP of the whole;
    of the deeper contexts, all places have to be here."""
    pair_of = lambda d: at & ((1 << 8 * (d + 1)) - 1)
    levels = [Level(*t) for t in top]
    for d in range(TOP + 1, DEPTH + 1):
        on = (back >= d) & (c > 0)
        levels.append(Level(pair_of(d)[on], c[on]))
    for d in range(DEPTH, TOP, -1):
        here = levels[d]
        here.kept = (here.total >= MIN_COUNT) & (here.gains(levels[d - 1], 8 * d) >= GAIN_NATS)
        if d < DEPTH:  # suffixes of those retained
            longer = levels[d + 1]
            here.kept[member(here.contexts, np.unique(longer.contexts[longer.kept] & ((1 << 8 * d) - 1)))] = True
    root = np.zeros(256)
    root[ALPHABET] = 1
    root[levels[0].pairs] += levels[0].n
    p = [root / root.sum()]
    for d in range(1, DEPTH + 1):
        here = levels[d]
        suffix = here.pairs & ((1 << 8 * d) - 1)
        lower = p[0][suffix] if d == 1 else p[d - 1][member(levels[d - 1].pairs, suffix)]
        p.append((here.n - DISCOUNT) / here.total[here.of] + here.rest[here.of] * lower)
    log, live = np.zeros(len(at)), np.arange(len(at))
    for d in range(DEPTH, 0, -1):
        here, pairs = levels[d], pair_of(d)[live]
        state = np.where(back[live] >= d, member(here.contexts, pairs >> 8), -1)
        state[state >= 0] = np.where(here.kept[state[state >= 0]], state[state >= 0], -1)
        pair = np.where(state >= 0, member(here.pairs, pairs), -1)
        log[live[pair >= 0]] += np.log(p[d][pair[pair >= 0]])
        apart = (state >= 0) & (pair < 0)
        log[live[apart]] += np.log(here.rest[state[apart]])
        live = live[pair < 0]
    log[live] += np.log(p[0][at[live] & 255])
    return log


def spelt(vocab: DataFrame, groups: int) -> DataFrame:
    """By part of the vocabulary, a: natural logs of its words' spellings. groups: parts that places are dealt to."""
    spark = vocab.sparkSession

    def first(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(np.zeros(0, np.int64),) * 2] * (TOP + 1)  # bounded by the alphabet
        for batch in batches:
            for _, _, _, size, data, count in columns(pa.Table.from_batches([batch]), "bibi"):
                word, at, back = places(size, data, TOP)
                learnt = (count > 0)[word]
                for d in range(TOP + 1):
                    pair, n = np.unique(at[learnt & (back >= d)] & ((1 << 8 * (d + 1)) - 1), return_counts=True)
                    pair, n = np.append(held[d][0], pair), np.append(held[d][1], n)
                    one, number = numbered(pair)
                    held[d] = pair[one], np.bincount(number, n, len(one)).astype(np.int64)
        for d, (pair, n) in enumerate(held):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pair), d)), pa.array(pair), pa.array(n)], names=["depth", "pair", "n"])

    blobs = vocab.select("block", "part", "a", "b", "c", "d")
    counted = blobs.mapInArrow(first, "depth long, pair long, n long").groupBy("depth", "pair").agg(F.sum("n").alias("n")).toPandas()  # bounded by the alphabet
    top = [(of["pair"].to_numpy(np.int64), of["n"].to_numpy(np.float64)) for _, of in ((d, counted[counted["depth"] == d].sort_values("pair")) for d in range(TOP + 1))]
    state = spark.sparkContext.broadcast(top)

    def dealt(s: Spelt) -> tuple[np.ndarray, np.ndarray]:
        """Places in the order of their groups (the last TOP + 1 bytes of history), and where parts begin."""
        group = part_of(mix64(np.where(s.back > TOP, (s.at >> 8) & ((1 << 8 * (TOP + 1)) - 1), 0).astype(np.uint64) + np.uint64(1)), groups)
        return np.argsort(group, kind="stable"), np.append(0, np.cumsum(np.bincount(group, minlength=groups)))

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, part, _, size, data, count in columns(pa.Table.from_batches([batch]), "bibi"):
                s = Spelt(size, data)
                c = np.bincount(s.where, (count > 0)[s.word], len(s.at)).astype(np.int64)
                order, cuts = dealt(s)
                at, back, c = s.at[order], s.back[order], c[order]
                yield from rows((part, int(group), planes(at[a:b]), planes(back[a:b]), planes(c[a:b])) for group in np.flatnonzero(np.diff(cuts)) for a, b in [cuts[group : group + 2]])

    def judge(table: pa.Table) -> pa.Table:
        found = list(columns(table, "iii"))
        at, back, c = (np.concatenate([f[k] for f in found]) for k in (2, 3, 4))
        log = spelling(state.value, at, back, c)
        ends = np.cumsum([len(f[2]) for f in found])
        return pa.Table.from_batches(rows((f[0], f[1], x.tobytes()) for f, x in zip(found, np.split(log, ends[:-1]), strict=True)))

    def gather(left: pa.Table, right: pa.Table) -> pa.Table:
        ((_, part, _, size, data, _),) = columns(left, "bibi")
        s = Spelt(size, data)
        log = np.empty(len(s.at))
        log[dealt(s)[0]] = np.concatenate([x for *_, x in columns(right, "d")])
        whole = np.bincount(s.word, log[s.where], len(size))
        return pa.Table.from_batches([row(None, part, whole.tobytes())])

    answers = blobs.mapInArrow(ask, BLOBS).groupBy("part").applyInArrow(judge, BLOBS)
    return blobs.groupBy("part").cogroup(answers.select(F.col("block").cast("int").alias("of"), "*").groupBy("of")).applyInArrow(gather, BLOBS)


def word_answers(index: DataFrame, vocab: DataFrame, logs: DataFrame, first: dict[int, int]) -> DataFrame:
    """By block and part, of the block's words: ``kind=0``: a: numbers in the whole vocabulary, b: counts; ``kind=1``: a: logs of
    spellings. first: by part, the first number of its words."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        have = right.column("a").to_pylist(), right.column("b").to_pylist()
        count = next(unplanes(x) for x in have[0] if x is not None)
        log = next(np.frombuffer(x, np.float64) for x in have[1] if x is not None)
        out = []
        for block, part, k in columns(left, "i"):
            out += [(block, part, planes(first[part] + k), planes(count[k])), (block, part, log[k].astype(np.float32).tobytes())]
        return pa.Table.from_batches(rows(out), SHAPE).add_column(0, "kind", pa.array([0, 1] * (len(out) // 2), pa.int32()))

    both = vocab.select("part", F.col("d").alias("a"), F.lit(None).cast("binary").alias("b")).unionByName(logs.select("part", F.lit(None).cast("binary").alias("a"), F.col("a").alias("b")))
    return index.groupBy("part").cogroup(both.groupBy("part")).applyInArrow(run, f"kind int, {BLOBS}")


class Asked:
    """A level's questions of a block: the places of contexts, their distinct contexts by part, and what follows them.
    mine: of the runs before, those that are asked about in this round (none given: all)."""

    def __init__(self, view: View, m: int, mine: np.ndarray | None = None):
        run, key, count = view.run(m - 1)
        # contexts: runs of m tokens, ended by none of the ends, that are learnt often enough
        asked = np.append(False, run[:-1] >= 0)
        if mine is not None and len(mine):
            asked[1:] &= mine[run[:-1]]
        self.on = np.flatnonzero(asked)
        context = run[self.on - 1]
        used = np.zeros(len(key), bool)
        used[context] = True
        used = np.flatnonzero(used)
        part = part_of(key[used], view.parts)
        order = np.argsort(part, kind="stable")
        used, self.part = used[order], part[order]
        rank = np.empty(len(key), np.int64)
        rank[used] = np.arange(len(used))
        self.m, self.of, self.key, self.count = m, rank[context], key[used], count[used]
        # what may be listed: its places, and their distinct pairs of a context and a token
        maybe = np.flatnonzero(view.follow[m - 1][self.on] >= MIN_COUNT)
        self.at, bits = self.on[maybe], len(view.count).bit_length()
        order, pair = sort(self.of[maybe] << bits | view.tokens[self.at])
        new = changes(pair)
        self.item = np.empty(len(order), np.int64)
        self.item[order] = np.cumsum(new) - 1
        self.one, pair = order[new], pair[new]
        self.context, self.follows = pair >> bits, pair & ((1 << bits) - 1)

    def rows(self, view: View) -> Iterator[tuple]:
        """a: contexts, b: log of the suffix's count by the context's, c: how many follow, d: their counts after the suffix, e: uses in
        training and, all after these, numbers in the vocabulary."""
        uses = np.bincount(self.item[view.learnt[self.at]], minlength=len(self.context))
        size = np.bincount(self.context, minlength=len(self.key))
        # a context's suffix: the empty one has all tokens
        suffix = np.full(len(self.key), view.whole)
        if self.m > 1:
            short, _, short_count = view.run(self.m - 2)
            suffix[self.of] = short_count[short[self.on - 1]]
        offset = np.log(np.maximum(suffix, 1) / np.maximum(self.count, 1)).astype(np.float32)
        lower = view.follow[self.m - 1][self.at[self.one]]  # counts after the suffix
        number = view.number[self.follows]
        cuts = np.append(0, np.cumsum(np.bincount(self.part, minlength=view.parts)))
        ends = np.append(0, np.cumsum(size))
        for part in np.flatnonzero(np.diff(cuts)):
            a, b = cuts[part], cuts[part + 1]
            i, j = ends[a], ends[b]
            yield (view.block, int(part), self.key[a:b].tobytes(), offset[a:b].tobytes(), planes(size[a:b]), planes(lower[i:j]), planes(np.append(uses[i:j], number[i:j])))


def answered(table: pa.Table) -> pa.Table:
    """A part's answers to all blocks, a: counts of what follows (0: not listed), b, c: by context, listed uses, and how many are
    listed (0: the context isn't retained)."""
    keep_freed()
    found = list(columns(table, "ufiii"))
    contexts, offset, size, lower = (np.concatenate([f[k] for f in found]) for k in (2, 3, 4, 5))
    uses, follows = (np.concatenate([f[6].reshape(2, -1)[k] for f in found]) for k in (0, 1))
    one, number = numbered(contexts)
    of = np.repeat(number, size)
    item_one, item = numbered(of * (int(follows.max(initial=0)) + 1) + follows)
    n = np.bincount(item, uses, len(item_one)).astype(np.int64)
    listed = n >= MIN_COUNT
    some = item_one[listed]
    gain = np.bincount(of[some], n[listed] * np.log(n[listed] / lower[some]), len(one))
    total, distinct = np.bincount(of[some], n[listed], len(one)).astype(np.int64), np.bincount(of[some], minlength=len(one))
    kept = gain + total * offset[one] >= GAIN_NATS
    total, distinct = (total * kept)[number], (distinct * kept)[number]
    n = np.where(listed, n, 0)[item]
    out, at, i = [], 0, 0
    for f in found:
        b, j = at + len(f[2]), i + len(f[5])
        out.append((f[0], f[1], planes(n[i:j]), planes(total[at:b]), planes(distinct[at:b])))
        at, i = b, j
    return pa.Table.from_batches(rows(out))


class View:
    """A block (left), and what the answers (right) of levels 0 to ``depth`` say of its tokens. whole, ends: all tokens learnt, and
    the ends among them. parts: that questions are dealt to."""

    def __init__(self, left: pa.Table, right: pa.Table, whole: int, ends: int, parts: int, depth: int):
        keep_freed()
        tokens, size, learnt = (left.column(k)[0].as_buffer() for k in "abc")
        self.block, self.whole, self.parts = left.column("block")[0].as_py(), whole, parts
        self.tokens, self.size, self.held = unplanes(tokens), unplanes(size), unplanes(learnt) == 0
        self.learnt = np.repeat(~self.held, self.size)
        levels = right.column("level").to_numpy()
        none = np.zeros(0, np.int64)
        self.given = lambda m, kinds: [np.concatenate([none, *x]) for x in list(zip(*[c[2:] for c in columns(right.filter(pa.array(levels == m)), kinds)], strict=True)) or [[]] * len(kinds)]
        number, count = self.given(0, "ii")
        self.number, self.count = np.append(0, number + 1), np.append(ends, count)
        self.runs, self.follow, self.asked, self.used = [], [self.count[self.tokens]], [], []
        for m in range(1, depth + 1):
            asked = Asked(self, m)
            self.asked.append(asked)
            self.used.append(self.given(m, "iii"))
            self.follow.append(np.zeros(len(self.tokens), np.int64))
            self.follow[m][asked.at] = self.used[-1][0][asked.item]

    def run(self, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of a level: the run that ends at each place (-1: not learnt often enough, or ended by an end), hashes and counts of the runs."""
        if m < len(self.runs):
            return self.runs[m]
        if m == 0:
            often = self.count >= MIN_COUNT
            often[0] = False
            self.runs.append((np.where(often, np.arange(len(often)), -1)[self.tokens], mix64(self.number.astype(np.uint64)), self.count))
        else:
            asked, n, run = self.asked[m - 1], self.used[m - 1][0], np.full(len(self.tokens), -1)
            often = (n >= MIN_COUNT) & (asked.follows > 0)
            run[asked.at] = np.where(often, np.arange(len(n)), -1)[asked.item]
            self.runs.append((run, joined_keys(asked.key[asked.context], self.number[asked.follows].astype(np.uint64)), n))
        return self.runs[m]

    def score(self, vocab: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """By document: tokens learnt, log10 of the base and of the tree. Level -1 of the answers: logs of the words' spellings."""
        whole, begin = self.whole, np.cumsum(self.size) - self.size  # a document has an end at least
        spare = DISCOUNT * vocab / whole if whole else 1.0
        spelt = np.append(-np.inf, self.given(-1, "f")[0])
        p = np.maximum(self.count - DISCOUNT, 0) / max(whole, 1) + spare * np.exp(spelt)
        # of long spellings the logs are added afterwards; they weren't learnt, so no context lists them
        small = p <= 1e-250
        own = np.where(small, np.maximum(np.log(spare) + spelt, -1e6), 0)  # nothing learnt: an end has no probability
        chance = np.where(small, 1, p)[self.tokens]
        for m, (asked, (_, total, distinct)) in enumerate(zip(self.asked, self.used, strict=True), 1):
            rest = 1 - (total - DISCOUNT * distinct) / asked.count  # 1 of a context that isn't retained
            seen = np.maximum(self.follow[m][asked.on] - DISCOUNT, 0) * ((distinct > 0) / asked.count)[asked.of]
            chance[asked.on] = seen + rest[asked.of] * chance[asked.on]
        log = np.log(chance)
        if small.any():
            log += own[self.tokens]
        base = np.log10((self.count + 1) / (whole + vocab + 1))[self.tokens]
        known = (self.count > 0).astype(np.int64)[self.tokens]
        return np.add.reduceat(known, begin), np.add.reduceat(base, begin), np.add.reduceat(log, begin) / np.log(10)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokens: int = TOKENS) -> DataFrame:
    """``_id``, held_out, n_tokens, n_known, train_tokens, base_score, score of every whole text.

    base_score: add-one unigrams of tokens, log10. score: log10 probability of the tokens by the model, contexts of up to
    ``tokens`` tokens. Null and wordless texts are an end only. Nothing learnt (no training rows): the base is that of no
    counts, words have an even spelling, and an end scores -1e6 nats. Rows, repeated ones too, are kept; a text longer than a block is a
    block of its own. Other columns aren't looked at."""
    spark = docs.sparkSession
    source = bounded(docs).select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), training(F.col(id_col)).alias("_train"))
    kind = source.schema["_id"].dataType.simpleString()
    rest = "held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    size, ends = source.agg(F.sum(F.coalesce(F.octet_length("_text"), F.lit(0)) + 1), F.count_if("_train")).first()
    if not size:
        return spark.createDataFrame([], f"_id {kind}, {rest}")
    parts = max(-(-size // PART_BYTES), 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    path, vocab_path, logs_path, answer_path, result = (shared_path(spark, x) for x in ("blocks", "words", "spelt", "answers", "scores"))
    blocks_of(source, path, parts)
    vocab, whole, distinct = None, ends, int(ends > 0)
    if exists(spark, f"{path}/kind=1"):
        vocabulary(spark.read.parquet(f"{path}/kind=1"), vocab_path)
        remove_path(spark, f"{path}/kind=1")
        vocab = spark.read.parquet(f"{vocab_path}/kind=0")
        first, at, width = {}, 0, 0
        for r in vocab.select("part", "n", "x", "y", "z").orderBy("part").collect():  # a row for each part
            first[r["part"]], at, whole, distinct, width = at, at + r["n"], whole + r["x"], distinct + r["y"], width + r["z"]
        save(spelt(vocab, max(16, width // SPELT_BYTES)), logs_path)
        save(word_answers(spark.read.parquet(f"{vocab_path}/kind=1").select(*SHAPE.names), vocab, spark.read.parquet(logs_path), first), vocab_path + "-answers")
        move(spark, f"{vocab_path}-answers/kind=0", f"{answer_path}/level=0")
        for p in (vocab_path, logs_path):
            remove_path(spark, p)

    blocks = spark.read.parquet(f"{path}/kind=0")
    answers = lambda: spark.read.schema(f"{BLOBS}, level int").parquet(answer_path) if vocab else spark.createDataFrame([], f"{BLOBS}, level int")
    for m in range(1, tokens + 1 if vocab else 1):
        next_path = shared_path(spark, "next-answers")
        for turn in range(rounds := min(m, ROUNDS)):
            asked = blocks.groupBy("block").cogroup(answers().groupBy("block")).applyInArrow(asker(whole, ends, parts, m, turn, rounds), BLOBS)
            save(asked.groupBy("part").applyInArrow(answered, BLOBS), next_path, "append")
        move(spark, next_path, f"{answer_path}/level={m}")
    if vocab:
        move(spark, f"{vocab_path}-answers/kind=1", f"{answer_path}/level=-1")

    def judge(left: pa.Table, right: pa.Table) -> pa.Table:
        view = View(left, right, whole, ends, parts, tokens if right.num_rows else 0)
        known, base, own = view.score(distinct)
        ids = left.column("ids").combine_chunks().flatten()
        return pa.table({"_id": ids, "held_out": view.held, "n_tokens": view.size, "n_known": known, "train_tokens": np.full(len(known), whole), "base_score": base, "score": own})

    with freeing(spark):
        blocks.groupBy("block").cogroup(answers().groupBy("block")).applyInArrow(judge, f"_id {kind}, {rest}").write.parquet(result)
    for p in (path, answer_path, f"{vocab_path}-answers"):
        remove_path(spark, p)
    return spark.read.parquet(result)


def asker(whole: int, ends: int, parts: int, m: int, turn: int, rounds: int):
    """A block's questions of level m, in a round those of each ``rounds``th part."""

    def ask(left: pa.Table, right: pa.Table) -> pa.Table:
        view = View(left, right, whole, ends, parts, m - 1)
        mine = part_of(view.run(m - 1)[1], parts) % rounds == turn if rounds > 1 else None
        return pa.Table.from_batches(rows(Asked(view, m, mine).rows(view)), SHAPE)

    return ask
