"""The suffix tree against brute force: unigram base, spellings, longest suffix states, probabilities that add up."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.cases import empty, frame, rows
from topicloom.llm import queries, suffix_tree

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
COLUMNS = ["held_out", "n_tokens", "n_known", "train_tokens", "base_score"]


def in_fold(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


def tokens_of(text):
    return (*SPACE.findall((text or "").translate(LOWER)), None)


def expected_base(docs):
    tokens, held = [tokens_of(t) for _, t in docs], [in_fold(d) for d, _ in docs]
    count = Counter(w for ws, h in zip(tokens, held, strict=True) if not h for w in ws)
    n, v = sum(count.values()), len(count)
    return [(d, h, len(ws), sum(count[w] > 0 for w in ws), n, round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws), 6)) for (d, _), h, ws in zip(docs, held, tokens, strict=True)]


class Plain:
    """The model, straight from its definition, in dictionaries."""

    def __init__(self, texts, depth=suffix_tree.TOKENS):
        self.depth, runs = depth, [tokens_of(t) for t in texts]
        self.n = Counter(r[i:j] for r in runs for i in range(len(r)) for j in range(i + 1, min(i + depth + 1, len(r)) + 1))
        self.whole, self.words = sum(map(len, runs)), {k[0] for k in self.n if len(k) == 1}
        self.follow: dict = {}
        for k, n in self.n.items():
            if len(k) > 1 and n >= suffix_tree.MIN_COUNT:
                self.follow.setdefault(k[:-1], {})[k[-1]] = n
        of = lambda s: self.n[s] if s else self.whole
        gain = lambda s: sum(n * math.log(n / of(s) * of(s[1:]) / self.n[(*s[1:], x)]) for x, n in self.follow[s].items())
        self.kept = {s for s in self.follow if gain(s) >= suffix_tree.GAIN_NATS}
        self.spell = Spelling([w for w in self.words if w is not None])

    def p(self, history, x):
        for d in range(min(self.depth, len(history)), 0, -1):
            s = history[-d:]
            if s in self.kept:
                seen, n = self.follow[s], self.n[s]
                return max(seen.get(x, 0) - 0.75, 0) / n + (1 - sum(c - 0.75 for c in seen.values()) / n) * self.p(s[1:], x)
        spare = 0.75 * len(self.words) / self.whole
        return max(self.n[x,] - 0.75, 0) / self.whole + spare * (0 if x is None else self.spell.p(x.encode()))

    def score(self, text):
        t = tokens_of(text)
        return sum(math.log10(self.p(t[max(0, k - self.depth) : k], x)) for k, x in enumerate(t))


class Spelling:
    def __init__(self, words):
        self.n: dict = {}
        for w in words:
            run = b" " + w.encode() + b"\n"
            for i in range(1, len(run)):
                for d in range(min(i, suffix_tree.DEPTH) + 1):
                    at = self.n.setdefault(run[i - d : i], Counter())
                    at[run[i]] += 1
        total = {s: sum(c.values()) for s, c in self.n.items()}
        gain = lambda s: sum(n * math.log(n / total[s] * total[s[1:]] / self.n[s[1:]][b]) for b, n in self.n[s].items())
        good = {s for s in self.n if len(s) > suffix_tree.TOP and total[s] >= 2 and gain(s) >= suffix_tree.GAIN_NATS}
        self.kept = {s[k:] for s in good for k in range(len(s))} | {s for s in self.n if len(s) <= suffix_tree.TOP}
        self.total = total

    def step(self, history, b):
        for d in range(min(suffix_tree.DEPTH, len(history)), 0, -1):
            s = history[-d:]
            if s in self.kept:
                seen = self.n[s]
                return max(seen[b] - 0.75, 0) / self.total[s] + 0.75 * len(seen) / self.total[s] * self.step(s[1:], b)
        root, allowed = self.n.get(b"", Counter()), len(suffix_tree.ALPHABET)
        return (root[b] + 1) / (sum(root.values()) + allowed)

    def p(self, word):
        run = b" " + word + b"\n"
        return math.prod(self.step(run[:i], run[i]) for i in range(1, len(run)))


def test_base_all_documents(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = queries.op9_suffix_tree(spark, sf_dir).collect()
    assert sorted((r["doc_id"], *[r[c] for c in COLUMNS[:-1]], round(r["base_score"], 6)) for r in found) == sorted(expected_base(docs))
    assert all(r["score"] < 0 for r in found)
    model = Plain([t for d, t in docs if not in_fold(d)])
    text = dict(docs)
    for r in found:
        assert math.isclose(r["score"], model.score(text[r["doc_id"]]), rel_tol=1e-6)


def test_awkward(spark, monkeypatch):
    want = expected_base([r[:2] for r in rows()])
    model = Plain([t for d, t, *_ in rows() if not in_fold(d)])
    scores = sorted(round(model.score(t), 6) for _, t, *_ in rows())
    for block in (suffix_tree.BLOCK_BYTES, 5000):
        monkeypatch.setattr(suffix_tree, "BLOCK_BYTES", block)
        found = suffix_tree.score(frame(spark)).collect()
        assert sorted(repr((r["_id"], *[r[c] for c in COLUMNS[:-1]], round(r["base_score"], 6))) for r in found) == sorted(map(repr, want))
        assert np.allclose(sorted(r["score"] for r in found), scores)
    assert suffix_tree.score(empty(spark)).count() == 0
    for only in (10, 12):  # in the held-out fold or not, a lone document is scored
        alone = suffix_tree.score(frame(spark).where(f"doc_id = {only}")).collect()
        assert len(alone) == 1 and math.isfinite(alone[0]["score"])


def test_long_words_and_texts(spark):
    texts = [(1, "x" * 3000 + " y"), (2, "ab " * 400_000), (3, "x" * 3000), (4, "q" * 2000 + " é")]
    found = {r["_id"]: r["score"] for r in suffix_tree.score(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    model = Plain([t for d, t in texts if not in_fold(d)])
    spelt = [k for k, t in texts if in_fold(k)]
    assert all(math.isfinite(x) for x in found.values()) and math.isclose(found[2], model.score(texts[1][1]), rel_tol=1e-6), spelt


@pytest.fixture(scope="module")
def small():
    texts = ["a b c a b d", "b a c c a b c", "a b c", "d d b b a c"] * 6
    return texts, Plain(texts)


def scores(spark, texts, asked):
    given = [*zip((i for i in range(100_000) if not in_fold(i)), texts, strict=False)]
    asked = [*zip((i for i in range(100_000) if in_fold(i)), asked, strict=False)]
    got = {r["_id"]: r["score"] for r in suffix_tree.score(spark.createDataFrame([*given, *asked], "doc_id long, text string")).collect()}
    return [got[i] for i, _ in asked]


def test_next_tokens_by_brute_force(spark, small):
    texts, model = small
    asked = ["a b c", "a b d", "a b unseen", "c c unseen d", "unseen a", "d", "", "dog a cat"]
    assert any(len(s) == 2 for s in model.kept)
    assert np.allclose(scores(spark, texts, asked), [model.score(t) for t in asked])


def test_probabilities_add_up(spark, small):
    texts, model = small
    # of a token after a history: the end, words learnt, and all other words by their spelling
    letters = [bytes([b]) for b in suffix_tree.ALPHABET if b != suffix_tree.STOP]
    prefix = lambda s: math.prod(model.spell.step((b" " + s)[:i], (b" " + s)[i]) for i in range(1, len(s) + 1))
    for history in (b"", b"a", b"ab"):  # a spelling goes on or stops
        assert math.isclose(model.spell.p(history) + sum(prefix(history + x) for x in letters), prefix(history))
    for s in ((), ("a",), ("a", "b"), ("zz",)):
        spare = model.p(s, "unseen") / model.spell.p(b"unseen")
        known = sum(model.p(s, x) - (spare * model.spell.p(x.encode()) if x else 0) for x in model.words)
        assert math.isclose(known + spare, 1)
    # the same by scores of texts: what a word's unseen spelling has goes by its letters
    one, two = scores(spark, texts, ["a b unseen", "a b unsean"])
    assert math.isclose(one - two, math.log10(model.spell.p(b"unseen") / model.spell.p(b"unsean")), rel_tol=1e-4) and one != two


def test_the_tree_is_the_model(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    fold = lambda df: sum(r["score"] for r in df.where("held_out").collect())
    tree = fold(suffix_tree.score(docs))
    assert tree > fold(suffix_tree.score(docs, tokens=0)) + 500  # contexts of tokens
    flat = Plain([r["text"] for r in docs.collect() if not in_fold(r["doc_id"])])
    flat.spell.step = lambda history, b: 1 / len(suffix_tree.ALPHABET)
    assert tree > sum(flat.score(r["text"]) for r in docs.collect() if in_fold(r["doc_id"])) + 1000  # spellings, against even bytes


def test_order_and_rare_contexts_count(spark):
    rng = np.random.default_rng(5)
    words = [f"w{k}" for k in range(3000)]
    passage = "one odd passage of words stands here but twice in all the texts".split()
    texts = [" ".join(rng.choice(words, 300)) for _ in range(300)]
    for i in range(2):
        texts[i] += " " + " ".join(passage)
    forward, back = scores(spark, texts, [" ".join(passage), " ".join(reversed(passage))])
    assert forward > back + 10  # the same words in another order; their contexts occur twice


def test_contexts_grow_with_the_corpus(spark):
    def retained(copies):
        model = Plain([f"x{k} y{k} z{k}" for k in range(copies) for _ in range(2)])
        return model, len(model.kept)

    model, many = retained(200)
    assert many == 2 * retained(100)[1] > 200  # two uses are enough at any size
    texts = [f"x{k} y{k} z{k}" for k in range(200) for _ in range(2)]
    assert np.allclose(scores(spark, texts, ["x7 y7 z7", "x7 z7 y7"]), [model.score("x7 y7 z7"), model.score("x7 z7 y7")])


def test_words_and_their_hashes():
    texts = [b"", b" The\tcat ", b"x" * 5000 + b" y\x0bz \xc3\x89a", b"\n\n", b"sat", b"12345678 123456789 1234567 12345678 " + b"x" * 5000]
    data, start, size, n = suffix_tree.words_of(texts)
    found = [data[a : a + b] for a, b in zip(start, size, strict=True)]
    assert found == [w for t in texts for w in t.lower().split()] and n.tolist() == [len(t.split()) for t in texts]
    keys = suffix_tree.word_keys(data, start, size).tolist()
    assert len({*zip(found, keys, strict=True)}) == len(set(found)) == len(set(keys))


def test_places_in_order_of_keys():
    rng = np.random.default_rng(3)
    wide = rng.integers(0, 1 << 64, 5000, np.uint64, endpoint=False)
    cases = [np.zeros(0, np.int64), np.array([7]), rng.integers(0, 50, 5000), rng.integers(-9, 9, 5000), rng.integers(0, 1 << 62, 5000), wide, wide >> np.uint64(2), rng.choice(wide, 5000)]
    cases += [(rng.integers(0, 3, 5000) << 60) + rng.integers(0, 90, 5000), wide // np.uint64(4000) * np.uint64(4000) + np.arange(5000, dtype=np.uint64) % np.uint64(7)]  # alike in the upper bits
    for key in cases:
        order, ordered = suffix_tree.sort(key)
        assert np.array_equal(order, np.argsort(key, kind="stable")) and np.array_equal(ordered, np.sort(key)) and ordered.dtype == key.dtype
        one, number = suffix_tree.numbered(key)
        distinct, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        assert np.array_equal(one, first) and np.array_equal(number, inverse) and np.array_equal(key[one], distinct)


def test_questions_to_many_parts_are_few_batches():
    # a batch for each part costs several times what its numbers do, and parts grow with the corpus
    tokens = np.append(np.random.default_rng(4).integers(1, 2001, 50_000), 0)
    block = lambda *blobs: suffix_tree.row(0, 0, *map(suffix_tree.planes, blobs))
    left = pa.Table.from_batches([block(tokens, np.array([len(tokens)]), np.array([1]))])
    right = pa.Table.from_batches([block(np.arange(2000), np.bincount(tokens)[1:])]).append_column("level", pa.array([0], pa.int32()))
    found = suffix_tree.asker(len(tokens), 1, 500, 1, 0, 1)(left, right)
    assert found.num_rows > 450 and len(found.to_batches()) == 1
    answers = suffix_tree.answered(pa.concat_tables([found.slice(k, 1).set_column(1, "part", pa.array([0], pa.int32())).set_column(0, "block", pa.array([k])) for k in range(400)]))
    assert answers.num_rows == 400 and len(answers.to_batches()) == 1


def test_a_batch_just_over_a_block_is_one():
    batch = pa.RecordBatch.from_pydict({"_text": ["x" * 100] * 41})
    assert [b.num_rows for b in suffix_tree.slices([batch], "_text", 4000, even=True)] == [41]
    assert [b.num_rows for b in suffix_tree.slices([batch], "_text", 1300, even=True)] == [13, 14, 14]
    assert [b.num_rows for b in suffix_tree.slices([batch], "_text", 50, even=True)] == [1] * 41
    nothing = pa.RecordBatch.from_pydict({"_text": pa.array([None, ""], pa.string())})
    assert [b.num_rows for b in suffix_tree.slices([nothing], "_text", 4000, even=True)] == [2]


def test_long_spellings_after_contexts(spark, small):
    # what is less than the least double is added as a logarithm: each further letter of a run costs about the same
    texts, model = small
    short, longer, longest = scores(spark, texts, ["a b " + "q" * n for n in (60, 400, 740)])
    assert math.isclose(short, model.score("a b " + "q" * 60), rel_tol=1e-6)
    assert math.isclose(longest - longer, longer - short, rel_tol=1e-6) and short - longer > 340
