"""Mixing, records, decontamination, SimHash and language ID against brute force."""

import hashlib
import pickle
import re
import time
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.cases import empty, frame, rows
from topicloom.llm import decontaminate, language, mixing, queries, records, simhash
from topicloom.llm.common import alnum_words, shared_path

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACE = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@given(st.text())
def test_words_on_bytes(text):
    assert [w.decode() for w in alnum_words(text.encode())] == ALNUM.findall(text.translate(LOWER))
    assert [w.decode() for w in text.encode().split()] == SPACE.findall(text)


# mixing


def test_mix_keeps_every_row_and_meets_budgets(spark, sf_dir):
    docs = documents(spark, sf_dir)
    shares = mixing.plan(mixing.slim_rows(docs, "doc_id", "text", "source"), repetition=1.1).collect()
    mixed = mixing.mixed_order(docs, repetition=1.1).collect()
    assert {r["doc_id"] for r in mixed} == {r["doc_id"] for r in docs.collect()}
    read = Counter()
    for r in mixed:
        read[r["source"]] += r["n_tokens"]
    assert abs(sum(s["weight"] for s in shares) - 1) < 1e-9
    for s in shares:
        assert s["budget"] <= read[s["source"]] < s["budget"] + max(r["n_tokens"] for r in mixed)
    assert 1.1 - 1e-3 < max(s["budget"] / s["n_tokens"] for s in shares) <= 1.1 + 1e-3 and min(s["budget"] / s["n_tokens"] for s in shares) > 1 - 1e-3
    twice = 2 * sum(s["n_tokens"] for s in shares)
    bounded = mixing.plan(mixing.slim_rows(docs, "doc_id", "text", "source"), repetition=2.1, budget=twice).collect()
    assert max(s["budget"] / s["n_tokens"] for s in bounded) <= 2.1 + 1e-3 and abs(sum(s["budget"] for s in bounded) - twice) <= len(bounded)
    whole = mixing.mix(docs, repetition=1.1)
    assert sorted((r["doc_id"], r["epoch"]) for r in whole.collect()) == sorted((r["doc_id"], r["epoch"]) for r in mixed)
    for r in mixed:
        assert r["key"] == hashlib.md5(f"mix|{r['epoch']}|{r['doc_id']}".encode()).hexdigest()


def test_mix_entropy_target(spark, sf_dir):
    totals = mixing.source_tokens(documents(spark, sf_dir), "source", mixing.word_count(F.col("text")))
    value = mixing.statistic(totals)
    share = (value(1.0)[0] / value(0.0)[0] + 1) / 2
    alpha = mixing.exponent(totals, entropy_share=share)
    assert 0 < alpha < 1 and abs(value(alpha)[0] - share * value(0.0)[0]) < 1e-4
    limit, mixing.DRIVER_SOURCES = mixing.DRIVER_SOURCES, 1
    try:  # the same by Spark aggregates
        assert abs(mixing.statistic(totals)(0.3)[0] - value(0.3)[0]) < 1e-9
        assert abs(mixing.statistic(totals)(0.3)[1] - value(0.3)[1]) < 1e-9
    finally:
        mixing.DRIVER_SOURCES = limit
    with pytest.raises(ValueError):
        mixing.exponent(totals)


def test_mix_awkward(spark):
    out = mixing.mix(frame(spark)).collect()
    assert Counter(r["doc_id"] for r in out if r["epoch"] == 0) == Counter(r[0] for r in rows())
    assert mixing.mix(empty(spark)).count() == 0 and mixing.mixed_order(empty(spark)).count() == 0
    placed = mixing.mixed_order(frame(spark)).collect()
    assert len(placed) == len(out)
    ends: dict = {}
    for r in sorted(placed, key=lambda r: (str(r["source"]), r["epoch"], r["key"], r["n_tokens"], r["before"])):  # repeated rows follow one another
        if (r["source"], r["epoch"]) in ends:
            assert r["before"] == ends[r["source"], r["epoch"]]
        ends[r["source"], r["epoch"]] = r["before"] + r["n_tokens"]


# records


def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    t.encode_special_tokens = True
    return t


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(), max_size=4))
def test_chunks_encode_like_whole_texts(texts):
    same_ids(texts)


PIECES = ["The", " ", ",", ".", "it's", "'S", "I\u0307", "e\u0301", "É", "\u0958", "K", "Σ", "ς", "x", "...", ".,", "a.b,c", "\u00a0", "\u0301", "12", "3rd", "<|endoftext|>", "’s", "ﬁ", "日本", "\x00", "\x85"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=12).map("".join), max_size=4))
def test_awkward_chunks_encode_like_whole_texts(texts):
    same_ids(texts)


def same_ids(texts):
    encode = records.encoder(records.tokenizer_path())
    got = [np.frombuffer(x, "<u2").tolist() for x in encode([t.encode() for t in texts])]
    assert got == [e.ids for e in tokenizer().encode_batch(texts, add_special_tokens=False)]


def expected_records(docs):
    t, start, out = tokenizer(), 0, []
    for doc, text in docs:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_records_round_trip(spark, sf_dir):
    got = queries.op2_token_records(spark, sf_dir).orderBy("doc_id").collect()
    docs = [(r["doc_id"], r["text"]) for r in documents(spark, sf_dir).orderBy("doc_id").collect()]
    assert [tuple(r) for r in got] == expected_records(docs)


def test_records_awkward_and_fetch(spark):
    path = shared_path(spark, "records-test")
    index = records.export(frame(spark), path, file_bytes=20_000)
    assert index.select("file").distinct().count() > 1
    order = sorted(((r[0], r[1]) for r in rows()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    assert [tuple(r) for r in index.orderBy("start").select("doc_id", "start", "n_tokens", "ids_crc32").collect()] == expected_records(order)
    some = records.fetch(spark, path, index.where("doc_id in (7, 3)")).collect()
    assert {r["doc_id"]: r["ids"] for r in some} == {i: [*tokenizer().encode(rows()[i][1], add_special_tokens=False).ids, 1] for i in (3, 7)}
    assert records.encoded(empty(spark)).count() == 0


def test_damage_is_found():
    good = records.frame(records.pack(5, b"\1\0\2\0", 2)) + records.frame(records.pack(None, b"", 2))
    payload, at = records.unframe(good, 0)
    assert records.unpack(payload)[0] == 5 and records.unpack(records.unframe(good, at)[0])[0] is None
    for k in range(at):
        with pytest.raises(ValueError):
            records.unframe(good[:k] + bytes([good[k] ^ 1]) + good[k + 1 :], 0)
    with pytest.raises(ValueError):
        records.unframe(good[: at - 3], 0)


# decontamination


def expected_hits(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        words = ALNUM.findall((text or "").translate(LOWER))
        n = min(13, len(words))
        for i in range(len(words) - n + 1 if words else 0):
            windows[tuple(words[i : i + n])].add("" if item is None else str(item))
    sizes, out = {len(w) for w in windows}, []
    for doc, text in docs:
        words = ALNUM.findall((text or "").translate(LOWER))
        hit, names = set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                if (w := tuple(words[i : i + n])) in windows:
                    hit |= set(range(i, i + n))
                    names |= windows[w]
        out.append((doc, len(words), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(words)))
    return out


COLUMNS = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def test_decontaminate_all_documents(spark, sf_dir):
    got = queries.op6_decontaminate(spark, sf_dir).select("doc_id", *COLUMNS).collect()
    docs = [tuple(r) for r in documents(spark, sf_dir).select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    want = expected_hits(docs, items)
    assert sorted(map(tuple, got)) == sorted(want)
    assert any(r[-1] for r in want) and not all(r[-1] for r in want)


ITEMS = [(1, "alpha beta"), (2, None), (3, "..."), (None, "gamma alpha"), (5, "the " * 40), (5, "x1"), (7, rows()[9][1]), (8, rows()[9][1]), (9, rows()[7][1][:900])]


@pytest.mark.parametrize("block_bytes", [decontaminate.BLOCK_BYTES, 300])
def test_decontaminate_awkward(spark, block_bytes):
    bench = spark.createDataFrame([(*i, 1.0) for i in ITEMS], "item_id long, text string, score double")
    found = decontaminate.judged(decontaminate.matches(frame(spark), bench, block_bytes=block_bytes))
    got = [tuple(r) for r in found.select("_id", *COLUMNS).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, expected_hits([r[:2] for r in rows()], ITEMS)))
    exact = found.where("_id = 9").first()
    assert exact["longest"] == exact["n_words"] and exact["longest_at"] == 0 and exact["longest_item"] == "7"
    left = decontaminate.remove_contaminated(frame(spark), bench, block_bytes=block_bytes)
    assert left.columns == frame(spark).columns and left.count() == sum(not r[-1] for r in expected_hits([r[:2] for r in rows()], ITEMS))


def test_decontaminate_empty(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.matches(empty(spark), none).count() == 0
    found = decontaminate.judged(decontaminate.matches(frame(spark), none)).collect()
    assert len(found) == len(rows()) and not any(r["contaminated"] for r in found)


def test_decontaminate_repeated_items(spark):
    """Thousands of equal items, and items that share a long preamble, are searched for together; longest matches by brute force."""
    rng = np.random.default_rng(8)
    word = lambda: f"w{rng.integers(0, 40)}"
    head = [word() for _ in range(40)]
    items = [(k, " ".join(head)) for k in range(3000)] + [(4000 + k, " ".join([*head, *[word() for _ in range(30)]])) for k in range(300)]
    texts = [" ".join([word(), *items[3000 + k][1].split()[: 20 + k % 50], word()]) for k in range(40)] + [" ".join(head * 3)]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    found = decontaminate.judged(decontaminate.matches(docs, spark.createDataFrame(items, "item_id long, text string"))).collect()
    assert sorted(tuple(r[c] for c in ("_id", *COLUMNS)) for r in found) == sorted(expected_hits([*enumerate(texts)], items))
    grams = {tuple(w[i:]) for w in {tuple(t.split()) for _, t in items} for i in range(len(w) - 12)}
    same = lambda a, b: next((n for n in range(min(len(a), len(b))) if a[n] != b[n]), min(len(a), len(b)))
    for r in found[:12]:
        w = tuple(texts[r["_id"]].split())
        assert r["longest"] == max(same(w[i:], g) for i in range(len(w)) for g in grams) and r["longest_item"] is not None


def test_decontaminate_real_blocks(spark):
    """Five blocks of half a megabyte each; the driver holds little for one."""
    rng = np.random.default_rng(3)
    vocab = np.array([f"v{k}" for k in range(20_000)])
    items = [(k, " ".join(vocab[rng.integers(0, len(vocab), 100)])) for k in range(3400)]
    texts = [" ".join([*vocab[rng.integers(0, len(vocab), 30)], *items[int(k)][1].split()[: 10 + n % 60], *vocab[rng.integers(0, len(vocab), 30)]]) for n, k in enumerate(rng.integers(0, 3400, 80))]
    bench, docs = spark.createDataFrame(items, "item_id long, text string").repartition(4), spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    assert decontaminate.block_count(bench, "text", 1 << 19) == 5
    want = sorted(expected_hits([*enumerate(texts)], items))
    for block_bytes in (1 << 19, decontaminate.BLOCK_BYTES):
        found = decontaminate.judged(decontaminate.matches(docs, bench, block_bytes=block_bytes)).collect()
        assert sorted(tuple(r[c] for c in ("_id", *COLUMNS)) for r in found) == want
    tracemalloc.start()
    queries_ = decontaminate.Queries((str(k), t.encode()) for k, t in items)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 * sum(len(t) for _, t in items) and len(pickle.dumps(queries_)) < 5 * sum(len(t) for _, t in items)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(-1, 2), min_size=1, max_size=60), st.integers(1, 8))
def test_suffix_array(flat, depth):
    flat = np.array([*flat, -1])
    start = np.flatnonzero(flat >= 0)
    got = decontaminate.suffix_array(flat, start, depth)
    key = lambda p: [w for w in flat[p : p + depth].tolist()][: (flat[p : p + depth].tolist() + [-1]).index(-1)]
    assert sorted(got) == start.tolist() and [key(p) for p in got] == sorted(map(key, start))


# SimHash


def expected_prints(docs, size=4):
    out = []
    for text in docs:
        words = SPACE.findall((text or "").translate(LOWER))
        grams = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
        hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        out.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    return out


def expected_components(ids, prints, radius=4):
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                parent[find(i)] = find(j)
    least = defaultdict(list)
    for i in range(len(ids)):
        least[find(i)].append(ids[i])
    return [min((x for x in least[find(i)] if x is not None), default=None) for i in range(len(ids))]


def test_simhash_all_documents(spark, sf_dir):
    docs = [tuple(r) for r in documents(spark, sf_dir).select("doc_id", "text").collect()]
    prints = expected_prints([t for _, t in docs])
    want = sorted(zip([d for d, _ in docs], [f"{p:016x}" for p in prints], expected_components([d for d, _ in docs], prints), strict=True))
    assert sorted(map(tuple, queries.op8_simhash(spark, sf_dir).collect())) == want
    assert any(w[0] != w[2] for w in want)


def test_simhash_awkward(spark):
    docs = rows()
    prints = expected_prints([r[1] for r in docs])
    want = zip([r[0] for r in docs], expected_components([r[0] for r in docs], prints), strict=True)
    found = simhash.near_duplicates(frame(spark))
    assert sorted(map(repr, ((r["doc_id"], r["component_id"]) for r in found.collect()))) == sorted(map(repr, want))
    kept = simhash.drop_near_duplicates(frame(spark))
    near = simhash.near_duplicates(frame(spark), size=simhash.NEAR_SIZE, radius=simhash.NEAR_RADIUS, bands=simhash.NEAR_BANDS)
    assert kept.columns == frame(spark).columns and kept.count() == near.select("_root").distinct().count()
    assert simhash.near_duplicates(empty(spark)).count() == 0 and simhash.drop_near_duplicates(empty(spark)).count() == 0


def test_near_copies_are_caught(spark):
    """Texts that share 80 % of their five-word shingles with another one: one of each such group stays, and others are left alone."""
    docs = [(r["doc_id"], r["text"]) for r in documents(spark, "/root/testdata/sf0.1").where("doc_id < 1500 and length(text) > 600").collect()]
    rng, made, at = np.random.default_rng(4), [], 10**6
    for doc, text in docs[::5]:
        words = text.split()
        for k in rng.choice(len(words), max(1, len(words) // 60), replace=False):
            words[k] = "changed"
        grams = lambda ws: {tuple(ws[i : i + 5]) for i in range(len(ws) - 4)}
        a, b = grams(text.lower().split()), grams([w.lower() for w in words])
        if len(a & b) >= 0.8 * len(a | b):
            made.append((at, " ".join(words)))
            at += 1
    assert len(made) > 100
    before = {r["doc_id"] for r in simhash.drop_near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    kept = {r["doc_id"] for r in simhash.drop_near_duplicates(spark.createDataFrame(docs + made, "doc_id long, text string")).collect()}
    assert sum(k in kept for k, _ in made) <= 0.1 * len(made) and before <= kept
    exact = {t for _, t in docs}
    assert len(before) >= 0.9 * len(exact)


@pytest.mark.parametrize("tile", [simhash.TILE, 40])
@pytest.mark.parametrize("many", [1, 10**9])
def test_links_are_whole(spark, monkeypatch, tile, many):
    monkeypatch.setattr(simhash, "TILE", tile)
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 60, dtype=np.uint64)
    near = base[rng.integers(0, 60, 400)]
    for _ in range(6):
        near = near ^ (np.uint64(1) << rng.integers(0, 64, 400).astype(np.uint64))
    prints = np.unique(np.concatenate([base, near, base[0] ^ (np.uint64(1) << np.arange(64, dtype=np.uint64))]))
    edges = simhash.links(simhash.in_tables(spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "_fp long"), simhash.block_tables(many, 4)), 4)
    roots = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    signed = prints.view(np.int64).tolist()
    got = [roots.get(x, x) for x in signed]
    want = expected_components(signed, [int(p) for p in prints])
    assert got == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=150), st.integers(0, 15))
def test_near_pairs(prints, radius):
    prints = [*prints, *[p ^ 5 for p in prints[:20]]]
    fp = np.array(prints, np.uint64)
    group = np.sort(np.array([p % 3 for p in range(len(fp))]))
    got = sorted((int(i), int(j)) for a, b in simhash.near_pairs(fp, group, radius) for i, j in zip(a, b, strict=True))
    want = [(i, j) for i in range(len(fp)) for j in range(i + 1, len(fp)) if group[i] == group[j] and (prints[i] ^ prints[j]).bit_count() <= radius]
    assert got == want


def test_block_tables_cover():
    for many in (10, 10**8, 10**10, 10**13):
        for table in simhash.block_tables(many, 4):
            assert all(0 <= a < b <= 64 for a, b in table)


# language ID


def test_language_held_out_accuracy(spark, sf_dir):
    truth = {r["doc_id"]: (r["lang"], r["text"]) for r in documents(spark, sf_dir).collect()}
    got = queries.op10_language(spark, sf_dir).collect()
    assert {r["doc_id"] for r in got} == set(truth)
    fold = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in fold} == {d for d in truth if zlib.crc32(str(d).encode()) % 4 == 2}
    assert sum(r["lang_pred"] == truth[r["doc_id"]][0] for r in fold) >= 0.95 * len(fold)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_awkward(spark):
    found = language.identify(frame(spark)).collect()
    assert len(found) == len(rows())
    for r in found:
        assert (r["lang_pred"] == "und") == (not any(map(str.isalpha, r["text"] or "")))
    assert language.identify(empty(spark)).count() == 0
    model = language.fit(empty(spark))
    assert {r["lang_pred"] for r in language.predict(frame(spark), model).collect()} == {"und"}


def test_forward_sums_all_segmentations():
    vocab = language.pieces(language.vocabulary_path())
    rng = np.random.default_rng(1)
    prob = rng.random((len(vocab.names) + 1, 2)) / 1000
    place = {p: k for k, p in enumerate(vocab.names)}

    def brute(word):
        if not word:
            return np.ones(2)
        total = np.zeros(2)
        for n in range(1, len(word) + 1):
            if word[:n] in place:
                total = total + prob[place[word[:n]]] * brute(word[n:])
            elif n == 1:
                total = total + prob[-1] * brute(word[1:])
        return total

    words = ["the", "nation", "ß", "日本x", "été"]
    assert np.allclose(language.word_log(vocab, prob, words), [np.log(brute(language.SPACE + w)) for w in words])
    # expected uses: each forward-backward pass explains a word wholly
    marked = [language.SPACE + w for w in words]
    uses = language.Lattice(vocab, marked).expected(prob, np.ones((len(words), 2)))
    length = np.array([*map(len, vocab.names), 1])
    assert np.allclose((uses * length[:, None]).sum(axis=0), sum(map(len, marked)))
    one_by_one = np.zeros_like(prob)
    for w in marked:
        language.LongWord(vocab, prob, w).expected(np.ones(2), one_by_one)
        assert np.allclose(language.long_logs(vocab, prob, [w])[0], np.log(brute(w)))
    assert np.allclose(one_by_one, uses)


def test_unspaced_text_is_fast():
    """Sentences without a space: megabytes a second, not letters."""
    vocab = language.pieces(language.vocabulary_path())
    rng = np.random.default_rng(3)
    prob = rng.random((len(vocab.names) + 1, 4)) / 1000
    words = ["".join(chr(c) for c in rng.integers(0x4E00, 0x9FA5, rng.integers(31, 200))) for _ in range(4000)]
    began = time.process_time()
    language.word_log(vocab, prob, words)
    assert sum(len(w.encode()) for w in words) / (time.process_time() - began) > 1e6


def test_long_words_are_summed_whole():
    """Words over LONG letters, up to thousands, against sums in logs letter by letter: no segmentation is left out."""
    vocab = language.pieces(language.vocabulary_path())
    rng = np.random.default_rng(2)
    prob = rng.random((len(vocab.names) + 1, 3)) / 1000
    place = {p: k for k, p in enumerate(vocab.names)}

    def slow(word):
        total = np.full((len(word) + 1, 3), -np.inf)
        total[0] = 0
        for i in range(len(word)):
            for n in range(1, min(vocab.longest, len(word) - i) + 1):
                k = place.get(word[i : i + n], -1 if n == 1 else None)
                if k is not None:
                    total[i + n] = np.logaddexp(total[i + n], total[i] + np.log(prob[k]))
        return total[-1]

    words = ["international" * 3, "donaudampfschifffahrtsgesellschaft", "日本語の文は空白がない" * 4, "the" * 1500, "x"]
    assert np.allclose(language.word_log(vocab, prob, words), [slow(language.SPACE + w) for w in words])
    many = ["".join(rng.choice(list("日本語の文空白intera"), rng.integers(31, 90))) for _ in range(150)] + [words[3]]
    before = language.CELLS
    try:
        for cells in (before, 5000):  # runs of one or a few letters too
            language.CELLS = cells
            assert np.allclose(language.word_log(vocab, prob, many), [slow(language.SPACE + w) for w in many])
    finally:
        language.CELLS = before
    uses = np.zeros_like(prob)
    word = language.SPACE + words[3]
    language.LongWord(vocab, prob, word).expected(np.ones(3), uses)
    assert np.allclose((uses * np.array([*map(len, vocab.names), 1])[:, None]).sum(axis=0), len(word))
