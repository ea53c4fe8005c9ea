"""Personal data, ranked search and fill-in-the-middle against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.cases import SCHEMA, empty, frame, rows
from topicloom.llm import infill, privacy, queries, treaps

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def documents(spark, sf_dir):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]


def match(got, want):
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


# personal data

RULES = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def checks(kind, text):
    digits = [int(c) for c in re.sub("[^0-9]", "", text)] if kind else []
    if kind == 1:
        return all(int(p) <= 255 for p in text.split("."))
    if kind == 2:
        doubled = [d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(digits[::-1])]
        return 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return 9 <= len(digits) <= 15 if kind == 3 else True


def expected_spans(text):
    return sorted((m.start(), kind, m.end()) for kind, rule in enumerate(RULES) for m in re.finditer(rule, text or "", re.ASCII) if checks(kind, m.group()))


def expected_base(docs):
    out = []
    for doc, text in docs:
        found = expected_spans(text)
        digest = hashlib.sha256(",".join(f"{privacy.KINDS[k]}:{a}:{b}" for a, k, b in found).encode()).hexdigest()
        out.append((doc, *[sum(s[1] == k for s in found) for k in range(4)], digest))
    return out


BASE = ["n_email", "n_ip", "n_card", "n_phone", "base_sha256"]
PRIVATE = [
    "é a.b@x.y.z, @a.b@c.d x@y @@ a@b..c a@b.c@d.e x+y%@q-r.s. é@a.b",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.0255 1.2.3 é9.9.9.9",
    "4316522678525456 4316-5226-7852-5456 4316 5226 7852 5456 4316522678525457 0000 0000 0000 1  1 1 1 1 1 1 1 1 1 1 1 1",
    "+1 (743) 555-3824 +49 30 1234567890123 +1 2 ++44.20.7946.0958 +1 (",
    "call +1 743 555 3824@x.y.z 10.0.0.1@host.example",
    "1" * 5000 + "." + "2" * 5000 + " " + "a" * 9000 + "@" + "1 " * 3000,
]


def test_private_base(spark, sf_dir):
    match(queries.op11_disclosure(spark, sf_dir).select("doc_id", *BASE).collect(), expected_base(documents(spark, sf_dir)))
    docs = frame(spark, PRIVATE)
    match(privacy.scan(docs, privacy.fit(docs)).select("_id", *BASE).collect(), expected_base([r[:2] for r in rows(PRIVATE)]))
    assert privacy.scan(empty(spark), privacy.fit(empty(spark))).count() == 0
    assert privacy.sanitise(empty(spark), privacy.fit(empty(spark))).columns == empty(spark).columns


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1 9.@-+()é,%\t", max_size=80))
def test_private_spans_of_any_text(text):
    data = text.encode()
    got = [(len(data[:a].decode()), k, len(data[:b].decode())) for a, k, b, _ in privacy.base_spans(data)]
    assert got == expected_spans(text)


def test_private_patterns_are_linear():
    for text in (b"a" * 3_000_000, b"1" * 3_000_000, b"1." * 1_500_000, b"1 " * 1_500_000, b"+1" * 1_500_000, b"+1" + b" " * 3_000_000, b"a@" * 1_500_000):
        privacy.base_spans(text)


NAMES = ["zorblatt", "quimbrey", "Zorél", "ab"]


def revealing(copies=1):
    """Texts of common words; one name stands beside one address only, in many surroundings, others anywhere."""
    rng = random.Random(3)
    common = [f"w{k}" for k in range(200)]
    prose = lambda n: " ".join(rng.choice(common) for _ in range(n))
    texts = []
    for k in range(60):
        texts.append(prose(150))
        if k % 6 == 0:
            texts.append(f"{prose(30)} {NAMES[0]} {prose(3)} z.b@mail.example {prose(2)} {NAMES[2]} {prose(40)}")
        if k % 6 == 1:
            texts.append(f"{prose(80)} {NAMES[1]} {prose(30)}")
            texts.append(f"{prose(10)} {NAMES[1]} {prose(2)} +1 743 555 3824 {prose(20)}")
    texts.append(f"{prose(30)} {NAMES[0].upper()} {prose(30)}")
    texts += [f"{prose(20)} unique{copies} 9.8.7.6 {prose(10)}"] * copies
    return [(k, t, "en", "s", 0, 0.0, 0) for k, t in enumerate(texts)]


def expected_terms(texts, length=None):
    """Disclosing words (or prefixes) by plain counts."""
    total, count, near, by_entity = 0, Counter(), defaultdict(Counter), Counter()
    kinds = defaultdict(set)
    for text in texts:
        spans = expected_spans(text)
        words = [(m.start(), m.group().translate(LOWER)) for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text) if not any(a < m.end() and m.start() < b for a, _, b in spans)]
        total += len(words)
        name = [w if length is None else w[:length] if len(w) > length else None for _, w in words]
        count.update(n for n in name if n)
        close = {((k, re.sub("[^0-9]", "", text[a:b]) if k > 1 else text[a:b].lower()), i) for a, k, b in spans for p in [sum(s < a for s, _ in words)] for i in range(max(0, p - 16), min(len(words), p + 16))}
        for c, i in close:
            by_entity[c] += 1
            if name[i]:
                near[c][name[i]] += 1
                kinds[c, name[i]].add(tuple(words[j][1] if 0 <= j < len(words) else j - i for j in (i - 2, i - 1, i + 1, i + 2)))
    out = {}
    for c, found in near.items():
        log_p = math.log(by_entity[c] / total)
        for t, n in found.items():
            if len(kinds[c, t]) >= 3 and n >= 3 and log_p <= -4 * math.log(2) and math.log(n) - 0.1 * log_p >= math.log(count[t]) - 1e-9:
                out[t] = max(out.get(t, 0), 1 - math.log(n / count[t]) / log_p)
    return out


def key_of(word, length=None):
    data = np.frombuffer(word.encode(), np.uint8)
    key = privacy.word_keys(word.encode() + b" ", np.array([0]), np.array([len(data)]))
    return int((key if length is None else privacy.prefix_keys(key, length)).view(np.int64)[0])


def test_disclosing_terms(spark):
    given = revealing(300)
    docs = spark.createDataFrame(given, SCHEMA).repartition(5)
    terms = privacy.fit(docs)
    want = {key_of(t, n): d for n in (None, 4, 2) for t, d in expected_terms([r[1] for r in given], n).items()}
    got = {r["t"]: r["disclosure"] for r in terms.collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)
    words = expected_terms([r[1] for r in given])
    assert {"zorblatt", "zorél"} <= set(words) and not {"quimbrey", "unique300"} & set(words)
    spans = {r["_id"]: r["spans"] for r in privacy.scan(docs, terms).collect()}
    for doc, text, *_ in given:
        own = [f"{a}:{b}" for a, k, b in expected_spans(text)]
        more = [f"{m.start()}:{m.end()}" for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text) if m.group().translate(LOWER) in words and not any(a < m.end() and m.start() < b for a, _, b in expected_spans(text))]
        assert sorted(s.split(":", 1)[1] for s in spans[doc].split(",") if s) == sorted(own + more)
    by_map = privacy.scan(docs, terms, sent=0)
    match(by_map.select("_id", "spans").collect(), [tuple(x) for x in spans.items()])
    clean = {r["doc_id"]: r["text"] for r in privacy.sanitise(docs, terms).collect()}
    assert clean == {r["doc_id"]: r["text"] for r in privacy.sanitise(docs, terms, sent=0).collect()}
    prefix = {n: expected_terms([r[1] for r in given], n) for n in (4, 2)}
    for doc, text, *_ in given:
        assert "@" not in clean[doc] and "zorblatt" not in clean[doc].lower() and "Zorél" not in clean[doc]
        if "zorblatt" in text:
            shown = "zorb*" if "zorb" not in prefix[4] else "zo*" if "zo" not in prefix[2] else "[term]"
            assert f" {shown} " in clean[doc]


def test_prefixes_that_disclose_nothing_stay(spark):
    """Other words begin as a name does, so its prefix tells little."""
    rng = random.Random(5)
    given = revealing() + [(1000 + k, " ".join(["zorbing zoo"] + [f"w{rng.randrange(200)}" for _ in range(30)]), "en", "s", 0, 0.0, 0) for k in range(100)]
    docs = spark.createDataFrame(given, SCHEMA)
    clean = {r["doc_id"]: r["text"] for r in privacy.sanitise(docs, privacy.fit(docs)).collect()}
    assert any(" zorb* " in t for t in clean.values()) and all("zorbing" in clean[1000 + k] for k in range(100))


def test_private_awkward(spark):
    docs = frame(spark, ["x a@b.c"])
    got = privacy.sanitise(docs, privacy.fit(docs))
    assert got.columns == docs.columns and got.count() == docs.count()
    texts = [r["text"] for r in got.collect()]
    assert "x [email]" in texts and texts.count(None) == [r[1] for r in rows()].count(None)


# ranked search


def expected_ranks(docs, items, top=10):
    terms = [(d, Counter(w.translate(LOWER) for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t or ""))) for d, t in docs]
    terms = [(d, c) for d, c in terms if c]
    n, total = len(terms), sum(c.total() for _, c in terms)
    df = Counter(t for _, c in terms for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * k + 1))) for t, k in df.items()}
    out = []
    for item, text in items:
        asked = {w.translate(LOWER) for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")}
        found = []
        for d, c in terms:
            m = 10 + 90 * c.total() * n // total
            score = sum(weight[t] * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in asked if t in c)
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(item, k, d, -s) for k, (s, _, _, d) in enumerate(sorted(found)[:top], 1)]
    return out


ITEMS = [(1, "alpha beta"), (2, "Alpha, BETA!"), (2, "beta"), (3, None), (4, "..."), (5, "日本語 naïve ſecret nowhere"), (None, "the the the of x1"), (6, "nowhere")]


def test_search(spark, sf_dir):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    match(queries.op12_inverted_treaps(spark, sf_dir).collect(), expected_ranks(documents(spark, sf_dir), items))
    docs, asked = frame(spark).repartition(3), spark.createDataFrame(ITEMS, "item_id long, text string")
    want = expected_ranks([r[:2] for r in rows()], ITEMS)
    match(treaps.search(docs, asked).collect(), want)
    match(treaps.search(docs, asked, block_bytes=12).collect(), want)
    match(treaps.search(docs, asked, top=2).collect(), expected_ranks([r[:2] for r in rows()], ITEMS, 2))
    for a, b in ((empty(spark), asked), (docs, asked.limit(0)), (docs.where("text is null"), asked)):
        assert treaps.search(a, b).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.data())
def test_walk_finds_the_highest(data):
    terms, docs = data.draw(st.integers(1, 6)), data.draw(st.integers(1, 60))
    pairs = sorted(data.draw(st.sets(st.tuples(st.integers(0, terms - 1), st.integers(0, docs - 1)), max_size=200)))
    impact = np.array([data.draw(st.integers(0, 9)) for _ in pairs], np.int64)
    term, doc = (np.array([p[k] for p in pairs], np.int64) for k in (0, 1))
    t = treaps.Treaps(term, doc, impact, terms, docs)
    for up, side in ((t.left, -1), (t.right, 1)):
        child = up[:-1]
        has = np.flatnonzero(child != t.none)
        assert (t.impact[child[has]] <= t.impact[has]).all() and (np.sign(t.doc[child[has]] - t.doc[has]) == side).all()
    asked = [np.array(sorted(data.draw(st.sets(st.integers(0, terms - 1), min_size=1))), np.int64) for _ in range(3)]
    least = np.array([data.draw(st.integers(1, 12)) for _ in asked], np.int64)
    top = data.draw(st.integers(1, 4))
    want = []
    for k, q in enumerate(asked):
        score = Counter()
        for a, d, x in zip(term.tolist(), doc.tolist(), impact.tolist(), strict=True):
            score[d] += x * (a in q)
        want += [(k, s, d) for d, s in sorted(score.items(), key=lambda x: (-x[1], x[0]))[:top] if s >= least[k]]
    assert list(zip(*[x.tolist() for x in treaps.walk(t, asked, least, top)], strict=True)) == want


def test_walk_leaves_out_what_cannot_enter():
    rng = np.random.default_rng(1)
    docs = 200_000
    term = np.repeat(np.arange(3), docs)
    doc = np.tile(np.arange(docs), 3)
    impact = (rng.pareto(1.0, 3 * docs) * 100).astype(np.int64) + 1
    visits = []
    treaps.walk(treaps.Treaps(term, doc, impact, 3, docs), [np.arange(3)], np.array([1]), 10, visits)
    assert sum(visits) < docs / 10


def test_many_equal_scores(spark):
    same = [(k, "alpha beta", None, None, 0, 0.0, 0) for k in range(3000)] + [(k + 5000, "gamma", None, None, 0, 0.0, 0) for k in range(4000)]
    random.Random(1).shuffle(same)
    got = treaps.search(spark.createDataFrame(same, SCHEMA).repartition(6), spark.createDataFrame([(1, "beta")], "item_id long, text string"))
    assert sorted((r["rank"], r["doc_id"]) for r in got.collect()) == [(k + 1, k) for k in range(10)]


# fill-in-the-middle

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
INFILL = ["<P> a b", "a <S>", "x<M", "< P>", "  ", "a\n", " a b  \n", "é " * 3000, "日本語 " * 1500 + "\t", "x" * 20000, "\n" * 9000 + "a", "<" * 50 + " <S <P", *[f"a{k} b\tc  d{'e' * k}\n" * k for k in range(1, 40)]]


def expected_infill(docs):
    out = []
    for doc, text in docs:
        text = text or ""
        tokens = TOKEN.findall(text)
        digest = hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()
        h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
        a, b = sorted(x % (len(tokens) + 1) for x in h[:2])
        form = "plain" if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50 else "spm" if h[3] % 100 < 80 else "psm"
        prefix, middle, suffix = ("".join(x) for x in (tokens[:a], tokens[a:b], tokens[b:]))
        output = {"plain": text, "psm": f"<P>{prefix}<S>{suffix}<M>{middle}", "spm": f"<S>{suffix}<P>{prefix}<M>{middle}"}[form]
        plain = form == "plain"
        out.append((doc, len(tokens), form, None if plain else len(prefix), None if plain else len(middle), hashlib.sha256(output.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    return out


def test_infill(spark, sf_dir):
    match(queries.op13_infill(spark, sf_dir).collect(), expected_infill(documents(spark, sf_dir)))
    found = infill.transform(frame(spark, INFILL)).collect()
    want = {w[0]: w for w in expected_infill([r[:2] for r in rows(INFILL)])}
    assert len(found) == len(rows(INFILL)) and {r["form"] for r in found} == {"plain", "psm", "spm"}
    texts = dict(r[:2] for r in rows(INFILL))
    for r in found:
        if r["_id"] is not None:
            assert (r["_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], hashlib.sha256(r["output"].encode()).hexdigest()) == want[r["_id"]][:6]
    restored = infill.transform(frame(spark, INFILL)).select("_id", infill.restored(queries.F.col("output"), queries.F.col("form")).alias("t"))
    assert all(r["t"] == (texts[r["_id"]] or "") for r in restored.collect() if r["_id"] is not None)
    assert infill.transform(empty(spark)).count() == 0


def test_infill_in_place(spark):
    docs = frame(spark, INFILL).withColumnsRenamed({"n_words": "form", "score": "output"})
    got = infill.replaced(docs)
    assert got.columns == docs.columns
    want = sorted(repr(r["output"]) for r in infill.transform(docs).collect())
    assert sorted(repr(r["text"]) for r in got.collect()) == want
    assert infill.replaced(docs, rate=0).where("text <> '' and text like '<_>%<_>%<_>%'").count() == 0


@pytest.mark.parametrize("chunk", [1, 2, 3, 7])
@settings(max_examples=60, deadline=None)
@given(texts=st.lists(st.text(alphabet="ab é日\n\t", max_size=40), min_size=1, max_size=6), h=st.integers(0, 2**32 - 1), g=st.integers(0, 2**32 - 1))
def test_cuts_over_any_chunks(chunk, texts, h, g):
    before = infill.CHUNK, infill.TOGETHER
    infill.CHUNK, infill.TOGETHER = chunk, 3
    try:
        n, first, second = infill.cuts_of([t.encode() for t in texts], np.full(len(texts), h), np.full(len(texts), g))
    finally:
        infill.CHUNK, infill.TOGETHER = before
    for k, text in enumerate(texts):
        tokens = TOKEN.findall(text)
        a, b = sorted((h % (len(tokens) + 1), g % (len(tokens) + 1)))
        assert (n[k], first[k], second[k]) == (len(tokens), len("".join(tokens[:a])), len("".join(tokens[:b])))
