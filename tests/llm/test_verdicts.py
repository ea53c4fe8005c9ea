"""Verdicts of the trained operators, end to end, against plain loops with the same trained weights."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.cases import frame, rows
from topicloom.llm import language, lines, secrets


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"), spark.read.parquet(f"{sf_dir}/documents.parquet")


def plain_features(text, recurring):
    """(words, features) of each line with a word, straight from their definitions."""
    out, seen = [], set()
    for line in text.split("\n"):
        words = re.findall(r"[^\x20\x09-\x0D]+", line)
        if not words:
            continue
        chars = sum(map(len, words))
        share = lambda members: min(10 * sum(line.count(chr(b)) for b in members) / chars, 3)  # noqa: B023, E731
        out.append((words, line, [1.0, *[share(m) for m in lines.CLASSES.values()], math.log1p(len(words)) / 4, min(chars / len(words) / 10, 3), line in seen, line in recurring]))
        seen.add(line)
    low = [w.lower() if w.isascii() else w.encode().lower().decode() for words, _, _ in out for w in words]
    at, found = 0, []
    for k, (words, _, f) in enumerate(out):
        doubled = sum(low[i] == low[i - 1] for i in range(max(at, 1), at + len(words)))
        at += len(words)
        *start, size, length, repeat, recurs = f
        found.append((len(words), [*start, size, length, 3 * doubled / len(words), float(repeat), float(k == 0), float(recurs)]))
    return found


def plain_viterbi(scores, step):
    best, back = [(0.0, scores[0])], []
    for s in scores[1:]:
        way = [[best[-1][a] + step[a][b] for a in (0, 1)] for b in (0, 1)]
        back.append([int(w[1] > w[0]) for w in way])
        best.append((max(way[0]), max(way[1]) + s))
    labels = [int(best[-1][1] > best[-1][0])]
    for b in reversed(back):
        labels.append(b[labels[-1]])
    return labels[::-1]


def test_line_verdicts(spark, tables):
    docs, labels, _ = tables
    field = lines.fit(docs, labels)
    given = [(r["doc_id"], r["text"]) for r in docs.collect()] + [(10**6 + k, r[1]) for k, r in enumerate(rows())]
    every = {line for _, t in given for line in (t or "").split("\n")}
    recurring = {line for line in every if int(lines.xxhash.xxh3_64_intdigest(line.encode())) in set(field.recurring.tolist())}
    got = {r["_id"]: r for r in lines.judge(spark.createDataFrame(given, "doc_id long, text string"), field).collect()}
    for doc, text in given:
        found, r = plain_features(text or "", recurring), got[doc]
        want = plain_viterbi([float(np.dot(f, field.emit)) for _, f in found], field.step.tolist()) if found else []
        assert list(r["labels"]) == want, doc
        content = sum(n for (n, _), y in zip(found, want, strict=True) if not y) / max(1, sum(n for n, _ in found))
        assert math.isclose(r["content_share"], content, abs_tol=1e-9)
        assert r["kept"] == (not r["base_failed"] and content >= field.share)


def test_secret_spans(spark, tables):
    docs, _, _ = tables
    models = secrets.fit(docs)
    extra = ["key qV9x0ZbT7LmK2sWc4RyU8nHd. and --9f8e7d6c5b4a39281706f5e4d3c2b1-- end", "é qV9x0ZbT7LmK2sWc4RyU8nHd=", "password=qV9x0ZbT7LmK2sWc4RyU8nHd", "sum " + "deadbeef" * 5]
    given = [(r["doc_id"], r["text"]) for r in docs.collect()] + [(10**6 + k, t) for k, t in enumerate([*extra, *[r[1] for r in rows()]])]
    got = {r["_id"]: r["spans"] for r in secrets.scan(spark.createDataFrame(given, "doc_id long, text string"), models).collect()}
    place = {c: k for k, c in enumerate(secrets.CHARS)}
    seen = Counter()
    for doc, text in given:
        text = text or ""
        spans = [(m.start(), 0, m.end()) for m in re.finditer(secrets.ASSIGN.pattern.decode(), text, re.IGNORECASE | re.ASCII) if len(m[2]) >= 8]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
        more = []
        for m in re.finditer(r"[A-Za-z0-9+/_.=-]+", text):
            token = m[0].strip("._=-/+")
            a = m.start() + m[0].index(token) if token else 0
            if len(token) >= 8 and not any(s < a + len(token) and a < e for s, _, e in spans):
                pairs = zip([secrets.START, *[place[c] for c in token]], [place[c] for c in token], strict=False)
                if sum(models.ratio[x, y] for x, y in pairs) > models.thresholds[max(k for k, n in enumerate(secrets.LENGTHS) if len(token) >= n)]:
                    more.append((a, 3, a + len(token)))
        assert got[doc] == ",".join(f"{('assign', 'access', 'hex', 'markov')[k]}:{s}:{e}" for s, k, e in sorted(spans + more)), doc
        seen.update(k for _, k, _ in spans + more)
    assert all(seen[k] for k in (0, 2, 3))


def test_language_verdicts(spark, tables):
    _, _, docs = tables
    model = language.fit(docs.where(~language.held_out()))
    vocab = language.pieces(model.path)
    place, memory = {p: k for k, p in enumerate(vocab.names)}, {}

    def word(w):
        """Logs of the sums over all segmentations."""
        if w not in memory:
            marked = language.SPACE + w
            total = [np.ones(len(model.langs))] + [np.zeros(len(model.langs))] * len(marked)
            for i in range(len(marked)):
                for n in range(1, min(vocab.longest, len(marked) - i) + 1):
                    k = place.get(marked[i : i + n], -1 if n == 1 else None)
                    if k is not None:
                        total[i + n] = total[i + n] + total[i] * model.prob[k]
            memory[w] = np.log(total[-1])
        return memory[w]

    given = [(r["doc_id"], r["text"]) for r in docs.where("doc_id % 3 = 0").collect()] + [(10**6 + k, r[1]) for k, r in enumerate(rows())]
    for r in language.predict(spark.createDataFrame(given, "doc_id long, text string"), model).collect():
        found = language.WORD.findall((r["text"] or "").lower())
        if not any(map(str.isalpha, r["text"] or "")):
            assert (r["lang_pred"], r["score"]) == ("und", 0)
            continue
        logs = sum(map(word, found)) + model.prior
        odds = np.exp(logs - logs.max())
        assert r["lang_pred"] == model.langs[int(odds.argmax())] and math.isclose(r["score"], odds.max() / odds.sum(), rel_tol=1e-9)


def test_awkward_frames_are_judged_row_by_row(spark, tables):
    docs, labels, _ = tables
    assert lines.judge(frame(spark), lines.fit(docs, labels)).count() == len(rows()) == secrets.scan(frame(spark), secrets.fit(docs)).count()
