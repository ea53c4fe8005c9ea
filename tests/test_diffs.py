"""Differences of revisions against a plain longest common subsequence, and histories kept as deltas."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from topicloom.operators import diffs


def lcs(a, b):
    best = [0] * (len(a) + 1)
    for y in b:
        row = [0]
        for i, x in enumerate(a, 1):
            row.append(best[i - 1] + 1 if x == y else max(best[i], row[-1]))
        best = row
    return best[-1]


LINES = st.lists(st.sampled_from(["a", "b", "c", "", "dd"]), max_size=30)


@settings(max_examples=300, deadline=None)
@given(LINES, LINES)
def test_smallest_difference(a, b):
    common = lcs(a, b)
    assert diffs.changed(a, b) == (len(b) - common, len(a) - common)
    found = diffs.edits(a, b)
    assert diffs.applied(a, found) == b
    assert (sum(len(e[2]) for e in found), sum(e[1] for e in found)) == (len(b) - common, len(a) - common)


def test_long_files_are_compared():
    rng = random.Random(1)
    a = [f"l{rng.randrange(3000)}" for _ in range(20_000)]
    b = [x for x in a if rng.random() > 0.1]
    for _ in range(500):
        b.insert(rng.randrange(len(b)), "new")
    added, deleted = diffs.changed(a, b)
    assert added - deleted == len(b) - len(a) and added <= 500
    assert diffs.applied(a, diffs.edits(a, b)) == b


def history(spark, n_files=3, n_revisions=37):
    rng, rows = random.Random(2), []
    for f in range(n_files):
        lines = ["x"] * 5
        for k in range(n_revisions - f):
            rows.append((f"v{f}.{k}", f"f{f}", n_revisions - f - 1 - k, "\n".join(lines)))
            lines = [x for x in lines if rng.random() > 0.2] + [rng.choice("xyz") for _ in range(rng.randrange(4))]
            rng.shuffle(lines) if rng.random() < 0.3 else None
    return spark.createDataFrame(rows, "version string, file string, age int, content string"), rows


def test_line_diffs(spark):
    frame, rows = history(spark)
    content = {(f, k): c for _, f, k, c in rows}
    got = {r["version"]: (r["added"], r["deleted"]) for r in diffs.line_diffs(frame, "age").collect()}
    for version, f, k, c in rows:
        a = content[f, k + 1].split("\n") if (f, k + 1) in content else []
        common = lcs(a, c.split("\n"))
        assert got[version] == (len(c.split("\n")) - common, len(a) - common)
    moved = spark.createDataFrame([("v0", "f", 1, "a\nb\nc"), ("v1", "f", 0, "b\nc\na"), ("w", "g", 0, None)], "version string, file string, age int, content string")
    assert sorted(map(tuple, diffs.line_diffs(moved, "age").collect())) == [("v0", "f", 3, 0), ("v1", "f", 1, 1), ("w", "g", 1, 0)]
    assert diffs.line_diffs(frame.limit(0), "age").count() == 0


def test_packed_histories(spark):
    frame, rows = history(spark)
    kept = diffs.packed(frame, "age", 8)
    assert kept.where("content is not null").count() < 20 and kept.where("content is null and edits is null").count() == 0
    want = sorted((f, k, v, c) for v, f, k, c in rows)
    assert sorted(map(tuple, diffs.unpacked(kept, "age").collect())) == want
    for place in (0, 7, 8, 20, 35, 36, 99):
        assert sorted(map(tuple, diffs.at_place(kept, "age", place, 8).collect())) == [r for r in want if r[1] == place]
