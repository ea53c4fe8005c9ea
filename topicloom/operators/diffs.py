"""Revisions of files as differences: lines added and deleted by a longest common subsequence, and histories kept as deltas.

A revision is compared with the one before it by a join on (file, place in the log), so a file with many revisions is spread
over tasks. Python sees two texts at a time: lines become numbers, equal heads and ends are cut off, and common
subsequences are counted with bits of whole numbers, one for each line. A packed history has whole contents every few
revisions and edits between them, so that any version is rebuilt from a bounded number of rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Revisions from one whole content to the next.
EVERY = 16
#: An edit: after ``at`` lines of the older revision ``gone`` lines go, and ``lines`` come.
EDITS = "array<struct<at:int,gone:int,lines:array<string>>>"


def _bits(a: list[int], b: list[int]) -> int:
    """A number whose zero bits among the first i are the longest common subsequence of ``a[:i]`` and ``b``."""
    places: dict[int, int] = defaultdict(int)
    for i, x in enumerate(a):
        places[x] |= 1 << i
    full = (1 << len(a)) - 1
    v = full
    for y in b:
        if m := places.get(y):
            u = v & m
            v = ((v + u) | (v - u)) & full
    return v


def _lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Longest common subsequences of all heads of ``a`` with ``b``."""
    data = _bits(a, b).to_bytes(len(a) // 8 + 1, "little")
    ones = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little")[: len(a)]
    return np.append(0, np.cumsum(1 - ones.astype(np.int64)))


def _ends(a: list[int], b: list[int]) -> tuple[int, int]:
    """Lines that two texts share at their head, and then at their end."""
    most = min(len(a), len(b))
    head = next((i for i in range(most) if a[i] != b[i]), most)
    most -= head
    return head, next((i for i in range(most) if a[-1 - i] != b[-1 - i]), most)


def _numbered(old: list[str], new: list[str]) -> tuple[list[int], list[int]]:
    numbers: dict[str, int] = {}
    return tuple([numbers.setdefault(x, len(numbers)) for x in lines] for lines in (old, new))


def changed(old: list[str], new: list[str]) -> tuple[int, int]:
    """(added, deleted) lines of the smallest difference."""
    a, b = _numbered(old, new)
    head, end = _ends(a, b)
    a, b = a[head : len(a) - end], b[head : len(b) - end]
    common = len(a) - _bits(a, b).bit_count()
    return len(b) - common, len(a) - common


def _pairs(a: list[int], b: list[int], i: int, j: int) -> Iterator[tuple[int, int]]:
    """Places of a longest common subsequence, in order: ``b`` is halved where the halves have the most in common with a head and an end of ``a``."""
    work = [(a, b, i, j)]
    while work:
        a, b, i, j = work.pop()
        if not a or not b:
            continue
        if len(b) == 1:
            if b[0] in a:
                yield i + a.index(b[0]), j
            continue
        half = len(b) // 2
        cut = int(np.argmax(_lengths(a, b[:half]) + _lengths(a[::-1], b[half:][::-1])[::-1]))
        work += [(a[cut:], b[half:], i + cut, j + half), (a[:cut], b[:half], i, j)]


def edits(old: list[str], new: list[str]) -> list[tuple[int, int, list[str]]]:
    """(at, gone, lines) of a smallest difference, by place in the old lines."""
    a, b = _numbered(old, new)
    head, end = _ends(a, b)
    at, to, out = head, head, []
    for i, j in [*_pairs(a[head : len(a) - end], b[head : len(b) - end], head, head), (len(a) - end, len(b) - end)]:
        if i > at or j > to:
            out.append((at, i - at, new[to:j]))
        at, to = i + 1, j + 1
    return out


def applied(old: list[str], changes: list[tuple[int, int, list[str]]]) -> list[str]:
    out, at = [], 0
    for place, gone, lines in changes:
        out += [*old[at:place], *lines]
        at = place + gone
    return out + old[at:]


def _lines(text: str | None) -> list[str]:
    """Lines of a text; none for a missing one."""
    return [] if text is None else text.split("\n")


def _compared(revisions: DataFrame, order: str) -> DataFrame:
    """Revisions with ``_old``, the content of the one before (``order``: 0 is the newest); null for a file's first."""
    older = revisions.select("file", (F.col(order) - 1).alias(order), F.coalesce("content", F.lit("")).alias("_old"))
    return revisions.withColumn("content", F.coalesce("content", F.lit(""))).join(older, ["file", order], "left")


def line_diffs(revisions: DataFrame, order: str) -> DataFrame:
    """(version, file, added, deleted): lines of the smallest difference to the file's revision before, so a moved line is one of each.

    revisions: version, file, ``order`` (0, 1, 2 ... from the newest, once for each file), content. All lines of a file's first
    revision are added; lines end at line feeds, so an empty content is one empty line; a null content counts as empty."""

    @F.pandas_udf("struct<added:long,deleted:long>")
    def compare(old: pd.Series, new: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([changed(_lines(a), _lines(b)) for a, b in zip(old, new, strict=True)], columns=["added", "deleted"])

    found = _compared(revisions.select("version", "file", order, "content"), order)
    return found.select("version", "file", compare("_old", "content").alias("_d")).select("version", "file", "_d.*")


def packed(revisions: DataFrame, order: str, every: int = EVERY) -> DataFrame:
    """(file, frame, ``order``, version, content, edits): a history as deltas. The oldest revision of each ``every`` has its content, the others
    what changes from the one before."""
    frame = F.expr(f"cast({order} div {every} as int)")
    found = _compared(revisions.select("version", "file", order, "content"), order).withColumn("frame", frame)
    whole = F.col("_old").isNull() | (F.col(order) % every == every - 1)

    @F.pandas_udf(EDITS)
    def difference(old: pd.Series, new: pd.Series) -> pd.Series:
        as_rows = lambda a, b: [{"at": at, "gone": gone, "lines": lines} for at, gone, lines in edits(_lines(a), _lines(b))]
        return pd.Series([None if b is None else as_rows(a, b) for a, b in zip(old, new, strict=True)])

    delta = difference(F.when(~whole, F.col("_old")), F.when(~whole, F.col("content")))
    return found.select("file", "frame", order, "version", F.when(whole, F.col("content")).alias("content"), delta.alias("edits"))


def unpacked(history: DataFrame, order: str) -> DataFrame:
    """(file, ``order``, version, content) of a packed history: all revisions, rebuilt frame by frame."""
    schema = f"file string, {order} int, version string, content string"

    def rebuild(frame: pd.DataFrame) -> pd.DataFrame:
        lines, out = [], []
        for r in frame.sort_values(order, ascending=False).itertuples():
            lines = _lines(r.content) if r.content is not None else applied(lines, [(e["at"], e["gone"], list(e["lines"])) for e in r.edits])
            out.append((r.file, getattr(r, order), r.version, "\n".join(lines)))
        return pd.DataFrame(out, columns=["file", order, "version", "content"])

    return history.groupBy("file", "frame").applyInPandas(rebuild, schema)


def at_place(history: DataFrame, order: str, place: int, every: int = EVERY) -> DataFrame:
    """The files' contents at a place of their logs (0: newest), read from one frame of each; a file without it has no row."""
    return unpacked(history.where((F.col("frame") == place // every) & (F.col(order) >= place)), order).where(F.col(order) == place)
