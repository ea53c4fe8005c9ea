"""Fill-in-the-middle transformation by overlapping chunks.

A token ends where a character that isn't white space stands before white space or the end, so
two adjacent characters tell. Texts are cut into chunks that overlap by one character; the ends in
each chunk are counted, all chunks at once; running sums over a text's chunks give the chunk that
owns the token after which a text is cut, and only that chunk is scanned again. White space is ASCII, so
this is done on UTF-8 bytes. Python returns numbers only: texts are put together in the JVM.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicloom.llm.common import bounded

#: Bytes of a chunk, besides the one that it shares with the next; chunks that are looked at together.
CHUNK, TOGETHER = 4096, 256
#: Marks of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Shares (of 100) of texts that are transformed, and of these in the order suffix, prefix, middle.
RATE, SPM = 50, 80

SOLID = np.ones(256, bool)
SOLID[list(b" \t\n\v\f\r")] = False


class Chunks:
    """The chunks of several texts that lie one after another in ``data``; each text is followed by a space."""

    def __init__(self, data: np.ndarray, start: np.ndarray, stop: np.ndarray):
        """start, stop: of each text in the data."""
        self.data, self.start, self.stop = data, start, stop
        many = np.maximum(1, -(-(stop - start) // CHUNK))  # an empty text has one empty chunk
        self.first = np.cumsum(many) - many
        text = np.repeat(np.arange(len(start)), many)
        self.begin = start[text] + (np.arange(len(text)) - self.first[text]) * CHUNK
        self.end = np.minimum(self.begin + CHUNK, stop[text])
        self.ends = np.zeros(len(text), np.int64)
        for a in range(0, len(text), TOGETHER):
            self.ends[a : a + TOGETHER] = self._count(slice(a, a + TOGETHER))
        self.until = np.cumsum(self.ends)
        last = self.first + many - 1
        self.before = self.until[self.first] - self.ends[self.first]
        solid = self.until[last] - self.before
        # white space at a text's end is a token of its own
        self.tokens = solid + ((stop > start) & ~SOLID[data[np.maximum(stop - 1, 0)]])
        self.solid = solid

    def _predicate(self, begin: int, end: int) -> np.ndarray:
        """Of each place whether a token of solid characters ends with it; the chunk overlaps the next one by a character."""
        solid = SOLID[self.data[begin : end + 1]]
        return solid[:-1] & ~solid[1:]

    def _count(self, some: slice) -> np.ndarray:
        begin, end = self.begin[some], self.end[some]
        base = int(begin[0])
        sums = np.append(0, np.cumsum(self._predicate(base, int(end[-1])), dtype=np.int64))
        return sums[end - base] - sums[begin - base]

    def after(self, rank: np.ndarray) -> np.ndarray:
        """Of each text the bytes of its first ``rank`` tokens."""
        out = np.where(rank > self.solid, self.stop, self.start) - self.start
        inside = np.flatnonzero((rank > 0) & (rank <= self.solid))
        wanted = self.before[inside] + rank[inside]
        owner = np.searchsorted(self.until, wanted)
        for k, chunk, left in zip(inside, owner, wanted - self.until[owner] + self.ends[owner], strict=True):
            at = np.flatnonzero(self._predicate(int(self.begin[chunk]), int(self.end[chunk])))[left - 1]
            out[k] = self.begin[chunk] + at + 1 - self.start[k]
        return out


def characters(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Code points in runs of bytes."""
    return np.array([np.count_nonzero((data[a : a + n] & 0xC0) != 0x80) for a, n in zip(start.tolist(), size.tolist(), strict=True)], np.int64)


CUTS = "struct<n:bigint,first:bigint,second:bigint>"


def cuts_of(texts: list[bytes], h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each text: tokens, and the code points before its two cuts, after the first h % (tokens + 1) tokens for the smaller and the larger h % (tokens + 1)."""
    size = np.array([len(t) for t in texts], np.int64)
    start = np.cumsum(size + 1) - size - 1
    data = np.frombuffer(b" ".join([*texts, b""]) or b" ", np.uint8)
    chunks = Chunks(data, start, start + size)
    ranks = np.sort(np.stack([h1 % (chunks.tokens + 1), h2 % (chunks.tokens + 1)]), axis=0)
    return chunks.tokens, *[characters(data, start, chunks.after(r)) for r in ranks]


def _cuts(text: Column, h1: Column, h2: Column) -> Column:
    """``cuts_of`` as a column."""

    @F.arrow_udf(CUTS)
    def run(text: pa.Array, h1: pa.Array, h2: pa.Array) -> pa.Array:
        size = pc.binary_length(text).to_numpy(zero_copy_only=False).astype(np.int64)
        end, parts, at = np.cumsum(size), [], 0
        while at < len(text):  # texts of some megabytes at once, or one longer text
            to = max(at + 1, int(np.searchsorted(end, (end[at - 1] if at else 0) + CHUNK * TOGETHER * 4, "right")))
            some = slice(at, to)
            parts.append(cuts_of(text[some].cast(pa.large_binary()).to_pylist(), h1[some].to_numpy(), h2[some].to_numpy()))
            at = to
        found = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * 3
        return pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in found], names=["n", "first", "second"])

    return run(text, h1, h2)


def _transformed(rows: DataFrame, rate: int, spm: int, seed: int) -> DataFrame:
    """Rows with ``_id`` and ``_text`` (not null), and what they become."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit(""))), 256)
    h = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]
    marked = F.contains("_text", F.lit(PREFIX)) | F.contains("_text", F.lit(SUFFIX)) | F.contains("_text", F.lit(MIDDLE))
    form = F.when((F.col("_text") == "") | marked | (h[2] % 100 >= rate), "plain").when(h[3] % 100 < spm, "spm").otherwise("psm")
    rows = rows.withColumn("form", form).withColumn("_cut", _cuts(F.col("_text"), h[0], h[1]))
    part = lambda a, n: F.substring(F.col("_text"), (a + 1).cast("int"), n.cast("int"))
    first, second = F.col("_cut.first"), F.col("_cut.second")
    prefix, middle, suffix = part(F.lit(0), first), part(first, second - first), part(second, F.length("_text") - second)
    output = F.when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
    output = output.when(F.col("form") == "spm", F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle)).otherwise(F.col("_text"))
    cut = F.col("form") != "plain"
    return rows.withColumns({"n": F.col("_cut.n"), "prefix_chars": F.when(cut, first), "middle_chars": F.when(cut, second - first), "output": output}).drop("_cut")


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: int = RATE, spm: int = SPM, seed: int = 42) -> DataFrame:
    """A row for each row: ``_id``, n (tokens), form (plain, psm, spm), prefix_chars and middle_chars (code points, null if
    plain), ``output``.

    Cuts and form follow from SHA-256 of ``seed:id``, so they don't depend on partitions; rows of one id share the
    numbers, but for the count of tokens. Null is the empty text; a null id is an empty one after the colon. Empty texts and those that hold a mark
    stay plain. White space at a text's end is a token, so a cut may fall before it. A text of any length is cut chunk by
    chunk; no shuffle."""
    rows = bounded(docs).select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    return _transformed(rows, rate, spm, seed).select("_id", "n", "form", "prefix_chars", "middle_chars", "output")


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of. No part of it holds a mark, and a mark can't begin within another."""
    parts = F.split(output, "<[PSM]>", -1)
    return F.when(form == "psm", F.concat(parts[1], parts[3], parts[2])).when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output)


def replaced(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: int = RATE, spm: int = SPM, seed: int = 42) -> DataFrame:
    """The documents, with all their columns, and the transformed text in place of the text; null becomes empty."""
    names = [f"_k{i}" for i in range(len(docs.columns))]
    place = {c: n for c, n in zip(docs.columns, names, strict=True)}
    rows = bounded(docs).toDF(*names).withColumn("_id", F.col(place[id_col])).withColumn("_text", F.coalesce(F.col(place[text_col]), F.lit(""))).drop(place[text_col])
    found = _transformed(rows, rate, spm, seed)
    return found.select(*[F.col("output").alias(c) if c == text_col else F.col(n).alias(c) for c, n in place.items()])


SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
w AS (SELECT doc_id, text, CASE WHEN text = '' THEN []::VARCHAR[] ELSE regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') END AS u,
  ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM t),
c AS (SELECT *, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b FROM w),
p AS (SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:], '') AS suffix,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM c)
SELECT doc_id, len(u)::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(prefix || middle || suffix) AS restored_sha256 FROM p
"""
