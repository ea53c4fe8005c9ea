"""Language detection by character n-grams: counts in tasks, sums by row.

A profile is counted from labelled rows: of each language its most frequent trigrams, with the logarithms of their
shares in every language. Tasks count the trigrams of their texts as numbers, a run at a time, so that what is shuffled is a count for
each distinct trigram of a run; a text's trigrams are looked up in the profile where the row is read, and what is shuffled is a number for each
language.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The most frequent trigrams of a language that a profile keeps.
KEPT = 2000
#: Texts of fewer characters aren't judged.
SHORT = 20
#: Characters that are numbered at once.
RUN = 1 << 20
#: Bits of a character in a trigram's number; numbers are ordered as the trigrams are.
BITS = 21


def folded(text: Column) -> Column:
    """A text in lower case; runs of white space count as one space."""
    return F.lower(F.regexp_replace(text, r"[\t\n\x0B\f\r ]+", " "))


def gram(code: Column) -> Column:
    """A trigram of its number."""
    char = lambda k: F.lpad(F.hex(F.shiftright(code, BITS * k).bitwiseAND(F.lit((1 << BITS) - 1))), 8, "0")
    return F.decode(F.unhex(F.concat(char(2), char(1), char(0))), "UTF-32")


def codes_of(texts: Iterable[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The trigrams of texts as numbers, and the place of each one's text, in runs."""
    texts = [t or "" for t in texts]
    size = np.array([*map(len, texts)], np.int64)
    ends = np.cumsum(size)
    first, n = 0, len(texts)
    while first < n:  # some texts, or one longer text, are put together
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + RUN, "right")))
        chars = np.frombuffer("".join(texts[first:last]).encode("utf-32-le"), "<u4")
        stop = np.cumsum(size[first:last])
        for at in range(0, max(len(chars) - 2, 0), RUN):
            c = chars[at : at + RUN + 2].astype(np.int64)
            code = (c[:-2] << (2 * BITS)) | (c[1:-1] << BITS) | c[2:]
            place = np.arange(at, at + len(code))
            of = np.searchsorted(stop, place, "right")
            inside = place + 2 < stop[of]  # of one text
            yield code[inside], of[inside] + first
        first = last


def profile(labelled: DataFrame, text: str, language: str, kept: int = KEPT) -> DataFrame:
    """(gram, language, log_share): at most ``kept`` trigrams of each language, each with its share in all languages; what a language lacks
    counts once. Rows without a text or language are left out."""
    source = labelled.where(F.col(text).isNotNull() & F.col(language).isNotNull()).select(F.col(language).alias("language"), folded(F.col(text)).alias("text"))
    kind = source.schema["language"].dataType.simpleString()

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("language").dictionary_encode()
            number = names.indices.to_numpy(zero_copy_only=False)
            for code, of in codes_of(batch.column("text").to_pylist()):
                its = number[of]
                for k in np.unique(its):
                    one, n = np.unique(code[its == k], return_counts=True)
                    own = names.dictionary.take(pa.array(np.full(len(one), k)))
                    yield pa.RecordBatch.from_arrays([own, pa.array(one), pa.array(n.astype(np.int64))], names=["language", "code", "n"])

    counts = source.mapInArrow(count, f"language {kind}, code long, n long").groupBy("language", "code").agg(F.sum("n").alias("n"))
    totals = counts.groupBy("language").agg(F.sum("n").alias("total"))
    rank = F.row_number().over(Window.partitionBy("language").orderBy(F.desc("n"), "code"))
    best = counts.withColumn("_rank", rank).where(F.col("_rank") <= kept).select("code").distinct()
    every = best.join(F.broadcast(totals))  # a row for each language
    shares = every.join(counts, ["language", "code"], "left")
    return shares.select(gram(F.col("code")).alias("gram"), "language", F.log((F.coalesce("n", F.lit(0)) + 1) / (F.col("total") + F.lit(kept))).alias("log_share"))


def detected(texts: DataFrame, key: str, text: str, known: DataFrame) -> DataFrame:
    """(key, language) for each distinct key: the language whose n-grams make its texts most likely, equal ones by name; null for texts under
    20 characters and those without a known n-gram. ``known`` is a profile, which is small by its parameters, and goes along with tasks."""
    found = known.collect()
    names = sorted({r["language"] for r in found})
    code = {g: next(codes_of([g]))[0][0] for g in {r["gram"] for r in found}}
    table = np.array(sorted(code.values()), np.int64)
    at = {g: k for g, k in zip(code, np.searchsorted(table, [*code.values()]), strict=True)}
    shares = np.zeros((len(names), len(table)))
    for r in found:
        shares[names.index(r["language"]), at[r["gram"]]] = r["log_share"]
    long = F.when(F.length(F.col(text)) >= SHORT, folded(F.col(text)))
    rows = texts.select(F.col(key).alias("key"), F.coalesce(long, F.lit("")).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    columns = ["_n", *[f"_s{k}" for k in range(len(names))]]

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, sums = np.zeros(batch.num_rows, np.int64), np.zeros((len(names), batch.num_rows))
            for codes, of in codes_of(batch.column("text").to_pylist()) if len(table) else ():
                one, number = np.unique(codes, return_inverse=True)  # each distinct one is looked up once
                place = np.minimum(np.searchsorted(table, one), len(table) - 1)
                place = np.where(table[place] == one, place, -1)[number]
                hit = place >= 0
                place, of = place[hit], of[hit]
                if len(of):
                    low = of[0]  # places go upwards
                    some = np.bincount(of - low)
                    n[low : low + len(some)] += some
                    for k, s in enumerate(shares):
                        sums[k, low : low + len(some)] += np.bincount(of - low, s[place])
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(n), *map(pa.array, sums)], names=["key", *columns])

    scored = rows.mapInArrow(score, f"key {kind}, _n long" + "".join(f", {c} double" for c in columns[1:])).groupBy("key").agg(*[F.sum(c).alias(c) for c in columns])
    best = F.array_max(F.array(*[F.struct(F.round(f"_s{k}", 6).alias("s"), F.lit(n).alias("n")) for k, n in enumerate(names)]))
    return scored.select(F.col("key").alias(key), (F.when(F.col("_n") > 0, best["n"]) if names else F.lit(None).cast("string")).alias("language"))


def english(texts: DataFrame, key: str, text: str, known: DataFrame) -> DataFrame:
    """(key, english): detected as English, or not to be detected."""
    return detected(texts, key, text, known).select(key, (F.coalesce("language", F.lit("en")) == "en").alias("english"))
