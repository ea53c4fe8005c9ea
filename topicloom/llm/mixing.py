"""Mixing sources by temperature.

A source's weight is its share of all tokens to the power alpha, normalised. Alpha is found
by bisection: the largest that reaches a target entropy, or the least that keeps every
source within a limit of repetitions. The weights are realised as budgets of tokens, and a
budget as permutations of the source's documents: whole ones first, then the head of one more.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicloom.llm.common import cut

#: Sources whose counts the driver holds; with more of them every bisection step is a Spark aggregate.
DRIVER_SOURCES = 50_000
STEPS = 40
#: Alpha is rounded to so many decimals, so that any two engines agree on it.
DECIMALS = 6
#: Hex digits of a permutation key that deal a source's documents out to buckets.
BUCKET_DIGITS = 3


def word_count(text: Column) -> Column:
    """Tokens of a text: words ``[^\\x20\\x09-\\x0D]+``; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def held(shares: DataFrame) -> DataFrame:
    """A table by source, to be broadcast only while it has DRIVER_SOURCES rows at most."""
    shares = cut(shares)
    return F.broadcast(shares) if shares.count() <= DRIVER_SOURCES else shares


def source_tokens(docs: DataFrame, source_col: str, tokens: Column) -> DataFrame:
    """(source, docs, tokens); a null source is a source of its own."""
    return docs.groupBy(F.col(source_col).alias("source")).agg(F.count(F.lit(1)).alias("n_docs"), F.sum(tokens).alias("n_tokens"))


def bisect(above: Callable[[float], bool], low: float, high: float, steps: int = STEPS) -> float:
    """The point between low (where ``above`` is false) and high at which it turns true."""
    for _ in range(steps):
        mid = (low + high) / 2
        if above(mid):
            high = mid
        else:
            low = mid
    return (low + high) / 2


def statistic(totals: DataFrame, budget: int | None = None) -> Callable[[float], tuple[float, float]]:
    """alpha -> (entropy of the weights in nats, largest number of times that a source is read within ``budget``; without
    a budget, when every source is read once at least)."""
    known = totals.where("n_tokens > 0").select("n_tokens").limit(DRIVER_SOURCES + 1).collect()
    if len(known) <= DRIVER_SOURCES:
        tokens = sorted(r["n_tokens"] for r in known)
        total = sum(tokens)

        def local(alpha: float) -> tuple[float, float]:
            powers = [(n / total) ** alpha for n in tokens]
            norm = math.fsum(powers)
            weights = [p / norm for p in powers]
            rates = [w * total / n for w, n in zip(weights, tokens, strict=True)]
            return -math.fsum(w * math.log(w) for w in weights if w > 0), max(rates) / min(rates) if budget is None else max(rates) * budget / total

        return local if tokens else lambda alpha: (0.0, 0.0)
    total = totals.agg(F.sum("n_tokens")).first()[0]
    share = F.col("n_tokens") / F.lit(total)

    def spread(alpha: float) -> tuple[float, float]:
        power = F.pow(share, F.lit(alpha))
        norm, mean, most, least = totals.where("n_tokens > 0").agg(F.sum(power), F.sum(power * F.log(power)), F.max(power / share), F.min(power / share)).first()
        return math.log(norm) - mean / norm, most / least if budget is None else most / norm * budget / total

    return spread


def exponent(totals: DataFrame, entropy_share: float | None = None, repetition: float | None = None, budget: int | None = None) -> float:
    """Alpha in [0, 1]. entropy_share: entropy to reach, as a share of the largest one (that of even weights);
    repetition: the most often that a source may be read."""
    if (entropy_share is None) == (repetition is None):
        raise ValueError("give a target entropy or a limit of repetitions")
    value = statistic(totals, budget)
    if entropy_share is not None:
        goal = entropy_share * value(0.0)[0]
        if value(1.0)[0] >= goal:
            return 1.0
        return round(bisect(lambda a: value(a)[0] < goal, 0.0, 1.0), DECIMALS)
    if value(0.0)[1] <= repetition:
        return 0.0
    return round(bisect(lambda a: value(a)[1] <= repetition, 0.0, 1.0), DECIMALS)


def budgets(totals: DataFrame, alpha: float, budget: int | None = None) -> DataFrame:
    """(source, n_docs, n_tokens, weight, budget tokens, full passes, rest). Without ``budget`` in all, it is the least
    with which every source is read once at least, so that no document is lost. Sources without tokens are read once."""
    totals = cut(totals)
    full = totals.agg(F.sum("n_tokens")).first()[0] or 0
    share = F.col("n_tokens") / F.lit(max(full, 1))
    power = F.when(F.col("n_tokens") > 0, F.pow(share, F.lit(alpha))).otherwise(0.0)
    norm, least = totals.agg(F.sum(power), F.max(F.when(F.col("n_tokens") > 0, F.col("n_tokens") / power))).first()
    scale = F.lit(float(least or 0)) * power if budget is None else power / F.lit(float(norm or 1)) * budget
    out = totals.withColumn("weight", power / F.lit(float(norm or 1))).withColumn("budget", F.round(scale).cast("long"))
    passes = F.when(F.col("n_tokens") > 0, F.floor(F.col("budget") / F.col("n_tokens"))).otherwise(1).cast("long")
    return out.withColumn("passes", passes).withColumn("rest", F.col("budget") - F.col("passes") * F.col("n_tokens"))


def key_of(epoch: Column, ident: Column, seed: str) -> Column:
    """A document's place in the permutation of an epoch."""
    return F.md5(F.concat_ws("|", F.lit(seed), epoch.cast("string"), ident).cast("binary"))


def ident(id_col: str, text_col: str) -> Column:
    """What a document's places are drawn by: its id, or without one a hash of its text."""
    return F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("null-"), F.md5(F.coalesce(text_col, F.lit("")).cast("binary"))))


def slim_rows(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(id, source ``_s``, ``_i``: see ``ident``, ``n``: tokens), computed in one scan of the text and kept."""
    return cut(docs.select(F.col(id_col), F.col(source_col).alias("_s"), ident(id_col, text_col).alias("_i"), word_count(F.col(text_col)).alias("n")))


def before(keyed: DataFrame) -> DataFrame:
    """Add ``before``: tokens ahead of each row in its (source, epoch)'s order of keys; rows of one key (repeated rows) follow one another, the
    shorter ones first. First by bucket, then within buckets, so that no task holds a source."""
    keyed = keyed.withColumn("_bucket", F.substring("key", 1, BUCKET_DIGITS))
    sums = keyed.groupBy("_s", "epoch", "_bucket").agg(F.sum("n").alias("_n"))
    ahead = Window.partitionBy("_s", "epoch").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("_s").alias("_s2"), F.col("epoch").alias("_e2"), F.col("_bucket").alias("_b2"), F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"))
    inside = Window.partitionBy("_s", "epoch", "_bucket").orderBy("key", "n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = keyed.withColumn("_in", F.sum("n").over(inside) - F.col("n"))
    same = rows["_s"].eqNullSafe(sums["_s2"]) & (rows["epoch"] == sums["_e2"]) & (rows["_bucket"] == sums["_b2"])
    return rows.join(sums, same).withColumn("before", F.col("_ahead") + F.col("_in")).drop("_s2", "_e2", "_b2", "_ahead", "_in", "_bucket")


def plan(slim: DataFrame, entropy_share: float | None = None, repetition: float | None = 1.25, budget: int | None = None, seed: str = "mix") -> DataFrame:
    """By source: alpha, weight, budget, passes, and ``last_key``: the last key of the head that is read once more (null: none).
    slim: see ``slim_rows``."""
    totals = source_tokens(slim, "_s", F.col("n"))
    totals = cut(totals)
    alpha = exponent(totals, entropy_share, None if entropy_share is not None else repetition, budget)
    shares = budgets(totals, alpha, budget)
    more = slim.join(held(shares.where("rest > 0").select(F.col("source").alias("_q"), "passes", "rest")), F.col("_s").eqNullSafe(F.col("_q")))
    head = before(more.withColumn("epoch", F.col("passes")).withColumn("key", key_of(F.col("epoch"), F.col("_i"), seed))).where("before < rest")
    last = head.groupBy("_s").agg(F.max("key").alias("last_key"))
    return shares.join(last, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s").withColumn("alpha", F.lit(alpha))


def epochs(seed: str, ident: Column) -> Column:
    """The epochs in which a row is read, beside its source's ``_passes`` and ``_last``."""
    more = F.coalesce(key_of(F.col("_passes"), ident, seed) <= F.col("_last"), F.lit(False)).cast("long")
    return F.filter(F.sequence(F.lit(0).cast("long"), F.col("_passes") + more), lambda e: e < F.col("_passes") + more)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix", epoch_col: str = "epoch", **options) -> DataFrame:
    """All columns of the documents and ``epoch_col``, a row for each time that a document is read.

    The head of the last pass ends with the document that reaches the budget. Documents without words are read with
    their keys' neighbours. A null id has places by its text; repeated rows stay together; a text of any length counts whole.
    Null is a source of its own; an empty table has no rows."""
    slim = slim_rows(docs, id_col, text_col, source_col)
    shares = held(plan(slim, seed=seed, **options).select(F.col("source").alias("_q"), F.col("passes").alias("_passes"), F.col("last_key").alias("_last")))
    rows = docs.join(shares, F.col(source_col).eqNullSafe(F.col("_q")))
    return rows.select(*[docs[c] for c in docs.columns], F.explode(epochs(seed, ident(id_col, text_col))).alias(epoch_col))


def mixed_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", blocks: int = 1000, seed: str = "mix", **options) -> DataFrame:
    """The mixture's rows with their places: doc id, source, n_tokens, epoch, ``before`` (tokens of its source ahead of it),
    ``block`` of the mixture (each holds every source by its weight), ``key`` (the order inside a source's epoch). The text is
    scanned once."""
    slim = slim_rows(docs, id_col, text_col, source_col)
    shares = plan(slim, seed=seed, **options)
    sizes = held(shares.select(F.col("source").alias("_q"), "budget", "n_tokens", F.col("passes").alias("_passes"), F.col("last_key").alias("_last")))
    rows = slim.join(sizes, F.col("_s").eqNullSafe(F.col("_q"))).withColumn("epoch", F.explode(epochs(seed, F.col("_i"))))
    rows = before(rows.withColumn("key", key_of(F.col("epoch"), F.col("_i"), seed)))
    start = F.col("epoch") * F.col("n_tokens") + F.col("before")
    block = F.when(F.col("budget") > 0, F.least(F.lit(blocks - 1).cast("long"), F.floor(start * F.lit(blocks) / F.col("budget")))).otherwise(0).cast("long")
    return rows.select(F.col(id_col), F.col("_s").alias("source"), F.col("n").alias("n_tokens"), "epoch", start.alias("before"), block.alias("block"), "key")
