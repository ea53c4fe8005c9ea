"""Counts, lengths, ranges, orders, heads and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicloom.functions.text import bar, falsy, inverted_digits, word_count


def count_by(df: DataFrame, key: Column, name: str, missing: str = "unknown") -> DataFrame:
    """(name, n); null is ``missing``."""
    return df.groupBy(F.coalesce(key, F.lit(missing)).alias(name)).agg(F.count(F.lit(1)).alias("n"))


def count_by_date(df: DataFrame, date: Column, prefix: bool = True) -> DataFrame:
    """Counts by day: the first ten characters, empty is unknown; or the value as it is."""
    key = falsy(F.substring(date, 1, 10), F.lit("unknown")) if prefix else F.coalesce(date, F.lit("unknown"))
    return count_by(df, key, "day")


def conditional_counts(df: DataFrame, **conditions: Column) -> DataFrame:
    """One row: all rows, and those that meet each condition."""
    return df.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in conditions.items()])


def length_stats(df: DataFrame, title: Column, description: Column) -> DataFrame:
    size = F.length(F.coalesce(description, F.lit("")))
    return df.agg(F.avg(size).alias("avg_description"), F.min(size).cast("long").alias("min_description"), F.max(size).cast("long").alias("max_description"), F.avg(F.length(F.coalesce(title, F.lit("")))).alias("avg_title"))


def outlet_words(df: DataFrame, outlet: Column, description: Column) -> DataFrame:
    return df.groupBy(outlet.alias("outlet")).agg(F.count(F.lit(1)).alias("n"), F.avg(word_count(description)).alias("mean_words"))


def date_range(df: DataFrame, day: Column) -> DataFrame:
    valid = F.when(F.regexp_like(day, F.lit(r"^\d{4}-\d{2}-\d{2}$")), day)
    return df.agg(F.min(valid).alias("first_day"), F.max(valid).alias("last_day"), F.count_distinct(valid).alias("n_days"), F.count(F.lit(1)).alias("n"))


def completeness(df: DataFrame, *columns: str) -> DataFrame:
    """How many rows lack each column (null or empty)."""
    return df.agg(*[F.count_if(F.coalesce(F.col(c).cast("string"), F.lit("")) == "").alias(f"no_{c}") for c in columns])


def publication_order(date: Column, url: Column) -> list[Column]:
    """Newest day first, then by MD5 of the URL; a missing day is last."""
    return [inverted_digits(F.coalesce(date, F.lit("0000-00-00"))), F.md5(F.coalesce(url, F.lit("")))]


def most_frequent(df: DataFrame, key: Column, name: str, top: int | None = None, pos: str | None = None) -> DataFrame:
    """Counts, the largest first; ties by key, or by first position. With ``top`` no full sort is made."""
    counts = df.groupBy(key.alias(name)).agg(F.count(F.lit(1)).alias("n"), *([F.min(pos).alias("_first")] if pos else []))
    ordered = counts.orderBy(F.desc("n"), "_first" if pos else name)
    return (ordered.limit(top) if top else ordered).drop("_first")


def top_and_more(df: DataFrame, key: Column, name: str, top: int) -> DataFrame:
    """(name, n, rank from 1) of the most frequent keys, and a last row ``+k more`` with the count of the k others, if there are any."""
    counts = df.groupBy(key.alias(name)).agg(F.count(F.lit(1)).alias("n"))
    head = counts.orderBy(F.desc("n"), name).limit(top)
    head = head.select(name, "n", F.row_number().over(Window.orderBy(F.desc("n"), name)).alias("rank"))  # top rows at most
    whole = counts.agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("all")).join(head.agg(F.sum("n").alias("shown")))
    rest = whole.where(F.col("k") > top).select(F.format_string("+%d more", F.col("k") - top).alias(name), (F.col("all") - F.col("shown")).alias("n"), F.lit(top + 1).alias("rank"))
    return head.unionByName(rest)


def day_order(day: Column) -> Column:
    """Order of days with 'unknown' first."""
    return F.when(day == "unknown", F.lit("0000-00-00")).otherwise(day)


def head(df: DataFrame, pos: str, n: int) -> DataFrame:
    return df.orderBy(pos).limit(n)


def head_by_group(df: DataFrame, group: str, pos: str, n: int) -> DataFrame:
    """The first n rows of each group. Ranks above n are dropped before the shuffle too, so that a large group stays small."""
    order = Window.partitionBy(group).orderBy(pos)
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def _chance(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(key).cast("string"), F.lit(""))))


def sample(df: DataFrame, n: int, key: str, seed: int = 0) -> DataFrame:
    """n random rows: those of the least hashes of seed and key, so a seed gives the same rows however they are partitioned. Tasks keep n rows
    each before these meet; samples of parts, put together and sampled again, are a sample of the whole. Rows of one key are taken by their
    other columns."""
    return df.orderBy(_chance(key, seed), *_others(df, key)).limit(n)


def sample_by(df: DataFrame, group: str, n: int, key: str, seed: int = 0) -> DataFrame:
    """n random rows of each group, in the same way."""
    order = Window.partitionBy(group).orderBy(_chance(key, seed), *_others(df, key))
    return df.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= n).drop("_rank")


def _others(df: DataFrame, key: str) -> list[str]:
    return [key, *[c for c, kind in df.dtypes if c != key and "map<" not in kind and "variant" not in kind]]


def positions_to_check(n: Column) -> Column:
    """Which of n revisions to look at, in order: all of five, else the first, the sixth and the last, of more than ten the first, the
    eleventh, the middle and the last."""
    n = n.cast("int")
    of_ten, of_more = F.array(F.lit(0), F.lit(5), n - 1), F.array(F.lit(0), F.lit(10), F.floor(n / 2).cast("int"), n - 1)
    every = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.array_sort(F.array_distinct(F.when(n > 10, of_more).when(n > 5, of_ten).otherwise(every)))


def histogram(counts: DataFrame, key: str, width: int = 40) -> DataFrame:
    """Counts with bars in proportion to the largest one, which is a row of its own, not a window over all rows."""
    largest = counts.agg(F.max("n").alias("_most"))
    return counts.join(F.broadcast(largest)).select(key, "n", bar(F.col("n"), F.col("_most"), width).alias("bar"))


def top_terms(df: DataFrame, text: Column, n: int) -> DataFrame:
    """The most frequent words of a text column."""
    terms = df.select(F.explode(F.filter(F.split(F.lower(text), r"\W+"), lambda t: t != "")).alias("term"))
    return most_frequent(terms, F.col("term"), "term", n)
