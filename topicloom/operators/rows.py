"""Which rows stay: deduplication, lookups, merges, anti-joins, and the account of dropped rows.

Winners are found by a grouped minimum or maximum of whole rows by position: one scan and
one shuffle, combined before it, so a key that holds a large share of all rows doesn't land
in one task. Of rows with one position the least (first wins) or largest (last wins) counts, so
results don't depend on the order of tasks. Select the columns that are needed before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from topicloom.functions.text import sha256_id


def present(key: Column) -> Column:
    return F.coalesce(key, F.lit("")) != ""


def _winner(df: DataFrame, key: str, pos: str, pick) -> DataFrame:
    others = [c for c in df.columns if c != key]
    ties = [c for c, kind in df.dtypes if c not in (key, pos) and "map<" not in kind and "variant" not in kind]
    best = df.groupBy(key).agg(pick(F.struct(*others), F.struct(pos, *ties)).alias("_row"))
    return best.select(*[F.col(key) if c == key else F.col("_row")[c].alias(c) for c in df.columns])


def _spread(df: DataFrame, key: str) -> Column:
    """A join key that equals ``key``, and for rows without one is their own, so that these don't meet in one task."""
    others = [c for c, kind in df.dtypes if c != key and "map<" not in kind and "variant" not in kind]
    return F.when(present(F.col(key).cast("string")), F.col(key).cast("string")).otherwise(F.concat(F.lit("\0"), F.xxhash64(*others).cast("string")))


def _apart(df: DataFrame, key: str) -> DataFrame:
    """The rows with ``_lk``, the key as text; a row without one has a text that no key is."""
    return df.withColumn("_lk", F.when(F.col(key).cast("string") == "", F.lit("")).otherwise(_spread(df, key)))


def first_wins(df: DataFrame, key: str, pos: str, blank: bool = False) -> DataFrame:
    """The first row of each key; rows without a key are dropped unless ``blank``."""
    return _winner(df if blank else df.where(present(F.col(key))), key, pos, F.min_by)


def last_wins(df: DataFrame, key: str, pos: str) -> DataFrame:
    """The last row of each key; a missing (null) key has no row."""
    return _winner(df.where(F.col(key).isNotNull()), key, pos, F.max_by)


def distinct_in_order(df: DataFrame, key: str, pos: str) -> DataFrame:
    """(key, first position) of each key that isn't blank."""
    return df.where(present(F.col(key))).groupBy(key).agg(F.min(pos).alias("first_pos"))


def unseen(new: DataFrame, store: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't in the store; null is a key like others, but rows with it aren't gathered: one row tells whether
    the store has it."""
    seen = store.select(F.col(key).cast("string").alias("_seen")).where("_seen is not null").distinct()
    fresh = _apart(new, key).join(seen, F.col("_lk") == seen["_seen"], "left_anti").drop("_lk")
    null = store.where(F.col(key).isNull()).select(F.lit(True).alias("_null")).limit(1)
    return fresh.join(F.broadcast(null), F.col(key).isNull() & F.col("_null"), "left_anti")


def append_unseen(store: DataFrame, new: DataFrame, key: str, dedupe_pos: str | None = None) -> DataFrame:
    """The store, then the unseen rows. These aren't deduplicated among themselves unless a position is named."""
    fresh = unseen(new, store, key)
    return store.unionByName(first_wins(fresh, key, dedupe_pos, blank=True) if dedupe_pos else fresh, allowMissingColumns=True)


def accepted_first(df: DataFrame, passes: Column, key: str, pos: str, existing: DataFrame | None = None) -> DataFrame:
    """Of each key the first row that passes, unless the key is in the existing output."""
    kept = first_wins(df.where(passes), key, pos)
    return kept if existing is None else unseen(kept, existing, key)


def _looked_up(left: DataFrame, right: DataFrame, key: str, pos: str, columns: list[str]) -> DataFrame:
    """Left rows with ``_found`` and ``_r_`` columns of the last right row of their key. An empty key is one like others."""
    index = last_wins(right, key, pos).select(F.col(key).cast("string").alias("_rk"), F.lit(True).alias("_found"), *[F.col(c).alias(f"_r_{c}") for c in columns])
    return _apart(left, key).join(index, F.col("_lk") == index["_rk"], "left").drop("_lk", "_rk")


def lookup(left: DataFrame, right: DataFrame, key: str, pos: str, columns: list[str], override: bool = False) -> DataFrame:
    """Left rows with ``columns`` of the last right row of their key; override: right values count even where they are null."""
    joined = _looked_up(left, right, key, pos, columns)
    found = F.coalesce("_found", F.lit(False))
    merged = [F.when(found, F.col(f"_r_{c}")).otherwise(F.col(c) if c in left.columns else F.lit(None)).alias(c) if override or c not in left.columns else F.col(c) for c in columns]
    return joined.select(*[left[c] for c in left.columns if c not in columns], *merged)


def missing(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left rows that a lookup wouldn't find."""
    keys = right.select(F.col(key).cast("string").alias("_seen")).where("_seen is not null").distinct()
    return _apart(left, key).join(keys, F.col("_lk") == keys["_seen"], "left_anti").drop("_lk")


def checked_lookup(left: DataFrame, right: DataFrame, key: str, pos: str, columns: list[str]) -> DataFrame:
    """A lookup, in one join, that raises when a left row without a match is read."""
    joined = _looked_up(left, right, key, pos, columns)
    failed = F.raise_error(F.concat(F.lit("IntegrityError: a row without a match, "), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    joined = joined.where(F.when(F.col("_found"), F.lit(True)).otherwise(failed.cast("boolean")))
    return joined.select(*[left[c] for c in left.columns if c not in columns], *[F.col(f"_r_{c}").alias(c) for c in columns])


def merge_maps(*maps: Column) -> Column:
    """Records as maps, later ones win, even with null. Needs spark.sql.mapKeyDedupPolicy=LAST_WIN."""
    return F.map_concat(*maps)


def duplicate_report(df: DataFrame, key: str, top: int = 5) -> DataFrame:
    """Keys that occur twice or more, the most frequent first, ties by key."""
    counts = df.where(present(F.col(key))).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return counts.orderBy(F.desc("n"), key).limit(top)


def filter_reasons(df: DataFrame, url: str, pos: str, success: Column, indexed: Column, english: Column, broad: Column, strict: Column, existing: Column | None = None) -> DataFrame:
    """Add ``reason``: each row is charged to the first stage that stops it, or is added.

    A row is "already_exists" if an earlier row of its URL was accepted, or if ``existing`` says that the output has it."""
    flags = {"_ok": success, "_in": indexed, "_en": english, "_broad": broad, "_strict": strict, "_old": F.lit(False) if existing is None else existing}
    df = df.withColumns({k: F.coalesce(v, F.lit(False)) for k, v in flags.items()})
    passes = F.col("_ok") & present(F.col(url)) & ~F.col("_old") & F.col("_in") & F.col("_en") & F.col("_broad") & F.col("_strict")
    first = df.where(passes).groupBy(F.col(url).alias("_u")).agg(F.min(pos).alias("_first"))
    df = df.withColumn("_lk", F.when(present(F.col(url)), F.col(url)).otherwise(F.concat(F.lit("\0"), F.col(pos).cast("string"))))
    df = df.join(first, df["_lk"] == first["_u"], "left").drop("_lk")
    reason = (
        F.when(~F.col("_ok"), "not_success")
        .when(~present(F.col(url)), "missing_url")
        .when(F.col("_old") | (F.col(pos) > F.col("_first")), "already_exists")
        .when(~F.col("_in"), "missing_in_index")
        .when(~F.col("_en"), "non_english")
        .when(~F.col("_broad"), "off_topic")
        .when(~F.col("_strict"), "not_relevant")
        .otherwise("added")
    )
    return df.withColumn("reason", reason).drop(*flags, "_u", "_first")


def waterfall(reasons: DataFrame) -> DataFrame:
    return reasons.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


REASONS = ("added", "not_success", "missing_url", "already_exists", "missing_in_index", "non_english", "off_topic", "not_relevant")


def counted(reasons: DataFrame) -> tuple[DataFrame, Observation]:
    """The same rows, and what counts them by ``reason`` while they are written: no job of its own. Its ``get`` waits for that."""
    seen = Observation()
    return reasons.observe(seen, *[F.count_if(F.col("reason") == r).alias(r) for r in REASONS]), seen


def counters(spark: SparkSession, seen: Observation) -> DataFrame:
    """(reason, n) of what was counted, reasons that occurred only."""
    return spark.createDataFrame([(r, n) for r, n in seen.get.items() if n], "reason string, n long")


def recover(current: DataFrame, recovered: DataFrame, key: str, pos: str) -> DataFrame:
    """Current rows, then recovered ones, the first of each key; ``src`` tells them apart."""
    both = current.withColumn("src", F.lit(0)).unionByName(recovered.withColumn("src", F.lit(1)), allowMissingColumns=True)
    ranked = both.withColumn("_order", F.struct("src", pos))
    return first_wins(ranked, key, "_order").drop("_order")


def enrich(records: DataFrame, scraped: DataFrame, key: str, pos: str, columns: list[str]) -> DataFrame:
    """Records with scraped fields over their own; one without a URL is kept as a failure."""
    merged = lookup(records, scraped, key, pos, columns, override=True)
    blank = ~present(F.col(key))
    if "success" in merged.columns:
        merged = merged.withColumn("success", F.when(blank, F.lit(False)).otherwise(F.col("success")))
    return merged.withColumn("error", F.when(blank, F.lit("missing url")).otherwise(F.col("error") if "error" in merged.columns else F.lit(None).cast("string")))


def pending(urls: DataFrame, done: DataFrame, key: str, retry_failed: bool = False) -> DataFrame:
    """URLs not scraped yet; failed ones count as done unless they are to be tried again."""
    if retry_failed:
        done = done.where(F.coalesce("success", F.lit(False)))
    return unseen(urls, done, key)


def store_record(stories: DataFrame, collected_at: str) -> DataFrame:
    """A feed's stories (domain, publish_date, title, url, summary) as records of the store, with all of their columns."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    none = F.lit(None).cast("string")
    return stories.select(
        sha256_id(F.col("url")).alias("id"),
        none.alias("indexed_date"),
        F.lit("en").alias("language"),
        text("domain").alias("media_name"),
        text("domain").alias("media_url"),
        "publish_date",
        text("title").alias("title"),
        text("url").alias("url"),
        text("summary").alias("description"),
        F.lit("rss").alias("collected_with"),
        F.lit(collected_at).alias("collected_at"),
        text("url").alias("final_url"),
        F.lit(None).cast("int").alias("http_status"),
        F.lit(True).alias("success"),
        none.alias("error"),
        none.alias("scraped_at"),
    )
