"""Which keys stand in which texts, when both are rows: a join by n-grams in place of a comparison of all pairs.

Every key is known by one of its n-grams, the one that the fewest texts have. A text with the key has this n-gram, so keys and texts
are joined on it, and the pairs found are verified.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters of an n-gram; shorter keys are n-grams themselves.
SIZE = 4
#: Bytes of keys that are sent to all tasks, and what a key takes beside its letters.
SENT, ROW = 8 << 20, 64


def _grams(text: Column, size: int) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=({'.' * size}))"), 1))


def contained(texts: DataFrame, keys: DataFrame, id_col: str, text_col: str, key_col: str, size: int = SIZE, sent: int = SENT) -> DataFrame:
    """(id, key) of all pairs where the text holds the key, as it is written. Keys count once, empty and null ones not at all; of
    rows with one id and text there is one result.

    Keys of up to ``sent`` bytes go to the texts' tasks; with more, n-grams are joined without their texts, and texts come in once to verify."""
    wanted = keys.where(F.col(key_col) != "").select(F.col(key_col).alias("_key")).distinct()
    sizes, weight = wanted.agg(F.collect_set(F.least(F.length("_key"), F.lit(size))), F.sum(F.octet_length("_key") + ROW)).first()  # at most ``size`` numbers
    if not sizes:
        return texts.select(F.col(id_col).alias(id_col), F.lit("").alias(key_col)).limit(0)
    small = weight <= sent
    put = F.broadcast if small else (lambda df: df)
    source = texts.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    places = F.explode(F.concat(*[_grams(F.col("_text"), n) for n in sorted(sizes)])).alias("_gram")
    every = None
    for n in sorted(sizes):
        own = wanted.where(F.length("_key") >= size if n == size else F.length("_key") == n).select("_key", F.explode(_grams(F.col("_key"), n)).alias("_gram"))
        every = own if every is None else every.unionByName(own)
    common = source.select(places).join(put(every.select("_gram").distinct()), "_gram", "left_semi").groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    rarest = every.join(common, "_gram", "left").groupBy("_key").agg(F.min_by("_gram", F.struct(F.coalesce("_n", F.lit(0)), "_gram")).alias("_gram"))
    if small:
        pairs = source.select("_id", "_text", places).join(F.broadcast(rarest), "_gram")
    else:
        source = source.withColumn("_row", F.xxhash64("_id", "_text"))  # of rows with one hash each is verified by its own text
        pairs = source.join(source.select("_row", places).join(rarest, "_gram").select("_row", "_key").distinct(), "_row")
    return pairs.where(F.contains("_text", F.col("_key"))).select(F.col("_id").alias(id_col), F.col("_key").alias(key_col)).distinct()
