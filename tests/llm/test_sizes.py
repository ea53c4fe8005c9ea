"""What a step holds, and how long it takes, beside its results."""

import glob
import os
import re
import time

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from topicloom.llm import blobs, licenses


def test_row_groups_of_blobs_hold_a_few_blocks(spark, tmp_path):
    frame = spark.range(40, numPartitions=1).select(F.col("id").alias("block"), F.lit(0).alias("part"), *[F.lit(os.urandom(1 << 20)).alias(c) for c in "ab"])
    blobs.save(frame, f"{tmp_path}/x")
    (file,) = glob.glob(f"{tmp_path}/x/*.parquet")
    meta = pq.ParquetFile(file).metadata
    assert max(meta.row_group(k).num_rows for k in range(meta.num_row_groups)) <= 8
    assert spark.read.parquet(f"{tmp_path}/x").count() == 40


def test_words_are_found_by_the_class_of_their_characters(spark):
    every = " ".join(f"x{chr(c)}y{chr(c)}" for c in range(0x3000) if not 0xD800 <= c < 0xE000) + " 😀 A\U0010ffffZ"
    frame = spark.createDataFrame([(every,)], "t string")
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in every)
    assert frame.select(licenses.words(F.col("t"))).first()[0] == re.findall(licenses.WORD, low)
    many = spark.range(8, numPartitions=2).select(F.repeat(F.concat(F.lit("some words of a text, "), F.col("id")), 40000).alias("t")).cache()
    many.count()

    def seconds(found):
        began = time.perf_counter()
        many.agg(F.sum(F.size(found))).collect()
        return time.perf_counter() - began

    negated = F.regexp_extract_all("t", F.lit(licenses.WORD), F.lit(0))
    assert min(seconds(licenses.words(F.col("t"))) for _ in range(3)) < min(seconds(negated) for _ in range(3))
