"""The corpus pipeline: documents to token records.

Language ID, SimHash near-dedup, benchmark decontamination, mixing of sources, token-ID output.
Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read
again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.llm import decontaminate, language, mixing, records, simhash
from topicloom.llm.common import remove_path, shared_path, table

#: Columns of documents; what other columns a stage is given goes on too.
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


#: Least probability of the language that a document is taken to be in.
SURE = 0.6


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or in no one language to the model (its probability is under SURE), go; ``lang`` of the others is
    what the model says, in place of what is missing or wrong."""
    model = language.fit(docs.where(~language.held_out()))
    found = language.predict(docs, model, add=("_lang", "_odds")).where((F.col("_lang") != language.UNDETERMINED) & (F.col("_odds") >= SURE))
    return found.withColumn("lang", F.col("_lang")).select(*docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: shingles of five words, fingerprints up to 14 bits apart."""
    return simhash.drop_near_duplicates(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; those of smaller sources are repeated to meet the weights."""
    return mixing.mix(docs, epoch_col="_epoch").drop("_epoch")


def records_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token records in the shared folder; the result is their index, with each document's digest."""
    return records.encoded(docs)


STAGES = [
    ("language_id", language_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontaminate_stage),
    ("mixing", mix_stage),
    ("token_records", records_stage),
]

#: Language ID, bit-sliced linking and the tokenizer aren't SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        out = shared_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(out)
        if path:
            remove_path(spark, path)
        docs, path = spark.read.parquet(out), out
    return docs
