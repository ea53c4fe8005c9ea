"""The driver's tables seen as the engine's: articles, listings, clean output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.functions import text as T
from topicloom.operators import rows, summary

#: Topics of the registered queries: broad, excluded, and strict keywords.
TOPICS = {
    "a": {"broad": ["ionth", "estion", "license", "thenan"], "exclude": ["tokenx"], "strict": ["ionth", "estion", "thenan"]},
    "b": {"broad": ["thation", "ingthe"], "exclude": [], "strict": ["thation", "ingthe"]},
}


def topic(name: str, topics: dict = TOPICS) -> dict:
    """The settings of one topic, with its name among them; ValueError for a name that has none."""
    try:
        return {**topics[name], "name": name}
    except KeyError:
        raise ValueError(f"no settings for topic {name!r}; there are {sorted(topics)}") from None


def active(wanted: list[str] | None, known: dict) -> tuple[dict, list[str]]:
    """The settings that are wanted, in their order (all if none are named), and the wanted names that are unknown."""
    names = list(known) if not wanted else wanted
    return {n: known[n] for n in names if n in known}, [n for n in names if n not in known]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as articles: the first line is the title, the rest the description, the source the outlet."""
    cut = F.instr("text", "\n")
    return read(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("pos"),
        F.concat(F.lit("https://www."), F.col("source"), F.lit(".example/"), F.md5("text")).alias("url"),
        F.when(cut > 0, F.expr("substring(text, 1, instr(text, '\n') - 1)")).otherwise(F.col("text")).alias("title"),
        F.when(cut > 0, F.expr("substring(text, instr(text, '\n') + 1)")).otherwise(F.lit("")).alias("description"),
        F.col("lang").alias("language"),
        F.col("source").alias("media_url"),
        F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 30).cast("int")), "yyyy-MM-dd").alias("publish_date"),
    )


def clean(found: DataFrame, name: str) -> DataFrame:
    """A topic's clean articles: English, broad match, description cut, strict match, first accepted of each URL."""
    t = TOPICS[name]
    broad = T.broad_match(t["broad"], t["exclude"], F.col("title"), F.col("description"))
    english = F.lower(F.coalesce("language", F.lit(""))) == "en"
    kept = found.where(english & broad).withColumn("description", T.truncate_words(F.col("description")))
    kept = kept.where(T.strict_match(t["strict"], F.col("title"), F.col("description")))
    return rows.first_wins(kept, "url", "pos").withColumn("my_topic", F.lit(name))


def ranked(kept: DataFrame) -> DataFrame:
    """Published columns, with the two columns that publication is ordered by."""
    day, link = summary.publication_order(F.col("publish_date"), F.col("url"))
    return kept.select("media_url", "title", "description", "publish_date", "url", "my_topic", day.alias("order_day"), link.alias("order_url"))
