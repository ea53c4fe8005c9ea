"""License scans by diagonal voting, in DataFrame functions only.

All rolling word trigrams of the documents are hashed and joined to the trigrams of license
notices. A match votes for its diagonal (document position less template position). Votes
of neighbouring diagonals are merged, so that a word more or less doesn't part a notice,
and a span is verified by the share of its template's trigrams, each counted once, that stand there word by
word. Templates are sentences and paragraphs of notices and license texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from topicloom.llm.license_texts import NOTICES

#: Phrases of the base rules, and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same characters, named: Java's expressions take several times as long for the class of all but some.
SAME = r"[0-9a-z\x{80}-\x{10FFFF}]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
K = 3
#: Diagonals so far apart are neighbours; a span holds this share of its template's trigrams at least.
SLACK, SHARE = 2, 0.6


def words(text: Column) -> Column:
    """Words of a text after lower-casing A-Z; null has none."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(SAME), F.lit(0))


def trigrams(words: Column) -> Column:
    """Structs (a, b, c) of consecutive words; the last two lack words."""
    n = F.size(words)
    rest = lambda k: F.slice(words, F.lit(k + 1), F.greatest(n - k, F.lit(0)))
    return F.arrays_zip(words.alias("a"), rest(1).alias("b"), rest(2).alias("c"))


def template_grams(spark: SparkSession, templates=NOTICES) -> DataFrame:
    """(template, label, total trigrams, position, hash, words) of the templates."""
    base = spark.createDataFrame([(i, label, text) for i, (label, text) in enumerate(templates)], "template int, label string, text string")
    split = base.select("template", "label", words(F.col("text")).alias("w"))
    grams = split.select("template", "label", (F.size("w") - (K - 1)).cast("long").alias("total"), F.posexplode(trigrams(F.col("w"))).alias("at", "g"))
    return grams.where("g.c is not null").select("template", "label", "total", F.col("at").alias("t_at"), F.xxhash64("g.a", "g.b", "g.c").alias("h"), F.col("g").alias("t_g"))


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=NOTICES) -> DataFrame:
    """Verified spans: ``_id``, ``_th`` (hash of the text), template, label, first and last word (from 0), votes, share.

    Equal rows have their spans once. The template table is a constant of some 2,000 rows, so it is broadcast;
    only matches leave a scan's task. A text of any length is scanned whole, as an array of its words."""
    source = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_th"), words(F.col(text_col)).alias("w"))
    grams = source.select("_id", "_th", F.posexplode(trigrams(F.col("w"))).alias("at", "g")).where("g.c is not null")
    known = F.broadcast(template_grams(docs.sparkSession, templates))
    hits = grams.withColumn("h", F.xxhash64("g.a", "g.b", "g.c")).join(known, "h").where("g = t_g")
    votes = hits.groupBy("_id", "_th", "template", "label", "total", (F.col("at") - F.col("t_at")).alias("diagonal")).agg(
        F.collect_set("at").alias("places"))  # a diagonal has at most a vote for each trigram of its template
    in_order = Window.partitionBy("_id", "_th", "template").orderBy("diagonal")
    new = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(in_order) > SLACK).cast("int"), F.lit(1))
    runs = votes.withColumn("new", new).withColumn("run", F.sum("new").over(in_order))
    place = runs.select("_id", "_th", "template", "label", "total", "run", "diagonal", F.explode("places").alias("at"))
    voted = F.size(F.collect_set(F.col("at") - F.col("diagonal"))).cast("long")  # positions in the template
    merged = place.groupBy("_id", "_th", "template", "label", "total", "run").agg(voted.alias("votes"), F.min("at").alias("first"), (F.max("at") + (K - 1)).alias("last"))
    share = F.col("votes") / F.col("total")
    return merged.withColumn("share", share).where(F.col("share") >= SHARE).drop("run", "total")


def phrase_places(words: Column, phrase: str) -> Column:
    """Positions (from 0) at which the words of a phrase stand consecutively."""
    parts = phrase.split()
    match = lambda i: _all([F.get(words, i + k) == F.lit(p) for k, p in enumerate(parts)])
    return F.filter(F.sequence(F.lit(0), F.greatest(F.size(words) - len(parts), F.lit(0))), lambda i: F.coalesce(match(i), F.lit(False)))


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def base_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=PHRASES) -> DataFrame:
    """A row for each document: ``_id``, ``_th``, n_words, places of each phrase. Only texts that hold the phrases' common last word look for places."""
    source = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_th"), words(F.col(text_col)).alias("w"))
    none = F.array().cast("array<int>")
    some = F.array_contains("w", phrases[0][0].split()[-1])
    places = [F.when(some, phrase_places(F.col("w"), p)).otherwise(none).alias(f"p{k}") for k, (p, _) in enumerate(phrases)]
    return source.select("_id", "_th", F.size("w").cast("long").alias("n_words"), *places)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_id``, n_words, n_base, first_word, last_word, base_labels, labels, score (the best span's share, times v / (v + 1) for
    its v votes: one trigram proves less than twenty).

    Null and wordless texts have no words, labels or places (null), and score 0. Every row has a row, repeated ones too."""
    found = spans(docs, id_col, text_col).groupBy("_id", "_th").agg(F.collect_set("label").alias("found"), F.max(F.col("share") * (F.col("votes") / (F.col("votes") + 1))).alias("share"))
    found = found.select(F.col("_id").alias("_i"), F.col("_th").alias("_t"), "found", "share")
    base = base_counts(docs, id_col, text_col)
    rows = base.join(found, base["_id"].eqNullSafe(found["_i"]) & (base["_th"] == found["_t"]), "left")
    columns = [f"p{k}" for k in range(len(PHRASES))]
    every = F.concat(*columns)
    labels = F.filter(F.array(*[F.when(F.size(c) > 0, F.lit(label)) for c, (_, label) in zip(columns, PHRASES, strict=True)]), lambda x: x.isNotNull())
    labels = F.array_sort(F.array_distinct(labels))
    both = F.array_sort(F.array_union(labels, F.coalesce("found", F.array().cast("array<string>"))))
    return rows.select(
        "_id",
        "n_words",
        F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"),
        F.array_max(every).cast("long").alias("last_word"),
        F.array_join(labels, ",").alias("base_labels"),
        F.array_join(both, ",").alias("labels"),
        F.coalesce("share", F.lit(0.0)).alias("score"),
    )


def template_rows() -> str:
    """The templates as SQL values."""
    return ", ".join("({}, '{}', '{}')".format(i, label, text.replace("'", "''")) for i, (label, text) in enumerate(NOTICES))


SQL = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents),
templates AS (SELECT t, label, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM (VALUES {template_rows()}) AS v(t, label, text)),
tgrams AS (SELECT t, label, len(w) - 2 AS total, i AS pos, w[i+1] AS a, w[i+2] AS b, w[i+3] AS c FROM templates, unnest(range(len(w) - 2)) AS u(i)),
dgrams AS (SELECT r, i AS pos, w[i+1] AS a, w[i+2] AS b, w[i+3] AS c FROM docs, unnest(range(len(w) - 2)) AS u(i)),
votes AS (SELECT DISTINCT r, t, label, total, d.pos, d.pos - g.pos AS diagonal FROM dgrams d JOIN tgrams g USING (a, b, c)),
diagonals AS (SELECT DISTINCT r, t, diagonal FROM votes),
starts AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY r, t ORDER BY diagonal) <= {SLACK} THEN 0 ELSE 1 END AS brk FROM diagonals),
runs AS (SELECT *, sum(brk) OVER (PARTITION BY r, t ORDER BY diagonal) AS run FROM starts),
spans AS (SELECT r, label, count(DISTINCT pos - diagonal) AS n, count(DISTINCT pos - diagonal) / total::DOUBLE AS share FROM votes JOIN runs USING (r, t, diagonal) GROUP BY r, t, label, total, run),
found AS (SELECT r, list(DISTINCT label) AS found, max(share * (n / (n + 1)::DOUBLE)) AS share FROM spans WHERE share >= {SHARE} GROUP BY r),
places AS (SELECT r, i AS pos, CASE WHEN w[i+1] = 'mit' THEN 'mit' WHEN w[i+1] = 'apache' THEN 'apache' ELSE 'gpl' END AS label FROM docs, unnest(range(len(w))) AS u(i)
  WHERE (w[i+1] IN ('mit', 'apache') AND w[i+2] = 'license') OR (w[i+1] = 'general' AND w[i+2] = 'public' AND w[i+3] = 'license')),
base AS (SELECT r, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, list(DISTINCT label) AS labels FROM places GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(array_to_string(list_sort(labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(labels, []), coalesce(found, [])))), ','), '') AS labels,
  coalesce(share, 0.0)::DOUBLE AS score
FROM docs LEFT JOIN found USING (r) LEFT JOIN base USING (r)
"""
