"""JSON lines with header lines in band, read by options; other inputs that become rows.

The readers of the tools that write these files differ in four ways, so each is an option:
what a bad line does, whether JSON values that aren't objects stay, which headers are
skipped, and where lines end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

HEADERS = ("_meta", "_manifest")


def split_lines(df: DataFrame, text: str = "value", unicode: bool = False) -> DataFrame:
    """(all other columns, ``pos`` from 0, ``line``) of a text column; blank lines are skipped.

    Lines end at line feeds; ``unicode`` adds U+0085, U+2028 and U+2029, which breaks records that hold them raw."""
    ends = r"\r\n|[\r\n\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}]" if unicode else r"\r\n|\n"
    others = [c for c in df.columns if c != text]
    return df.select(*others, F.posexplode(F.split(text, ends)).alias("pos", "line")).where(F.trim("line") != "")


def is_header(line: Column, flags: tuple[str, ...] = HEADERS) -> Column:
    """An object with a flag whose value counts as true."""
    found = F.lit(False)
    for flag in flags:
        value = F.get_json_object(line, f"$.{flag}")
        found = found | (value.isNotNull() & ~value.isin("false", "null", "0", "0.0", "", "[]", "{}"))
    return F.coalesce(found, F.lit(False))


def parse(lines: DataFrame, schema: str, flags: tuple[str, ...] = HEADERS, on_bad: str = "drop", non_dict: str = "drop", line: str = "line") -> DataFrame:
    """Rows of ``schema`` from a column of lines, beside their other columns.

    on_bad: 'drop', 'fail' (a bad line raises when it is read), or 'keep' (its fields are null and ``_corrupt`` holds it).
    non_dict: 'drop', 'fail', or 'keep' (as ``_value``, the JSON as text)."""
    value = F.try_parse_json(line)
    kind = F.when(value.isNull(), F.lit("bad")).when(F.schema_of_variant(value).startswith("OBJECT"), F.lit("dict")).otherwise(F.lit("other"))
    rows = lines.withColumn("_kind", kind).where(~((F.col("_kind") == "dict") & is_header(F.col(line), flags)))
    for wanted, name in ((on_bad, "bad"), (non_dict, "other")):
        if wanted == "drop":
            rows = rows.where(F.col("_kind") != name)
        elif wanted == "fail":
            rows = rows.where(F.when(F.col("_kind") == name, F.raise_error(F.concat(F.lit(f"{name} line: "), F.col(line))).cast("boolean")).otherwise(F.lit(True)))
    extra = []
    if on_bad == "keep":
        extra.append(F.when(F.col("_kind") == "bad", F.col(line)).alias("_corrupt"))
    if non_dict == "keep":
        extra.append(F.when(F.col("_kind") == "other", F.col(line)).alias("_value"))
    fields = F.from_json(F.col(line), F.lit(schema), {"mode": "PERMISSIVE"})
    others = [c for c in lines.columns if c != line]
    return rows.select(*others, *extra, F.when(F.col("_kind") == "dict", fields).alias("_r")).select(*others, *[c for c in ("_corrupt", "_value") if (c == "_corrupt" and on_bad == "keep") or (c == "_value" and non_dict == "keep")], "_r.*")


def bad_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """(all other columns, ``number`` from 1, the line) of lines that aren't JSON, as warnings name them."""
    rows = lines.withColumn("number", F.col("pos") + 1)
    return rows.where(F.try_parse_json(line).isNull())


def read_any(spark: SparkSession, path: str, schema: str, **options) -> DataFrame:
    """Rows of a file by its suffix: ``.jsonl`` and ``.ndjson`` (with or without ``.gz``) are JSON lines, anything else is one JSON
    document in any accepted form: stories, a list of objects or of URLs, ``{"urls": [...]}``, or one object."""
    if path.lower().removesuffix(".gz").endswith((".jsonl", ".ndjson")):
        return read(spark, path, schema, **options)
    return documents(spark.read.text(path, wholetext=True), schema)


def documents(texts: DataFrame, schema: str, text: str = "value") -> DataFrame:
    """(pos, fields of ``schema``) of JSON documents: objects are rows, strings are rows with that ``url`` alone; another form is an error."""
    value = F.col(text)
    inner = F.coalesce(F.get_json_object(value, "$.stories"), F.get_json_object(value, "$.urls"))
    start = F.substring(F.trim(value), 1, 1)
    listed = F.when(inner.isNotNull(), inner).when(start == "[", value).when(start == "{", F.concat(F.lit("["), value, F.lit("]"))).otherwise(F.raise_error(F.lit("input is neither a list nor an object")).cast("string"))
    rows = texts.select(F.posexplode(F.from_json(listed, "array<string>")).alias("pos", "_item"))
    record = F.when(F.substring(F.trim("_item"), 1, 1) == "{", F.col("_item")).otherwise(F.to_json(F.struct(F.col("_item").alias("url"))))
    return rows.select("pos", F.from_json(record, F.lit(schema)).alias("_r")).select("pos", "_r.*")


def as_maps(lines: DataFrame, line: str = "line") -> DataFrame:
    """Each object as a map of text, in which present nulls stay apart from missing keys."""
    return lines.withColumn("record", F.from_json(F.col(line), "map<string,string>"))


def read(spark: SparkSession, paths: str | list[str], schema: str, **options) -> DataFrame:
    """Rows of JSONL files with ``path`` and ``pos`` (the line's number in its file, from 0). Files of any size are split among tasks:
    a line's number is that in its block, after the lines of the file's earlier blocks."""
    return parse(numbered_lines(spark, paths), schema, **options)


def numbered_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, pos, line) of text files; lines end at line feeds, blank ones are skipped."""
    lines = spark.read.text(paths, lineSep="\n").select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"), "value")
    blocks = lines.groupBy("path", "_block").agg(F.count(F.lit(1)).alias("n"), F.min("_id").alias("_from"))
    ahead = Window.partitionBy("path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)  # a row for each block
    blocks = blocks.select("path", "_block", "_from", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("_ahead"))
    # a block is read by one task, one line after another
    found = lines.join(blocks, ["path", "_block"]).select("path", (F.col("_ahead") + F.col("_id") - F.col("_from")).cast("int").alias("pos"), F.regexp_replace("value", r"\r$", "").alias("line"))
    return found.where(F.trim("line") != "")


def read_large(spark: SparkSession, paths: str | list[str], schema: str, fail: bool = False) -> DataFrame:
    """Rows of JSONL files of any size, split among tasks, without positions."""
    found = spark.read.text(paths).select(F.col("value").alias("line")).where(F.trim("line") != "")
    return parse(found, schema, on_bad="fail" if fail else "drop")


def read_days(spark: SparkSession, root: str, name: str, schema: str, first: str | None = None, last: str | None = None, **options) -> DataFrame:
    """Files ``{root}/{day}/{name}`` of all days, or of those from ``first`` to ``last``, with ``day`` (folders that begin with an underscore
    are skipped); no files: no rows. Only folders of wanted days are looked into."""
    days = [d for d in days_collected(spark, root, name) if (first is None or d >= first) and (last is None or d <= last)]
    if not days:
        return spark.createDataFrame([], f"path string, pos int, {schema}, day string")
    return read(spark, [f"{root}/{d}/{name}" for d in days], schema, **options).withColumn("day", F.element_at(F.split("path", "/"), -2))


def write_day_table(df: DataFrame, root: str, day: str = "day", mode: str = "append") -> None:
    """JSON lines in a folder ``day=...`` for each day, as tables are read with their filters."""
    df.write.mode(mode).option("ignoreNullFields", "false").partitionBy(day).json(root)


def read_day_table(spark: SparkSession, root: str, schema: str, day: str = "day") -> DataFrame:
    """Rows with their day. A filter on the day leaves all other folders alone."""
    return spark.read.schema(f"{schema}, {day} date").json(root)


def days_collected(spark: SparkSession, root: str, name: str = "articles.jsonl") -> list[str]:
    """Sorted names of day folders that hold a file."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(root)
    store = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = store.globStatus(jvm.org.apache.hadoop.fs.Path(f"{root}/[^_]*/{name}")) if store.exists(folder) else None
    return sorted(s.getPath().getParent().getName() for s in found or [])


def first_header(lines: DataFrame, schema: str, flag: str = "_manifest", line: str = "line") -> DataFrame:
    """The first line as a header, if it is one."""
    return lines.where((F.col("pos") == 0) & is_header(F.col(line), (flag,))).select(F.from_json(F.col(line), F.lit(schema)).alias("_r")).select("_r.*")


def stories(documents: DataFrame, schema: str, text: str = "value") -> DataFrame:
    """Rows of a document ``{"stories": [...]}`` or of a bare list."""
    wrapped = F.get_json_object(F.col(text), "$.stories")
    items = F.from_json(F.coalesce(wrapped, F.col(text)), F.lit(f"array<struct<{', '.join(f.strip().replace(' ', ':', 1) for f in schema.split(','))}>>"))
    return documents.select(F.posexplode(items).alias("pos", "_r")).select("pos", "_r.*")


def normalised_urls(documents: DataFrame, text: str = "value") -> DataFrame:
    """(pos, url, record) of any accepted input: {"urls": [...]}, a list of strings or objects, or an object; else an error."""
    value = F.col(text)
    urls = F.get_json_object(value, "$.urls")
    start = F.substring(F.trim(value), 1, 1)
    items = F.when(urls.isNotNull(), F.from_json(urls, "array<string>")).when(start == "[", F.from_json(value, "array<string>")).when(start == "{", F.array(value)).otherwise(F.raise_error(F.lit("input is neither a list nor an object")).cast("array<string>"))
    rows = documents.select(F.posexplode(items).alias("pos", "item"))
    record = F.when(F.substring(F.trim("item"), 1, 1) == "{", F.col("item"))
    return rows.select("pos", F.when(record.isNull(), F.trim("item")).otherwise(first_url(record)).alias("url"), record.alias("record"))


def first_url(record: Column) -> Column:
    """The first of url, link and uri that isn't blank."""
    pick = [F.nullif(F.trim(F.get_json_object(record, f"$.{k}")), F.lit("")) for k in ("url", "link", "uri")]
    return F.coalesce(*pick)


def keys_of(lines: DataFrame, key: str, line: str = "line") -> DataFrame:
    """The distinct values of one key of all objects that can be read."""
    rows = parse(lines.select(line), f"{key} string", line=line)
    return rows.select(F.trim(key).alias(key)).where(F.col(key) != "").distinct()


def rss_items(documents: DataFrame, source: str = "source", xml: str = "xml") -> DataFrame:
    """Items of RSS documents with their feed and position; one item alone is a list of one."""
    from topicloom.schema import RSS_CHANNEL

    channel = F.from_xml(F.col(xml), RSS_CHANNEL)
    return documents.select(source, F.posexplode(channel["channel"]["item"]).alias("pos", "i")).select(source, "pos", "i.title", F.col("i.link").alias("url"), F.col("i.pubDate").alias("pub_date"), F.col("i.description").alias("summary"))
