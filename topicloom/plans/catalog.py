"""Registered queries over the driver's tables, one or more for each group of operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from topicloom.functions import dates as D
from topicloom.functions import text as T
from topicloom.functions import udf
from topicloom.operators import coverage, diffs, languages, rows, summary, within
from topicloom.plans.articles import TOPICS, articles, clean, ranked, read
from topicloom.sources import commits, jsonl, sinks
from topicloom.streaming import collection, store

LONG = "long"
THIN = "NOT (event_type = 'click' AND day(ts) IN (3, 4, 17)) AND NOT day(ts) = 20"


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return articles(spark, sf_dir).join(read(spark, sf_dir, "labels").select(F.col("doc_id").alias("pos"), "quality", "toxic"), "pos", "left")


def days_of(spark: SparkSession, sf_dir: str, gaps: bool = True) -> DataFrame:
    """events as rows by (day, outlet); with gaps, without some days."""
    return read(spark, sf_dir, "events").where(THIN if gaps else "true").select("event_id", F.to_date("ts").alias("day"), F.col("event_type").alias("outlet"), "ts", "user_id", "value")


def topic_clean(spark, sf_dir):
    return ranked(clean(articles(spark, sf_dir), "a"))


def topic_loose_any(spark, sf_dir):
    every = sorted({k for t in TOPICS.values() for k in t["broad"]})
    return articles(spark, sf_dir).where(T.loose_match(every, F.col("title"), F.col("description"))).select("pos", "url")


def topic_multi_counts(spark, sf_dir):
    low = {"_title": T.text_of(F.col("title")), "_body": T.text_of(F.col("description")), "_both": T.text_of(F.col("title"), F.col("description"))}
    found = articles(spark, sf_dir).select("media_url", "language", *[c.alias(n) for n, c in low.items()])  # in lower case once, for all topics
    columns = []
    for name, t in TOPICS.items():
        loose = T.holds_any(t["broad"], F.col("_both"))
        strict = T.strict_in(t["strict"], F.col("_title"), F.col("_body"))
        kept = loose & strict & ~F.coalesce("media_url", F.lit("")).isin("src3") & (F.col("language") == "en")
        columns += [F.struct(F.lit(name).alias("topic"), *[c.cast("int").alias(n) for n, c in (("loose", loose), ("strict", loose & strict), ("kept", kept))])]
    flat = found.select(F.inline(F.array(*columns)))
    return flat.groupBy("topic").agg(*[F.sum(c).alias(f"n_{c}") for c in ("loose", "strict", "kept")])


def strict_title_only(spark, sf_dir):
    """Strict matching as built: the body isn't read for the loose match, so titles alone decide."""
    found = articles(spark, sf_dir)
    loose = T.loose_match(TOPICS["a"]["strict"], F.col("title"))
    return found.where(loose & T.strict_match(TOPICS["a"]["strict"], F.col("title"), F.col("description"))).select("pos", "url")


def strict_documented(spark, sf_dir):
    """Strict matching as documented: in the title, or twice in the body."""
    return articles(spark, sf_dir).where(T.strict_match(TOPICS["a"]["strict"], F.col("title"), F.col("description"))).select("pos", "url")


def dedupe_first_wins(spark, sf_dir):
    return rows.first_wins(articles(spark, sf_dir).select("pos", "url"), "url", "pos")


def dedupe_after_filter(spark, sf_dir):
    """English articles not by an outlet that is published already."""
    found = articles(spark, sf_dir).select("pos", "url", "language", "media_url")
    existing = found.where("media_url = 'src0'").select("url")
    return rows.accepted_first(found, F.col("language") == "en", "url", "pos", existing).select("pos", "url")


def distinct_urls(spark, sf_dir):
    return rows.distinct_in_order(articles(spark, sf_dir), "url", "pos")


def lookup_last_wins(spark, sf_dir):
    """Articles with the day of the last listing of their URL."""
    found = articles(spark, sf_dir)
    listing = found.where("language <> 'fr'").select("pos", "url", F.col("publish_date").alias("listed"), F.col("pos").alias("listing"))
    return rows.lookup(found.select("pos", "url"), listing, "url", "pos", ["listed", "listing"])


def integrity_missing(spark, sf_dir):
    labels = read(spark, sf_dir, "labels").select(F.col("doc_id").alias("pos"))
    return rows.missing(articles(spark, sf_dir).select("pos", "url"), labels, "pos")


def anti_new_records(spark, sf_dir):
    found = articles(spark, sf_dir).select("pos", "url", "title")
    return rows.append_unseen(found.where("pos % 2 = 0"), found.where("pos % 2 = 1"), "url")


def merge_override(spark, sf_dir):
    """Articles with labels over their own columns: the label side counts even where it is null."""
    found = articles(spark, sf_dir).select("pos", F.col("language").alias("quality_text"), "media_url")
    right = read(spark, sf_dir, "labels").select(F.col("doc_id").alias("pos"), F.when(F.col("quality") == 1, F.lit("good")).alias("quality_text"))
    return rows.lookup(found, right.withColumn("rpos", F.lit(0)), "pos", "rpos", ["quality_text"], override=True)


def filter_waterfall(spark, sf_dir):
    return rows.waterfall(_reasons(spark, sf_dir))


def filter_reasons(spark, sf_dir):
    return _reasons(spark, sf_dir).select("pos", "reason")


def _reasons(spark, sf_dir):
    t = TOPICS["a"]
    found = labelled(spark, sf_dir).withColumn("url", F.when(F.col("pos") % 23 == 5, F.lit("")).otherwise(F.col("url")))
    body = T.truncate_words(F.col("description"))
    return rows.filter_reasons(
        found, "url", "pos",
        success=F.coalesce(F.col("quality") == 1, F.col("pos") % 2 == 0),
        indexed=F.col("pos") % 7 != 0,
        english=F.lower(F.coalesce("language", F.lit(""))) == "en",
        broad=T.broad_match([*t["broad"], "ation"], t["exclude"], F.col("title"), F.col("description")),
        strict=T.strict_match([*t["strict"], "ation"], F.col("title"), body),
    )


def outlet_counts(spark, sf_dir):
    return summary.count_by(articles(spark, sf_dir), F.nullif("media_url", F.lit("src3")), "outlet")


def date_counts(spark, sf_dir):
    return summary.count_by_date(read(spark, sf_dir, "events"), F.when(F.col("user_id") % 11 != 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).otherwise(""))


def conditional_counts(spark, sf_dir):
    found = labelled(spark, sf_dir)
    topic = T.broad_match(TOPICS["a"]["broad"], None, F.col("title"), F.col("description"))
    return summary.conditional_counts(found, success=F.col("quality") == 1, english=F.col("language") == "en", other=F.col("language") != "en", on_topic=topic)


def length_stats(spark, sf_dir):
    return summary.length_stats(articles(spark, sf_dir), F.col("title"), F.col("description"))


def outlet_mean_words(spark, sf_dir):
    return summary.outlet_words(articles(spark, sf_dir), T.falsy(F.col("media_url"), T.domain(F.col("url"))), F.col("description"))


def date_range(spark, sf_dir):
    return summary.date_range(read(spark, sf_dir, "events"), F.when(F.col("user_id") % 13 != 0, F.date_format("ts", "yyyy-MM-dd")).otherwise("soon"))


def completeness(spark, sf_dir):
    return summary.completeness(articles(spark, sf_dir), "title", "url", "publish_date", "media_url", "description")


def duplicate_report(spark, sf_dir):
    return rows.duplicate_report(articles(spark, sf_dir), "url")


def publication_rank(spark, sf_dir):
    """The order of publication as columns: it sorts by the first, then by the second, then by position."""
    day, link = summary.publication_order(F.when(F.col("user_id") % 17 != 0, F.date_format("ts", "yyyy-MM-dd")), F.concat(F.lit("https://e/"), F.col("event_id").cast("string")))
    return read(spark, sf_dir, "events").select("event_id", day.alias("order_day"), link.alias("order_url"))


def published_head(spark, sf_dir):
    return topic_clean(spark, sf_dir).orderBy("order_day", "order_url").limit(20)


def top_n_outlets(spark, sf_dir):
    return summary.most_frequent(read(spark, sf_dir, "events"), F.col("user_id"), "user_id", 20)


def per_outlet_head(spark, sf_dir):
    return summary.head_by_group(read(spark, sf_dir, "events").select("event_type", "event_id", "user_id"), "event_type", "event_id", 3)


def histogram_rows(spark, sf_dir):
    counts = summary.count_by_date(read(spark, sf_dir, "events"), F.date_format("ts", "yyyy-MM-dd"))
    return summary.histogram(counts, "day")


def outlet_day_counts(spark, sf_dir):
    return coverage.day_outlet_counts(days_of(spark, sf_dir, gaps=False), "outlet", "day")


def coverage_gaps(spark, sf_dir):
    return coverage.gaps(days_of(spark, sf_dir).where("outlet = 'click'").select("day"))


def dates_to_collect(spark, sf_dir):
    return coverage.to_collect(days_of(spark, sf_dir).where("outlet = 'click'").select("day"), "2023-12-28", "2024-02-02")


def _expected(spark, sf_dir):
    """Expected counts: those there are, more on the 9th, unknown for purchases on the 12th; none on the 15th."""
    every = read(spark, sf_dir, "events").select(F.to_date("ts").alias("day"), F.col("event_type").alias("outlet")).groupBy("day", "outlet").agg(F.count(F.lit(1)).alias("n"))
    expected = F.when((F.dayofmonth("day") == 12) & (F.col("outlet") == "purchase"), F.lit(-1)).when(F.dayofmonth("day") == 9, F.col("n") + 1).otherwise(F.col("n"))
    return every.where("day(day) <> 15").select("day", "outlet", expected.cast(LONG).alias("expected"))


def completeness_status(spark, sf_dir):
    have = coverage.day_outlet_counts(days_of(spark, sf_dir), "outlet", "day")
    return coverage.day_status(coverage.date_grid(spark, "2023-12-30", "2024-01-31"), have, _expected(spark, sf_dir))


def completed_pairs(spark, sf_dir):
    have = coverage.day_outlet_counts(days_of(spark, sf_dir), "outlet", "day")
    return coverage.completed(have, _expected(spark, sf_dir), ["day", "outlet"])


def work_left(spark, sf_dir):
    outlets = spark.createDataFrame([(o,) for o in ("click", "purchase", "nowhere")], "outlet string")
    return coverage.work_left(coverage.date_grid(spark, "2024-01-01", "2024-01-31"), outlets, completed_pairs(spark, sf_dir))


def manifest_daily_runs(spark, sf_dir):
    """events as runs; times are to the microsecond, ties fall to the least mode."""
    runs = days_of(spark, sf_dir, gaps=False).select("day", F.struct("ts", "event_id").alias("time"), F.col("outlet").alias("mode"))
    found = coverage.daily_runs(runs)
    return found.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "count", F.col("first.event_id").alias("first_run"), F.col("last.event_id").alias("last_run"), "mode")


def store_header(spark, sf_dir):
    found = coverage.header(articles(spark, sf_dir), "a", F.col("publish_date"), "2024-02-01")
    return found.select("topic", "record_count", F.array_join("dates_collected", ",").alias("dates_collected"), F.col("date_range.start").alias("start_day"), F.col("date_range.end").alias("end_day"))


def page_domain(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", T.domain(F.col("url")).alias("domain"))


def page_title(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", T.html_title(F.col("html")).alias("title"))


def strip_html(spark, sf_dir):
    """Pages with entities of each kind put in: named, in decimal and in hexadecimal digits, escaped twice."""
    more = F.lit("<p>Caf&eacute; &#8217;&mdash; it&#x27;s &amp;lt; &nbsp;&frac12;</p>")
    return read(spark, sf_dir, "pages").select("page_id", T.strip_html(F.concat("html", more)).alias("body"))


def _versions(spark, sf_dir, lost: bool = True):
    """Days as versions of a store, the newest first in the log; ``lost``: the newest day lost most of its records."""
    found = read(spark, sf_dir, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("version"), (F.lit(30) - F.dayofmonth("ts")).cast(LONG).alias("idx"), "event_id")
    return found.where("idx > 0 or event_id % 3 = 0") if lost else found


def snapshot_argmax(spark, sf_dir):
    return coverage.best_snapshot(coverage.snapshot_counts(_versions(spark, sf_dir), "version", "idx"), "version", "idx", "n")


def data_loss(spark, sf_dir):
    return coverage.data_loss(coverage.snapshot_counts(_versions(spark, sf_dir), "version", "idx"), "idx")


def truncate_words(spark, sf_dir):
    return articles(spark, sf_dir).select("pos", T.truncate_words(F.col("description")).alias("short"), T.word_count(F.col("description")).alias("n_words"))


def keyword_counts(spark, sf_dir):
    body = F.lower("description")
    return articles(spark, sf_dir).select("pos", T.occurrences(body, "the").alias("n_the"), T.occurrences(body, "ere").alias("n_ere"))


def query_hash(spark, sf_dir):
    return articles(spark, sf_dir).select("pos", T.query_hash(F.col("title")).alias("query"), T.sha256_id(F.col("url")).alias("id"), T.preview(F.col("title")).alias("preview"), T.display_name(F.col("url")).alias("name"))


def recency_cutoff(spark, sf_dir):
    """Feed dates in many forms, some of them unreadable, against a fixed cutoff."""
    mail = F.concat(F.lit("Mon, "), F.date_format("ts", "dd MMM yyyy HH:mm:ss"), F.lit(" -0500"))
    small = F.concat(F.lit("tue, "), F.lower(F.date_format("ts", "d MMM yyyy H:m:s")), F.lit(" gmt"))
    iso = F.concat(F.date_format("ts", "yyyy-M-d"), F.lit("T"), F.date_format("ts", "HH:mm:ss"), F.lit("+05:30"))
    kind = F.col("event_id") % 6
    date = F.when(kind == 0, mail).when(kind == 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).when(kind == 2, "yesterday").when(kind == 3, small).when(kind == 4, iso).otherwise(F.date_format("ts", "yyyy-M-d"))
    found = read(spark, sf_dir, "events").select("event_id", date.alias("date"))
    kept = found.where(D.recent(F.col("date"), F.lit("2024-01-20 00:00:00").cast("timestamp")))
    return kept.select("event_id", D.wall_date(F.col("date")).alias("publish_date"))


def recovery_merge(spark, sf_dir):
    """A store of English articles, recovered from all of them."""
    found = articles(spark, sf_dir)
    return rows.recover(found.where("language = 'en'").select("pos", "url"), found.select("pos", "url"), "url", "pos")


def outlet_attribution(spark, sf_dir):
    """The first configured key that an outlet's name holds."""
    return articles(spark, sf_dir).select("pos", T.first_match(F.col("media_url"), ["src1", "src15", "5"]).alias("outlet"))


def raw_records(spark, sf_dir):
    """Feed stories as store records."""
    found = articles(spark, sf_dir).select(F.col("media_url").alias("domain"), "publish_date", "title", "url", F.col("description").alias("summary"))
    return rows.store_record(found, "2024-02-01T00:00:00+00:00")


def pending_urls(spark, sf_dir):
    found = articles(spark, sf_dir).select("pos", "url")
    return rows.pending(found, articles(spark, sf_dir).where("language = 'de'"), "url")


def conversation_roles(spark, sf_dir):
    """Per-role counts of turns with the words of the first turn: ordered records without gaps."""
    turns = read(spark, sf_dir, "conversations")
    return turns.groupBy("role").agg(F.count(F.lit(1)).alias("n"), F.sum(T.word_count(F.col("text"))).alias("n_words"), F.count_if(F.col("turn") == 0).alias("n_first"))


def top_terms(spark, sf_dir):
    return summary.top_terms(read(spark, sf_dir, "benchmark"), F.col("text"), 25)


def revision_stats(spark, sf_dir):
    found = read(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("version"), F.lit("clean.jsonl").alias("file"), F.col("text").alias("content"))
    return coverage.change_stats(found)


def jsonl_props(spark, sf_dir):
    """The JSON column of events as lines of a file, by the line parser."""
    lines = read(spark, sf_dir, "events").select(F.col("event_id").alias("pos"), F.col("props").alias("line"))
    return jsonl.parse(lines, "k int", on_bad="drop").select("pos", F.col("k").cast(LONG).alias("k"))


def rss_items(spark, sf_dir):
    """Pages as feeds of one or two items."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    link = F.regexp_replace("url", "&", "&amp;")
    item = lambda n: F.concat(F.lit(f"<item><title> Story {n} </title><link>"), link, F.lit(f"#{n}</link><pubDate>Tue, 02 Jan 2024 23:30:00 -0500</pubDate><description>&lt;p&gt;Text&lt;/p&gt;</description></item>"))
    xml = F.concat(F.lit("<rss><channel>"), item(1), F.when(F.col("page_id") % 2 == 0, item(2)).otherwise(""), F.lit("</channel></rss>"))
    found = jsonl.rss_items(pages.select(F.col("page_id").alias("source"), xml.alias("xml")))
    return found.select("source", F.col("pos").cast(LONG).alias("pos"), T.trim(F.col("title")).alias("title"), "url", D.wall_date(F.col("pub_date")).alias("publish_date"), T.strip_html(F.col("summary")).alias("summary"))


def _judged(spark, sf_dir):
    """Articles with title and description as one text, as languages are detected in."""
    return articles(spark, sf_dir).select("pos", "language", T.trim(F.concat_ws(" ", "title", "description")).alias("words"))


def lang_detect(spark, sf_dir):
    """English by the n-grams of the languages that the articles declare."""
    found = _judged(spark, sf_dir)
    return languages.english(found, "pos", "words", languages.profile(found, "words", "language"))


def html_meta(spark, sf_dir):
    """Pages with tags of both kinds in some, blank ones among them: the first that isn't blank counts, else the title element."""
    n = F.col("page_id").cast("string")
    tags = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit('<meta property="og:title" content="Story '), n, F.lit('"><meta name="description" content=" About '), n, F.lit(' &amp; more ">')))
    tags = tags.when(F.col("page_id") % 3 == 1, F.concat(F.lit('<meta name="twitter:title" content=" "><meta name="description" content=""/><meta property="og:description" content="On '), n, F.lit('">'))).otherwise("")
    pages = read(spark, sf_dir, "pages").select("page_id", F.replace("html", F.lit("<head>"), F.concat(F.lit("<head>"), tags)).alias("html"))
    return pages.select("page_id", udf.html_metadata(F.col("html")).alias("m")).select("page_id", "m.title", "m.description")


def _lines(spark, sf_dir):
    """events as lines of a file: their properties, some of them cut, headers, lists, numbers or blank."""
    line = F.when(F.col("event_id") % 10 == 0, F.lit('{"k":')).when(F.col("event_id") % 10 == 1, F.lit('{"_manifest": true, "k": 5}')).when(F.col("event_id") % 10 == 2, F.lit("[1]")).when(F.col("event_id") % 10 == 3, F.lit("  ")).when(F.col("event_id") % 10 == 4, F.lit('{"_meta": false, "k": 7}'))
    lines = read(spark, sf_dir, "events").select(F.col("event_id").alias("pos"), line.otherwise(F.col("props")).alias("line"))
    return lines.where(F.trim("line") != "")


def jsonl_modes(spark, sf_dir):
    """Bad lines and values that aren't objects are kept apart; headers are skipped."""
    return jsonl.parse(_lines(spark, sf_dir), "k int", on_bad="keep", non_dict="keep").select("pos", F.col("k").cast(LONG).alias("k"), F.col("_corrupt").alias("corrupt"), F.col("_value").alias("value"))


def jsonl_dropped(spark, sf_dir):
    """The same lines by the reader that swallows errors and knows one header only."""
    return jsonl.parse(_lines(spark, sf_dir), "k int", flags=("_meta",)).select("pos", F.col("k").cast(LONG).alias("k"))


def jsonl_bad_lines(spark, sf_dir):
    return jsonl.bad_lines(_lines(spark, sf_dir)).select("pos", "number", "line")


def jsonl_files(spark, sf_dir):
    """Articles through a store: written, appended to, and read again by the reader that fails on bad lines."""
    found, path = articles(spark, sf_dir).select("pos", "url", "title"), sinks.scratch(spark, "store")
    sinks.write_jsonl(found.where("pos % 2 = 0"), path, {"_meta": True, "topic": "a"})
    sinks.write_jsonl(found.where("pos % 2 = 1"), path, mode="append")
    return jsonl.read_large(spark, path, "pos long, url string, title string", fail=True)


def jsonl_ordered(spark, sf_dir):
    """Articles in the order of publication, written, and numbered by the order of the files' lines."""
    found, path = articles(spark, sf_dir), sinks.scratch(spark, "ordered")
    sinks.write_ordered(found.select("url", "publish_date"), path, summary.publication_order(F.col("publish_date"), F.col("url")))
    files = jsonl.read(spark, path, "url string, publish_date string")
    before = files.select("url", "publish_date", F.struct("path", "pos").alias("at"))
    return before.groupBy("publish_date").agg(F.count(F.lit(1)).alias("n"), F.min_by("url", "at").alias("first_url"), F.max_by("url", "at").alias("last_url"))


def jsonl_split(spark, sf_dir):
    """Texts as files: lines by line feeds, blank ones skipped."""
    texts = read(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("value"))
    return jsonl.split_lines(texts).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.min("pos").cast(LONG).alias("first_pos"), F.max("pos").cast(LONG).alias("last_pos"))


def header_line(spark, sf_dir):
    """The header of a file whose first line is one."""
    lines = read(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("int").alias("pos"), F.concat(F.lit('{"_manifest": true, "topic": "'), "n_name", F.lit('"}')).alias("line"))
    return jsonl.first_header(lines, "topic string")


def story_document(spark, sf_dir):
    """nation as one document of stories."""
    document = read(spark, sf_dir, "nation").agg(F.to_json(F.struct(F.sort_array(F.collect_list(F.struct(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name")))).alias("stories"))).alias("value"))
    return jsonl.stories(document, "k long, name string").select(F.col("pos").cast(LONG).alias("pos"), "k", "name")


def input_urls(spark, sf_dir):
    """Inputs of each accepted shape, one for each page."""
    pages = read(spark, sf_dir, "pages")
    link = F.concat(F.lit('"'), F.replace("url", F.lit('"'), F.lit("")), F.lit('"'))
    shape = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit('{"urls": ['), link, F.lit("]}"))).when(F.col("page_id") % 3 == 1, F.concat(F.lit("["), link, F.lit("]"))).otherwise(F.concat(F.lit('{"url": "", "link": '), link, F.lit("}")))
    return jsonl.normalised_urls(pages.select(shape.alias("value"))).select("url")


def listed_ids(spark, sf_dir):
    """Distinct ids in a column of lines, blank and missing ones left out."""
    line = F.to_json(F.struct(F.when(F.col("user_id") % 7 == 0, F.lit("")).otherwise(F.concat(F.lit("u"), F.col("user_id").cast("string"))).alias("id")))
    return jsonl.keys_of(read(spark, sf_dir, "events").select(line.alias("line")), "id")


def merged_header(spark, sf_dir):
    """Nations as files of two lines, every other one with a header, which is replaced or put first."""
    header = F.concat(F.lit('{"_manifest": true, "n": '), F.col("n_nationkey").cast("string"), F.lit("}"))
    lines = F.when(F.col("n_nationkey") % 2 == 0, F.array(F.lit('{"_manifest": true, "old": 1}'), F.col("n_name"))).otherwise(F.array("n_name", F.upper("n_name")))
    found = read(spark, sf_dir, "nation").select("n_nationkey", F.posexplode(lines).alias("pos", "line"))
    return sinks.with_header(found, header, "n_nationkey").select(F.col("n_nationkey").cast(LONG).alias("file"), F.col("pos").cast(LONG).alias("pos"), "line")


def date_labels(spark, sf_dir):
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'.5+00:00'")
    start = D.window_start(F.lit("2024-01-10").cast("date"), F.to_date("ts"), 7)
    return read(spark, sf_dir, "events").select("event_id", D.utc_label(F.col("ts")).alias("utc"), D.stamp_label(stamp).alias("stamp"), F.date_format(start, "yyyy-MM-dd").alias("window_start"))


def frequent_first_seen(spark, sf_dir):
    """Counts, ties by first position."""
    return summary.most_frequent(read(spark, sf_dir, "events"), F.col("user_id") % 100, "bucket", 30, pos="event_id")


def outlets_and_more(spark, sf_dir):
    return summary.top_and_more(read(spark, sf_dir, "events"), F.concat(F.lit("u"), F.col("user_id").cast("string")), "outlet", 10)


def day_ranks(spark, sf_dir):
    """Days with 'unknown' first, by their place in the order; and the newest first."""
    days = read(spark, sf_dir, "events").select(F.when(F.col("user_id") % 19 == 0, "unknown").otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("day")).distinct()
    order = Window.orderBy(summary.day_order(F.col("day")))  # a row for each day
    return days.select("day", F.row_number().over(order).cast(LONG).alias("place"), F.row_number().over(Window.orderBy(F.desc("day"))).cast(LONG).alias("newest"))


def first_rows(spark, sf_dir):
    return summary.head(read(spark, sf_dir, "events").select("event_id", "user_id"), "event_id", 25)


def latest_snapshot(spark, sf_dir):
    """The version with the latest date in it, then of most records."""
    log = coverage.snapshot_counts(_versions(spark, sf_dir, lost=False), "version", "idx")
    return coverage.best_snapshot(log.withColumn("latest", F.col("version")), "version", "idx", "latest").select("version")


def third_revision(spark, sf_dir):
    log = coverage.snapshot_counts(_versions(spark, sf_dir, lost=False), "version", "idx")
    return coverage.nth_revision(log, "idx", 2).select("version", "n")


def checked_positions(spark, sf_dir):
    """Revisions to look at: of each user's events as revisions, by how many there are."""
    return coverage.checked_positions(read(spark, sf_dir, "events"), "user_id").select("user_id", "n", F.col("position").cast(LONG).alias("position"))


def revision_range(spark, sf_dir):
    log = read(spark, sf_dir, "events").select("event_id", "ts")
    return coverage.revisions_between(log, "ts", "2024-01-05", "2024-01-09").select("event_id")


def line_changes(spark, sf_dir):
    """Turns of a conversation as revisions of a file, a word to a line."""
    turns = read(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("file"), (-F.col("turn")).cast("int").alias("age"), F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("version"), F.replace(F.coalesce("text", F.lit("")), F.lit(" "), F.lit("\n")).alias("content"))
    return coverage.line_changes(turns, "age").select("version", "file", "added", "deleted")


def file_at_version(spark, sf_dir):
    """All files of one version of a history, and one of them."""
    history = read(spark, sf_dir, "conversations").select(F.col("turn").cast("string").alias("version"), F.col("conv_id").cast("string").alias("file"), F.col("text").alias("content"))
    return coverage.restored(history, "1").select("file", F.length("content").cast(LONG).alias("size"))


def manifest_update(spark, sf_dir):
    """A manifest after two more runs of a topic, the second on the same day."""
    days = days_of(spark, sf_dir).where("outlet = 'click'").select("day").distinct()
    first = coverage.update_manifest(spark.createDataFrame([], "topic string"), "a", "2024-01-01", days.where("day(day) < 12"), 40, "2024-01-12T06:00:00+00:00", "automated")
    second = coverage.update_manifest(first, "a", "2024-01-01", days, 2, "2024-01-12T18:30:00+00:00")
    run = F.col("daily_runs")["2024-01-12"]
    return second.select("topic", "record_count", F.col("coverage.end_date").alias("end_day"), F.array_join("dates_collected", ",").alias("days"), F.array_join("gaps", ",").alias("gaps"), run["count"].cast(LONG).alias("runs"), run["first"].alias("first_run"), run["last"].alias("last_run"), run["mode"].alias("mode"))


def manifest_empty(spark, sf_dir):
    """The manifest of an outlet that has no events."""
    none = days_of(spark, sf_dir).where("outlet = 'nowhere'").select("day", F.date_format("ts", "HH:mm:ss").alias("time"), F.col("outlet").alias("mode"))
    found = coverage.manifest("a", "2024-01-01", none, none.select("day"), 0, "2024-01-01T00:00:00+00:00")
    return found.select("topic", "record_count", F.size("dates_collected").cast(LONG).alias("n_days"), F.col("coverage.start_date").alias("start_day"), F.size("gaps").cast(LONG).alias("n_gaps"))


def checkpoint_state(spark, sf_dir):
    """Pairs marked complete and expected counts, under the query that they were collected for; those of another query are forgotten."""
    pairs = completed_pairs(spark, sf_dir)
    empty, query = spark.createDataFrame([], coverage.CHECKPOINT), F.lit("storm AND coast")
    old = coverage.mark_complete(empty, "a", F.lit("storm"), pairs)
    state = coverage.mark_complete(old, "a", query, pairs.where("outlet = 'click'"))
    state = coverage.known_counts(state, "a", query, _expected(spark, sf_dir))
    return state.select("outlet", "day", "complete", "expected")


def pairs_to_count(spark, sf_dir):
    """Pairs whose expected count isn't cached."""
    query = F.lit("storm")
    state = coverage.known_counts(spark.createDataFrame([], coverage.CHECKPOINT), "a", query, _expected(spark, sf_dir))
    return coverage.to_count(state, "a", query, read(spark, sf_dir, "events").select(F.col("event_type").alias("outlet"), F.to_date("ts").alias("day")).distinct())


def enriched(spark, sf_dir):
    """Records with scraped fields over their own; one without a URL is a failure."""
    found = articles(spark, sf_dir).select("pos", F.when(F.col("pos") % 13 != 0, F.col("url")).alias("url"), F.lit(True).alias("success"), "title")
    scraped = articles(spark, sf_dir).where("language = 'en'").select("pos", "url", T.capitals(F.col("title")).alias("title"))
    return rows.enrich(found, scraped, "url", "pos", ["title"]).select("pos", "url", "success", "title", "error")


def outlet_success(spark, sf_dir):
    """Totals and failures by outlet."""
    found = labelled(spark, sf_dir)
    return found.groupBy(F.col("media_url").alias("outlet")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("ok"), F.count_if(~F.coalesce(F.col("quality") == 1, F.lit(False))).alias("failed"))


def store_batches(spark, sf_dir):
    """Events through the growing store in four batches, the third one tried twice, with a compaction in between."""
    events = read(spark, sf_dir, "events").select(F.concat(F.lit("https://e/"), (F.col("user_id") % 700).cast("string"), F.lit("/"), "event_type").alias("url"), F.col("event_id").alias("pos"), F.expr("(day(ts) - 1) div 8").alias("batch"))
    place = sinks.scratch(spark, "buckets")
    for number in range(4):
        batch = events.where(F.col("batch") == number).select("url", "pos")
        store.append(batch, place, number, pos="pos", buckets=16)
        if number == 2:
            store.append(batch, place, number, pos="pos")
            store.compact(spark, place)
    return store.read_store(spark, place)


def store_versions(spark, sf_dir):
    """Rows of each version of a store that was written, added to, replaced by what it held and restored."""
    found, place = articles(spark, sf_dir).select("url", "language"), sinks.scratch(spark, "versions")
    commits.replace(found.where("language = 'en'"), place, {"topic": "a"})
    commits.replace(found.where("language <> 'en'"), place, append=True)
    sinks.backup_then_write(commits.read(spark, place, "url string, language string").where("language = 'de'").select("url", "language"), place)
    commits.restore(spark, place, 2)
    every = None
    for number in commits.numbers(spark, place):
        one = commits.read(spark, place, "url string, language string", number).groupBy(F.lit(number).cast(LONG).alias("version"), "language").agg(F.count(F.lit(1)).alias("n"))
        every = one if every is None else every.unionByName(one)
    return every


def collection_stream(spark, sf_dir):
    """The state of two topics' collections after three batches of reports: topic a's query changes, b's stays."""
    pairs = completed_pairs(spark, sf_dir).select("outlet", F.date_format("day", "yyyy-MM-dd").alias("day"))
    counts = _expected(spark, sf_dir).select("outlet", F.date_format("day", "yyyy-MM-dd").alias("day"), "expected")
    report = lambda rows, topic, query, kind, at: rows.select(F.lit(topic).alias("topic"), F.lit(query).alias("query"), "outlet", "day", F.lit(kind).alias("kind"), (F.col("expected") if kind == "count" else F.lit(None)).cast(LONG).alias("expected"), F.lit(at).cast("timestamp").alias("at"))
    batches = [
        report(pairs, "a", "storm", "complete", "2024-02-01 00:00:00").unionByName(report(counts, "b", "rain", "count", "2024-02-01 01:00:00")),
        report(pairs.where("outlet = 'click'"), "a", "storm AND coast", "complete", "2024-02-02 00:00:00"),
        report(counts, "a", "storm AND coast", "count", "2024-02-02 01:00:00").unionByName(report(counts, "a", "storm", "count", "2024-02-01 23:00:00")),
    ]
    given, out, check = (sinks.scratch(spark, n) for n in ("reports", "changes", "offsets"))
    for number, batch in enumerate(batches):
        batch.coalesce(1).write.mode("append").parquet(given)
        stream = spark.readStream.schema(collection.REPORT).parquet(given)
        collection.follow(stream, out, check, late="7 days").awaitTermination()
    return collection.standing(collection.changes(spark, out)).select("topic", "outlet", "day", "complete", "expected")


def _turns(spark, sf_dir):
    """Turns of a conversation as revisions of a file, a word to a line, the newest first."""
    turns = read(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("file"), "turn", F.replace(F.coalesce("text", F.lit("")), F.lit(" "), F.lit("\n")).alias("content"))
    last = turns.groupBy("file").agg(F.max("turn").alias("_last"))
    return turns.join(last, "file").select(F.concat_ws("/", "file", F.col("turn").cast("string")).alias("version"), "file", (F.col("_last") - F.col("turn")).cast("int").alias("age"), "content")


def revision_diffs(spark, sf_dir):
    return diffs.line_diffs(_turns(spark, sf_dir), "age")


def history_at(spark, sf_dir):
    """A version of each file, rebuilt from whole contents every other revision and edits."""
    return diffs.at_place(diffs.packed(_turns(spark, sf_dir), "age", 2), "age", 2, 2).select("file", "version", F.md5("content").alias("digest"))


def keys_within(spark, sf_dir):
    """Which words of the benchmark stand in which titles."""
    keys = read(spark, sf_dir, "benchmark").select(F.explode(F.split(F.coalesce("text", F.lit("")), " ")).alias("word"))
    return within.contained(articles(spark, sf_dir).select("pos", "title"), keys, "pos", "title", "word")


def sampled_rows(spark, sf_dir):
    return summary.sample(read(spark, sf_dir, "events").select("event_id", "user_id"), 50, "event_id", 7)


def sampled_by_type(spark, sf_dir):
    return summary.sample_by(read(spark, sf_dir, "events").select("event_type", "event_id"), "event_type", 20, "event_id", 7)


def filter_counters(spark, sf_dir):
    """The waterfall's counts, taken while the rows are written."""
    found, seen = rows.counted(_reasons(spark, sf_dir))
    found.select("pos", "reason").write.parquet(sinks.scratch(spark, "reasons"))
    return rows.counters(spark, seen)


def day_folders(spark, sf_dir):
    """Events in a folder for each day, read for three days."""
    place = sinks.scratch(spark, "days")
    jsonl.write_day_table(read(spark, sf_dir, "events").select(F.to_date("ts").alias("day"), "event_id", "event_type"), place)
    found = jsonl.read_day_table(spark, place, "event_id long, event_type string").where("day BETWEEN DATE '2024-01-05' AND DATE '2024-01-07'")
    return found.groupBy("day", "event_type").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"))


def json_documents(spark, sf_dir):
    """Documents of each form that a file of records may have, one for each page."""
    link = F.concat(F.lit('"'), F.replace("url", F.lit('"'), F.lit("")), F.lit('"'))
    record = F.concat(F.lit('{"title": "t", "url": '), link, F.lit("}"))
    kind = F.col("page_id") % 5
    shape = F.when(kind == 0, F.concat(F.lit('{"stories": ['), record, F.lit("]}"))).when(kind == 1, F.concat(F.lit("["), link, F.lit(", "), record, F.lit("]"))).when(kind == 2, F.concat(F.lit('{"urls": ['), link, F.lit("]}"))).when(kind == 3, record).otherwise("[]")
    return jsonl.documents(read(spark, sf_dir, "pages").select(shape.alias("value")), "url string, title string").select(F.col("pos").cast(LONG).alias("pos"), "url", "title")


def written_document(spark, sf_dir):
    """Articles as one JSON document in several files, read again line by line."""
    place = sinks.scratch(spark, "document")
    sinks.write_document(articles(spark, sf_dir).select("pos", "url", "language"), place, "pos", topic="a")
    lines = spark.read.text(place).where("value not like '{\"_meta\"%' and value <> ']}'")
    return lines.select(F.from_json(F.regexp_replace("value", "^,", ""), "url string, language string").alias("r")).select("r.*")


QUERIES = {
    f.__name__: f
    for f in (
        topic_clean, topic_loose_any, topic_multi_counts, strict_title_only, strict_documented, dedupe_first_wins, dedupe_after_filter, distinct_urls,
        lookup_last_wins, integrity_missing, anti_new_records, merge_override, filter_waterfall, filter_reasons, outlet_counts, date_counts, conditional_counts,
        length_stats, outlet_mean_words, date_range, completeness, duplicate_report, publication_rank, published_head, top_n_outlets, per_outlet_head,
        histogram_rows, outlet_day_counts, coverage_gaps, dates_to_collect, completeness_status, completed_pairs, work_left, manifest_daily_runs, store_header,
        page_domain, page_title, strip_html, snapshot_argmax, data_loss, truncate_words, keyword_counts, query_hash, recency_cutoff, recovery_merge,
        outlet_attribution, raw_records, pending_urls, conversation_roles, top_terms, revision_stats, jsonl_props, rss_items, lang_detect, html_meta,
        jsonl_modes, jsonl_dropped, jsonl_bad_lines, jsonl_files, jsonl_ordered, jsonl_split, header_line, story_document, input_urls, listed_ids, merged_header,
        date_labels, frequent_first_seen, outlets_and_more, day_ranks, first_rows, latest_snapshot, third_revision, checked_positions, revision_range,
        line_changes, file_at_version, manifest_update, manifest_empty, checkpoint_state, pairs_to_count, enriched, outlet_success,
        store_batches, store_versions, collection_stream, revision_diffs, history_at, keys_within, sampled_rows, sampled_by_type, filter_counters, day_folders,
        json_documents, written_document,
    )
}
