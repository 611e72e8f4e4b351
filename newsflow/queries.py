"""Registered queries: every operator over the whole given tables."""

import datetime as dt
import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.functions import text, times, urls
from newsflow.operators import audit, compare, dedupe, enrich, quota, records, upsert, validate
from newsflow.operators.extract import with_article
from newsflow.plans import feed, ranked
from newsflow.schemas import ANALYSIS, ARTICLES, RAW_RECORD, STORY_ITEM
from newsflow.session import scratch_path, stage
from newsflow.sources import keyed, landing, readers, sinks
from newsflow.streaming import ingest

RUN_TS = dt.datetime(2026, 1, 1, tzinfo=dt.UTC)
TITLE = ("h1", None)
CONTENT = (("article", None),)
QUOTA = 30
LIST_LIMIT = 3
SITE = "https://news.example.org/"

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def given(*names):
    """Pass the named tables to the query instead of the folder."""

    def wrap(fn):
        @functools.wraps(fn)
        def run(spark, sf_dir):
            return fn(spark, *[table(spark, sf_dir, n) for n in names])

        return query(run)

    return wrap


def first_line(column):
    return F.split_part(column, F.lit("\n"), F.lit(1))


def has(column, part):
    return F.col(column).contains(part)


# --- filters, keys, text -----------------------------------------------------------------------


@given("documents")
def topic_filter(spark, documents):
    return documents.select(
        "doc_id",
        text.is_topic(F.col("text")).alias("text_on_topic"),
        text.is_topic(first_line(F.col("text"))).alias("title_on_topic"),
    )


def url_variants(pages):
    """Every page URL as it is, with an upper-case scheme, and with empty parameters and query."""
    forms = F.array(
        F.col("url"),
        F.regexp_replace("url", "^http", "HTTP"),
        F.concat(F.regexp_replace("url", "[?#].*$", ""), F.lit(";?")),
        F.regexp_replace("url", "^https?://", "ftp://"),
        F.regexp_replace("url", "^https?:", ""),
    )
    return pages.select("page_id", F.posexplode(forms).alias("variant", "url"))


@given("pages")
def canonical_keys(spark, pages):
    u = F.col("url")
    return url_variants(pages).select(
        "page_id",
        "variant",
        urls.normalize_url(u).alias("normalized"),
        urls.canonical_key(u).alias("canonical_key"),
    )


@given("pages")
def url_checks(spark, pages):
    u = F.col("url")
    return url_variants(pages).select(
        "page_id",
        "variant",
        urls.is_http_url(u).alias("is_http"),
        urls.is_well_formed_url(u).alias("is_well_formed"),
    )


@given("pages")
def generic_text(spark, pages):
    return pages.select("page_id", text.html_to_text(F.col("html")).alias("clean_text"))


@given("pages")
def article_extract(spark, pages):
    return with_article(pages, "html", TITLE, CONTENT).select(
        "page_id",
        records.chosen_title(F.col("page_title"), F.col("url")).alias("title"),
        "content",
        "published_raw",
        times.isoformat(times.parse_page_date(F.col("published_raw"), RUN_TS)).alias("published_at"),
    )


@given("pages")
def page_scan(spark, pages):
    landed = readers.landed_pages(pages)
    return landed.select("url", "http_status", F.length("html").alias("n_chars"))


@given("pages")
def content_choice(spark, pages):
    link = F.when(~has("url", "#"), F.col("url"))
    content = records.chosen_content(link, text.html_to_text(F.col("html")), F.col("html"))
    chosen = pages.select(
        "page_id", records.item_url(link, F.col("page_id")).alias("item_url"), content.alias("content")
    )
    return chosen.where(~records.is_missing(F.col("content")))


@given("events")
def epoch_iso(spark, events):
    ts = F.col("ts").cast("timestamp")
    seconds = F.when(F.col("event_type") != "error", F.unix_seconds(ts))
    return events.select(
        "event_id",
        times.isoformat(ts).alias("iso"),
        times.isoformat(times.epoch_to_utc(seconds, RUN_TS)).alias("from_epoch"),
    )


@given("events")
def feed_dates(spark, events):
    ts = F.col("ts").cast("timestamp")
    written = F.when(F.col("event_type") == "error", F.col("props")).otherwise(
        F.concat(F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0000"))
    )
    return events.select("event_id", times.isoformat(times.parse_feed_date(written)).alias("published_at"))


# --- records -----------------------------------------------------------------------------------


@given("pages")
def raw_feed_records(spark, pages):
    named = pages.select("url", "html", F.col("page_id").alias("pos"), F.lit("pages").alias("source"))
    rows = with_article(named, "html", TITLE, CONTENT).withColumns(
        {"title": F.col("url"), "http_status": F.lit(200)}
    )
    body = records.raw_body_feed(F.col("content"), F.col("html"))
    return records.raw_records(rows, body, F.lit(None).cast("string"), RUN_TS)


def document_articles(documents):
    return documents.select(
        F.col("doc_id").alias("pos"),
        "source",
        first_line(F.col("text")).alias("title"),
        F.concat(F.lit(SITE), F.col("lang"), F.lit("/"), F.col("doc_id")).alias("url"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("n_chars")).alias("published_at"),
        F.col("text").alias("content"),
        records.ranked_metadata(
            F.col("n_chars"), F.lit(None).cast("long"), F.col("lang"), F.col("doc_id")
        ).alias("raw_metadata"),
        urls.canonical_key(F.concat(F.lit(SITE), F.col("lang"), F.lit("/"), F.col("doc_id"))).alias("canonical_key"),
    )


@given("documents")
def article_rows(spark, documents):
    rows = records.articles(document_articles(documents), F.col("raw_metadata"))
    return rows.withColumn("published_at", times.isoformat(F.col("published_at")))


@given("documents")
def json_records(spark, documents):
    return documents.select("doc_id", records.to_json_record(documents).alias("raw_data"))


def stored_results(documents, labels):
    """One analysis per distinct labelled text, from the labels of its first document."""
    labelled = documents.join(labels, "doc_id")
    picked = labelled.groupBy(F.sha2("text", 256).alias("article_hash")).agg(
        F.min_by(F.struct("doc_id", "lang", "quality", "toxic"), "doc_id").alias("p")
    )
    q, toxic = F.col("p.quality"), F.col("p.toxic")
    fields = {
        "company": F.when(q == 1, F.concat(F.lit("Company "), F.col("p.doc_id"))),
        "funding_amount": F.lit(None).cast("string"),
        "funding_stage": F.when(toxic == 1, F.lit("Bridge")),
        "investors": F.array(F.col("p.lang"), F.lit("Quay Fund")),
        "summary": F.concat(F.lit("quality "), q),
        "investment_relevant": q == 1,
        "event_type": F.when(toxic == 1, "funding").otherwise("partnership"),
    }
    return picked.select(
        "article_hash", F.struct(*[fields[f.name].alias(f.name) for f in ANALYSIS]).alias("analysis")
    )


def with_flat_investors(df):
    return df.withColumn("investors", F.array_join("investors", "|"))


@given("documents", "labels")
def analysis_defaults(spark, documents, labels):
    hashed = document_articles(documents).withColumn("article_hash", enrich.article_hash(F.col("content")))
    joined = enrich.attach_analysis(hashed, stored_results(documents, labels))
    return with_flat_investors(enrich.output_records(joined, RUN_TS))


@given("documents")
def prompts(spark, documents):
    rows = document_articles(documents)
    prompt = enrich.build_prompt(
        F.col("title"), F.col("source"), enrich.prompt_date(F.col("published_at")), F.col("content")
    )
    return rows.select("pos", F.sha2(prompt, 256).alias("prompt_hash"), F.length(prompt).alias("prompt_chars"))


@given("events")
def parse_json(spark, events):
    body = F.concat(
        F.lit('{"summary": "'), F.col("event_type"), F.lit('", "investment_relevant": true, "event_type": "'),
        F.when(F.col("value") > 20, "funding").otherwise(F.col("event_type")), F.lit('", "extra": '),
        F.col("props"), F.lit("}"),
    )
    response = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("oops "), F.col("props")))
        .when(F.col("event_type") == "view", F.col("props"))
        .otherwise(body)
    )
    a = enrich.parse_analysis(response)
    return events.select(
        "event_id",
        a.isNotNull().alias("has_analysis"),
        a["summary"].alias("summary"),
        a["event_type"].alias("event_type"),
        a["company"].alias("company"),
        F.size(a["investors"]).alias("n_investors"),
    )


def keyword_analyzer():
    """Analyzer for the check: a rule on the prompt, one failing branch, one empty branch."""

    def analyze(prompt):
        if "Source: src1\n" in prompt:
            raise ValueError("refused")
        if "Source: src2\n" in prompt:
            return None
        return {
            "summary": f"{len(prompt)} characters",
            "investment_relevant": " the " in prompt,
            "event_type": "funding" if " of " in prompt else "other",
            "investors": ["Quay Fund"],
        }

    return analyze


@given("documents")
def analyze_batch(spark, documents):
    rows = document_articles(documents)
    prompt = enrich.build_prompt(
        F.col("title"), F.col("source"), enrich.prompt_date(F.col("published_at")), F.col("content")
    )
    done = enrich.analyze(rows, prompt, keyword_analyzer)
    return done.select(
        "pos",
        F.col("analysis.summary").alias("summary"),
        F.col("analysis.investment_relevant").alias("investment_relevant"),
        F.col("analysis.event_type").alias("event_type"),
        "analysis_error",
    )


@given("documents")
def validation(spark, documents):
    rows = enrich.output_records(
        document_articles(documents).withColumn("analysis", F.lit(None).cast(ANALYSIS)), RUN_TS
    )
    lang = F.regexp_extract("url", SITE + "([a-z]+)/", 1)
    broken = rows.withColumns(
        {
            "url": F.when(lang == "fr", F.replace("url", F.lit("https"), F.lit("ftp"))).otherwise(F.col("url")),
            "event_type": F.when(lang == "de", "launch").otherwise(F.col("event_type")),
            "title": F.when(F.length("title") >= 40, F.col("title")),
        }
    )
    checked = validate.validate(broken, validate.output_rules(broken))
    return checked.select("pos", F.array_join("violations", ",").alias("violations"))


@given("documents")
def preview(spark, documents):
    rows = document_articles(documents).withColumn("analysis", F.lit(None).cast(ANALYSIS))
    return records.preview(enrich.output_records(rows, RUN_TS))


@given("events")
def latest_articles(spark, events):
    rows = events.select(
        F.col("event_type").alias("source"),
        F.col("props").alias("title"),
        (F.col("value") > 20).alias("investment_relevant"),
        F.col("ts").cast("timestamp").alias("inserted_at"),
        F.sha2(F.col("event_id").cast("string"), 256).alias("canonical_key"),
    )
    return records.latest(rows)


# --- dedupe, quota, tables ---------------------------------------------------------------------


def page_entries(pages):
    """Every page listed twice, the second time with another fragment."""
    again = F.concat(F.regexp_replace("url", "#.*$", ""), F.lit("#again"))
    both = F.posexplode(F.array(F.col("url"), again)).alias("copy", "url")
    rows = pages.select("page_id", "html", both)
    return rows.withColumn("pos", F.col("page_id") * 2 + F.col("copy")).withColumn(
        "canonical_key", urls.canonical_key(F.col("url"))
    )


def keys_with_query(pages):
    return pages.where(has("url", "?")).select(urls.canonical_key(F.col("url")).alias("canonical_key")).distinct()


@given("pages")
def first_wins_dedupe(spark, pages):
    rows = page_entries(pages).select(
        "pos", "canonical_key", (F.length("html") + F.col("copy") * 1000 >= 3000).alias("ok")
    )
    return dedupe.with_status(rows)


@given("pages")
def only_new(spark, pages):
    return dedupe.only_new(page_entries(pages).select("pos", "canonical_key"), keys_with_query(pages))


@given("pages")
def seen_flag(spark, pages):
    return dedupe.seen_flag(page_entries(pages).select("pos", "canonical_key"), keys_with_query(pages))


@given("pages")
def seen_union(spark, pages):
    return dedupe.union_keys(keys_with_query(pages), page_entries(pages))


@given("pages")
def mark_processed(spark, pages):
    path = scratch_path(spark, "seen")
    for _ in range(2):
        sinks.mark_processed(spark, path, keys_with_query(pages))
    sinks.mark_processed(spark, path, page_entries(pages))
    return spark.read.parquet(path)


def document_walk(documents):
    rows = documents.select(
        "source",
        F.col("doc_id").alias("pos"),
        F.sha2("text", 256).alias("canonical_key"),
        (F.col("n_chars") >= 500).alias("ok"),
    )
    return stage(dedupe.with_status(rows), "status")


@given("pages")
def seen_scan(spark, pages):
    path = scratch_path(spark, "hashes")
    page_entries(pages).select(F.array("canonical_key").alias("hashes")).write.json(path)
    return readers.read_seen(spark, path)


@given("documents")
def success_quota(spark, documents):
    visited = quota.take_successes(document_walk(documents), QUOTA)
    return visited.select("source", "pos", "status")


@given("documents")
def run_counters(spark, documents):
    return quota.run_counters(quota.take_successes(document_walk(documents), QUOTA))


@given("documents")
def run_ledger(spark, documents):
    counted = quota.run_counters(document_walk(documents))
    run = [F.concat(F.lit("run-"), F.col("source")).alias("run_id"), F.col("source")]
    started = counted.select(
        *run, F.lit(RUN_TS).alias("event_ts"), F.lit(sinks.RUNNING).alias("status"),
        F.lit(0).cast("long").alias("items_processed"), F.lit(0).cast("long").alias("errors"),
    )
    ended = counted.select(
        *run, (F.lit(RUN_TS) + F.make_dt_interval(secs=F.col("items_processed"))).alias("event_ts"),
        F.when(F.col("errors") > 3, sinks.FAILED).otherwise(sinks.SUCCESS).alias("status"),
        "items_processed", "errors",
    )
    return sinks.current_runs(started.unionByName(ended))


@given("documents")
def ranked_items(spark, documents):
    ids = F.transform(F.regexp_extract_all("text", F.lit("([0-9]{1,9})"), 1), lambda x: x.cast("long"))
    listed = readers.ranked_ids(documents.withColumn("ids", ids), LIST_LIMIT * 2, keep=("doc_id",))
    listed = listed.withColumn("pos", F.col("doc_id") * 1000 + F.col("rank"))
    items = documents.select(F.col("doc_id").alias("id"), "source", "lang")
    joined = readers.with_items(listed, items)
    return joined.select("doc_id", "rank", "id", F.col("item").isNotNull().alias("found"), F.col("item.lang").alias("lang"))


@given("documents")
def found_items(spark, documents):
    ids = F.transform(F.regexp_extract_all("text", F.lit("([0-9]{1,9})"), 1), lambda x: x.cast("long"))
    listed = readers.ranked_ids(documents.withColumn("ids", ids), LIST_LIMIT * 2, keep=("doc_id",))
    listed = listed.withColumn("pos", F.col("doc_id") * 1000 + F.col("rank"))
    items = documents.select(F.col("doc_id").alias("id"), "lang")
    return records.drop_missing_items(readers.with_items(listed, items)).select("doc_id", "rank", "id", "item.lang")


@given("documents", "labels")
def upsert_articles(spark, documents, labels):
    rows = document_articles(documents).withColumn("analysis", F.lit(None).cast(ANALYSIS))
    base = enrich.output_records(rows, RUN_TS).select("pos", "canonical_key", "source", "title", "url", "published_at",
                                                      "investment_relevant", "event_type", "summary")
    base = base.withColumn("raw_data", records.to_json_record(base))
    existing = base.join(labels.select(F.col("doc_id").alias("pos")), "pos").select(
        (F.col("pos") + 1).alias("id"), *[c for c in base.columns if c != "pos"],
        F.lit("Old Corp").alias("company"), F.lit("2025-01-01T00:00:00").alias("inserted_at"),
    )
    wave = F.explode(F.array(F.lit(0), F.lit(1))).alias("wave")
    incoming = base.where(~F.col("url").contains("/en/")).select("*", wave).select(
        "canonical_key",
        (F.col("pos") * 2 + F.col("wave")).alias("pos"),
        F.concat(F.col("source"), F.lit("-"), F.col("wave")).alias("source"),
        F.concat(F.lit("new "), F.col("wave"), F.lit(" "), F.col("title")).alias("title"),
        F.concat(F.col("url"), F.lit("#"), F.col("wave")).alias("url"),
        "published_at", "investment_relevant", "event_type", "raw_data",
        F.when(F.col("wave") == 0, "New Corp").alias("company"),
        F.when(F.col("wave") == 0, F.col("summary")).alias("summary"),
        F.lit("2026-01-01T00:00:00").alias("inserted_at"),
    )
    merged = stage(upsert.upsert_articles(existing, incoming), "merged")
    return upsert.assign_ids(merged, existing)


def run_rows(documents, key, wave):
    """Article rows of every document for the run ``wave``."""
    at = F.lit(f"2026-01-0{wave}T00:00:00")
    mark = F.concat(F.lit(f"{wave} "), F.col("doc_id"))
    rows = documents.select(
        F.col("doc_id").alias("pos"), F.sha2(key, 256).alias("canonical_key"),
        F.concat(F.lit("source "), mark).alias("source"), F.concat(F.lit("title "), mark).alias("title"),
        F.concat(F.lit(SITE), mark).alias("url"), F.when(F.col("doc_id") % 3 != wave, mark).alias("company"),
        at.alias("inserted_at"),
    )
    missing = [f for f in ARTICLES if f.name not in (*rows.columns, "id")]
    return rows.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])


STORED = ("id", "canonical_key", "source", "title", "url", "company", "inserted_at")


@given("documents")
def upsert_runs(spark, documents):
    """Two runs over every document; English and French ones meet their keys again in the second, others do not."""
    text = F.coalesce("text", F.lit(""))
    again = F.when(F.col("lang").isin("en", "fr"), text).otherwise(F.concat(text, F.lit("+")))
    articles = keyed.KeyedArticles(spark, scratch_path(spark, "keyed"), buckets=16)
    articles.write_run(run_rows(documents, text, 1), "a", 0)
    articles.write_run(run_rows(documents, again, 2), "b", 0)
    return articles.read().select(*STORED)


@given("documents")
def fold_articles(spark, documents):
    """Two runs that overlapped: both number their rows from 1 and keep some keys in common."""
    text = F.coalesce("text", F.lit(""))
    again = F.when(F.col("lang").isin("en", "fr"), text).otherwise(F.concat(text, F.lit("+")))
    both = run_rows(documents, text, 1).unionByName(run_rows(documents, again, 2))
    return upsert.fold_articles(both.withColumn("id", F.col("pos") + 1).drop("pos")).select(*STORED)


# --- audit -------------------------------------------------------------------------------------


def audit_records(documents):
    """Output-like rows: repeated texts share a URL, one language has none, another has a bad one."""
    link = F.concat(F.lit(SITE), F.sha2("text", 256))
    return documents.select(
        F.col("doc_id").alias("pos"),
        F.when(F.col("lang") == "de", F.lit(""))
        .when(F.col("lang") == "fr", F.replace(link, F.lit("https:"), F.lit("")))
        .otherwise(link)
        .alias("url"),
        F.when(F.col("source") != "src7", F.col("source")).alias("source"),
        F.split_part("text", F.lit(" "), F.lit(1)).alias("title"),
        F.when(F.col("source") != "src3", F.col("n_chars")).alias("raw_text_length"),
    )


@given("documents")
def audit_summary(spark, documents):
    return audit.audit(audit_records(documents))


@given("documents")
def source_distribution(spark, documents):
    return audit.source_distribution(audit_records(documents))


@given("documents")
def duplicate_flags(spark, documents):
    rows = audit_records(documents).select("pos", "url")
    return dedupe.with_duplicate_flag(rows).select("pos", "is_duplicate")


@given("documents")
def audit_findings(spark, documents):
    found = audit.findings(audit_records(documents))
    return found.select("pos", F.array_join("findings", ",").alias("findings"))


# --- comparison --------------------------------------------------------------------------------


def two_runs(documents):
    """The documents, and a second run whose digits are masked and where one source is lost."""
    a = documents.select(
        F.col("doc_id").alias("pos"), "text", "lang", "source", F.current_timestamp().alias("collected_at")
    )
    b = a.withColumns(
        {
            "text": F.regexp_replace("text", "[0-9]+", "#"),
            "source": F.when(F.col("source") != "src5", F.col("source")),
        }
    )
    return a, b


@given("documents")
def comparison_fields(spark, documents):
    a, _ = two_runs(documents)
    rows = a.withColumns({"title": first_line(F.col("text")), "metadata": F.lit("{}")})
    return compare.comparison_view(rows, "ingestion")


@given("documents")
def fingerprints(spark, documents):
    a, _ = two_runs(documents)
    return a.select("pos", compare.fingerprint(a).alias("digest"))


@given("documents")
def compare_positional(spark, documents):
    return compare.diff_positional(*two_runs(documents))


@given("documents")
def compare_counts(spark, documents):
    a, b = two_runs(documents)
    return compare.same_count(a, b.where(F.col("lang") != "es"))


@given("documents")
def compare_verdict(spark, documents):
    return compare.comparison_summary(*two_runs(documents))


@given("documents")
def compare_ingestion_verdict(spark, documents):
    a, b = two_runs(documents)
    return compare.comparison_summary(a, b, mode="ingestion", ranked=True)


@given("documents")
def compare_multiset(spark, documents):
    return compare.multiset_diff(*two_runs(documents))


@given("documents")
def compare_content_verdict(spark, documents):
    return compare.content_summary(*two_runs(documents))


@given("documents")
def field_diff(spark, documents):
    return compare.field_diff_positional(*two_runs(documents))


@given("documents")
def field_diff_by_key(spark, documents):
    a, b = two_runs(documents)
    url = F.concat(F.lit(SITE), F.sha2("text", 256))
    a = a.withColumn("url", url)
    b = b.join(a.select("pos", "url"), "pos").where(F.col("lang") != "es")
    return compare.field_diff_keyed(a, b)


# --- sources and sinks: written with Spark, read back ---------------------------------------------


@given("documents")
def jsonl_round_trip(spark, documents):
    rows = document_articles(documents).withColumn("http_status", F.lit(200))
    raw = records.raw_records(rows, F.col("content"), times.isoformat(F.col("published_at")), RUN_TS)
    path = scratch_path(spark, "raw")
    sinks.append_jsonl(raw.select(RAW_RECORD.fieldNames()), path, by_source=True)
    return readers.read_jsonl(spark, path, RAW_RECORD).select(RAW_RECORD.fieldNames())


@given("pages")
def feed_scan(spark, pages):
    path = scratch_path(spark, "feed")
    items = pages.select(
        F.concat(F.lit("Page & <"), F.col("page_id"), F.lit(">")).alias("title"),
        F.col("url").alias("link"),
        F.when(~has("url", "#"), F.lit("Tue, 05 Mar 2024 10:11:12 +0100")).alias("pubDate"),
    )
    items.write.format("xml").option("rowTag", "item").option("rootTag", "channel").save(path)
    entries = readers.usable_entries(readers.read_feed(spark, path))
    return entries.select(
        "title", "link", "published", times.isoformat(times.parse_feed_date(F.col("published"))).alias("published_at")
    )


def document_items(documents, pages):
    """One story item per document; a document with a page of the same number links to it."""
    linked = documents.join(pages.select(F.col("page_id").alias("doc_id"), "url"), "doc_id", "left")
    return linked.select(
        F.col("doc_id").alias("id"), F.col("text").alias("title"), "url",
        F.when(F.col("lang") != "es", F.col("text")).alias("text"),
        (F.lit(1_700_000_000) + F.col("n_chars")).alias("time"),
        F.col("n_chars").alias("score"), F.lit(None).cast("long").alias("descendants"), F.col("source").alias("by"),
    )


@given("documents", "pages")
def item_scan(spark, documents, pages):
    path = scratch_path(spark, "items")
    document_items(documents, pages).write.json(path)
    return readers.read_items(spark, path).select(STORY_ITEM.fieldNames())


@given("pages")
def bucketed_page_lookup(spark, pages):
    """Pages landed in buckets, looked up by a listing that has every URL twice, once with another fragment."""
    path = scratch_path(spark, "landed-pages")
    landing.land_pages(pages.select("url", "html"), path, buckets=32)
    listed = stage(page_entries(pages).select("pos", "url"), "listed")
    found = landing.page_lookup(listed, readers.read_pages(spark, path), "url", "pos")
    return found.select("pos", "url", "http_status", F.length("html").alias("n_chars"))


# --- whole sources -----------------------------------------------------------------------------


def feed_inputs(pages):
    rows = page_entries(pages)
    entries = rows.select(
        F.col("pos").alias("feed_pos"),
        F.concat(F.lit("Feed title "), F.col("page_id")).alias("title"),
        F.col("url").alias("link"),
        F.lit("Tue, 05 Mar 2024 10:11:12 +0100").alias("published"),
    )
    landed = readers.landed_pages(rows.select("url", F.when(~has("url", "//spam"), F.col("html")).alias("html")))
    return entries, landed, keys_with_query(pages)


SELECTORS = {"title_selector": TITLE, "content_selectors": CONTENT}


@given("pages")
def feed_ingest(spark, pages):
    done = feed.feed_walk(*feed_inputs(pages), RUN_TS, **SELECTORS)
    return with_flat_investors(feed.feed_records(done, RUN_TS))


@given("pages")
def feed_ingest_counters(spark, pages):
    return feed.feed_walk(*feed_inputs(pages), RUN_TS, limit=QUOTA, **SELECTORS).counters


@given("pages")
def feed_raw_ingest(spark, pages):
    done = feed.feed_walk(*feed_inputs(pages), RUN_TS, raw=True, **SELECTORS)
    return feed.feed_raw_records(done, RUN_TS)


def ranked_inputs(documents, labels, pages):
    """Every document is listed; each labelled one also lists an id that has no item."""
    listed = documents.select((F.col("doc_id") * 2).alias("pos"), F.col("doc_id").alias("id")).union(
        labels.select(F.col("doc_id") * 2 + 1, -1 - F.col("doc_id"))
    )
    landed = readers.landed_pages(pages)
    return listed, document_items(documents, pages), landed, keys_with_query(pages)


@given("documents", "labels", "pages")
def ranked_ingest(spark, documents, labels, pages):
    done = ranked.ranked_walk(*ranked_inputs(documents, labels, pages), RUN_TS)
    return with_flat_investors(ranked.ranked_records(done, RUN_TS))


@given("documents", "labels", "pages")
def ranked_ingest_counters(spark, documents, labels, pages):
    return ranked.ranked_walk(*ranked_inputs(documents, labels, pages), RUN_TS).counters


@given("documents", "labels", "pages")
def ranked_raw_ingest(spark, documents, labels, pages):
    done = ranked.ranked_walk(*ranked_inputs(documents, labels, pages), RUN_TS, raw=True)
    return ranked.ranked_raw_records(done, RUN_TS)


@query
def stream_ingest(spark, sf_dir):
    """Feed entries arrive as a stream; the stored articles must equal those of one batch run."""
    entries, landed, _ = feed_inputs(table(spark, sf_dir, "pages"))
    landing = scratch_path(spark, "landing")
    entries.write.json(landing)
    articles = sinks.ArticleTable(spark, scratch_path(spark, "articles"))
    write = ingest.feed_batches(articles, scratch_path(spark, "ledger"), landed, RUN_TS, **SELECTORS)
    stream = ingest.read_entry_stream(spark, landing, entries.schema)
    ingest.ingest_stream(stream, write, scratch_path(spark, "stream")).awaitTermination()
    return with_flat_investors(articles.read()).select(ARTICLES.fieldNames())
