"""Sources, sinks, enrichment, whole runs and the stream."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from newsflow import runs
from newsflow.functions import times
from newsflow.functions.urls import canonical_key
from newsflow.operators import compare, enrich, upsert
from newsflow.plans.feed import feed_candidates, feed_listing, feed_raw_records, feed_records, feed_walk
from newsflow.plans.flow import walk_ranges
from newsflow.plans.ranked import ranked_records, ranked_walk
from newsflow.schemas import ARTICLES, FEED_ENTRY, LANDED_PAGE, OUTPUT_RECORD, RAW_RECORD, STORY_ITEM, schema
from newsflow.session import stage
from newsflow.sources import landing, readers, sinks
from newsflow.streaming import ingest

RUN = dt.datetime(2026, 1, 2, 3, 4, 5)
ANALYSIS = {
    "company": "Lumen Works", "funding_amount": "$7M", "funding_stage": "Series C", "investors": ["North Fund", "Quay"],
    "summary": "Lumen Works raised money for lamps.", "investment_relevant": True, "event_type": "funding",
}


def articles(spark, n=1):
    rows = [(i, "feed", f"Title {i}", f"https://e.com/{i}", RUN, f"content {i}", "{}") for i in range(n)]
    return spark.createDataFrame(
        rows, "pos long, source string, title string, url string, published_at timestamp, content string, raw_metadata string"
    )


def prompt():
    return enrich.build_prompt(F.col("title"), F.col("source"), enrich.prompt_date(F.col("published_at")), F.col("content"))


def test_analyzer_result_is_copied(spark):
    done = enrich.analyze(articles(spark), prompt(), lambda: lambda text: ANALYSIS)
    record = enrich.output_records(done, RUN, "model-x").first()
    assert {k: record[k] for k in ANALYSIS} == ANALYSIS
    assert record.model_used == "model-x" and record.published_at == "2026-01-02T03:04:05"


def test_analyzer_none_and_failure(spark):
    def factory():
        def analyze(text):
            if "Title 1" in text:
                raise RuntimeError("down")
            return {"summary": "incomplete"} if "Title 2" in text else None

        return analyze

    done = enrich.analyze(articles(spark, 3), prompt(), factory)
    rows = enrich.output_records(done, RUN).orderBy("pos").collect()
    for record in rows:
        assert record.company is None and record.summary == "Analysis failed or content unavailable."
        assert (record.event_type, record.investment_relevant, record.investors) == ("other", False, [])
    errors = [r.analysis_error for r in done.orderBy("pos").select("analysis_error").collect()]
    assert errors == [None, "RuntimeError: down", None]


def test_analyzer_called_once_per_row(spark, tmp_path):
    log = tmp_path / "calls"
    log.mkdir()

    def factory():
        import uuid

        def analyze(text):
            (log / uuid.uuid4().hex).write_text(text[:10])
            return ANALYSIS

        return analyze

    done = enrich.analyze(articles(spark, 20), prompt(), factory)
    enrich.output_records(done, RUN).collect()
    assert len(list(log.iterdir())) == 20


def test_prompt_text(spark):
    long = articles(spark).withColumn("content", F.repeat(F.lit("x"), 20_000))
    got = long.select(prompt().alias("p")).first().p
    assert got.startswith("\nAnalyze the following article") and got.endswith("based on the schema.\n")
    assert "Title: Title 0\nSource: feed\nDate: 2026-01-02 03:04:05\nContent:\nxxx" in got
    assert got.count("x") == 15_000 + got.replace("x" * 15_000, "").count("x")


def test_parse_analysis(spark):
    texts = [
        json.dumps(ANALYSIS), json.dumps(ANALYSIS | {"investors": None}), json.dumps(ANALYSIS | {"event_type": "launch"}),
        '{"summary": "s"}', "not json", None,
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.a for r in df.select("i", enrich.parse_analysis(F.col("t")).alias("a")).orderBy("i").collect()]
    assert got[0].asDict() == ANALYSIS and got[1].investors == [] and got[2:] == [None] * 4


def test_jsonl(spark, tmp_path):
    path = tmp_path / "in.jsonl"
    path.write_text('{"url": "a", "title": "t"}\n\n{"title": "u"}\n')
    rows = readers.read_jsonl(spark, str(path), schema("url string, title string")).collect()
    assert sorted(map(tuple, rows), key=repr) == [("a", "t"), (None, "u")]
    path.write_text('{"url": "a"}\n{"url": \n')
    with pytest.raises(Exception):
        readers.read_jsonl(spark, str(path), schema("url string")).collect()
    bad = readers.read_jsonl(spark, str(path), schema("url string"), quarantine=True).collect()
    assert [r["_corrupt_record"] for r in bad if r["_corrupt_record"]] == ['{"url": ']
    with pytest.raises(Exception):
        readers.read_jsonl(spark, str(tmp_path / "none.jsonl"), schema("url string")).collect()
    out = str(tmp_path / "out")
    sinks.append_jsonl(spark.createDataFrame([("s", None)], "source string, url string"), out, by_source=True)
    lines = spark.read.text(out).select("value").collect()
    assert json.loads(lines[0].value) == {"source": "s", "url": None}


def test_feed_scan(spark, tmp_path):
    path = tmp_path / "feed.xml"
    path.write_text(
        "<rss><channel><item><title>A</title><link>http://a</link><pubDate>Tue, 05 Mar 2024 10:11:12 +0000</pubDate></item>\n"
        "<item><title>B &bad; </title><link>http://b</link></item>\n"
        "<item><title>C</title><link>http://c</link></item>\n<item><title>D"
    )
    feed = readers.read_feed(spark, str(path)).cache()
    entries = readers.usable_entries(feed).orderBy("feed_pos").collect()
    assert [(e.title, e.link) for e in entries] == [("A", "http://a"), ("C", "http://c")]
    assert entries[1].published is None
    assert readers.malformed_entries(feed).count() >= 1


def test_items_and_ranked_ids(spark, tmp_path):
    path = tmp_path / "items.json"
    path.write_text('{"id": 1, "title": "t", "by": "x", "extra": 1}\nnull\n{"id": 3}\n')
    items = readers.read_items(spark, str(path))
    assert items.columns == [*STORY_ITEM.fieldNames(), "landed_at"]
    lists = spark.createDataFrame([([5, 1, 3, 2],), (None,)], "ids array<long>")
    ranked = readers.ranked_ids(lists, 3).select("id", F.col("rank").alias("pos"))
    found = {r.id: r.item is not None for r in readers.with_items(ranked, items).collect()}
    assert found == {5: False, 1: True, 3: True}


def test_pages(spark, tmp_path):
    df = spark.createDataFrame([("u", "old", 1), ("u", "new", 2), ("v", None, 1)], "url string, html string, day int")
    df.write.parquet(str(tmp_path / "pages"))
    landed = readers.read_pages(spark, str(tmp_path / "pages"))
    assert {(r.url, r.html, r.http_status) for r in landed.collect()} == {("u", "old", 200), ("u", "new", 200), ("v", None, 0)}
    full = df.withColumn("http_status", F.lit(200))
    assert {(r.url, r.html) for r in readers.newest_pages(full, "day").collect()} == {("u", "new"), ("v", None)}


def test_seen_keys_persist(spark, tmp_path):
    path = tmp_path / "seen.json"
    assert readers.read_seen(spark, str(path)).count() == 0
    path.write_text('{"hashes": ["a", "b", "a"]}')
    assert {r[0] for r in readers.read_seen(spark, str(path)).collect()} == {"a", "b"}
    path.write_text('{"hashes": ["a", ')
    with pytest.raises(Exception):
        readers.read_seen(spark, str(path)).collect()
    table = str(tmp_path / "seen")
    key = spark.createDataFrame([("https://example.com/persistent",)], "url string").select(
        canonical_key(F.col("url")).alias("canonical_key")
    )
    for _ in range(2):
        sinks.mark_processed(spark, table, key)
    assert spark.read.parquet(table).count() == 1


def test_tables_and_ledger(spark, tmp_path):
    table = sinks.ArticleTable(spark, str(tmp_path / "articles"), schema("id long, canonical_key string"))
    frame = lambda *rows: spark.createDataFrame(list(rows), "id long, canonical_key string")
    assert table.read().count() == 0
    table.append(frame((1, "a")), "feed", 0)
    table.append(frame((2, "b")), "feed", 1)
    table.append(frame((2, "b")), "feed", 1)
    assert {tuple(r) for r in table.read().collect()} == {(1, "a"), (2, "b")}
    assert {tuple(r) for r in table.read(before=("feed", 1)).collect()} == {(1, "a")}
    assert {tuple(r) for r in table.read(before=("other", 0)).collect()} == {(1, "a"), (2, "b")}
    assert table.rewrite(table.read().withColumn("canonical_key", F.upper("canonical_key"))) == 1
    table.append(frame((3, "c")), "feed", 0)
    table.append(frame((4, "d")), "a/b=c %", 0)
    assert {tuple(r) for r in table.read().collect()} == {(1, "A"), (2, "B"), (3, "c"), (4, "d")}
    assert {tuple(r) for r in table.read(before=("a/b=c %", 0)).collect()} == {(1, "A"), (2, "B"), (3, "c")}
    with pytest.raises(ValueError):
        table.append(frame((5, "e")), "feed", -1)

    ledger = str(tmp_path / "runs")
    assert sinks.read_runs(spark, ledger).count() == 0
    sinks.start_run(spark, ledger, "r1", "feed", RUN)
    assert sinks.read_runs(spark, ledger).first().status == "running"
    sinks.finish_run(spark, ledger, "r1", "feed", RUN, "success", 3, 1)
    sinks.finish_run(spark, ledger, "r1", "feed", RUN, "success", 3, 1)
    run = sinks.read_runs(spark, ledger).first()
    assert (run.status, run.items_processed, run.errors) == ("success", 3, 1)
    assert run.started_at == run.completed_at == "2026-01-02T03:04:05"
    # a run that failed and then succeeds, in either order of landing, with the clock standing still
    for status in ("failed", "success"):
        sinks.finish_run(spark, ledger, "r2", "feed", RUN, status, 1, 0)
    assert sinks.read_runs(spark, ledger).where("run_id = 'r2'").first().status == "success"
    table.read().createOrReplaceTempView("articles_view")
    assert "articles_view" in {r.tableName for r in readers.list_tables(spark).collect()}


def page(title, body, meta=""):
    return f'{meta}<h1 class="article__title">{title}</h1><div class="article-content"><p>{body}</p></div>'


def feed_case(spark):
    entries = [
        (0, "One", "https://e.com/1", "Tue, 05 Mar 2024 10:11:12 +0000"),
        (1, "One again", "https://E.com/1#x", None),
        (2, "No page", "https://e.com/2", None),
        (3, "Bad date", "https://e.com/3", None),
        (4, "Not http", "ftp://e.com/4", None),
        (5, "Known", "https://e.com/5", None),
        (6, "Plain", "https://e.com/6", None),
        (7, "Retry", "https://e.com/2#retry", None),
    ]
    bad_date = '<meta property="article:published_time" content="soon">'
    pages = [
        ("https://e.com/1", page("Head 1", "Body 1"), 200),
        ("https://E.com/1#x", page("Head 1b", "Body 1b"), 200),
        ("https://e.com/2", None, 404),
        ("https://e.com/3", page("Head 3", "Body 3", bad_date), 200),
        ("ftp://e.com/4", page("Head 4", "Body 4"), 200),
        ("https://e.com/5", page("Head 5", "Body 5"), 200),
        ("https://e.com/6", "<p>nothing to extract</p>", 200),
        ("https://e.com/2#retry", page("", "Body 2"), 200),
    ]
    seen = spark.createDataFrame([("https://e.com/5",)], "url string").select(canonical_key(F.col("url")).alias("canonical_key"))
    return spark.createDataFrame(entries, FEED_ENTRY), spark.createDataFrame(pages, LANDED_PAGE), seen


@pytest.mark.parametrize("hot_rows", [1, 10**6])
def test_feed_run(spark, hot_rows):
    done = feed_walk(*feed_case(spark), RUN, hot_rows=hot_rows)
    status = {r.pos: r.status for r in done.visited.collect()}
    assert status == {0: "accepted", 1: "duplicate", 2: "error", 3: "error", 4: "error", 6: "accepted", 7: "accepted"}
    counts = done.counters.first()
    assert (counts.items_processed, counts.errors) == (3, 3)
    rows = {r.pos: r for r in feed_records(done, RUN).collect()}
    assert {p: r.title for p, r in rows.items()} == {0: "Head 1", 6: "Plain", 7: "Retry"}
    assert rows[6].article_hash == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert json.loads(rows[0].metadata) == {"parsed_at": "2026-01-02T03:04:05"}


def test_feed_quota(spark):
    done = feed_walk(*feed_case(spark), RUN, limit=2)
    assert {r.pos for r in done.visited.collect()} == {0, 1, 2, 3, 4, 6}
    counts = done.counters.first()
    assert (counts.items_processed, counts.errors) == (2, 3)


def long_feed(spark, n=200):
    """Every third entry has no page, every fifth repeats an earlier one."""
    listed = spark.range(n).select(
        F.col("id").alias("feed_pos"),
        F.concat(F.lit("Entry "), "id").alias("title"),
        F.concat(F.lit("https://e.com/"), F.expr("if(id % 5 = 4, id div 2, id)")).alias("link"),
        F.lit(None).cast("string").alias("published"),
    )
    pages = spark.range(n).where("id % 3 != 1").select(
        F.concat(F.lit("https://e.com/"), "id").alias("url"),
        F.concat(F.lit("<p>body "), "id", F.lit("</p>")).alias("html"),
        F.lit(200).alias("http_status"),
    )
    return listed, pages


@pytest.mark.parametrize("limit", [0, 1, 7, 40, 1000])
@pytest.mark.parametrize("raw", [False, True])
def test_quota_in_ranges_equals_the_whole_walk(spark, limit, raw):
    listed, pages = long_feed(spark)
    ranges = feed_walk(listed, pages, None, RUN, limit=limit, raw=raw, first_range=3)
    whole = feed_walk(listed, pages, None, RUN, limit=limit, raw=raw, first_range=1000)
    rows = [sorted((r.pos, r.status, r.url) for r in w.visited.collect()) for w in (ranges, whole)]
    assert rows[0] == rows[1] and sum(r[1] == "accepted" for r in rows[0]) <= limit
    assert ranges.counters.collect() == whole.counters.collect()
    if not raw and limit <= 40:  # the plain walk, entry by entry
        seen, plain = set(), []
        for i in range(200 if limit else 0):
            key = i // 2 if i % 5 == 4 else i
            status = "duplicate" if key in seen else "error" if key % 3 == 1 else "accepted"
            plain.append((i, status, f"https://e.com/{key}"))
            seen |= {key} if status == "accepted" else set()
            if len(seen) == limit:
                break
        assert rows[0] == plain


def test_quota_leaves_later_ranges_unread(spark):
    listed, pages = long_feed(spark)
    looked_up = []

    def candidates(part):
        looked_up.append([r.pos for r in part.select("pos").collect()])
        return feed_candidates(part, pages, RUN)

    walk_ranges(feed_listing(listed, None), candidates, 5, first=4)
    assert [sorted(p) for p in looked_up] == [list(range(10))]
    looked_up.clear()
    walk_ranges(feed_listing(listed, None), candidates, 30, first=4)
    assert [(min(p), max(p)) for p in looked_up] == [(0, 59)]
    empty = walk_ranges(feed_listing(listed.limit(0), None), candidates, 5)
    assert empty.visited.count() == 0


def test_bucketed_pages_give_the_same_run(spark, tmp_path):
    entries, pages, seen = feed_case(spark)
    landing.land_pages(pages.unionByName(pages.limit(1).withColumn("url", F.lit(None))), str(tmp_path / "pages"), buckets=4)
    bucketed = readers.read_pages(spark, str(tmp_path / "pages"))
    rows = [
        sorted((r.pos, r.title, r.article_hash) for r in feed_records(feed_walk(entries, p, seen, RUN), RUN).collect())
        for p in (pages, bucketed)
    ]
    assert rows[0] == rows[1] and len(rows[0]) == 3


def test_lookup_opens_the_buckets_of_its_listing_only(spark, tmp_path):
    path = tmp_path / "pages"
    urls = spark.range(64).select(F.concat(F.lit("https://e.com/"), "id").alias("url"), F.lit("<p>x</p>").alias("html"))
    landing.land_pages(urls, str(path), buckets=16)
    listed = stage(urls.limit(2).select("url", F.xxhash64("url").alias("pos")), "listed")
    wanted = {r.b for r in listed.select(landing.url_bucket(F.col("url"), 16).alias("b")).collect()}
    pages = readers.read_pages(spark, str(path))
    found = landing.page_lookup(listed, pages, "url", "pos")
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(found.columns) == ["html", "http_status", "landed_at", "pos", "url"]
    for folder in path.glob("url_bucket_of_16=*"):
        if int(folder.name.split("=")[1]) not in wanted:
            for file in folder.glob("*.parquet"):
                file.write_bytes(b"x" * file.stat().st_size)
    assert found.count() == 2 and found.where("html = '<p>x</p>'").count() == 2
    with pytest.raises(Exception):
        pages.where("html = '<p>x</p>'").count()
    everything = landing.page_lookup(listed, urls, "url", "pos", broadcast_bytes=0)
    assert everything.count() == 2


def test_large_listing_in_buckets_is_joined_by_url(spark, tmp_path):
    urls = spark.range(40).select(F.concat(F.lit("https://e.com/"), F.col("id") % 30).alias("url"), F.lit("<p>x</p>").alias("html"))
    landing.land_pages(urls.dropDuplicates(["url"]), str(tmp_path / "pages"), buckets=4)
    listed = stage(urls.select("url", F.monotonically_increasing_id().alias("pos")), "listed")
    found = landing.page_lookup(listed, readers.read_pages(spark, str(tmp_path / "pages")), "url", "pos", 1, 0)
    assert found.count() == 40 and "url_bucket_of_4" not in found.columns


def test_feed_raw_run(spark):
    done = feed_walk(*feed_case(spark), RUN, raw=True)
    rows = {r.pos: r for r in feed_raw_records(done, RUN).collect()}
    assert sorted(rows) == [0, 2, 3, 4, 6]
    assert (rows[0].raw_text_length, rows[0].raw_text_preview, rows[0].title) == (6, "Body 1", "One")
    assert rows[0].published_at == "Tue, 05 Mar 2024 10:11:12 +0000"
    assert (rows[2].raw_text_length, rows[2].raw_text_preview, rows[2].http_status) == (0, "", 404)
    assert rows[3].raw_text_preview.startswith("<meta") and rows[6].raw_text_preview.startswith("<p>nothing")
    counts = done.counters.first()
    assert (counts.items_processed, counts.errors) == (5, 1)
    assert [c for c in feed_raw_records(done, RUN).columns if c in RAW_RECORD.fieldNames()] == RAW_RECORD.fieldNames()


def ranked_case(spark):
    items = [
        (1, "New AI model", "https://e.com/1", None, 0, 10, 2, "a"),
        (2, "Ask: is AI done?", None, "<p>item text", 60, 1, None, "b"),
        (3, "Cats", "https://e.com/3", None, 0, 1, 1, "c"),
        (4, "GPT page gone", "https://e.com/4", None, 0, 1, 1, "d"),
        (5, "GPT known", "https://e.com/5", None, 0, 1, 1, "e"),
        (6, "LLM empty", None, None, None, 1, 1, "f"),
        (8, "New AI model again", "https://e.com/1#c", None, 0, 1, 1, "g"),
    ]
    ranked = spark.createDataFrame([(i, i + 1) for i in range(8)], "pos long, id long")
    pages = [(f"https://e.com/{k}", f"<p>page {k}</p>", 200) for k in ("1", "3", "5", "1#c")]
    _, _, seen = feed_case(spark)
    return ranked, spark.createDataFrame(items, STORY_ITEM), spark.createDataFrame(pages, LANDED_PAGE), seen


@pytest.mark.parametrize("hot_rows", [1, 10**6])
def test_ranked_run(spark, hot_rows):
    done = ranked_walk(*ranked_case(spark), RUN, hot_rows=hot_rows)
    status = {r.id: r.status for r in done.visited.collect()}
    assert status == {1: "accepted", 2: "accepted", 4: "error", 6: "error", 7: "error", 8: "duplicate"}
    rows = {r.pos: r for r in ranked_records(done, RUN).collect()}
    assert rows[1].url == "https://news.ycombinator.com/item?id=2"
    assert rows[1].published_at == "1970-01-01T00:01:00"
    assert json.loads(rows[1].metadata) == {"hn_score": 1, "comment_count": None, "by": "b", "id": 2}
    hashes = enrich.article_hash(F.lit("<p>item text")), enrich.article_hash(F.lit("page 1"))
    want = spark.range(1).select(*hashes).first()
    assert (rows[1].article_hash, rows[0].article_hash) == tuple(want)


def test_stream_runs_and_replay(spark, tmp_path):
    entries, pages, _ = feed_case(spark)
    landing, stream_state = str(tmp_path / "landing"), str(tmp_path / "state")
    ledger = str(tmp_path / "runs")
    table = sinks.ArticleTable(spark, str(tmp_path / "articles"))
    write = ingest.feed_batches(table, ledger, pages, RUN)

    def run():
        stream = ingest.read_entry_stream(spark, landing, FEED_ENTRY)
        ingest.ingest_stream(stream, write, stream_state).awaitTermination()
        return sorted(table.read().collect(), key=lambda r: r.id)

    entries.where("feed_pos < 3").coalesce(1).write.mode("append").json(landing)
    assert [(r.id, r.title) for r in run()] == [(1, "Head 1")]
    entries.where("feed_pos >= 3").coalesce(1).write.mode("append").json(landing)
    after = run()
    assert [(r.id, r.title) for r in after] == [(1, "Head 1"), (2, "Head 5"), (3, "Plain"), (4, "Retry")]
    assert json.loads(after[1].raw_data)["article_hash"]
    assert run() == after

    write(entries.where("feed_pos >= 3"), 1)  # the second batch is delivered again
    assert sorted(table.read().collect(), key=lambda r: r.id) == after
    finished = {r.run_id: (r.status, r.items_processed, r.errors) for r in sinks.read_runs(spark, ledger).collect()}
    assert finished == {"techcrunch-0": ("success", 1, 1), "techcrunch-1": ("success", 3, 2)}
    assert table.read().columns == ARTICLES.fieldNames()


def test_failed_run_is_recorded(spark, tmp_path):
    entries, pages, _ = feed_case(spark)
    ledger = str(tmp_path / "runs")
    table = sinks.ArticleTable(spark, str(tmp_path / "articles"))
    write = ingest.feed_batches(table, ledger, pages.drop("html"), RUN)
    with pytest.raises(Exception):
        write(entries, 0)
    assert sinks.read_runs(spark, ledger).first().status == "failed"


def test_ranked_stream_batch(spark, tmp_path):
    ranked, items, pages, _ = ranked_case(spark)
    table = sinks.ArticleTable(spark, str(tmp_path / "articles"))
    ledger = str(tmp_path / "runs")
    write = ingest.ranked_batches(
        table, ledger, items, pages, RUN, limit=2, analysis={"analyzer_factory": lambda: lambda text: ANALYSIS, "model_used": "m"}
    )
    write(ranked, 0)
    write(ranked, 1)
    rows = sorted(table.read().collect(), key=lambda r: r.id)
    assert [(r.id, r.company, r.funding_amount) for r in rows] == [(i, "Lumen Works", "$7M") for i in (1, 2, 3)]
    assert set(json.loads(rows[0].raw_data)) == set(OUTPUT_RECORD.fieldNames())


def test_whole_feed_runs(spark, tmp_path):
    _, pages, _ = feed_case(spark)
    pages.write.parquet(str(tmp_path / "pages"))
    items = "".join(
        f"<item><title>T{i}</title><link>https://e.com/{i}</link></item>\n" for i in (1, 2, 5, 6)
    )
    (tmp_path / "feed.xml").write_text(f"<rss><channel>{items}</channel></rss>")
    table, ledger = sinks.ArticleTable(spark, str(tmp_path / "articles")), str(tmp_path / "runs")
    where = (spark, str(tmp_path / "feed.xml"), str(tmp_path / "pages"), table, ledger)
    raw_out, out = str(tmp_path / "raw"), str(tmp_path / "out")

    runs.ingest_feed(*where, batch=0, run_ts=RUN, limit=2, output=raw_out, raw=True)
    runs.ingest_feed(*where, batch=1, run_ts=RUN, limit=2, output=raw_out, raw=True)
    raw = readers.read_jsonl_batches(spark, raw_out, RAW_RECORD).orderBy("batch", "url").collect()
    assert [(r.batch, r.url[-1], r.http_status) for r in raw] == [(0, "1", 200), (0, "2", 404), (1, "5", 200), (1, "6", 200)]
    assert runs.audit_jsonl(spark, raw_out, RAW_RECORD).first().passed
    assert table.read().count() == 0

    runs.ingest_feed(*where, batch=2, run_ts=RUN, limit=2, output=out)
    again = sinks.ArticleTable(spark, str(tmp_path / "again"))
    runs.ingest_feed(*where[:3], again, ledger, batch=3, run_ts=RUN + dt.timedelta(days=1), limit=2, output=out + "2")
    assert [r.title for r in table.read().orderBy("id").collect()] == ["Head 1", "Head 5"]
    # both runs looked at the same entries; published_at falls back to the run time, so it differs
    verdict = runs.compare_jsonl(spark, out, out + "2").first()
    assert (verdict.left_count, verdict.mismatches) == (2, 2)
    assert runs.compare_jsonl(spark, out, out + "2", by_position=True).first().mismatches == 2
    same = compare.content_summary(
        *[readers.read_jsonl(spark, p, OUTPUT_RECORD).drop("published_at") for p in (out, out + "2")]
    ).first()
    assert same.identical
    finished = {r.run_id: (r.status, r.items_processed, r.errors) for r in sinks.read_runs(spark, ledger).collect()}
    assert finished["techcrunch-0"] == ("success", 2, 1) and finished["techcrunch-2"] == ("success", 2, 1)


def test_whole_ranked_runs(spark, tmp_path):
    ranked, items, pages, _ = ranked_case(spark)
    pages.write.parquet(str(tmp_path / "pages"))
    items.write.json(str(tmp_path / "items"))
    (tmp_path / "ids.json").write_text(json.dumps({"ids": list(range(1, 9))}))
    table, ledger = sinks.ArticleTable(spark, str(tmp_path / "articles")), str(tmp_path / "runs")
    where = (spark, str(tmp_path / "ids.json"), str(tmp_path / "items"), str(tmp_path / "pages"), table, ledger)
    runs.ingest_ranked(*where, batch=0, run_ts=RUN, limit=2, output=str(tmp_path / "raw"), raw=True)
    raw = readers.read_jsonl_batches(spark, str(tmp_path / "raw"), RAW_RECORD).orderBy("published_at").collect()
    assert [(r.title, r.raw_text_preview, r.http_status) for r in raw] == [
        ("New AI model", "<p>page 1</p>", 200), ("Ask: is AI done?", "<p>item text", 200)
    ]
    runs.ingest_ranked(*where, batch=1, run_ts=RUN, limit=4)
    assert [r.title for r in table.read().orderBy("id").collect()] == ["New AI model", "Ask: is AI done?", "GPT known"]


def titles(table):
    return sorted(r.title for r in table.read().collect())


def test_sources_share_a_table_and_batch_numbers(spark, tmp_path):
    entries, pages, _ = feed_case(spark)
    ranked, items, ranked_pages, _ = ranked_case(spark)
    table, ledger = sinks.ArticleTable(spark, str(tmp_path / "articles")), str(tmp_path / "runs")
    ingest.feed_batches(table, ledger, pages, RUN)(entries, 0)
    first = titles(table)
    ingest.ranked_batches(table, ledger, items, ranked_pages, RUN)(ranked, 0)
    both = titles(table)
    assert len(both) > len(first) and set(first) <= set(both)
    ingest.feed_batches(table, ledger, pages, RUN)(entries, 0)  # replay
    assert titles(table) == both
    table.rewrite(table.read())
    ingest.feed_batches(table, ledger, pages, RUN)(entries, 0)  # a new stream counts from 0 again
    assert titles(table) == both


def test_landed_files_count_positions_on_their_own(spark, tmp_path):
    pages = spark.createDataFrame(
        [(f"https://e.com/{i}", page(f"H{i}", f"b{i}"), 200) for i in range(4)], "url string, html string, http_status int"
    )
    landing = str(tmp_path / "landing")
    for part in ((0, 1), (2, 3)):
        rows = [(n, f"T{i}", f"https://e.com/{i}", None) for n, i in enumerate(part)]
        spark.createDataFrame(rows, FEED_ENTRY).coalesce(1).write.mode("append").json(landing)
    table, ledger = sinks.ArticleTable(spark, str(tmp_path / "articles")), str(tmp_path / "runs")
    write = ingest.feed_batches(table, ledger, pages, RUN)
    stream = ingest.read_entry_stream(spark, landing, FEED_ENTRY)
    ingest.ingest_stream(stream, write, str(tmp_path / "state")).awaitTermination()
    assert titles(table) == ["H0", "H1", "H2", "H3"]
    assert sorted(r.id for r in table.read().collect()) == [1, 2, 3, 4]
    assert sinks.read_runs(spark, ledger).first().items_processed == 4


def test_two_id_lists_and_items_landed_twice(spark, tmp_path):
    ranked, items, pages, _ = ranked_case(spark)
    pages.write.parquet(str(tmp_path / "pages"))
    items.write.json(str(tmp_path / "items"))
    items.write.mode("append").json(str(tmp_path / "items"))
    where = lambda name: (
        spark, str(tmp_path / name), str(tmp_path / "items"), str(tmp_path / "pages"),
        sinks.ArticleTable(spark, str(tmp_path / f"{name}-articles")), str(tmp_path / "runs"),
    )
    (tmp_path / "one").write_text(json.dumps({"ids": list(range(1, 9))}))
    (tmp_path / "two").write_text("\n".join(json.dumps({"ids": ids}) for ids in (list(range(1, 5)), list(range(5, 9)))))
    found = []
    for name in ("one", "two"):
        args = where(name)
        runs.ingest_ranked(*args, batch=0, run_ts=RUN, limit=8)
        found.append(titles(args[4]))
        assert len(set(found[-1])) == len(found[-1])
    assert found[0] == found[1]


def test_page_landed_twice_counts_once_and_the_newest_wins(spark):
    entries = spark.createDataFrame([(0, "A", "https://e.com/1", None), (1, "B", "https://e.com/2", None)], FEED_ENTRY)
    rows = [
        ("https://e.com/1", page("Old", "old"), 200, RUN),
        ("https://e.com/1", page("New", "new"), 200, RUN + dt.timedelta(days=1)),
        ("https://e.com/2", page("Two", "two"), 200, RUN),
    ]
    pages = spark.createDataFrame(rows, "url string, html string, http_status int, landed_at timestamp")
    got = feed_walk(entries, pages, None, RUN).accepted.collect()
    assert sorted(r.title for r in got) == ["New", "Two"]
    untimed = feed_walk(entries, pages.drop("landed_at"), None, RUN).accepted.collect()
    assert len(untimed) == 2


def test_clock_values_do_not_depend_on_the_zone(spark, monkeypatch):
    import time

    monkeypatch.setenv("TZ", "Asia/Tokyo")
    time.tzset()
    try:
        shown = spark.range(1).select(
            times.isoformat(times.run_time(dt.datetime(2026, 1, 1))).alias("run"),
            times.isoformat(times.parse_page_date(F.lit("10:11"), dt.datetime(2026, 1, 1))).alias("timed"),
        ).first()
    finally:
        monkeypatch.undo()
        time.tzset()
    assert (shown.run, shown.timed) == ("2026-01-01T00:00:00", "2026-01-01T10:11:00")


@pytest.mark.parametrize(
    "text", ["5th March 2024", "Mar 5 2024", "Tue Mar  5 00:00:00 2024", "5-Mar-2024", "2024.03.05", "March 5, 2024", "2024-03-05"]
)
def test_common_page_dates(spark, text):
    parsed = spark.range(1).select(times.isoformat(times.parse_page_date(F.lit(text), RUN)).alias("d")).first().d
    assert parsed == "2024-03-05T00:00:00"


def test_parse_analysis_checks_types(spark):
    cases = [
        ({"investors": "Quay"}, None), ({"investors": [1, 2]}, None), ({"investors": ["a", None]}, None), ({"investors": []}, True),
        ({"company": 5}, None), ({"company": {"n": 1}}, None), ({"company": None}, True), ({"summary": 7}, None), ({"summary": None}, None),
        ({"investment_relevant": "true"}, True), ({"investment_relevant": 1}, True), ({"investment_relevant": "No"}, False),
        ({"investment_relevant": 2}, None), ({"investment_relevant": None}, None), ({"event_type": ["funding"]}, None),
    ]
    df = spark.createDataFrame([(i, json.dumps(ANALYSIS | change)) for i, (change, _) in enumerate(cases)], "i int, t string")
    got = [r.a for r in df.select("i", enrich.parse_analysis(F.col("t")).alias("a")).orderBy("i").collect()]
    assert [a and a.investment_relevant for a in got] == [want for _, want in cases]


def test_fold_overlapping_batches(spark, tmp_path):
    table = sinks.ArticleTable(spark, str(tmp_path / "articles"))
    blank = {f: None for f in ARTICLES.fieldNames()}

    def batch(*rows, at):
        return spark.createDataFrame(
            [blank | {"id": i, "canonical_key": k, "title": t, "funding_amount": a, "url": f"u{t}", "source": "s", "inserted_at": at} for i, k, t, a in rows],
            ARTICLES,
        )

    table.append(batch((1, "a", "A1", "$1"), (2, "b", "B1", "$2"), at="2026-01-01T00:00:00"), "s", 0)
    table.append(batch((1, "c", "C1", None), (2, "a", "A2", None), at="2026-01-02T00:00:00"), "t", 0)
    table.rewrite(upsert.fold_articles(table.read()))
    rows = sorted((r.id, r.canonical_key, r.title, r.url, r.funding_amount, r.inserted_at[:10]) for r in table.read().collect())
    assert rows == [
        (1, "a", "A2", "uA1", None, "2026-01-01"), (2, "b", "B1", "uB1", "$2", "2026-01-01"), (3, "c", "C1", "uC1", None, "2026-01-02"),
    ]
    incoming = table.read().where("id < 3").withColumn("title", F.lit("new")).withColumn("pos", F.col("id"))
    merged = upsert.upsert_articles(table.read(), incoming)
    table.rewrite(upsert.assign_ids(merged, table.read()))
    assert sorted((r.id, r.title) for r in table.read().collect()) == [(1, "new"), (2, "new"), (3, "C1")]


def test_parse_analysis_of_unusual_json(spark):
    whole = '{"summary":"s","investment_relevant":true,"event_type":"other"'
    texts = [
        whole + ',"company":"é \\u00e9 \\"q\\"","investors":["a","b"]}', whole + ',"investors":[]}', whole + ',"investors":null}',
        whole + ',"investors":[null]}', whole + ',"investors":["a",null]}', whole + ',"investors":"a"}', whole + ',"company":{"x":1}}',
        "[" + whole + "}]", whole + ',"summary":"again"}', whole, "null", "", None, whole + ',"other":[1,{"a":2}]}',
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(3)
    got = [r.a for r in df.select("i", enrich.parse_analysis(F.col("t")).alias("a")).orderBy("i").collect()]
    assert [i for i, a in enumerate(got) if a is not None] == [0, 1, 2, 13]
    assert got[0].company == 'é é "q"' and got[0].investors == ["a", "b"] and got[1].investors == [] and got[2].investors == []
