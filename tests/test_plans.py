"""Plan shape: what is pushed down, what is shuffled, what is reused."""

import re

import pytest
from pyspark.sql import functions as F

from newsflow.functions.urls import canonical_key
from newsflow.operators import dedupe, enrich, quota
from newsflow.operators.extract import with_article
from newsflow.operators.skew import wide_lookup

DOCS = "/root/testdata/sf0.001/documents.parquet"
PAGES = "/root/testdata/sf0.001/pages.parquet"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_auto_broadcast(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "rows")
    docs = spark.read.parquet(DOCS)
    docs.select(
        "source", F.col("doc_id").alias("pos"), F.sha2("text", 256).alias("canonical_key"),
        (F.col("n_chars") >= 500).alias("ok"), "text",
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_status_spreads_null_keys_and_needs_no_window(staged, no_auto_broadcast):
    text = plan(dedupe.with_status(staged.drop("text")))
    assert re.search(r"hashpartitioning\(canonical_key#\d+, _salt#\d+L, 8\)", text)
    assert "Window" not in text and "text:string" not in text


def test_quota_shuffles_rows_once(staged, no_auto_broadcast):
    rows = dedupe.with_status(staged.drop("text"))
    path = staged.inputFiles()[0].rsplit("/", 2)[0] + "/status"
    rows.write.mode("overwrite").parquet(path)
    text = plan(quota.take_successes(rows.sparkSession.read.parquet(path), 5))
    by_row_range = re.findall(r"Exchange hashpartitioning\(_g0#\d+, _null0#\d+, _range#\d+L, 8\)", text)
    windows = re.findall(r"windowspecdefinition\((.*?)#", text)
    assert windows and "SinglePartition" not in text
    assert len(by_row_range) <= 4  # rows, their bases, and the two partial sums


def test_small_listing_is_broadcast_and_pages_are_not_shuffled(spark, no_auto_broadcast):
    pages = spark.read.parquet(PAGES).select("url", "html")
    listed = pages.select("url", F.xxhash64("url").alias("pos")).limit(5)
    small = plan(wide_lookup(listed, pages, "url", "pos"))
    assert "BroadcastHashJoin" in small and "hashpartitioning(url" not in small
    large = plan(wide_lookup(listed, pages, "url", "pos", broadcast_bytes=0))
    assert "SortMergeJoin" in large and "_salt" in large


def test_known_keys_are_dropped_below_the_analyzer(spark):
    docs = spark.read.parquet(DOCS)
    rows = docs.select(
        F.col("doc_id").alias("pos"), "text", canonical_key(F.concat(F.lit("http://a/"), F.col("doc_id"))).alias("canonical_key")
    )
    seen = rows.where("pos > 5").select("canonical_key")
    done = enrich.analyze(dedupe.only_new(rows, seen), F.col("text"), lambda: lambda text: None)
    text = plan(done)
    assert text.index("ArrowEvalPython") < text.index("LeftAnti")


def test_topic_filter_reads_one_column(spark):
    from newsflow.functions.text import is_topic

    docs = spark.read.parquet(DOCS)
    text = plan(docs.where(is_topic(F.col("text"))).select("text"))
    assert "ReadSchema: struct<text:string>" in text and "Python" not in text


def test_extraction_evaluates_each_pattern_once(spark):
    pages = spark.read.parquet(PAGES)
    text = plan(with_article(pages, "html", ("h1", None), (("article", None),)))
    assert text.count("AS _tail0") == 2  # one for the title, one for the content
    assert "Exchange" not in text
