"""The keyed article table: overlapping runs, replays, buckets left alone, lost writers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from newsflow.plans.feed import feed_records, feed_walk
from newsflow.plans.flow import article_rows
from newsflow.schemas import ARTICLES
from newsflow.sources import keyed
from newsflow.streaming import ingest

RUN = dt.datetime(2026, 1, 2, 3, 4, 5)


def rows(spark, names, mark, columns=ARTICLES):
    listed = [(i, name, f"{mark} {name}") for i, name in enumerate(names)]
    df = spark.createDataFrame(listed, "pos long, canonical_key string, title string")
    df = df.withColumn("source", F.lit(mark)).withColumn("inserted_at", F.lit(mark))
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in columns if f.name not in (*df.columns, "id")])


def state(table):
    return sorted((r.id, r.canonical_key, r.title, r.source) for r in table.read().collect())


def folders(path):
    return {(f.parent.name, f.name) for f in path.glob("bucket=*/commit=*")}


def test_overlapping_runs_leave_one_row_per_key(spark, tmp_path):
    table = keyed.KeyedArticles(spark, str(tmp_path / "t"), buckets=4)
    assert state(table) == []
    table.write_run(rows(spark, "ab", "one"), "x", 0)
    table.write_run(rows(spark, ["c", "b", "d", "d", None], "two"), "y", 0)
    expected = [(1, "a", "one a", "one"), (2, "b", "two b", "one"), (3, "c", "two c", "two"), (4, "d", "two d", "two")]
    assert state(table) == expected
    table.write_run(rows(spark, ["c", "b", "d", "d", None], "two"), "y", 0)
    assert state(table) == expected
    assert sorted(r.canonical_key for r in table.read(before=("y", 0)).collect()) == ["a", "b"]
    table.write_run(rows(spark, "", "none"), "y", 1)
    assert state(table) == expected


def test_only_buckets_with_known_keys_are_written_anew(spark, tmp_path):
    table = keyed.KeyedArticles(spark, str(tmp_path / "t"), buckets=8)
    names = [f"k{i}" for i in range(40)]
    table.write_run(rows(spark, names, "one"), "x", 0)
    before = folders(tmp_path / "t")
    table.write_run(rows(spark, ["k3", "new"], "two"), "x", 1)
    bucket = {r.canonical_key: r.bucket for r in table.stored().select("canonical_key", "bucket").collect()}
    added = folders(tmp_path / "t") - before
    assert {b for b, _ in added} == {f"bucket={bucket[k]}" for k in ("k3", "new")}
    replaced = {r.bucket for r in table.manifest().where("replaces").collect()}
    assert replaced == {bucket["k3"]}
    assert table.read().count() == 41 and table.read().select("id").distinct().count() == 41
    for i in range(3):
        table.write_run(rows(spark, [f"more{i}"], "three"), "x", 2 + i)
    whole = state(table)
    table.compact(folders=1)
    assert state(table) == whole and table.live().groupBy("bucket").count().where("count > 1").isEmpty()


def test_a_lost_writer_and_one_that_came_second(spark, tmp_path, monkeypatch):
    table = keyed.KeyedArticles(spark, str(tmp_path / "t"), buckets=2)
    table.write_run(rows(spark, "ab", "one"), "x", 0)
    last = keyed.KeyedArticles._last
    with monkeypatch.context() as broken:  # data written, list of the commit not
        broken.setattr(keyed.KeyedArticles, "_last", lambda self: (0, 2))
        with pytest.raises(Exception, match="ALREADY_EXISTS"):
            table.write_run(rows(spark, "bc", "lost"), "z", 0)
    assert state(table) == [(1, "a", "one a", "one"), (2, "b", "one b", "one")]

    def overtaken(self):
        seen = last(self)
        if seen[0] == 1:  # another run commits between look and write
            monkeypatch.setattr(keyed.KeyedArticles, "_last", last)
            keyed.KeyedArticles(spark, table.path, buckets=2).write_run(rows(spark, "c", "other"), "y", 0)
        return seen

    monkeypatch.setattr(keyed.KeyedArticles, "_last", overtaken)
    table.write_run(rows(spark, "cd", "late"), "z", 1)
    assert [r[:3] for r in state(table)] == [(1, "a", "one a"), (2, "b", "one b"), (3, "c", "late c"), (4, "d", "late d")]


def test_reading_prunes_void_folders(spark, tmp_path):
    table = keyed.KeyedArticles(spark, str(tmp_path / "t"), buckets=2)
    for i in range(3):
        table.write_run(rows(spark, "abcdef", f"run{i}"), "x", i)
    live = {(r.bucket, r.commit) for r in table.live().collect()}
    current = table.read()
    for file in (tmp_path / "t").glob("bucket=*/commit=*/*.parquet"):
        place = int(file.parent.parent.name.split("=")[1]), file.parent.name.split("=")[1]
        if place not in live:
            file.write_bytes(b"x" * file.stat().st_size)
    assert {r.title for r in current.collect()} == {f"run2 {k}" for k in "abcdef"}


def test_stream_and_overlapping_feed_runs(spark, tmp_path):
    entries = spark.range(12).select(
        F.col("id").alias("feed_pos"), F.concat(F.lit("T"), "id").alias("title"),
        F.concat(F.lit("https://e.com/"), "id").alias("link"), F.lit(None).cast("string").alias("published"),
    )
    pages = entries.select(F.col("link").alias("url"), F.lit("<p>x</p>").alias("html"), F.lit(200).alias("http_status"))
    table = keyed.KeyedArticles(spark, str(tmp_path / "t"), buckets=4)
    write = ingest.feed_batches(table, str(tmp_path / "ledger"), pages, RUN)
    write(entries.where("feed_pos < 8"), 0)
    write(entries.where("feed_pos < 8"), 0)  # delivered again
    write(entries, 1)
    assert [r.id for r in table.read().orderBy("id").collect()] == list(range(1, 13))
    # a run that looked before the others wrote
    late = article_rows(feed_records(feed_walk(entries, pages, None, RUN, source="late"), RUN), RUN)
    table.write_run(late, "late", 0)
    stored = table.read().collect()
    assert len(stored) == 12 == len({r.canonical_key for r in stored}) and {r.source for r in stored} == {"techcrunch"}
