"""Operators against brute force on small frames, with skew and range limits turned down to tiny."""

import random

import pytest
from pyspark.sql import functions as F

from newsflow.operators import audit, compare, dedupe, quota, records, upsert, validate
from newsflow.operators.ordering import with_prior_count
from newsflow.operators.skew import hot_keys, key_counts, lookup_join, wide_lookup
from newsflow.schemas import OUTPUT_RECORD


def serial_status(rows):
    """(pos, key, ok) in order -> {pos: status}."""
    saved, out = set(), {}
    for pos, key, ok in sorted(rows):
        if key is not None and key in saved:
            out[pos] = "duplicate"
        elif ok:
            out[pos] = "accepted"
            saved.add(key)
        else:
            out[pos] = "error"
    return out


def random_rows(seed, n=400):
    rng = random.Random(seed)
    keys = ["hot"] * 20 + [f"k{i}" for i in range(40)]
    return [(pos, rng.choice(keys), rng.random() < 0.4) for pos in rng.sample(range(10**12), n)]


@pytest.mark.parametrize("hot_rows", [1, 10, 10**6])
def test_status_equals_serial_loop(spark, hot_rows):
    rows = random_rows(hot_rows)
    df = spark.createDataFrame(rows, "pos long, canonical_key string, ok boolean")
    got = {r.pos: r.status for r in dedupe.with_status(df, hot_rows=hot_rows).collect()}
    assert got == serial_status(rows)


@pytest.mark.parametrize("n", [0, 1, 7, 10_000])
@pytest.mark.parametrize("bits", [1, 4, 21])
def test_quota_equals_serial_loop(spark, n, bits):
    rng = random.Random(n)
    rows = [
        (pos, rng.choice(["a", "a", "a", "b", None]), rng.choice(["accepted", "error", "duplicate"]))
        for pos in rng.sample(range(500), 300)
    ]
    df = spark.createDataFrame(rows, "pos long, source string, status string")
    want, done = set(), {}
    for pos, source, status in sorted(rows, key=lambda r: r[0]):
        if done.get(source, 0) < n:
            want.add(pos)
            done[source] = done.get(source, 0) + (status == "accepted")
    visited = quota.take_successes(df, n, bits=bits)
    assert {r.pos for r in visited.collect()} == want
    counters = {r.source: (r.items_processed, r.errors) for r in quota.run_counters(visited).collect()}
    for source, (items, errors) in counters.items():
        mine = [s for p, so, s in rows if so == source and p in want]
        assert (items, errors) == (mine.count("accepted"), mine.count("error"))


@pytest.mark.parametrize("bits", [1, 3, 21])
def test_prior_count_any_positions(spark, bits):
    rng = random.Random(bits)
    positions = rng.sample(range(-300, 300), 150) + [2**62, -(2**62), 2**40, 2**40 + 1]
    df = spark.createDataFrame([(p, p % 3 == 0) for p in positions], "pos long, flag boolean")
    got = {r.pos: r.prior for r in with_prior_count(df, "pos", flag="flag", bits=bits).collect()}
    assert got == {p: sum(q < p and q % 3 == 0 for q in positions) for p in positions}


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookup_join_any_skew(spark, how):
    rng = random.Random(3)
    keys = [rng.choice(["hot", "hot", "warm", None, "x", "y"]) for _ in range(300)]
    left = spark.createDataFrame(list(enumerate(keys)), "pos long, k string")
    right = spark.createDataFrame([("hot", 1), ("warm", 2), ("z", 3), (None, 4)], "k string, v int")
    plain = left.join(right, "k", how)
    for hot_rows in (1, 60, 10**6):
        got = lookup_join(left, right, "k", "pos", how, hot_rows=hot_rows).select(plain.columns)
        assert sorted(got.collect(), key=repr) == sorted(plain.collect(), key=repr)


def test_more_hot_keys_than_are_listed(spark):
    """Every hot key is split, however many there are, by broadcast and by join."""
    left = spark.range(60_000).select(F.col("id").alias("pos"), F.concat(F.lit("k"), F.col("id") % 1500).alias("k"))
    left = left.unionByName(spark.range(200).select((-F.col("id") - 1).alias("pos"), F.lit(None).cast("string").alias("k")))
    right = spark.range(1500).select(F.concat(F.lit("k"), F.col("id")).alias("k"), F.col("id").alias("v"))
    hot = hot_keys(key_counts(left, "k"), "k", 10)
    assert hot.count() == 1500 and hot.where("_salts <> 4").count() == 0
    want = sorted(left.join(right, "k", "left").select("pos", "k", "v").collect(), key=repr)
    for listed_keys in (10, 100_000):
        got = lookup_join(left, right, "k", "pos", hot_rows=10, listed_keys=listed_keys).select("pos", "k", "v")
        assert sorted(got.collect(), key=repr) == want


def test_both_ways_of_a_wide_lookup_agree(spark):
    rows = [(1, "a"), (2, "a"), (3, None), (4, "b"), (5, "c"), (5, "c")]
    left = spark.createDataFrame(rows, "pos long, url string")
    right = spark.createDataFrame([("a", "x", 200), ("c", "y", 404), (None, "z", 0)], "url string, html string, http_status int")
    small, large = wide_lookup(left, right, "url", "pos"), wide_lookup(left, right, "url", "pos", broadcast_bytes=0)
    assert small.columns == large.columns == ["pos", "url", "html", "http_status"]
    assert sorted(small.collect()) == sorted(large.collect()) and small.count() == 4


def test_hot_keys_are_spread(spark):
    """With one key holding a third of the rows, no join task gets all of them."""
    left = spark.range(3000).select(
        F.col("id").alias("pos"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k")
    )
    right = spark.createDataFrame([("hot", 1)], "k string, v int")
    plan_settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in plan_settings}
    try:
        for k, v in plan_settings.items():
            spark.conf.set(k, v)
        joined = lookup_join(left, right, "k", "pos", hot_rows=10)
        sizes = joined.where("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in sizes) == 1000
        assert len(sizes) == 8 and max(r["count"] for r in sizes) < 300
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_seen_keys(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (4, None)], "pos long, canonical_key string")
    seen = spark.createDataFrame([("b",), ("c",)], "canonical_key string")
    assert {r.pos for r in dedupe.only_new(df, seen).collect()} == {1, 4}
    assert {r.pos: r.is_processed for r in dedupe.seen_flag(df, seen).collect()} == {1: False, 2: True, 3: True, 4: False}
    assert {r[0] for r in dedupe.union_keys(seen, df).collect()} == {"a", "b", "c"}
    assert {r[0] for r in dedupe.new_keys(seen, df).collect()} == {"a"}


def test_duplicate_flag(spark):
    rows = [(0, "u"), (1, "v"), (2, "u"), (3, ""), (4, ""), (5, None), (6, None), (7, "u")]
    df = spark.createDataFrame(rows, "pos long, url string")
    for hot_rows in (1, 10**6):
        got = {r.pos: r.is_duplicate for r in dedupe.with_duplicate_flag(df, hot_rows=hot_rows).collect()}
        assert got == {p: p in (2, 7) for p, _ in rows}


def test_upsert_equals_serial_writes(spark):
    rng = random.Random(5)
    columns = ["canonical_key", *upsert.KEPT, *upsert.UPDATED]

    def row(key, tag):
        values = {c: f"{c}-{tag}" for c in columns} | {"canonical_key": key, "investment_relevant": tag % 2 == 0}
        if rng.random() < 0.4:
            values["company"] = None
        return values

    existing = [{"id": i + 1, **row(f"k{i}", i)} for i in range(10)]
    incoming = [{"pos": p, **row(f"k{rng.randrange(5, 20)}", 100 + p)} for p in range(40)]
    table = {r["canonical_key"]: dict(r) for r in existing}
    for r in incoming:
        key = r["canonical_key"]
        if key in table:
            table[key].update({c: r[c] for c in upsert.UPDATED})
        else:
            table[key] = {"id": len(table) + 1, **{c: r[c] for c in columns}}

    types = {"id": "long", "pos": "long", "investment_relevant": "boolean"}
    ddl = lambda names: ", ".join(f"{c} {types.get(c, 'string')}" for c in names)
    frame = lambda rows, names: spark.createDataFrame([[r[c] for c in names] for r in rows], ddl(names))
    old, new = frame(existing, ["id", *columns]), frame(incoming, ["pos", *columns])
    merged = upsert.assign_ids(upsert.upsert_articles(old, new), old)
    got = {r.canonical_key: r.asDict() for r in merged.collect()}
    assert got == table
    assert "WHEN NOT MATCHED" in upsert.merge_sql("articles", "incoming")


def test_audit(spark):
    rows = [
        ("http://a.com/1", "s", "long enough title", 600),
        ("http://a.com/1", "s", "long enough title", 600),
        ("http://a.com/2", None, "short", 10),
        ("nohost", "t", None, None),
        ("", "s", "x", 1),
        (None, "s", "x", 1),
    ]
    df = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)], "pos long, url string, source string, title string, raw_text_length int"
    )
    report = audit.audit(df).first().asDict()
    assert report == {
        "total_records": 6, "unique_urls": 3, "missing_urls": 2, "invalid_urls": 1, "short_titles": 2,
        "short_texts": 1, "duplicates": 1, "passed": False,
    }
    assert {tuple(r) for r in audit.source_distribution(df).collect()} == {("s", 2), ("unknown", 1), ("t", 1)}
    found = {r.pos: r.findings for r in audit.findings(df).collect()}
    assert found == {
        1: ["duplicate_url"], 2: ["short_title", "short_text"], 3: ["invalid_url", "short_title"],
        4: ["missing_url"], 5: ["missing_url"],
    }
    clean = audit.audit(df.where("pos = 0").drop("raw_text_length")).first()
    assert clean.passed and clean.short_texts == 0


def output_row(spark, **changes):
    values = {
        "schema_version": "2.0", "source": "wire", "title": "Pump maker opens plant", "url": "https://news.site.net/pumps",
        "published_at": None, "company": None, "funding_amount": None, "funding_stage": None, "investors": [],
        "summary": "A plant opens.", "investment_relevant": True, "event_type": "other", "model_used": "m",
        "prompt_version": "1.0", "processing_timestamp": "2021-06-09T08:30:00", "article_hash": "9f1c",
        "metadata": "{}", "collected_at": "2021-06-09T08:15:00",
    } | changes
    return spark.createDataFrame([[values[f.name] for f in OUTPUT_RECORD]], OUTPUT_RECORD)


@pytest.mark.parametrize(
    "changes,broken",
    [
        ({}, []),
        ({"url": "gopher://news.site.net/pumps"}, ["url"]),
        ({"url": None, "source": None}, ["source", "url"]),
        ({"event_type": "launch"}, ["event_type"]),
        ({"event_type": None, "summary": None}, ["summary", "event_type"]),
        ({"schema_version": "1.0"}, ["schema_version"]),
    ],
)
def test_output_rules(spark, changes, broken):
    df = output_row(spark, **changes)
    checked = validate.validate(df, validate.output_rules(df))
    assert checked.first().violations == broken
    valid, quarantined = validate.split_valid(checked)
    assert (valid.count(), quarantined.count()) == ((0, 1) if broken else (1, 0))


def test_missing_fields(spark):
    df = output_row(spark).drop("published_at", "model_used")
    assert validate.validate(df, validate.output_rules(df)).first().violations == ["model_used", "published_at"]
    article = spark.createDataFrame([("test",)], "source string")
    assert validate.validate(article, validate.article_rules(article)).first().violations == ["title", "url", "content"]
    raw = spark.createDataFrame(
        [("1.0", "t", "T", "https://e.com", None, 100, "p", 200, "now")],
        "schema_version string, source string, title string, url string, published_at string, raw_text_length int, "
        "raw_text_preview string, http_status int, collected_at string",
    )
    assert validate.validate(raw, validate.raw_rules(raw)).first().violations == []


def runs(spark):
    a = [(10, "u1", "t1", 1, "x"), (20, "u2", "t2", 2, "x"), (35, "u2", "t3", 3, "x")]
    b = [(5, "u1", "t1", 1, "y"), (6, "u2", "T2", 2, "y"), (7, "u2", "t3", None, "y")]
    ddl = "pos long, url string, title string, raw_text_length int, collected_at string"
    return spark.createDataFrame(a, ddl), spark.createDataFrame(b, ddl)


def test_positional_comparison(spark):
    a, b = runs(spark)
    got = [tuple(r) for r in compare.diff_positional(a, b).orderBy("index").collect()]
    assert got == [(1, 20, 6), (2, 35, 7)]
    verdict = compare.comparison_summary(a, b).first()
    assert (verdict.left_count, verdict.right_count, verdict.mismatches, verdict.identical) == (3, 3, 2, False)
    assert compare.comparison_summary(a, a).first().identical
    short = compare.comparison_summary(a, b.where("pos < 7")).first()
    assert (short.mismatches, short.identical) == (None, False)
    assert not compare.same_count(a, b.where("pos < 7")).first().same
    diffs = {tuple(r) for r in compare.field_diff_positional(a, b.withColumn("extra", F.lit("e"))).collect()}
    assert diffs == {
        (0, "extra", None, "e"), (1, "extra", None, "e"), (2, "extra", None, "e"),
        (1, "title", "t2", "T2"), (2, "raw_text_length", "3", None),
    }
    ignored = compare.comparison_summary(a, b.withColumn("company", F.lit("c")), mode="ingestion").first()
    assert ignored.mismatches == 2


def test_keyed_and_multiset_comparison(spark):
    a, b = runs(spark)
    got = {tuple(r) for r in compare.field_diff_keyed(a, b).collect()}
    assert got == {("u2", 0, "title", "t2", "T2"), ("u2", 1, "raw_text_length", "3", None)}
    assert compare.multiset_diff(a, a.withColumn("pos", F.col("pos") * 3)).count() == 0
    counts = sorted((r.left_count, r.right_count) for r in compare.multiset_diff(a.union(a), a).collect())
    assert counts == [(2, 1)] * 3
    assert "collected_at" not in compare.comparison_view(a).columns
    assert compare.comparison_view(a, "ingestion").columns == ["url", "title", "raw_text_length"]
    with pytest.raises(ValueError):
        compare.comparison_view(a, "other")


def test_small_rules(spark):
    df = spark.createDataFrame(
        [(None, 7, "p", "i"), ("", 8, "p", None), ("http://a", 9, None, "i")],
        "url string, id long, page string, item string",
    )
    got = df.select(
        records.item_url(F.col("url"), F.col("id"), "base="), records.chosen_content(F.col("url"), F.col("page"), F.col("item"))
    ).collect()
    assert [tuple(r) for r in got] == [("base=7", "i"), ("base=8", ""), ("http://a", "")]
    titles = spark.createDataFrame(
        [("", "F"), ("Unknown Title", "F"), ("T", "F"), ("Unknown Title", None), (None, "F")], "t string, f string"
    ).select(records.chosen_title(F.col("t"), F.col("f")).alias("o"))
    assert [r.o for r in titles.collect()] == ["F", "F", "T", "Unknown Title", "F"]
