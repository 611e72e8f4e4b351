import pathlib
import sys
import zlib

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

import oracle  # noqa: E402

import __spark_entry__ as entry_module  # noqa: E402
import corpus_pipeline  # noqa: E402
from newsflow.llm import langid, queries, quality  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    names = entry_module.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14))
    assert "pipeline" in names


@pytest.mark.parametrize("name", queries.ORACLES)
def test_query_matches_sql(spark, name):
    rows, differences = oracle.compare(spark, oracle.connect(SF_DIR), name, queries.QUERIES[name], queries.ORACLES[name], SF_DIR)
    assert not differences, differences[:3]
    assert rows > 0


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n not in queries.ORACLES])
def test_query_covers_its_table(spark, name):
    got = queries.QUERIES[name](spark, SF_DIR)
    if name.startswith("op2_"):
        assert got.count() == 10 * spark.read.parquet(f"{SF_DIR}/embeddings.parquet").where("vec_id % 100 = 0").count()
    else:
        assert got.count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()


def naive_components(rows, size, threshold):
    sets = {}
    for r in rows:
        words = r.text.lower().split()
        sets[r.doc_id] = {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= threshold * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {find(i) for i in ids}


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    machine = quality.fit(docs, labels)
    first = corpus_pipeline.keep_quality(spark, docs, SF_DIR)
    accepted = {r.doc_id for r in quality.score(docs, machine).collect() if r.predicted}
    assert first.columns == docs.columns and {r.doc_id for r in first.collect()} == accepted
    good = {r.doc_id for r in labels.collect() if r.quality == 1 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0}
    assert len(good - accepted) <= 0.05 * len(good)

    second = corpus_pipeline.keep_language(spark, first, SF_DIR)
    rejected = {r.doc_id for r in langid.identify(first, langid.fit(first)).collect() if r.rejected}
    assert second.columns == docs.columns and {r.doc_id for r in second.collect()} == accepted - rejected

    third = corpus_pipeline.drop_near_duplicates(spark, second, SF_DIR)
    assert third.columns == docs.columns
    left = naive_components(second.collect(), 5, 80)
    assert sorted(r.doc_id for r in third.collect()) == sorted(left)

    packed = corpus_pipeline.pack_lengths(spark, third, SF_DIR)
    assert sorted(r.doc_id for r in packed.collect()) == sorted(left)
    assert sorted(corpus_pipeline.run(spark, SF_DIR).collect()) == sorted(packed.collect())
