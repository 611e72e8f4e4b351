import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from newsflow.llm import bpe

ALPHABET = "ab  \n\n\t 's'll1٣éü中🙂.,#\x1c\x85\xa0\0  <|endoftext|>"


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.load_vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(vocabulary):
    ranks = {token: i for i, token in enumerate(vocabulary.tokens)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def random_texts(n, seed=1):
    rng = random.Random(seed)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(n)]
    return texts + ["", "a" * 3000, "é" * 2000, " " * 1000, "x " * 500, " \n \n" * 50]


def test_perfect_hash_is_minimal_and_finds_every_key():
    keys = [f"key {i}" for i in range(5000)]
    index = bpe.PerfectHash(keys)
    assert sorted(index.lookup(keys).tolist()) == list(range(5000))
    assert index.lookup(["stranger"])[0] in range(5000)


def test_equals_the_library(vocabulary, library):
    texts = random_texts(4000)
    encoder = bpe.Encoder(vocabulary, pieces=500, merges=200)
    ids, bounds = encoder.encode(texts)
    for text, a, b in zip(texts, bounds[:-1], bounds[1:], strict=True):
        assert ids[a:b].tolist() == library.encode_ordinary(text), repr(text)
    assert encoder.decode(ids, bounds) == [t.encode() for t in texts]


def test_documents(spark, vocabulary, library):
    texts = [*random_texts(50, 2), None]
    rows = [(i, t, i) for i, t in enumerate(texts)] + [(None, "no id", 0), (0, texts[0], 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = bpe.round_trip_digests(docs, vocabulary).collect()
    assert len(got) == len(rows)
    want = {r[0]: r[1] or "" for r in rows}
    for r in got:
        ids = library.encode_ordinary(want[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(want[r.doc_id].encode()).hexdigest()


def test_columns_in_and_out(spark, vocabulary, library):
    docs = spark.createDataFrame([(1, "some words", "x"), (2, None, "y")], "doc_id long, text string, data string")
    encoded = bpe.encode(docs, vocabulary, keep=("doc_id", "data"))
    assert {r.doc_id: r.ids for r in encoded.collect()} == {1: library.encode_ordinary("some words"), 2: []}
    decoded = bpe.decode(encoded, vocabulary, keep=("doc_id",))
    assert {r.doc_id: bytes(r.data) for r in decoded.collect()} == {1: b"some words", 2: b""}
    assert bpe.round_trip_digests(docs.limit(0), vocabulary).count() == 0
