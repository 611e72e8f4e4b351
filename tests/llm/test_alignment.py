"""The alignment against one that looks at every pair of tokens of a whole text."""

import hashlib
import tracemalloc
from collections import Counter
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from newsflow.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "The cat's mat, 12345 isn't here.",
    "  two  spaces \n\n and\t tabs \r\n  end   ",
    " lead", "trail ", " ", "\n", "a b   c᠎ d \x1c e\x85 f",
    "Zürich größer naïve São Paulo — “quoted” … €5",
    "日本語のテキスト 中文 mixed 한국어 кириллица עברית 🙂🙃 👩‍👩‍👧",
    "<|endoftext|> <s> </s> <unk> <0x41> \x00 \x01",
    "▁ a piece mark ▁b", "", None,
    "aaaa aaa aa a aaaaaaaaaaaa", "x" * 3000, "word " * 500, "The cat's mat, 12345 isn't here.",
    "http://example.org/a?b=c&d=%20 foo_bar FooBar 3.14159e-10",
]


def brute(texts):
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    alphabet = alignment.byte_alphabet()
    docs = []
    for text in texts:
        links, groups, xs, ys = [], [], [], []
        if text:
            raw = (" " + text).encode()
            for i in a.encode(" " + text, add_special_tokens=False).ids:
                part = bytes(alphabet[c] for c in a.id_to_token(i))
                start = xs[-1][2] if xs else 0
                xs.append((i, start, start + len(part), part))
            for j in b.encode(text):
                piece = b.id_to_piece(j)
                part = bytes([int(piece[3:5], 16)]) if b.is_byte(j) else piece.replace("▁", " ").encode()
                start = ys[-1][2] if ys else 0
                ys.append((j, start, start + len(part), part))
            if b"".join(x[3] for x in xs) != raw or b"".join(y[3] for y in ys) != raw:
                xs, ys = [], []
            links = [(x[0], y[0]) for x in xs for y in ys if max(x[1], y[1]) < min(x[2], y[2])]
            ends = sorted({x[2] for x in xs} & {y[2] for y in ys})
            for low, high in zip([0, *ends], ends):
                groups.append(
                    ",".join(str(x[0]) for x in xs if low <= x[1] < high) + "|" + ",".join(str(y[0]) for y in ys if low <= y[1] < high)
                )
        docs.append((len(xs), len(ys), groups, links))
    counts = Counter(p for d in docs for p in d[3])
    best = Counter()
    for (_, j), n in counts.items():
        best[j] = max(best[j], n)
    return [
        (
            n_a, n_b, len(groups), len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "",
        )
        for n_a, n_b, groups, links in docs
    ]


@pytest.fixture(scope="module")
def models():
    return alignment.load_tokenizers(A, B)


@pytest.mark.parametrize("heavy", [0, 5, alignment.HEAVY_PAIRS])
def test_alignment_equals_brute_force(spark, models, heavy):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(3)
    got = alignment.align_corpus(docs, models, heavy=heavy).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == brute(TEXTS)
    assert sum(r.n_links > r.n_groups for r in got) > 5


def test_given_documents_equal_brute_force(spark, models):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) < 3000")
    rows = docs.select("doc_id", "text").orderBy("doc_id").collect()
    got = alignment.align_corpus(docs, models, heavy=50).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == brute([r.text for r in rows])


def test_segments_as_a_whole(models):
    texts = [t for t in TEXTS if t]
    whole = [models.align_all([" " + t])[0] for t in texts]
    cut = alignment.Aligner(models).texts(texts)
    for w, c in zip(whole, cut, strict=True):
        assert (w.groups if w else "") == ";".join(s.groups for s in c)
    # a full memory is emptied, not trusted
    small = alignment.Aligner(models)
    small.known = dict.fromkeys(range(alignment.CACHED_SEGMENTS + 1))
    assert [[s.groups for s in own] for own in small.texts(texts)] == [[s.groups for s in own] for own in cut]


def test_same_ids_have_same_bytes(models):
    pairs = [(i, j) for i, j in enumerate(models.same) if j >= 0]
    assert len(pairs) > 10_000 and all(models.a_bytes[i] == models.b_bytes[j] for i, j in pairs)
    assert models.cuttable


def test_odd_tables(spark, models):
    schema = "doc_id long, text string, row string, pair int, n int"
    assert alignment.align_corpus(spark.createDataFrame([], schema), models).count() == 0
    rows = [(None, "a b", "x", 1, 1), (1, None, "x", 1, 1), (1, "a b", None, 1, 1), (1, "a b", "x", 1, 1)]
    got = alignment.align_corpus(spark.createDataFrame(rows, schema), models).collect()
    assert sorted((r.doc_id or 0, r.n_a, r.count_sum) for r in got) == [(0, 2, 6), (1, 0, 0), (1, 2, 6), (1, 2, 6)]


def traced_mb(run):
    """(MB held after ``run``, most held meanwhile, its result)"""
    tracemalloc.start()
    try:
        out = run()
        return *(x / 1e6 for x in tracemalloc.get_traced_memory()), out
    finally:
        tracemalloc.stop()


def test_wide_batches_are_priced_in_blocks(models):
    rows, links = 4000, 1000
    exact = np.tile(np.arange(links), rows)
    pairs = np.tile(np.arange(links) << alignment.SHIFT | 7, rows)
    at = pa.array(np.arange(rows + 1) * links, pa.int32())
    columns = [pa.ListArray.from_arrays(at, pa.array(exact, pa.int32())), pa.ListArray.from_arrays(at, pa.array(pairs))]
    batch = pa.RecordBatch.from_arrays(columns, names=["exact", "pairs"])
    same = SimpleNamespace(value=np.array(models.same, dtype=np.int64))
    count = np.ones(len(models.same), dtype=np.int64)
    heavy = np.unique(pairs)[::2]
    totals = alignment.Totals(count, np.ones(len(models.b_bytes), dtype=np.int64), heavy, np.full(len(heavy), 3))
    _, most, out = traced_mb(lambda: list(alignment._count(same)([batch])))
    assert sum(pa.Table.from_batches(out)["n"].to_pylist()) == 2 * rows * links
    assert most < 150
    priced = alignment._priced(same, SimpleNamespace(value=totals))
    _, most, out = traced_mb(lambda: list(priced([batch])))
    table = pa.Table.from_batches(out)
    assert table["count_sum"].to_pylist() == [links + 3 * len(heavy)] * rows
    assert {len(c) for c in table["cold"].to_pylist()} == {links - len(heavy)}
    assert most < 150


def test_remembered_segments_are_small_and_survive_a_full_memory(models, monkeypatch):
    words = [f"w{i:x}" for i in range(40_000)]
    texts = [" ".join(words[i : i + 500]) for i in range(0, len(words), 500)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    models.align_all([" a"])  # tables are made
    _ = models.same, models.tables
    run = alignment._aligned(SimpleNamespace(value=models))
    list(run([batch.slice(0, 1)]))
    task = run(iter([batch]))
    held, _, out = traced_mb(lambda: [next(task)])
    out += list(task)
    assert held < 25
    assert sum(pa.Table.from_batches(out)["n_groups"].to_pylist()) >= len(words)

    # what came twice outlasts what came once; results stay
    monkeypatch.setattr(alignment, "CACHED_SEGMENTS", 1500)
    aligner = alignment.Aligner(models)
    common, rest = texts[0], texts[1:]
    asked = []
    encode = models.align_all
    monkeypatch.setattr(models, "align_all", lambda segments: asked.extend(segments) or encode(segments))
    for text in rest:
        got = aligner.texts([common, common, text])
        assert [s.groups for s in got[0]] == [s.groups for s in got[1]]
        assert ";".join(s.groups for s in got[2]) == encode([" " + text])[0].groups
        assert len(aligner.known) <= 1500 + 1000
    assert len(asked) == len(words)  # the common words were worked out once


def test_words_between_odd_spaces_are_those_of_the_pattern(models):
    for text in [t for t in TEXTS if t] + ["a\nb c", "a \nb", "a\n b", "\u3000a b", "a b\u3000", "a\x1c b", "a b ", "  a b", "a  b c"]:
        assert [" " + s for s in models.segments(text)] == alignment.CUT.split(" " + text)
    odd = [" a", " b ", "  c", " \u2581", " d", " é", " \n", " e"]
    got = models.align_all(odd)
    alone = [models.align_all([s])[0] for s in odd]
    assert [s and (s.n_a, s.n_b, s.groups, s.exact, s.pairs) for s in got] == [
        s and (s.n_a, s.n_b, s.groups, s.exact, s.pairs) for s in alone
    ]
    assert any(s is None for s in got) and sum(s is not None for s in got) >= 5


def test_links_that_repeat_in_a_text_are_kept_once(models):
    words = [f"{w}{i}" for i in range(10) for w in ("cat", "größer", "naïveté")]
    texts = [" ".join(words * 40), None, "", "cat", " ".join(["dog größe", *words * 40])]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    out = pa.Table.from_batches(list(alignment._aligned(SimpleNamespace(value=models))([batch])))
    whole = [s for s in models.align_all([" " + t for t in texts if t])]
    own = iter(whole)
    for row, text in zip(out.to_pylist(), texts, strict=True):
        segment = next(own) if text else None
        for name in ("exact", "pairs"):
            links = Counter(getattr(segment, name)) if segment else {}
            more = row[f"{name}_n"]
            assert min(more, default=2) > 1 and len(row[name]) == len(links)
            assert dict(zip(row[name], more + [1] * (len(links) - len(more)), strict=True)) == links
    assert sum(map(len, out["exact"].to_pylist())) + sum(map(len, out["pairs"].to_pylist())) < 0.05 * sum(out["n_links"].to_pylist())
    same = SimpleNamespace(value=np.array(models.same, dtype=np.int64))
    counted = pa.Table.from_batches(list(alignment._count(same)(out.select(alignment.LINKS).combine_chunks().to_batches())))
    assert sum(counted["n"].to_pylist()) == sum(out["n_links"].to_pylist())


def test_rare_links_that_repeat_count_each_time(spark, models):
    texts = ["größer12 " * 30 + "naïveté " * 7, "größer12 naïveté", "x" * 70 + " größer12"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for heavy in (0, 2):
        got = alignment.align_corpus(docs, models, heavy=heavy).orderBy("doc_id").collect()
        assert [tuple(r)[1:] for r in got] == brute(texts)
