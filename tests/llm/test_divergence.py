"""The audit against plain dictionaries, and its trees against plain sums."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from newsflow.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, part int, item string"


def brute(rows, least, top=10):
    words = [
        (lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))
        for text, lang, source in rows
    ]
    docs, counts, groups = Counter(), defaultdict(Counter), defaultdict(set)
    for lang, source, own in words:
        groups[lang].add(source)
        counts[lang, source].update(own)
        docs.update((lang, w) for w in set(own))
    out = []
    for lang, sources in groups.items():
        kept = [w for (of, w), n in docs.items() if of == lang and n >= least]
        whole = Counter()
        for s in sources:
            whole.update({w: counts[lang, s][w] for w in kept})

        def share(own):
            total = sum(own[w] for w in kept) + 2 * len(kept)
            return {w: 1 + 10**9 * (own[w] + 2) // total for w in kept}

        p, q = {s: share(counts[lang, s]) for s in sources}, share(whole)
        f = lambda x, y: (x - y) ** 2 // (x + y)
        for s in sources:
            pairs = [(-sum(f(p[s][w], p[o][w]) for w in kept), o.encode(), o) for o in sources if o != s]
            best = [(-f(p[s][w], q[w]), w.encode(), w) for w in kept if counts[lang, s][w] and p[s][w] > q[w]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(best)[:top])):
                out += [(lang, s, part, item, -v, i + 1) for i, (v, _, item) in enumerate(found)]
    return sorted(out)


def got(df):
    return sorted((r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in df.collect())


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    words = [f"{a}{b}{c}" for a in "abc" for b in "äßxyz" for c in "klmno日"]
    out = []
    for i in range(500):
        lang, source = ["en", "de", None][i % 3 if i % 2 else 0], f"s{int(rng.zipf(1.5)) % 9}"
        draw = rng.zipf(1.4, size=int(rng.integers(0, 40))) % len(words)
        out.append((" ".join(words[d].upper() if d % 7 == 0 else words[d] for d in draw) + " 12, x_y", lang, source))
    out += [("the same", "en", "s1")] * 25 + [(None, "en", "empty"), ("", "fr", None), (None, "fr", "b"), ("one", "it", "only")]
    out += [("wort " * 3000, "de", "long")]
    return out


@pytest.mark.parametrize("segment_terms, block", [(3_000, 64), (7, 64), (7, 2), (1, 1)])
def test_audit_equals_brute_force(spark, rows, segment_terms, block):
    docs = spark.createDataFrame([(i, *r, 1, "x") for i, r in enumerate(rows)], SCHEMA).repartition(4)
    assert got(divergence.audit(docs, least_documents=5, segment_terms=segment_terms, block=block)) == brute(rows, 5)


def test_no_kept_terms_and_empty_table(spark, rows):
    few = [("a b", "en", "x"), ("c", "en", "y"), (None, "en", "é")]
    docs = spark.createDataFrame([(i, *r, 1, "x") for i, r in enumerate(few)], SCHEMA)
    assert got(divergence.audit(docs)) == brute(few, 10)
    assert all(r[4] == 0 for r in brute(few, 10)) and len(brute(few, 10)) == 6
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).count() == 0


def test_equal_subtrees_are_one_node():
    counts = np.zeros((5, 1 << 12), dtype=np.int64)
    counts[1, 7] = counts[2, 7] = 3
    trees = divergence.Trees(counts)
    assert trees.roots[0] == trees.roots[3] and trees.roots[1] == trees.roots[2]
    # a zero node per level and, for the others, one more per level
    assert sum(len(left) for left, _ in trees.levels) == 2 * len(trees.levels)
    pair, x, y, times = trees.walk(np.array([0, 0]), np.array([1, 3]), np.array([False, True]))
    assert pair.tolist() == [0, 0] and sorted(times.tolist()) == [1, (1 << 12) - 1]


def test_walk_prices_like_a_plain_sum():
    rng = np.random.default_rng(8)
    for width in (1, 2, 3, 100, 129):
        counts = rng.poisson(0.4, (6, width))
        totals = counts.sum(1)
        trees = divergence.Trees(counts)
        p = np.stack([divergence.shares(np.maximum(trees.leaves, 0), int(t), width) for t in totals])
        first, second = np.triu_indices(6, 1)
        value = divergence.price_pairs(trees, p, totals, first, second)
        shares = [divergence.shares(c, int(t), width) for c, t in zip(counts, totals, strict=True)]
        assert value.tolist() == [int(divergence.gap(shares[g], shares[h]).sum()) for g, h in zip(first, second, strict=True)]


def test_shares_of_huge_counts_are_exact():
    counts = np.array([0, 10**13, 3 * 10**17])
    assert divergence.shares(counts, 4 * 10**17, 9).tolist() == [1 + 10**9 * (int(c) + 2) // (4 * 10**17 + 18) for c in counts]
