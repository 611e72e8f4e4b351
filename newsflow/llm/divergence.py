"""How far the sources of a language differ in their words, by hash-consed segment trees over term ids.

1. Terms are counted per (lang, source) and task, added up, and joined with those that enough documents of their
   language hold. Kept terms are dealt to segments of about ``SEGMENT_TERMS`` ids of similar document frequency, so that
   segments of rare terms are mostly zeros.
2. A task has one segment and at most two blocks of sources. It builds the count tree of every source over the
   segment's ids, level by level, and gives one id to equal subtrees, whichever tree and place they are in.
3. Two trees are walked together from their roots: each distinct pair of nodes is followed once and carries the
   number of places where it occurs. Pairs of the same node under equal totals cost nothing. Distinct pairs of leaves
   are priced once, in whole numbers.
4. Prices of segments are added up per pair of sources; the terms that stand out are the best of each segment's best.

A task holds no more than ``2 * block`` sources times a segment, whatever the number of sources and terms is.
"""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsflow.llm.common import as_text, map_groups
from newsflow.operators.skew import lookup_join
from newsflow.session import stage

TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = bytes(i + 32 if 65 <= i <= 90 else i for i in range(256))
LEAST_DOCUMENTS = 10
TOP_TERMS = 10
SEGMENT_TERMS = 3_000
BLOCK_SOURCES = 64
SCALE = 1_000_000_000
FLUSH_TERMS = 500_000
WALK_CELLS = 2_000_000
NO_TERM = -1


def terms(text: str | None) -> list[bytes]:
    """The runs of letters (A-Z, a-z and everything beyond ASCII) as UTF-8, A-Z lower-cased."""
    return TERM.findall(as_text(text).encode("utf-8", "surrogatepass").translate(LOWER))


def _count(batches):
    """Counts and document counts per group and term, added up in the task; a group without terms is a row too."""
    counts, holders = defaultdict(Counter), defaultdict(Counter)
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("n", pa.int64()), ("docs", pa.int64())])

    def rows():
        flat = [(*g, t, n, holders[g][t]) for g, own in counts.items() for t, n in own.items()]
        flat += [(*g, None, 0, 0) for g in counts]
        counts.clear()
        holders.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k.type) for c, k in zip(zip(*flat, strict=True), schema, strict=True)], schema=schema
        )

    held = 0
    for batch in batches:
        for text, *group in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            found, group = terms(text), tuple(group)
            counts[group].update(found)
            holders[group].update(set(found))
            held += len(found)
            if held > FLUSH_TERMS and sum(map(len, counts.values())) > FLUSH_TERMS:
                yield rows()
            held = held if held <= FLUSH_TERMS else 0
    if counts:
        yield rows()


def shares(counts: np.ndarray, total: int, size: int) -> np.ndarray:
    """``1 + floor(SCALE * (count + 2) / (total + 2 * size))``, exact for counts of any size."""
    if len(counts) and int(counts.max()) > (1 << 62) // SCALE:
        return np.array([1 + SCALE * (int(c) + 2) // (total + 2 * size) for c in counts], dtype=np.int64)
    return 1 + SCALE * (counts + 2) // (total + 2 * size)


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """``floor((p - q)^2 / (p + q))``; shares are at most ``SCALE + 1``, so squares fit 64 bits."""
    return (p - q) ** 2 // (p + q)


class Trees:
    """Count trees of several sources over the same ids. A node is a number; equal subtrees are the same number."""

    def __init__(self, counts: np.ndarray):
        """``counts``: a row per source, a column per id."""
        width = max(1, 1 << max(0, counts.shape[1] - 1).bit_length())
        padded = np.full((len(counts), width), NO_TERM, dtype=np.int64)
        padded[:, : counts.shape[1]] = counts
        self.leaves, nodes = np.unique(padded, return_inverse=True)
        nodes = nodes.reshape(padded.shape)
        self.levels = []
        size = len(self.leaves)
        while nodes.shape[1] > 1:
            both, above = np.unique(nodes[:, ::2] * size + nodes[:, 1::2], return_inverse=True)
            self.levels.append((both // size, both % size))
            nodes, size = above.reshape(len(nodes), -1), len(both)
        self.roots = nodes[:, 0]
        self.width = width

    def walk(self, first: np.ndarray, second: np.ndarray, alike: np.ndarray):
        """``(pair, leaf of first, leaf of second, places)`` for pairs of trees, every distinct pair of nodes followed once.

        ``alike`` marks pairs under equal totals, in which the same node on both sides needs no visit. The result is
        sorted by pair.
        """
        pair = np.arange(len(first))
        x, y, times = self.roots[first], self.roots[second], np.ones(len(first), dtype=np.int64)
        for level in range(len(self.levels), -1, -1):
            needed = ~(alike[pair] & (x == y))
            pair, x, y, times = pair[needed], x[needed], y[needed], times[needed]
            if not level:
                return pair, x, y, times
            left, right = self.levels[level - 1]
            size = len(self.levels[level - 2][0]) if level > 1 else len(self.leaves)
            key = np.concatenate([(pair * size + left[x]) * size + left[y], (pair * size + right[x]) * size + right[y]])
            order = np.argsort(key, kind="stable")
            key, times = key[order], np.concatenate([times, times])[order]
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
            times = np.add.reduceat(times, starts) if len(starts) else times
            key = key[starts]
            pair, x, y = key // (size * size), key // size % size, key % size


def price_pairs(trees: Trees, p: np.ndarray, totals: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The summed gap of each pair of trees; ``p`` has the share of every leaf value for every source."""
    value = np.zeros(len(first), dtype=np.int64)
    step = max(1, WALK_CELLS // trees.width)
    for start in range(0, len(first), step):
        g, h = first[start : start + step], second[start : start + step]
        pair, x, y, times = trees.walk(g, h, totals[g] == totals[h])
        real = trees.leaves[x] != NO_TERM
        pair, x, y, times = pair[real], x[real], y[real], times[real]
        np.add.at(value, start + pair, gap(p[g[pair], x], p[h[pair], y]) * times)
    return value


def _segment(top: int):
    def run(key, table):
        _, _, _, low, high = key
        lang = key[0]
        rows = table.to_pydict()
        source, block, term, n = rows["source"], rows["block"], rows["term"], rows["n"]
        roster = {s: i for i, s in enumerate(sorted(s for s, t in zip(source, term, strict=True) if t is None))}
        names, totals, of_block = list(roster), np.zeros(len(roster), np.int64), np.zeros(len(roster), np.int64)
        size = lang_total = width = 0
        found = {}
        for i, t in enumerate(term):
            if t is None:
                at = roster[source[i]]
                totals[at], of_block[at] = n[i], block[i]
                size, lang_total, width = rows["size"][i], rows["lang_n"][i], rows["width"][i]
            else:
                found[t] = rows["lang_n"][i]
        # frequent terms first, so that the rest of a source without rare terms is one run of zeros
        ids = {t: i for i, t in enumerate(sorted(found, key=lambda t: (-found[t], t)))}
        counts = np.zeros((len(names), width), dtype=np.int64)
        for i, t in enumerate(term):
            if t is not None:
                counts[roster[source[i]], ids[t]] = n[i]
        if low == high:
            first, second = np.triu_indices(len(names), 1)
        else:
            first, second = (x.ravel() for x in np.meshgrid(np.flatnonzero(of_block == low), np.flatnonzero(of_block == high)))
        value = np.zeros(len(first), dtype=np.int64)
        best = []
        if width:
            trees = Trees(counts)
            p = np.stack([shares(np.maximum(trees.leaves, 0), int(t), size) for t in totals])
            value = price_pairs(trees, p, totals, first, second)
            if low == high and found:
                best = _standing_out(counts, totals, ids, found, lang_total, size, top)
        name = np.array(names, dtype=object)
        return pa.table(
            {
                "lang": pa.array([lang] * (2 * len(first) + len(best)), pa.string()),
                "source": pa.array([*name[first], *name[second], *(names[g] for g, _, _ in best)], pa.string()),
                "part": pa.array(["pair"] * (2 * len(first)) + ["term"] * len(best), pa.string()),
                "item": pa.array([*name[second], *name[first], *(t.decode("utf-8", "surrogatepass") for _, t, _ in best)], pa.string()),
                "value": pa.array([*value.tolist(), *value.tolist(), *(v for _, _, v in best)], pa.int64()),
            }
        )

    return run


def _standing_out(counts, totals, ids, found, lang_total, size, top) -> list[tuple[int, bytes, int]]:
    """The ``top`` terms of each source whose share most exceeds that of the language."""
    by_name = sorted(ids)
    q = shares(np.array([found[t] for t in by_name], dtype=np.int64), lang_total, size)
    places = np.array([ids[t] for t in by_name])
    best = []
    for g, total in enumerate(totals):
        own = counts[g, places]
        at = np.flatnonzero(own)
        p = shares(own[at], int(total), size)
        at, p = at[p > q[at]], p[p > q[at]]
        value = gap(p, q[at])
        for i in np.lexsort((at, -value))[:top]:
            best.append((g, by_name[at[i]], int(value[i])))
    return best


def audit(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    least_documents: int = LEAST_DOCUMENTS,
    top: int = TOP_TERMS,
    segment_terms: int = SEGMENT_TERMS,
    block: int = BLOCK_SOURCES,
) -> DataFrame:
    """``lang, source, part, item, value, rank`` for every (lang, source) group of ``docs``.

    Part ``pair`` has a row for every other source of the language with the summed gap between both groups' shares of
    the language's kept terms, 0 if it keeps none; part ``term`` the ``top`` terms of a group whose share exceeds the
    language's. Ranks go by value, greatest first, then by item. Null texts, langs and sources count as empty. Every
    row is a document, so repeated rows count as often as they stand there. Other columns are not read. An empty
    table gives no rows. ``segment_terms`` and ``block`` change the division of the work, not the result.
    """
    texts = docs.select(
        F.col(text_col).alias("text"),
        F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
    )
    counted = texts.mapInArrow(_count, "lang string, source string, term binary, n long, docs long")
    counts = stage(counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "term-counts")

    octave = F.length(F.bin("docs"))
    kept = stage(
        counts.where("term is not null")
        .groupBy("lang", "term")
        .agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
        .where(F.col("docs") >= least_documents)
        .select("lang", "term", "lang_n", octave.alias("octave")),
        "kept-terms",
    )
    groups = counts.select("lang", "source").distinct()
    n_terms = F.count(F.lit(1))
    octaves = kept.groupBy("lang", "octave").agg(
        F.ceil(n_terms / F.lit(segment_terms)).alias("parts"), n_terms.alias("own"), F.sum("lang_n").alias("lang_n")
    )
    langs = octaves.groupBy("lang").agg(
        F.map_from_entries(F.collect_list(F.struct("octave", "parts"))).alias("parts"),
        F.sum("own").alias("size"),
        F.sum("lang_n").alias("lang_total"),
    )
    blocks = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("n_blocks"))
    langs = stage(blocks.join(langs, "lang", "left"), "langs")
    placed = lookup_join(kept, langs.select("lang", "parts", "n_blocks"), "lang", "term")
    part = F.pmod(F.xxhash64(F.lit(5), "term"), F.element_at("parts", F.col("octave"))).cast("int")
    placed = stage(placed.select("lang", "term", "lang_n", "octave", part.alias("part"), "n_blocks"), "placed-terms")

    own_block = F.pmod(F.xxhash64(F.lit(7), "source"), F.col("n_blocks")).cast("int")
    per_term = stage(
        counts.where("term is not null")
        .select("lang", "source", "term", "n")
        .join(placed, ["lang", "term"])
        .select("lang", "octave", "part", "source", own_block.alias("block"), "n_blocks", "term", "n", "lang_n"),
        "placed-counts",
    )
    totals = per_term.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    # a language that keeps no term has one segment without ids, so that its pairs get their zero
    widths = placed.groupBy("lang", "octave", "part").agg(F.count(F.lit(1)).alias("width"))
    segments = widths.groupBy("lang").agg(F.collect_list(F.struct("octave", "part", "width")).alias("segments"))
    nothing = F.array(F.struct(F.lit(0).alias("octave"), F.lit(0).alias("part"), F.lit(0).cast("long").alias("width")))
    roster = (
        groups.join(totals, ["lang", "source"], "left")
        .join(langs.drop("parts").join(segments, "lang", "left"), "lang")
        .withColumn("at", F.explode(F.coalesce("segments", nothing)))
        .select(
            "lang",
            "at.octave",
            "at.part",
            "source",
            own_block.alias("block"),
            "n_blocks",
            F.lit(None).cast("binary").alias("term"),
            F.coalesce("n", F.lit(0)).alias("n"),
            F.coalesce("lang_total", F.lit(0)).alias("lang_n"),
            F.coalesce("size", F.lit(0)).alias("size"),
            "at.width",
        )
    )
    zero = F.lit(0).cast("long")
    rows = (
        per_term.withColumn("size", zero)
        .withColumn("width", zero)
        .unionByName(roster)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .drop("other", "n_blocks")
    )
    schema = "lang string, source string, part string, item string, value long"
    found = map_groups(rows, ["lang", "octave", "part", "low", "high"], [], _segment(top), schema)
    found = stage(found, "segment-prices")
    pairs = found.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    ranked = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    best = found.where("part = 'term'").withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(ranked)).unionByName(best)
