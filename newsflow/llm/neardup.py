"""Near-duplicate documents by HyperMinHash.

1. Each whole text becomes its set of word shingles, kept as 64-bit hashes. The first bits of a hash choose one
   of 256 registers; a register keeps the smallest rest of a hash as a count of leading zeros (6 bits) and the
   next 10 bits as mantissa. Empty registers of short texts borrow from others by a fixed random walk.
2. Documents with the same set form one class; only its smallest id goes on. So exact copies never meet as pairs.
3. Bands of compressed registers make bucket keys (36 bands of 7 for a similarity of 0.85); a pair at the
   threshold shares no bucket with probability below 1e-5. Every document of a bucket is tied to the bucket's smallest id (no pairs), and the
   connected components of these ties are candidate clusters: each true link lies inside one.
4. Each cluster's documents are read once more with their texts. A cluster whose sets fit a block goes to one
   task; a larger one is dealt to blocks, and each pair of blocks is a task, so that no task holds more than two
   blocks however large a group is. In a task, pairs of documents that are not connected yet are screened by
   the collision-corrected similarity estimate and confirmed on the full sets; only a spanning forest leaves.
5. Components of the forest and of the class memberships give the result.

Work in step 4 is linear in the number of documents for groups that are dense (copies of copies); pairs that
stay unconnected must be screened one by one by any exact method, and are, vectorised.
"""

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pandas.util import hash_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import as_text, map_groups, text_blocks
from newsflow.llm.components import components
from newsflow.session import stage

LOWER = bytes(i + 32 if 65 <= i <= 90 else i for i in range(256))
REGISTERS, REGISTER_BITS = 256, 8
MANTISSA_BITS = 10
MISSED = 1e-5
BLOCK_SHINGLES = 3_000_000
SCREEN = 5.0
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) runs of anything but ASCII white space, as UTF-8."""
    return as_text(text).encode("utf-8", "surrogatepass").translate(LOWER).split()


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str | None], size: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its word shingles; fewer words than ``size`` make one."""
    texts = [as_text(t) for t in texts]
    for start, end in text_blocks(texts):
        tokens = [words(t) for t in texts[start:end]]
        flat = np.array([w for t in tokens for w in t], dtype=object)
        codes = hash_array(flat, categorize=False) if len(flat) else np.zeros(0, np.uint64)
        at = 0
        for own in map(len, tokens):
            part, at = codes[at : at + own], at + own
            if not own:
                yield part
                continue
            n = max(1, own - size + 1)
            mixed = np.full(n, min(own, size), dtype=np.uint64)
            for i in range(min(size, own)):
                mixed = _mix(mixed * MULTIPLIER + part[i : i + n])
            yield np.unique(mixed)


@lru_cache(maxsize=1)
def _walks() -> np.ndarray:
    """For each register the fixed order in which it looks for a filled one."""
    rng = np.random.default_rng(20_261)
    return np.stack([rng.permutation(REGISTERS) for _ in range(REGISTERS)])


def registers(hashes: np.ndarray) -> np.ndarray:
    """The HyperMinHash of a sorted non-empty set."""
    which = (hashes >> np.uint64(64 - REGISTER_BITS)).astype(np.int64)
    first = np.concatenate([[True], which[1:] != which[:-1]])
    low = hashes[first] << np.uint64(REGISTER_BITS)
    # 53 leading bits are plenty: exponent and mantissa of the double are the zeros and the bits behind them
    value = (low >> np.uint64(11)).astype(np.float64) + 0.5
    mantissa, exponent = np.frexp(value)
    zeros = np.minimum(53 - exponent, 63)
    tail = ((mantissa * 2 - 1) * (1 << MANTISSA_BITS)).astype(np.int64)
    packed = np.full(REGISTERS, -1, dtype=np.int64)
    packed[which[first]] = zeros << MANTISSA_BITS | tail
    empty = np.flatnonzero(packed < 0)
    if len(empty):
        walks = _walks()[empty]
        donor = walks[np.arange(len(empty)), (packed[walks] >= 0).argmax(1)]
        packed[empty] = packed[donor]
    return packed.astype(np.uint16)


def chance_collision() -> float:
    """Probability that two independent registers agree: same zeros (4**-z each) and same mantissa."""
    return sum(4.0 ** -(z + 1) for z in range(40)) / (1 << MANTISSA_BITS)


def similarity(equal_share: np.ndarray) -> np.ndarray:
    """Jaccard estimate from the share of equal registers, corrected for chance agreement."""
    p = chance_collision()
    return np.clip((equal_share - p) / (1 - p), 0.0, 1.0)


def band_rows(threshold: int) -> int:
    """The most registers a band may have so that a pair at the threshold is missed less than once in 100,000."""
    t = threshold / 100
    return max(r for r in range(1, 12) if r == 1 or (1 - t**r) ** (REGISTERS // r) < MISSED)


def band_keys(packed: np.ndarray, rows: int) -> np.ndarray:
    bands = REGISTERS // rows
    parts = packed[: bands * rows].reshape(bands, rows).astype(np.uint64)
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for i in range(rows):
        key = _mix(key * MULTIPLIER + parts[:, i])
    return key.view(np.int64)


def _sketches(size: int, rows: int):
    def run(batches):
        for batch in batches:
            counts, digests, keys = [], [], []
            for hashes in shingle_sets(batch.column(1).to_pylist(), size):
                counts.append(len(hashes))
                digests.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest() if len(hashes) else None)
                keys.append(band_keys(registers(hashes), rows) if len(hashes) else None)
            bands = pa.array(keys, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), bands],
                names=["doc_id", "n_shingles", "digest", "bands"],
            )

    return run


class Forest:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def find(self, i: int) -> int:
        root = self.root
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def union(self, i: int, j: int) -> bool:
        a, b = self.find(i), self.find(j)
        if a == b:
            return False
        self.root[max(a, b)] = min(a, b)
        return True

    def roots(self) -> np.ndarray:
        root = self.root
        while True:
            up = root[root]
            if (up == root).all():
                return root
            root = up


def _linked(a: np.ndarray, b: np.ndarray, threshold: int) -> bool:
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small) < threshold * len(large):
        return False
    at = np.searchsorted(large, small)
    common = int((large[np.minimum(at, len(large) - 1)] == small).sum())
    return 100 * common >= threshold * (len(a) + len(b) - common)


def spanning_links(ids: np.ndarray, sets: list[np.ndarray], side: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    """Links that connect what the pairs of linked sets connect.

    With both sides present, pairs are taken across them, otherwise all pairs. Pairs that are connected already
    are skipped: they cannot change the components.
    """
    n = len(ids)
    across = bool(side.any()) and not side.all()
    packed = np.stack([registers(s) for s in sets])
    counts = np.fromiter(map(len, sets), dtype=np.int64, count=n)
    t = threshold / 100
    # a short set fills few registers, so its estimate is that much coarser
    filled = REGISTERS * -np.expm1(-counts / REGISTERS)
    floor = t - SCREEN * np.sqrt(t * (1 - t) / filled)
    forest, links = Forest(n), []
    for same in ids_repeated(ids):
        for j in same[1:]:
            forest.union(same[0], j)
    live = side == 1 if across else np.ones(n, dtype=bool)
    for i in np.lexsort((ids, -counts)):
        if across and side[i] == 1:
            continue
        if not across:
            live[i] = False
        forest.root = roots = forest.roots()
        low, high = np.minimum(counts, counts[i]), np.maximum(counts, counts[i])
        maybe = np.flatnonzero(live & (roots != roots[i]) & (100 * low >= threshold * high))
        if not len(maybe):
            continue
        share = (packed[maybe] == packed[i]).mean(1)
        for j in maybe[similarity(share) >= np.minimum(floor[maybe], floor[i])]:
            if forest.find(i) != forest.find(j) and _linked(sets[i], sets[j], threshold):
                forest.union(i, j)
                links.append((int(ids[i]), int(ids[j])))
    return links


def ids_repeated(ids: np.ndarray) -> list[list[int]]:
    """Positions of ids that occur more than once."""
    if len(np.unique(ids)) == len(ids):
        return []
    places: dict[int, list[int]] = {}
    for i, x in enumerate(ids.tolist()):
        places.setdefault(x, []).append(i)
    return [p for p in places.values() if len(p) > 1]


def _confirm(size: int, threshold: int):
    def run(key, table):
        ids = table.column("doc_id").to_numpy()
        side = table.column("side").to_numpy()
        sets = list(shingle_sets(table.column("text").to_pylist(), size))
        kept = [i for i, s in enumerate(sets) if len(s)]
        if len(kept) < 2:
            return None
        links = spanning_links(ids[kept], [sets[i] for i in kept], side[kept], threshold)
        return pa.table(
            {"u": pa.array([u for u, _ in links], pa.int64()), "v": pa.array([v for _, v in links], pa.int64())}
        )

    return run


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    threshold: int = 80,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Documents are linked when ``100 * |A & B| >= threshold * |A | B|`` for their shingle sets. ``component_id`` is
    the smallest id reachable over links, ``kept`` marks it. A null, empty or blank text has an empty set and is
    linked with nothing. An id that repeats names one document: its rows share a component, and each row keeps
    its own set size. Rows without an id are not linked: their component is null and they are kept. Other
    columns are not read. An empty table gives no rows.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sketch = stage(
        texts.mapInArrow(_sketches(shingle, band_rows(threshold)), "doc_id long, n_shingles long, digest binary, bands array<long>"), "sketch"
    )
    filled = sketch.where("doc_id is not null and digest is not null")
    # bands of one class are equal, so any row's do; ties are resolved by value, not by arrival
    classes = stage(
        filled.groupBy("digest").agg(
            F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n_shingles"), F.max("bands").alias("bands")
        ),
        "classes",
    )
    member = filled.select("doc_id", "digest").join(classes.select("digest", "rep"), "digest")
    same_set = member.where("doc_id <> rep").select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))

    in_bucket = classes.select("rep", F.explode("bands").alias("bucket"))
    shared = in_bucket.groupBy("bucket").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low <> high")
    ties = in_bucket.join(shared.select("bucket", "low"), "bucket").where("rep <> low")
    clusters = components(ties.select(F.col("rep").alias("u"), F.col("low").alias("v")))

    weights = classes.groupBy("rep").agg(F.sum("n_shingles").alias("weight"))
    placed = clusters.join(weights, F.col("node") == F.col("rep")).select("node", "component", "weight")
    blocks = placed.groupBy("component").agg(F.ceil(F.sum("weight") / F.lit(block_shingles)).cast("int").alias("n_blocks"))
    placed = placed.join(blocks, "component").select(
        F.col("node").alias("doc_id"),
        "component",
        F.pmod(F.xxhash64(F.lit(3), "node"), F.col("n_blocks")).cast("int").alias("block"),
        "n_blocks",
    )
    candidates = (
        texts.join(placed, "doc_id")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
        .select(
            "component",
            F.least("block", "other").alias("low_block"),
            F.greatest("block", "other").alias("high_block"),
            F.when(F.col("block") <= F.col("other"), 0).otherwise(1).alias("side"),
            "doc_id",
            "text",
        )
    )
    links = map_groups(
        candidates, ["component", "low_block", "high_block"], ["doc_id"], _confirm(shingle, threshold), "u long, v long"
    )
    found = components(links.unionByName(same_set))
    return (
        sketch.select("doc_id", "n_shingles")
        .join(found, F.col("doc_id") == F.col("node"), "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)))
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with one document of each component, all columns kept. Of an id that repeats, one row stays
    (the smallest text first); rows without an id stay."""
    kept = near_duplicates(docs, id_col, text_col, **how).where("kept and doc_id is not null").select("doc_id").distinct()
    with_id = docs.where(F.col(id_col).isNotNull())
    kept = kept.select(F.col("doc_id").alias(id_col))
    columns = F.struct(*docs.columns)
    # rows of one id and one text are ordered by their other columns, never by arrival
    first = F.min_by(columns, F.struct(F.coalesce(F.col(text_col), F.lit("")), F.xxhash64(*docs.columns)))
    single = with_id.join(kept, id_col, "left_semi").groupBy(F.col(id_col).alias("_id")).agg(first.alias("_row"))
    return single.select("_row.*").unionByName(docs.where(F.col(id_col).isNull()))
