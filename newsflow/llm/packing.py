"""Packing into optimal length buckets.

The histogram of token counts over all rows is one aggregate; it reaches the driver as at most
``EXACT + 128 * 51`` cells, because counts above ``EXACT`` share cells that are 1/128 wide. Dynamic programming over
the cells chooses bucket boundaries so that padding every document to its bucket's boundary wastes the fewest
tokens (divide and conquer over the monotone optimal split, O(buckets * cells * log cells)). A boundary is the
longest count that occurs in its last cell.

Inside a bucket, documents are batched in the order of a hash of the id so that ``rows * boundary`` stays
within the token budget. Places in a bucket are running counts over ranges of that hash, so a bucket that
holds a third of the table is not one task's work.
"""

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.operators.ordering import with_prior_count
from newsflow.session import stage

EXACT = 4096
STEPS = 128
BUCKETS = 32
TOKEN_BUDGET = 16_384


def word_count(text: Column) -> Column:
    """Runs of anything but ASCII white space; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def cell(n: Column) -> Column:
    """The histogram cell of a count: the count itself up to ``EXACT``, then 128 cells for each doubling."""
    high = F.floor(F.log2(n.cast("double") / EXACT) * STEPS).cast("long")
    return F.when(n <= EXACT, n).otherwise(F.lit(EXACT + 1) + high)


def optimal_boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> tuple[list[int], int]:
    """(last position of each bucket, padded tokens) for ascending ``lengths`` with ``counts``.

    Minimises the sum over documents of their bucket's longest length. Uses fewer buckets if there are fewer
    lengths. Ties go to the earlier split.
    """
    n = len(lengths)
    if not n:
        return [], 0
    buckets = min(buckets, n)
    before = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    lengths = np.asarray(lengths, dtype=np.int64)
    best = lengths * before[1:]
    splits = []
    for _ in range(1, buckets):
        fresh, where = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
        todo = [(0, n - 1, 0, n - 1)]
        while todo:
            low, high, first, last = todo.pop()
            if low > high:
                continue
            mid = (low + high) // 2
            # the bucket that ends at mid starts behind position k
            k = np.arange(first, min(last, mid - 1) + 1)
            cut = first
            if len(k):
                costs = best[k] + lengths[mid] * (before[mid + 1] - before[k + 1])
                at = int(costs.argmin())
                fresh[mid], where[mid], cut = costs[at], k[at], int(k[at])
            todo += [(low, mid - 1, first, max(cut, first)), (mid + 1, high, cut, last)]
        better = fresh < best
        splits.append(np.where(better, where, -2))
        best = np.where(better, fresh, best)
    ends, at = [], n - 1
    for split in reversed(splits):
        if split[at] == -2:
            continue
        ends.append(at)
        at = int(split[at])
    ends.append(at)
    return ends[::-1], int(best[-1])


def length_buckets(counted: DataFrame, buckets: int = BUCKETS) -> list[tuple[int, int]]:
    """``(last cell, boundary)`` of each bucket for a table with the column ``n_tokens``."""
    histogram = (
        counted.groupBy(cell(F.col("n_tokens")).alias("cell"))
        .agg(F.count(F.lit(1)).alias("n"), F.max("n_tokens").alias("longest"))
        .orderBy("cell")
        .collect()
    )
    lengths = np.array([r.longest for r in histogram], dtype=np.int64)
    ends, _ = optimal_boundaries(lengths, np.array([r.n for r in histogram], dtype=np.int64), buckets)
    return [(histogram[e].cell, histogram[e].longest) for e in ends]


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    tokens: Column | None = None,
    buckets: int = BUCKETS,
    token_budget: int = TOKEN_BUDGET,
) -> DataFrame:
    """``doc_id, n_tokens, bucket, bucket_tokens, batch, place`` for every row.

    ``tokens`` counts a row's tokens (words of ``text`` by default; null counts as 0). ``bucket_tokens`` is what
    the row is padded to, ``batch`` numbers batches inside the bucket from 0, ``place`` the rows inside a batch.
    A batch takes ``token_budget // bucket_tokens`` rows, at least one: a document longer than the budget is a
    batch of its own. Every row gets a place, repeated rows and null ids too (which of equal rows comes first
    does not show in the result). An empty table gives no rows. Other columns are not read.
    """
    n_tokens = F.coalesce((word_count(F.col("text")) if tokens is None else tokens).cast("long"), F.lit(0))
    counted = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.greatest(n_tokens, F.lit(0)).alias("n_tokens"))
    counted = stage(counted, "lengths")
    chosen = length_buckets(counted, buckets)
    in_cell = cell(F.col("n_tokens"))
    number, boundary = F.lit(None).cast("int"), F.lit(None).cast("long")
    for i, (last, longest) in reversed(list(enumerate(chosen))):
        number = F.when(in_cell <= last, i).otherwise(number)
        boundary = F.when(in_cell <= last, F.lit(longest)).otherwise(boundary)
    placed = counted.select("doc_id", "n_tokens", number.alias("bucket"), boundary.cast("long").alias("bucket_tokens"))
    # the order of a batch is a hash of the id; 31 bits of it make at most 2**17 ranges in a bucket
    placed = placed.withColumn("_pos", F.shiftrightunsigned(F.xxhash64(F.lit(5), "doc_id", "n_tokens"), 33))
    ordered = with_prior_count(placed, "_pos", ["bucket"], out="_at", bits=14)
    per_batch = F.greatest(F.floor(F.lit(token_budget) / F.greatest("bucket_tokens", F.lit(1))).cast("long"), F.lit(1))
    at = F.col("_at")
    return ordered.select(
        "doc_id", "n_tokens", "bucket", "bucket_tokens",
        F.floor(at / per_batch).cast("long").alias("batch"),
        (at % per_batch).alias("place"),
    )
