"""Helpers shared by the operators: grouped Arrow streams, text blocks, packed words, stable folds."""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_CHARS = 2_000_000


def as_text(value: str | None) -> str:
    return "" if value is None else value


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``mapInArrow`` for functions of one batch; a ``None`` result is left out."""

    def run(batches):
        for batch in batches:
            out = fn(batch)
            if out is not None:
                yield out

    return df.mapInArrow(run, schema)


def text_blocks(texts: list[str], chars: int = BLOCK_CHARS) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of ``texts`` of about ``chars`` characters; bounds what one step holds besides its input."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= chars:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """``(key, rows)`` of each run of equal keys in a stream sorted by ``keys``. Holds one group at a time."""
    key, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = list(zip(*[batch.column(k).to_pylist() for k in keys], strict=True))
        start = 0
        for i in range(1, len(rows) + 1):
            if i < len(rows) and rows[i] == rows[start]:
                continue
            if held and rows[start] != key:
                yield key, pa.Table.from_batches(held)
                held = []
            key = rows[start]
            held.append(batch.slice(start, i - start))
            start = i
    if held:
        yield key, pa.Table.from_batches(held)


def map_groups(df: DataFrame, keys: list[str], order: list[str], fn, schema: str) -> DataFrame:
    """Apply ``fn(key, table) -> table`` to every group, rows sorted by ``order`` inside a group.

    Rows are shuffled by key and streamed in key order, so a task holds one group, not its whole partition,
    and many small groups cost no round trip each.
    """
    sorted_rows = df.repartition(*keys).sortWithinPartitions(*keys, *order)

    def run(batches):
        for key, table in grouped(batches, keys):
            out = fn(key, table)
            if out is not None and out.num_rows:
                yield from out.to_batches()

    return sorted_rows.mapInArrow(run, schema)


def remainder(column: str | Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``: the fold a row belongs to. Null for a null id."""
    text = (F.col(column) if isinstance(column, str) else column).cast("string")
    return F.crc32(text.cast("binary")) % F.lit(modulus)


def hash_sample(df: DataFrame, key: str, rows: int, total: int) -> DataFrame:
    """About ``rows`` of the ``total`` rows, chosen by a hash of ``key``, never more than twice as many."""
    if total <= rows:
        return df.limit(2 * rows)
    space = 1 << 30
    place = F.pmod(F.xxhash64(F.lit(17), F.col(key)), F.lit(space))
    return df.where(place < int(space * rows / total)).limit(2 * rows)


def vectors(column: pa.Array, dim: int) -> np.ndarray:
    """A list column without nulls, all of length ``dim``, as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), dim)


def usable_vectors(df: DataFrame, vec_id: str, vec: str, nonzero: bool) -> tuple[DataFrame, int]:
    """``(vec_id, vec)`` rows that can take part in a search, and their dimension.

    Left out: null ids and vectors, empty vectors, null, NaN or infinite components, the zero vector if
    ``nonzero``, and vectors whose length is not the commonest one (ties: the longer).
    """
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vec).alias("vec")).where(
        F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0)
    )
    kept = kept.where(~bad)
    if nonzero:
        kept = kept.where(F.exists("vec", lambda x: x != 0))
    lengths = kept.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    dim = lengths.dim if lengths else 0
    return kept.where(F.size("vec") == dim), dim
