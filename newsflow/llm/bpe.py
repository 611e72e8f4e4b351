"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier 1: a minimal perfect hash over the vocabulary resolves a pre-token that is a token as a whole. It is
evaluated for all distinct pre-tokens of a block of text at once (numpy), and a compare with the stored key
rejects strangers. Tier 2: a miss is merged pair by pair, lowest rank first and leftmost among equals, with a
heap of candidate pairs over a doubly linked list of bytes, in O(n log n) for a pre-token of n bytes.

Before the pattern runs, texts are cut in front of single spaces. No pre-token crosses such a cut, so the
pattern and both tiers run once per distinct piece of a block. Where a space has white space on both sides
(or ends the text after white space) the cut is not safe, and that text goes through the pattern whole.

The vocabulary (some 50,000 tokens, fixed by its file) is read on the driver and broadcast. Memory per task is
bounded by a block of text and two generations of recent pieces and merges.
"""

import base64
import functools
import hashlib
import re
from collections.abc import Callable
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pandas.util import hash_array
from pyspark.sql import DataFrame

from newsflow.llm.common import as_text, text_blocks

UNSAFE_CUT = re.compile(r"\s (?:\s|\Z)")
RECENT_PIECES = 200_000
RECENT_MERGES = 300_000
DIRECT = np.uint64(1 << 63)
PLACE_BITS = 40
PLACE_MASK = (1 << PLACE_BITS) - 1


def read_ranks(path: str) -> list[bytes]:
    """Tokens in rank order from a rank file (base64 token, space, rank per line)."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    return [ranks[i] for i in range(len(ranks))]


class PerfectHash:
    """Minimal perfect hash of a fixed set of strings: hash, displace, compress.

    Keys fall into buckets by one part of a 64-bit hash. Buckets, largest first, each get the first seed that
    sends all their keys to free slots of a table that has exactly one slot per key.
    """

    def __init__(self, keys: list[str], per_bucket: int = 3):
        self.size = len(keys)
        self.n_buckets = max(1, -(-self.size // per_bucket))
        codes = self.codes(keys)
        self.seeds = np.zeros(self.n_buckets, dtype=np.uint64)
        taken = np.zeros(self.size, dtype=bool)
        self.slots = np.zeros(self.size, dtype=np.int64)
        buckets = (codes % np.uint64(self.n_buckets)).astype(np.int64)
        order = np.argsort(buckets, kind="stable")
        ends = np.cumsum(np.bincount(buckets, minlength=self.n_buckets))
        members = [order[(ends[b - 1] if b else 0) : ends[b]] for b in range(self.n_buckets)]
        big = [b for b in sorted(range(self.n_buckets), key=lambda b: -len(members[b])) if len(members[b]) > 1]
        for b in big:
            where, self.seeds[b] = self._free_seed(codes[members[b]], taken)
            taken[where] = True
            self.slots[members[b]] = where
        # a bucket of one key names its slot outright
        single = [b for b in range(self.n_buckets) if len(members[b]) == 1]
        free = np.flatnonzero(~taken)[: len(single)]
        self.seeds[single] = free.astype(np.uint64) | DIRECT
        self.slots[[members[b][0] for b in single]] = free

    def _free_seed(self, codes: np.ndarray, taken: np.ndarray, chunk: int = 64) -> tuple[np.ndarray, int]:
        """Slots and the smallest seed that sends ``codes`` to different free slots."""
        start = 0
        while True:
            seeds = np.arange(start, start + chunk, dtype=np.uint64)
            where = self._slot(codes[:, None], seeds[None, :])
            good = ~taken[where].any(0)
            for k in np.flatnonzero(good):
                if len(set(where[:, k].tolist())) == len(codes):
                    return where[:, k], int(seeds[k])
            start, chunk = start + chunk, min(2 * chunk, 8192)

    @staticmethod
    def codes(keys) -> np.ndarray:
        return hash_array(np.asarray(keys, dtype=object), categorize=False) if len(keys) else np.zeros(0, np.uint64)

    def _slot(self, codes: np.ndarray, seeds: np.ndarray) -> np.ndarray:
        mixed = (codes ^ (seeds * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(29)
        hashed = mixed % np.uint64(self.size)
        return np.where(seeds & DIRECT, seeds ^ DIRECT, hashed).astype(np.int64)

    def lookup(self, keys) -> np.ndarray:
        """The slot of each string; for a string outside the set, the slot of some other one."""
        codes = self.codes(keys)
        return self._slot(codes, self.seeds[(codes % np.uint64(self.n_buckets)).astype(np.int64)])


class Vocabulary:
    """What tasks need: the perfect hash with its keys and ids, the pair table, token bytes."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens, self.pattern = tokens, pattern
        words, ids = [], []
        for i, token in enumerate(tokens):
            try:
                words.append(token.decode())
            except UnicodeDecodeError:
                continue  # only ever a part of a pre-token
            ids.append(i)
        self.index = PerfectHash(words)
        by_slot = np.argsort(self.index.slots)
        self.slot_ids = np.asarray(ids, dtype=np.int32)[by_slot]
        self.slot_words = [words[i] for i in by_slot]

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("pairs", "byte_ids", "keys", "matcher", "packed", "pieces")}

    @functools.cached_property
    def matcher(self):
        return regex.compile(self.pattern)

    @functools.cached_property
    def keys(self) -> pa.Array:
        return pa.array(self.slot_words, pa.string())

    @functools.cached_property
    def packed(self) -> list[bytes]:
        """Id of each slot of the perfect hash as four bytes."""
        return [int(i).to_bytes(4, "little") for i in self.slot_ids]

    @functools.cached_property
    def pieces(self) -> pa.Array:
        return pa.array(self.tokens, pa.binary())

    @functools.cached_property
    def pairs(self) -> dict[int, int]:
        """(left id, right id) as one number to the id of the token they form."""
        ids = {token: i for i, token in enumerate(self.tokens)}
        found = {}
        for i, token in enumerate(self.tokens):
            for cut in range(1, len(token)):
                left, right = ids.get(token[:cut]), ids.get(token[cut:])
                if left is not None and right is not None:
                    found[left << 24 | right] = i
        return found

    @functools.cached_property
    def byte_ids(self) -> list[int]:
        ids = {token: i for i, token in enumerate(self.tokens)}
        return [ids[bytes([b])] for b in range(256)]

    def merge(self, word: str) -> list[int]:
        """Tier 2: ids of one pre-token that is no token as a whole."""
        find, byte_ids = self.pairs.get, self.byte_ids
        symbols = [byte_ids[b] for b in word.encode()]
        n = len(symbols)
        # an entry is the rank of a pair and the place of its left side in one number, so order is rank, then place
        heap = []
        for i in range(n - 1):
            merged = find(symbols[i] << 24 | symbols[i + 1])
            if merged is not None:
                heap.append(merged << PLACE_BITS | i)
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            entry = heappop(heap)
            i = entry & PLACE_MASK
            right = after[i]
            if right >= n or symbols[i] is None:
                continue
            merged = entry >> PLACE_BITS
            # stale when a side has changed since the push: then the pair that stands there has another rank
            if find(symbols[i] << 24 | symbols[right]) != merged:
                continue
            symbols[i], symbols[right] = merged, None
            behind = after[i] = after[right]
            if behind < n:
                before[behind] = i
                up = find(merged << 24 | symbols[behind])
                if up is not None:
                    heappush(heap, up << PLACE_BITS | i)
            left = before[i]
            if left >= 0:
                up = find(symbols[left] << 24 | merged)
                if up is not None:
                    heappush(heap, up << PLACE_BITS | left)
        return [s for s in symbols if s is not None]


class Recent:
    """A bounded memory of strings and their packed ids, in two generations. Long strings are not kept."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def fill(self, names: list[str], compute: Callable[[list[str]], list[bytes]]) -> list[bytes]:
        """Packed ids of distinct strings; ``compute`` is asked for the unknown ones."""
        young, old = self.young.get, self.old.get
        found = [young(x) or old(x) for x in names]
        unknown = [i for i, x in enumerate(found) if x is None]
        if unknown:
            fresh = compute([names[i] for i in unknown])
            if len(self.young) >= self.size:
                self.old, self.young = self.young, {}
            for i, ids in zip(unknown, fresh, strict=True):
                found[i] = ids
                if len(names[i]) < 48:
                    self.young[names[i]] = ids
        return found


class Encoder:
    """Encodes blocks of texts; remembers recent pieces and recent merges."""

    def __init__(self, vocabulary: Vocabulary, pieces: int = RECENT_PIECES, merges: int = RECENT_MERGES):
        self.v = vocabulary
        self.pieces, self.merges = Recent(pieces), Recent(merges)

    def _merged(self, words: list[str]) -> list[bytes]:
        return [np.array(self.v.merge(word), dtype=np.int32).tobytes() for word in words]

    def _pretokens(self, words: pa.Array) -> list[bytes]:
        """Packed ids of distinct pre-tokens: the perfect hash for whole tokens, merges for the rest."""
        slots = self.v.index.lookup(words.to_pylist())
        whole = pc.equal(self.v.keys.take(pa.array(slots)), words).to_numpy(zero_copy_only=False)
        packed = self.v.packed
        ids = [packed[s] for s in slots.tolist()]
        missed = np.flatnonzero(~whole)
        names = words.take(pa.array(missed)).to_pylist()
        for i, merged in zip(missed.tolist(), self.merges.fill(names, self._merged), strict=True):
            ids[i] = merged
        return ids

    def _split(self, pieces: list[str]) -> list[bytes]:
        """Packed ids of distinct pieces: the pattern, then both tiers on the distinct pre-tokens."""
        findall = self.v.matcher.findall
        parts = [findall(p) for p in pieces]
        words = pa.array([w for p in parts for w in p], pa.string()).dictionary_encode()
        by_word = self._pretokens(words.dictionary)
        flat = [by_word[i] for i in words.indices.to_numpy().tolist()]
        out, start = [], 0
        for part in parts:
            end = start + len(part)
            out.append(flat[start] if len(part) == 1 else b"".join(flat[start:end]))
            start = end
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each text's ids begin and the last ends)."""
        findall = self.v.matcher.findall
        pieces, bounds = [], [0]
        for text in texts:
            if UNSAFE_CUT.search(text):
                pieces.extend(findall(text))
            elif text:
                pieces.extend(text.replace(" ", "\0 ").split("\0") if "\0" not in text else findall(text))
            bounds.append(len(pieces))
        distinct = pa.array(pieces, pa.string()).dictionary_encode()
        packed = self.pieces.fill(distinct.dictionary.to_pylist(), self._split)
        sizes = np.fromiter(map(len, packed), dtype=np.int64, count=len(packed)) // 4
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        ids, ends = _take_lists(np.frombuffer(b"".join(packed), dtype=np.int32), offsets, distinct.indices.to_numpy())
        return ids, ends[np.asarray(bounds)]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """Bytes of each text."""
        taken = self.v.pieces.take(pa.array(ids))
        offsets = np.frombuffer(taken.buffers()[1], dtype=np.int32)[taken.offset : taken.offset + len(taken) + 1]
        data = memoryview(taken.buffers()[2]) if len(ids) else memoryview(b"")
        cuts = offsets[bounds] if len(ids) else np.zeros(len(bounds), dtype=np.int64)
        return [bytes(data[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _take_lists(values: np.ndarray, offsets: np.ndarray, indices: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenation of ``values[offsets[i]:offsets[i+1]]`` over ``indices``, and its offsets."""
    sizes = np.diff(offsets)[indices]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    shift = np.repeat(offsets[:-1][indices] - ends[:-1], sizes)
    return values[np.arange(ends[-1]) + shift], ends


def load_vocabulary(path: str, pattern: str) -> Vocabulary:
    return Vocabulary(read_ranks(path), pattern)


_ENCODERS: dict[tuple, Encoder] = {}


def _encoder(shared) -> Encoder:
    """One encoder per worker process and vocabulary, so that the pair table is built once."""
    v = shared.value
    key = (id(v), v.pattern, len(v.tokens))
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(v)
    return _ENCODERS[key]


def encode(
    docs: DataFrame, vocabulary: Vocabulary, text: str = "text", keep: tuple[str, ...] = ("doc_id",), out: str = "ids"
) -> DataFrame:
    """The columns ``keep`` and ``out``, an ``array<int>`` of the token ids of the whole text.

    A null text counts as empty and gives no ids. Rows are independent: repeated rows and nulls in ``keep``
    pass through, other columns are ignored. Special-token strings in a text are ordinary text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        encoder = _encoder(shared)
        for batch in batches:
            texts = [as_text(t) for t in batch.column(len(keep)).to_pylist()]
            for a, b in text_blocks(texts):
                ids, bounds = encoder.encode(texts[a:b])
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(i).slice(a, b - a) for i in range(len(keep))], lists], names=[*keep, out]
                )

    kept = docs.select(*keep)
    schema = kept.schema.simpleString()[len("struct<") : -1]
    return docs.select(*keep, text).mapInArrow(run, f"{schema},{out}:array<int>")


def decode(
    encoded: DataFrame, vocabulary: Vocabulary, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",), out: str = "data"
) -> DataFrame:
    """The columns ``keep`` and ``out``, the bytes that ``ids`` stand for. Null ids count as empty."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        encoder = _encoder(shared)
        for batch in batches:
            lists = pc.fill_null(batch.column(len(keep)), pa.scalar([], pa.list_(pa.int32())))
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
            data = pa.array(encoder.decode(lists.flatten().to_numpy(), bounds), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(len(keep))], data], names=[*keep, out]
            )

    schema = encoded.select(*keep).schema.simpleString()[len("struct<") : -1]
    return encoded.select(*keep, ids).mapInArrow(run, f"{schema},{out}:binary")


def round_trip_digests(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: encode each whole text, decode the ids, digest both.

    Encodes and decodes in one pass over the text, so that ids need not leave the task.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        encoder = _encoder(shared)
        for batch in batches:
            texts = [as_text(t) for t in batch.column(1).to_pylist()]
            for a, b in text_blocks(texts):
                ids, bounds = encoder.encode(texts[a:b])
                decoded = encoder.decode(ids, bounds)
                raw = memoryview(np.ascontiguousarray(ids, dtype="<u4").tobytes())
                spans = list(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array([e - s for s, e in spans], pa.int64()),
                        pa.array([hashlib.sha256(raw[4 * s : 4 * e]).hexdigest() for s, e in spans]),
                        pa.array([hashlib.sha256(x).hexdigest() for x in decoded]),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text].alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

