"""Alignment of two tokenizers over the same bytes, with an identity map for the regular part.

A is a byte-level BPE in the format of the ``tokenizers`` library and reads space + text; B is a ``sentencepiece``
model, which adds that space itself. Byte offsets where tokens of both end cut them into groups; each A and B token
whose byte ranges overlap are linked.

1. A text is cut before every single space between two non-spaces. No token of A crosses such a place, and none of B
   if no piece has a space behind another character, which is checked when the models are loaded (otherwise a text
   is one segment). So a text's alignment is the sequence of its segments' alignments, and a worker remembers those of
   short segments that come again, as columns; a text is a list of places in them. New segments are tokenized many at a
   time, laid end to end. A text with a segment that does not give its bytes back is judged as a whole. Results are
   staged with the different links of each text and how often each comes, so that every text is tokenized once and
   later steps read what is little longer than the text has different words.
2. ``same`` maps each A id to the B id with the same bytes. A group of one A token and its ``same`` is exact and is
   counted in a vector as long as A's vocabulary. Only links of other groups are counted as pairs, added up in the
   task before they are shuffled.
3. Totals of the pairs are a table. Those of ``same`` pairs, the best count of each B id and the ``heavy`` most frequent
   other pairs go to the tasks; their number is bounded by the vocabularies and by ``heavy``. Links of rarer pairs are
   joined with the table; each of those pairs is rarer than one in ``heavy`` of the counted pairs, so none is hot.
"""

import hashlib
import os
import re
import weakref
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from newsflow.llm.common import as_text, text_blocks
from newsflow.session import stage

SPACE = "▁"
CUT = re.compile(r"(?<=\S)(?= \S)")
#: A space that is no cut, in space + text.
NO_CUT = re.compile(r" (?:(?<=\s )|\s|\Z)")
HEAVY_PAIRS = 1 << 17
BLOCK_BYTES = 400_000
BLOCK_LINKS = 250_000
PART_CHARS = 20_000
CACHED_SEGMENTS, CACHED_CHARS = 200_000, 64
FLUSH_PAIRS = 500_000
#: A pair of ids is one number: A's id in the upper, B's in the lower 32 bits.
SHIFT = 32


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable Latin-1 for itself, the rest from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(others)}


@dataclass(slots=True, eq=False)
class Segment:
    """The alignment of a piece of text: counts, groups as text, A ids of exact groups, pairs of the other links."""

    n_a: int
    n_b: int
    n_groups: int
    n_links: int
    groups: str
    exact: tuple[int, ...]
    pairs: tuple[int, ...]


@dataclass
class Segments:
    """Alignments of many segments as columns. A segment that a tokenizer does not give back has no tokens.

    ``counts`` has a row for each of ``NUMBERS``; row ``i`` of a list column lies from ``at[i]`` to ``at[i + 1]``.
    """

    counts: np.ndarray
    groups: list[str]
    exact: np.ndarray
    exact_at: np.ndarray
    pairs: np.ndarray
    pairs_at: np.ndarray

    @classmethod
    def none(cls) -> "Segments":
        start = np.zeros(1, dtype=np.int64)
        return cls(np.zeros((4, 0), dtype=np.int32), [], np.zeros(0, dtype=np.int32), start, np.zeros(0, dtype=np.int64), start)

    def __len__(self) -> int:
        return len(self.groups)

    def __getitem__(self, i: int) -> Segment | None:
        if not 0 <= i < len(self):
            raise IndexError(i)
        n_a, n_b, n_groups, n_links = self.counts[:, i].tolist()
        exact = self.exact[self.exact_at[i] : self.exact_at[i + 1]].tolist()
        pairs = self.pairs[self.pairs_at[i] : self.pairs_at[i + 1]].tolist()
        return Segment(n_a, n_b, n_groups, n_links, self.groups[i], tuple(exact), tuple(pairs)) if n_a else None

    def __add__(self, other: "Segments") -> "Segments":
        return Segments(
            np.concatenate([self.counts, other.counts], axis=1),
            self.groups + other.groups,
            np.concatenate([self.exact, other.exact]),
            np.concatenate([self.exact_at, other.exact_at[1:] + self.exact_at[-1]]),
            np.concatenate([self.pairs, other.pairs]),
            np.concatenate([self.pairs_at, other.pairs_at[1:] + self.pairs_at[-1]]),
        )

    def take(self, places: np.ndarray) -> "Segments":
        return Segments(
            self.counts[:, places],
            [self.groups[i] for i in places.tolist()],
            *taken(self.exact, self.exact_at, places),
            *taken(self.pairs, self.pairs_at, places),
        )


def taken(values: np.ndarray, at: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values of the rows at ``places`` end to end, where each row starts and the last ends) of a list column."""
    n = at[places + 1] - at[places]
    ends = np.concatenate([[0], np.cumsum(n)])
    return values[np.repeat(at[places] - ends[:-1], n) + np.arange(ends[-1])], ends


@dataclass
class Tokenizers:
    """Both models, as the bytes of their files, so that tasks need no file of the driver's."""

    a_json: str
    b_model: bytes

    def __getstate__(self):
        return {"a_json": self.a_json, "b_model": self.b_model}

    @cached_property
    def a(self) -> Tokenizer:
        loaded = Tokenizer.from_str(self.a_json)
        loaded.encode_special_tokens = True
        return loaded

    @cached_property
    def b(self) -> sentencepiece.SentencePieceProcessor:
        return sentencepiece.SentencePieceProcessor(model_proto=self.b_model)

    @cached_property
    def a_bytes(self) -> list[bytes]:
        alphabet = byte_alphabet()
        tokens = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size(True))]
        return [bytes(alphabet[c] for c in t) if all(c in alphabet for c in t) else t.encode() for t in tokens]

    @cached_property
    def b_bytes(self) -> list[bytes]:
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        return [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)
        ]

    @cached_property
    def same(self) -> list[int]:
        """The B id with the bytes of each A id, else -1. Of a byte's two forms the piece counts, not the fallback."""
        byte_last = sorted(range(len(self.b_bytes)), key=lambda i: not self.b.is_byte(i))
        known = {self.b_bytes[i]: i for i in byte_last}
        return [known.get(x, -1) for x in self.a_bytes]

    @cached_property
    def cuttable(self) -> bool:
        plain = (self.b.id_to_piece(i) for i in range(self.b.get_piece_size()) if not self.b.is_control(i))
        return not any(SPACE in p.lstrip(SPACE) for p in plain)

    @cached_property
    def aligner(self) -> "Aligner":
        """What a worker remembers, also for its next tasks; it goes when the models go, which no cycle may delay."""
        return Aligner(weakref.proxy(self))

    def segments(self, text: str) -> list[str]:
        """Text, cut where neither tokenizer can reach across; each cut takes a space away."""
        if not self.cuttable:
            return [text]
        return [s[1:] for s in CUT.split(" " + text)] if NO_CUT.search(" " + text) else text.split(" ")

    def align_all(self, segments: list[str]) -> Segments:
        """The alignment of each segment, which starts with a space."""
        of_a, of_b, sizes = [], [], []
        for start, end in text_blocks(segments, PART_CHARS):
            a, b, own = self.encode_joined(segments[start:end]) or self.encode_each(segments[start:end])
            of_a += a
            of_b += b
            sizes += own
        return align(np.array(of_a, dtype=np.int64), np.array(of_b, dtype=np.int64), np.array(sizes, dtype=np.int64), self.tables)

    def encode_joined(self, part: list[str]) -> tuple[list[int], list[int], list[int]] | None:
        """(ids of A, ids of B, bytes of each segment), encoded as one text; None unless it can be cut into them again."""
        joined = "".join(part)
        if len(part) > 1 and not (self.cuttable and CUT.split(joined) == part):
            return None
        a, b, raw = self.a.encode_batch_fast([joined], add_special_tokens=False)[0].ids, self.b.encode(joined[1:]), joined.encode()
        if b"".join([self.a_bytes[i] for i in a]) != raw or b"".join([self.b_bytes[i] for i in b]) != raw:
            return None
        return a, b, [len(s) for s in part] if len(raw) == len(joined) else [len(s.encode()) for s in part]

    def encode_each(self, part: list[str]) -> tuple[list[int], list[int], list[int]]:
        """The same, each encoded alone; no ids and no bytes of a segment that a tokenizer does not give back."""
        of_a = [e.ids for e in self.a.encode_batch_fast(part, add_special_tokens=False)]
        of_b = self.b.encode([s[1:] for s in part], num_threads=1)
        raw = [s.encode() for s in part]
        fits = (given_back(of_a, self.a_bytes, raw) & given_back(of_b, self.b_bytes, raw)).tolist()
        a = [i for ids, ok in zip(of_a, fits, strict=True) if ok for i in ids]
        b = [i for ids, ok in zip(of_b, fits, strict=True) if ok for i in ids]
        return a, b, [len(s) if ok else 0 for s, ok in zip(raw, fits, strict=True)]

    @cached_property
    def tables(self) -> "Tables":
        sides = (self.a_bytes, ",|"), (self.b_bytes, ",;")
        ids = [[f"{i}{sign}".encode() for i in range(len(own)) for sign in signs] for own, signs in sides]
        text = np.array([*ids[0], *ids[1]])
        return Tables(
            np.array([len(x) for x in self.a_bytes], dtype=np.int64),
            np.array([len(x) for x in self.b_bytes], dtype=np.int64),
            np.array(self.same, dtype=np.int64),
            text.view(np.uint8).reshape(len(text), -1),
            np.array([len(x) for own in ids for x in own], dtype=np.int64),
        )


@dataclass
class Tables:
    """By id: bytes of the tokens of A and of B, and ``same``.

    ``text`` has two rows of characters, filled up with zeros, for each id of A and then of B: the id inside and at the
    end of its side of a group; ``text_size`` their lengths.
    """

    a_size: np.ndarray
    b_size: np.ndarray
    same: np.ndarray
    text: np.ndarray
    text_size: np.ndarray


def given_back(ids: list[list[int]], token_bytes: list[bytes], raw: list[bytes]) -> np.ndarray:
    """Which of the tokenizations give their bytes back."""
    return np.array([b"".join([token_bytes[i] for i in own]) == text for own, text in zip(ids, raw, strict=True)], dtype=bool)


def load_tokenizers(a_path: str, b_path: str) -> Tokenizers:
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        return Tokenizers(a.read(), b.read())


def align(a: np.ndarray, b: np.ndarray, sizes: np.ndarray, tables: Tables) -> Segments:
    """Groups and links of segments whose tokens lie end to end, as ids of both tokenizers and bytes of each segment.

    Ends of tokens are byte offsets in one sequence. Between two neighbouring ends lies one link; an end of both cuts
    a group, and each segment ends in one.
    """
    upto = np.cumsum(sizes)
    in_a, in_b = np.zeros((2, int(upto[-1]) + 1 if len(sizes) else 1), dtype=bool)
    in_a[np.cumsum(tables.a_size[a])] = True
    in_b[np.cumsum(tables.b_size[b])] = True
    ends = np.flatnonzero(in_a | in_b)
    in_a, in_b = in_a[ends], in_b[ends]
    cut = in_a & in_b
    upto_a, upto_b, upto_cut = np.cumsum(in_a), np.cumsum(in_b), np.cumsum(cut)
    link_a, link_b = a[upto_a - in_a], b[upto_b - in_b]
    alone = cut & np.concatenate([[True], cut])[: len(cut)]
    exact = alone & (tables.same[link_a] == link_b)

    # the groups as text: of each group the ids of A, then those of B
    group = upto_cut - cut
    cut_at = np.flatnonzero(cut)
    at_a, at_b = np.flatnonzero(in_a), np.flatnonzero(in_b)
    b_before = np.concatenate([[0], upto_b[cut_at]])
    order = np.empty(len(a) + len(b), dtype=np.int64)
    order[np.arange(len(a)) + b_before[group[at_a]]] = 2 * a + cut[at_a]
    order[np.arange(len(b)) + upto_a[cut_at][group[at_b]]] = 2 * (len(tables.a_size) + b) + cut[at_b]
    text = tables.text[order].ravel()
    text = text[text != 0].tobytes().decode()
    text_upto = np.concatenate([[0], np.cumsum(tables.text_size[order])])

    last = np.searchsorted(ends, upto, "right")  # links before the end of each segment
    before = [np.concatenate([[0], x])[last] for x in (upto_a, upto_b, upto_cut, np.cumsum(exact))]
    counts = np.array([np.diff(x, prepend=0) for x in (*before[:3], last)], dtype=np.int32).reshape(4, -1)
    text_at = [0, *text_upto[before[0] + before[1]].tolist()]
    groups = [text[i : j - 1] if j > i else "" for i, j in zip(text_at[:-1], text_at[1:], strict=True)]
    exact_at, pairs_at = np.concatenate([[0], before[3]]), np.concatenate([[0], last - before[3]])
    return Segments(counts, groups, link_a[exact].astype(np.int32), exact_at, (link_a << SHIFT | link_b)[~exact], pairs_at)


class Aligner:
    """Alignments of texts as sequences of segments; remembers those of short segments, up to a fixed number.

    ``known`` has the place of each segment, in the order of ``found``; ``uses`` says how often it came.
    """

    def __init__(self, models: Tokenizers):
        self.models = models
        self.known: dict[str, int] = {}
        self.found = Segments.none()
        self.uses = np.zeros(0, dtype=np.int64)
        self.passing: list[str] = []

    def forget(self) -> None:
        """Drop what served the last texts only; if there are too many segments, also those that came once or least."""
        for segment in self.passing:
            del self.known[segment]
        self.passing = []
        keep = np.arange(min(len(self.known), len(self.uses)))
        if len(self.known) > CACHED_SEGMENTS:
            often = keep[self.uses[keep] > 1]
            keep = np.sort(often[np.argsort(-self.uses[often], kind="stable")[: CACHED_SEGMENTS // 2]])
            words = list(self.known)
            self.known = {words[i]: place for place, i in enumerate(keep.tolist())}
            self.uses = self.uses // 2
        if len(keep) < len(self.found):
            self.found, self.uses = self.found.take(keep), self.uses[keep]

    def add(self, segments: list[str]) -> None:
        self.found += self.models.align_all([" " + s for s in segments])
        self.uses = np.concatenate([self.uses, np.zeros(len(segments), dtype=np.int64)])

    def places(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(places in ``found`` of all segments, where each text starts and the last ends), until the next call.

        None for a text that is empty or not given back.
        """
        self.forget()
        cut = [self.models.segments(t) if t else [] for t in texts]
        words = list(chain.from_iterable(cut))
        new = sorted(set(words).difference(self.known), key=lambda s: len(s) > CACHED_CHARS)
        self.add(new)
        self.known.update(zip(new, range(len(self.known), len(self.found)), strict=True))
        self.passing = [s for s in new if len(s) > CACHED_CHARS]
        at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        starts = np.concatenate([[0], np.cumsum([len(own) for own in cut], dtype=np.int64)])
        self.uses += np.bincount(at, minlength=len(self.uses))
        lost = sums(self.found.counts[0][at] == 0, starts) > 0
        if lost.any():
            whole = np.flatnonzero(lost)
            first = len(self.found)
            self.add([texts[i] for i in whole.tolist()])
            own = dict(zip(whole.tolist(), range(first, len(self.found)), strict=True))
            rows = [
                at[starts[i] : starts[i + 1]] if i not in own else np.array([own[i]] if self.found.counts[0][own[i]] else [], np.int64)
                for i in range(len(texts))
            ]
            at, starts = np.concatenate(rows), np.concatenate([[0], np.cumsum([len(x) for x in rows])])
        return at, starts

    def texts(self, texts: list[str]) -> list[list[Segment]]:
        """The segments of each text; none for a text that is empty or not given back."""
        at, starts = self.places(texts)
        return [[self.found[i] for i in at[start:end].tolist()] for start, end in zip(starts[:-1], starts[1:], strict=True)]


#: The different links of a text, those that repeat first, and how often each of these comes.
LINKS = ["exact", "exact_n", "pairs", "pairs_n"]
ALIGNED_FIELDS = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "exact array<int>, exact_n array<int>, pairs array<long>, pairs_n array<int>"
)
NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]


def blocks(batch: pa.RecordBatch, sizes: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of ``batch`` of about ``most`` in all, each row of the size given."""
    edges = [0, *(np.flatnonzero(np.diff(np.cumsum(sizes) // most)) + 1).tolist(), batch.num_rows]
    for start, end in zip(edges[:-1], edges[1:], strict=True):
        yield batch.slice(start, end - start)


def linked_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the columns ``exact`` and ``pairs``, in batches that hold about ``BLOCK_LINKS`` links."""
    for batch in batches:
        lengths = [pc.list_value_length(batch.column(c)).to_numpy(zero_copy_only=False) for c in ("exact", "pairs")]
        yield from blocks(batch, lengths[0].astype(np.int64) + lengths[1], BLOCK_LINKS)


def per_row(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """(values of all rows end to end, where each row starts and the last ends) of a list column."""
    offsets = column.offsets.to_numpy()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), offsets - offsets[0]


def per_row_times(batch: pa.RecordBatch, name: str, at: np.ndarray) -> np.ndarray:
    """How often each value of the list column ``name``, whose rows start at ``at``, comes; once where the row does not say."""
    times = np.ones(at[-1], dtype=np.int64)
    if f"{name}_n" in batch.schema.names:
        more, more_at = per_row(batch.column(f"{name}_n"))
        times[np.arange(len(more)) + np.repeat(at[:-1] - more_at[:-1], np.diff(more_at))] = more
    return times


def tallied(values: np.ndarray, at: np.ndarray) -> tuple[pa.ListArray, pa.ListArray]:
    """(different values of each row, those that repeat first; how often each of these comes). Never more than ``values``."""
    known, place = np.unique(values, return_inverse=True)
    rows = len(at) - 1
    row = np.repeat(np.arange(rows), np.diff(at))
    own, times = np.unique(row * len(known) + place, return_counts=True)
    row, place = np.divmod(own, max(1, len(known)))
    more = times > 1
    starts, more_starts = (np.searchsorted(x, np.arange(rows + 1)) for x in (row, row[more]))
    return lists(starts, known[place[np.argsort(2 * row + ~more, kind="stable")]]), lists(more_starts, times[more].astype(np.int32))


def lists(at: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values))


def sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    before = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])[starts]
    return before[1:] - before[:-1]


def _aligned(models):
    def run(batches):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        aligner = models.value.aligner
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            for block in blocks(batch, sizes, BLOCK_BYTES):
                at, starts = aligner.places([as_text(t) for t in block.column(1).to_pylist()])
                found = aligner.found
                places, edges = at.tolist(), starts.tolist()
                digests = [
                    hashlib.sha256(";".join([found.groups[i] for i in places[start:end]]).encode()).hexdigest() if end > start else ""
                    for start, end in zip(edges[:-1], edges[1:], strict=True)
                ]
                exact, exact_at = taken(found.exact, found.exact_at, at)
                pairs, pairs_at = taken(found.pairs, found.pairs_at, at)
                yield pa.RecordBatch.from_arrays(
                    [
                        block.column(0),
                        *(pa.array(sums(column[at], starts)) for column in found.counts),
                        pa.array(digests, pa.string()),
                        *tallied(exact, exact_at[starts]),
                        *tallied(pairs, pairs_at[starts]),
                    ],
                    names=["doc_id", *NUMBERS, "groups_sha256", *LINKS],
                )

    return run


def _count(same):
    def run(batches):
        known = same.value
        vector = np.zeros(len(known), dtype=np.int64)
        held = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

        def rows(keys, counts, regular):
            names = ["pair", "n", "same"]
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts), pa.array(np.full(len(keys), regular))], names=names)

        for batch in linked_rows(batches):
            exact, exact_at = per_row(batch.column("exact"))
            np.add.at(vector, exact, per_row_times(batch, "exact", exact_at))
            keys, pairs_at = per_row(batch.column("pairs"))
            counts = per_row_times(batch, "pairs", pairs_at)
            merged, place = np.unique(np.concatenate([held[0], keys]), return_inverse=True)
            total = np.zeros(len(merged), dtype=np.int64)
            np.add.at(total, place, np.concatenate([held[1], counts]))
            held = merged, total
            if len(merged) > FLUSH_PAIRS:
                yield rows(*held, False)
                held = held[0][:0], held[1][:0]
        at = np.flatnonzero(vector)
        yield rows(at << SHIFT | known[at], vector[at], True)
        yield rows(*held, False)

    return run


@dataclass
class Totals:
    """Corpus-wide counts: of the ``same`` pair of each A id, the highest of each B id, and of the heavy pairs, sorted."""

    same: np.ndarray
    best: np.ndarray
    heavy: np.ndarray
    heavy_n: np.ndarray


def _priced(same, totals):
    def run(batches):
        known, to_b = totals.value, same.value
        for batch in linked_rows(batches):
            exact, exact_at = per_row(batch.column("exact"))
            pairs, pairs_at = per_row(batch.column("pairs"))
            exact_n, pairs_n = per_row_times(batch, "exact", exact_at), per_row_times(batch, "pairs", pairs_at)
            n = known.same[exact]
            n_best, count_sum = sums(exact_n * (n == known.best[to_b[exact]]), exact_at), sums(exact_n * n, exact_at)
            place = np.minimum(np.searchsorted(known.heavy, pairs), max(0, len(known.heavy) - 1))
            found = known.heavy[place] == pairs if len(known.heavy) else np.zeros(len(pairs), dtype=bool)
            n = np.where(found, known.heavy_n[place], 0) if len(known.heavy) else np.zeros(len(pairs), dtype=np.int64)
            n_best += sums(pairs_n * (found & (n == known.best[pairs & 0xFFFFFFFF])), pairs_at)
            count_sum += sums(pairs_n * n, pairs_at)
            cold_at = np.concatenate([[0], np.cumsum(sums(~found, pairs_at))])
            cold, cold_n = lists(cold_at, pairs[~found]), lists(cold_at, pairs_n[~found].astype(np.int32))
            kept = [c for c in batch.schema.names if c not in LINKS]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(n_best), pa.array(count_sum), cold, cold_n],
                names=[*kept, "n_best", "count_sum", "cold", "cold_n"],
            )

    return run


def _totals(pairs: DataFrame, models: Tokenizers, heavy: int) -> Totals:
    """What every task needs of the staged pair table. Fetches at most a row per A id and B id and ``heavy`` pairs."""
    a_size, b_size = len(models.same), len(models.b_bytes)
    best = np.zeros(b_size, dtype=np.int64)
    for row in pairs.groupBy((F.col("pair") % (1 << SHIFT)).cast("int").alias("b")).agg(F.max("n").alias("n")).collect():
        best[row.b] = row.n
    # the smallest count that at most ``heavy`` pairs reach, of counts rounded down to three binary digits
    tail = "greatest(length(bin(n)) - 3, 0)"
    level = F.expr(f"shiftleft(shiftright(n, {tail}), {tail})")
    reached, least = 0, None
    for row in sorted(pairs.where("not same").groupBy(level.alias("level")).count().collect(), key=lambda r: -r.level):
        reached += row["count"]
        if reached > heavy:
            break
        least = row.level
    same = np.zeros(a_size, dtype=np.int64)
    frequent = []
    chosen = F.col("same") if least is None else F.col("same") | (F.col("n") >= F.lit(least))
    for row in pairs.where(chosen).collect():
        if row.same:
            same[row.pair >> SHIFT] = row.n
        frequent.append((row.pair, row.n))
    table = np.array(sorted(frequent), dtype=np.int64).reshape(-1, 2)
    return Totals(same, best, table[:, 0].copy(), table[:, 1].copy())


def align_corpus(
    docs: DataFrame, models: Tokenizers, id_col: str = "doc_id", text_col: str = "text", heavy: int = HEAVY_PAIRS
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every row of ``docs``.

    ``n_best`` counts links whose pair is as frequent corpus-wide as the most frequent pair of its B id,
    ``count_sum`` adds up the corpus-wide counts of all links' pairs. Texts that are null, empty or not given back byte
    by byte by either tokenizer have no tokens: zeros and an empty digest; they count for nothing. Rows with null or
    repeated ids keep their own results; other columns are not read. An empty table gives no rows. ``heavy`` only
    decides which pairs are handed out and which are joined.
    """
    broadcast = docs.sparkSession.sparkContext.broadcast
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    aligned = texts.mapInArrow(_aligned(broadcast(models)), ALIGNED_FIELDS)
    aligned = stage(aligned.withColumn("row", F.monotonically_increasing_id()), "aligned")
    same = broadcast(np.array(models.same, dtype=np.int64))
    counted = aligned.select(*LINKS).mapInArrow(_count(same), "pair long, n long, same boolean")
    pairs = stage(counted.groupBy("pair").agg(F.sum("n").alias("n"), F.max("same").alias("same")), "pairs")
    totals = broadcast(_totals(pairs, models, heavy))
    fields = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, row long"
    prices = "n_best long, count_sum long, cold array<long>, cold_n array<int>"
    rows = stage(aligned.mapInArrow(_priced(same, totals), f"{fields}, {prices}"), "priced")
    best = pairs.groupBy((F.col("pair") % (1 << SHIFT)).alias("b")).agg(F.max("n").alias("most"))
    cold = rows.select("row", F.inline(F.arrays_zip("cold", "cold_n"))).toDF("row", "pair", "times")
    priced = (
        cold.join(pairs.select("pair", "n"), "pair")
        .withColumn("b", F.col("pair") % (1 << SHIFT))
        .join(F.broadcast(best), "b")  # one row per B id
        .groupBy("row")
        .agg(F.sum(F.col("times") * F.col("n")).alias("rest"), F.sum(F.when(F.col("n") == F.col("most"), F.col("times"))).alias("tops"))
    )
    return rows.drop("cold", "cold_n").join(priced, "row", "left").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        (F.col("n_best") + F.coalesce("tops", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("rest", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )
