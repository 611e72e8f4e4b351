"""Licence scan: exact phrases by word, and short notices with spelling differences.

Texts are reduced to their words (A-Z lower-cased, runs of digits, letters a-z and anything outside ASCII), joined
by single spaces. Base phrases are places where the words of a phrase stand in a row.

A short notice of m characters may differ by ``errors(m)`` edits. Cut into one piece more than that, at least one
piece survives unchanged (pigeonhole), so exact hits of pieces (one Aho-Corasick pass over all pieces of all
notices) find every place where the notice can be. Around them the regex library's bounded-error matching
verifies the edits and gives the span. Windows that touch are joined before verification. Every task holds one
text at a time besides its batch.
"""

import functools
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import as_text

#: Phrases whose exact places count, and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Short notices that the fuzzy search looks for, and their labels.
NOTICES = {
    "released under the mit license": "mit",
    "licensed under the mit license": "mit",
    "licensed under the apache license version 2 0": "apache-2",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "creative commons attribution noncommercial": "cc-by-nc",
    "licensed under the gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "mozilla public license version 2 0": "mpl-2",
    "redistribution and use in source and binary forms": "bsd",
    "all rights reserved": "all-rights-reserved",
}
CHARACTERS_PER_ERROR = 9
#: lower-cases A-Z and turns ASCII bytes outside words into spaces
TO_WORDS = bytes(
    i + 32 if 65 <= i <= 90 else i if 48 <= i <= 57 or 97 <= i <= 122 or i >= 128 else 32 for i in range(256)
)


class Finding(NamedTuple):
    label: str
    notice: str
    start: int
    end: int
    first_word: int
    edits: int


def errors(notice: str) -> int:
    """How many edits a notice may have."""
    return max(1, len(notice) // CHARACTERS_PER_ERROR)


def pieces(notice: str, edits: int) -> list[tuple[int, str]]:
    """``edits + 1`` pieces of about equal length and where they start: one is left whole by ``edits`` edits."""
    cuts = [len(notice) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def words_of(text: str | None) -> list[bytes]:
    return as_text(text).encode("utf-8", "surrogatepass").translate(TO_WORDS).split()


class Scanner:
    """Compiled phrases and notices."""

    def __init__(self, base: dict[str, str], notices: dict[str, str]):
        self.base = [(f" {p} ", label) for p, label in base.items()]
        self.notices = list(notices.items())
        self.allowed = [errors(n) for n, _ in self.notices]
        seeds: dict[str, list[tuple[int, int]]] = {}
        for i, (notice, _) in enumerate(self.notices):
            for at, piece in pieces(notice, self.allowed[i]):
                seeds.setdefault(piece, []).append((i, at))
        self.seeds = ahocorasick.Automaton()
        for piece, uses in seeds.items():
            self.seeds.add_word(piece, (len(piece), uses))
        self.seeds.make_automaton()
        self.matchers = [
            regex.compile(rf"(?e)(?<![^ ])(?:{regex.escape(n, literal_spaces=True)}){{e<={k}}}(?![^ ])")
            for (n, _), k in zip(self.notices, self.allowed, strict=True)
        ]

    def base_places(self, text: str) -> list[tuple[int, str]]:
        """(first word, label) of every place of a base phrase in a spaced text."""
        found = []
        for phrase, label in self.base:
            at = text.find(phrase)
            while at >= 0:
                found.append((text.count(" ", 0, at), label))
                at = text.find(phrase, at + 1)
        return found

    def windows(self, text: str) -> dict[int, list[tuple[int, int]]]:
        """For each notice the stretches of text that can hold it."""
        spans: dict[int, list[tuple[int, int]]] = {}
        for end, (size, uses) in self.seeds.iter(text):
            for i, at in uses:
                k = self.allowed[i]
                start = end + 1 - size - at - k - 1
                stop = start + len(self.notices[i][0]) + 2 * (k + 1)
                own = spans.setdefault(i, [])
                if own and start <= own[-1][1]:
                    own[-1] = (min(start, own[-1][0]), max(stop, own[-1][1]))
                else:
                    own.append((start, stop))
        return spans

    def notices_in(self, text: str) -> list[Finding]:
        """Verified notices in a spaced text: whole words, within the notice's edits, not overlapping."""
        found = set()
        for i, spans in self.windows(text).items():
            notice, label = self.notices[i]
            for start, stop in spans:
                for m in self.matchers[i].finditer(text, max(0, start), min(len(text), stop)):
                    edits = sum(m.fuzzy_counts)
                    found.add(Finding(label, notice, m.start(), m.end(), text.count(" ", 0, m.start()) - 1, edits))
        return sorted(found, key=lambda f: (f.start, f.end, f.notice))


@functools.lru_cache(maxsize=4)
def _scanner(base: tuple, notices: tuple) -> Scanner:
    return Scanner(dict(base), dict(notices))


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    base: dict[str, str] = BASE_PHRASES,
    notices: dict[str, str] = NOTICES,
) -> DataFrame:
    """One row per row of ``docs``:

    ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, notices``. ``first_word`` and
    ``last_word`` are the smallest and largest start of a base phrase (words from 0), else null. ``labels`` adds
    those of the verified notices; both lists are distinct, sorted and joined by commas, and empty if there are
    none. ``score`` is 1 with a base phrase, else the best ``1 - edits / length`` of a notice, else 0.
    ``notices`` lists the notices with first word, character span in the spaced words, and edits.

    A null text is empty. Repeated and null ids keep their rows, other columns are not read.
    """
    chosen = (tuple(base.items()), tuple(notices.items()))

    def run(batches):
        scanner = _scanner(*chosen)
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                tokens = words_of(text)
                spaced = (b" " + b" ".join(tokens) + b" ").decode("utf-8", "surrogatepass")
                places = scanner.base_places(spaced)
                found = scanner.notices_in(spaced)
                base_labels = {label for _, label in places}
                starts = [at for at, _ in places]
                near = max((1 - f.edits / len(f.notice) for f in found), default=0.0)
                rows.append(
                    {
                        "n_words": len(tokens),
                        "n_base": len(places),
                        "first_word": min(starts, default=None),
                        "last_word": max(starts, default=None),
                        "base_labels": ",".join(sorted(base_labels)),
                        "labels": ",".join(sorted(base_labels | {f.label for f in found})),
                        "score": 1.0 if places else max(0.0, near),
                        "notices": [f._asdict() for f in found],
                    }
                )
            yield _batch(batch.column(0), rows)

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(
        run,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string,"
        " score double, notices array<struct<label:string,notice:string,start:long,end:long,first_word:long,edits:int>>",
    )


NOTICE_TYPE = pa.struct(
    [
        ("label", pa.string()),
        ("notice", pa.string()),
        ("start", pa.int64()),
        ("end", pa.int64()),
        ("first_word", pa.int64()),
        ("edits", pa.int32()),
    ]
)
RESULT = [
    ("n_words", pa.int64()),
    ("n_base", pa.int64()),
    ("first_word", pa.int64()),
    ("last_word", pa.int64()),
    ("base_labels", pa.string()),
    ("labels", pa.string()),
    ("score", pa.float64()),
    ("notices", pa.list_(NOTICE_TYPE)),
]


def _batch(ids: pa.Array, rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [ids, *[pa.array([r[name] for r in rows], kind) for name, kind in RESULT]], names=["doc_id", *[n for n, _ in RESULT]]
    )
