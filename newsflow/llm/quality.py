"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

Features of a document: its words, hashed to buckets and weighted by their share of the text, and one bucket
per structure statistic (its value cut into bins) of the whole text, plus the recorded length if there is one.
The score is

    sigmoid(w0 + sum_i w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2])

so all pairwise interactions cost time linear in the number of features of a document.

The machine is fitted on the driver by Adam on at most ``2 * max_train`` labelled documents, chosen by a hash of
the id; features of that sample are made on the executors. Scoring covers every row. Parameters are broadcast:
``buckets * (factors + 1)`` numbers, whatever the input.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pandas.util import hash_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import as_text, hash_sample, remainder, text_blocks

WORD_BUCKETS = 4096
BINS = 16
FACTORS = 8
MAX_TRAIN = 5_000
EPOCHS = 30
THRESHOLD = 0.3
STATISTICS = (
    "log_words", "word_length", "distinct_share", "repeat_share", "upper_share", "digit_share", "mark_share",
    "symbol_share", "space_share", "line_length", "wide_share", "shouted_share", "marked_words", "recorded_length",
)
N_FEATURES = WORD_BUCKETS + BINS * len(STATISTICS)

# classes of UTF-8 bytes: 0 other control, 1 space, 2 newline, 3 lower, 4 upper, 5 digit, 6 sentence mark, 7 symbol, 8 wide
BYTE_CLASS = np.zeros(256, dtype=np.uint8)
BYTE_CLASS[33:127] = 7
BYTE_CLASS[[9, 11, 12, 13, 32]] = 1
BYTE_CLASS[10] = 2
BYTE_CLASS[ord("a") : ord("z") + 1] = 3
BYTE_CLASS[ord("A") : ord("Z") + 1] = 4
BYTE_CLASS[ord("0") : ord("9") + 1] = 5
BYTE_CLASS[[ord(c) for c in ".,;:'\"()-?"]] = 6
BYTE_CLASS[128:] = 8


def statistics(text: str, words: list[str], recorded: int | None) -> list[float]:
    """Values of ``STATISTICS``, each between 0 and 1. Empty texts have all zero."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    n, n_words = max(1, len(raw)), max(1, len(words))
    seen = np.bincount(BYTE_CLASS[raw], minlength=9) / n
    letters = max(1e-9, seen[3] + seen[4])
    repeats = sum(a == b for a, b in zip(words, words[1:], strict=False))
    # ends and shapes of words tell markup, shouting and table cells from prose
    shouted = sum(w.isupper() for w in words)
    marked = sum(not w[-1].isalnum() and w[-1] not in ".,;:?" for w in words)
    return [
        min(1.0, np.log1p(len(words)) / 12),
        min(1.0, n / n_words / 24),
        len(set(words)) / n_words,
        repeats / n_words,
        seen[4] / letters,
        seen[5],
        min(1.0, 4 * seen[6]),
        min(1.0, 4 * seen[7]),
        min(1.0, 3 * seen[1]),
        min(1.0, np.log1p(n / (1 + seen[2] * n)) / 12),
        seen[8],
        shouted / n_words,
        marked / n_words,
        0.0 if not recorded or recorded < 0 else min(1.0, np.log1p(recorded) / 14),
    ]


def features(texts: list[str], recorded: list[int | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature ids, values, where each text's features begin) of a block of texts."""
    words = [t.split() for t in texts]
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    flat = pa.array([w for ws in words for w in ws], pa.string()).dictionary_encode()
    names = np.array(flat.dictionary.to_pylist(), dtype=object)
    codes = hash_array(names, categorize=False) if len(names) else np.zeros(0, np.uint64)
    bucket = (codes % np.uint64(WORD_BUCKETS)).astype(np.int64)[flat.indices.to_numpy()]
    doc = np.repeat(np.arange(len(texts)), sizes)
    cells, counts = np.unique(doc * WORD_BUCKETS + bucket, return_counts=True)
    word_doc, word_id = cells // WORD_BUCKETS, cells % WORD_BUCKETS
    word_value = np.sqrt(counts / np.maximum(1, sizes)[word_doc])

    stats = np.array([statistics(t, w, r) for t, w, r in zip(texts, words, recorded, strict=True)])
    bins = np.minimum((stats * BINS).astype(np.int64), BINS - 1)
    n_stats = len(STATISTICS)
    stat_id = (WORD_BUCKETS + np.arange(n_stats) * BINS + bins).ravel()
    stat_doc = np.repeat(np.arange(len(texts)), n_stats)
    stat_value = np.full(len(stat_id), 1 / np.sqrt(n_stats))

    docs = np.concatenate([word_doc, stat_doc])
    order = np.argsort(docs, kind="stable")
    ids = np.concatenate([word_id, stat_id])[order]
    values = np.concatenate([word_value, stat_value])[order]
    starts = np.searchsorted(docs[order], np.arange(len(texts)))
    return ids, values, starts


@dataclass
class Machine:
    """Parameters of a factorisation machine; ``weights`` holds the linear term and the factors of a feature."""

    bias: float
    weights: np.ndarray

    def margins(self, ids, values, starts) -> np.ndarray:
        w = self.weights[ids] * values[:, None]
        linear = np.add.reduceat(w[:, 0], starts)
        sums = np.add.reduceat(w[:, 1:], starts)
        squares = np.add.reduceat(w[:, 1:] ** 2, starts)
        return self.bias + linear + 0.5 * (sums**2 - squares).sum(1)

    def scores(self, ids, values, starts) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(ids, values, starts), -40, 40)))


def fit_machine(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Machine:
    """Minimise log loss with weight decay by Adam over batches of documents. No rows, or one class only, give a
    machine that scores every document with the smoothed share of label 1."""
    rng = np.random.default_rng(seed)
    share = (labels.sum() + 1) / (len(labels) + 2)
    machine = Machine(float(np.log(share / (1 - share))), np.zeros((N_FEATURES, 1 + FACTORS)))
    if not len(labels) or labels.min() == labels.max():
        return machine
    machine.weights[:, 1:] = rng.normal(0, 0.05, (N_FEATURES, FACTORS))
    weights = machine.weights
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    bias_moments, step, rate = [0.0, 0.0], 0, 0.02
    for _ in range(epochs):
        for batch in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // 128)):
            ids = np.concatenate([rows[i][0] for i in batch])
            values = np.concatenate([rows[i][1] for i in batch])
            sizes = np.array([len(rows[i][0]) for i in batch])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            error = (machine.scores(ids, values, starts) - labels[batch]) / len(batch)
            own = np.repeat(error, sizes) * values
            sums = np.add.reduceat(weights[ids, 1:] * values[:, None], starts)
            part = np.empty((len(ids), 1 + FACTORS))
            part[:, 0] = own
            part[:, 1:] = own[:, None] * (np.repeat(sums, sizes, axis=0) - weights[ids, 1:] * values[:, None])
            order = np.argsort(ids, kind="stable")
            touched, runs = np.unique(ids[order], return_index=True)
            grad = np.add.reduceat(part[order], runs) + 1e-5 * weights[touched]
            step += 1
            first[touched] = 0.9 * first[touched] + 0.1 * grad
            second[touched] = 0.99 * second[touched] + 0.01 * grad**2
            lift = rate * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
            weights[touched] -= lift * first[touched] / (np.sqrt(second[touched]) + 1e-8)
            g = error.sum()
            bias_moments = [0.9 * bias_moments[0] + 0.1 * g, 0.99 * bias_moments[1] + 0.01 * g * g]
            machine.bias -= lift * bias_moments[0] / (np.sqrt(bias_moments[1]) + 1e-8)
    return machine


def _inputs(docs: DataFrame, id_col: str, text_col: str, recorded_col: str | None) -> DataFrame:
    recorded = F.col(recorded_col).cast("long") if recorded_col in docs.columns else F.lit(None).cast("long")
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), recorded.alias("recorded")
    )


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    recorded_col: str | None = "n_chars",
    max_train: int = MAX_TRAIN,
) -> Machine:
    """Fit on labelled documents whose crc32(id as text) modulo 5 is not 0.

    Only labels 0 and 1 count; an id that is labelled both ways counts as 0. Ids or labels that are null teach
    nothing; of an id that repeats one row teaches. ``max_train`` bounds the sample (see module text).
    """
    known = (
        labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
        .where("doc_id is not null and label in (0, 1)")
        .where(remainder("doc_id", 5) != 0)
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
    )
    sample = hash_sample(known, "doc_id", max_train, known.count())
    rows = _inputs(docs, id_col, text_col, recorded_col).join(F.broadcast(sample), "doc_id")

    def run(batches):
        for batch in batches:
            texts = [as_text(t) for t in batch.column(1).to_pylist()]
            recorded = batch.column(2).to_pylist()
            for a, b in text_blocks(texts):
                ids, values, starts = features(texts[a:b], recorded[a:b])
                ends = pa.array(np.append(starts, len(ids)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        batch.column(3).slice(a, b - a),
                        pa.ListArray.from_arrays(ends, pa.array(ids, pa.int32())),
                        pa.ListArray.from_arrays(ends, pa.array(values, pa.float32())),
                    ],
                    names=["doc_id", "label", "ids", "features"],
                )

    made = rows.select("doc_id", "text", "recorded", "label").mapInArrow(
        run, "doc_id long, label int, ids array<int>, features array<float>"
    )
    # one row per sampled id, which bounds what the driver gets
    single = made.groupBy("doc_id").agg(F.min(F.struct("label", "ids", "features")).alias("one")).select("doc_id", "one.*")
    # ordered, so that the fit does not depend on which task ends first
    taken = single.toArrow().sort_by([("doc_id", "ascending")]).combine_chunks()
    pairs = [
        (np.asarray(i.values, dtype=np.int64), np.asarray(v.values, dtype=np.float64))
        for i, v in zip(taken["ids"], taken["features"], strict=True)
    ]
    return fit_machine(pairs, taken["label"].to_numpy().astype(float))


def score(
    docs: DataFrame,
    machine: Machine,
    id_col: str = "doc_id",
    text_col: str = "text",
    recorded_col: str | None = "n_chars",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``doc_id, score, predicted`` for every row: null texts count as empty, repeated and null ids keep their rows,
    a null or missing recorded length counts as 0, other columns are not read."""
    shared = docs.sparkSession.sparkContext.broadcast((machine.bias, machine.weights.astype(np.float32)))

    def run(batches):
        model = Machine(*shared.value)
        for batch in batches:
            texts = [as_text(t) for t in batch.column(1).to_pylist()]
            recorded = batch.column(2).to_pylist()
            for a, b in text_blocks(texts):
                scores = model.scores(*features(texts[a:b], recorded[a:b])).astype(float)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))],
                    names=["doc_id", "score", "predicted"],
                )

    rows = _inputs(docs, id_col, text_col, recorded_col)
    return rows.mapInArrow(run, "doc_id long, score double, predicted int")


def keep_good(docs: DataFrame, machine: Machine, threshold: float = THRESHOLD, text_col: str = "text", **columns) -> DataFrame:
    """The rows of ``docs`` that the machine accepts, all columns and repeated rows kept.

    The decision is a function of the text and the recorded length alone, so it is made where the row is, without a join.
    """
    recorded_col = columns.get("recorded_col", "n_chars")
    shared = docs.sparkSession.sparkContext.broadcast((machine.bias, machine.weights.astype(np.float32)))
    text_at = docs.columns.index(text_col)
    recorded_at = docs.columns.index(recorded_col) if recorded_col in docs.columns else None

    def run(batches):
        model = Machine(*shared.value)
        for batch in batches:
            texts = [as_text(t) for t in batch.column(text_at).to_pylist()]
            recorded = batch.column(recorded_at).to_pylist() if recorded_at is not None else [None] * len(texts)
            keep = np.zeros(len(texts), dtype=bool)
            for a, b in text_blocks(texts):
                keep[a:b] = model.scores(*features(texts[a:b], recorded[a:b])) >= threshold
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
