"""Language identification by the nearest of several centroids per language.

A text becomes the TF-IDF vector of its byte n-grams (1 to 4 bytes of the lower-cased text, hashed), scaled to
length 1. Each language has several centroids, found by spherical k-means, and a text gets the language of the
centroid with the greatest cosine. A text is rejected when its distance (1 - cosine) exceeds what nine tenths of
the learning texts of about its length have from their own language by more than a margin.

Document frequencies are counted over all learning rows. Centroids and distances come from a sample of at most
``2 * per_language`` ids of each language, chosen by a hash of the id. A task clusters the sample of one language;
the driver gets its centroids and one distance per step of text length. What is broadcast is bounded by
``buckets * centroids * languages``.
"""

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import as_text, map_groups, remainder
from newsflow.session import stage

BUCKETS = 4096
ORDERS = (1, 2, 3, 4)
CENTROIDS = 4
PER_LANGUAGE = 1_000
MARGIN = 0.3
USUAL = 0.9
FEWEST = 20
LENGTH_STEPS = 24
UNKNOWN = "und"
DIGITS_AND_ASCII_MARKS = bytes(32 if i < 97 and not 65 <= i <= 90 or 90 < i < 97 or 122 < i < 128 else i for i in range(256))


def counts(text: str) -> np.ndarray:
    """Hashed n-gram counts of the whole text; digits and ASCII marks count as spaces, runs of which are one."""
    raw = text.lower().encode("utf-8", "surrogatepass").translate(DIGITS_AND_ASCII_MARKS)
    codes = np.frombuffer(b" ".join([b"", *raw.split(), b""]), dtype=np.uint8).astype(np.uint32)
    found = np.zeros(BUCKETS, dtype=np.int64)
    mixed = np.zeros(len(codes), dtype=np.uint32)
    for n in ORDERS:
        if len(codes) < n:
            break
        mixed = mixed[: len(codes) - n + 1] * np.uint32(0x01000193) + codes[n - 1 :] + np.uint32(1)
        spread = mixed * np.uint32(0x9E3779B1)
        found += np.bincount((spread >> np.uint32(20)).astype(np.int64), minlength=BUCKETS)
    return found


def vector(found: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """The TF-IDF vector of length 1, or zero for an empty text."""
    weighted = np.log1p(found) * idf
    norm = np.sqrt(weighted @ weighted)
    return weighted / norm if norm else weighted


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, as_text(text)))


def length_step(text: str) -> int:
    return min(LENGTH_STEPS - 1, len(text).bit_length())


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    limits: np.ndarray

    def nearest(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(index of the language, cosine) of each text."""
        if not len(self.centroids):
            return np.zeros(len(texts), dtype=np.int64), np.zeros(len(texts))
        best, cosine = np.empty(len(texts), dtype=np.int64), np.empty(len(texts))
        for start in range(0, len(texts), 256):
            part = np.stack([vector(counts(t), self.idf) for t in texts[start : start + 256]]).astype(np.float32)
            close = part @ self.centroids.T
            top = close.argmax(1)
            best[start : start + 256] = self.owner[top]
            cosine[start : start + 256] = close[np.arange(len(top)), top]
        return best, np.clip(cosine, 0.0, 1.0)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, cosine, rejected). Without a letter, or without a learned language: ``und``, 0, rejected."""
        lettered = np.array([has_letter(t) for t in texts], dtype=bool) & bool(self.languages)
        best, cosine = self.nearest([as_text(t) if ok else "" for t, ok in zip(texts, lettered, strict=True)])
        languages = [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered, strict=True)]
        cosine = np.where(lettered, cosine, 0.0)
        limits = self.limits[[length_step(as_text(t)) for t in texts]] if len(texts) else np.zeros(0)
        return languages, cosine, ~lettered | (1 - cosine > limits)


def clustered(rows: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """Centroids (length 1) of spherical k-means; fewer rows than ``k`` give as many centroids as rows."""
    k = min(k, len(rows))
    centroids = rows[rng.choice(len(rows), k, replace=False)]
    for _ in range(rounds):
        nearest = (rows @ centroids.T).argmax(1)
        for j in range(k):
            mean = rows[nearest == j].sum(0)
            norm = np.linalg.norm(mean)
            if norm:
                centroids[j] = mean / norm
    return centroids


def _learn(k: int, most: int):
    """Clusters the sample of a language: a row per centroid, then one per sampled text with its distance."""

    def run(key, table):
        table = table.slice(0, most)
        rows = np.zeros((table.num_rows, BUCKETS), dtype=np.float32)
        for row, buckets, weights in zip(rows, table["buckets"].to_pylist(), table["weights"].to_pylist(), strict=True):
            row[np.frombuffer(buckets, dtype=np.uint16)] = np.frombuffer(weights, dtype=np.float32)
        centre = clustered(rows, k, np.random.default_rng([11, zlib.crc32(key[0].encode())]))
        distance = 1 - (rows @ centre.T).max(1)
        n, m = len(centre), len(rows)
        return pa.table(
            {
                "lang": pa.array([key[0]] * (n + m), pa.string()),
                "centroid": pa.array([c.tobytes() for c in centre] + [None] * m, pa.binary()),
                "step": pa.array([None] * n + table["step"].to_pylist(), pa.int32()),
                "distance": pa.array([None] * n + distance.astype(float).tolist(), pa.float64()),
            }
        )

    return run


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    centroids: int = CENTROIDS,
    per_language: int = PER_LANGUAGE,
) -> Model:
    """Learn from rows whose crc32(id as text) modulo 3 is not 1 and whose language and id are not null.

    Texts without a letter teach nothing, and an id that repeats in a language teaches its centroids once. Without any
    learning row the model predicts ``und`` for every text. The number of languages has no limit of its own.
    """
    learning = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")
    ).where("doc_id is not null and lang is not null and text is not null")
    learning = learning.where(remainder("doc_id", 3) != 1)

    def frequencies(batches):
        seen, rows = np.zeros(BUCKETS, dtype=np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen += counts(text) > 0
                rows += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, BUCKETS), pa.int32()), pa.array(np.append(rows, seen), pa.int64())], names=["bucket", "n"]
        )

    totals = learning.select("text").mapInArrow(frequencies, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    frequency = np.zeros(BUCKETS + 1)
    for row in totals.collect():
        frequency[row.bucket + 1] = row.n
    idf = np.log((1 + frequency[0]) / (1 + frequency[1:])) + 0.05

    # one row per language, as many as the model itself has languages
    sizes = learning.groupBy("lang").count().collect()
    space = 1 << 30
    shares = [(r.lang, int(space * min(1.0, per_language / r["count"]))) for r in sizes]
    bounds = docs.sparkSession.createDataFrame(shares, "lang string, bound long")
    place = F.pmod(F.xxhash64(F.lit(29), "doc_id"), F.lit(space))

    def sample_vectors(batches):
        for batch in batches:
            texts = batch.column(2).to_pylist()
            keep = [i for i, t in enumerate(texts) if has_letter(t)]
            rows = [vector(counts(texts[i]), idf).astype(np.float32) for i in keep]
            filled = [np.flatnonzero(row) for row in rows]
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(at),
                    batch.column(1).take(at),
                    pa.array([length_step(texts[i]) for i in keep], pa.int32()),
                    pa.array([f.astype(np.uint16).tobytes() for f in filled], pa.binary()),
                    pa.array([row[f].tobytes() for row, f in zip(rows, filled, strict=True)], pa.binary()),
                ],
                names=["doc_id", "lang", "step", "buckets", "weights"],
            )

    chosen = learning.join(F.broadcast(bounds), "lang").where(place < F.col("bound")).select("doc_id", "lang", "text")
    vectors = chosen.mapInArrow(sample_vectors, "doc_id long, lang string, step int, buckets binary, weights binary")
    # an id that repeats teaches once, so a language's sample is bounded before it meets in a task
    sample = vectors.groupBy("lang", "doc_id").agg(F.min(F.struct("step", "buckets", "weights")).alias("one"))
    learned = stage(
        map_groups(
            sample.select("lang", "doc_id", "one.*"),
            ["lang"],
            ["doc_id"],
            _learn(centroids, 2 * per_language),
            "lang string, centroid binary, step int, distance double",
        ),
        "language-centroids",
    )
    found = sorted((r.lang, r.centroid) for r in learned.where("centroid is not null").select("lang", "centroid").collect())
    languages = sorted({lang for lang, _ in found})
    usual = F.percentile("distance", F.lit(USUAL))
    steps = learned.where("distance is not null").groupBy("step").agg(F.count(F.lit(1)).alias("n"), usual.alias("far")).collect()
    far = np.zeros(LENGTH_STEPS)
    for row in steps:
        if row.n >= FEWEST:
            far[row.step] = max(1e-6, row.far)
    # a shorter text may lie as far out as a longer one; texts shorter than those often seen are not judged,
    # longer ones are judged like the longest
    limits = np.maximum.accumulate(far[::-1])[::-1] + MARGIN
    seen = np.flatnonzero(far)
    limits[: seen[0] if len(seen) else LENGTH_STEPS] = 1.0
    if len(seen):
        limits[seen[-1] :] = limits[seen[-1]]
    return Model(
        languages,
        idf,
        np.frombuffer(b"".join(c for _, c in found), dtype=np.float32).reshape(-1, BUCKETS),
        np.array([languages.index(lang) for lang, _ in found], dtype=np.int64),
        np.minimum(limits, 1.0),
    )


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` for every row.

    ``score`` is the cosine to the nearest centroid. A text that is null or has no letter is ``und`` with score 0
    and rejected. Null and repeated ids keep their rows; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            languages, cosine, rejected = shared.value.predict(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(languages, pa.string()), pa.array(cosine.astype(float)), pa.array(rejected)],
                names=["doc_id", "lang_pred", "score", "rejected"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is not rejected, all columns and repeated rows kept."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text_at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            rejected = shared.value.predict(batch.column(text_at).to_pylist())[2]
            yield batch.filter(pa.array(~rejected))

    return docs.mapInArrow(run, docs.schema)
