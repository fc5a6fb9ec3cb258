"""Quality scores from document statistics: random Fourier features, ridge regression, isotonic calibration.

A document becomes a short vector of statistics of its whole text. Random Fourier features approximate a
Gaussian kernel over these vectors, so a linear ridge fit on them is a kernel fit whose normal equations
are sums: every task adds up its own rows and only these sums travel. The raw scores of a fold that
the fit has not seen are made monotone probabilities by pooling adjacent violators over score bins.

Labelled rows are split by crc32 of the id: remainder 0 of 5 is held out and never read for learning, 1
calibrates, 2 to 4 fit. The fit takes a sample of about ``fit_rows`` of its rows, chosen by a hash of the id;
calibration reads all rows of its fold.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.session import stage_table

FIT_ROWS = 100_000
FIT_TASKS = 16
FEATURES = 256
RIDGE = 1e-3
WIDTH = 4.0
BINS = 200
FOLDS = 5
KEEP_AT = 0.3

_CLASSES = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t", b"\n\r", b".,;:",
            b"!?", b"|", b"%*#$&~^_+=<>", b"@/\\", b"\"'()[]{}-"]
_CLASS_OF = np.full(256, len(_CLASSES))
for _i, _c in enumerate(_CLASSES):
    _CLASS_OF[list(_c)] = _i
N_STATS = 8 + len(_CLASSES) + 1


def statistics(text: bytes | None) -> np.ndarray:
    """Sizes (log), word lengths, repetition of words and lines, and shares of byte classes; zeros for no text."""
    out = np.zeros(N_STATS)
    if not text:
        return out
    words, lines = text.split(), text.split(b"\n")
    n = len(words)
    out[0], out[1], out[2] = np.log1p(len(text)), np.log1p(n), np.log1p(len(lines))
    if n:
        out[3] = (len(text) - n) / n
        out[4] = len(set(words)) / n
        out[5] = sum(map(operator.eq, words, words[1:])) / n
        out[6] = max(map(len, words)) / len(text)
    out[7] = len(set(lines)) / len(lines)
    shares = np.bincount(_CLASS_OF, np.bincount(np.frombuffer(text, np.uint8), minlength=256), len(_CLASSES) + 1)
    out[8:] = np.sqrt(shares / len(text))
    return out


def document_statistics(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, stats; one row per input row."""
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = [statistics(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(stats, pa.list_(pa.float64()))],
                                             ["doc_id", "stats"])
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        code, "doc_id long, stats array<double>")


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; 1 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS, F.lit(1))


@dataclass(frozen=True)
class Model:
    """Standardisation, random features, ridge weights and calibration points."""

    mean: np.ndarray
    scale: np.ndarray
    waves: np.ndarray
    phase: np.ndarray
    beta: np.ndarray
    knots: np.ndarray
    rates: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.cos((stats - self.mean) / self.scale @ self.waves + self.phase) * np.sqrt(2 / self.waves.shape[1])
        return np.hstack([z, np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(self.features(stats) @ self.beta, -0.5, 1.5)

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(stats), self.knots, self.rates)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def isotonic(x: np.ndarray, hits: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over bins in order of ``x``: block centres and their rates."""
    blocks: list[list[float]] = []  # weighted x, hits, rows
    for a, h, n in zip(x, hits, rows):
        blocks.append([a * n, h, n])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][2] >= blocks[-1][1] / blocks[-1][2]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last)]
    b = np.array(blocks)
    return b[:, 0] / b[:, 2], b[:, 1] / b[:, 2]


def train(stats: DataFrame, labels: DataFrame, label: str = "quality", fit_rows: int = FIT_ROWS,
          seed: int = 7) -> Model:
    """Fit on ``stats(doc_id, stats)`` joined with ``labels(doc_id, <label> 0 or 1)``, held-out ids left out.

    Without a label every score is 0.5; with labels of one kind only, scores are that label.
    """
    known = labels.where(F.col(label).isin(0, 1)).select("doc_id", F.col(label).cast("double").alias("y"))
    rows = stats.join(known, "doc_id").withColumn("fold", fold(F.col("doc_id"))).where(F.col("fold") != 0)
    rows = stage_table(rows.select("doc_id", "stats", "y", "fold"), "labelled")
    fit, calibrate = rows.where(F.col("fold") != 1), rows.where(F.col("fold") == 1)
    share = min(1.0, fit_rows / max(1, fit.count()))
    fit = fit.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    moments = fit.select(F.posexplode("stats")).groupBy("pos").agg(F.avg("col"), F.stddev_pop("col")).collect()
    mean, scale = np.zeros(N_STATS), np.ones(N_STATS)
    for at, m, s in moments:
        mean[at], scale[at] = m, s if s and s > 1e-9 else 1.0
    rng = np.random.default_rng(seed)
    waves = rng.normal(0, 1 / WIDTH, (N_STATS, FEATURES))
    phase = rng.uniform(0, 2 * np.pi, FEATURES)
    model = Model(mean, scale, waves, phase, np.zeros(FEATURES + 1), np.zeros(1), np.full(1, 0.5))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ztz, zty = np.zeros((FEATURES + 1, FEATURES + 1)), np.zeros(FEATURES + 1)
        for batch in batches:
            if batch.num_rows:
                z = model.features(_matrix(batch.column(0)))
                ztz += z.T @ z
                zty += z.T @ batch.column(1).to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array([ztz.tobytes()]), pa.array([zty.tobytes()])], ["ztz", "zty"])

    # FIT_TASKS rows of half a megabyte reach the driver, whatever the size of the table.
    parts = fit.select("stats", "y").repartition(FIT_TASKS).mapInArrow(sums, "ztz binary, zty binary").collect()
    ztz = sum(np.frombuffer(p["ztz"]) for p in parts).reshape(FEATURES + 1, -1)
    zty = sum(np.frombuffer(p["zty"]) for p in parts)
    if not ztz[-1, -1]:
        return model
    beta = np.linalg.solve(ztz + RIDGE * ztz[-1, -1] / FEATURES * np.eye(FEATURES + 1), zty)
    model = Model(mean, scale, waves, phase, beta, model.knots, model.rates)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                raw = model.raw(_matrix(batch.column(0)))
                yield pa.RecordBatch.from_arrays([pa.array(np.round(raw * BINS).astype(np.int64)), batch.column(1)],
                                                 ["bin", "y"])

    bins = calibrate.select("stats", "y").mapInArrow(binned, "bin long, y double").groupBy("bin").agg(
        F.sum("y").alias("hits"), F.count(F.lit(1)).alias("rows")).orderBy("bin").collect()
    if not bins:  # nothing to calibrate on: raw scores, cut to [0, 1]
        return Model(mean, scale, waves, phase, beta, np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    b = np.array([tuple(r) for r in bins], float)
    return Model(mean, scale, waves, phase, beta, *isotonic(b[:, 0] / BINS, b[:, 1], b[:, 2]))


def score_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", keep_at: float = KEEP_AT,
                  **options) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, held_out, score, predicted; one row per input row.

    The score comes from the text alone; null and empty texts have all-zero statistics and a score like any
    other. Labels of ids that are no document, null labels and labels other than 0 and 1 are not used; a
    document with several labels counts once for each. Other columns are not read.
    """
    stats = stage_table(document_statistics(docs), "stats")
    model = train(stats, labels, label, **options)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.score(_matrix(batch.column(1))) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], ["doc_id", "score"])

    return stats.mapInArrow(code, "doc_id long, score double").select(
        "doc_id", (F.coalesce(fold(F.col("doc_id")), F.lit(1)) == 0).alias("held_out"), "score",
        (F.col("score") >= keep_at).cast("int").alias("predicted"))
