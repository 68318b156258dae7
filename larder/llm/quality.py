"""Quality scores: random Fourier features of text statistics, ridge regression, isotonic calibration."""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.tables import plain, scratch, summed, written

FEATURES = 192
KERNEL_WIDTH = 4.0
RIDGE = 1e-3
BINS = 1000
SEED = 7

LOWER, UPPER, DIGITS = b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789"
BLANK, STOPS, SYMBOLS = b" \t\r\x0b\x0c", b".,;:", b"!\"#$%&'()*+/<=>?@[\\]^_`{|}~-"
CLASSES = (LOWER, UPPER, DIGITS, BLANK, b"\n", STOPS, SYMBOLS, b"!")
STATISTICS = len(CLASSES) + 11


def text_statistics(text: str | None) -> list[float]:
    """What the score sees of a whole text; an empty one has zeros."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    n = len(raw)
    if not n:
        return [0.0] * STATISTICS
    shares = [(n - len(raw.translate(None, c))) / n for c in CLASSES]
    words, lines = raw.split(), raw.split(b"\n")
    if not words:
        return shares + [np.log1p(n)] + [0.0] * (STATISTICS - len(shares) - 1)
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), float, len(words))
    titled = sum(k for w, k in counts.items() if 65 <= w[0] <= 90)
    return [
        *shares,
        float(np.log1p(n)),
        float(np.log1p(len(words))),
        float(lengths.mean()),
        float(lengths.std()),
        float(np.log(lengths.max())),
        len(counts) / len(words),
        counts.most_common(1)[0][1] / len(words),
        len(set(lines)) / len(lines),
        float(np.log1p(n / len(lines))),
        len(zlib.compress(raw, 1)) / n,
        titled / len(words),
    ]


def statistics(text: Column | str) -> Column:
    @F.pandas_udf("array<double>")
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(text_statistics)

    return of(text)


@dataclass
class Model:
    """``score`` maps statistics to calibrated scores. Without labels of both kinds all scores are the same."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # random frequencies
    phases: np.ndarray
    ridge: np.ndarray
    centres: np.ndarray  # of the calibration's steps
    levels: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        waves = np.sqrt(2 / len(self.phases)) * np.cos(x @ self.weights + self.phases)
        return np.hstack([waves, x, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.ridge

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.centres, self.levels), 0, 1)


def isotonic(weight: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: the best non-decreasing means of bins."""
    blocks: list[list[float]] = []  # weight, sum, bins
    for w, t in zip(weight, total):
        blocks.append([w, t, 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            w2, t2, k2 = blocks.pop()
            blocks[-1][0] += w2
            blocks[-1][1] += t2
            blocks[-1][2] += k2
    return np.concatenate([np.full(k, t / w) for w, t, k in blocks]) if blocks else np.zeros(0)


def _matrix(batch, column: str) -> np.ndarray:
    lists = batch.column(column)
    return np.asarray(lists.flatten(), float).reshape(len(lists), -1)


def fit(labelled: DataFrame) -> Model:
    """Fits on rows (fold int, stats array<double>, y double): fold 0 gives the ridge weights, the others calibrate.

    All rows are used. Sums of a fixed size leave each task; nothing of single rows does.
    """
    k = STATISTICS

    def moments(batch):
        x = _matrix(batch, "stats")
        return np.stack([np.full(k, len(x)), x.sum(0), (x * x).sum(0)])

    n, s, q = summed(labelled, moments, (3, k))
    mean = s / np.maximum(n, 1)
    scale = np.sqrt(np.maximum(q / np.maximum(n, 1) - mean**2, 0))
    scale[scale < 1e-9] = 1.0
    chance = np.random.default_rng(SEED)
    model = Model(
        mean, scale, chance.normal(0, 1 / KERNEL_WIDTH, (k, FEATURES)), chance.uniform(0, 2 * np.pi, FEATURES),
        np.zeros(FEATURES + k + 1), np.array([0.0, 1.0]), np.array([0.5, 0.5]),
    )
    if not n[0]:
        return model
    d = FEATURES + k + 1

    def normal(batch):
        fold, y = np.asarray(batch.column("fold")), np.asarray(batch.column("y"), float)
        z = model.features(_matrix(batch, "stats"))[fold == 0]
        return np.hstack([z.T @ z, (z.T @ y[fold == 0])[:, None]])

    sums = summed(labelled, normal, (d, d + 1))
    rows = max(sums[d - 1, d - 1], 1)
    penalty = RIDGE * rows * np.eye(d)
    penalty[-1, -1] = 1e-9 * rows + 1e-12
    model.ridge = np.linalg.solve(sums[:, :d] + penalty, sums[:, d])

    def bins(batch):
        fold, y = np.asarray(batch.column("fold")), np.asarray(batch.column("y"), float)
        at = np.clip((model.raw(_matrix(batch, "stats")) + 0.5) / 2 * BINS, 0, BINS - 1).astype(int)
        use = fold != 0
        return np.stack([np.bincount(at[use], minlength=BINS), np.bincount(at[use], y[use], minlength=BINS)])

    weight, total = summed(labelled, bins, (2, BINS))
    if not weight.sum():
        return model
    full = np.flatnonzero(weight)
    model.centres = (full + 0.5) / BINS * 2 - 0.5
    model.levels = isotonic(weight[full], total[full])
    return model


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; rows of fold 1 are held out. A null id is in no fold."""
    return (F.crc32(doc_id.cast("string").cast("binary")) % 3).cast("int")


def labelled_statistics(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics of labelled rows that aren't held out. Of several labels of a document the larger counts."""
    known = (
        labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["quality"].cast("double").alias("y"))
        .where("doc_id IS NOT NULL AND y IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("y").alias("y"))
    )
    rows = stats.join(known, "doc_id").withColumn("fold", fold_of(F.col("doc_id")))
    return rows.where("fold <> 1").select("fold", "stats", "y")


def scoring(model: Model):
    @F.pandas_udf("double")
    def score(stats: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.stack(stats.to_list()))) if len(stats) else pd.Series([], dtype=float)

    return score


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of each row: scores of whole texts, learnt from rows that aren't held out.

    Null text counts as empty. Rows that repeat get equal scores. A row without an id is scored, not held out and never
    learnt from. Other columns are no inputs.
    """
    stats = written(plain(docs).select("doc_id", statistics("text").alias("stats")), "quality-statistics")
    model = fit(labelled_statistics(stats, labels))
    score = scoring(model)(F.col("stats"))
    return stats.select(
        "doc_id", F.coalesce(fold_of(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"), score.alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows predicted as bad; all columns stay."""
    stats = plain(docs).select("doc_id", statistics("text").alias("stats"))
    with scratch():
        model = fit(written(labelled_statistics(stats, labels), "quality-labelled"))
    return docs.where(scoring(model)(statistics(F.coalesce(docs["text"], F.lit("")))) >= 0.5)
