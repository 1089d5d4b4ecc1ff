"""Quality scores: random Fourier features, ridge regression, isotonic calibration.

Statistics of the text alone are standardised and mapped to cosines whose inner products
approximate a Gaussian kernel. Partitions of the labelled rows are summed into normal equations,
whose size depends on the number of features only; the driver solves them. Raw scores of labelled
rows that the fit did not see are counted in bins of fixed number, and pool-adjacent-violators over
the bins turns raw scores into probabilities.

Folds by crc32 of the doc_id as text, modulo 4: 0 and 1 fit, 3 calibrates, 2 is held out.

Defined results: null and empty texts have the statistics of an empty text; labels that are null
are left out, several labels of a document count by their mean (a tie counts as 0); with no label
at all, or one class only, every score is the mean label (0.5 without any) and there is no model.
A null doc_id is never labelled and not held out.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.llm import tools

BINS = 1000
_SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>@^~_=+{}[]\\/"))
_UPPER = np.isin(np.arange(256), np.arange(65, 91))
_LOWER = np.isin(np.arange(256), np.arange(97, 123))
_DIGIT = np.isin(np.arange(256), np.arange(48, 58))
_STOPS = np.isin(np.arange(256), list(b".,;:?"))
_CONTROL = np.arange(256) < 32
_CLASSES = np.stack([_SYMBOLS, _UPPER, _LOWER, _DIGIT, _STOPS, _CONTROL, np.arange(256) == 33, np.arange(256) == 124], 1).astype(float)
N_STATS = 19


def statistics(text: str | None) -> list[float]:
    """Statistics of one text; all are bounded or logarithms, so no length dominates."""
    raw = (text or "").encode()
    symbols, upper, lower, digit, stops, control, shouts, bars = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ _CLASSES
    words, lines = raw.split(), [line for line in raw.split(b"\n") if line.strip()]
    n, letters, size = max(1, len(words)), max(1.0, upper + lower), max(1, len(raw))
    pairs = set(zip(words, words[1:], strict=False))
    ends = sum(line.rstrip().endswith((b".", b"!", b"?", b'"')) for line in lines)
    return [
        math.log1p(len(raw)), math.log1p(len(words)), math.log1p(len(lines)), min(40.0, size / n), symbols / n if words else 0.0,
        math.sqrt(symbols / size), upper / letters, digit / size, stops / n, control / size, min(3.0, shouts / n), min(3.0, bars / n),
        len(set(words)) / n, len(pairs) / n, sum(map(bytes.__eq__, words, words[1:])) / n,
        len(set(lines)) / max(1, len(lines)), ends / max(1, len(lines)), math.log1p(max(map(len, words), default=0)), (size - letters) / size,
    ]


def statistics_of(docs: DataFrame) -> DataFrame:
    """doc_id and stats, an array of N_STATS floats, for every row."""

    def run(batches):
        for batch in batches:
            rows = [statistics(t) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(rows, pa.list_(pa.float64()))], ["doc_id", "stats"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, stats array<double>")


def fold():
    return F.crc32(F.col("doc_id").cast("string")) % 4


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    edges: np.ndarray
    steps: np.ndarray

    def lift(self, stats: np.ndarray) -> np.ndarray:
        z = np.cos((stats - self.mean) / self.scale @ self.directions + self.phases)
        return np.hstack([z, np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.lift(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.edges, self.steps), 0, 1)


def isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: the nearest non-decreasing sequence by weighted squares."""
    blocks: list[list[float]] = []
    for v, w in zip(values, weights, strict=True):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            b, a = blocks.pop(), blocks.pop()
            blocks.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2] + b[2]])
    return np.concatenate([np.full(int(n), v) for v, _, n in blocks]) if blocks else np.empty(0)


def _sums(rows: DataFrame, terms, size: int) -> np.ndarray:
    """The sum over all rows of terms(stats, label), an array of ``size`` numbers."""
    return tools.summed(rows.select("stats", "label"), lambda batch: terms(np.array(batch["stats"].to_pylist()), batch["label"].to_numpy()), size)


def train(stats: DataFrame, labels: DataFrame, features: int = 256, ridge: float = 1e-3, width: float = 3.0, seed: int = 7) -> Model:
    """Fit on the labelled rows of folds 0 and 1, calibrate on those of fold 3.

    ``width`` is the kernel's standard deviation in standardised units.
    """
    known = labels.filter("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = known.agg((F.avg("quality") > 0.5).cast("double").alias("label")).withColumn("fold", fold()).filter("fold <> 2")
    rows = tools.staged(stats.join(known, "doc_id"), "labelled")
    fit, rest = rows.filter("fold <> 3"), rows.filter("fold = 3")

    moments = _sums(fit, lambda x, y: np.concatenate([[len(y), y.sum()], x.sum(0), (x * x).sum(0)]), 2 + 2 * N_STATS)
    n = max(1.0, moments[0])
    mean = moments[2 : 2 + N_STATS] / n
    scale = np.sqrt(np.maximum(moments[2 + N_STATS :] / n - mean**2, 0)) + 1e-6
    random = np.random.Generator(np.random.PCG64(seed))
    model = Model(
        mean, scale, random.normal(size=(N_STATS, features)) / width, random.uniform(0, 2 * np.pi, features), np.zeros(features + 1), np.array([0.0, 1.0]), np.full(2, moments[1] / n if moments[0] else 0.5),
    )
    if not 0 < moments[1] < moments[0]:
        return model
    d = features + 1

    def normal(x, y):
        z = model.lift(x)
        return np.concatenate([(z.T @ z).ravel(), z.T @ y])

    equations = _sums(fit, normal, d * d + d)
    model.weights = np.linalg.solve(equations[: d * d].reshape(d, d) + ridge * n * np.eye(d), equations[d * d :])

    def counts(x, y):
        slot = np.clip((model.raw(x) + 0.5) / 2 * BINS, 0, BINS - 1).astype(int)
        return np.concatenate([np.bincount(slot, minlength=BINS), np.bincount(slot, y, BINS)]).astype(float)

    seen = _sums(rest, counts, 2 * BINS)
    if not seen[:BINS].any():
        seen = _sums(fit, counts, 2 * BINS)
    used = np.flatnonzero(seen[:BINS])
    model.edges = (used + 0.5) / BINS * 2 - 0.5
    model.steps = isotonic(seen[BINS:][used] / seen[:BINS][used], seen[:BINS][used])
    return model


def score(stats: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    shared = stats.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            s = shared.value.score(np.array(batch["stats"].to_pylist()).reshape(-1, N_STATS))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    scored = stats.mapInArrow(run, "doc_id long, score double, predicted int")
    return scored.select("doc_id", F.coalesce(fold() == 2, F.lit(False)).alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """The rows of docs that the model accepts; columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            s = shared.value.score(np.array([statistics(t) for t in texts]).reshape(-1, N_STATS))
            yield batch.filter(pa.array(s >= threshold))

    return docs.mapInArrow(run, docs.schema)
