"""Quality by regularised quadratic discriminant analysis.

A document is a vector of transformed statistics of its whole text. Each class
has a mean and a covariance, shrunk towards the pooled diagonal; the score is
the logistic of the difference of the Gaussian log densities, by Mahalanobis
distances through Cholesky factors that are made once. Class moments are sums
over the labelled rows, so fitting is one aggregation, whatever their number.

Cases: null and empty texts have the statistics of an empty text and a score
between 0 and 1; texts of any length work, in memory proportional to one batch;
repeated rows are scored alike; without labels of both classes every score is
the share of label 1 (0.5 without any); an empty table gives an empty result;
ids are whole numbers (others raise), and a null id is scored and never fitted
on; only doc_id and score are given, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, slices

SHRINKAGE = 0.1
FLOOR = 1e-3  # variance that every feature has at least
_CLASSES = np.zeros((256, 7), np.int64)
for _b in range(256):
    _c = chr(_b)
    _CLASSES[_b, 0 if _c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else 1 if _c in "abcdefghijklmnopqrstuvwxyz" else 2 if _c.isdigit() and _b < 128 else 3 if _c in ".,;:'\"-()" else 4 if _b >= 128 else 5 if _c.isspace() and _b < 128 else 6] = 1
NAMES = ("log_words", "word_length", "length_spread", "upper", "digits", "stops", "symbols", "beyond_ascii", "distinct_words", "distinct_pairs", "distinct_lines", "line_words")


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of a text."""
    text = text or ""
    raw = text.encode("utf-8", "replace")
    upper, lower, digits, stops, beyond, _, symbols = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ _CLASSES
    words = text.split()
    n = len(words)
    letters, size = upper + lower + beyond + 1, len(raw) + 1
    lengths = np.fromiter(map(len, words), np.int64, n) if n else np.zeros(1)
    lines = [x for x in text.split("\n") if x.strip()]
    share = lambda a, b: float(np.log((a + 0.5) / (b + 1)))  # noqa: E731  logarithms spread the small shares
    return [
        float(np.log1p(n)), float(np.log1p(lengths.mean())), float(np.log1p(lengths.std())), share(upper, letters), share(digits, size), share(stops, size), share(symbols, size), float(beyond / size),
        (len(set(words)) + 1) / (n + 1), (len(set(zip(words, words[1:], strict=False))) + 1) / (n + 1), (len(set(lines)) + 1) / (len(lines) + 1), float(np.log1p(n / (len(lines) + 1))),
    ]


def with_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and f, the statistics, of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            rows = [statistics(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.list_(pa.float64()))], ["doc_id", "f"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, f array<double>")


class Model:
    """Means, log determinants and inverse Cholesky factors per class; prior: the log odds of label 1."""

    def __init__(self, prior: float, classes: list | None):
        self.prior, self.classes = prior, classes

    def scores(self, f: np.ndarray) -> np.ndarray:
        if self.classes is None:
            return np.full(len(f), 1 / (1 + np.exp(-self.prior)))
        density = []
        for mean, inverse, logdet in self.classes:
            z = (f - mean) @ inverse.T
            density.append(-0.5 * (z * z).sum(1) - 0.5 * logdet)
        return 1 / (1 + np.exp(-np.clip(self.prior + density[1] - density[0], -500, 500)))


def fit(rows: DataFrame, shrinkage: float = SHRINKAGE) -> Model:
    """rows: f and label. The driver gets one row of moments per class."""
    d = len(NAMES)
    sums = [F.sum(F.col("f")[i]).alias(f"s{i}") for i in range(d)]
    products = [F.sum(F.col("f")[i] * F.col("f")[j]).alias(f"p{i}_{j}") for i in range(d) for j in range(i, d)]
    found = {r["label"]: r for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), *sums, *products).collect()}
    n = [found[k]["n"] if k in found else 0 for k in (0, 1)]
    prior = float(np.log((n[1] + 0.5) / (n[0] + 0.5)))
    if not all(n):
        return Model(prior, None)
    means, covs = [], []
    for k in (0, 1):
        mean = np.array([found[k][f"s{i}"] for i in range(d)]) / n[k]
        cov = np.zeros((d, d))
        for i in range(d):
            for j in range(i, d):
                cov[i, j] = cov[j, i] = found[k][f"p{i}_{j}"] / n[k] - mean[i] * mean[j]
        means.append(mean)
        covs.append(cov)
    pooled = np.diag(np.diag((n[0] * covs[0] + n[1] * covs[1]) / sum(n)) + FLOOR)
    classes = []
    for mean, cov in zip(means, covs, strict=True):
        factor = np.linalg.cholesky((1 - shrinkage) * cov + shrinkage * pooled)
        classes.append((mean, np.linalg.inv(factor), 2 * np.log(np.diag(factor)).sum()))
    return Model(prior, classes)


def scored(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """doc_id and score of every row of docs. labelled: doc_id and label, of bounded size."""
    rows = cut(with_statistics(docs))
    model = fit(rows.join(F.broadcast(labelled), "doc_id").select("f", "label"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            f = np.array(b.column(1).flatten()).reshape(-1, len(NAMES))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.scores(f))], ["doc_id", "score"])

    return rows.mapInArrow(run, "doc_id long, score double")
