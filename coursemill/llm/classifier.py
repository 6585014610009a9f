"""Quality by a regularised quadratic discriminant over document statistics.

Every text becomes ``FEATURES`` bounded, transformed numbers (logs and square roots of counts and shares). Per class, the count, sums and
products of those numbers over all labelled training documents are added up by Spark: the model needs a table of fixed size, whatever the
corpus. A class covariance is pulled towards the pooled one and towards its diagonal, its Cholesky factor is kept in the model, and
a score is the logistic function of the Mahalanobis log-density difference plus the log prior ratio.

Defined results: a null text is an empty text and gets a score like any other; a label other than 0 or 1, or of a null or unknown id, is not
used; with one class only, its documents' share decides (score 1 or 0); without labels every score is 0.5; repeated rows get equal scores.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursemill.llm.common import Scratch, chunks, flat, span_hashes, word_spans

FEATURES = (
    "log_words log_chars word_length_mean word_length_sd upper_share digit_share punctuation_share symbol_share other_share newline_share "
    "repeated_word_share repeated_neighbour_share bang_word_share lone_symbol_share top_word_share short_word_share"
).split()
FEW_WORDS = 20
SHRINK_TO_POOLED = 0.1
SHRINK_TO_DIAGONAL = 0.05
_KIND = np.zeros(256, np.uint8)  # 1 lower, 2 upper, 3 digit, 4 punctuation, 5 symbol, 6 space, 7 newline, 8 other
_KIND[128:] = 8
for _k, _c in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:!?'\"()-", b"#*$%&|<>@^~_=+/\\[]{}`", b" \t\r\x0b\x0c", b"\n"), 1):
    _KIND[list(_c)] = _k


def statistics(batch: pa.RecordBatch) -> np.ndarray:
    """One row of ``FEATURES`` for each document of the batch."""
    data, offsets = flat(batch.column("text"))
    begin, end, first = word_spans(data, offsets)
    rows, n = batch.num_rows, np.diff(first)
    doc = np.repeat(np.arange(rows), n)
    size = np.diff(offsets)
    kinds = _KIND[data]
    row = np.repeat(np.arange(rows), size)
    table = np.bincount(row * 9 + kinds, minlength=rows * 9).reshape(rows, 9)
    solid = np.maximum(size - table[:, 6] - table[:, 7], 1)
    words = np.maximum(n, 1)
    length = (end - begin).astype(float)
    mean = np.bincount(doc, length, rows) / words
    sd = np.sqrt(np.maximum(np.bincount(doc, length**2, rows) / words - mean**2, 0))
    # word lengths likewise, to a usual length
    mean_ = np.log((mean * n + 6 * FEW_WORDS) / (n + FEW_WORDS))
    sd_ = np.log1p((sd * n + 3 * FEW_WORDS) / (n + FEW_WORDS))
    h = span_hashes(data, begin, end, 3)
    order = np.lexsort([h, doc])
    new = np.r_[True, (h[order][1:] != h[order][:-1]) | (doc[order][1:] != doc[order][:-1])] if len(h) else np.zeros(0, bool)
    repeats = (n - np.bincount(doc[order], new, rows)) / (n + FEW_WORDS)
    runs = np.diff(np.r_[np.nonzero(new)[0], len(h)])
    top = np.zeros(rows)
    np.maximum.at(top, doc[order][new], runs)
    same = np.r_[False, (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])] if len(h) else np.zeros(0, bool)
    last = data[end - 1] if len(end) else np.zeros(0, np.uint8)
    bang, symbol = last == 33, _KIND[last] == 5
    # shares of a short text are pulled to zero: it has little to say for or against itself
    share = lambda hit: np.sqrt(np.bincount(doc, hit, rows) / (n + FEW_WORDS))
    part = lambda k: np.sqrt(table[:, k] / (solid + 5 * FEW_WORDS))
    return np.stack([
        np.log(n + FEW_WORDS), np.log(size + 5 * FEW_WORDS), mean_, sd_, part(2), part(3), part(4), part(5), part(8),
        np.sqrt(table[:, 7] / (size + 5 * FEW_WORDS)), np.sqrt(repeats), share(same), share(bang), share(symbol), np.sqrt(np.maximum(top - 1, 0) / (n + FEW_WORDS)), share(length <= 3),
    ], 1)


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        x = statistics(batch)
        flatx = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.reshape(-1)))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), flatx], names=["doc_id", "x"])


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Count, sums and products by class of a task's rows."""
    d = len(FEATURES)
    total = np.zeros((2, 1 + d + d * d))
    for batch in batches:
        y = np.array(batch.column("y"))
        x = np.array(batch.column("x").flatten()).reshape(-1, d)
        for c in (0, 1):
            own = x[y == c]
            total[c] += np.r_[len(own), own.sum(0), (own.T @ own).reshape(-1)]
    i = np.arange(total.size)
    yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(total.reshape(-1))], names=["i", "v"])


@dataclass
class Quadratic:
    """Class means, Cholesky factors of the shrunk covariances and log priors."""

    counts: np.ndarray
    means: np.ndarray | None = None
    factors: np.ndarray | None = None
    scale: tuple[np.ndarray, np.ndarray] | None = None

    @classmethod
    def fit(cls, total: np.ndarray) -> Quadratic:
        d = len(FEATURES)
        n, s, p = total[:, 0], total[:, 1 : 1 + d], total[:, 1 + d :].reshape(2, d, d)
        if (n == 0).any():
            return cls(n)
        # common scale first, so that shrinking treats all statistics alike
        centre = s.sum(0) / n.sum()
        spread = np.sqrt(np.maximum(np.diagonal(p.sum(0)) / n.sum() - centre**2, 1e-8))
        means = s / n[:, None]
        cov = np.stack([(p[c] / n[c] - np.outer(means[c], means[c])) / np.outer(spread, spread) for c in (0, 1)])
        pooled = (cov * n[:, None, None]).sum(0) / n.sum()
        cov = (1 - SHRINK_TO_POOLED) * cov + SHRINK_TO_POOLED * pooled
        diagonal = np.stack([np.diag(np.diag(c)) for c in cov])
        cov = (1 - SHRINK_TO_DIAGONAL) * cov + SHRINK_TO_DIAGONAL * diagonal + 1e-2 * np.eye(d)
        return cls(n, (means - centre) / spread, np.linalg.cholesky(cov), (centre, spread))

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(x), 0.5 if not self.counts.any() else float(self.counts[1] > 0))
        z = (x - self.scale[0]) / self.scale[1]
        log = []
        for c in (0, 1):
            y = np.linalg.solve(self.factors[c], (z - self.means[c]).T)
            log.append(math.log(self.counts[c]) - np.log(np.diagonal(self.factors[c])).sum() - 0.5 * (y**2).sum(0))
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -700, 700)))


def fit(stats: DataFrame, labels: DataFrame) -> Quadratic:
    """``labels``: ``doc_id, y`` with y 0 or 1, all of which are used."""
    known = labels.filter("y in (0, 1) and doc_id is not null").select("doc_id", F.col("y").cast("int").alias("y"))
    sums = stats.join(known, "doc_id").select("y", "x").mapInArrow(_sums, "i long, v double").groupBy("i").agg(F.sum("v").alias("v"))
    total = np.zeros(2 * (1 + len(FEATURES) + len(FEATURES) ** 2))
    for i, v in sums.collect():  # of fixed length
        total[i] = v
    return Quadratic.fit(total.reshape(2, -1))


def _scores(model: Quadratic):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column("x").flatten()).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(x))], names=["doc_id", "score"])

    return rows


def document_statistics(docs: DataFrame) -> DataFrame:
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return texts.mapInArrow(_stats, "doc_id long, x array<double>")


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, score`` for every row of ``docs``, learnt from ``labels`` (``doc_id, y``)."""
    scratch = Scratch(docs.sparkSession, "classifier")
    stats = scratch.keep(document_statistics(docs), "statistics")
    return stats.mapInArrow(_scores(fit(stats, labels)), "doc_id long, score double")
