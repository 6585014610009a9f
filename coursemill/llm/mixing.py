"""Mixing to target weights with soft memberships.

Domains are named by the label table: ``low`` (quality 0), ``toxic`` (else, toxic 1) and ``clean``. A softmax regression over document statistics and the
presence of telling words, fitted on at most ``SAMPLE`` labelled documents (those with the smallest hash of their id), gives every document a
posterior over the domains. Rates ``r >= 0`` then minimise

    1/2 sum_k w_k (sum_d r_d t_d p_dk / T - target_k / T)^2 + RIDGE/2 sum_d (t_d / T) (r_d - 1)^2

with ``t`` words, ``T`` their total and ``w_k`` one over domain k's present share, by projected gradient steps. A step needs the domain totals only:
each round is one job that adds them up, and a document's rate is replayed from the history of residuals, so no state is kept between jobs and a
lost task repeats itself. Without a pull to do otherwise a document's rate is 1.

Defined results: a null text has no words and gets a rate like any other; labels of null or unknown ids and unlabelled qualities are not used; without
labels posteriors are even; without words all rates are 1; rows that repeat are documents of their own; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursemill.llm.classifier import statistics
from coursemill.llm.common import Scratch, chunks, flat, lists, signed, span_hashes, word_spans

DOMAINS = ("clean", "low", "toxic")
SAMPLE = 4_000
TELLING = 128  # words for each domain
RIDGE = 1e-3
STEPS = 40
PRECISION = 1e-7
_LEAST_SHARE = 1e-3


def domain_labels(labels: DataFrame) -> DataFrame:
    """``doc_id, y``: the number of the domain."""
    kind = F.when(F.col("quality") == 0, 1).when(F.col("toxic") == 1, 2).when((F.col("quality") == 1) & (F.col("toxic") == 0), 0)
    return labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), kind.alias("y")).filter("doc_id is not null and y is not null")


def _lowered(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each document without regard to capitals and closing punctuation, repeats included: row, hash; and words a row."""
    data, offsets = flat(batch.column("text"))
    data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    begin, end, first = word_spans(data, offsets)
    n = np.diff(first)
    row = np.repeat(np.arange(len(n)), n)
    letter = (data >= 97) & (data <= 122) | (data >= 128) | (data >= 48) & (data <= 57)
    for _ in range(3):
        end = end - ((end - begin > 1) & ~letter[end - 1])
    return row, span_hashes(data, begin, end, 9), n


def _distinct(row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each word of a document once, in order."""
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    return row[new], h[new]


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        row, h = _distinct(*_lowered(batch)[:2])
        x = statistics(batch)
        yield pa.RecordBatch.from_arrays(
            [batch.column("y"), lists(signed(h), np.bincount(row, minlength=batch.num_rows), pa.int64()), lists(x.reshape(-1), np.full(len(x), x.shape[1]), pa.float64())], names=["y", "words", "x"]
        )


@dataclass
class Membership:
    words: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @classmethod
    def fit(cls, y: np.ndarray, words: list[np.ndarray], x: np.ndarray, own: np.ndarray | None = None) -> Membership:
        """``own``: the telling words in order, if ``words`` holds no others; else they are found here."""
        k = len(DOMAINS)
        words = [np.asarray(w, np.int64) for w in words]  # an empty list would turn all hashes into floats
        doc = np.repeat(np.arange(len(y)), [len(w) for w in words])
        own = cls._telling(y, words, doc) if own is None else own
        centre, scale = (x.mean(0), x.std(0) + 1e-3) if len(x) else (0.0, 1.0)
        model = cls(own, centre, scale, np.zeros((len(own) + x.shape[1] + 1, k)))
        if not len(y):
            return model
        design = model._design(doc, np.concatenate(words), x)
        wanted = np.eye(k)[y]
        step = 1 / (0.25 * np.linalg.norm(design, 2) ** 2 / len(y) + 1e-3)
        ahead = model.weights.copy()
        for i in range(400):  # accelerated gradient descent
            slope = design.T @ (_softmax(design @ ahead) - wanted) / len(y) + 1e-3 * ahead
            new = ahead - step * slope
            ahead = new + i / (i + 3) * (new - model.weights)
            model.weights = new
        return model

    @staticmethod
    def _telling(y: np.ndarray, words: list[np.ndarray], doc: np.ndarray) -> np.ndarray:
        every, where = np.unique(np.concatenate(words) if len(words) else np.zeros(0, np.int64), return_inverse=True)
        n, telling = np.bincount(y, minlength=len(DOMAINS)), set()
        for c in range(len(DOMAINS)):
            inside = np.bincount(where, y[doc] == c, len(every))
            total = np.bincount(where, minlength=len(every))
            expected = total * n[c] / max(len(y), 1)
            gain = np.where(inside > expected, (inside - expected) ** 2 / (expected + 1), 0)
            telling |= set(every[np.argsort(-gain, kind="stable")[:TELLING]].tolist())
        return np.array(sorted(telling), np.int64)

    def _design(self, row: np.ndarray, h: np.ndarray, x: np.ndarray) -> np.ndarray:
        """A word says that it is there, so words may repeat and come in any order."""
        out = np.zeros((len(x), len(self.words) + x.shape[1] + 1))
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
            hit = self.words[at] == h
            out[row[hit], at[hit]] = 1
        out[:, len(self.words) : -1] = np.clip((x - self.centre) / self.scale, -8, 8)
        out[:, -1] = 1
        return out

    def posterior(self, row: np.ndarray, h: np.ndarray, x: np.ndarray) -> np.ndarray:
        return _softmax(self._design(row, h, x) @ self.weights)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def telling_words(known: DataFrame, scratch: Scratch) -> np.ndarray:
    """The ``TELLING`` words of each domain (``known``: ``y, words``) that are there most beyond expectation, in order of their hash.

    Words are counted and ranked by Spark: only the telling ones reach the driver.
    """
    own = lambda c: F.count(F.when(F.col("y") == c, 1)).alias(f"n{c}")
    every = [own(c) for c in range(len(DOMAINS))]
    n = known.agg(*every, F.count("*")).collect()[0]
    seen = known.select("y", F.explode("words").alias("word")).groupBy("word").agg(*every, F.count("*").alias("total"))
    seen, found = scratch.keep(seen, "words"), None
    for c in range(len(DOMAINS)):
        expected = F.col("total") * F.lit(float(n[c])) / F.lit(float(max(n[-1], 1)))
        beyond = F.col(f"n{c}") - expected
        gain = F.when(beyond > 0, beyond * beyond / (expected + 1)).otherwise(F.lit(0.0))
        first = seen.select("word", gain.alias("gain")).orderBy(F.desc("gain"), "word").limit(TELLING).select("word")
        found = first if found is None else found.unionByName(first)
    return np.array(sorted({r.word for r in found.collect()}), np.int64)


def _told(own: np.ndarray):
    """Rows with their telling words only."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("words")
            row = np.repeat(np.arange(batch.num_rows), np.diff(words.offsets.to_numpy()))
            values = words.flatten().to_numpy(zero_copy_only=False)
            hit = np.isin(values, own)
            few = lists(values[hit], np.bincount(row[hit], minlength=batch.num_rows), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("y"), few, batch.column("x")], names=["y", "words", "x"])

    return rows


def fit_membership(docs: DataFrame, labels: DataFrame, scratch: Scratch) -> Membership:
    """``labels``: ``doc_id, y``. At most ``SAMPLE`` rows reach the driver, with their telling words only, which bounds what is broadcast, too."""
    kinds = "y int, words array<long>, x array<double>"
    picked = labels.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(SAMPLE)
    known = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("doc_id", "text", "y")
    known = scratch.keep(known.mapInArrow(_features, kinds), "known")
    own = telling_words(known, scratch)
    rows = known.mapInArrow(_told(own), kinds).orderBy("y", "x", "words").toPandas()  # sorting sends the driver samples of its keys
    width = len(statistics(pa.RecordBatch.from_pydict({"text": pa.array([""])}))[0])
    return Membership.fit(rows["y"].to_numpy(np.int64), list(rows["words"]), np.stack(rows["x"]) if len(rows) else np.zeros((0, width)), own)


def _members(model: Membership):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            row, h, n = _lowered(batch)
            p = model.posterior(row, signed(h), statistics(batch))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("source"), pa.array(n.astype(np.int64)), lists(p.reshape(-1), np.full(len(p), len(DOMAINS)), pa.float64())], names=["doc_id", "source", "n_words", "p"])

    return rows


@dataclass
class Rates:
    """The history of residuals, from which any document's rate follows."""

    residuals: list[np.ndarray]
    weights: np.ndarray

    def replay(self, p: np.ndarray) -> np.ndarray:
        r = np.ones(len(p))
        for e in self.residuals:
            r = np.maximum(0, r - (p @ (self.weights * e) + RIDGE * (r - 1)) / (1 + RIDGE))
        return r


def _read(batch: pa.RecordBatch) -> np.ndarray:
    return np.array(batch.column("p").flatten()).reshape(-1, len(DOMAINS))


def _totals(rates: Rates):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(DOMAINS))
        for batch in batches:
            p = _read(batch)
            total += (rates.replay(p) * np.array(batch.column("n_words"))) @ p
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in total], names=[*DOMAINS])

    return rows


def domain_totals(members: DataFrame, rates: Rates) -> np.ndarray:
    """Rounds have one row for each task and no key, so one small task adds them up, however many partitions a shuffle has."""
    totals = members.mapInArrow(_totals(rates), ", ".join(f"{d} double" for d in DOMAINS))
    return np.array([v or 0.0 for v in totals.agg(*[F.sum(d) for d in DOMAINS]).collect()[0]])


def fit_rates(members: DataFrame, targets: np.ndarray, now: np.ndarray) -> Rates:
    """Rates whose expected word totals by domain come to ``targets``; ``now`` are the totals at rate 1."""
    whole = now.sum()
    if whole == 0:
        return Rates([], np.zeros(len(DOMAINS)))
    rates = Rates([], 1 / np.maximum(now / whole, _LEAST_SHARE))
    have, before = now, None
    for _ in range(STEPS):
        e = (have - targets) / whole
        if before is not None and np.abs(e - before).max() < PRECISION:
            break
        rates.residuals.append(e)
        before, have = e, domain_totals(members, rates)
    return rates


def _rated(rates: Rates):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rates.replay(_read(batch)))], names=[*batch.schema.names, "rate"])

    return rows


MEMBER = "doc_id long, source string, n_words long, p array<double>"


def fit_mix(docs: DataFrame, labels: DataFrame, weights: dict[str, float] | None = None, factors: dict[str, float] | None = None) -> tuple[Membership, Rates, DataFrame]:
    """The classifier, the rates and the members (``MEMBER``) of ``docs`` (``doc_id, text, source``).

    Targets are ``weights`` as shares of all words, or the present totals times ``factors``.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), "text")
    model = fit_membership(texts, domain_labels(labels), scratch)
    members = scratch.keep(texts.mapInArrow(_members(model), MEMBER), "members")
    now = domain_totals(members, Rates([], np.zeros(len(DOMAINS))))
    if weights is not None:
        share = np.array([weights.get(d, 0.0) for d in DOMAINS])
        targets = share / share.sum() * now.sum()
    else:
        targets = now * np.array([(factors or {}).get(d, 1.0) for d in DOMAINS])
    return model, fit_rates(members, targets, now), members


def mix(docs: DataFrame, labels: DataFrame, weights: dict[str, float] | None = None, factors: dict[str, float] | None = None) -> DataFrame:
    """``doc_id, source, n_words, p, rate`` of every row of ``docs``."""
    _, rates, members = fit_mix(docs, labels, weights, factors)
    return members.mapInArrow(_rated(rates), f"{MEMBER}, rate double")


def select_by_rate(docs: DataFrame, model: Membership, rates: Rates, least: float = 0.5, spared: str = "clean") -> DataFrame:
    """The rows of ``docs``, all columns, whose rate comes to one copy at least when rounded (``least`` 0.5).

    Documents that most likely belong to the domain ``spared`` stay: stray posteriors must not cost them their place.
    """
    safe = DOMAINS.index(spared)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            row, h, _ = _lowered(batch)
            p = model.posterior(row, signed(h), statistics(batch))
            yield batch.filter(pa.array((rates.replay(p) >= least) | (p.argmax(1) == safe)))

    return docs.mapInArrow(rows, docs.schema)


def source_weights(mixed: DataFrame) -> DataFrame:
    """What share of the mixture's words each source gives."""
    words = mixed.groupBy("source").agg(F.sum("n_words").alias("n_words"), F.sum(F.col("n_words") * F.col("rate")).alias("mixed_words"))
    whole = words.agg(F.sum("mixed_words")).first()[0] or 1.0
    return words.withColumn("weight", F.col("mixed_words") / whole)
