import collections
import math
import os
import re

import numpy as np
import pyarrow as pa
import pytest

from coursemill.llm import likelihood
from coursemill.llm.common import Scratch, span_hashes
from coursemill.llm.likelihood import CLASSES, EACH, OWN, RARE, SIDE, Network, Vocabulary, frequent, pseudo_likelihood, rare_scores, train, vocabulary
from coursemill.llm.likelihood import _scored as scored
from coursemill.llm.likelihood import _trained as trained
from tests.conftest import plan
from tests.llm.helpers import edge_rows, frame, words

SF = "/root/testdata/sf0.01"


def test_gradient_equals_differences():
    random = np.random.default_rng(0)
    net = Network.first(random.integers(0, 50, CLASSES * EACH).astype(float))
    around, target = random.integers(0, CLASSES * EACH + 1, (40, 4)), random.integers(0, CLASSES * EACH, 40)
    g = net.gradient(around, target)
    for i in random.choice(np.nonzero(np.abs(g) > 3e-4)[0], 15):
        def loss(d, i=i):
            moved = net.flat.copy()
            moved[i] += d
            return -Network(moved).log_probabilities(around, target).mean()

        assert (loss(1e-2) - loss(-1e-2)) / 2e-2 == pytest.approx(float(g[i]), rel=0.05, abs=1e-5)


def test_probabilities_sum_to_one():
    net = Network.first(np.arange(CLASSES * EACH, dtype=float))
    around = np.tile([[5, 9, 4096, 70]], (CLASSES * EACH, 1))
    assert np.exp(net.log_probabilities(around, np.arange(CLASSES * EACH))).sum() == pytest.approx(1, abs=1e-4)


def test_every_word_of_every_row(spark):
    rows = edge_rows()
    out = pseudo_likelihood(frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_words) for r in out), key=str) == sorted(((i, len(words(t))) for i, t in rows), key=str)
    for r in out:
        assert (r.mean_log_likelihood is None and r.log_likelihood == 0) if not r.n_words else math.isclose(r.mean_log_likelihood, r.log_likelihood / r.n_words) and r.log_likelihood < 0
    assert len({r.log_likelihood for r in out if r.doc_id in (120, 121)}) == 1
    assert pseudo_likelihood(frame(spark, rows).limit(0)).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are absent")
def test_training_beats_word_frequencies(spark):
    texts = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    own = vocabulary(texts, Scratch(spark, "t"))
    kinds = "doc_id long, n_words long, log_likelihood double, mean_log_likelihood double"
    total = lambda net: texts.mapInArrow(scored(own, net), kinds).selectExpr("sum(log_likelihood)").first()[0]
    assert total(train(texts, own)) > 0.98 * total(Network.first(own.counts))


def test_rare_words_are_told_apart_by_their_counts(spark):
    often = " ".join(f"common{i}" for i in range(OWN) for _ in range(4))
    rows = [(k, often) for k in range(3)] + [(10, "twice " * 8 + "x0"), (11, "twice"), (12, "typo"), (13, "typo typo twice")]
    rows += [(20, " ".join(f"rare{i}" for i in range(2000)))]
    got = {r.doc_id: r.log_likelihood for r in pseudo_likelihood(frame(spark, rows), 0).collect()}
    counts = collections.Counter(w for _, t in rows for w in words(t))
    every = sum(counts.values())
    # untrained, the network gives the smoothed share of the id, and the join the word's share of the id
    assert got[11] - got[12] > math.log(counts["twice"] / counts["typo"]) - 1
    for i, word in ((11, "twice"), (12, "typo")):
        assert abs(got[i] - math.log(counts[word] / every)) < 0.5
    assert math.isclose(got[13], 2 * got[12] + got[11], abs_tol=0.3)


def test_shares_of_an_id_sum_to_one(spark):
    rows = [(k, " ".join(f"w{i}" for i in range(6000) for _ in range(1 + i % 3))) for k in range(2)]
    own = vocabulary(frame(spark, rows), Scratch(spark, "t"))
    assert own.counts.sum() == sum(len(words(t)) for _, t in rows)
    texts = spark.createDataFrame([(i, f"w{i}") for i in range(6000)], "key long, text string")
    kept = rare_scores(texts, own, Scratch(spark, "t")).collect()
    assert len(kept) == 6000 - OWN
    assert sum(math.exp(r.rare) for r in kept) == pytest.approx((own.counts[OWN:] > 0).sum())


@pytest.mark.parametrize("rounds", [1, 2, 3])
def test_every_place_is_a_target_once(rounds):
    texts = [" ".join(f"w{k * i % 41}" for i in range(k % 7 * 30)) for k in range(40)] + ["one", None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    own = Vocabulary(np.zeros(0, np.int64), np.zeros(0, np.int64))
    seen = [next(trained(own, Network.first(own.counts), turn, rounds)(iter([batch]))).column("v")[-1].as_py() for turn in range(rounds)]
    assert sum(seen) == sum(len(words(t)) for t in texts) and min(seen) > 0.8 * max(seen)


def test_scores_equal_a_full_softmax_in_plain_loops(spark):
    often = [f"common{i}" for i in range(OWN)]
    rows = [(k, " ".join(often * 3)) for k in range(2)] + [(10 + k, f"common{k} odd{k % 3} common{7 * k} odd{k % 3} common1 é{k}") for k in range(8)] + [(20, None), (21, "odd0")]
    docs = frame(spark, rows).coalesce(1)
    got = {r.doc_id: r.log_likelihood for r in pseudo_likelihood(docs, 1).collect()}
    own = vocabulary(docs, Scratch(spark, "t"))
    net = train(docs, own, 1)
    counts = collections.Counter(w for _, t in rows for w in words(t))
    number = {w: int(own.look(span(w))[0]) for w in counts}
    of_id = collections.Counter()
    for w, n in counts.items():
        of_id[number[w]] += n
    assert {w for w in counts if w.startswith("é")} <= {w for w, i in number.items() if OWN <= i < OWN + RARE}
    for doc, text in rows[2:]:
        ids, total = [number[w] for w in words(text)], 0.0
        for at, word in enumerate(words(text)):
            near = [ids[at + k] if 0 <= at + k < len(ids) else CLASSES * EACH for k in range(-SIDE, SIDE + 1) if k]
            x = [float(v) for i in near for v in net.embed[i]]
            h = [math.tanh(sum(a * float(b) for a, b in zip(x, net.w[:, j])) + float(net.b[j])) for j in range(net.w.shape[1])]
            out = lambda weights, bias: [math.exp(sum(a * float(b) for a, b in zip(h, weights[:, j])) + float(bias[j])) for j in range(len(bias))]
            kind, member = divmod(ids[at], EACH)
            kinds, members = out(net.wc, net.bc), out(net.ww[kind], net.bw[kind])
            total += math.log(kinds[kind] / sum(kinds)) + math.log(members[member] / sum(members))
            if ids[at] >= OWN:
                total += math.log(counts[word] / of_id[ids[at]])
        assert got[doc] == pytest.approx(total, abs=2e-3), doc


def span(word):
    data = np.frombuffer(word.encode(), np.uint8)
    return span_hashes(data, np.array([0]), np.array([len(data)]), 5)


@pytest.mark.parametrize("known", [0, OWN + 200])
def test_rare_words_score_the_same_joined_or_known(spark, monkeypatch, known):
    often = " ".join(f"common{i}" for i in range(OWN) for _ in range(40))
    rows = [(0, often), (1, " ".join(f"r{i} " * (i % 9 + 1) for i in range(900))), (2, "r8 r8 r1 common1 r0"), (3, "r8 r8 r1 common1 r0"), (4, "common2"), (5, None)]
    monkeypatch.setattr(likelihood, "KNOWN", known)
    docs = frame(spark, rows)
    own = vocabulary(docs, Scratch(spark, "t"))
    assert (len(own.known.words) > 0) == (known > 0) and len(own.known.words) < 900
    counts = collections.Counter(w for _, t in rows for w in words(t))
    number = {w: int(own.look(span(w))[0]) for w in counts}
    of_id = collections.Counter()
    for w, n in counts.items():
        of_id[number[w]] += n
    texts = docs.selectExpr("doc_id as key", "text")
    got = {r.key: r.rare for r in rare_scores(texts, own, Scratch(spark, "t")).collect()}
    want = {i: sum(math.log(counts[w] / of_id[number[w]]) for w in words(t) if number[w] >= OWN) for i, t in rows if i in (1, 2, 3)}
    assert got == pytest.approx(want)


def test_frequent_words_are_no_more_than_asked_for(spark):
    counted = spark.range(1000).selectExpr("id as word", "1 + id % 100 as n")
    for most in (0, 5, 10, 300, 999, 1000, 5000):
        got = [(r.n, r.word) for r in frequent(counted, most).collect()]
        assert len(got) <= most and all(n > 100 - most / 10 for n, _ in got)
    assert frequent(counted, 1000).count() == 1000 and frequent(counted, 300).count() > 200
    assert frequent(counted.limit(0), 10).count() == 0


def test_logits_beyond_the_plain_bound_are_scored_alike():
    random = np.random.default_rng(2)
    net = Network.first(random.integers(0, 50, CLASSES * EACH).astype(float))
    around, target = random.integers(0, CLASSES * EACH + 1, (700, 4)), random.integers(0, CLASSES * EACH, 700)
    plain, slope = net.log_probabilities(around, target), net.gradient(around, target).copy()
    net.bc += 200
    net.bw -= 300
    assert np.allclose(net.log_probabilities(around, target), plain, atol=2e-3)
    assert np.allclose(net.gradient(around, target), slope, atol=1e-5)


def test_frequent_rare_words_are_not_shuffled_one_by_one(spark):
    rows = [(k, " ".join(f"w{i}" for i in range(OWN + 900))) for k in range(3)]
    docs = frame(spark, rows).coalesce(1)
    own = vocabulary(docs, Scratch(spark, "t"))
    batch = pa.RecordBatch.from_arrays([pa.array([7, 8]), pa.array([rows[0][1], "w1 w1 other"])], names=["key", "text"])
    out = pa.Table.from_batches(list(likelihood._rare_words(own)(iter([batch]))))
    assert out.num_rows <= 3  # one for each text, and the word that is not in the table


def test_rare_words_are_summed_without_a_shuffle_by_word_and_text(spark, monkeypatch):
    rows = [(0, " ".join(f"common{i}" for i in range(OWN) for _ in range(40)))] + [(k, "odd odd rare1 common3 rare2") for k in range(1, 9)] + [(9, "common1"), (10, None), (11, "odd rare2")]
    for known in (0, 1 << 16):
        monkeypatch.setattr(likelihood, "KNOWN", known)
        docs = frame(spark, rows)
        own = vocabulary(docs, Scratch(spark, "t"))
        counts = collections.Counter(w for _, t in rows for w in words(t))
        number = {w: int(own.look(span(w))[0]) for w in counts}
        of_id = collections.Counter()
        for w, n in counts.items():
            of_id[number[w]] += n
        totals = likelihood._rare_totals(docs.selectExpr("xxhash64(text) as key", "doc_id", "text").repartition(8, "doc_id"), own)
        assert len(re.findall(r"hashpartitioning\(key[^,]*, word", plan(totals))) == 0
        want = sorted(sum(math.log(counts[w] / of_id[number[w]]) for w in words(t) if number[w] >= OWN) for t in {t for _, t in rows[1:]} if any(number[w] >= OWN for w in words(t)))
        assert sorted(r.rare for r in totals.collect()) == pytest.approx(want)
