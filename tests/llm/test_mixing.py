import random
import time

import numpy as np
import pyarrow as pa

from coursemill.llm.classifier import statistics
from coursemill.llm.common import Scratch
from coursemill.llm.mixing import DOMAINS, RIDGE, TELLING, Membership, Rates, domain_labels, domain_totals, fit_mix, mix, select_by_rate, source_weights, telling_words
from coursemill.llm.mixing import _features as features
from coursemill.llm.mixing import _members as members
from tests.llm.helpers import edge_rows, frame, words


def corpus():
    clean = [(i, "A calm and useful sentence about rivers and hills. " * (i % 4 + 1)) for i in range(400, 460)]
    low = [(i, "BUY!! NOW!! CHEAP!! " * (i % 5 + 4)) for i in range(500, 530)]
    toxic = [(i, "A calm sentence, you idiot and moron, about rivers and hills. " * (i % 4 + 1)) for i in range(600, 630)]
    labels = [(i, 1, 0) for i, _ in clean] + [(i, 0, 0) for i, _ in low] + [(i, 1, 1) for i, _ in toxic]
    return clean + low + toxic, [*labels, (None, 1, 0), (99999, 1, 1), (400, None, None)]


def frames(spark, rows, labels):
    return frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def reference_rates(p, n, targets, weights):
    """The same minimum by many plain projected steps."""
    r, whole = np.ones(len(p)), n.sum()
    for _ in range(4000):
        r = np.maximum(0, r - 0.5 * (p @ (weights * (((r * n) @ p) - targets) / whole) + RIDGE * (r - 1)))
    return r


def test_totals_match_targets_and_rates_are_the_minimum(spark):
    rows, labels = corpus()
    rows += edge_rows()
    docs, known = frames(spark, rows, labels)
    want = {"clean": 0.8, "low": 0.15, "toxic": 0.05}
    out = mix(docs, known, weights=want).collect()
    assert len(out) == len(rows) and all(r.rate >= 0 for r in out)
    p, n, rate = np.array([r.p for r in out]), np.array([r.n_words for r in out], float), np.array([r.rate for r in out])
    assert np.allclose(p.sum(1), 1)
    assert np.allclose((rate * n) @ p / n.sum(), [want[d] for d in DOMAINS], atol=5e-3)
    now = n @ p / n.sum()
    assert np.allclose(rate, reference_rates(p, n, np.array([want[d] for d in DOMAINS]) * n.sum(), 1 / np.maximum(now, 1e-3)), atol=2e-3)


def test_posteriors_follow_labels(spark):
    rows, labels = corpus()
    docs, known = frames(spark, rows, labels)
    kind = {r.doc_id: r.y for r in domain_labels(known).collect()}
    assert all(int(np.argmax(r.p)) == kind[r.doc_id] for r in mix(docs, known, weights={"clean": 1}).collect())


def test_labelled_empty_documents_do_not_blur_words(spark):
    rows, labels = corpus()
    docs, known = frames(spark, [*rows, (300, ""), (301, None)], [*labels, (300, 1, 0), (301, 1, 0)])
    kind = {r.doc_id: r.y for r in domain_labels(known).collect()}
    assert all(int(np.argmax(r.p)) == kind[r.doc_id] for r in mix(docs, known, weights={"clean": 1}).collect())


def test_selection_drops_what_the_mixture_does_not_want(spark):
    rows, labels = corpus()
    docs, known = frames(spark, rows, labels)
    model, rates, _ = fit_mix(docs, known, factors={"clean": 1.0, "low": 0.05, "toxic": 0.05})
    kept = select_by_rate(docs, model, rates)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, _ in rows if i < 500}
    weights = source_weights(mix(docs, known, weights={"clean": 1}))
    assert abs(sum(r.weight for r in weights.collect()) - 1) < 1e-9


def test_without_labels_or_rows(spark):
    docs, known = frames(spark, edge_rows(), [])
    out = mix(docs, known, factors={}).collect()
    assert all(np.allclose(r.p, 1 / len(DOMAINS)) and abs(r.rate - 1) < 1e-9 for r in out)
    assert mix(docs.limit(0), known, weights={"clean": 1}).count() == 0
    assert {r.rate for r in mix(docs.filter("text is null"), known, weights={"clean": 1}).collect()} == {1.0}


def lowered(text):
    """Distinct words without capitals and up to three closing marks."""
    out = set()
    for word in words(text):
        data = bytes(b + 32 if 65 <= b <= 90 else b for b in word.encode())
        for _ in range(3):
            if len(data) > 1 and not (data[-1:].isalnum() or data[-1] >= 128):
                data = data[:-1]
        out.add(data)
    return out


def labelled(texts):
    n = len(texts)
    columns = {"doc_id": pa.array(range(n)), "text": pa.array(texts), "source": pa.array(["s"] * n), "y": pa.array([i % 3 for i in range(n)], pa.int32())}
    return pa.RecordBatch.from_pydict(columns)


def test_a_document_has_each_word_once():
    texts = [t for _, t in edge_rows()] + ["Word word, WORD!!! word. other", "!", "a!!!! A"]
    got = next(features(iter([labelled(texts)]))).column("words").to_pylist()
    assert [len(w) for w in got] == [len(set(w)) for w in got] == [len(lowered(t)) for t in texts]
    assert len(set().union(*got)) == len(set().union(*map(lowered, texts)))


def test_posteriors_cost_little_more_than_the_statistics():
    say = random.Random(3)
    batch = labelled([" ".join(f"word{say.randint(0, 3000)}" for _ in range(400)) for _ in range(500)])
    known = next(features(iter([batch])))
    model = Membership.fit(np.array(known.column("y")), known.column("words").to_pylist(), np.array(known.column("x").to_pylist()))

    def least(run):
        took = []
        for _ in range(3):
            began = time.process_time()
            run()
            took.append(time.process_time() - began)
        return min(took)

    assert least(lambda: list(members(model)(iter([batch])))) < 2.5 * least(lambda: statistics(batch))


def test_only_telling_words_reach_the_driver(spark, monkeypatch):
    rows, labels = corpus()
    say = random.Random(9)
    docs, known = frames(spark, [(i, t + " " + " ".join(f"word{say.randint(0, 5000)}" for _ in range(60))) for i, t in rows], labels)
    came, fit = [], Membership.fit
    monkeypatch.setattr(Membership, "fit", lambda y, words, *more: came.append(np.unique(np.concatenate(words))) or fit(y, words, *more))
    model, _, _ = fit_mix(docs, known, factors={})
    assert len(came) == 1 and TELLING <= len(came[0]) <= TELLING * len(DOMAINS)
    assert set(came[0]) <= set(model.words)


def test_telling_words_are_those_of_a_plain_count(spark):
    say = random.Random(11)
    y = [say.choice([0, 0, 1, 2]) for _ in range(200)]
    words_ = [sorted({say.randint(0, 900) * 7919 - 3_000_000 + (k if say.random() < 0.3 else 0) for _ in range(40)}) for k in y]
    known = spark.createDataFrame([*zip(y, words_)], "y int, words array<long>").repartition(3)
    plain = Membership._telling(np.array(y), [np.array(w) for w in words_], np.repeat(np.arange(len(y)), [len(w) for w in words_]))
    assert telling_words(known, Scratch(spark, "test")).tolist() == plain.tolist()
    assert telling_words(known.limit(0), Scratch(spark, "test")).tolist() == []


def test_a_round_has_one_task_that_adds_up(spark):
    rows = [(k, "s", 10 + k, [0.5, 0.25, 0.25]) for k in range(30)]
    members_ = spark.createDataFrame(rows, "doc_id long, source string, n_words long, p array<double>").repartition(3)
    members_ = Scratch(spark, "test").keep(members_, "members")
    names = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    was = {k: spark.conf.get(k) for k in names}
    context, tracker = spark.sparkContext, spark.sparkContext.statusTracker()
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        context.setJobGroup("a-round", "")
        totals = domain_totals(members_, Rates([], np.zeros(len(DOMAINS))))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for k, v in was.items():
            spark.conf.set(k, v)
    whole = sum(r[2] for r in rows)
    assert totals.tolist() == [whole / 2, whole / 4, whole / 4]
    stages = {x for j in tracker.getJobIdsForGroup("a-round") for x in tracker.getJobInfo(j).stageIds}
    assert sum(info.numTasks for x in stages if (info := tracker.getStageInfo(x))) <= 10
