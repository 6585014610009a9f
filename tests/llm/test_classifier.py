import os

import numpy as np
import pyarrow as pa
import pytest

from coursemill.llm.classifier import FEATURES, Quadratic, quality_scores, statistics
from coursemill.llm.queries import QUERIES
from tests.llm.helpers import edge_rows, frame

SF = "/root/testdata/sf0.01"


def labelled():
    good = [(i, f"This is plain text number {i}, with a sentence or two. " + "It goes on for some words. " * (i % 5 + 1)) for i in range(400, 460)]
    bad = [(i, "BUY!! NOW!! " * (i % 7 + 9) + "### $$$") for i in range(500, 540)]
    return good + bad, [(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad]


def test_scores_whole_table_with_edges(spark):
    rows, labels = labelled()
    rows += edge_rows()
    y = spark.createDataFrame([*labels, (None, 1), (12345, 0), (401, None)], "doc_id long, y int")
    out = quality_scores(frame(spark, rows), y).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    score = {r.doc_id: r.score for r in out}
    assert all((score[i] >= 0.3) == bool(v) for i, v in labels)


def test_density_difference_equals_the_textbook_formula():
    x = np.random.default_rng(1).normal(size=(500, len(FEATURES)))
    y = (x[:, 0] > 0.3).astype(int)
    x[y == 1] *= 1.5
    total = np.stack([np.r_[(y == c).sum(), x[y == c].sum(0), (x[y == c].T @ x[y == c]).reshape(-1)] for c in (0, 1)])
    model = Quadratic.fit(total)
    z = (x - model.scale[0]) / model.scale[1]
    log = []
    for c in (0, 1):
        cov = model.factors[c] @ model.factors[c].T
        d = z - model.means[c]
        log.append(np.log((y == c).sum()) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d))
    assert np.allclose(model.score(x), 1 / (1 + np.exp(log[0] - log[1])))


@pytest.mark.parametrize("labels, score", [([], 0.5), ([(1, 1)], 1.0), ([(1, 0)], 0.0)])
def test_few_labels(spark, labels, score):
    out = quality_scores(frame(spark, edge_rows()), spark.createDataFrame(labels, "doc_id long, y int"))
    assert {r.score for r in out.collect()} == {score}


def test_statistics_are_finite():
    texts = pa.array([t for _, t in edge_rows()], pa.string())
    assert np.isfinite(statistics(pa.RecordBatch.from_arrays([texts], names=["text"]))).all()


def test_empty_table(spark):
    assert quality_scores(frame(spark, edge_rows()).limit(0), spark.createDataFrame([], "doc_id long, y int")).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are absent")
def test_held_out_accuracy(spark):
    out = QUERIES["op4_quality_classifier"](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r.quality for r in out) / len(out) >= 0.95
