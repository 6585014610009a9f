import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from coursemill.llm.sliced import digits, positions, pack, scores, slices, top_scores


def brute(rows, k=20):
    fine = [(i, tuple(int(np.floor(64.0 * x)) for x in v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    fine, out = sorted(set(fine)), {}
    for q, x in fine:
        if q % 20 == 0:
            near = sorted({(-sum(a * b for a, b in zip(x, y)), i) for i, y in fine if i != q and len(x) == len(y)})
            out[q] = [(i, -s) for s, i in sorted({*near, *((-s, i) for i, s in out.get(q, []))})[:k]]
    return {q: v for q, v in out.items() if v}


def answers(df):
    out = {}
    for r in sorted(df.collect()):
        assert r["rank"] == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def decoded(planes, n):
    return sum((1 << p) * np.isin(np.arange(n), positions(s)).astype(object) for p, s in enumerate(planes)) if planes else np.zeros(n, object)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 130).flatmap(lambda n: st.integers(1, 5).flatmap(lambda d: st.tuples(st.lists(st.lists(st.integers(-(2**20), 2**20), min_size=d, max_size=d), min_size=n, max_size=n), st.lists(st.integers(-70, 70), min_size=d, max_size=d)))))
def test_slices_hold_the_scores(case):
    x, q = np.array(case[0], np.int64), np.array(case[1], np.int64)
    got, want = decoded(scores(slices(x), q), len(x)), x @ q
    assert len(set((got - want).tolist())) == 1  # the query's constant


@given(st.lists(st.integers(-(2**27), 2**27), min_size=1, max_size=20))
def test_digits_make_up_the_weights(values):
    q = np.array(values, np.int64)
    component, place, negative = digits(q)
    total = np.zeros_like(q)
    np.add.at(total, component, np.where(negative, -1, 1) << place)
    assert (total == q).all()


def test_pack_and_positions():
    bits = np.arange(130) % 3 == 0
    assert positions(pack(bits)).tolist() == np.nonzero(bits)[0].tolist()


def test_ties_copies_and_unfit_vectors(spark, monkeypatch):
    monkeypatch.setattr("coursemill.llm.sliced.ROWS", 100)
    random = np.random.default_rng(1)
    rows = [(i, (random.integers(-40, 40, 4) / 64).tolist()) for i in range(200)] + [(i, [1.0] * 4) for i in range(200, 520)]
    rows += [(600, None), (620, [1.0, None, 1.0, 1.0]), (640, [float("nan")] * 4), (660, [0.0] * 4), (None, [1.0] * 4), (300, [1.0] * 4), (700, [float("inf")] * 4)]
    rows += [(680, [1.0, 2.0]), (681, [1.0, -2.0]), (720, []), (740, [1e30, -1e30, 0.0, 0.0]), (40, [-0.01] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as x", "2 as part", "3 as dims", "4 as score").repartition(3)
    held = [(i, v and [None if x is None else x if not np.isfinite(x) else max(min(x, 2**21), -(2**21)) for x in v]) for i, v in rows]
    assert answers(top_scores(df, df.filter("vec_id % 20 = 0"))) == brute(held)


def test_few_and_no_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (7, [2.0, 1.0])], "vec_id long, embedding array<float>")
    assert answers(top_scores(df, df.filter("vec_id % 20 = 0"))) == {0: [(7, 4 * 64 * 64)]}
    assert top_scores(df.limit(0), df).count() == 0
    assert top_scores(df, df.limit(0)).count() == 0
