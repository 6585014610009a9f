import collections
import math
import random
import re

import numpy as np

from coursemill.llm import lexical
from coursemill.llm.lexical import at_least, search
from coursemill.llm.sliced import add, pack, positions
from tests.llm.helpers import edge_rows, frame

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(rows, items, k=50):
    docs = [(i, collections.Counter(terms(t))) for i, t in rows]
    docs = [(i, c) for i, c in docs if c]
    many, total = len(docs), sum(sum(c.values()) for _, c in docs)
    df = collections.Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        w = {t: math.floor(1000 * math.log((2.0 * many + 2) / (2 * df[t] + 1))) for t in set(terms(text))}
        found = []
        for i, c in docs:
            m = 50 + 50 * sum(c.values()) * many // total
            s = sum(v * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t, v in w.items() if t in c)
            if s > 0:
                found.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


ITEMS = [(0, "alpha3 BETA7 gamma1, delta9!"), (1, "shared1 shared2 shared3 same one"), (2, None), (3, ""), (4, "nowhere at all to be found"), (5, "théta3 日本語 w5x5 Omega"), (5, "one two"), (6, "alpha3 BETA7 gamma1, delta9!"), (None, "two"), (7, "same " * 9)]


def test_equals_brute_force(spark):
    rows = edge_rows()
    items = spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", "1 as key", "2 as doc_id", "3 as least")
    assert got(search(frame(spark, rows), items)) == brute(rows, ITEMS)


def test_many_documents_ties_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(lexical, "ITEMS", 2)
    monkeypatch.setattr(lexical, "DOCS", 128)
    say = random.Random(3)
    rows = [(i, " ".join(f"t{min(say.randint(0, 90), say.randint(0, 90))}" for _ in range(say.choice([3, 20, 60])))) for i in range(1500)]
    rows += [(2000 + i, "t1 t2 t3 copied many times") for i in range(700)]
    items = [(i, " ".join(f"t{say.randint(0, 90)}" for _ in range(9))) for i in range(5)] + [(9, "copied t1")]
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert got(search(frame(spark, rows), asked)) == brute(rows, items)
    monkeypatch.setattr(lexical, "BROADCAST_TERMS", 0)
    assert got(search(frame(spark, rows), asked)) == brute(rows, items)


def test_most_documents_are_excluded_by_their_bounds(spark):
    say = random.Random(4)
    rows = [(i, " ".join(f"t{int(say.paretovariate(0.5)) % 5000}" for _ in range(60))) for i in range(4000)]
    block = lexical._built(len(rows), sum(len(terms(t)) for _, t in rows))
    import pyarrow as pa

    columns = pa.RecordBatch.from_pydict({"id": pa.array([i for i, _ in rows]), "text": [t for _, t in rows]})
    table = pa.Table.from_batches(list(lexical._terms([columns])))
    built = lexical.Block(block((pa.scalar(6), pa.scalar(0)), table).to_batches()[0], 0)
    words, n = np.unique(built.code, return_counts=True)
    codes = words[(n > 20) & (n < 60)][:8]
    weights = np.full(len(codes), 4000)
    docs, score, scored = built.best(codes, weights, 1, 50)
    exact = built.scores(np.arange(len(rows)), codes, weights)
    assert score.tolist() == sorted(exact.tolist(), reverse=True)[:50]
    assert scored < len(rows) / 4
    sums, unit = built.bounds(codes, weights)
    bound = sum((1 << p) * np.isin(np.arange(len(rows)), positions(s)) for p, s in enumerate(sums)) * unit
    assert (bound >= exact).all()


def test_at_least():
    values = np.array([0, 1, 5, 7, 12, 12, 3])
    sums = add([pack((values >> b & 1 == 1))[None] for b in range(4)])
    live = pack(np.ones(7, bool))
    for least in range(18):
        assert positions(at_least(sums, least, live)).tolist() == np.nonzero(values >= least)[0].tolist()


def test_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = frame(spark, edge_rows())
    assert search(docs.limit(0), items).count() == 0
    assert search(docs, items.limit(0)).count() == 0
