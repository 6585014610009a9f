import re

import numpy as np
import pytest
import xxhash

from coursemill.llm.common import Scratch
from coursemill.llm.simhash import forest, near_fingerprints, simhash
from tests.llm.helpers import components, edge_rows, frame, words


def fingerprint(text):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    parts = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("split", [4096, 2])
def test_equals_brute_force(spark, split):
    rows = edge_rows()
    rows += [(200 + k, rows[5][1] + f" more{k}") for k in range(4)]
    prints = [fingerprint(t) for _, t in rows]
    group = components(rows, lambda i: [j for j in range(len(rows)) if bin(prints[i] ^ prints[j]).count("1") <= 2])
    least = {}
    for (i, _), g in zip(rows, group):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    want = sorted(((i, f"{p:016x}", least.get(g)) for (i, _), p, g in zip(rows, prints, group)), key=str)
    assert sorted(map(tuple, simhash(frame(spark, rows), split=split).collect()), key=str) == want


def _clusters():
    random = np.random.default_rng(3)
    centres, out = random.integers(0, 1 << 63, 12).tolist(), set()
    for _ in range(1500):
        x = centres[random.integers(12)]
        for b in random.integers(0, 64, random.integers(0, 4)).tolist():
            x ^= 1 << b
        out.add(x)
    return np.array(sorted(out), np.uint64)


def _classes(fps):
    return components(fps, lambda i: np.nonzero(np.bitwise_count(fps ^ fps[i]) <= 2)[0].tolist())


def test_bit_sliced_forest_ties_what_brute_force_ties():
    fps = _clusters()
    label = forest(fps, np.zeros(len(fps), np.int64), 2)
    want = _classes(fps)
    assert len(set(zip(label.tolist(), want))) == len(set(want)) == len(set(label.tolist()))


@pytest.mark.parametrize("split", [4096, 20])
def test_filing_loses_no_link(spark, split):
    fps = _clusters()
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    place = {int(x): i for i, x in enumerate(fps.view(np.int64))}
    edges = [(place[a], place[b]) for a, b in near_fingerprints(df, Scratch(spark, "t"), 2, split).collect()]
    to = {}
    for a, b in edges:
        to.setdefault(a, []).append(b)
    got, want = components(fps, lambda i: to.get(i, [])), _classes(fps)
    assert len(set(zip(got, want))) == len(set(want)) == len(set(got))


def test_empty_table(spark):
    assert simhash(frame(spark, edge_rows()).limit(0)).count() == 0
