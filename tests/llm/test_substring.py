import hashlib

import pytest

from coursemill.llm.substring import levels, substring_dedup
from tests.llm.helpers import PASSAGE, edge_rows, frame, words


def brute(rows, window):
    least = {}
    for i, text in rows:
        w = words(text)
        for k in range(len(w) - window + 1):
            if i is not None:
                key = tuple(w[k : k + window])
                least[key] = min(i, least.get(key, i))
    out = []
    for i, text in rows:
        w, gone = words(text), set()
        for k in range(len(w) - window + 1):
            if i is not None and least[tuple(w[k : k + window])] < i:
                gone |= set(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("window", [13, 5, 40])
def test_equals_brute_force(spark, window):
    rows = edge_rows()
    out = substring_dedup(frame(spark, rows), window).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted(map(tuple, out.collect()), key=str) == brute(rows, window)


@pytest.mark.parametrize("window", [13, 40])
def test_rows_of_one_id_are_judged_apart(spark, window):
    own = " ".join(f"own{k}" for k in range(60))
    rows = [(1, PASSAGE), (5, own), (5, PASSAGE), (5, "x y"), (5, f"x y {PASSAGE}"), (6, own), (5, own)]
    out = substring_dedup(frame(spark, rows), window).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted(map(tuple, out.collect()), key=str) == brute(rows, window)


def test_levels_double_up_to_the_window():
    assert levels(13) == [7, 13] and levels(50) == [7, 13, 25, 50] and levels(4) == [4]


def test_kept_text_spans_and_carried_columns(spark):
    rows = edge_rows()
    out = substring_dedup(frame(spark, rows), carry=["lang", "source"]).collect()
    text = {}
    for i, t in rows:
        text.setdefault(i, []).append(t)
    for r in out:
        assert hashlib.sha256(" ".join(words(r.kept_text)).encode()).hexdigest() == r.kept_sha256
        assert sum(b - a for a, b in zip(r.removed_spans[::2], r.removed_spans[1::2])) == r.n_removed
        assert r.carried.lang == "en"
        if not r.n_removed:
            assert r.kept_text in [t or "" for t in text[r.doc_id]]


def test_empty_table(spark):
    assert substring_dedup(frame(spark, edge_rows()).limit(0)).count() == 0
