import collections
import math

import xxhash

from coursemill.llm.queries import op5_quality_rules
from coursemill.llm.rules import BUCKETS, PRIOR, THRESHOLD, quality_rules
from tests.conftest import plan
from tests.llm.helpers import edge_rows, frame, words


def grams(w):
    """Buckets of words, pairs of words and pairs of endings; a pair is the hash of two hashes, eight bytes each."""
    one, end = ([xxhash.xxh64_intdigest(x.encode(), 42) for x in part] for part in (w, [x[-3:] for x in w]))
    both = lambda a, b: xxhash.xxh64_intdigest(b.to_bytes(8, "little"), xxhash.xxh64_intdigest(a.to_bytes(8, "little"), 42))
    out = one + [both(a, b) for part in (one, end) for a, b in zip(part, part[1:])]
    return [(h - (1 << 64) if h >> 63 else h) % BUCKETS for h in out]


def brute(rows, trusted):
    raw, good = collections.Counter(), collections.Counter()
    for i, text in rows:
        g = grams(words(text))
        raw.update(g)
        if i in trusted:
            good.update(g)
    part = sum(good.values()) / max(sum(raw.values()), 1)
    out = []
    for i, text in rows:
        w, t = words(text), text or ""
        seen = collections.Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        cover = {k + j for k in range(len(w) - 2) if seen[tuple(w[k : k + 3])] > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if words(x)]
        g = grams(w)
        score = sum(math.log((good[b] + PRIOR * part) / (raw[b] + PRIOR) / part) for b in g) / len(g) if g and part else 0.0
        failed = len(w) < 50 or 100 * len(cover) > 50 * len(w)
        out.append((i, len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t), len(lines) - len(set(lines)), len(cover), failed, not failed and score >= THRESHOLD, round(score, 9)))
    return sorted(out, key=str)


def got(df):
    cells = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept, round(r.score, 9)) for r in df.collect()]
    return sorted(cells, key=str)


def test_equals_brute_force(spark):
    junk = [(300 + k, " ".join(f"AB{j * 7 % 50}!! <#{j}>" for j in range(60)) + "\na\na\n\n") for k in range(6)]
    rows = edge_rows() + junk
    trusted = set(range(0, 60, 2))
    labels = spark.createDataFrame([(i,) for i in trusted] + [(None,), (4,), (9999,)], "doc_id long")
    assert got(quality_rules(frame(spark, rows), labels)) == brute(rows, trusted)


def test_without_trusted_documents_base_rules_decide(spark):
    rows = edge_rows()
    labels = spark.createDataFrame([], "doc_id long")
    assert got(quality_rules(frame(spark, rows), labels)) == brute(rows, set())


def test_filter_on_the_verdict_and_no_python(spark):
    rows = edge_rows()
    labels = spark.createDataFrame([(i,) for i in range(60)], "doc_id long")
    out = quality_rules(frame(spark, rows), labels, carry=["doc_id", "text", "lang"]).filter("kept")
    assert {r.doc_id for r in out.collect()} == {x[0] for x in brute(rows, set(range(60))) if x[7]}
    whole = spark.range(1).selectExpr("id as doc_id", "'a b' as text")
    text = plan(quality_rules(whole, labels))
    assert "Python" not in text and "Arrow" not in text


def test_empty_table(spark):
    assert quality_rules(frame(spark, edge_rows()).limit(0), spark.createDataFrame([], "doc_id long")).count() == 0


def test_queries_tell_stems_apart(spark, tmp_path):
    good = lambda k: " ".join(f"{s}{(k * 7 + i * i) % 9}ing" for i in range(60) for s in ("walk", "sing"))
    bad = lambda k: " ".join(f"{s}{(k * 7 + i * i) % 9}ing" for i in range(60) for s in ("spam", "scam"))
    rows = [(k, good(k)) for k in range(40)] + [(100 + k, bad(k)) for k in range(40)]
    frame(spark, rows, extra=False).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, 1, 0) for k in range(40)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    scores = {r.doc_id: r.score for r in op5_quality_rules(spark, str(tmp_path)).collect()}
    assert max(scores[100 + k] for k in range(40)) < -0.2 < 0 < min(scores[k] for k in range(40))


def test_the_table_of_ratios_stands_in_the_plan_once(spark):
    labels = spark.createDataFrame([(i,) for i in range(0, 60, 2)], "doc_id long")
    text = quality_rules(frame(spark, edge_rows()), labels)._jdf.queryExecution().executedPlan().toString()
    assert text.count(",") < 1.5 * BUCKETS
