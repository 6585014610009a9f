import collections
import re

import corpus_pipeline
import pytest
import sentencepiece

import __spark_entry__ as entry
from coursemill.llm.pieces import MODEL
from tests.llm import test_mixing, test_rules, test_simhash
from tests.llm.helpers import PASSAGE, components


@pytest.fixture(scope="module")
def folder(tmp_path_factory, spark):
    """A small corpus with every case the stages look for."""
    docs, labels = test_mixing.corpus()
    say = lambda i, n: " ".join(f"word{(i * 37 + k * k) % 4001}" for k in range(n))
    rows = [(i, f"{t} {say(i, 120)}.") for i, t in docs]
    rows += [(700, say(1, 200)), (701, say(1, 200)), (702, say(1, 199) + " changed"), (703, f"{say(3, 90)} {PASSAGE} {say(4, 90)}"), (704, f"{say(5, 90)} {PASSAGE}\n{say(6, 90)}")]
    rows += [(705, say(7, 200)), (705, say(7, 200))]
    rows += [(710, None), (711, ""), (712, "too short"), (713, "again and again " * 60), (None, say(9, 150))]
    rows += [(800 + k, " ".join(f"AB{(j * 7 + k) % 50}!! <#{j}>" for j in range(60))) for k in range(8)]
    root = str(tmp_path_factory.mktemp("corpus"))
    df = spark.createDataFrame([(i, t, "en", f"src{(i or 0) % 3}", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    df.repartition(3).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return root, rows, labels


def cut(rows, window=13):
    """Texts without the words that windows of a smaller id have too, with the white space before them."""
    least = {}
    spans = [(i, t, list(re.finditer(r"[^\x20\x09-\x0D]+", t))) for i, t in rows]
    for i, _, w in spans:
        for k in range(len(w) - window + 1):
            if i is not None:
                key = tuple(m[0] for m in w[k : k + window])
                least[key] = min(i, least.get(key, i))
    out = []
    for i, t, w in spans:
        gone = {k + j for k in range(len(w) - window + 1) if i is not None and least[tuple(m[0] for m in w[k : k + window])] < i for j in range(window)}
        text = "".join(t[(w[k - 1].end() if k else 0) : m.end()] for k, m in enumerate(w) if k not in gone) + (t[w[-1].end() :] if w else t)
        if len(gone) == len(w) and w:
            text = ""
        elif 0 in gone:
            text = text.lstrip(" \t\n\r\x0b\x0c")
        out.append((i, text))
    return out


def test_stages_equal_brute_force(spark, folder):
    root, rows, labels = folder
    kind = {i: (0 if q and not x else 1) for i, q, x in labels if None not in (i, q)}
    got, docs = {}, spark.read.parquet(f"{root}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "simhash_near_dedup", "substring_dedup", "mixing", "sentencepiece"]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, root)
        path = f"{root}/out-{name}"
        docs.write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        got[name] = docs.collect()
        if name != "sentencepiece":
            assert docs.columns == corpus_pipeline.COLUMNS
    texts = lambda name: sorted(((r.doc_id, r.text) for r in got[name]), key=str)

    trusted = {i for i, q, x in labels if q == 1 and x == 0 and i is not None}
    keep = collections.Counter(x[0] for x in test_rules.brute(rows, trusted) if x[7])
    now = [r for r in rows if keep[r[0]]]
    assert texts("quality_rules") == sorted(now, key=str)
    assert {700, 703, 704} <= {i for i, _ in now} and not {710, 711, 712, 713} & {i for i, _ in now}

    prints = [test_simhash.fingerprint(t) for _, t in now]
    group = components(now, lambda i: [j for j in range(len(now)) if bin(prints[i] ^ prints[j]).count("1") <= 2])
    first = {}
    for (i, _), g in zip(now, group):
        if i is not None:
            first[g] = min(i, first.get(g, i))
    now = [r for r, g in zip(now, group) if r[0] is None or first.get(g) == r[0]]
    assert texts("simhash_near_dedup") == sorted(now, key=str)
    assert 701 not in {i for i, _ in now} and [i for i, _ in now].count(705) == 2

    now = cut(now)
    assert texts("substring_dedup") == sorted(now, key=str)
    assert all(r.n_chars == len(r.text) for r in got["substring_dedup"])
    assert PASSAGE in dict(now)[703] and "shared30" not in dict(now)[704]

    kept = {r.doc_id for r in got["mixing"]}
    assert set(texts("mixing")) <= set(now)
    for i, _ in now:  # labelled rows show whose words the mixture does without
        if i in kind:
            assert (i in kept) == (kind[i] == 0), i

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    want = sorted(((r.doc_id, library.encode(r.text)) for r in got["mixing"]), key=str)
    assert sorted(((r.doc_id, r.ids) for r in got["sentencepiece"]), key=str) == want
    again = corpus_pipeline.run(spark, root).collect()
    assert sorted(((r.doc_id, r.ids) for r in again), key=str) == want


def test_registered_names():
    numbers = {int(n[2:].split("_")[0]) for n in entry.queries() if re.match(r"op\d+_", n)}
    assert numbers == set(range(1, 14)) and "pipeline" in entry.queries()
