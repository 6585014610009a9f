"""Small tables and plain Python versions of what several tests need."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
PASSAGE = " ".join(f"shared{i}" for i in range(60))


def words(text):
    return WORD.findall(text or "")


def edge_rows():
    """doc_id, text: nulls, empty and very long texts, ties, copies, shared passages, odd white space, repeated rows."""
    say = random.Random(5)
    rows = [(i, " ".join(say.choice(["alpha", "beta", "gamma", "delta", "Omega.", "eta!", "théta"]) + str(say.randint(0, 40)) for _ in range(say.randint(0, 120)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, " \t\n\x0b\x0c\r "), (103, "one"), (104, "one two"), (105, " non breaking\x1cstays one"), (106, LONG), (107, LONG + " end")]
    rows += [(110, PASSAGE), (111, PASSAGE), (112, f"before it\n{PASSAGE}\nafter it"), (113, f"{PASSAGE} {PASSAGE}"), (114, PASSAGE.replace(" ", "\n"))]
    rows += [(None, PASSAGE), (None, None), (111, PASSAGE), (120, "same " * 200), (121, "same " * 200), (122, "日本語 ▁ mark 😀 " * 9)]
    return rows


def frame(spark, rows, extra=True):
    """A documents table; ``extra`` adds columns whose names operators use inside."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    if extra:
        df = df.selectExpr("doc_id", "text", "'en' as lang", "concat('src', coalesce(doc_id, 0) % 3) as source", "cast(length(text) as bigint) as n_chars", "1 as positions", "2 as score", "'x' as fp", "0 as kept", "3 as seed", "4 as n_words", "5 as p")
    return df.repartition(3)


def components(ids, near):
    """Least reachable id by position; ``near(i)`` gives the positions linked to i."""
    label = list(range(len(ids)))

    def root(i):
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    for i in range(len(ids)):
        for j in near(i):
            a, b = root(i), root(j)
            label[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(ids))]
