import gc
import itertools
import random

import pyarrow as pa
import pytest
import sentencepiece

from coursemill.llm.pieces import MARK, MODEL, UNIGRAM, Pieces, _encoded, decode, encode, pieces
from coursemill.llm.simhash import _prints
from tests.llm.helpers import edge_rows, frame

library = sentencepiece.SentencePieceProcessor(model_file=MODEL)


def texts():
    say = random.Random(2)
    letters = "aaabcdeothe   \n\t▁éß日本语😀.,!<s>0123"
    out = ["".join(say.choice(letters) for _ in range(say.randint(0, 40))) for _ in range(4000)]
    return out + [" " * k + "a" + " " * (2 * k) for k in range(40)] + [c * k for c in "ae0=-*#/" for k in range(40)] + [t or "" for _, t in edge_rows()]


def test_ids_and_texts_equal_the_librarys():
    model = pieces(MODEL)
    for t in texts():
        ids = library.encode(t)
        assert model.encode(t) == ids, t
        assert model.decode(ids) == library.decode(ids), t


def _message(*fields):
    def size(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    return b"".join(size(f << 3 | 2) + size(len(v)) + v if isinstance(v, bytes) else size(f << 3) + size(v) for f, v in fields)


def test_unigram_path_is_the_best_of_all():
    import struct

    say = random.Random(4)
    own = {"a", "b", "c", MARK}
    while len(own) < 40:
        own.add(say.choice(["", MARK]) + "".join(say.choice("abc") for _ in range(say.randint(1, 4))))
    score = {p: -say.random() * 9 - 1 for p in sorted(own)}
    parts = [_message((1, b"<unk>"), (3, 2))] + [_message((1, p.encode())) + b"\x15" + struct.pack("<f", s) for p, s in score.items()]
    model = Pieces(_message(*[(1, p) for p in parts], (2, _message((3, UNIGRAM))), (3, _message((3, 1), (4, 0)))))
    for _ in range(150):
        text = "".join(say.choice("abc ") for _ in range(say.randint(1, 9)))
        whole = MARK + text.replace(" ", MARK)
        best = -1e9
        for cuts in itertools.product([0, 1], repeat=len(whole) - 1):
            at = [0, *[k + 1 for k, c in enumerate(cuts) if c], len(whole)]
            ways = [whole[x:y] for x, y in zip(at, at[1:])]
            if all(p in score for p in ways):
                best = max(best, sum(score[p] for p in ways))
        ids = model.encode(text)
        assert "".join(model.text[i] for i in ids) == whole
        assert sum(model.score[i] for i in ids) == pytest.approx(best, abs=1e-4)


def test_over_a_table(spark):
    rows = edge_rows()
    out = encode(frame(spark, rows), ["doc_id", "source"])
    got = sorted(((r.doc_id, r.n_tokens, r.ids) for r in out.collect()), key=str)
    assert got == sorted(((i, len(library.encode(t or "")), library.encode(t or "")) for i, t in rows), key=str)
    back = sorted(((r.doc_id, r.text) for r in decode(out).collect()), key=str)
    assert back == sorted(((i, library.decode(library.encode(t or ""))) for i, t in rows), key=str)
    assert encode(frame(spark, rows).limit(0), ["doc_id"]).count() == 0


def test_a_worker_forgets_the_model_when_another_operator_begins():
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["some words here", None]})
    encoded = lambda: [r.to_pylist() for r in _encoded(MODEL, ["doc_id"])(iter([batch]))]
    first = encoded()
    model = pieces(MODEL)
    assert encoded() == first and pieces(MODEL) is model  # the same operator's tasks share it
    list(_prints(iter([batch])))
    assert pieces.cache_info().currsize == 0
    assert encoded() == first


def test_what_is_remembered_is_not_walked_by_the_garbage_collector():
    model = pieces(MODEL)
    model.encode("words that are remembered for later texts, as they come again")
    gc.collect()
    assert model.recent and model.joined
    assert not any(gc.is_tracked(x) for t in (model.recent, model.joined) for pair in t.items() for x in pair)
