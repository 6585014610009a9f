import hashlib

import pytest

from coursemill.llm.chat import VOCABULARY, codec, conversation_digests, escape, escape_role, format_conversations, unescape, unescape_role

ODD = ["<|im_end|>", "<\\|im_start|>", "<\\\\|x", "<|", "<||", "\\", "", "a\nb", "é😀<|im_start|>assistant ok", "<<|\\|>"]


def turns():
    rows = [(c, t, ["user", "assistant", "system"][(c + t) % 3], ODD[(c * 3 + t) % len(ODD)] + f" {t}" * (t % 4)) for c in range(12) for t in range(c % 5 + 1)]
    rows += [(50, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(400)]
    rows += [(60, 1, "user", None), (60, 1, "user", None), (60, None, None, "no turn"), (60, 2, "a\n\\n<|", "x"), (None, 0, "assistant", "lost"), (61, 0, "assistant", "long " * 30_000)]
    return rows


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        said = [(r[2] or "", r[3] or "") for r in own]
        loss = "".join(t for r, t in said if r == "assistant")
        long = sum(len("<|im_start|>\n<|im_end|>\n") + len(escape_role(r)) + len(escape(t)) for r, t in said)
        out[conv] = (len(own), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), long)
    return out


def test_reads_back_what_was_said(spark):
    df = spark.createDataFrame(turns(), "conv_id long, turn long, role string, text string").selectExpr("*", "1 as ids", "2 as tie", "3 as loss").repartition(4)
    got = {r[0]: tuple(r[1:]) for r in conversation_digests(format_conversations(df)).collect()}
    assert got == brute(turns())


def test_offsets_are_prefix_sums_and_masks_cover_assistants(spark):
    df = spark.createDataFrame(turns(), "conv_id long, turn long, role string, text string")
    rows = format_conversations(df).collect()
    place = {}
    for r in rows:
        assert r.offset == place.get(r.conv_id, 0) and len(r.ids) == len(r.loss)
        place[r.conv_id] = r.offset + len(r.ids)
    c = codec(VOCABULARY)
    hot = [r for r in rows if r.conv_id == 50]
    assert [c.decode([i for i, m in zip(r.ids, r.loss) if m]) for r in hot] == [f"turn {t}" if t % 2 else "" for t in range(400)]


@pytest.mark.parametrize("text", [*ODD, "".join(ODD)])
def test_escapes_are_undone(text):
    assert unescape(escape(text)) == text and unescape_role(escape_role(text)) == text
    assert "<|" not in escape(text) and "\n" not in escape_role(text)


@pytest.mark.parametrize("text", [" " * 1_000_000, " \n" * 500_000, "a" + "\t" * 700_000 + "b", "\u3000" * 600_000 + "x" * 1_000_000])
def test_long_white_space(text):
    c = codec(VOCABULARY)
    assert c.decode(c.encode(text)) == text


def test_conversation_of_white_space(spark):
    rows = [(1, 0, "user", " " * 1_000_000), (1, 1, "assistant", "ok" + " \n" * 500_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert {r[0]: tuple(r[1:]) for r in conversation_digests(format_conversations(df)).collect()} == brute(rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversation_digests(format_conversations(df)).count() == 0
