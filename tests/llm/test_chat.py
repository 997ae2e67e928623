"""Formatted conversations read back, with typed parts and hard texts."""

import hashlib
import random

import pytest

from govlake.llm import chat

HARD = ["", "\\", "\\\\", "### user: x", "a </turn>\n### assistant: b", "<|image:0|>", "####", "\\### Assistant: </turn> ok",
        "tail \\", " </turn>", "\n\n", "é🙂 "]


@pytest.mark.parametrize("text", HARD)
def test_escapes_come_back(text):
    assert chat.unescape(chat.escape(text)) == text
    line = f"### {chat.escape_role(text)}: {chat.escape(text)} </turn>\n"
    assert [(r, t) for r, t, _, _ in chat.parse(line * 2)] == [(text, text)] * 2


def test_random_escapes():
    rnd = random.Random(8)
    for _ in range(3000):
        text = "".join(rnd.choice(["\\", "#", "##", "</turn>", "<|", "|>", " ", "\n", ":", "x", "### "]) for _ in range(rnd.randint(0, 12)))
        line = f"### {chat.escape_role(text)}: {chat.escape(text)} </turn>\n"
        assert [(r, t) for r, t, _, _ in chat.parse(line + line)] == [(text, text)] * 2


def test_read_back(spark, monkeypatch):
    rnd = random.Random(1)
    rows = [(c, t, rnd.choice(["user", "assistant", None, "tool:x\n"]), rnd.choice([*HARD, None, "plain text"]))
            for c in [1, 2, 3, None] for t in range(rnd.randint(1, 9))]
    rows += [(2, 0, "user", "again"), (2, 0, "user", "again"), (5, None, "assistant", "only")]
    rows += [(6, t, "assistant", "long " * 300) for t in range(40)]
    rnd.shuffle(rows)
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, piece int")
    got = {r.conv_id: r for r in chat.read_back(chat.format_turns(df)).collect()}
    assert set(got) == {r[0] for r in rows}
    for conv, r in got.items():
        mine = sorted(((t is not None, t or 0, role or "", text or "") for c, t, role, text in rows if c == conv))
        whole = "".join(f"{role}\n{text}\n" for *_, role, text in mine)
        loss = "".join(text for *_, role, text in mine if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(mine), hashlib.sha256(whole.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r.formatted_chars > len(whole)


def test_long_conversations_go_on_in_further_rows(spark):
    text = "x" * 900_000
    df = spark.createDataFrame([(1, t, "assistant", text) for t in range(6)], "conv_id long, turn long, role string, text string")
    made = chat.format_turns(df)
    pieces = sorted((r.piece, len(r.formatted)) for r in made.select("piece", "formatted").collect())
    assert len(pieces) == 2 and all(n < chat.ROW + 1_000_000 for _, n in pieces)
    r = chat.read_back(made).collect()[0]
    assert (r.n_turns, r.loss_chars) == (6, 5_400_000)


def test_parts(spark):
    parts = [("text", "see <|image:0|> ", None, None, None, None, None), ("image", None, "s3://i", 28, 15, None, None),
             ("audio", None, "a.wav", None, None, 2.0, None), ("document", None, "d.pdf", None, None, None, 3),
             ("video", None, "v", None, None, None, None), (None, "end", None, None, None, None, None)]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None), (1, 2, "user", [parts[1]])],
                               f"conv_id long, turn long, role string, parts {chat.PARTS}")
    r = chat.format_turns(df).collect()[0]
    assert r.formatted.startswith("### user: see \\<|image:0|> <|image:0|><|audio:1|><|document:2|><|other:3|>end </turn>\n")
    assert [(a.number, a.kind, a.uri, a.tokens) for a in r.attachments] == [
        (0, "image", "s3://i", 4), (1, "audio", "a.wav", 50), (2, "document", "d.pdf", 1800), (3, "other", "v", 1), (4, "image", "s3://i", 4)]


def test_no_rows(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_turns(none)).collect() == []


def test_stored_pieces_are_read_back_in_any_partitions(spark, tmp_path):
    """A conversation of several rows, written and read into several partitions, is one conversation."""
    rows = [(c, t, "assistant", f"{t} " + "x" * 400_000) for c in (1, 2) for t in range(20)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat.format_turns(df)
    want = {r.conv_id: r for r in chat.read_back(made).collect()}
    made.repartition(7).write.parquet(str(tmp_path / "stored"))
    stored = spark.read.parquet(str(tmp_path / "stored"))
    assert stored.count() > 4
    assert {r.conv_id: r for r in chat.read_back(stored).collect()} == want
    assert want[1].n_turns == 20 and len(want) == 2
