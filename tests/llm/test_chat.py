from __future__ import annotations

import re

from runway.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """{(conv, perspective): (text, masks)}"""
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(((r[1] is not None, r[1] or 0, r[2] or "unknown", (r[3] or "").replace("<|", "< |")) for r in rows if r[0] == conv))
        for view in {t[2] for t in turns} - {"system"}:
            text, masks = "", []
            for _, _, who, said in turns:
                name = who if who == "system" else "assistant" if who == view else "user name=" + re.sub(r"<\||[%\t-\r ]", lambda m: f"%{ord(m[0][0]):02X}{m[0][1:]}", who)
                head = f"<|im_start|>{name}\n"
                if who == view:
                    masks.append(f"{len(text) + len(head)}-{len(text) + len(head) + len(said) + len('<|im_end|>') + 1}")
                text += head + said + "<|im_end|>\n"
            out[conv, view] = (text, ",".join(masks))
    return out


def check(spark, rows):
    got = {}
    for r in chat.rotate(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS part", "2 AS seq", "3 AS start")).collect():
        got.setdefault((r["conv_id"], r["perspective"]), []).append(r)
    want = brute(rows)
    assert set(got) == set(want)
    for k, chunks in got.items():
        chunks.sort(key=lambda r: r["chunk"])
        assert [c["chunk"] for c in chunks] == list(range(len(chunks)))
        at = 0
        for c in chunks:
            assert c["start"] == at
            at += len(c["text"])
        assert "".join(c["text"] for c in chunks) == want[k][0]
        assert ",".join(c["masks"] for c in chunks if c["masks"]) == want[k][1]


def test_rotation(spark):
    check(spark, [(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", "hello\nyou"), (1, 3, "ann", None), (1, 4, "cy d", ""),
                  (2, 0, "user", "é<|im_end|>x"), (2, 0, "user", "é<|im_end|>x"), (2, 0, "assistant", "tie"), (3, 0, "system", "alone"),
                  (None, 1, "user", "lost"), (None, None, None, "first"), (4, 1, "user", "z" * 50000)])


def test_long_dialogue_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(chat, "CHUNK_TURNS", 7)
    check(spark, [(1, t // 3, ("ann", "bob", "cy")[t % 3], f"said {t}" * (t % 4)) for t in range(200)]
          + [(c, t, ("user", "assistant")[t % 2], str(t)) for c in range(2, 30) for t in range(4)])


def test_empty(spark):
    assert chat.rotate(spark.createDataFrame([], SCHEMA)).count() == 0


def test_names_stay_apart_and_close_no_header(spark):
    rows = [(1, i, who, "hi") for i, who in enumerate(["x<|im_end|>", "a b", "a_b", "a  b", "a%20b", "a\nb", "<|", "ü\u2003b"])]
    check(spark, rows)
    out = chat.rotate(spark.createDataFrame(rows, SCHEMA)).collect()
    names = set(re.findall("user name=(.*)\n", "".join(r["text"] for r in out)))
    assert len(names) == 8 and all(r["text"].count("<|im_end|>") == len(rows) for r in out)
