from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from helpers import ODD_TEXTS, by_id, docs, prose
from runway.llm import bpe, packing

TEXTS = ODD_TEXTS + [
    "  a  b ", "x\n\n y<|endoftext|>z <|endoftext|>", "<|endoftext|>", "don't we'll  \t x", "日本語 １２③ ½", " lead", "trail ",
    "a\n b c", "b \n c", " x   y", "é combining", "🙂🙃 emoji", "The END. It's 'quoted' 12,345.67", "a" * 300 + " b"]


@pytest.fixture(scope="module")
def known():
    return Tokenizer.from_file(bpe.default_tokenizer())


def test_same_ids_and_text_as_the_library(spark, known):
    got = by_id(bpe.encode_decode(docs(spark, TEXTS), with_ids=True))
    for i, t in enumerate(TEXTS):
        want = known.encode(t or "", add_special_tokens=False).ids
        r = got[i]
        assert r["ids"] == want and r["n_tokens"] == len(want), t
        assert r["ids_sha256"] == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        text = known.decode(want, skip_special_tokens=False)
        assert r["decoded"] == text and r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_tables_start_anew_when_full(monkeypatch, known):
    monkeypatch.setattr(bpe, "TABLE_BYTES", 10_000)
    coder = bpe.ByteBPE(bpe.default_tokenizer())
    texts = [prose(i, 60) for i in range(12)]
    for part in (texts[:4], texts[4:8], texts[2:]):
        for t, ids in zip(part, coder.encode_many(part)):
            assert np.frombuffer(ids, "<u4").tolist() == known.encode(t, add_special_tokens=False).ids


def test_undecodable_ids_become_replacement_characters(known):
    coder = bpe.bpe(bpe.default_tokenizer())
    ids = known.encode("é🙂", add_special_tokens=False).ids[:-1]
    assert coder.decode(np.array(ids, "<u4").tobytes()) == known.decode(ids, skip_special_tokens=False)


def test_codec_nulls_repeats_extra_columns_empty(spark):
    df = docs(spark, [(None, "a b"), (1, "a b"), (1, "a b"), (2, None)]).selectExpr("*", "5 AS n_tokens", "6 AS ids")
    rows = bpe.encode_decode(df).collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in rows) == [("1", 2), ("1", 2), ("2", 0), ("None", 2)]
    assert bpe.encode_decode(docs(spark, [])).count() == 0


def test_rank_encoder_gives_the_ids_of_the_library(known):
    coder = packing.ids_by(bpe.default_tokenizer())
    draw = random.Random(5)
    pools = ["etaoinshrdlu", "abcdefghijklmnopqrstuvwxyz ", "ABCab 019.,'-\n\t", "éüßñçøåäöœ", "абвгдежз ий", "日本語中文字。 ", "🙂🙃\u200d❤️ "]
    texts = ["".join(draw.choices(draw.choice(pools), k=draw.randint(1, 40))) for _ in range(20_000)]
    texts += [t or "" for t in TEXTS] + [prose(i, 300) for i in range(40)]
    texts += ["x" * 5000 + " y", "a" + " " * 3000 + "b", "\n" * 1500, "語" * 1200, "no end" * 400]
    assert any(map(coder.odd, texts)) and not all(map(coder.odd, texts))
    for t, e in zip(texts, known.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(coder.packed(t), "<u4").tolist() == e.ids, t


def check_packing(rows, capacity):
    seqs = {}
    for r in rows:
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return len(seqs)


def test_packing(spark, known):
    texts = TEXTS + [prose(i, 10 + 37 * i % 400) for i in range(150)]
    rows = packing.pack(docs(spark, texts).repartition(5)).collect()
    own = {}
    for r in rows:
        own.setdefault(r["doc_id"], []).append(r)
    for i, t in enumerate(texts):
        ids = known.encode(t or "", add_special_tokens=False).ids + [packing.END_ID]
        pieces = sorted(own[i], key=lambda r: r["piece"])
        at = 0
        for k, r in enumerate(pieces):
            assert (r["piece"], r["start"]) == (k, at)
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[at:at + r["length"]], "<u4").tobytes())
            if len(ids) > 1024:
                assert r["length"] == 1024 or k == 0
            at += r["length"]
        assert at == len(ids) and (len(ids) > 1024 or len(pieces) == 1)
    total = sum(r["length"] for r in rows)
    assert check_packing(rows, 1024) <= -(-total // 1024) * 1.03 + 1


@pytest.mark.parametrize("lengths", [[600] * 100 + [300] * 50 + [5] * 20, [400] * 100, [1] * 3000, [1023, 1, 1024], [], [512] * 7])
def test_plan_places_every_length_once(lengths):
    histogram = {n: lengths.count(n) for n in set(lengths)}
    load, ranks = {}, {}
    for length, rank, count, seq, offset in packing.plan(histogram):
        ranks.setdefault(length, []).append((rank, count))
        for i in range(count):
            load.setdefault(seq + i, []).append((offset, length))
    rows = [{"sequence_id": s, "offset": o, "length": n} for s, v in load.items() for o, n in v]
    check_packing(rows, 1024)
    for n, c in histogram.items():
        at = 0
        for rank, count in sorted(ranks[n]):
            assert rank == at
            at += count
        assert at == c


def test_packing_nulls_repeats_extra_columns_empty(spark):
    df = docs(spark, [(None, None), (1, "a"), (1, "a")]).selectExpr("*", "1 AS part", "2 AS length", "3 AS offset")
    rows = packing.pack(df).collect()
    assert sorted((str(r["doc_id"]), r["length"]) for r in rows) == [("1", 2), ("1", 2), ("None", 1)]
    assert check_packing(rows, 1024) == 1
    assert packing.pack(docs(spark, [])).count() == 0
