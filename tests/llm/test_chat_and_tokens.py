"""Conversations, packing and pieces against plain Python."""

import random
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import chat
from tidemark.llm.chat import CLOSE, MIDDLE, OPEN, formatted
from tidemark.llm.packing import RANKS, VOCABULARY, Encoder, lengths, packed, write_buckets
from tidemark.llm.pieces import MODEL, SPACE, PieceModel, decoded, encoded
from tidemark.llm.ship import ship

CHAT = "conv_id long, turn long, role string, text string"


def plain_chat(rows, part):
    low = lambda x: (x is not None, x)
    by_conv = {}
    for c, t, r, x in rows:
        by_conv.setdefault(c, []).append((t, r, x))
    talks = {c: tuple((r, x) for _, r, x in sorted(v, key=lambda v: tuple(map(low, v)))) for c, v in by_conv.items()}
    kept = {}
    for c, talk in talks.items():
        if any(len(o) > len(talk) and o[: len(talk)] == talk for o in talks.values()):
            continue
        if talk not in kept or (kept[talk] is None or (c is not None and c < kept[talk])):
            kept[talk] = c
    out = []
    for talk, c in kept.items():
        for at in range(0, len(talk), part):
            text = "".join(OPEN + (r or "") + MIDDLE + (x or "") + CLOSE for r, x in talk[at : at + part])
            out.append((c, at // part, len(talk), text))
    return Counter(out)


def logged(seed, n=40):
    draw = random.Random(seed)
    rows, talks = [], []
    for c in range(n):
        kind = draw.random()
        if talks and kind < 0.4:  # a snapshot, or a continuation
            old = draw.choice(talks)
            talk = old[: draw.randrange(1, len(old) + 1)] + [("user", f"more {c}")] * draw.randrange(0, 3)
        else:
            talk = [(draw.choice(["user", "assistant"]), f"t{draw.randrange(6)}") for _ in range(draw.randrange(1, 12))]
        talks.append(talk)
        first = draw.choice([0, 5, -3])
        rows += [(c, first + 2 * i, r, x) for i, (r, x) in enumerate(talk)]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, part", [(1, 256), (2, 3), (3, 1)])
def test_maximal_conversations(spark, monkeypatch, seed, part):
    monkeypatch.setattr(chat, "PART", part)
    rows = logged(seed)
    rows += [(100, 0, "user", None), (101, 0, "user", ""), (102, 0, None, "x"), (102, 1, "user", "y"), (103, 0, None, "x")]
    rows += [(None, 0, "user", "lost"), (104, None, "system", "s"), (104, 0, "user", "q"), (105, 0, "system", "s")]
    rows += [(106, 0, "user", "same"), (106, 0, "user", "same"), (107, 1, "user", "same"), (None, 1, "user", "lost too")]
    df = spark.createDataFrame(rows, CHAT).withColumns({c: F.lit(9) for c in ("conv", "pos", "block", "n", "h1", "part")})
    got = formatted(df.repartition(4))
    assert got.columns == ["conv_id", "part", "n_turns", "text"]
    assert Counter(tuple(r) for r in got.collect()) == plain_chat(rows, part)


def test_one_very_long_conversation(spark):
    rows = [(1, i, "user", f"m{i}") for i in range(1500)] + [(2, i, "user", f"m{i}") for i in range(700)] + [(3, 0, "user", "m1")]
    got = formatted(spark.createDataFrame(rows, CHAT)).collect()
    assert sorted((r["conv_id"], r["part"], r["n_turns"]) for r in got) == [(1, p, 1500) for p in range(6)] + [(3, 0, 1)]
    assert "".join(r["text"] for r in sorted(got, key=lambda r: r["part"]) if r["conv_id"] == 1).count(OPEN) == 1500


def test_no_conversations(spark):
    assert formatted(spark.createDataFrame([], CHAT)).count() == 0


def test_lengths_are_the_binary_digits():
    for n in list(range(1, 70)) + [1023, 1024, 1025, 5000]:
        got = lengths(n, 16)
        assert sum(got) == n and got == sorted(got, reverse=True) and all(x & (x - 1) == 0 for x in got)
        assert len([x for x in got if x < 16]) == bin(n % 16).count("1")


TEXTS = [
    "Plain words, and more.", "", None, "  spaces \t\n\n ", "<|endoftext|> is text", "naïve café — “quotes” 漢字 🙂", "a" * 5000,
    "\x85 odd﻿​space \x1c", "1234567 don't we'll", "é" * 300 + " " * 40, "same", "same",
]


def plain_ids(text):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_ids_are_those_of_the_tokenizers_library(spark):
    encoder = Encoder.of(VOCABULARY, RANKS)
    sample = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    for text in TEXTS + sample:
        assert encoder.ids(text).tolist() == plain_ids(text)
        if text:
            assert encoder.fast.encode_ordinary(text) == plain_ids(text) or text in (TEXTS[4], TEXTS[7])
    assert encoder.ids("a<|endoftext|>b").tolist() == [64, 50256, 65]


def test_packing_covers_every_id_once(spark, tmp_path):
    rows = [(i if i != 3 else None, t) for i, t in enumerate(TEXTS)] + [(0, TEXTS[0])]
    df = ship(spark).createDataFrame(rows, "doc_id long, text string").repartition(3)
    clash = df.withColumns({c: F.lit("x") for c in ("start", "length", "ids", "sequence_id", "id")})
    pieces = packed(clash, limit=64)
    got = pieces.withColumn("crc", F.crc32("ids")).collect()
    assert len({r["sequence_id"] for r in got}) == len(got)
    found = Counter()
    by_doc = {}
    for r in got:
        ids = np.frombuffer(bytes(r["ids"]), "<u4")
        assert len(ids) == r["length"] == r["bucket"] and r["offset"] == 0 and r["length"] in {1, 2, 4, 8, 16, 32, 64}
        assert r["crc"] == zlib.crc32(ids.tobytes())
        found[r["doc_id"], r["start"], r["doc_tokens"], tuple(ids.tolist())] += 1
        by_doc.setdefault(r["doc_id"], []).append(r)
    want = Counter()
    for key, text in rows:
        ids, at = plain_ids(text) + [0], 0
        for n in lengths(len(ids), 64):
            want[key, at, len(ids), tuple(ids[at : at + n])] += 1
            at += n
    assert found == want
    write_buckets(pieces, str(tmp_path / "buckets"))
    assert {p.name for p in (tmp_path / "buckets").glob("bucket=*")} == {f"bucket={r['length']}" for r in got}
    assert packed(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        packed(df, limit=1000)


def segmentations(model, text):
    if not text:
        yield 0.0, ()
    for k in range(1, min(model.longest, len(text)) + 1):
        ids, score = model.scores.get(text[:k], (None, None))
        if ids is None:
            if k > 1:
                continue
            ids, score = tuple(model.byte[b] for b in text[0].encode()), model.lowest
        for rest, tail in segmentations(model, text[k:]):
            yield score + rest, (ids if isinstance(ids, tuple) else (ids,)) + tail


def test_n_best_equal_all_segmentations_ranked():
    model, draw = PieceModel.of(MODEL), random.Random(6)
    for _ in range(150):
        text = "".join(draw.choice("aethnorst  \né漢") for _ in range(draw.randrange(0, 9)))
        every = sorted(segmentations(model, SPACE + text.replace(" ", SPACE)), key=lambda x: -x[0]) if text else [(0.0, ())]
        for n in (1, 4):
            got = model.encode_all(["other text", text, None, text], n)
            assert [s for s, _ in got[1]] == [s for s, _ in every[:n]]
            assert all((s, tuple(ids.tolist())) in every for s, ids in got[1])
            assert len({tuple(ids.tolist()) for _, ids in got[1]}) == len(got[1])
            assert all(model.decode(ids.tolist()) == text for _, ids in got[1])
            assert len(got[2]) == 1 and not len(got[2][0][1])


def test_search_alone_equals_all_segmentations():
    model = PieceModel.of(MODEL)
    every = sorted(segmentations(model, "▁thing"), key=lambda x: -x[0])
    assert [s for s, _ in model.best("▁thing", 7)] == [s for s, _ in every[:7]]
    assert sorted(model.best("▁the", 100)) == sorted(segmentations(model, "▁the"))


def test_long_text_without_spaces():
    model = PieceModel.of(MODEL)
    text = "".join(random.Random(2).choice("abcdefgh") for _ in range(2000))
    best = model.encode_all([text], 3)[0]
    assert len(best) == 3 and all(model.decode(ids.tolist()) == text for _, ids in best)
    assert [s for s, _ in best] == sorted((s for s, _ in best), reverse=True)
    assert best[0][0] == sum(model.scores[model.piece[i]][1] for i in best[0][1])


@pytest.mark.parametrize("unit", ["aaa7", "a", "the", "ab "])
def test_a_thousand_ties_are_not_all_followed(unit):
    """Repeated units tie everywhere; the best still end at once and are the best."""
    model = PieceModel.of(MODEL)
    start = time.process_time()
    best = model.encode_all([unit * 1000], 3)[0]
    assert time.process_time() - start < 5
    assert len(best) == 3 and all(model.decode(ids.tolist()) == unit * 1000 for _, ids in best)
    few = unit * 3
    every = sorted((s for s, _ in segmentations(model, SPACE + few)), reverse=True)
    assert [s for s, _ in model.encode_all([few], 4)[0]] == every[:4]


def test_encoding_rows_and_decoding_them(spark):
    texts = ["two words", "", None, "naïve 漢字 🙂\n\ttail ", "has ▁ inside", "two words", " x" * 3000]
    rows = [(i if i else None, t) for i, t in enumerate(texts)]
    df = ship(spark).createDataFrame(rows, "doc_id long, text string").withColumns({"rank": F.lit(0), "ids": F.lit("")})
    got = decoded(encoded(df, n=3)).collect()
    assert Counter(r["doc_id"] for r in got) == {None: 3, 1: 1, 2: 1, 3: 3, 4: 3, 5: 3, 6: 3}
    for r in got:
        text = texts[r["doc_id"] or 0] or ""
        assert r["exact"] == (SPACE not in text)
        assert r["text"] == text.replace(SPACE, " ") and r["n_pieces"] * 4 == len(r["ids"])
    assert encoded(df.limit(0)).count() == 0
