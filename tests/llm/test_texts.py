"""Words, components, near copies and repeated passages against plain Python."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.llm import near_copies, repeats
from tidemark.llm.graph import components
from tidemark.llm.near_copies import forest, near_copy_groups, shingle_sets, similar
from tidemark.llm.ship import ship
from tidemark.llm.superminhash import signatures
from tidemark.llm.words import BASES, Batch, pack_sorted, rolling, unpack_sorted, words_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_words(text, lower=False):
    text = text or ""
    if lower:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return WORD.findall(text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8"), max_size=40), st.booleans())
def test_words_are_runs_without_the_six_white_characters(text, lower):
    assert [w.decode() for w in words_of(text, lower)] == plain_words(text, lower)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=40), st.integers(1, 20))
def test_rolling_hash_equals_horner(values, width):
    want = []
    for i in range(len(values) - width + 1):
        h = 0
        for v in values[i : i + width]:
            h = (h * BASES[0] + v) % 2**64
        want.append(h)
    assert rolling(np.array(values, np.uint64), width, BASES[0]).tolist() == want


def test_packed_keys_come_back():
    keys = np.sort(np.random.default_rng(1).integers(0, 2**63, 500).astype(np.uint64))
    assert (unpack_sorted(pack_sorted(keys)) == keys).all()
    assert len(unpack_sorted(pack_sorted(keys[:0]))) == 0


def test_runs_stay_in_one_text():
    batch = Batch(["a b c", None, "d e", ""])
    assert batch.starts.tolist() == [0, 3, 3, 5, 5]
    assert batch.whole_runs(2).tolist() == [0, 1, 3]


def test_signatures_estimate_similarity_with_less_spread_than_independent_slots():
    draw = np.random.default_rng(4)
    wrong = []
    for _ in range(60):
        values = draw.integers(0, 2**63, 150).astype(np.uint64)
        a, b = np.sort(values[:100]), np.sort(values[50:])  # similarity 1/3
        s = signatures([a, b], 240)
        wrong.append((s[0] == s[1]).mean() - 1 / 3)
    assert abs(np.mean(wrong)) < 0.02
    assert np.std(wrong) < (1 / 3 * 2 / 3 / 240) ** 0.5


def test_signatures_of_tiny_and_empty_sets():
    s = signatures([np.array([7], np.uint64), np.array([], np.uint64), np.array([7], np.uint64)], 16)
    assert (s[0] == s[2]).all() and (s[1] == np.iinfo(np.uint64).max).all()
    assert sorted(s[0] >> np.uint64(32)) == list(range(16))


def test_components(spark):
    draw = random.Random(3)
    pairs = [(draw.randrange(300), draw.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 460)]
    pairs += [(5, 5), (None, 3), (3, None), pairs[0]]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in got} == {x: find(x) for x in parent}
    assert len(got) == len(parent)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_similar_is_exact_in_blocks():
    draw = random.Random(8)
    base = [draw.randrange(1000) for _ in range(40)]
    sets = [np.unique(np.array([x if draw.random() > 0.08 else draw.randrange(5000) for x in base], np.uint64)) for _ in range(30)]
    want = np.array([[100 * len(set(a) & set(b)) >= 80 * len(set(a) | set(b)) for b in sets] for a in sets])
    np.fill_diagonal(want, False)
    assert (similar(sets, 80, width=7) == want).all()
    got = similar(sets, 80, left=11, width=9)
    want[:11, :11] = want[11:, 11:] = False
    assert (got == want).all()


def test_forest_spans_components():
    linked = np.zeros((6, 6), bool)
    for a, b in ((0, 2), (2, 4), (1, 5)):
        linked[a, b] = linked[b, a] = True
    assert [(a, sorted(b)) for a, b in forest(linked)] == [(0, [2, 4]), (1, [5])]


def texts_with_copies(seed=1, n=120):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" if i % 3 else f"W{i}" for i in range(400)]
    texts = []
    for _ in range(n):
        kind = draw.random()
        if texts and kind < 0.2:
            texts.append(draw.choice(texts))
        elif texts and kind < 0.55:
            words = draw.choice(texts).split(" ")
            for _ in range(draw.randrange(1, 5)):
                words[draw.randrange(len(words))] = draw.choice(vocabulary)
            texts.append(" ".join(words))
        else:
            texts.append(" ".join(draw.choice(vocabulary) for _ in range(draw.randrange(1, 90))))
    return texts + ["", "  \n", None, "one", "ONE", "a b c", "A  b\tc", "ſ K", " ſ k"]


def plain_groups(rows, width, percent):
    sets = []
    for _, text in rows:
        w = plain_words(text, True)
        sets.append({tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                parent[find(i)] = find(j)
    lowest = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            lowest[find(i)] = min(lowest.get(find(i), key), key)
    return Counter((key, len(s), lowest.get(find(i)) if s else key) for i, ((key, _), s) in enumerate(zip(rows, sets)))


@pytest.mark.parametrize("width, block", [(4, 1024), (5, 3)])
def test_near_copies_equal_brute_force(spark, monkeypatch, width, block):
    monkeypatch.setattr(near_copies, "BLOCK", block)
    texts = texts_with_copies(width)
    rows = [(1000 - i, t) for i, t in enumerate(texts)]
    rows += [rows[4], rows[4], (None, rows[5][1]), (None, "alone here"), (7, None)]
    docs = ship(spark).createDataFrame(rows, "doc_id long, text string").repartition(3)
    clash = docs.withColumns({c: F.lit(1) for c in ("id", "row", "class", "bands", "root", "group_id", "n_shingles", "task")})
    got = near_copy_groups(clash, width=width).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == plain_groups(rows, width, 80)


def test_near_copies_of_nothing(spark):
    docs = ship(spark).createDataFrame([], "doc_id long, text string")
    assert near_copy_groups(docs).count() == 0


def test_a_large_group_of_copies_and_near_copies(spark):
    base = [f"x{i}" for i in range(200)]
    rows = [(i, " ".join(base)) for i in range(300)]
    for i in range(300, 500):
        words = list(base)
        words[i % 190 + 5] = f"y{i}"
        rows.append((i, " ".join(words)))
    rows += [(900, " ".join(base[:100] + [f"z{i}" for i in range(100)]))]
    docs = ship(spark).createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_copy_groups(docs).collect()}
    assert got == {i: 0 for i in range(500)} | {900: 900}


def test_shingles_of_short_texts():
    sets = shingle_sets(["a b", "A b", "a", "", None, "a b c d e a b c d e"], 4)
    assert [len(s) for s in sets] == [1, 1, 1, 0, 0, 5]
    assert (sets[0] == sets[1]).all() and sets[0][0] != sets[2][0]


def plain_removal(texts, window):
    words = [plain_words(t) for t in texts]
    count = Counter(tuple(w[k : k + window]) for w in words for k in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if count[tuple(w[k : k + window])] > 1:
                gone[k : k + window] = [True] * window
        kept = " ".join(x for x, y in zip(w, gone) if not y)
        out.append((len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def test_repeated_windows_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BUCKET_BYTES", 2000)
    draw = random.Random(5)
    passage = [" ".join(draw.choice("abcdefgh") + str(draw.randrange(40)) for _ in range(n)) for n in (12, 7, 30)]
    texts = []
    for _ in range(60):
        parts = [" ".join(f"q{draw.randrange(3000)}" for _ in range(draw.randrange(0, 30))) for _ in range(3)]
        parts.insert(draw.randrange(3), draw.choice([*passage, "", passage[2][:50], "la " * draw.randrange(20)]))
        texts.append(draw.choice([" ", "\n", "\t "]).join(parts))
    texts += ["", None, "short", "é\x1c  " * 12, texts[3]]
    rows = list(enumerate(texts)) + [(0, texts[0])]
    docs = ship(spark).createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = repeats.digests(docs.withColumns({"spans": F.lit("x"), "n_words": F.lit(0)}), window=6).collect()
    want = plain_removal([t for _, t in rows], 6)
    assert Counter(tuple(r) for r in got) == Counter((rows[i][0], *w) for i, w in enumerate(want))


def test_other_columns_and_order_of_spans(spark):
    text = "p1 p2 p3 p4 x y p1 p2 p3 p4 z q1 q2 q3 q4 q1 q2 q3 q4"
    docs = ship(spark).createDataFrame([(1, text, {"k": 1})], "a int, body string, m map<string,int>")
    row = repeats.repeated_spans(docs, "body", 4).collect()[0]
    assert [(s["start"], s["stop"]) for s in row["spans"]] == [(0, 4), (6, 10), (11, 19)]
    assert row["m"] == {"k": 1} and row["n_words"] == 19
    assert repeats.repeated_spans(docs.limit(0), "body", 4).count() == 0


def test_cutting_keeps_the_rest_as_it_stands(spark):
    shared = "s1 s2 s3 s4 s5"
    rows = [(1, f"One  two\n{shared}\nthree   four", "k"), (2, f"{shared} end", "l"), (3, "clean  text\n", "m"), (4, shared, "n"), (5, None, "o")]
    docs = ship(spark).createDataFrame(rows, "doc_id long, text string, spans string")
    got = {r["doc_id"]: (r["text"], r["spans"]) for r in repeats.without_repeats(docs.drop("spans").withColumn("other", F.lit(1)).select("doc_id", "text", F.lit("z").alias("spans2")), "text", 5).withColumn("spans", F.lit("")).collect()}
    assert {k: v[0] for k, v in got.items()} == {1: "One  two\nthree   four", 2: "end", 3: "clean  text\n", 4: "", 5: None}
