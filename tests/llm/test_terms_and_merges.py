"""Source divergence, resampling and merge rounds against plain Python and the tokenizers library."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyarrow.parquet import ParquetFile
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer
from tokenizers.pre_tokenizers import Split

from tidemark.llm import divergence as terms
from tidemark.llm import resample
from tidemark.llm.divergence import divergence
from tidemark.llm.merges import UNSURE, VOCABULARY, MergeRules, decoded, encoded, rules_of
from tidemark.llm.resample import resampled
from tidemark.llm.ship import ship
from tidemark.session import written

DOCS = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(VOCABULARY))


ALPHABET = [
    "a", "b", " ", "  ", "\n", " \n", "\t", "'s", "'re", "é", "ü", "日本", "՘", "\x85", "\x1c", "​", "　",
    "\xa0", " ", "1", "23", "½", "<|endoftext|>", "<|endof", "😀", "᠎", "﻿", "!!", "the", "ing", "\x00",
    "A", "'", "ЖЖ", "́", " 0",
]


def mixed_texts(n):
    draw = random.Random(5)
    texts = ["".join(draw.choice(ALPHABET) for _ in range(draw.randrange(30))) for _ in range(n)]
    ranges = [(0x20, 0x7F), (0, 0xD800), (0xE000, 0x110000), (32, 33)]
    return texts + [
        "".join(chr(draw.randrange(*draw.choice(ranges))) for _ in range(draw.randrange(20))) for _ in range(n)
    ]


def test_ids_and_texts_are_those_of_the_library(library):
    texts, rules = mixed_texts(4000), rules_of(VOCABULARY)
    ids, counts = rules.encode(texts)
    rows = np.split(ids, np.cumsum(counts)[:-1])
    want = library.encode_batch(texts, add_special_tokens=False)
    assert [r.tolist() for r in rows] == [e.ids for e in want]
    assert rules.decode(ids.astype(np.int64), counts).to_pylist() == texts


@pytest.mark.parametrize("seed", [1, 2])
def test_decoding_any_ids(library, seed):
    draw = random.Random(seed)
    rows = [[draw.choice([draw.randrange(300), draw.randrange(60_000)]) for _ in range(draw.randrange(12))] for _ in range(500)]
    got = rules_of(VOCABULARY).decode(np.array(sum(rows, []), np.int64), np.array([len(r) for r in rows]))
    assert got.to_pylist() == [library.decode(r, skip_special_tokens=False) for r in rows]


@pytest.mark.parametrize("word", ["a" * 70_001, "ab" * 40_000 + "a", "aaab" * 3000, "é" * 5000, None])
def test_long_words(library, word):
    word = word or "".join(random.Random(3).choice("abcdefghijklmnopqrstuvwxyz") for _ in range(50_000))
    ids, _ = rules_of(VOCABULARY).encode([word])
    assert ids.tolist() == library.encode(word, add_special_tokens=False).ids


def test_rounds_and_ranks_merge_alike():
    rules, draw = rules_of(VOCABULARY), random.Random(9)
    words = ["".join(draw.choice("aabnt'he ") for _ in range(draw.randrange(1, 60))).encode() for _ in range(400)]
    sizes = np.array([len(w) for w in words])
    ids = rules.of_byte[np.frombuffer(b"".join(words), np.uint8)]
    for a, b in zip(rules._by_rounds(ids.copy(), sizes), rules._by_rank(ids.copy(), sizes)):
        assert a.tolist() == b.tolist()


def test_latin_classes_are_those_of_the_library(library):
    """Words are found by a pattern of our own below U+0250; all of its characters, beside each kind of neighbour."""
    rules = rules_of(VOCABULARY)
    for c in map(chr, range(0x250)):
        for text in (c, "a" + c, "1" + c, "." + c, c + "a", " " + c + " b", "x " + c):
            places = [piece for _, piece in library.pre_tokenizer.pre_tokenize_str(text)]
            assert rules.words(text) == [text[a:b] for a, b in places], repr(text)
    assert UNSURE.search("ɐ") and not UNSURE.search("ɏ")


def test_forgotten_words_give_the_same_ids(monkeypatch):
    texts = mixed_texts(300)
    whole, _ = rules_of(VOCABULARY).encode(texts)
    monkeypatch.setattr("tidemark.llm.merges.REMEMBERED", 50)
    rules = MergeRules(public_tokenizers.path(VOCABULARY))
    parts = [rules.encode(texts[at : at + 20])[0] for at in range(0, len(texts), 20)]
    assert np.concatenate(parts).tolist() == whole.tolist()


def test_encoded_and_decoded_tables(spark, library, monkeypatch):
    monkeypatch.setattr("tidemark.llm.merges.PORTION", 64)
    texts = ["plain words", "", None, "<|endoftext|> stands", "é" * 300, "same", "same", "x " * 400]
    rows = [(None if n == 3 else n % 5, t) for n, t in enumerate(texts)]
    df = ship(spark).createDataFrame(rows, "doc_id long, text string").repartition(3)
    clash = df.withColumns({c: F.lit("x") for c in ("id", "ids", "decoded")})
    got = decoded(encoded(clash))
    assert got.columns == ["doc_id", "ids", "decoded"]
    want = Counter(
        (i, tuple(library.encode(t or "", add_special_tokens=False).ids), t or "") for i, t in rows
    )
    assert Counter((r[0], tuple(r[1]), r[2]) for r in got.collect()) == want
    odd = spark.createDataFrame([(1, None), (2, [64, None, 65]), (3, []), (4, [70_000, 64])], "n int, ids array<bigint>")
    assert [r["decoded"] for r in decoded(odd).orderBy("n").collect()] == [None, "ab", "", "a"]
    assert encoded(df.limit(0)).count() == 0 and decoded(odd.limit(0)).count() == 0


def test_digests_of_all_documents(spark, library):
    from tidemark.llm.queries import op13_merge_round_bpe

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    want = {}
    for r in docs:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), back)]
        want[r["doc_id"]] = (len(ids), *digests)
    got = {r[0]: tuple(r[1:]) for r in op13_merge_round_bpe(spark, "/root/testdata/sf0.001").collect()}
    assert got == want


# -- resampling ------------------------------------------------------------------


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain_features(text):
    words = re.findall(resample.WORD, low(text))
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def test_hashes_of_words_and_pairs():
    splitter = Split(Regex(resample.WORD), "removed", invert=True)
    texts = ["", "héllo wörld, A1 [x]_`y{z日本", "ÀÉ \x00a\x00b", "x" * 1000 + " " + "y" * 500, " ", "one", "a  a a", "İI"]
    hashes, n_words, n_features = resample.feature_hashes(texts, splitter)
    want = [plain_features(t) for t in texts]
    assert n_words.tolist() == [len(w) for w, _ in want] and n_features.tolist() == [len(f) for _, f in want]
    assert hashes.tolist() == [zlib.crc32(x.encode()) for _, f in want for x in f]


def plain_resampled(docs, target, buckets, least, percent, seed):
    count = lambda texts: Counter(zlib.crc32(f.encode()) % buckets for t in texts for f in plain_features(t)[1])
    s, t = count([x for _, x in docs]), count(target)
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets))))
    out = []
    for i, text in docs:
        words, features = plain_features(text)
        weight = sum(gain(zlib.crc32(f.encode()) % buckets) for f in features) // len(features) if features else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        out.append((i, len(features), weight, score, len(words)))
    fit = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    ranks = {}
    for rank, r in enumerate(fit[: percent * len(fit) // 100], 1):
        ranks.setdefault(r, []).append(rank)
    return Counter((*r[:4], (ranks.get(r) or [None]).pop(0) if ranks.get(r) else None, r[4]) for r in out)


@pytest.mark.parametrize("buckets", [97, 10_000, 70_000])
def test_resampling(spark, monkeypatch, buckets):
    monkeypatch.setattr(resample, "PORTION", 300)
    draw = random.Random(buckets)
    words = ["tide", "mark", "Sea", "sea", "é", "日本", "x1", "-", "the", "of"]
    docs = [(n if n % 17 else None, " ".join(draw.choice(words) for _ in range(draw.randrange(40)))) for n in range(200)]
    docs += [(7, "tide mark " * 15)] * 30 + [(300, None), (301, ""), (302, "  ,,, ")]
    target = ["the sea of tide", None, "mark the sea " * 5]
    df = ship(spark).createDataFrame(docs, "doc_id long, text string").repartition(5)
    clash = df.withColumns({c: F.lit(0) for c in ("id", "row", "rank", "score", "part", "n_words", "buckets")})
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    got = resampled(clash, wanted, buckets=buckets, percent=40, seed=3)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank", "n_words"]
    assert Counter(map(tuple, got.collect())) == plain_resampled(docs, target, buckets, 20, 40, 3)


def test_resampling_without_documents_or_target(spark):
    none = ship(spark).createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b " * 20), (2, "c d " * 20)], "doc_id long, text string")
    assert resampled(none, some).count() == 0
    got = resampled(some, none, percent=50).collect()
    assert Counter(map(tuple, got)) == plain_resampled([(1, "a b " * 20), (2, "c d " * 20)], [], 10_000, 20, 50, 7)


# -- divergence ------------------------------------------------------------------


def plain_divergence(docs, least, top):
    rows = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low(text))) for _, text, lang, source in docs]
    out = []
    for lang in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == lang]
        df = Counter(t for _, _, ws in mine for t in set(ws))
        kept = sorted(t for t, n in df.items() if n >= least)
        groups = {s: Counter(t for _, s2, ws in mine if s2 == s for t in ws if df[t] >= least) for s in {r[1] for r in mine}}
        whole = sum(groups.values(), Counter())

        def share(counts, t):
            return 1 + 1_000_000_000 * (counts[t] + 5) // (sum(counts.values()) + 5 * len(kept))

        for s, counts in groups.items():
            pairs = [(o, sum(abs(share(counts, t) - share(groups[o], t)) for t in kept)) for o in groups if o != s]
            above = [(t, share(counts, t) - share(whole, t)) for t in kept if counts[t] and share(counts, t) > share(whole, t)]
            for part, found, most in (("pair", pairs, None), ("term", above, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, n) for n, (item, value) in enumerate(found[:most], 1)]
    return Counter(out)


def corpus(seed, n=260):
    draw = random.Random(seed)
    words = ["a", "an", "and", "anda", "andante", "AND", "être", "ê", "日本語", "日本", "zz" * 30, "zz" * 30 + "y", "b1b", "c_d"]
    words += [f"rare{chr(97 + n % 26)}{chr(97 + n // 26)}" for n in range(300)]
    weights = [8] * 14 + [0.05] * 300
    docs = []
    for n in range(n):
        text = " ".join(draw.choices(words, weights, k=draw.randrange(12)))
        lang, source = draw.choice(["en", "en", "fr", None]), draw.choice(["hot", "hot", "s1", "s2", "é", None])
        docs.append((n, text, lang, source))
    docs += [(7, "and and anda", "en", "hot")] * 80
    docs += [(8, None, "de", "s1"), (9, "", "de", "s2"), (10, "few words", "xx", "s1"), (None, "and " * 500, "en", "s9"), (11, ",,,", "en", "bare")]
    return docs


@pytest.mark.parametrize("seed, least, unit, chunk, block", [(1, 30, 1 << 20, 1 << 20, 256), (2, 5, 300, 50, 2), (3, 1, 5000, 7, 3)])
def test_divergence(spark, monkeypatch, seed, least, unit, chunk, block):
    for name, value in (("UNIT", unit), ("PORTION", 200), ("CHUNK", chunk), ("BLOCK", block), ("CELLS", 12)):
        monkeypatch.setattr(terms, name, value)
    docs = corpus(seed)
    df = ship(spark).createDataFrame(docs, DOCS).repartition(4)
    clash = df.withColumns({c: F.lit("x") for c in ("unit", "term", "terms", "n", "doc", "dead", "item", "value")})
    got = divergence(clash, least=least, top=4)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert Counter(map(tuple, got.collect())) == plain_divergence(docs, least, 4)


def test_rare_prefixes_are_discarded_level_by_level(spark):
    docs = ship(spark).createDataFrame(corpus(4), DOCS).repartition(3)
    units = terms.term_units(docs, "text", "lang", "source")
    told, width = terms.frequent_terms(units, 30)
    assert width == 64
    rare = 0
    for row in terms._rows(told.toArrow().to_batches()):
        words = terms._terms(row).to_pylist()
        ranges = sorted((int(d) >> 32, int(d) & 0xFFFFFFFF) for d in row["dead"])
        assert words == sorted(words) and all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))
        rare += sum(words[at].startswith(b"rare") for first, last in ranges for at in range(first, last))
        alive = terms._alive(row, len(words))
        assert not any(w.startswith(b"rare") and a for w, a in zip(words, alive) if row["lang"] == "fr")
    assert rare


def test_divergence_of_nothing(spark):
    assert divergence(ship(spark).createDataFrame([], DOCS)).count() == 0
    lone = ship(spark).createDataFrame([(1, "word", "en", "a"), (2, "word", "en", "b")], DOCS)
    assert sorted(map(tuple, divergence(lone).collect())) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_units_are_read_as_buffers_of_32_bits():
    """Copies in Python bytes and 64 bits took a task over its memory."""
    numbers = np.array([0, 7, 2**32 - 1])
    batch = pa.RecordBatch.from_pydict(
        {"lang": ["en"], "doc": [terms._planes(numbers)], "dead": [[5]]},
        schema=pa.schema([("lang", pa.string()), ("doc", pa.binary()), ("dead", pa.list_(pa.int64()))]),
    )
    (row,) = terms._rows(iter([batch]))
    assert isinstance(row["doc"], pa.Buffer)
    found = terms._unplaned(row["doc"])
    assert found.dtype.itemsize == 4 and found.tolist() == numbers.tolist()
    assert row["lang"] == "en" and row["dead"].tolist() == [5]


def test_a_task_holds_one_unit_at_a_time(spark):
    """All units of a partition came in one batch, so a task's memory grew with the table."""
    units = terms.term_units(ship(spark).createDataFrame(corpus(5), DOCS).repartition(6), "text", "lang", "source")
    told, _ = terms.frequent_terms(units, 5)
    for rows in (terms.term_counts(told), terms.prefix_counts(told, 8, 4)):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "FlatMapGroupsInArrow" in plan and "MapInArrow" not in plan.replace("FlatMapGroupsInArrow", "")

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_pydict({"rows": [sum(batch.num_rows for batch in batches)]})

    found = [row.rows for row in terms._by_unit(units.coalesce(1), sizes, "rows long").collect()]
    assert found == [1] * units.count() and len(found) > 12


def test_numbers_take_only_the_bytes_they_need():
    """Each entry of a unit took twelve bytes, wherever a unit was held."""
    for numbers in ([], [0], [1, 255], [256], [65535], [65536, 1], [2**24 - 1], [2**24], [2**32 - 1, 0]):
        data = terms._planes(np.array(numbers, np.int64))
        width = max(1, (max(numbers, default=0).bit_length() + 7) // 8)
        assert len(data) == 1 + width * len(numbers)
        assert terms._unplaned(data).tolist() == terms._unplaned(pa.py_buffer(data)).tolist() == numbers
    unit = terms._Unit()
    unit.add([b"b a b", b"", b"C a"], ["s", "t", "s"])
    unit.add([b"d " * 300], ["u"])
    row = unit.row("en")
    assert terms._terms(row).to_pylist() == [b"a", b"b", b"c", b"d"]
    assert terms._docs(row).tolist() == [0, 0, 2, 2, 3]
    assert terms._unplaned(row["term"]).tolist() == [0, 1, 0, 2, 3]
    assert terms._unplaned(row["n"]).tolist() == [1, 2, 1, 1, 300]
    assert len(row["term"]) == 6 and len(row["n"]) == 11 and len(row["sizes"]) == 5


def test_units_of_a_task_lie_in_several_row_groups(spark, monkeypatch):
    """The writer looked at its sizes after a hundred rows, so it and readers held all units of a task."""
    options = []
    monkeypatch.setattr(terms, "written", lambda df, name, *given: options.append(given) or written(df, name, *given))
    terms.term_units(ship(spark).createDataFrame(corpus(6, 20), DOCS), "text", "lang", "source")
    large = random.Random(6)
    rows = spark.createDataFrame([(n, large.randbytes(3 << 20)) for n in range(8)], "unit long, term binary").coalesce(1)
    table = written(rows, "units", *options[0])
    (file,) = table.inputFiles()
    found = ParquetFile(urlparse(file).path).metadata
    assert max(found.row_group(n).num_rows for n in range(found.num_row_groups)) < 4
    assert table.count() == 8
