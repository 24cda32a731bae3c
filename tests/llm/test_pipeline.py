"""The pipeline's stages against plain Python, and the registered queries."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
import oracle_check
from test_texts import plain_groups, plain_removal, plain_words, texts_with_copies
from tidemark.llm.oracles import ORACLES
from tidemark.llm.packing import lengths

SMALL = "/root/testdata/sf0.001"

#: Columns and types that the queries promise.
PROMISED = {
    "op2": "query_id bigint, rank int, vec_id bigint, score bigint",
    "op3": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    "op4": "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string",
    "op5": "query_id bigint, rank int, vec_id bigint, score double",
    "op6": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op8": "page_id bigint, url string, text string, n_chars bigint",
    "op9": "doc_id bigint, held_out boolean, score double, predicted int",
    "op10": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    "op11": "lang string, source string, part string, item string, value bigint, rank int",
    "op12": "doc_id bigint, n_features bigint, weight bigint, score bigint, rank bigint",
    "op13": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
}


def documents(spark, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    full = [(i, t, "en", f"src{at}", len(t or "")) for at, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, schema)


def test_stages_are_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_copies", "passages", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_near_copies_stage_keeps_one_of_each_group(spark):
    texts = texts_with_copies(9)
    rows = [(500 - i, t) for i, t in enumerate(texts)]
    rows += [rows[2], rows[2], (None, rows[3][1]), (None, "quite alone in here"), (None, "quite alone in here"), (500, None)]
    docs = documents(spark, rows).withColumn("__n", F.lit(1))
    got = corpus_pipeline.near_copies(spark, docs, SMALL)
    assert got.columns == docs.columns
    kept = Counter((r["doc_id"], r["text"]) for r in got.collect())
    want = Counter()
    seen = set()
    for (key, text), (_, n, low) in zip(rows, plain_rows(rows)):
        if not n:
            want[key, text] += 1
        elif key == low and (key, text) not in seen:
            seen.add((key, text))
            want[key, text] += 1
    assert kept == want


def test_stages_keep_columns_of_any_name(spark):
    """Names the stages work with, as columns of the table."""
    long = " ".join(f"w{i}" for i in range(60))
    odd = {c: F.lit(f"own {c}") for c in ("__quality", "quality", "__group", "group", "grp", "n", "kept_id", "kept_n", "score")}
    docs = documents(spark, [(1, long + " a"), (2, "b " + long), (3, "something else"), (3, "something else")]).withColumns(odd)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, SMALL)
        assert got.columns == docs.columns, name
        assert got.select(*[F.lit(f"own {c}") == F.col(c) for c in odd]).distinct().collect() == [(True,) * len(odd)], name


def plain_rows(rows):
    """(id, shingles, smallest id of the group) in the order of the rows."""
    out = []
    by = {}
    for key, n, low in plain_groups(rows, 5, 80).elements():
        by.setdefault(key, []).append((key, n, low))
    for key, text in rows:
        words = plain_words(text, True)
        n = len({tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}) if words else 0
        out.append(next(x for x in by[key] if x[1] == n))
    return out


def test_passages_stage(spark):
    passage = " ".join(f"p{i}" for i in range(55))
    rows = [(1, f"before it {passage} after it"), (2, f"{passage}\nend"), (3, " ".join(f"p{i}" for i in range(49))),
            (4, None), (5, ""), (6, "clean  text"), (7, f"again {passage}"), (6, "clean  text")]
    docs = documents(spark, rows)
    got = corpus_pipeline.passages(spark, docs, SMALL)
    assert got.columns == docs.columns and got.count() == len(rows)
    for r in got.collect():
        words = plain_words(r["text"])
        at = [i for i, (key, _) in enumerate(rows) if key == r["doc_id"]][0]
        total, gone, _ = plain_removal([t for _, t in rows], 50)[at]
        assert len(words) == total - gone
        if not gone:
            assert r["text"] == rows[at][1]


def test_quality_stage_drops_what_is_rejected(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = corpus_pipeline.quality(spark, docs, folder)
    assert got.columns == docs.columns
    kept = {r["doc_id"] for r in got.collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet").join(docs, "doc_id", "left_semi").collect()
    good = [r["doc_id"] in kept for r in labels if r["quality"] == 1]
    bad = [r["doc_id"] in kept for r in labels if r["quality"] == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.15 * len(bad)


@pytest.mark.parametrize("at", range(4))
def test_stages_take_an_empty_table(spark, at):
    name, stage = corpus_pipeline.STAGES[at]
    docs = documents(spark, [])
    got = stage(spark, docs, SMALL)
    assert got.count() == 0 and (name == "packing" or got.columns == docs.columns)


def test_whole_pipeline(spark):
    got = corpus_pipeline.run(spark, SMALL)
    rows = got.collect()
    docs = {r["doc_id"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    assert 0 < len(by_doc) < len(docs) and set(by_doc) <= docs
    for pieces in by_doc.values():
        pieces.sort(key=lambda r: r["start"])
        assert [r["length"] for r in pieces] == lengths(pieces[0]["doc_tokens"], 1024)


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if n.startswith("op")))
def test_queries_keep_their_promises(spark, name):
    got = entry.queries()[name](spark, SMALL)
    kinds = dict(got.dtypes)
    for column in PROMISED.get(name.split("_")[0], "").split(", "):
        if column:
            key, kind = column.split(" ")
            assert kinds[key] == kind
    assert got.count() > 0


@pytest.mark.parametrize("name", ORACLES)
def test_queries_equal_their_sql(spark, name):
    problem, rows = oracle_check.compare(spark, name, SMALL)
    assert problem is None and rows
