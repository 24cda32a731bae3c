"""Passages that repeat: rolling hashes of every window of words, counted over all texts."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.words import Batch, lean, pack_sorted, unpack_sorted, words_of

#: Bytes of text that a group of documents holds on average, at most.
GROUP_BYTES = 4 << 20
#: Bytes of text whose windows a bucket holds on average, at most.
BUCKET_BYTES = 32 << 20


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, with as many underscores behind it as make it no column of ``docs``."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def grouped(docs: DataFrame, text_col: str, group: str) -> tuple[DataFrame, int]:
    """``docs`` with a column ``group``, and into how many buckets its groups send.

    Groups grow in number with the text, not in size, and a row's group follows from its
    content, so a task that runs again sees the same rows. Every group sends a row to
    every bucket, so there are no more of either than the partitions and the text ask for.
    """
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = max(2 * partitions, -(-total // GROUP_BYTES))
    buckets = max(partitions, -(-total // BUCKET_BYTES))
    key = F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c, kind in docs.dtypes if not kind.startswith("map"))), F.lit(groups))
    return docs.withColumn(group, key.cast("long")), buckets


def repeated_spans(docs: DataFrame, text_col: str = "text", window: int = 35) -> DataFrame:
    """``docs`` with ``n_words`` and ``spans``, the runs of words ``[from, to)`` that repeated windows cover.

    A window is ``window`` consecutive words of one text. It is repeated if the same words
    also start at another place, in the same text or another. Overlapping and touching
    repeated windows are merged into one span, the largest possible.

    Documents are dealt into groups. Each group sends every distinct window hash once,
    sorted and packed, to the bucket named by a second hash of the window, so a window
    that stands in a third of all rows costs one number per group. Buckets count in how
    many groups a hash occurs and send each group back one bit per hash; the group adds
    what it sees to repeat within itself. Equal windows agree in 64 bits and the bucket.

    Null text has no words and no spans. Repeated rows are documents of their own and so
    cover each other. Other columns stay as they are; ``n_words`` and ``spans`` replace
    columns with these names. An empty table gives no rows.
    """
    docs = docs.drop("n_words", "spans")
    columns = docs.columns

    def made(table: pa.Table, words: np.ndarray, spans: list[list[dict]]) -> pa.Table:
        out = {c: table.column(c) for c in columns}
        out["n_words"] = pa.array(words, pa.int64())
        out["spans"] = pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))
        return pa.table(out)

    return _with_spans(docs, text_col, window, made, f"{_kinds(docs)}, n_words long, spans array<struct<start: long, stop: long>>")


def _kinds(docs: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)


def _with_spans(docs: DataFrame, text_col: str, window: int, made: Callable, schema: str) -> DataFrame:
    """What ``made`` gives for each group of documents, their numbers of words and their spans."""
    group = free_name(docs, "group")
    dealt, buckets = grouped(docs, text_col, group)
    sent = dealt.groupBy(group).applyInArrow(_send(text_col, window, buckets), "bucket long, grp long, keys binary")
    answers = sent.groupBy("bucket").applyInArrow(_count, "grp long, bucket long, bits binary")
    both = dealt.groupBy(group).cogroup(answers.groupBy("grp"))
    return both.applyInArrow(_cover(text_col, window, buckets, made), schema)


class _Windows:
    """The windows of a group of texts, by bucket and hash."""

    def __init__(self, texts: list[str | None], window: int, buckets: int):
        self.batch = Batch(texts)
        self.at = self.batch.whole_runs(window)
        if not len(self.at):
            self.keys = self.bucket = np.zeros(0, np.uint64)
            return
        self.keys = self.batch.runs(window, 0)[self.at]
        self.bucket = self.batch.runs(window, 1)[self.at] % np.uint64(buckets)

    def by_bucket(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """``(bucket, positions, which distinct key each has, distinct keys)``; positions count windows."""
        if not len(self.at):
            return
        order = np.argsort(self.bucket, kind="stable")
        names, starts = np.unique(self.bucket[order], return_index=True)
        for name, part in zip(names.tolist(), np.split(order, starts[1:])):
            keys, which = np.unique(self.keys[part], return_inverse=True)
            yield name, part, which, keys


def _send(text_col: str, window: int, buckets: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        rows = _Windows(table.column(text_col).to_pylist(), window, buckets).by_bucket()
        found = [(bucket, pack_sorted(keys)) for bucket, _, _, keys in rows]
        return pa.table(
            {
                "bucket": pa.array([x[0] for x in found], pa.int64()),
                "grp": pa.array([key[0].as_py()] * len(found), pa.int64()),
                "keys": pa.array([x[1] for x in found], pa.binary()),
            }
        )

    return lean(run)


@lean
def _count(key: tuple, table: pa.Table) -> pa.Table:
    """For each group, one bit per key: whether another group has it too."""
    groups = table.column("grp").to_pylist()
    keys = [unpack_sorted(x) for x in table.column("keys").to_pylist()]
    together = np.sort(np.concatenate(keys))
    repeated = np.unique(together[1:][together[1:] == together[:-1]])
    out = []
    for group, own in zip(groups, keys):
        at = np.minimum(np.searchsorted(repeated, own), max(len(repeated) - 1, 0))
        if len(repeated) and (hit := repeated[at] == own).any():
            out.append((group, np.packbits(hit).tobytes()))
    return pa.table(
        {
            "grp": pa.array([x[0] for x in out], pa.int64()),
            "bucket": pa.array([key[0].as_py()] * len(out), pa.int64()),
            "bits": pa.array([x[1] for x in out], pa.binary()),
        }
    )


def _cover(text_col: str, window: int, buckets: int, made: Callable):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        bits = dict(zip(answers.column("bucket").to_pylist(), answers.column("bits").to_pylist()))
        windows = _Windows(table.column(text_col).to_pylist(), window, buckets)
        batch = windows.batch
        edges = np.zeros(len(batch.numbers) + 1, np.int64)
        for bucket, part, which, keys in windows.by_bucket():
            repeated = np.bincount(which, minlength=len(keys)) > 1
            if bucket in bits:
                repeated |= np.unpackbits(np.frombuffer(bits[bucket], np.uint8), count=len(keys)).astype(bool)
            start = windows.at[part[repeated[which]]]
            edges[start] += 1
            edges[start + window] -= 1
        covered = np.cumsum(edges[:-1]) > 0
        starts = batch.starts
        spans = []
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
            step = np.diff(np.concatenate(([0], covered[a:b].view(np.int8), [0])))
            ends = zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist())
            spans.append([{"start": x, "stop": y} for x, y in ends])
        return made(table, np.diff(starts), spans)

    return lean(run)


def kept_words(text: str | None, spans: list[dict]) -> list[bytes]:
    """The words of ``text`` outside the spans."""
    words, kept, at = words_of(text), [], 0
    for span in spans:
        kept += words[at : span["start"]]
        at = span["stop"]
    return kept + words[at:]


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35) -> DataFrame:
    """``id_col``, ``n_words``, ``n_removed`` and ``kept_sha256`` of the kept words joined by spaces; see ``repeated_spans``."""

    def made(table: pa.Table, words: np.ndarray, spans: list[list[dict]]) -> pa.Table:
        pairs = zip(table.column(text_col).to_pylist(), spans)
        return pa.table(
            {
                id_col: table.column(id_col),
                "n_words": pa.array(words, pa.int64()),
                "n_removed": pa.array([sum(x["stop"] - x["start"] for x in s) for s in spans], pa.int64()),
                "kept_sha256": pa.array(
                    [hashlib.sha256(b" ".join(kept_words(t, s))).hexdigest() for t, s in pairs], pa.string()
                ),
            }
        )

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_words long, n_removed long, kept_sha256 string"
    return _with_spans(docs.select(id_col, text_col), text_col, window, made, schema)


def without_repeats(docs: DataFrame, text_col: str = "text", window: int = 35) -> DataFrame:
    """``docs`` with the repeated passages cut out of the text; texts without any stay as they are.

    Of a text with spans, what lies before, between and after them is kept as it stands,
    white space included, and the pieces are joined by a newline. See ``repeated_spans``.
    """
    columns = docs.columns

    def made(table: pa.Table, words: np.ndarray, spans: list[list[dict]]) -> pa.Table:
        pairs = zip(table.column(text_col).to_pylist(), spans)
        texts = pa.array([cut(t, s) if s else t for t, s in pairs], pa.string())
        return pa.table({c: texts if c == text_col else table.column(c) for c in columns})

    return _with_spans(docs, text_col, window, made, _kinds(docs))


def cut(text: str, spans: list[dict]) -> str:
    """``text`` without the words of the spans."""
    data = text.encode("utf-8", "surrogatepass")
    begins, ends, at = [], [], 0
    for word in data.split():
        at = data.index(word, at)
        begins.append(at)
        at += len(word)
        ends.append(at)
    pieces, at = [], 0
    for span in spans:
        pieces.append(data[at : begins[span["start"]]])
        at = ends[span["stop"] - 1]
    pieces.append(data[at:])
    return b"\n".join(x for x in (p.strip() for p in pieces) if x).decode("utf-8", "surrogatepass")
