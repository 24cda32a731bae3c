"""Near copies of texts: SuperMinHash signatures, bands, confirmation on full sets, grouping."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.graph import components
from tidemark.llm.superminhash import signatures
from tidemark.llm.words import BASES, Batch, give_back, lean, rolling
from tidemark.session import written

#: 40 bands of 6 slots meet for all but 5 in a million pairs at a similarity of 0.8.
BANDS, ROWS = 40, 6
#: Texts, and shingles of texts, in a block; larger groups are compared block by block.
BLOCK, BLOCK_SHINGLES = 1024, 1 << 20


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """The sorted distinct ``width``-word shingles of each text, as hashes of words in lower case.

    A text with fewer words is one shingle, a text without words an empty set.
    """
    batch = Batch(texts, lower=True)
    words, runs = batch.hashes(0), batch.runs(width, 0)
    sets = []
    for start, end in zip(batch.starts[:-1].tolist(), batch.starts[1:].tolist()):
        if end - start >= width:
            sets.append(np.unique(runs[start : end - width + 1]))
        else:
            sets.append(rolling(words[start:end], max(end - start, 1), BASES[0]))
    return sets


def near_copy_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """Groups of texts linked by a Jaccard similarity of at least ``percent`` of 100.

    One row per input row: ``id_col``, ``n_shingles`` (size of its set), ``group_id`` (key
    of its group, null without shingles), ``component_id`` (smallest id of the group, its
    own without shingles), ``row_hash`` (``xxhash64`` of id and text, to find the row again).

    1. Each text becomes its shingle set, a key of the set and the keys of the bands of
       its signature. Texts with one set are one class from here on, however many.
    2. Classes which share a band with others are joined, one link per class and band,
       and the components of these links hold every pair that can be similar.
    3. Within a component, sets are compared in full, in blocks of about ``BLOCK`` texts.
       A block returns a spanning forest of its links, never all pairs.
    4. The components of the confirmed links are the groups.

    Null ids are allowed; they stand in a group but never name it. Repeated rows and ids
    are kept. Other columns are ignored, whatever their names. Empty in, empty out.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    texts = texts.withColumn("row", F.xxhash64("id", "text"))
    described = texts.mapInArrow(
        _describe(width, bands, rows),
        f"id {texts.schema['id'].dataType.simpleString()}, row long, n_shingles long, class binary, bands array<long>",
    )
    described = written(described, "signatures")
    members = described.select("id", "row", "n_shingles", "class")

    classes = described.where("class is not null").groupBy("class").agg(F.first("bands").alias("bands"), F.min("row").alias("row"), F.first("n_shingles").alias("n"))
    keys = classes.select("class", F.explode("bands").alias("band"))
    crowded = keys.groupBy("band").agg(F.min("class").alias("low"), F.count("*").alias("n")).where("n > 1")
    meeting = keys.join(crowded.select("band", "low"), "band").select(F.col("class").alias("a"), F.col("low").alias("b"))
    rough = written(components(meeting.distinct()), "rough")

    standing = rough.join(classes.select(F.col("class").alias("node"), "row", "n"), "node")
    links = _confirmed(texts, standing, width, percent)
    roots = components(links)
    grouped = members.join(roots.select(F.col("node").alias("class"), "root"), "class", "left").select(
        "id", "row", "n_shingles", F.coalesce("root", "class").alias("group_id")
    )
    grouped = written(grouped, "groups")
    lowest = grouped.where("group_id is not null").groupBy("group_id").agg(F.min("id").alias("low"))
    return grouped.join(lowest, "group_id", "left").select(
        F.col("id").alias(id_col),
        F.col("row").alias("row_hash"),
        "n_shingles",
        "group_id",
        F.coalesce("low", "id").alias("component_id"),
    )


def _describe(width: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                sets = shingle_sets(part.column("text").to_pylist(), width)
                signed = signatures(sets, bands * rows)
                keys = np.zeros((len(sets), bands), np.uint64)
                for b in range(bands):
                    slots = np.ascontiguousarray(signed[:, b * rows : (b + 1) * rows])
                    keys[:, b] = [xxhash.xxh3_64_intdigest(x, seed=b) for x in slots]
                some = [len(s) > 0 for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        part.column("row"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([_class_key(s) if x else None for s, x in zip(sets, some)], pa.binary()),
                        pa.array([k if x else None for k, x in zip(keys.view(np.int64), some)], pa.list_(pa.int64())),
                    ],
                    names=["id", "row", "n_shingles", "class", "bands"],
                )
        give_back()

    return run


def pieces(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Slices of a batch, so that what is held at once stays small."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def _class_key(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles)


def _confirmed(texts: DataFrame, rough: DataFrame, width: int, percent: int) -> DataFrame:
    """Links ``(a, b)`` between the classes of ``rough`` (node, root, row, n) that span all similar pairs of a component."""
    spark = texts.sparkSession
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_SHINGLES)).cast("int")
    sizes = rough.groupBy("root").agg(blocks.alias("blocks"))
    placed = rough.join(sizes, "root").select(
        "row",
        F.col("node").alias("class"),
        "root",
        "blocks",
        F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"),
    )
    # One text stands for each class, also where its row is repeated; a block meets itself and
    # every other block of its component.
    chosen = texts.select("row", "text").join(placed, "row").select("class", "text", "root", "blocks", "block").distinct()
    sets = chosen.mapInArrow(_sets(width), "class binary, shingles binary, root binary, blocks int, block int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    met = sets.select("class", "shingles", "root", "block", other).select(
        "class", "shingles", "root", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")
    )
    tasks = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = met.withColumn("task", F.pmod(F.xxhash64("root", "i", "j"), F.lit(tasks)))
    return met.groupBy("task").applyInArrow(_compare(percent), "a binary, b binary")


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                sets = shingle_sets(part.column("text").to_pylist(), width)
                # A text that shares only its row hash with the one meant is left out here.
                meant = pa.array([c == _class_key(s) for c, s in zip(part.column("class").to_pylist(), sets)], pa.bool_())
                data = pa.array([s.tobytes() for s in sets], pa.binary())
                columns = [part.column("class"), data, *(part.column(c) for c in ("root", "blocks", "block"))]
                yield pa.RecordBatch.from_arrays(columns, names=["class", "shingles", "root", "blocks", "block"]).filter(meant)

    return run


def _compare(percent: int):
    def run(table: pa.Table) -> pa.Table:
        groups: dict[tuple, dict[bytes, tuple[int, np.ndarray]]] = {}
        columns = (table.column(c).to_pylist() for c in ("root", "i", "j", "class", "shingles", "block"))
        for root, i, j, name, shingles, block in zip(*columns):
            groups.setdefault((root, i, j), {})[name] = (block, np.frombuffer(shingles, np.uint64))
        a, b = [], []
        for (_, i, j), members in groups.items():
            names = sorted(members, key=lambda name: (members[name][0], name))
            left = sum(members[name][0] == i for name in names)
            linked = similar([members[name][1] for name in names], percent, left if i != j else None)
            for first, others in forest(linked):
                a += [names[first]] * len(others)
                b += [names[x] for x in others]
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return lean(run)


def similar(sets: list[np.ndarray], percent: int, left: int | None = None, width: int = 8192) -> np.ndarray:
    """Which pairs of sets have ``100 * intersection >= percent * union``, as a symmetric table.

    With ``left``, only the first ``left`` sets against the others. Shingles of one set
    alone count for its size only; the others are columns of a 0/1 matrix, taken
    ``width`` at a time, whose products are the intersections.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    number = np.cumsum(count > 1) - 1
    shared = count[column] > 1
    owner, column = owner[shared], number[column[shared]]
    cut = len(sets) if left is None else left
    rows, others = np.arange(cut), np.arange(0 if left is None else cut, len(sets))
    kind = np.float32 if sizes.max(initial=0) < 1 << 24 else np.float64
    common = np.zeros((len(rows), len(others)), np.int64)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for start in range(0, int((count > 1).sum()), width):
        a, b = np.searchsorted(column, (start, start + width))
        matrix = np.zeros((len(sets), min(width, int(column[b - 1]) - start + 1)), kind)
        matrix[owner[a:b], column[a:b] - start] = 1
        common += (matrix[rows] @ matrix[others].T).astype(np.int64)
    union = sizes[rows][:, None] + sizes[others][None, :] - common
    linked = np.zeros((len(sets), len(sets)), bool)
    linked[np.ix_(rows, others)] = 100 * common >= percent * union
    np.fill_diagonal(linked, False)
    return linked | linked.T


def forest(linked: np.ndarray) -> Iterator[tuple[int, list[int]]]:
    """The components of two or more nodes: the first node and the others."""
    left = np.ones(len(linked), bool)
    for first in range(len(linked)):
        if not left[first]:
            continue
        left[first] = False
        found, edge = [], np.array([first])
        while len(edge):
            reached = linked[edge].any(axis=0) & left
            edge = np.flatnonzero(reached)
            left[edge] = False
            found += edge.tolist()
        if found:
            yield first, found
