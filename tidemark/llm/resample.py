"""Drawing documents that resemble a target, by hashed features of words and word pairs."""

from __future__ import annotations

import gc
import math
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from tokenizers import PreTokenizedString, Regex
from tokenizers.pre_tokenizers import Split

from tidemark.llm.portions import Numbers, portions, small, spread
from tidemark.llm.words import give_back
from tidemark.session import written

#: Letters, digits and all beyond ASCII, once A-Z are small.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bytes of text a task takes at a time, and windows of more bytes than ``LONG`` one by one.
PORTION, LONG = 1 << 20, 48


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


CRC = _crc_table()


def crc_on(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, state: np.ndarray) -> np.ndarray:
    """CRC-32 registers after reading one window of ``data`` each, all windows side by side.

    Registers start at 2**32 - 1 and are inverted to give the checksum, as usual; reading on
    from a register is reading the longer text.
    """
    order = np.argsort(-lengths, kind="stable")
    at, left, out = starts[order], -lengths[order], state[order]
    most = -left[0] if len(left) else 0
    for step in range(min(int(most), LONG)):
        n = np.searchsorted(left, -step)
        out[:n] = CRC[(out[:n] ^ data[at[:n] + step]) & 255] ^ (out[:n] >> 8)
    for n in range(np.searchsorted(left, -LONG)):
        register = int(out[n])
        for byte in data[at[n] + LONG : at[n] - left[n]].tolist():
            register = int(CRC[(register ^ byte) & 255]) ^ (register >> 8)
        out[n] = register
    result = np.empty_like(out)
    result[order] = out
    return result


def word_offsets(data: bytes, splitter: Split) -> tuple[np.ndarray, np.ndarray]:
    """First and last byte (exclusive) of every word of a small-letter text."""
    if not data:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    split = PreTokenizedString(data.decode())
    splitter.pre_tokenize(split)
    parts = split.get_splits(offset_referential="original", offset_type="byte")
    places = np.fromiter(chain.from_iterable([place for _, place, _ in parts]), np.int64, 2 * len(parts))
    return places[::2], places[1::2]


def feature_hashes(texts: list[str], splitter: Split) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """CRC-32 of every word and every two consecutive words of each text; words and features per text.

    No word holds a space, so the splitter reads each distinct stretch between spaces once.
    """
    numbers, rows = Numbers(), []
    for text in texts:
        stretches = small(text).split(b" ")
        rows.append(np.fromiter(map(numbers.__getitem__, stretches), np.int64, len(stretches)))
    distinct = list(numbers)
    joined = b" ".join(distinct)
    starts, stops = word_offsets(joined, splitter)
    lengths = np.fromiter(map(len, distinct), np.int64, len(distinct))
    held = np.bincount(
        np.searchsorted(np.cumsum(lengths + 1) - lengths - 1, starts, "right") - 1, minlength=len(distinct)
    )
    # All these words again, a space before each, so that the second half of a pair is one stretch.
    sizes = stops - starts
    places = np.cumsum(sizes + 1) - sizes
    data = np.full(len(sizes) + sizes.sum(), ord(" "), np.uint8)
    data[spread(places, sizes)] = np.frombuffer(joined, np.uint8)[spread(starts, sizes)]
    one = crc_on(data, places, sizes, np.full(len(sizes), 0xFFFFFFFF, np.uint32))

    order = np.concatenate(rows)
    words = spread((np.cumsum(held) - held)[order], held[order])
    n_words = np.array([held[row].sum() for row in rows], np.int64)
    owner = np.repeat(np.arange(len(texts)), n_words)
    pair = np.flatnonzero(owner[1:] == owner[:-1])
    # A pair is its first word read on over the space and the second.
    two = crc_on(data, places[words[pair + 1]] - 1, sizes[words[pair + 1]] + 1, one[words[pair]])
    hashes = ~np.concatenate((one[words], two))
    by_text = np.argsort(np.concatenate((owner, owner[pair])), kind="stable")
    return hashes[by_text], n_words, n_words + np.maximum(n_words - 1, 0)


def bucketed(texts: DataFrame, buckets: int = 10000) -> DataFrame:
    """Columns ``id``, ``n_words``, ``n_features`` and ``buckets`` for the columns ``id`` and ``text``.

    ``buckets`` holds the bucket of every feature, repeats included, as little-endian numbers
    of 16 bits, or 32 where there are more buckets than those count. Nothing is shuffled.
    """
    kind = np.dtype("<u2") if buckets <= 1 << 16 else np.dtype("<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        gc.disable()  # words come as many short tuples, none of them in a cycle
        splitter = Split(Regex(WORD), "removed", invert=True)
        for part in portions(batches, "text", PORTION):
            column = [text or "" for text in part.column("text").to_pylist()]
            hashes, n_words, n_features = feature_hashes(column, splitter)
            data = (hashes % np.uint32(buckets)).astype(kind)
            ends = np.concatenate(([0], np.cumsum(n_features))) * kind.itemsize
            binary = pa.Array.from_buffers(
                pa.large_binary(), len(column), [None, pa.py_buffer(ends), pa.py_buffer(data)]
            ).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(n_words), pa.array(n_features), binary],
                names=["id", "n_words", "n_features", "buckets"],
            )
        gc.enable()
        give_back()

    id_kind = texts.schema["id"].dataType.simpleString()
    rows = texts.select("id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {id_kind}, n_words long, n_features long, buckets binary")


def _numbers(column: pa.Array, buckets: int) -> np.ndarray:
    """The buckets of all rows end to end."""
    kind = np.dtype("<u2") if buckets <= 1 << 16 else np.dtype("<u4")
    ends = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4)
    data = column.buffers()[2]
    if data is None:
        return np.zeros(0, kind)
    return np.frombuffer(data, kind, (int(ends[-1]) - int(ends[0])) // kind.itemsize, int(ends[0]))


def histogram(features: DataFrame, buckets: int = 10000) -> np.ndarray:
    """How many features fall into each bucket: partitions count, Spark adds, ``buckets`` numbers come back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            if batch.num_rows:
                counts += np.bincount(_numbers(batch.column(0), buckets), minlength=buckets)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[held])], names=["bucket", "n"])

    rows = features.select("buckets").mapInArrow(run, "bucket long, n long")
    counts = np.zeros(buckets, np.int64)
    for bucket, n in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[bucket] = n
    return counts


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> list[int]:
    """Each bucket's gain in thousandths: the logarithm of its share in the target over its share in all, both plus one."""
    size, s_all, t_all = len(raw), int(raw.sum()), int(target.sum())
    return [
        math.floor(1000 * math.log(float((t + 1) * (s_all + size)) / float((s + 1) * (t_all + size))))
        for s, t in zip(raw.tolist(), target.tolist())
    ]


def weighed(features: DataFrame, gains: list[int]) -> DataFrame:
    """``features`` with ``weight``, the floored mean of the gains over a row's features, in place of ``buckets``."""
    table, buckets = np.array(gains, np.int64), len(gains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n = batch.column("n_features").to_numpy()
            sums = np.concatenate(([0], np.cumsum(table[_numbers(batch.column("buckets"), buckets)])))
            ends = np.cumsum(n)
            weights = (sums[ends] - sums[ends - n]) // np.maximum(n, 1)
            columns = [batch.column(c) for c in ("id", "n_words", "n_features")] + [pa.array(weights)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n_words", "n_features", "weight"])

    kind = features.schema["id"].dataType.simpleString()
    return features.select("id", "n_words", "n_features", "buckets").mapInArrow(
        run, f"id {kind}, n_words long, n_features long, weight long"
    )


def gumbel(id_col: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from the SHA-256 of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((number + F.lit(0.5)) / F.lit(4294967296.0))))


def ranked(rows: DataFrame, drawn_percent: int, eligible: Column) -> DataFrame:
    """``rank`` (from 1) for the highest scores of the eligible rows, ties to smaller ids; null for all others.

    Rows are dealt over partitions by ranges of the order and numbered where they lie; the
    sizes of the partitions before are added. No task holds more than its range, and rows
    that are equal in every column are told apart by a number, so that they don't meet in one.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.desc("eligible"), F.desc("score"), F.asc_nulls_last("id"), F.asc("n_features"), F.asc("row")]
    numbered = rows.withColumns({"eligible": F.coalesce(eligible, F.lit(False)), "row": F.monotonically_increasing_id()})
    sorted_ = written(numbered, "scores").repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = written(sorted_.withColumn("place", F.monotonically_increasing_id()), "places")
    part = F.shiftrightunsigned("place", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.count_if("eligible").alias("fit"))
    before, fit, offsets = 0, 0, []
    for at, n, m in sorted(map(tuple, sizes.collect())):  # a row for each partition
        offsets.append((at, before))
        before, fit = before + n, fit + m
    starts = spark.createDataFrame(offsets, "part long, before long")
    rank = F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1) + 1
    joined = placed.withColumn("part", part).join(F.broadcast(starts), "part")
    drawn = fit * drawn_percent // 100
    return joined.withColumn("rank", F.when(F.col("eligible") & (rank <= drawn), rank)).select(*rows.columns, "rank")


def resampled(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    buckets: int = 10000,
    least_words: int = 20,
    percent: int = 25,
    seed: int = 7,
) -> DataFrame:
    """Importance resampling of ``docs`` towards the texts of ``target`` (its column ``text_col``).

    Features are the words of a text, A-Z made small, and its pairs of consecutive words; they
    are counted in buckets by CRC-32. A text's ``weight`` is the floored mean of its buckets'
    gains, and ``score`` adds Gumbel noise drawn from ``seed`` and id, so that the highest
    scores are a draw without replacement in proportion to the weights. ``percent`` percent
    of the documents of ``least_words`` words or more get a ``rank``.

    Features are hashed once and kept in a scratch table of two bytes each; the histogram has
    ``buckets`` rows. Null and empty texts have no features, weight 0, and no rank. Repeated
    rows are documents of their own with neighbouring ranks; a null id gives noise of its own
    and comes after the others in a tie. Other columns are ignored, whatever their names. An
    empty table gives no rows; an empty target has gains by the documents alone.

    Columns: ``id_col``, ``n_features``, ``weight``, ``score``, ``rank``, ``n_words``.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    wanted = target.select(F.lit(0).alias("id"), F.col(text_col).alias("text"))
    features = written(bucketed(rows, buckets), "features")
    gains = bucket_gains(histogram(features, buckets), histogram(bucketed(wanted, buckets), buckets))
    scored = weighed(features, gains).withColumn("score", F.col("weight") + gumbel(F.col("id"), seed))
    drawn = ranked(scored, percent, F.col("n_words") >= least_words)
    return drawn.select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank", "n_words")
