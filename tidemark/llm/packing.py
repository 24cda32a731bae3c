"""Packing documents into token sequences by powers of two."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

#: The vocabulary, and the same as ranks; see ``Encoder``.
VOCABULARY, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
#: Characters on which two libraries' Unicode tables may differ: unassigned, private, and rare white space.
UNSURE = regex.compile(r"[\p{Cn}\p{Co}\p{Cs}\x1c-\x1f\x85\u180e\u200b-\u200f\u2028-\u202f\u205f-\u206f\ufeff]")

_encoders: dict[tuple[str, str], Encoder] = {}


class Encoder:
    """Token ids as ``tokenizers`` gives them for a byte-level BPE file when it adds none of its own.

    ``tiktoken`` applies the same merges, from the file of ranks, several times faster; the
    tests compare the two. Texts with characters on which their Unicode tables may differ, or
    with the string of an added token, go to ``tokenizers`` itself.
    """

    def __init__(self, vocabulary: str, ranks: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.exact = Tokenizer.from_file(vocabulary)
        self.exact.no_truncation()
        self.exact.no_padding()
        self.added = [token.content for token in self.exact.get_added_tokens_decoder().values()]
        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding(
            "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={}
        )

    @classmethod
    def of(cls, vocabulary: str, ranks: str) -> Encoder:
        """The encoder of these files, loaded once per worker; names are looked up among the public files."""
        key = (vocabulary, ranks)
        if key not in _encoders:
            paths = (name if os.path.isabs(name) else public_tokenizers.path(name) for name in key)
            _encoders[key] = cls(*paths)
        return _encoders[key]

    def ids(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint32)
        if UNSURE.search(text) or any(token in text for token in self.added):
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype(np.uint32, copy=False)


def lengths(tokens: int, limit: int) -> list[int]:
    """The lengths of a document's pieces, longest first: whole ``limit``s, then the binary digits of the rest.

    ``limit`` is a power of two. All lengths are powers of two, so no piece needs padding.
    """
    rest = tokens % limit
    return [limit] * (tokens // limit) + [1 << bit for bit in range(limit.bit_length() - 2, -1, -1) if rest >> bit & 1]


def packed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 1024,
    end: int = 0,
    vocabulary: str = VOCABULARY,
    ranks: str = RANKS,
) -> DataFrame:
    """Pieces of all documents, each a sequence of its own whose length is a power of two up to ``limit``.

    A document is the ids of its text and then ``end``; null and empty texts are that id
    alone. It is cut into whole pieces of ``limit`` ids and one piece per binary digit of
    what is left, longest first, so every id lies in one piece, no sequence crosses
    documents and none is padded. One row per piece: ``id_col``, ``start`` (ids of the
    document before it), ``length``, ``bucket`` (the same: sequences of one bucket form
    batches as they are), ``ids`` (little-endian unsigned 32-bit numbers), ``doc_tokens``, ``sequence_id`` (unique), ``offset``
    (0). Repeated rows and ids are documents of their own, null ids stay null, other
    columns are ignored and an empty table gives no rows. Nothing is shuffled.
    """
    if limit < 1 or limit & (limit - 1):
        raise ValueError("limit must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(vocabulary, ranks)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column("text").to_pylist()
                ids = [np.append(encoder.ids(text), np.uint32(end)) for text in texts]
                cuts = [lengths(len(x), limit) for x in ids]
                sizes = np.array([n for cut in cuts for n in cut], np.int64)
                owner = np.repeat(np.arange(len(ids)), [len(cut) for cut in cuts])
                starts = np.concatenate([np.cumsum(cut) - cut for cut in map(np.array, cuts)])
                bounds = np.concatenate(([0], 4 * np.cumsum(sizes))).astype(np.int32)
                data = np.concatenate(ids).astype("<u4", copy=False)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id").take(pa.array(owner)),
                        pa.array(starts, pa.int64()),
                        pa.array(sizes),
                        pa.Array.from_buffers(
                            pa.binary(), len(sizes), [None, pa.py_buffer(bounds), pa.py_buffer(data)]
                        ),
                        pa.array(np.array([len(x) for x in ids], np.int64)[owner]),
                    ],
                    names=["id", "start", "length", "ids", "doc_tokens"],
                )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    pieces = rows.mapInArrow(run, f"id {kind}, start long, length long, ids binary, doc_tokens long")
    return pieces.select(
        F.col("id").alias(id_col),
        "start",
        "length",
        F.col("length").alias("bucket"),
        "ids",
        "doc_tokens",
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Writes sequences to one folder per length, so that a training batch needs no padding."""
    pieces.write.partitionBy("bucket").parquet(path)
