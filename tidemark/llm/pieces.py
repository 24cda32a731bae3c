"""SentencePiece encoding and decoding: the N best segmentations by forward Viterbi and backward A*."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.words import give_back

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
#: What a character without a piece costs below the lowest score of a piece.
PENALTY = 10.0
#: Searched segments remembered per worker, longest segment searched side by side, size of the piece tables.
REMEMBERED, WIDE, TABLE_BITS = 50_000, 256, 20
#: Characters of text that are segmented together.
TOGETHER = 1 << 21

_models: dict[str, PieceModel] = {}


class PieceModel:
    """The pieces of a model, their scores, and the segmentations of texts into them.

    The score of a segmentation is the sum of its pieces' scores. A character that is no
    piece is written as its UTF-8 bytes, at ``PENALTY`` below the lowest score. A space
    stands before the text, and spaces are written as U+2581.
    """

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.piece = [model.id_to_piece(i) for i in range(size)]
        plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.scores = {self.piece[i]: (i, model.get_score(i)) for i in plain}
        self.byte = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.of_byte = {i: b for b, i in enumerate(self.byte)}
        self.lowest = min(score for _, score in self.scores.values()) - PENALTY
        self.longest = max(map(len, self.scores))
        inside = "".join(p.lstrip(SPACE) for p in self.scores)
        if SPACE in inside:
            raise ValueError("a piece holds a space after another character")
        # No piece reaches across these, so that a text falls into segments that repeat.
        alone = "".join(c for c in "\n\r\t" if c not in inside)
        self.segment = re.compile(f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" + (f"|[{alone}]" if alone else ""))
        self.known: dict[tuple[str, int], list] = {}
        self._tables()

    @classmethod
    def of(cls, model: str) -> PieceModel:
        """The model of a file, loaded once per worker; a bare name is looked up among the public files."""
        if model not in _models:
            _models[model] = cls(model if os.path.isabs(model) else public_tokenizers.path(model))
        return _models[model]

    def best(self, text: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The ``n`` best segmentations of ``text`` as it stands, best first: score and ids.

        Forward, the best score of every beginning of the text is found. Backward from the
        end, partial segmentations are extended in order of their score plus that of the
        best beginning: exact, so each one finished is the next best. Equal scores come in
        the order in which they are finished, which depends on the text alone: among equal
        partial segmentations the one that has least left goes on, then the latest.
        """
        size, get, longest = len(text), self.scores.get, self.longest
        upto = [0.0] + [-1e300] * size
        edges: list[list[tuple]] = [[] for _ in range(size + 1)]
        for i in range(size):
            here, j = upto[i], i
            for piece in [text[i : i + k] for k in range(1, min(longest, size - i) + 1)]:
                j += 1
                found = get(piece)
                if found is None:
                    if j > i + 1:
                        continue
                    found = tuple(self.byte[b] for b in piece.encode("utf-8", "surrogatepass")), self.lowest
                edges[j].append((i, found[0], found[1]))
                if here + found[1] > upto[j]:
                    upto[j] = here + found[1]
        out: list[tuple[float, tuple[int, ...]]] = []
        heap: list[tuple] = [(-upto[size], size, 0, 0.0, None)]
        made = 0
        while heap and len(out) < n:
            _, at, _, score, rest = heappop(heap)
            if not at:
                ids: list[int] = []
                while rest:
                    piece, rest = rest
                    if isinstance(piece, tuple):
                        ids += piece
                    else:
                        ids.append(piece)
                out.append((score, tuple(ids)))
                continue
            for start, piece, value in edges[at]:
                made -= 1
                total = score + value
                # Among equals the one nearest to the beginning goes on, so ties are not all followed at once.
                heappush(heap, (-total - upto[start], start, made, total, (piece, rest)))
        return out

    def all_best(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Forward Viterbi for many segments side by side: ids end to end, their bounds, scores, losses.

        A loss is what the second best segmentation of a segment scores below the best,
        infinity where there is one only.
        """
        length = np.array([len(s) for s in segments], np.int64)
        score, loss = np.zeros(len(segments)), np.full(len(segments), np.inf)
        ids: list[np.ndarray] = []
        owner: list[np.ndarray] = []
        order = np.argsort(length, kind="stable")
        cuts = np.flatnonzero(np.diff(length[order])) + 1
        for same in np.split(order, cuts) if len(order) else []:
            size = int(length[same[0]])
            for part in np.array_split(same, -(-len(same) * size // 400_000)) if size <= WIDE else []:
                done, got = self._side_by_side([segments[i] for i in part], size)
                score[part[done]], loss[part[done]] = got[0], got[1]
                ids.append(got[2])
                owner.append(part[done][got[3]])
                same = np.setdiff1d(same, part[done], assume_unique=True)
            for i in same.tolist():  # very long, or with characters that are no piece
                found = self.best(segments[i], 2)
                score[i] = found[0][0]
                if len(found) > 1:
                    loss[i] = found[0][0] - found[1][0]
                ids.append(np.array(found[0][1], np.int32))
                owner.append(np.full(len(found[0][1]), i))
        if not ids:
            return np.zeros(0, np.int32), np.zeros(len(segments) + 1, np.int64), score, loss
        every = np.concatenate(owner)
        placed = np.argsort(every, kind="stable")
        bounds = np.concatenate(([0], np.cumsum(np.bincount(every, minlength=len(segments)))))
        return np.concatenate(ids)[placed], bounds, score, loss

    def _side_by_side(self, segments: list[str], size: int) -> tuple[np.ndarray, tuple]:
        """Segments of one length whose characters all are pieces: which these are; scores, losses, ids, owners."""
        chars = np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), np.uint32)
        chars = chars.reshape(-1, size).T.astype(np.uint64)
        widest = min(self.longest, size)
        found = np.full((size, widest, chars.shape[1]), -1, np.int32)
        for start in range(size):
            key = np.zeros(chars.shape[1], np.uint64)
            for k in range(min(widest, size - start)):
                key = key * self.base + chars[start + k] + np.uint64(1)
                found[start, k] = self._look_up(key)
        done = np.flatnonzero((found[:, 0] >= 0).all(axis=0))
        found = found[:, :, done]
        value = np.where(found >= 0, self.score_of[found], -np.inf)
        n = len(done)
        first, second = np.full((size + 1, n), -np.inf), np.full((size + 1, n), -np.inf)
        first[0] = 0
        back = np.zeros((size + 1, n), np.int64)
        for end in range(1, size + 1):
            for k in range(min(widest, end)):
                gain = value[end - 1 - k, k]
                total = first[end - 1 - k] + gain
                better = total > first[end]
                np.maximum(second[end], np.where(better, first[end], total), out=second[end])
                np.maximum(second[end], second[end - 1 - k] + gain, out=second[end])
                np.copyto(first[end], total, where=better)
                back[end][better] = k
        ids, owner = [], []
        at, who = np.full(n, size), np.arange(n)
        while len(who):
            k = back[at, who]
            at = at - 1 - k
            ids.append(found[at, k, who])
            owner.append(who)
            more = at > 0
            at, who = at[more], who[more]
        # Pieces were met from the end; the stable order by owner needs them from the beginning.
        return done, (
            first[size],
            first[size] - second[size],
            np.concatenate(ids[::-1]) if ids else np.zeros(0, np.int32),
            np.concatenate(owner[::-1]) if owner else np.zeros(0, np.int64),
        )

    def _look_up(self, keys: np.ndarray) -> np.ndarray:
        """The piece of each key, -1 for none."""
        out = np.full(len(keys), -1, np.int32)
        for slots, held, piece in self.tables:
            slot = (keys * slots) >> np.uint64(64 - TABLE_BITS)
            hit = held[slot] == keys
            out[hit] = piece[slot[hit]]
        return out

    def _tables(self) -> None:
        """Hash tables over the pieces; what finds its slot taken goes into the next table."""
        self.base = np.uint64(0x9E3779B97F4A7C15)
        keys, ids = [], []
        for text, (i, _) in self.scores.items():
            key = 0
            for c in text:
                key = (key * int(self.base) + ord(c) + 1) % (1 << 64)
            keys.append(key)
            ids.append(i)
        if len(set(keys)) < len(keys):
            raise ValueError("two pieces have one key")
        self.score_of = np.full(len(self.piece), -np.inf)
        for i, score in self.scores.values():
            self.score_of[i] = score
        self.tables, multiplier = [], 0xD6E8FEB86659FD93
        while keys:
            held = np.zeros(1 << TABLE_BITS, np.uint64)
            piece = np.full(1 << TABLE_BITS, -1, np.int32)
            left_keys, left_ids = [], []
            for key, i in zip(keys, ids):
                slot = (key * multiplier % (1 << 64)) >> (64 - TABLE_BITS)
                if piece[slot] < 0:
                    held[slot], piece[slot] = key, i
                else:
                    left_keys.append(key)
                    left_ids.append(i)
            self.tables.append((np.uint64(multiplier), held, piece))
            keys, ids, multiplier = left_keys, left_ids, (multiplier * 0xC2B2AE3D27D4EB4F) % (1 << 64) | 1

    def encode_all(self, texts: list[str | None], n: int = 1) -> list[list[tuple[float, np.ndarray]]]:
        """The ``n`` best segmentations of whole texts, best first; one, empty, for a null or empty text.

        Segments are independent, so the best of a text joins their best, and the next ones
        change few segments: those where a change costs least. Only these are searched
        for their own ``n`` best.
        """
        table: dict[str, int] = {}
        number = table.setdefault
        lines = [
            [number(s, len(table)) for s in self.segment.findall(SPACE + t.replace(" ", SPACE))] if t else [] for t in texts
        ]
        segments = list(table)
        flat, bounds, score, loss = self.all_best(segments)
        sizes = np.diff(bounds)
        out = []
        for line in lines:
            if not line:
                out.append([(0.0, np.zeros(0, np.int32))])
                continue
            parts = np.array(line)
            lens = sizes[parts]
            ends = np.cumsum(lens)
            ids = flat[np.repeat(bounds[parts] - (ends - lens), lens) + np.arange(ends[-1])]
            total = float(score[parts].sum())
            results = [(total, ids)]
            if n > 1:
                losses = loss[parts]
                cheap = np.argsort(losses, kind="stable")[: n - 1] if len(parts) < 4 * n else self._lowest(losses, n - 1)
                found: list[tuple[float, tuple]] = [(0.0, ())]
                for at in cheap.tolist():
                    if losses[at] == np.inf:
                        continue
                    own = flat[bounds[parts[at]] : bounds[parts[at] + 1]]
                    others = [x for x in self._remembered(segments[parts[at]], n) if x[1] != tuple(own.tolist())]
                    more = [
                        (lost + score[parts[at]] - value, changes + ((at, other),))
                        for lost, changes in found
                        for value, other in others[: n - 1]
                    ]
                    found = sorted(found + more, key=lambda x: x[0])[:n]
                for lost, changes in found[1:]:
                    pieces, before = [], 0
                    for at, other in sorted(changes):
                        pieces += [ids[before : ends[at] - lens[at]], np.array(other, np.int32)]
                        before = ends[at]
                    results.append((total - lost, np.concatenate([*pieces, ids[before:]])))
            out.append(results)
        return out

    @staticmethod
    def _lowest(losses: np.ndarray, n: int) -> np.ndarray:
        some = np.flatnonzero(losses <= np.partition(losses, n - 1)[n - 1])
        return some[np.argsort(losses[some], kind="stable")][:n]

    def _remembered(self, segment: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        if (segment, n) not in self.known:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[segment, n] = self.best(segment, n)
        return self.known[segment, n]

    def decode(self, ids: list[int]) -> str:
        """The text of pieces: bytes put together, U+2581 as space, without the space at the front."""
        of_byte = self.of_byte
        if of_byte.keys().isdisjoint(ids):
            text = "".join([self.piece[i] for i in ids])
        else:
            data = b"".join([bytes((of_byte[i],)) if i in of_byte else self.piece[i].encode() for i in ids])
            text = data.decode("utf-8", "replace")
        text = text.replace(SPACE, " ")
        return text[1:] if text.startswith(" ") else text


def encoded(docs: DataFrame, n: int = 3, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL) -> DataFrame:
    """The ``n`` best segmentations of every whole text: a row each.

    ``id_col``, ``rank`` from 1, ``score`` (sum of the pieces' scores), ``n_pieces``,
    ``ids`` (little-endian unsigned 32-bit numbers) and ``exact``: whether decoding the best
    gives the text back (all have the same characters), which it does unless the text
    itself holds U+2581.
    Texts with fewer segmentations have fewer rows; a null or empty text has one without
    pieces. Equal scores are ranked in an order that follows from the text. Repeated rows
    and null ids stay, other columns are ignored, an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = PieceModel.of(model)
        for batch in batches:
            texts, at = batch.column("text").to_pylist(), 0
            while at < len(texts):
                stop, size = at, 0
                while stop < len(texts) and (stop == at or size < TOGETHER):
                    size += len(texts[stop] or "")
                    stop += 1
                found = pieces.encode_all(texts[at:stop], n)
                rows = [(i, r, score, ids) for i, best in enumerate(found) for r, (score, ids) in enumerate(best)]
                ids = [x[3].astype("<u4") for x in rows]
                same = [pieces.decode(best[0][1].tolist()) == (t or "") for best, t in zip(found, texts[at:stop])]
                exact = [same[x[0]] for x in rows]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(pa.array([at + x[0] for x in rows], pa.int64())),
                        pa.array([x[1] + 1 for x in rows], pa.int32()),
                        pa.array([x[2] for x in rows], pa.float64()),
                        pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([x.tobytes() for x in ids], pa.binary()),
                        pa.array(exact, pa.bool_()),
                    ],
                    names=["id", "rank", "score", "n_pieces", "ids", "exact"],
                )
                at = stop
        give_back()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"id {kind}, rank int, score double, n_pieces long, ids binary, exact boolean")
    return out.withColumnRenamed("id", id_col)


def decoded(rows: DataFrame, ids_col: str = "ids", text_col: str = "text", model: str = MODEL) -> DataFrame:
    """``rows`` with the text of their pieces in ``text_col``; null ids give null."""
    rows = rows.drop(text_col)
    columns = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = PieceModel.of(model)
        for batch in batches:
            data = batch.column(ids_col).to_pylist()
            texts = [None if d is None else pieces.decode(np.frombuffer(d, "<u4").tolist()) for d in data]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*columns, text_col])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{kinds}, `{text_col}` string")
