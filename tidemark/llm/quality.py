"""Quality of texts by a small convolutional network over bytes, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

#: Bytes per half chunk; a chunk is two halves, and chunks overlap by one.
HALF = 32
#: Width and step of the byte filters, their number, the distances at which bytes are compared, chunk filters.
WIDTH, STEP, FILTERS, LAGS, SHAPES = 8, 4, 8, 32, 12
#: Labelled texts learned from, of each label, and the longest of them in characters.
SAMPLE, LONGEST = 800, 100_000


class Laid:
    """Texts as bytes end to end, each filled with zeros to whole halves and two empty halves more.

    A text's last chunk ends with the first empty half; the second keeps its filters from
    reaching into the next text.
    """

    def __init__(self, texts: list[str | None]):
        data = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        self.halves = np.array([max(1, -(-len(d) // HALF)) + 2 for d in data], np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.halves)))
        out = np.zeros(int(self.first[-1]) * HALF + WIDTH, np.uint8)
        for d, at in zip(data, self.first.tolist()):
            out[at * HALF : at * HALF + len(d)] = np.frombuffer(d, np.uint8)
        self.bytes = out
        inner = np.ones(int(self.first[-1]), bool)
        inner[self.first[1:] - 1] = inner[self.first[1:] - 2] = False
        self.chunks = np.flatnonzero(inner)  # a chunk begins at every half with text
        self.count = self.halves - 2
        self.begin = np.concatenate(([0], np.cumsum(self.count)[:-1]))
        self.owner = np.repeat(np.arange(len(texts)), self.count)

    def repeats(self) -> np.ndarray:
        """For each half and distance, the share of bytes equal to the byte so far before, and the largest share."""
        body = self.bytes[: len(self.bytes) - WIDTH]
        out = np.empty((len(body) // HALF, LAGS + 1), np.float32)
        solid = body != 0
        for lag in range(1, LAGS + 1):
            same = np.zeros(len(body), bool)
            np.equal(body[lag:], body[:-lag], out=same[lag:])
            same &= solid
            out[:, lag - 1] = np.bitwise_count(np.packbits(same).view(np.uint32))
        out[:, LAGS] = out[:, :LAGS].max(axis=1)
        return out / HALF


class ByteNetwork:
    """Filters over bytes, averaged by chunk, and filters over chunks, pooled by their maximum and mean.

    A filter's value at a place is a sum of one weight per byte of its width (a convolution
    over one-hot bytes), cut off below 0. A chunk is described by the means of the filters
    in it and by how often its bytes repeat at each distance.
    """

    def __init__(self, seed: int = 7):
        draw = np.random.default_rng(seed)
        self.params = {
            "bytes": draw.normal(0, 0.1, (WIDTH, 256, FILTERS)).astype(np.float32),
            "bias": np.zeros(FILTERS, np.float32),
            "chunk": draw.normal(0, 0.3, (FILTERS + LAGS + 1, SHAPES)).astype(np.float32),
            "shift": np.zeros(SHAPES, np.float32),
            "out": draw.normal(0, 0.3, 2 * SHAPES).astype(np.float32),
            "last": np.zeros(1, np.float32),
        }

    def _forward(self, laid: Laid) -> dict[str, np.ndarray]:
        p = self.params
        n = len(laid.bytes) - WIDTH
        wave = np.tile(p["bias"], (n // STEP, 1))
        for j in range(WIDTH):
            wave += p["bytes"][j][laid.bytes[j : n + j : STEP]]
        np.maximum(wave, 0, out=wave)
        half = np.concatenate((wave.reshape(-1, HALF // STEP, FILTERS).mean(axis=1), laid.repeats()), 1)
        chunk = (half[laid.chunks] + half[laid.chunks + 1]) / 2
        shape = np.maximum(chunk @ p["chunk"] + p["shift"], 0)
        most = np.maximum.reduceat(shape, laid.begin)
        mean = np.add.reduceat(shape, laid.begin) / laid.count[:, None]
        pooled = np.concatenate((most, mean), 1)
        return {"wave": wave, "chunk": chunk, "shape": shape, "pooled": pooled, "z": pooled @ p["out"] + p["last"]}

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """The probability of label 1 for every text; a null or empty text is scored as one empty chunk."""
        if not texts:
            return np.zeros(0)
        z = self._forward(Laid(texts))["z"].astype(np.float64)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def _gradients(self, laid: Laid, labels: np.ndarray, weights: np.ndarray) -> dict[str, np.ndarray]:
        p, f = self.params, self._forward(laid)
        shape, pooled = f["shape"], f["pooled"]
        dz = ((1 / (1 + np.exp(-f["z"])) - labels) * weights).astype(np.float32)
        out = {"out": pooled.T @ dz, "last": dz.sum(keepdims=True)}
        by_text = dz[:, None] * p["out"][None, :]
        dshape = (by_text[:, SHAPES:] / laid.count[:, None])[laid.owner]
        highest = shape >= pooled[laid.owner, :SHAPES]
        dshape += by_text[laid.owner, :SHAPES] * highest / np.add.reduceat(highest, laid.begin, dtype=np.float32)[laid.owner]
        dshape *= shape > 0
        out["chunk"], out["shift"] = f["chunk"].T @ dshape, dshape.sum(axis=0)
        dchunk = (dshape @ p["chunk"].T)[:, :FILTERS] / 2
        dhalf = np.zeros((len(f["wave"]) * STEP // HALF, FILTERS), np.float32)
        dhalf[laid.chunks] += dchunk
        dhalf[laid.chunks + 1] += dchunk
        dwave = np.repeat(dhalf / (HALF // STEP), HALF // STEP, axis=0) * (f["wave"] > 0)
        out["bias"] = dwave.sum(axis=0)
        n = len(laid.bytes) - WIDTH
        out["bytes"] = np.empty_like(p["bytes"])
        for j in range(WIDTH):
            at = laid.bytes[j : n + j : STEP]
            for k in range(FILTERS):
                out["bytes"][j, :, k] = np.bincount(at, dwave[:, k], 256)
        return out

    def fit(
        self, texts: list[str], labels: np.ndarray, weights: np.ndarray, rounds: int = 14, rate: float = 0.02, decay: float = 1e-3
    ) -> ByteNetwork:
        """Adam on the weighted log loss, in batches of 32 texts in a fixed random order.

        Few texts are gone through more often, for as many steps as ``rounds`` over 1600.
        """
        draw = np.random.default_rng(11)
        rounds = max(rounds, min(20 * rounds, rounds * 1600 // max(len(texts), 1)))
        first = {k: np.zeros_like(v) for k, v in self.params.items()}
        second = {k: np.zeros_like(v) for k, v in self.params.items()}
        step = 0
        for turn in range(rounds):
            order = draw.permutation(len(texts))
            for at in range(0, len(order), 32):
                some = order[at : at + 32]
                found = self._gradients(Laid([texts[i] for i in some]), labels[some], weights[some] / len(some))
                step += 1
                pace = rate * min(1.0, 2 * (1 - turn / rounds))
                for name, value in self.params.items():
                    g = found[name].reshape(value.shape) + decay * value * (name != "last")
                    first[name] += 0.1 * (g - first[name])
                    second[name] += 0.001 * (g * g - second[name])
                    scale = np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8
                    value -= (pace * first[name] / (1 - 0.9**step) / scale).astype(np.float32)
        return self


def held_out(id_col: str) -> F.Column:
    """Whether a row is kept from learning: crc32 of its id as text is divisible by 5, or it has no id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(True))


def learned(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample: int = SAMPLE,
    longest: int = LONGEST,
) -> ByteNetwork:
    """A network fitted to labelled texts that are not held out.

    At most ``sample`` texts of each label are learned from, those whose ids hash lowest,
    and none longer than ``longest`` characters; a loss weight per label restores the
    labels' shares. An id with several labels counts with the rounded mean. Without a text
    of either label the network answers that label's share alone.
    """
    usable = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).where(
        "id is not null and label is not null"
    )
    usable = usable.where(~held_out("id")).groupBy("id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    shares = {row["label"]: row["count"] for row in usable.groupBy("label").count().collect()}
    # Some labelled ids have no text or too long a one, so twice as many are looked up. Of many
    # labelled rows, one in so many is ranked at all: about four times the sample of each label.
    one_in = F.when(F.col("label") == 1, max(1, shares.get(1, 0) // (4 * sample))).otherwise(
        max(1, shares.get(0, 0) // (4 * sample))
    )
    lowest = Window.partitionBy("label").orderBy(F.xxhash64("id"), "id")
    drawn = usable.where(F.pmod(F.xxhash64("id", F.lit(1)), one_in) == 0)
    drawn = drawn.withColumn("at", F.row_number().over(lowest)).where(F.col("at") <= 2 * sample)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    texts = texts.where(F.length("text").between(1, longest))
    # Of several texts of one id the smallest counts, whatever the order of the rows.
    found = texts.join(F.broadcast(drawn), "id").groupBy("id", "label", "at").agg(F.min("text").alias("text"))
    turn = Window.partitionBy("label").orderBy("at")
    rows = found.withColumn("turn", F.row_number().over(turn)).where(F.col("turn") <= sample)
    rows = sorted(rows.select("label", "turn", "text").collect(), key=lambda r: (r["label"], r["turn"]))
    network = ByteNetwork()
    target = np.array([r["label"] for r in rows], np.float32)
    counts = {x: int((target == x).sum()) for x in (0, 1)}
    if not counts[0] or not counts[1]:
        network.params["out"][:] = 0
        share = (shares.get(1, 0) + 1) / (sum(shares.values()) + 2)
        network.params["last"][:] = np.log(share / (1 - share))
        return network
    total = sum(shares.values())
    weights = np.array([shares[int(x)] / total * len(rows) / counts[int(x)] for x in target], np.float32)
    return network.fit([r["text"] for r in rows], target, weights)


def scored(docs: DataFrame, network: ByteNetwork, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with the network's probability for every whole text, null and empty texts included.

    A column named ``score_col`` is replaced; all others stay. Rows stay where they are.
    """
    docs = docs.drop(score_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_col).to_pylist()
            values, at = [], 0
            while at < len(texts):  # about a megabyte at a time
                stop, size = at, 0
                while stop < len(texts) and (stop == at or size < 1 << 20):
                    size += len(texts[stop] or "")
                    stop += 1
                values.append(network.scores(texts[at:stop]))
                at = stop
            scores = pa.array(np.concatenate(values) if values else np.zeros(0), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*batch.schema.names, score_col])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{kinds}, `{score_col}` double")


def judged(docs: DataFrame, labels: DataFrame, least: float = 0.3) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` (1 from a score of ``least``) for every document."""
    network = learned(docs, labels)
    rows = scored(docs.select("doc_id", "text"), network)
    return rows.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted")
    )
