"""Class-based bigrams: exchange clustering puts words into classes, class transitions and word emissions score texts."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.words import Batch, give_back, lean, pack_sorted, unpack_sorted
from tidemark.session import scratch_dir, written

#: Word classes, the end of a text included; sweeps of the exchange; weight of the class shares in a transition.
CLASSES, SWEEPS, BLEND = 96, 3, 20.0
#: Bytes of text per group of documents, and of text per bucket of words.
GROUP_BYTES, BUCKET_BYTES = 4 << 20, 16 << 20
#: Contexts of words that are weighed together.
PAIRS = 1 << 15
#: Class of the end of a text, and the mark of a word that was never learned.
END, UNKNOWN = 0, 255


def planes(values: np.ndarray) -> bytes:
    """Whole numbers without sign, high bytes first and byte by byte, which compresses well.

    The first byte says how many bytes a number has: four, or eight if one needs them.
    """
    width = 8 if len(values) and values.max() >= 1 << 32 else 4
    laid = values.astype(f">u{width}").view(np.uint8).reshape(-1, width).T
    return bytes([width]) + np.ascontiguousarray(laid).tobytes()


def unplanes(data: bytes) -> np.ndarray:
    width = data[0]
    laid = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1).T
    return np.ascontiguousarray(laid).view(f">u{width}").ravel().astype(np.int64)


def held_out(id_col: str) -> F.Column:
    """Whether a text is kept from learning: crc32 of its id as text leaves 2 divided by 7, or it has no id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 7 == 2, F.lit(True))


class Group:
    """Documents of a group as numbers of its words, sorted by hash, from 1; 0 ends every text."""

    def __init__(self, row: dict):
        self.words = unpack_sorted(row["words"])
        self.ids = unplanes(row["ids"])
        self.sizes = np.array(row["sizes"], np.int64)
        self.held = np.array(row["held"], bool)
        self.docs = row["docs"]
        self.learned = np.repeat(~self.held, self.sizes)

    def slices(self, buckets: int) -> np.ndarray:
        """Where each bucket's words begin; a bucket is a range of hashes."""
        at = (self.words >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
        return np.searchsorted(at, np.arange(buckets + 1))

    def before(self, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class of every token, and of the token before it; a text begins after an end."""
        own = np.concatenate(([END], classes))[self.ids]
        past = np.empty_like(own)
        past[0:1] = END
        past[1:] = own[:-1]
        return own, past

    def facts(self, rows: list[dict], kind: str, read: Callable) -> np.ndarray:
        """What the buckets said about the group's words, in their order."""
        parts = [read(r["data"]) for r in sorted(rows, key=lambda r: r["bucket"]) if r["kind"] == kind]
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    size = 0

    def group() -> pa.RecordBatch:
        batch = Batch([text for _, text, _ in held], lower=True)
        hashes = batch.table.hashes()[:, 0] if len(batch.table) else np.zeros(0, np.uint64)
        words, number = np.unique(hashes, return_inverse=True)
        ids = np.insert(number[batch.numbers] + 1, batch.starts[1:], 0)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([[i for i, _, _ in held]], pa.list_(kind)),
                pa.array([[out for _, _, out in held]], pa.list_(pa.bool_())),
                pa.array([(np.diff(batch.starts) + 1).tolist()], pa.list_(pa.int64())),
                pa.array([planes(ids)], pa.binary()),
                pa.array([pack_sorted(words)], pa.binary()),
            ],
            names=["docs", "held", "sizes", "ids", "words"],
        )

    kind = pa.int64()
    for batch in batches:
        kind = batch.schema.field("id").type
        for row in zip(*(batch.column(c).to_pylist() for c in ("id", "text", "held"))):
            held.append(row)
            size += len(row[1] or "") + 1
            if size >= GROUP_BYTES:
                yield group()
                held, size = [], 0
                give_back()
    if held:
        yield group()


def _kept_by(df: DataFrame, key: str, parts: int, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, laid out by ``key`` so that later joins on it move the other side only."""
    spark = df.sparkSession
    table = f"tidemark_{name}_{uuid.uuid4().hex[:12]}"
    df.write.bucketBy(parts, key).option("path", scratch_dir(spark, name)).option("compression", "zstd").saveAsTable(table)
    kept = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # the name only: the files stay, and are read through ``kept``
    return kept


def _asked(corpus: DataFrame, facts: DataFrame, answer: Callable, schema: str) -> DataFrame:
    """``answer(group, facts)`` for every group of documents and what the buckets said about its words."""

    def run(group: pa.Table, said: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        return answer(rows[0]["grp"], Group(rows[0]), said.to_pylist())

    return corpus.groupBy("grp").cogroup(facts.groupBy("grp")).applyInArrow(lean(run), schema)


#: What groups send to buckets, and buckets to groups.
SENT = "bucket long, grp long, words binary, numbers binary, classes binary, counts binary"
SAID = """grp long, bucket long, kind string, data binary, tokens long, once long, twice long,
class_tokens array<long>, class_words array<long>, top array<struct<n: long, word: long>>"""


def _sent(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) or [()] * 6
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
    names = ("bucket", "grp", "words", "numbers", "classes", "counts")
    return pa.table({n: pa.array(c, t) for n, t, c in zip(names, kinds, columns)})


def _said(rows: list[dict]) -> pa.Table:
    schema = pa.schema(
        [
            ("grp", pa.int64()), ("bucket", pa.int64()), ("kind", pa.string()), ("data", pa.binary()), ("tokens", pa.int64()),
            ("once", pa.int64()), ("twice", pa.int64()), ("class_tokens", pa.list_(pa.int64())),
            ("class_words", pa.list_(pa.int64())), ("top", pa.list_(pa.struct([("n", pa.int64()), ("word", pa.int64())]))),
        ]
    )
    return pa.Table.from_pylist(rows, schema)


def _count(buckets: int):
    """Sends every bucket the learned counts of a group's words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                group = Group(row)
                counts = np.bincount(group.ids[group.learned], minlength=len(group.words) + 1)[1:]
                at = group.slices(buckets)
                rows = [
                    (b, row["grp"], pack_sorted(group.words[x:y]), None, None, planes(counts[x:y]))
                    for b, (x, y) in enumerate(zip(at.tolist(), at[1:].tolist()))
                    if y > x
                ]
                yield from _sent(rows).to_batches()
            give_back()

    return run


def _total(classes: int):
    """Adds up the counts of a bucket's words and answers every group; notes the most frequent words."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        bucket, rows = key[0].as_py(), table.select(["grp", "words", "counts"]).to_pylist()
        own = [unpack_sorted(r["words"]) for r in rows]
        words, number = np.unique(np.concatenate(own), return_inverse=True)
        total = np.bincount(number, np.concatenate([unplanes(r["counts"]) for r in rows]), len(words)).astype(np.int64)
        out, at = [], 0
        for row, mine in zip(rows, own):
            data = planes(total[number[at : at + len(mine)]])
            out.append({"grp": row["grp"], "bucket": bucket, "kind": "count", "data": data})
            at += len(mine)
        best = np.lexsort((words, -total))[:classes]
        out.append(
            {
                "grp": -1, "bucket": bucket, "kind": "sum", "tokens": int(total.sum()), "once": int((total == 1).sum()),
                "twice": int((total == 2).sum()), "class_words": [int((total > 0).sum())],
                "top": [{"n": n, "word": w} for n, w in zip(total[best].tolist(), words[best].view(np.int64).tolist()) if n],
            }
        )
        return _said(out)

    return lean(run)


@dataclass
class Classes:
    """How a group finds the classes of its words: from the buckets, or at first from the most frequent words."""

    count: int
    top: np.ndarray | None = None

    def of(self, group: Group, said: list[dict]) -> np.ndarray:
        if self.top is None:
            return group.facts(said, "class", lambda d: np.frombuffer(d, np.uint8)).astype(np.int64)
        classes = np.full(len(group.words), self.count - 1)
        order = np.argsort(self.top)
        at = np.minimum(np.searchsorted(self.top[order], group.words), max(len(order) - 1, 0))
        if len(order):
            hit = self.top[order][at] == group.words
            classes[hit] = order[at[hit]] + 1
        return classes


def _transitions(classes: Classes):
    def run(grp: int, group: Group, said: list[dict]) -> pa.Table:
        own, past = group.before(classes.of(group, said))
        some = group.learned
        n = classes.count
        counts = np.bincount(past[some] * n + own[some], minlength=n * n)
        at = np.flatnonzero(counts)
        return pa.table({"pair": pa.array(at, pa.int64()), "n": pa.array(counts[at], pa.int64())})

    return run


def _contexts(classes: Classes, buckets: int):
    """Sends every bucket how often each of a group's words follows each class."""

    def run(grp: int, group: Group, said: list[dict]) -> pa.Table:
        _, past = group.before(classes.of(group, said))
        some = group.learned & (group.ids > 0)
        pairs, counts = np.unique((group.ids[some] - 1) * 256 + past[some], return_counts=True)
        word = pairs >> 8
        at = group.slices(buckets)
        cut = np.searchsorted(word, at)
        number = np.bincount(word, minlength=len(group.words))
        rows = []
        for b in range(buckets):
            x, y, u, v = at[b], at[b + 1], cut[b], cut[b + 1]
            if y > x:
                kinds = (pairs[u:v] & 255).astype(np.uint8).tobytes()
                rows.append((b, grp, pack_sorted(group.words[x:y]), planes(number[x:y]), kinds, planes(counts[u:v])))
        return _sent(rows)

    return run


def _exchange(gain: np.ndarray):
    """Gives every word of a bucket the class in which its contexts are likeliest, and answers every group.

    ``gain[p, c]`` is the log of how much likelier class ``c`` is after class ``p`` than
    anywhere. A word moves to the class with the largest sum of gains over its contexts,
    ties to the smaller class; a word that was never learned has none.
    """

    def run(key: tuple, table: pa.Table) -> pa.Table:
        n = gain.shape[1]
        bucket, rows = key[0].as_py(), table.drop_columns(["bucket"]).to_pylist()
        own = [unpack_sorted(r["words"]) for r in rows]
        words, number = np.unique(np.concatenate(own), return_inverse=True)
        times = np.concatenate([unplanes(r["numbers"]) for r in rows])
        past = np.concatenate([np.frombuffer(r["classes"], np.uint8) for r in rows])
        counts = np.concatenate([unplanes(r["counts"]) for r in rows])
        pair = np.repeat(number, times) * 256 + past
        order = np.argsort(pair, kind="stable")
        pair, first = np.unique(pair[order], return_index=True)
        counts = np.add.reduceat(counts[order], first) if len(first) else counts
        word = pair >> 8
        classes = np.full(len(words), UNKNOWN, np.uint8)
        starts = np.flatnonzero(np.diff(word, prepend=-1))
        total = np.zeros(len(words), np.int64)
        total[word[starts]] = np.add.reduceat(counts, starts) if len(starts) else 0
        a = 0
        while a < len(starts):  # words with about PAIRS contexts at a time
            b = max(a + 1, int(np.searchsorted(starts, starts[a] + PAIRS)))
            some, end = starts[a:b], starts[b] if b < len(starts) else len(pair)
            worth = gain[pair[some[0] : end] & 255] * counts[some[0] : end, None]
            classes[word[some]] = np.add.reduceat(worth, some - some[0]).argmax(axis=1)
            a = b
        out, at = [], 0
        for row, mine in zip(rows, own):
            data = classes[number[at : at + len(mine)]].tobytes()
            out.append({"grp": row["grp"], "bucket": bucket, "kind": "class", "data": data})
            at += len(mine)
        known = classes != UNKNOWN
        out.append(
            {
                "grp": -1,
                "bucket": bucket,
                "kind": "sum",
                "class_tokens": np.bincount(classes[known], total[known], n).astype(np.int64).tolist(),
                "class_words": np.bincount(classes[known], minlength=n).tolist(),
            }
        )
        return _said(out)

    return lean(run)


@dataclass
class Model:
    """What scoring needs besides the classes and counts of words; its size depends on the number of classes alone."""

    tokens: int
    words: int
    discount: float
    transitions: np.ndarray
    class_tokens: np.ndarray
    class_words: np.ndarray

    def logs(self, own: np.ndarray, past: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """log10 probability of every token, by its class, the class before it and its count.

        A known word is emitted by its class with its count less a discount; what is taken
        off is the chance of unknown words in that class. A token after an unknown word
        goes by the shares of the classes, as does a transition blended with them.
        """
        n = len(self.class_tokens)
        share = (self.class_tokens + 1) / (self.tokens + n)
        after = (self.transitions + BLEND * share) / (self.transitions.sum(axis=1, keepdims=True) + BLEND)
        after = np.vstack([after, share])
        taken = np.where(self.class_tokens > 0, self.discount * self.class_words / np.maximum(self.class_tokens, 1), 1.0)
        taken[END] = 0.0 if self.class_tokens[END] else 1.0
        strange = np.maximum(after @ taken, 1e-300)
        past = np.where(past == UNKNOWN, n, past)
        known = own != UNKNOWN
        here = np.where(known, own, 0)
        off = np.where(here == END, 0.0, self.discount)
        emitted = (counts - off) / np.maximum(self.class_tokens[here], 1)
        return np.log10(np.where(known, np.maximum(after[past, here] * emitted, 1e-300), strange[past]))


def _score(model: Model, id_type: pa.DataType):
    def run(grp: int, group: Group, said: list[dict]) -> pa.Table:
        counts = group.facts(said, "count", unplanes)
        ends = int(model.class_tokens[END])
        classes = group.facts(said, "class", lambda d: np.frombuffer(d, np.uint8)).astype(np.int64)
        own, past = group.before(classes)
        own = np.where(group.ids == 0, END if ends else UNKNOWN, own)
        past = np.where(past == END, END, past)
        count = np.concatenate(([ends], counts))[group.ids]
        begin = np.cumsum(group.sizes) - group.sizes
        base = np.log10((count + 1) / (model.tokens + model.words + 1))
        return pa.table(
            {
                "id": pa.array(group.docs, id_type),
                "held_out": pa.array(group.held),
                "n_tokens": pa.array(group.sizes),
                "n_known": pa.array(np.add.reduceat((count > 0).astype(np.int64), begin)),
                "train_tokens": pa.array(np.full(len(group.docs), model.tokens, np.int64)),
                "base_score": pa.array(np.add.reduceat(base, begin)),
                "score": pa.array(np.add.reduceat(model.logs(own, past, count), begin)),
            }
        )

    return run


def class_bigram_scores(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    classes: int = CLASSES,
    sweeps: int = SWEEPS,
) -> DataFrame:
    """log10 probabilities of all texts under a class-based bigram model of those that are not held out.

    One row per document: ``id_col``, ``held_out``, ``n_tokens``, ``n_known`` (tokens that
    occur in learned texts), ``train_tokens``, ``base_score`` (add-one unigrams) and
    ``score``. Tokens are the words in lower case and one end per text. Perplexity is
    ``10 ** (-score / n_tokens)``.

    1. Texts become word numbers, in groups of about ``GROUP_BYTES`` with their sorted word
       hashes, in a table laid out by group. Words are dealt into buckets by hash.
    2. Groups send buckets their counts and get the corpus counts back.
    3. At first the most frequent words are a class each and all others one. In each sweep
       of the exchange, groups send buckets how often a word follows each class, buckets
       move every word to its best class given the class transitions of all texts, and
       groups get the new classes back. All words take part, however rare.
    4. Groups score their texts with the transitions, class sizes and counts.

    Only sums per class and the most frequent words, one per class, reach the driver.
    Words are the same if 64 bits of their hashes are. Null and empty texts are the end
    alone; rows with a null id are held out; repeated rows count as often as they occur;
    other columns are ignored; an empty table gives no rows.
    """
    if not 3 <= classes < UNKNOWN:
        raise ValueError("classes must be between 3 and 254")
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), held_out(id_col).alias("held")
    )
    kind = rows.schema["id"].dataType.simpleString()
    size, ends = rows.agg(F.sum(F.octet_length("text")), F.count_if(~F.col("held"))).first()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(2 * partitions, -(-(size or 0) // BUCKET_BYTES))
    corpus = rows.mapInArrow(
        _encode, f"docs array<{kind}>, held array<boolean>, sizes array<long>, ids binary, words binary"
    ).withColumn("grp", F.monotonically_increasing_id())
    corpus = _kept_by(corpus, "grp", partitions, "corpus")

    counted = corpus.mapInArrow(_count(buckets), SENT).groupBy("bucket").applyInArrow(_total(classes), SAID)
    counted = written(counted, "counts")
    tokens, words, once, twice = (
        x or 0 for x in counted.agg(F.sum("tokens"), F.sum(F.col("class_words")[0]), F.sum("once"), F.sum("twice")).first()
    )
    top = counted.select(F.explode("top").alias("t")).select("t.*").orderBy(F.desc("n"), "word").limit(classes - 2)
    top = np.array([r["word"] for r in top.collect()], np.int64).view(np.uint64)

    known, facts = Classes(classes, top), counted.limit(0)
    for sweep in range(sweeps + 1):
        counts = np.zeros(classes * classes)
        said = facts.where("kind = 'class'")
        pairs = _asked(corpus, said, _transitions(known), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        for row in pairs.collect():
            counts[row["pair"]] = row["n"]
        counts = counts.reshape(classes, classes)
        if sweep == sweeps:
            break
        share = (counts.sum(axis=0) + 1) / (counts.sum() + classes)
        gain = np.log((counts + BLEND * share) / (counts.sum(axis=1, keepdims=True) + BLEND) / share)
        gain[:, END] = -np.inf
        moved = _asked(corpus, said, _contexts(known, buckets), SENT).groupBy("bucket").applyInArrow(_exchange(gain), SAID)
        facts, known = written(moved, "classes"), Classes(classes)

    sums = {"class_tokens": np.zeros(classes), "class_words": np.zeros(classes)}
    for name, values in sums.items():
        each = facts.where("kind = 'sum'").select(F.posexplode(name).alias("class", "n"))
        for row in each.groupBy("class").agg(F.sum("n").alias("n")).collect():
            values[row["class"]] = row["n"]
    sums["class_tokens"][END], sums["class_words"][END] = ends, 1
    discount = once / (once + 2 * twice) if once and twice else 0.5
    model = Model(tokens + ends, words + (ends > 0), discount, counts, **sums)
    said = counted.where("kind = 'count'").union(facts.where("kind = 'class'"))
    schema = f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return _asked(corpus, said, _score(model, to_arrow_type(rows.schema["id"].dataType)), schema).withColumnRenamed("id", id_col)
