"""How the sources of a language differ in their use of frequent terms."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.portions import Numbers, portions
from tidemark.llm.words import give_back
from tidemark.session import written

#: What becomes of each byte: letters and all beyond ASCII are terms, A-Z made small; the rest parts them.
TERM_BYTES = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Ends a complete term; no term holds it.
END = b"\0"
#: Bytes of text a task reads at a time, and after which it closes a unit.
PORTION, UNIT = 1 << 20, 32 << 20
#: Prefixes of the first level have so many bytes; every level doubles them.
FIRST = 4
#: Counts in one group of the comparison of sources, and sources compared in one group with all others.
CHUNK, BLOCK = 1 << 17, 256
#: Cells of the table of shares that is laid out at a time.
CELLS = 1 << 22

#: Units are rows of megabytes: the writer looks at its sizes after each, not after a hundred, so that
#: neither it nor a reader holds all units of a task.
FEW_ROWS = {
    "parquet.block.size": str(8 << 20),
    "parquet.block.size.row.check.min": "1",
    "parquet.page.size.row.check.min": "1",
}

_UNIT = "lang string, sources array<string>, terms binary, widths binary, sizes binary, term binary, n binary"


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers below 2**32 byte by byte, which compresses well; before them, how many bytes the largest takes."""
    width = max(1, -(-int(numbers.max(initial=0)).bit_length() // 8))
    return bytes([width]) + numbers.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width].T.tobytes()


def _unplaned(data: bytes | pa.Buffer) -> np.ndarray:
    """The numbers of ``_planes``, in 32 bits."""
    width = int(np.frombuffer(data, np.uint8, 1)[0])
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1)
    numbers = np.zeros((planes.shape[1], 4), np.uint8)
    numbers[:, :width] = planes.T
    return numbers.view("<u4").ravel()


class _Unit:
    """Documents of one language that a task has read: which distinct terms each holds, and how often."""

    def __init__(self) -> None:
        self.terms = Numbers()
        self.sources: list[str] = []
        self.sizes: list[int] = []
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, texts: list[bytes], sources: list[str]) -> None:
        near = Numbers()  # of this portion: small enough for the processor's memory
        rows, counts = [], []
        for text in texts:
            found = Counter(text.translate(TERM_BYTES).split())
            rows.append(np.fromiter(map(near.__getitem__, found), np.int32, len(found)))
            counts.append(np.fromiter(found.values(), np.int32, len(found)))
        numbers = np.fromiter(map(self.terms.__getitem__, near), np.int32, len(near))
        self.parts.append((numbers[np.concatenate(rows)], np.concatenate(counts)))
        self.sizes.extend(map(len, rows))
        self.sources.extend(sources)

    def row(self, lang: str) -> dict:
        """Terms in the order of their bytes, and one entry for each term of each document in this order.

        A text is shorter than 2**31 bytes, so its counts fit the 32 bits they are given.
        """
        term, n = (np.concatenate(x) for x in zip(*self.parts))
        self.parts.clear()
        terms = pa.array(self.terms, pa.large_binary())
        self.terms.clear()
        by_bytes = pc.sort_indices(terms)
        terms = terms.take(by_bytes)
        place = np.empty(len(terms), np.int32)
        place[by_bytes.to_numpy()] = np.arange(len(terms), dtype=np.int32)
        term = place[term]
        keys = np.repeat(np.arange(len(self.sizes)) << 32, self.sizes)
        keys |= term
        order = np.argsort(keys)
        del keys
        widths = np.asarray(pc.binary_length(terms))
        return {
            "lang": lang,
            "sources": self.sources,
            "terms": terms.buffers()[2].to_pybytes()[: int(widths.sum())] if len(terms) else b"",
            "widths": _planes(widths),
            "sizes": _planes(np.array(self.sizes, np.int64)),
            "term": _planes(term[order]),
            "n": _planes(n[order]),
        }


def term_units(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """The terms of whole texts by unit: what one task has read in one language, up to ``UNIT`` bytes of text.

    Each unit has a number in ``unit``. Units are a scratch table; nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units: dict[str, _Unit] = {}
        held = 0

        def close() -> Iterator[pa.RecordBatch]:
            for lang in list(units):
                yield pa.RecordBatch.from_pylist([units.pop(lang).row(lang)], schema=_arrow_unit())
            give_back()

        for part in portions(batches, "text", PORTION):
            texts = [text.encode() for text in part.column("text").to_pylist()]
            langs, sources = part.column("lang").to_pylist(), part.column("source").to_pylist()
            for lang in dict.fromkeys(langs):
                rows = [n for n, other in enumerate(langs) if other == lang]
                units.setdefault(lang, _Unit()).add([texts[n] for n in rows], [sources[n] for n in rows])
            held += sum(map(len, texts))
            if held >= UNIT:
                yield from close()
                held = 0
        yield from close()

    def column(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    rows = docs.select(
        column(lang_col).alias("lang"), column(source_col).alias("source"), column(text_col).alias("text")
    )
    units = rows.mapInArrow(run, _UNIT)
    return written(units.withColumn("unit", F.monotonically_increasing_id()), "term-units", FEW_ROWS)


def _arrow_unit() -> pa.Schema:
    kinds = {"lang": pa.string(), "sources": pa.list_(pa.string())}
    names = ("lang", "sources", "terms", "widths", "sizes", "term", "n")
    return pa.schema([(name, kinds.get(name, pa.binary())) for name in names])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Units one by one; the discarded ranges, which are many, stay an array, and binary columns buffers."""
    for batch in batches:
        for n in range(batch.num_rows):
            row = {}
            for name in batch.schema.names:
                value = batch.column(name)[n]
                if name == "dead":
                    row[name] = np.zeros(0, np.int64) if value.values is None else value.values.to_numpy()
                else:
                    row[name] = value.as_buffer() if pa.types.is_binary(value.type) else value.as_py()
            yield row
            give_back()


def _terms(row: dict) -> pa.Array:
    ends = np.concatenate((np.zeros(1, np.int64), _unplaned(row["widths"]).cumsum(dtype=np.int64)))
    return pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(row["terms"])])


def _docs(row: dict) -> np.ndarray:
    """For each entry of a unit, which of its documents it is of."""
    sizes = _unplaned(row["sizes"])
    return np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)


def _alive(row: dict, count: int) -> np.ndarray:
    """Which terms lie in no discarded range: terms are sorted, so those with one prefix are a range."""
    marks = np.bincount(row["dead"] >> 32, minlength=count + 1) - np.bincount(row["dead"] & 0xFFFFFFFF, minlength=count + 1)
    return np.cumsum(marks[:-1]) == 0


def _by_unit(units: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``run`` over units one at a time: a batch of all units of a partition grows with the table.

    Where ``_told`` joins by sorting, its rows lie by unit already and nothing moves again.
    """
    return units.groupBy("unit").applyInArrow(run, schema)


def prefix_counts(units: DataFrame, width: int, since: int) -> DataFrame:
    """In how many documents of a unit each prefix of ``width`` bytes stands.

    Columns ``lang``, ``unit``, ``prefix``, ``n``, and the range ``[first, last)`` of the unit's terms that
    have it. Counted are terms in no ``dead`` range that were not complete within ``since``
    bytes; an end mark makes a complete term its own prefix.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            terms = _terms(row)
            lengths = np.asarray(pc.binary_length(terms))
            counted = _alive(row, len(terms)) & (lengths >= since)
            if not counted.any():
                continue
            places = np.flatnonzero(counted)
            some = terms.take(pa.array(places))
            whole = pc.binary_join_element_wise(some, pa.scalar(END, pa.large_binary()), pa.scalar(b"", pa.large_binary()))
            prefixes = pc.if_else(lengths[places] < width, whole, pc.binary_slice(some, 0, width)).dictionary_encode()
            number = np.full(len(terms), -1, np.int32)
            number[places] = prefixes.indices.to_numpy()
            first = np.full(len(prefixes.dictionary), len(terms))
            last = np.zeros(len(first), np.int64)
            np.minimum.at(first, number[places], places)
            np.maximum.at(last, number[places], places + 1)
            doc, prefix = _docs(row), number[_unplaned(row["term"])]
            here = prefix >= 0
            doc, prefix = doc[here], prefix[here]
            # A document's terms are sorted, so equal prefixes of one document are neighbours.
            once = np.concatenate(([True], (doc[1:] != doc[:-1]) | (prefix[1:] != prefix[:-1])))
            counts = np.bincount(prefix[once], minlength=len(first))
            del doc, prefix, once, here
            for start in range(0, len(first), 1 << 16):
                part = slice(start, start + (1 << 16))
                size = len(first[part])
                columns = [
                    pa.array([row["lang"]]).take(pa.array(np.zeros(size, np.int64))),
                    pa.array(np.full(size, row["unit"], np.int64)),
                    prefixes.dictionary[part].cast(pa.binary()),
                    *(pa.array(values[part]) for values in (counts, first, last)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "unit", "prefix", "n", "first", "last"])

    columns = units.select("unit", "lang", "terms", "widths", "sizes", "term", "dead")
    schema = "lang string, unit long, prefix binary, n long, first long, last long"
    # Nothing is discarded before the first level, so its units are read where they lie.
    return _by_unit(columns, run, schema) if since else columns.mapInArrow(run, schema)


def frequent_terms(units: DataFrame, least: int) -> tuple[DataFrame, int]:
    """``units`` with ``dead``, the ranges of their terms that fall out: those in fewer than ``least`` documents of the language.

    A range is one number: where it begins times 2**32, plus where it ends.

    A prefix stands in at least as many documents as any term that begins with it. Level by
    level, prefixes of twice the bytes are counted for the terms still open, and those below
    ``least`` are discarded. A discarded prefix stands in fewer than ``least`` documents, hence in as
    few units, and only these are told. It ends when every term left is complete. The
    width of the last level comes second.
    """
    dead = units.select("unit", F.lit(0).cast("long").alias("range")).where("false")
    since, width = 0, FIRST
    while True:
        counts = written(prefix_counts(_told(units, dead), width, since), "prefix-counts")
        met = counts.select("lang", "prefix", "n").repartition("lang", "prefix")
        sums = written(met.groupBy("lang", "prefix").agg(F.sum("n").alias("n")), "prefixes")
        rare = sums.where(F.col("n") < least).select("lang", "prefix")
        fallen = counts.where(F.col("n") < least).join(rare, ["lang", "prefix"], "left_semi")
        fallen = fallen.select("unit", (F.shiftleft("first", 32) + F.col("last")).alias("range"))
        dead = written(dead.union(fallen), "dead-prefixes")
        complete = F.substring("prefix", -1, 1) == F.lit(END)
        if sums.where((F.col("n") >= least) & ~complete).isEmpty():
            return _told(units, dead), width
        since, width = width, 2 * width


def _told(units: DataFrame, dead: DataFrame) -> DataFrame:
    return units.join(dead.groupBy("unit").agg(F.collect_list("range").alias("dead")), "unit", "left")


def term_counts(units: DataFrame) -> DataFrame:
    """How often each term that is left occurs in each source of its language: ``lang``, ``source``, ``term``, ``n``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            terms, names = _terms(row), sorted(set(row["sources"]))
            alive = _alive(row, len(terms))
            if not alive.any():
                continue
            term = _unplaned(row["term"])
            chosen = alive[term]
            places = {name: at for at, name in enumerate(names)}
            source = np.array([places[name] for name in row["sources"]], np.int64)
            # Arrays of a unit's length go as soon as they are used: they are most of what a task holds.
            keys = source[_docs(row)[chosen]]
            keys *= len(terms)
            keys += term[chosen]
            del term
            order = np.argsort(keys)
            keys, n = keys[order], _unplaned(row["n"])[chosen][order]
            del order, chosen
            first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            pairs, sums = keys[first], np.add.reduceat(n, first, dtype=np.int64)
            del keys, n, first
            texts, sources = terms.cast(pa.large_string()), pa.array(names)
            for start in range(0, len(pairs), 1 << 16):
                part = pairs[start : start + (1 << 16)]
                columns = [
                    pa.array([row["lang"]]).take(pa.array(np.zeros(len(part), np.int64))),
                    sources.take(pa.array(part // len(terms))),
                    texts.take(pa.array(part % len(terms))).cast(pa.string()),
                    pa.array(sums[start : start + (1 << 16)]),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n"])

    columns = units.select("unit", "lang", "sources", "terms", "widths", "sizes", "term", "n", "dead")
    rows = _by_unit(columns, run, "lang string, source string, term string, n long")
    # A unit names each of these once, so there is little to combine before the shuffle.
    keys = ("lang", "source", "term")
    return rows.repartition(*keys).groupBy(*keys).agg(F.sum("n").alias("n"))


def share(n: str, total: str, kept: str, per: int = 1_000_000_000, prior: int = 5):
    """One and the whole part of ``per`` times a smoothed share, in exact arithmetic: decimals where 64 bits could overflow."""
    top = f"cast({per} as decimal(38,0)) * (cast({n} as decimal(38,0)) + {prior})"
    wide = F.expr(f"1 + ({top}) div (cast({total} as decimal(38,0)) + {prior} * cast({kept} as decimal(38,0)))")
    narrow = F.expr(f"1 + ({per}L * (cast({n} as bigint) + {prior})) div ({total} + {prior} * {kept})")
    return F.when(F.expr(f"cast({n} as bigint)") < (1 << 62) // per, narrow).otherwise(wide)


def source_distances(counts: DataFrame, groups: DataFrame, entries: int) -> DataFrame:
    """For every two sources of a language the sum of their differences over all its kept terms.

    ``counts`` has ``lang``, ``source``, ``term`` and the share ``p``; ``groups`` every ``lang`` and ``source``
    with ``p``, its share of a term it lacks. Terms are dealt over groups of ``CHUNK`` counts, sources
    over blocks of ``BLOCK``; each group gives partial sums for its block against all sources.
    """
    chunks = max(1, -(-entries // CHUNK))
    blocks = groups.groupBy("lang").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    block = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    left = counts.join(blocks, "lang").select(
        "lang", F.pmod(F.xxhash64("term"), F.lit(chunks)).cast("int").alias("chunk"), block, "source", "term", "p"
    )
    chunk = F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk")
    right = groups.join(blocks, "lang").select("lang", chunk, "source", "p", "blocks")
    right = right.select("lang", "chunk", block, "source", "p", "blocks")

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        names = right.column("source").to_pylist()
        order = sorted(range(len(names)), key=lambda n: names[n].encode())
        names = [names[n] for n in order]
        lacking = right.column("p").to_numpy()[order]
        place = {name: at for at, name in enumerate(names)}
        own = range(key[2].as_py() * BLOCK, min(len(names), (key[2].as_py() + 1) * BLOCK))
        sums = np.zeros((len(own), len(names)), np.int64)
        if left.num_rows:
            term = left.column("term").combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int64)
            source = left.column("source").combine_chunks().dictionary_encode()
            source = np.array([place[name] for name in source.dictionary.to_pylist()])[source.indices.to_numpy()]
            p = left.column("p").to_numpy()
            order = np.argsort(term, kind="stable")
            term, source, p = term[order], source[order], p[order]
            step = max(1, CELLS // len(names))
            for start in range(0, int(term[-1]) + 1, step):
                stop = min(start + step, int(term[-1]) + 1)
                here = slice(*np.searchsorted(term, (start, stop)))
                shares = np.repeat(lacking[None, :], stop - start, axis=0)
                shares[term[here] - start, source[here]] = p[here]
                for at, one in enumerate(own):
                    sums[at] += np.abs(shares - shares[:, one : one + 1]).sum(axis=0)
        a = np.repeat(np.arange(len(own)), len(names))
        b = np.tile(np.arange(len(names)), len(own))
        other = a + (own.start if len(own) else 0) != b
        texts = pa.array(names, pa.string())
        return pa.table(
            {
                "lang": pa.array([key[0].as_py()] * int(other.sum()), pa.string()),
                "source": texts.take(pa.array(a[other] + (own.start if len(own) else 0))),
                "item": texts.take(pa.array(b[other])),
                "value": pa.array(sums[a[other], b[other]]),
            }
        )

    keys = ["lang", "chunk", "block"]
    partial = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        run, "lang string, source string, item string, value long"
    )
    return partial.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def divergence(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    least: int = 30,
    top: int = 50,
) -> DataFrame:
    """How far the sources of each language are apart, and the terms each uses more than its language does.

    Terms are runs of letters and of characters beyond ASCII, A-Z made small; each language
    keeps those in at least ``least`` of its documents, found by prefix refinement (see
    ``frequent_terms``). Shares are whole numbers of billionths, smoothed by five occurrences
    of every kept term. Part ``pair`` sets each source against every other of its language: the
    sum of the differences of their shares. Part ``term`` lists the ``top`` terms of which a
    source's share exceeds its language's by most.

    Null texts, languages and sources are empty strings. Every row is a document, also
    a repeated one. Sources without terms, and languages without kept terms, have their
    pairs (distance 0 without kept terms). Ties go to the smaller item by UTF-8. Other
    columns are ignored, whatever their names; an empty table gives no rows. A term of any
    length is read whole.

    Columns: ``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``.
    """
    units = term_units(docs, text_col, lang_col, source_col)
    counts = written(term_counts(frequent_terms(units, least)[0]), "term-counts")
    groups = units.select("lang", F.explode(F.array_distinct("sources")).alias("source")).distinct()
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    in_lang = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"))
    langs = in_lang.groupBy("lang").agg(F.sum("lang_n").alias("lang_total"), F.count("*").alias("kept"))
    groups = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0)
    groups = written(groups, "sources")
    has = groups.where("kept > 0")
    shares = counts.join(has.select("lang", "source", "total", "kept", "lang_total"), ["lang", "source"])
    shares = shares.withColumn("p", share("n", "total", "kept"))

    lacking = F.when(F.col("kept") > 0, share("0", "total", "greatest(kept, 1)")).otherwise(0)
    distances = source_distances(
        shares.select("lang", "source", "term", "p"),
        groups.select("lang", "source", lacking.alias("p")),
        counts.count(),
    )
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    pairs = distances.select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    pairs = pairs.withColumn("rank", F.row_number().over(by_value))

    compared = shares.join(in_lang, ["lang", "term"]).withColumn("q", share("lang_n", "lang_total", "kept"))
    above = compared.where("n > 0 and p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value")
    )
    terms = above.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top)
    return pairs.union(terms)
