"""Byte-pair encoding and decoding of texts by rounds of merges over numpy arrays."""

from __future__ import annotations

import heapq
import json
import os
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType
from tokenizers import PreTokenizedString, Tokenizer

from tidemark.llm.portions import portions, spread
from tidemark.llm.words import give_back

#: The vocabulary, looked up among the public files unless it is a path.
VOCABULARY = "byte_bpe_50k.json"
#: Bytes of text, or of ids, that a task takes at a time.
PORTION = 1 << 20
#: Distinct words, and characters in them, after which a worker forgets their ids.
REMEMBERED, HELD = 400_000, 16 << 20
#: Words of more bytes are merged by rank rather than by rounds.
LONG = 64
#: Rank of two symbols that no rule merges.
NO_RULE = np.iinfo(np.int64).max

#: What some library may take for white space.
WHITE = r"[\s\x1c-\x1f\x85\u180e\u200b-\u200f\u2028-\u202f\u205f-\u206f\ufeff]"
#: A space between two other characters: words never go across it.
CUT = re.compile(f"(?<!{WHITE}) (?!{WHITE})")
#: Characters beyond the Latin ones, on whose classes libraries may differ, and rare controls.
UNSURE = re.compile(r"[\x1c-\x1f\x85\u0250-\U0010ffff]")


def _latin(kind: str) -> str:
    return "".join(chr(c) for c in range(0x80, 0x250) if unicodedata.category(chr(c))[0] == kind)


#: The pattern of the vocabulary's pre-tokeniser for Latin texts.
LATIN_WORDS = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z{L}]+| ?[0-9{N}]+| ?[^\t-\r \xa0A-Za-z{L}0-9{N}]+"
    r"|[\t-\r \xa0]+(?![^\t-\r \xa0])|[\t-\r \xa0]+".replace("{L}", _latin("L")).replace("{N}", _latin("N"))
)


class Words(dict):
    """Numbers words in the order in which they are first seen, and lists the new ones."""

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


def byte_letters() -> dict[str, int]:
    """The letter by which byte-level vocabularies write each byte: itself if printable, else the next from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


class MergeRules:
    """A byte-level BPE vocabulary as arrays: sorted pair keys with ranks and results, and the bytes of every id."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        model, splitter = told["model"], told["pre_tokenizer"]
        plain = not (model["dropout"] or model["continuing_subword_prefix"] or model["end_of_word_suffix"])
        if model["type"] != "BPE" or not plain or told["normalizer"] or told["post_processor"]:
            raise ValueError("not a plain byte-level BPE vocabulary")
        if splitter["type"] != "ByteLevel" or splitter["add_prefix_space"] or not splitter["use_regex"]:
            raise ValueError("not the byte-level pre-tokeniser")
        added = told["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError("added tokens must stand for their text alone")
        self.splitter = Tokenizer.from_file(path).pre_tokenizer
        self.added = {t["content"]: t["id"] for t in added}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.specials = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if added else None

        letters, vocab = byte_letters(), model["vocab"]
        self.of_byte = np.array([vocab[c] for c in sorted(letters, key=letters.get)], np.int64)
        self.size = 1 + max(chain(vocab.values(), self.added.values()))
        made = dict.fromkeys(self.of_byte.tolist(), -1)
        left, right, result = (np.empty(len(model["merges"]), np.int64) for _ in range(3))
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            left[rank], right[rank], result[rank] = vocab[a], vocab[b], vocab[a + b]
            if vocab[a] not in made or vocab[b] not in made or vocab[a + b] in made:
                raise ValueError(f"merge {rank} has parts that no earlier merge makes, or a result that one does")
            made[vocab[a + b]] = rank
        keys = left * self.size + right
        self.ranks = np.argsort(keys, kind="stable")
        self.keys, self.results = keys[self.ranks], result[self.ranks]

        texts = [b""] * self.size
        for token, number in chain(vocab.items(), self.added.items()):
            known = all(c in letters for c in token)
            texts[number] = bytes(letters[c] for c in token) if known else token.encode()
        self.byte_counts = np.array([len(t) for t in texts], np.int64)
        self.byte_starts = np.cumsum(self.byte_counts) - self.byte_counts
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)
        self._forget()

    def rules(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each pair of neighbours its rank, ``NO_RULE`` without one, and its place among the sorted keys."""
        wanted = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], NO_RULE), at

    # -- merges --------------------------------------------------------------

    def merged(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of non-empty words end to end, and how many each word has."""
        sizes = np.array([len(w) for w in words], np.int64)
        ids = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        counts = np.empty(len(words), np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        for which, run in ((sizes <= LONG, self._by_rounds), (sizes > LONG, self._by_rank)):
            chosen = np.flatnonzero(which)
            if len(chosen):
                starts = np.cumsum(sizes) - sizes
                out, owner = run(ids[spread(starts[chosen], sizes[chosen])], sizes[chosen])
                counts[chosen] = np.bincount(owner, minlength=len(chosen))
                parts.append((out, chosen[owner]))
        flat, owner = (np.concatenate(x) for x in zip(*parts))
        return flat[np.argsort(owner, kind="stable")], counts

    def _by_rounds(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """In every round each word merges its pair of lowest rank, wherever it stands, from left to right.

        A result's own pairs rank behind the rule that made it, so a word's ranks rise from
        round to round and merging all places at once is the same as one after another.
        Words without a pair left leave the arrays.
        """
        owner = np.repeat(np.arange(len(sizes)), sizes)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        ranks, at = np.full(len(ids), NO_RULE), np.zeros(len(ids), np.int64)
        asked = np.flatnonzero(owner[1:] == owner[:-1])
        while len(ids):
            ranks[asked], at[asked] = self.rules(ids[asked], ids[asked + 1])
            first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            lengths = np.diff(np.append(first, len(ids)))
            lowest = np.repeat(np.minimum.reduceat(ranks, first), lengths)
            stays = lowest != NO_RULE
            if not stays.all():
                done.append((ids[~stays], owner[~stays]))
            # Of three equal symbols in a row, the first two merge.
            places = np.flatnonzero((ranks == lowest) & stays)
            fresh = np.concatenate(([True], np.diff(places) > 1))[: len(places)]
            places = places[(places - places[fresh][np.cumsum(fresh) - 1]) % 2 == 0]
            ids[places] = self.results[at[places]]
            ranks[places] = NO_RULE
            new = np.zeros(len(ids), bool)
            new[places] = True
            stays[places + 1] = False
            ids, owner, ranks, at, new = ids[stays], owner[stays], ranks[stays], at[stays], new[stays]
            # Only the pairs on both sides of a result are new.
            beside = owner[1:] == owner[:-1]
            asked = np.flatnonzero(beside & (new[1:] | new[:-1]))
            ranks[np.flatnonzero(new & ~np.append(beside, False))] = NO_RULE
        flat, owners = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(owners, kind="stable")
        return flat[order], owners[order]

    def _by_rank(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same merges for long words: all places of one rank at a time, over symbols linked both ways.

        Only the pairs beside a merge are looked up again, so a word of any length costs
        in proportion to it, besides one step per rank that occurs.
        """
        owner = np.repeat(np.arange(len(sizes)), sizes)
        n = len(ids)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        ends = np.cumsum(sizes)
        after[ends - 1] = -1
        before[ends - sizes] = -1
        alive, ranks, at = np.ones(n, bool), np.full(n, NO_RULE), np.zeros(n, np.int64)
        waiting: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def look_up(places: np.ndarray) -> None:
            places = places[after[places] >= 0]
            ranks[places], at[places] = self.rules(ids[places], ids[after[places]])
            places = places[ranks[places] != NO_RULE]
            order = places[np.argsort(ranks[places], kind="stable")]
            cuts = np.flatnonzero(np.diff(ranks[order])) + 1
            for group in np.split(order, cuts) if len(order) else ():
                rank = int(ranks[group[0]])
                if rank not in waiting:
                    waiting[rank] = []
                    heapq.heappush(queue, rank)
                waiting[rank].append(group)

        look_up(np.flatnonzero(after >= 0))
        while queue:
            rank = heapq.heappop(queue)
            places = np.unique(np.concatenate(waiting.pop(rank)))
            places = places[alive[places] & (ranks[places] == rank)]
            if not len(places):
                continue
            chained = np.concatenate(([False], after[places[:-1]] == places[1:]))
            run = np.flatnonzero(~chained)[np.cumsum(~chained) - 1]
            places = places[(np.arange(len(places)) - run) % 2 == 0]
            gone = after[places]
            ids[places] = self.results[at[places]]
            alive[gone] = False
            after[places] = after[gone]
            ranks[places] = NO_RULE
            later = after[places] >= 0
            before[after[places[later]]] = places[later]
            earlier = before[places]
            earlier = earlier[earlier >= 0]
            ranks[earlier] = NO_RULE
            look_up(np.unique(np.concatenate((places, earlier))))
        return ids[alive], owner[alive]

    # -- texts ---------------------------------------------------------------

    def words(self, text: str) -> list[str]:
        """The words of a text without added tokens, within which symbols merge."""
        if not UNSURE.search(text):
            return LATIN_WORDS.findall(text)
        first, *rest = CUT.split(text)
        words = self._split(first)
        for piece in rest:
            words += self._split(" " + piece)
        return words

    def _split(self, piece: str) -> list[str]:
        if not UNSURE.search(piece):
            return LATIN_WORDS.findall(piece)
        split = PreTokenizedString(piece)
        self.splitter.pre_tokenize(split)
        places = [place for _, place, _ in split.get_splits(offset_referential="original", offset_type="char")]
        return [piece[start:stop] for start, stop in places]

    def _parts(self, text: str) -> list[str]:
        """The words and added tokens of a text."""
        if not self.specials:
            return self.words(text)
        first, *rest = self.specials.split(text)
        parts = self.words(first)
        for special, between in zip(rest[::2], rest[1::2]):
            parts.append(special)
            parts += self.words(between)
        return parts

    def _forget(self) -> None:
        """Leaves no word known but the added tokens."""
        self.known, self.held = Words(), 0
        for token in self.added:
            self.known[token]
        self.known.new.clear()
        self.ids = np.array(list(self.added.values()), np.int32)
        self.lengths = np.ones(len(self.added), np.int32)

    def _learn(self, words: list[str]) -> None:
        """Adds the ids of new words to those of the known ones."""
        ids, counts = self.merged([word.encode() for word in words])
        self.ids = np.concatenate((self.ids, ids.astype(np.int32)))
        self.lengths = np.concatenate((self.lengths, counts.astype(np.int32)))
        self.held += sum(map(len, words))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and how many each text has."""
        if len(self.known) > REMEMBERED or self.held > HELD:
            self._forget()
        rows = []
        for text in texts:
            words = self._parts(text)
            rows.append(np.fromiter(map(self.known.__getitem__, words), np.int32, len(words)))
        if self.known.new:
            self._learn(self.known.new)
            self.known.new.clear()
        numbers = np.concatenate(rows) if rows else np.zeros(0, np.int32)
        counts = np.array([self.lengths[row].sum(dtype=np.int64) for row in rows], np.int64)
        starts = np.cumsum(self.lengths, dtype=np.int64) - self.lengths
        return self.ids[spread(starts[numbers], self.lengths[numbers])], counts

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
        """The texts of rows of ids; ids outside the vocabulary give nothing, broken UTF-8 gives U+FFFD."""
        known = (ids >= 0) & (ids < self.size)
        safe = np.where(known, ids, 0)
        lengths = np.where(known, self.byte_counts[safe], 0)
        data = self.bytes[spread(self.byte_starts[safe], lengths)]
        cuts = np.concatenate(([0], np.cumsum(lengths)))[np.concatenate(([0], np.cumsum(counts)))]
        raw = data.tobytes()
        inner = cuts[cuts < len(data)]
        try:
            raw.decode()
            whole = not ((data[inner] & 0xC0) == 0x80).any()
        except UnicodeDecodeError:
            whole = False
        if whole:
            return pa.Array.from_buffers(pa.large_utf8(), len(counts), [None, pa.py_buffer(cuts), pa.py_buffer(raw)])
        rows = [raw[start:stop].decode(errors="replace") for start, stop in zip(cuts[:-1], cuts[1:])]
        return pa.array(rows, pa.large_utf8())


_rules: dict[str, MergeRules] = {}


def rules_of(vocabulary: str) -> MergeRules:
    """The rules of a vocabulary, loaded once per worker."""
    if vocabulary not in _rules:
        path = vocabulary if os.path.isabs(vocabulary) else public_tokenizers.path(vocabulary)
        _rules[vocabulary] = MergeRules(path)
    return _rules[vocabulary]


def encoded(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY
) -> DataFrame:
    """The token ids of every whole text, as the vocabulary's own library gives them: ``id_col``, ``ids``.

    Texts are split into words by the vocabulary's pattern, and by its own pre-tokeniser
    around characters on whose classes libraries differ. The symbols of a batch's distinct
    words lie in one flat array in which every round merges each word's pair of lowest
    rank, found by binary search among the sorted pair keys. A worker remembers some short
    words, which changes no result. Strings of added tokens become their ids.

    Null and empty texts have no ids; texts of any length are encoded whole, also words of
    millions of bytes. Repeated rows and ids are rows of their own, a null id stays null,
    other columns are ignored, whatever their names, and an empty table gives no rows.
    Nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = rules_of(vocabulary)
        for part in portions(batches, "text", PORTION):
            texts = [text or "" for text in part.column("text").to_pylist()]
            ids, counts = rules.encode(texts)
            ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            rows = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([part.column("id"), rows], names=["id", "ids"])
        give_back()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decoded(
    rows: DataFrame, ids_col: str = "ids", out_col: str = "decoded", vocabulary: str = VOCABULARY
) -> DataFrame:
    """All columns of ``rows``, and in ``out_col`` the text that the ids stand for, added tokens included.

    Null ids give a null text, no ids the empty one; null and unknown ids within a row are
    passed over, and bytes that are no UTF-8 become U+FFFD, as in the vocabulary's own library.
    ``out_col`` replaces a column of that name. Nothing is shuffled.
    """
    kept = [f for f in rows.schema.fields if f.name != out_col]
    schema = StructType([*kept, StructField(out_col, StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = rules_of(vocabulary)
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.schema.get_field_index(ids_col)
            ends = np.asarray(batch.column(column).offsets)
            start = 0
            while start < batch.num_rows:
                stop = max(start + 1, int(np.searchsorted(ends, ends[start] + PORTION // 4, "right")) - 1)
                part = batch.slice(start, stop - start)
                ids = part.column(column)
                counts = np.diff(np.asarray(ids.offsets)).astype(np.int64)
                flat = ids.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
                counts[np.asarray(ids.is_null())] = 0
                texts = rules.decode(flat.astype(np.int64), counts).cast(pa.utf8())
                if ids.null_count:
                    texts = pa.array([None if null else text for null, text in zip(ids.is_null().to_pylist(), texts.to_pylist())])
                columns = [part.column(f.name) for f in kept] + [texts]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
                start = stop
        give_back()

    whole = rows.select(*[rows[f.name] for f in rows.schema.fields if f.name != out_col or f.name == ids_col])
    if not isinstance(whole.schema[ids_col].dataType, ArrayType) or not isinstance(
        whole.schema[ids_col].dataType.elementType, IntegerType
    ):
        whole = whole.withColumn(ids_col, F.col(ids_col).cast("array<int>"))
        schema = StructType([StructField(f.name, whole.schema[f.name].dataType) for f in schema.fields[:-1]] + [schema.fields[-1]])
    return whole.mapInArrow(run, schema)
