"""Words of texts and hashes of runs of words, as numpy arrays.

A word is a run of bytes other than space and the controls 9 to 13, which is what
``bytes.split`` without an argument takes.
"""

from __future__ import annotations

import ctypes
import inspect
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import xxhash

#: Odd multipliers of the two rolling hashes.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def words_of(text: str | None, lower: bool = False) -> list[bytes]:
    """The words of a text, A-Z made small if asked; none for a null or blank text."""
    data = (text or "").encode("utf-8", "surrogatepass")
    return (data.lower() if lower else data).split()


class WordTable(dict):
    """Numbers words in the order in which they are first seen."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))

    def hashes(self) -> np.ndarray:
        """Two 64-bit hashes for each word: an array of (words, 2)."""
        digests = b"".join(map(xxhash.xxh3_128_digest, self))
        return np.frombuffer(digests, np.uint64).reshape(-1, 2)


class Batch:
    """Words of several texts end to end: their hashes, and where each text begins."""

    def __init__(self, texts: Iterable[str | None], lower: bool = False):
        table, parts = WordTable(), []
        for text in texts:
            parts.append(table.numbers(words_of(text, lower)))
        self.starts = np.zeros(len(parts) + 1, np.int64)
        np.cumsum([len(x) for x in parts], out=self.starts[1:])
        self.numbers = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        self.table = table
        self._hashes = table.hashes()

    def hashes(self, which: int) -> np.ndarray:
        return self._hashes[self.numbers, which]

    def runs(self, width: int, which: int) -> np.ndarray:
        """Hash of the ``width`` words from each position on; see ``whole_runs`` for the valid ones."""
        return rolling(self.hashes(which), width, BASES[which])

    def whole_runs(self, width: int) -> np.ndarray:
        """Positions at which a run of ``width`` words lies in one text."""
        ends = np.repeat(self.starts[1:], np.diff(self.starts))
        return np.flatnonzero(np.arange(len(ends)) + width <= ends)


def rolling(values: np.ndarray, width: int, base: int) -> np.ndarray:
    """Rabin-Karp hash modulo 2**64 of every ``width`` consecutive values.

    Runs of doubling length are put together, so that a width costs a few passes
    over the array: hash(a followed by b) = hash(a) * base**len(b) + hash(b).
    """
    if len(values) < width:
        return np.zeros(0, np.uint64)
    power = lambda n: np.uint64(pow(base, n, 1 << 64))
    run, size, whole, whole_size = values.astype(np.uint64), 1, None, 0
    while True:
        if width & 1:
            if whole is None:
                whole = run
            else:
                n = len(whole) - size
                whole = run[:n] * power(whole_size) + whole[size:]
            whole_size += size
        width >>= 1
        if not width:
            return whole
        run = run[:-size] * power(size) + run[size:]
        size *= 2


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys, high bytes first and byte by byte, which compresses well."""
    return np.ascontiguousarray(keys.astype(">u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack_sorted(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(">u8").ravel().astype(np.uint64)


def give_back() -> None:
    """Returns freed memory to the system, so that a worker waiting for its next task holds little.

    Allocators keep what large arrays once took. Called after each large group or batch;
    where the system's library has no such call, nothing happens.
    """
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def lean(run: Callable) -> Callable:
    """A function of one or two tables that gives its memory back when it is done."""

    def one(table):
        try:
            return run(table)
        finally:
            give_back()

    def two(first, second):
        try:
            return run(first, second)
        finally:
            give_back()

    return one if len(inspect.signature(run).parameters) == 1 else two
