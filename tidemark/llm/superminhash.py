"""SuperMinHash signatures of sets of hashes, for many sets at once."""

from __future__ import annotations

import numpy as np

from tidemark.llm.words import mix

#: Elements whose permutations are held in memory at once.
ELEMENTS = 1 << 18


def signatures(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """One row of ``slots`` numbers per set; equal slots estimate the Jaccard similarity.

    Every element draws a random permutation of the slots. In round ``j`` it offers
    ``j + r``, with ``r`` random below 1, to the slot its permutation has at ``j``, and a
    slot keeps its smallest offer (``j`` in the high half, ``r`` in the low half). A set
    whose largest kept offer is below ``j + 1`` gains nothing from later rounds and
    stops. Empty sets give a row of the largest number.
    """
    out = np.full((len(sets), slots), np.iinfo(np.uint64).max, np.uint64)
    first = 0
    while first < len(sets):
        last, total = first, 0
        while last < len(sets) and (last == first or total + len(sets[last]) <= ELEMENTS):
            total += len(sets[last])
            last += 1
        _fill(out[first:last], sets[first:last], slots)
        first = last
    return out


def _fill(rows: np.ndarray, sets: list[np.ndarray], slots: int) -> None:
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    element = np.concatenate(sets).astype(np.uint64)
    order = None
    flat = rows.reshape(-1)
    for j in range(slots):
        if not len(element):
            return
        drawn = mix(element + np.uint64(0x9E3779B97F4A7C15 * (j + 1) % (1 << 64)))
        low = drawn & np.uint64(0xFFFFFFFF)
        pick = j + ((low * np.uint64(slots - j)) >> np.uint64(32)).astype(np.int64)
        offer = (np.uint64(j) << np.uint64(32)) | (drawn >> np.uint64(32))
        if order is None:  # the first swap of a fresh permutation needs no lookup
            slot = pick
        else:
            here = np.arange(len(element))
            slot = order[here, pick].astype(np.int64)
            order[here, pick] = order[:, j]
        np.minimum.at(flat, owner * slots + slot, offer)
        going = (rows.max(axis=1) >> np.uint64(32)) > j
        going &= sizes > 0
        stay = going[owner]
        if order is None:
            order = np.tile(np.arange(slots, dtype=np.uint16), (int(stay.sum()), 1))
            first = pick[stay]
            order[np.arange(len(first)), first] = 0
        elif not stay.all():
            order = order[stay]
        owner, element = owner[stay], element[stay]
