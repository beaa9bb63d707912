"""Shingle sets of documents and their SuperMinHash signatures, for one block of documents inside a task."""

from __future__ import annotations

import numpy as np

from chronoweave.llm.blocks import mix, span_keys, text_blocks, window_hashes, word_spans

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEP = np.uint64(0xD1B54A32D192ED03)


def _distinct(words: np.ndarray, first: np.ndarray, shingle: int) -> list[np.ndarray]:
    """The sorted distinct shingles of each document of a block of words."""
    grams, sets = window_hashes(words, shingle), []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= shingle:
            sets.append(np.unique(grams[a : b - shingle + 1]))
        elif b > a:
            sets.append(window_hashes(words[a:b], b - a) ^ np.uint64(b - a))
        else:
            sets.append(grams[:0])
    return sets


def shingle_sets(column, shingle: int, block: int = 4 << 20):
    """Yield ``(first row, end row, sets, ids)``: for each row its sorted distinct shingle hashes, and 128 bits that know the set.

    Letters A-Z are lower-cased. A text with fewer words than a shingle has its whole sequence as one; one without words has none.
    The two halves of ``ids`` come from hashes that are independent of each other from the bytes on; empty sets have zeros.
    """
    for begin, end, data, offsets in text_blocks(column, block):
        data = _LOWER[data]
        starts, ends, first = word_spans(data, offsets)
        sets = _distinct(span_keys(data, starts, ends), first, shingle)
        others = _distinct(span_keys(data, starts, ends, 1), first, shingle)
        ids = np.array([(np.bitwise_xor.reduce(mix(s)), mix(o).sum(dtype=np.uint64)) if len(s) else (0, 0)
                for s, o in zip(sets, others, strict=True)], dtype=np.uint64).reshape(-1, 2)
        yield begin, end, sets, ids


def signatures(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """SuperMinHash: every element fills the slots along its own permutation, with rank plus a fraction as value; the least value stays.

    A document is finished as soon as all its slots hold less than the next rank, so long ones stop after a rank or two. Empty
    sets keep infinite slots.
    """
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    out = np.full((len(sets), slots), np.inf)
    if not sizes.sum():
        return out
    elements = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    flat = out.reshape(-1)
    order = None
    for rank in range(slots):
        draw = mix(elements + np.uint64(int(_STEP) * (2 * rank + 1) % (1 << 64)))
        value = rank + (draw >> np.uint64(11)).astype(np.float64) * 2.0**-53
        place = rank + (mix(draw ^ _STEP) % np.uint64(slots - rank)).astype(np.int64)
        if rank == 0:
            slot = place
        else:
            rows = np.arange(len(elements))
            slot = order[rows, place].astype(np.int64)
            order[rows, place] = order[:, rank]
        np.minimum.at(flat, owner * slots + slot, value)
        open_documents = out.max(axis=1) >= rank + 1
        stay = open_documents[owner]
        if not stay.any():
            break
        if rank == 0:
            elements, owner, place = elements[stay], owner[stay], place[stay]
            order = np.tile(np.arange(slots, dtype=np.int16), (len(elements), 1))
            order[np.arange(len(elements)), place] = 0
        elif stay.mean() < 0.7:
            elements, owner, order = elements[stay], owner[stay], order[stay]
    return out


def band_hashes(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit hash for each band of ``rows`` slots."""
    bits = mix(signature.view(np.uint64)).reshape(len(signature), bands, rows)
    total = np.arange(1, bands + 1, dtype=np.uint64)[None, :] * _STEP
    for k in range(rows):
        total = mix(total + bits[:, :, k])
    return total
