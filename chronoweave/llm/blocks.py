"""Arrow-side helpers: texts of one record batch as flat numpy buffers.

Everything here works on one bounded block of documents inside a Spark task.
"""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes of text that are handled at once; a longer document is a block of its own.
BLOCK_BYTES = 4 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Last bytes and lead bytes after or before which a blank may touch a non-ASCII white space character.
_LEADS = np.zeros(256, dtype=bool)
_LEADS[[0xC2, 0xE1, 0xE2, 0xE3]] = True

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
#: Seed and factor of the chains of ``span_keys``, the factor of ``joined``, and masks of the first 0 to 8 bytes of a lane.
_CHAINS = [(np.uint64(0x2D358DCCAA6C78A5), np.uint64(0x8BB84B93962EACC9)), (np.uint64(0x4B33A62ED433D4A3), np.uint64(0xAAAAAAAAAAAAAAAB))]
_JOIN = np.uint64(0x9FB21C651E98DF25)
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)
#: Longest span that is read eight bytes at a time.
LONG_SPAN = 256
_BYTE_VALUE = np.random.Generator(np.random.PCG64(20240611)).integers(1, 1 << 63, size=256, dtype=np.uint64) | np.uint64(1)


def text_blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield ``(first row, end row, bytes, offsets)`` of runs of rows of at most ``limit`` bytes; null texts are empty."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = pc.fill_null(column, b"")
    rows = len(column)
    if not rows:
        return
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, dtype=np.int64)[column.offset : column.offset + rows + 1]
    data = np.frombuffer(data_buffer, dtype=np.uint8) if data_buffer is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < rows:
        end = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        end = min(max(end, first + 1), rows)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` of a block, and for each document the index of its first word (one more at the end)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    begins[cuts] = inside[cuts]
    stops[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(starts, offsets, side="left")


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, kept between calls up to one segment."""
    if len(_POWERS.get("up", ())) < n:
        ones = np.full(n, _BASE, dtype=np.uint64)
        ones[0] = 1
        _POWERS["up"] = np.cumprod(ones, dtype=np.uint64)
        ones = np.full(n, _BASE_INVERSE, dtype=np.uint64)
        ones[0] = 1
        _POWERS["down"] = np.cumprod(ones, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: a bijection that spreads every bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, segment: int = 1 << 20) -> np.ndarray:
    """A 64-bit polynomial hash of each span; spans ascend and don't overlap. Memory is bounded by a segment or the longest word.

    For features of classifiers only: some unlike words of over 1,000 letters share a hash, whatever the base. ``span_keys`` has no such pairs.
    """
    out = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        base = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, base + segment, side="right")))
        part = data[base : int(ends[to - 1])]
        up, down = _powers(len(part) + 1)
        sums = np.empty(len(part) + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(_BYTE_VALUE[part] * up[: len(part)], out=sums[1:])
        s, e = starts[at:to] - base, ends[at:to] - base
        out[at:to] = (sums[e] - sums[s]) * down[s]
        at = to
    return mix(out)


def _lanes(padded: np.ndarray) -> np.ndarray:
    """The eight bytes from every place of a buffer on, as one number each; nothing is copied."""
    return np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))


def padded(data: np.ndarray) -> np.ndarray:
    """A copy with eight zero bytes behind it, so that eight bytes can be read from every place."""
    return np.concatenate([data, np.zeros(8, dtype=np.uint8)])


def span_keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, chain: int = 0) -> np.ndarray:
    """A 64-bit key of the bytes of each span; the two chains are independent of each other from the bytes on.

    Eight bytes at a time go through a mixing step, so that no two spans are equal by the structure of their letters; spans of over
    ``LONG_SPAN`` bytes get the halves of a 128-bit xxh3.
    """
    seed, factor = _CHAINS[chain]
    lengths = ends - starts
    whole = padded(data)
    lanes = _lanes(whole)
    keys = mix((lanes[starts] & _KEEP[np.minimum(lengths, 8)]) * factor + (lengths.astype(np.uint64) ^ seed))
    rest, at = np.flatnonzero(lengths > 8), 8
    while len(rest) and at < LONG_SPAN:
        keys[rest] = mix((keys[rest] ^ (lanes[starts[rest] + at] & _KEEP[np.minimum(lengths[rest] - at, 8)])) * factor + seed)
        at += 8
        rest = rest[lengths[rest] > at]
    for i in np.flatnonzero(lengths > LONG_SPAN).tolist():
        digest = xxhash.xxh3_128_intdigest(data[starts[i] : ends[i]].tobytes())
        keys[i] = (digest >> (64 * chain)) & _MASK
    return keys


def same_spans(a: np.ndarray, a_starts: np.ndarray, b: np.ndarray, b_starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether spans of two padded buffers, each pair of one length, hold the same bytes."""
    one, other = _lanes(a), _lanes(b)
    same = ((one[a_starts] ^ other[b_starts]) & _KEEP[np.minimum(lengths, 8)]) == 0
    rest, at = np.flatnonzero(same & (lengths > 8)), 8
    while len(rest) and at < LONG_SPAN:
        differs = (one[a_starts[rest] + at] ^ other[b_starts[rest] + at]) & _KEEP[np.minimum(lengths[rest] - at, 8)]
        same[rest[differs != 0]] = False
        at += 8
        rest = rest[(differs == 0) & (lengths[rest] > at)]
    for i in rest.tolist():
        same[i] = np.array_equal(a[a_starts[i] : a_starts[i] + lengths[i]], b[b_starts[i] : b_starts[i] + lengths[i]])
    return same


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A hash of two hashes in this order."""
    return mix(left * _JOIN + right)


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive items, order included (``len - width + 1`` values)."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    # Doubling: hashes of runs of 1, 2, 4 ... items are joined to the wanted width.
    total, part, size, done, rest = None, words, 1, 0, width
    while True:
        if rest & 1:
            piece = part[done : done + n]
            total = piece if total is None else joined(total, piece)
            done += size
        rest >>= 1
        if not rest:
            return mix(total)
        part = joined(part[:-size], part[size:])
        size *= 2


def chunk_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of chunks that tile the block, and each document's first chunk (one more at the end).

    A chunk starts at each document and at each single blank between two characters that are no white space. The split patterns of
    byte-level vocabularies never match across such a place, so chunks are encoded one by one with the same result.
    """
    n = len(data)
    cut = np.zeros(n + 1, dtype=bool)
    if n > 2:
        blank = np.flatnonzero(data[1:-1] == 0x20) + 1
        before, after = data[blank - 1], data[blank + 1]
        good = ~(_SPACE[before] | _SPACE[after] | _LEADS[after] | (after == 0x85) | (after == 0xA0))
        good &= ~((before >= 0x1C) & (before <= 0x1F)) & ~((after >= 0x1C) & (after <= 0x1F))
        two, three = data[np.maximum(blank - 2, 0)], data[np.maximum(blank - 3, 0)]
        good &= ~((before >= 0x80) & ((two == 0xC2) | ((two >= 0x80) & (three >= 0xE1) & (three <= 0xE3))))
        cut[blank[good]] = True
    cut[offsets] = True
    bounds = np.flatnonzero(cut)
    if not n:
        return np.zeros(1, np.int64), np.zeros(len(offsets), np.int64)
    return bounds, np.searchsorted(bounds, offsets, side="left")


def distinct_chunks(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of each chunk among the distinct ones, their 64-bit keys, and where each of them occurs first. Bytes are compared."""
    starts, lengths = bounds[:-1], np.diff(bounds)
    keys = span_keys(data, starts, bounds[1:])
    coded = pa.array(keys).dictionary_encode()
    index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    first = np.empty(len(coded.dictionary), dtype=np.int64)
    first[index[::-1]] = np.arange(len(index) - 1, -1, -1)
    peer, whole = first[index], padded(data)
    wrong = np.flatnonzero((lengths != lengths[peer]) | ~same_spans(whole, starts, whole, starts[peer], np.minimum(lengths, lengths[peer])))
    if len(wrong):  # unlike chunks with one key
        more: dict[bytes, int] = {}
        for i in wrong.tolist():
            index[i] = more.setdefault(data[bounds[i] : bounds[i + 1]].tobytes(), len(first) + len(more))
        _, at = np.unique(index[wrong], return_index=True)
        first = np.concatenate([first, wrong[at]])
    return index, keys[first], first


def ragged_take(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices ``flat[start : start + length]`` one behind the other."""
    total = int(lengths.sum())
    if not total:
        return flat[:0]
    ends = np.cumsum(lengths)
    return flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


#: The one cache of encoded chunks that a Python worker keeps between tasks.
_RESIDENT: dict[tuple, "ChunkCache"] = {}


def lean(function: Callable, resident: bool = False) -> Callable:
    """A function of batches that leaves its worker small: workers are used again by other stages, and memory that is free goes back.

    Only a function that is ``resident`` keeps the cache of chunks for the next task.
    """

    @functools.wraps(function)
    def run(batches):
        if not resident:
            _RESIDENT.clear()
        try:
            yield from function(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return run


class ChunkCache:
    """Ids of chunks, encoded when first met and kept for the next blocks of the Python worker, at most ``keep`` chunks.

    A subclass has ``encode_new(list of bytes) -> (flat ids, lengths)``. Chunks are found by their key, in one sorted array, and their bytes
    are compared.
    """

    def __init__(self, keep: int = 600_000) -> None:
        self.keep = keep
        self.keys = np.zeros(0, dtype=np.uint64)
        self.places = np.zeros(0, dtype=np.int32)
        self.flat = np.zeros(1 << 16, dtype=np.int32)
        self.ends = np.zeros(1 << 14, dtype=np.int64)
        self.slots = 0
        self.text = np.zeros(8, dtype=np.uint8)  # bytes of the kept chunks, padded
        self.text_bounds = np.zeros(1, dtype=np.int64)

    @classmethod
    def load(cls, *arguments) -> "ChunkCache":
        """The worker's cache of this class and these arguments; any other one is let go."""
        key = (cls, *arguments)
        if key not in _RESIDENT:
            _RESIDENT.clear()
            _RESIDENT[key] = cls(*arguments)
        return _RESIDENT[key]

    def encode_new(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        raise NotImplementedError

    def _append(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        used = int(self.ends[self.slots - 1]) if self.slots else 0
        if used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat[:used], np.zeros(used // 2 + 2 * len(flat), dtype=np.int32)])
        if self.slots + len(lengths) > len(self.ends):
            self.ends = np.concatenate([self.ends[: self.slots], np.zeros(self.slots // 2 + 2 * len(lengths), dtype=np.int64)])
        self.flat[used : used + len(flat)] = flat
        self.ends[self.slots : self.slots + len(lengths)] = used + np.cumsum(lengths)
        self.slots += len(lengths)

    def lookup(self, data: np.ndarray, bounds: np.ndarray, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and length in ``flat`` of each distinct chunk."""
        self.slots = len(self.keys)  # drops what the last block had beyond the kept chunks
        slots = np.full(len(hashes), -1, dtype=np.int64)
        order = np.argsort(hashes)
        if len(self.keys):
            ordered = hashes[order]
            at = np.minimum(np.searchsorted(self.keys, ordered), len(self.keys) - 1)
            hit = np.flatnonzero(self.keys[at] == ordered)
            here, slot = first[order[hit]], self.places[at[hit]].astype(np.int64)
            sizes = bounds[here + 1] - bounds[here]
            known = self.text_bounds[slot + 1] - self.text_bounds[slot]
            same = (sizes == known) & same_spans(padded(data), bounds[here], self.text, self.text_bounds[slot], np.minimum(sizes, known))
            slots[order[hit[same]]] = slot[same]
        new = np.flatnonzero(slots < 0)
        for part in range(0, len(new), 1 << 14):
            some = new[part : part + (1 << 14)]
            at = first[some]
            slots[some] = np.arange(self.slots, self.slots + len(some))
            self._append(*self.encode_new([data[b:e].tobytes() for b, e in zip(bounds[at].tolist(), bounds[at + 1].tolist(), strict=True)]))
        kept = new[: self.keep - len(self.keys)]
        if len(kept):
            sizes = bounds[first[kept] + 1] - bounds[first[kept]]
            self.text = padded(np.concatenate([self.text[:-8], ragged_take(data, bounds[first[kept]], sizes)]))
            self.text_bounds = np.concatenate([self.text_bounds, self.text_bounds[-1] + np.cumsum(sizes)])
            keys = np.concatenate([self.keys, hashes[kept]])
            order = np.argsort(keys, kind="stable")
            self.keys, self.places = keys[order], np.concatenate([self.places, slots[kept].astype(np.int32)])[order]
        ends = self.ends[slots]
        starts = np.where(slots > 0, self.ends[slots - 1], 0)
        return starts, ends - starts


def encode_block(data: np.ndarray, offsets: np.ndarray, cache: ChunkCache) -> Iterator[np.ndarray]:
    """Yield the ids of each document of a block."""
    bounds, first = chunk_spans(data, offsets)
    index, hashes, occurs = distinct_chunks(data, bounds)
    starts, lengths = cache.lookup(data, bounds, hashes, occurs)
    document = 0
    documents = len(offsets) - 1
    while document < documents:  # some documents at a time, so that index arrays stay small
        end = max(document + 1, int(np.searchsorted(first, first[document] + (1 << 17), side="right")) - 1)
        end = min(end, documents)
        taken = index[first[document] : first[end]]
        sizes = lengths[taken]
        flat = ragged_take(cache.flat, starts[taken], sizes)
        sums = np.concatenate([[0], np.cumsum(sizes)])
        at = sums[first[document : end + 1] - first[document]]
        for k in range(end - document):
            yield flat[at[k] : at[k + 1]]
        document = end
