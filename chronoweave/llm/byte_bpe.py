"""Byte-level BPE from a rank file: ids of whole texts, and the way back.

Distinct words of a block of documents are folded at once: as byte arrays, each round merges in every word its leftmost pair of the
lowest rank, by a literal table from pairs of ids to ranks. Words that are known from earlier blocks aren't folded again.
Nothing is shuffled, so cost is linear in the text whatever the skew. Decoding concatenates the binary pieces of the ids.

Null and empty texts have no ids and decode to nothing. Rows with the same ``doc_id`` are encoded each for itself. An empty table
gives an empty result. Columns besides ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoweave.llm.blocks import ChunkCache, encode_block, lean, ragged_take, text_blocks
from chronoweave.llm.common import small_batches, table

#: Longer words are folded one by one with a heap, whose cost is n log n.
LONG_WORD = 64
_NONE = np.int64(1 << 40)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}


class RankFold(ChunkCache):
    """Encodes distinct chunks by ranks and a split pattern."""

    def __init__(self, path: str, pattern: str) -> None:
        super().__init__()
        import regex

        self.findall = regex.compile(pattern).findall
        self.ranks = read_ranks(path)
        self.pieces = {rank: word for word, rank in self.ranks.items()}
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        self.base = max(self.pieces) + 1
        pairs = {}
        for word, rank in self.ranks.items():
            for i in range(1, len(word)):
                left, right = self.ranks.get(word[:i]), self.ranks.get(word[i:])
                if left is not None and right is not None:
                    pairs[left * self.base + right] = rank
        self.pair_keys = np.array(sorted(pairs), dtype=np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], dtype=np.int64)
        self.first = self._ranks_of(np.repeat(self.byte_ids, 256), np.tile(self.byte_ids, 256)).reshape(256, 256)

    def _ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.base + right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], _NONE)

    def fold(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and lengths of words, all merged in step."""
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        ids = self.byte_ids[data]
        owner = np.repeat(np.arange(len(words)), lengths)
        ranks = np.full(len(data), _NONE)
        ranks[:-1] = self.first[data[:-1], data[1:]]
        ranks[np.cumsum(lengths) - 1] = _NONE
        done_ids, done_owner = [], []
        while len(ids):
            starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            sizes = np.diff(np.append(starts, len(ids)))
            best = np.minimum.reduceat(ranks, starts)
            settled = best == _NONE
            if settled.any():
                out = np.repeat(settled, sizes)
                done_ids.append(ids[out])
                done_owner.append(owner[out])
                ids, owner, ranks = ids[~out], owner[~out], ranks[~out]
                best, sizes = best[~settled], sizes[~settled]
                if not len(ids):
                    break
            hits = np.flatnonzero(ranks == np.repeat(best, sizes))
            hits = hits[np.concatenate([[True], owner[hits[1:]] != owner[hits[:-1]]])]
            ids[hits] = ranks[hits]
            keep = np.ones(len(ids), dtype=bool)
            keep[hits + 1] = False
            ids, owner, ranks = ids[keep], owner[keep], ranks[keep]
            hits -= np.arange(len(hits))
            for at in (hits, hits - 1):  # the merged pair's right and left neighbours
                here = at[(at >= 0) & (at + 1 < len(ids))]
                here = here[owner[here] == owner[here + 1]]
                ranks[here] = self._ranks_of(ids[here], ids[here + 1])
            last = hits[(hits + 1 == len(ids)) | (owner[np.minimum(hits + 1, len(ids) - 1)] != owner[hits])]
            ranks[last] = _NONE
        owner = np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        return np.concatenate(done_ids)[order], np.bincount(owner, minlength=len(words))

    def fold_long(self, word: bytes) -> list[int]:
        """The same for one long word, with a heap of pairs."""
        ids = [int(self.byte_ids[b]) for b in word]
        after, before = [*range(1, len(ids)), -1], [-1, *range(len(ids) - 1)]
        known = dict(zip(self.pair_keys.tolist(), self.pair_ranks.tolist(), strict=True)) if not hasattr(self, "_pairs") else self._pairs
        self._pairs = known
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(len(ids) - 1) if (r := known.get(ids[i] * self.base + ids[i + 1])) is not None]
        heapq.heapify(heap)
        alive = [True] * len(ids)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j < 0 or ids[i] != left or ids[j] != right:
                continue
            ids[i], alive[j] = rank, False
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a in (before[i], i):
                b = after[a] if a >= 0 else -1
                if b >= 0 and (r := known.get(ids[a] * self.base + ids[b])) is not None:
                    heapq.heappush(heap, (r, a, ids[a], ids[b]))
        return [x for x, here in zip(ids, alive, strict=True) if here]

    def encode_new(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        number: dict[bytes, int] = {}
        index: list[int] = []
        counts = np.zeros(len(chunks), dtype=np.int64)
        for i, chunk in enumerate(chunks):
            text = chunk.decode("utf-8", "replace")
            if text.isascii() and text[text[:1] == " " :].isalpha():
                index.append(number.setdefault(chunk, len(number)))
                counts[i] = 1
                continue
            found = self.findall(text)
            counts[i] = len(found)
            index += [number.setdefault(x.encode(), len(number)) for x in found]
        words = list(number)
        lengths = np.zeros(len(words), dtype=np.int64)
        short, flats = [], {}
        for i, word in enumerate(words):
            whole = self.ranks.get(word)
            if whole is not None:
                flats[i] = [whole]
            elif len(word) > LONG_WORD:
                flats[i] = self.fold_long(word)
            else:
                short.append(i)
        folded, sizes = self.fold([words[i] for i in short]) if short else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        lengths[short] = sizes
        for i, ids in flats.items():
            lengths[i] = len(ids)
        flat = np.empty(int(lengths.sum()), dtype=np.int64)
        own = np.zeros(len(words), dtype=bool)
        own[short] = True
        mask = np.repeat(own, lengths)
        flat[mask] = folded
        flat[~mask] = [x for i in sorted(flats) for x in flats[i]]
        index = np.array(index, dtype=np.int64)
        starts = np.cumsum(lengths) - lengths
        ends = np.cumsum(counts)
        sums = np.concatenate([[0], np.cumsum(lengths[index])])
        return ragged_take(flat, starts[index], lengths[index]), sums[ends] - sums[ends - counts]


def _encoder(path: str, pattern: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = RankFold.load(path, pattern)
        for batch in batches:
            for first, end, data, offsets in text_blocks(batch.column(1)):
                ids = list(encode_block(data, offsets, cache))
                bounds = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                tokens = pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(ids).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), tokens], names=["doc_id", "tokens"])

    return encode


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id`` and ``tokens array<int>`` of every whole text."""
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(lean(_encoder(path, pattern), resident=True),
        "doc_id bigint, tokens array<int>")


def _decoder(path: str):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = {rank: word for word, rank in read_ranks(path).items()}.__getitem__
        for batch in (whole.slice(at, 500) for whole in batches for at in range(0, whole.num_rows, 500)):
            tokens = batch.column(1)
            bounds = tokens.offsets.to_pylist()
            values = tokens.values.to_numpy(zero_copy_only=False)
            ids, text = [], []
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                ids.append(hashlib.sha256(values[a:b].astype("<u4").tobytes()).hexdigest())
                text.append(b"".join(map(piece, values[a:b].tolist())))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(bounds).astype(np.int64)),
                    pa.array(ids, pa.string()), pa.array(text, pa.binary())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded"])

    return decode


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The binary text of every row of ids, with their number and digest."""
    return encoded.select("doc_id", "tokens").mapInArrow(lean(_decoder(path), resident=True),
        "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``decode(encode(docs))`` in one Python worker instead of two."""
    small_batches(docs.sparkSession)
    there, back = _encoder(path, pattern), _decoder(path)
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(lean(lambda batches: back(there(batches)),
            resident=True), "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded binary")


def pair_ranks(ranks: dict[bytes, int]) -> tuple[list[int], list[int]]:
    """The literal rank table: ascending keys ``left id * base + right id`` of all pairs that merge, and the id that each merges into."""
    base = max(ranks.values()) + 1
    pairs = {}
    for word, rank in ranks.items():
        for i in range(1, len(word)):
            left, right = ranks.get(word[:i]), ranks.get(word[i:])
            if left is not None and right is not None:
                pairs[left * base + right] = rank
    keys = sorted(pairs)
    return keys, [pairs[k] for k in keys]


def fold_words(words: DataFrame, path: str) -> DataFrame:
    """``word binary, tokens array<int>`` of distinct words, folded by Spark's higher-order functions alone.

    The state of the fold is the array of ids, at first one for each byte; every step merges the leftmost pair of the lowest rank, found by
    binary search in a literal table, until no pair has a rank. README has its cost beside that of ``encode``.
    """
    ranks = read_ranks(path)
    keys, merged = pair_ranks(ranks)
    base = max(ranks.values()) + 1
    literal = lambda values, kind: F.from_json(F.lit(str(values)), f"array<{kind}>")
    table, ids = literal(keys, "bigint"), literal(merged, "int")
    steps = F.array(*[F.lit(1 << k) for k in range(len(keys).bit_length() - 1, -1, -1)])
    byte_ids = literal([ranks[bytes([b])] for b in range(256)], "int")
    none = F.lit(base)

    def rank_of(left, right):
        key = left.cast("bigint") * base + right
        at = F.aggregate(steps, F.lit(0), lambda a, step: a + F.when(F.get(table, a + step - 1) <= key, step).otherwise(0))
        return F.when(F.get(table, at - 1) == key, F.get(ids, at - 1)).otherwise(none)

    def merge(state, _):
        pairs = F.transform(F.slice(state, 1, F.greatest(F.size(state) - 1, F.lit(0))),
            lambda left, i: F.struct(rank_of(left, F.get(state, i + 1)).alias("rank"), i.alias("i")))
        spliced = lambda best: F.concat(F.slice(state, 1, best["i"]), F.array(best["rank"]),
            F.slice(state, best["i"] + 3, F.size(state)))
        # One element, so that the best pair is named once and not computed at each of its uses.
        return F.get(F.transform(F.array(F.array_min(pairs)), lambda best: F.when(best.isNull() | (best["rank"] == none),
                    state).otherwise(spliced(best))), 0)

    digits = F.regexp_extract_all(F.hex("word"), F.lit("(..)"), F.lit(1))
    start = F.transform(digits, lambda h: F.get(byte_ids, F.conv(h, 16, 10).cast("int")))
    rounds = F.when(F.octet_length("word") > 1, F.sequence(F.lit(2), F.octet_length("word"))).otherwise(F.array().cast("array<int>"))
    return words.select("word", F.aggregate(rounds, start, merge).alias("tokens"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return round_trip(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN).select("doc_id", "n_tokens",
        "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
