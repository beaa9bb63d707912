"""Alignment of two tokenizers over the corpus: which ids of one stand where ids of the other end.

Tokenizer A is a byte-level vocabulary file, B a sentencepiece model that puts a blank before a text; A gets the same blank. Byte offsets
where tokens of both end cut them into groups. A link is a pair of tokens that end together, so each group has one: that of its last
tokens. The shorter of the two is a suffix of the longer, and no more pairs of ids than (ids) x (bytes of an id) can be linked, whatever
the corpus: their counts are a broadcast of a proven bound, about a million rows.

Texts are cut at single blanks between letters, where tokens of both end (no piece of B has a blank behind another character, which
is checked), and each distinct chunk of a block is encoded and aligned once. An array gives for each A id the B id of the same bytes. Groups
of one token each that agree with it are counted by A id in one vector of the length of the vocabulary for each task; only other groups'
pairs are counted as pairs and shuffled, each distinct pair once a task. The same pass stores each document's numbers and its distinct links with
how often it has them, at most as many as there are pairs; when the counts of the corpus are known, they are looked up for those. Tasks hold one
block of texts (4 MB, or one longer text), the vector and the distinct pairs.

Special tokens' strings in texts are plain text. Texts that are null or empty, or whose tokens of A or B don't spell blank and text,
have no tokens: zeros, no links and an empty ``groups_sha256``. Repeated rows count each time; a null ``doc_id`` is kept. An empty table
gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoweave.llm.blocks import ChunkCache, chunk_spans, distinct_chunks, lean, ragged_take, text_blocks
from chronoweave.llm.common import small_batches, stored, table
from chronoweave.llm.library import ChunkEncoder

#: Head of a chunk's record: tokens of A (-1: bytes differ), tokens of B, groups, bytes of the groups as text. Links and text follow.
_HEAD = 4
#: Chunks of a text that are spelled out at once.
_SPELLED = 1 << 15
_RESULT = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string")


class _Plain(ChunkEncoder):
    """Special tokens' strings are ordinary text."""

    def __init__(self, path: str) -> None:
        super().__init__(path)
        self.tokenizer.encode_special_tokens = True
        self.added = []


class Aligner(ChunkCache):
    """Records of aligned chunks; every chunk starts with a blank."""

    def __init__(self, a_path: str, b_path: str) -> None:
        super().__init__(keep=300_000)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece

        self.a = _Plain(a_path)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = {c: b for b, c in self.a.letters.items()}
        spelled = {i: w for w, i in self.a.tokenizer.get_vocab(with_added_tokens=True).items()}
        a_words = [spelled.get(i, "") for i in range(max(spelled) + 1)]
        self.a_bytes = [bytes(letters[c] for c in w) if all(c in letters for c in w) else w.encode() for w in a_words]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("a piece of B has a blank behind another character; texts can't be cut at blanks")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.width = len(pieces)
        by_bytes = {w: i for i, w in reversed(list(enumerate(self.b_bytes))) if not self.b.is_control(i) and not self.b.is_unknown(i)}
        by_bytes |= {w: i for i, w in enumerate(self.b_bytes) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))}
        #: The B id with the bytes of each A id, or -1.
        self.same = np.array([by_bytes.get(w, -1) for w in self.a_bytes], dtype=np.int64)
        self.a_sizes, self.b_sizes = ([len(w) for w in words] for words in (self.a_bytes, self.b_bytes))
        self.a_digits, self.b_digits = ([str(i) for i in range(len(words))] for words in (self.a_bytes, self.b_bytes))

    def encode_new(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        flat, counts = self.a.encode_new(chunks)
        flat, ends = flat.tolist(), np.cumsum(counts).tolist()
        others = self.b.encode([c[1:].decode("utf-8", "replace") for c in chunks], num_threads=1)
        records, sizes, begin = [], np.empty(len(chunks), dtype=np.int64), 0
        for k, (chunk, end, b) in enumerate(zip(chunks, ends, others, strict=True)):
            record = self._record(chunk, flat[begin:end], b)
            records.append(record)
            sizes[k], begin = len(record) // 4, end
        return np.frombuffer(b"".join(records), dtype=np.int32), sizes

    def _record(self, chunk: bytes, a: list[int], b: list[int]) -> bytes:
        if b"".join([self.a_bytes[i] for i in a]) != chunk or b"".join([self.b_bytes[i] for i in b]) != chunk:
            return np.array([-1, 0, 0, 0], dtype=np.int32).tobytes()
        links, groups, i, j, a_end, b_end = [], [], 0, 0, 0, 0
        while i < len(a):
            a_from, b_from = i, j
            a_end, b_end, i, j = a_end + self.a_sizes[a[i]], b_end + self.b_sizes[b[j]], i + 1, j + 1
            while a_end != b_end:
                if a_end < b_end:
                    a_end, i = a_end + self.a_sizes[a[i]], i + 1
                else:
                    b_end, j = b_end + self.b_sizes[b[j]], j + 1
            links.append(a[i - 1] * self.width + b[j - 1])
            groups.append(f"{','.join([self.a_digits[x] for x in a[a_from:i]])}|{','.join([self.b_digits[x] for x in b[b_from:j]])};")
        text = "".join(groups).encode()
        head = np.array([len(a), len(b), len(groups), len(text), *links], dtype=np.int32)
        return head.tobytes() + text + bytes(-len(text) % 4)


class _Block:
    """The aligned chunks of one block of texts. Texts without bytes have no chunk."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, aligner: Aligner) -> None:
        sizes = np.diff(offsets)
        filled = np.flatnonzero(sizes)
        spaced = np.full(len(data) + len(filled), 0x20, dtype=np.uint8)
        spaced[np.arange(len(data)) + np.repeat(np.arange(1, len(filled) + 1), sizes[filled])] = data
        ends = np.concatenate([[0], np.cumsum(sizes[filled] + 1)])
        bounds, first = chunk_spans(spaced, ends)
        self.index, keys, occurs = distinct_chunks(spaced, bounds)
        self.flat = aligner.flat
        if len(self.index):
            self.starts, _ = aligner.lookup(spaced, bounds, keys, occurs)
            self.flat = aligner.flat
        else:
            self.starts = np.zeros(0, dtype=np.int64)
        self.heads = self.flat[self.starts[:, None] + np.arange(_HEAD)].astype(np.int64)
        #: Chunks of each document, as bounds in ``index``.
        self.first = np.zeros(len(offsets), dtype=np.int64)
        self.first[filled + 1] = np.diff(first)
        self.first = np.cumsum(self.first)
        self.good = self.sums((self.heads[:, 0] < 0).astype(np.int64)) == 0
        self.links_at = np.cumsum(self.heads[:, 2]) - self.heads[:, 2]
        self.links = ragged_take(self.flat, self.starts + _HEAD, self.heads[:, 2]).astype(np.int64)

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sum of a number of each distinct chunk over the chunks of each document."""
        total = np.concatenate([[0], np.cumsum(values[self.index])])
        return total[self.first[1:]] - total[self.first[:-1]]

    def times(self) -> np.ndarray:
        """How often each distinct chunk stands in texts with tokens."""
        counted = np.repeat(self.good, np.diff(self.first))
        return np.bincount(self.index[counted], minlength=len(self.starts))

    def links_of(self, begin: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct links of some documents one behind the other, how often each stands there, and where each document's begin."""
        size, taken = np.diff(self.first[begin : end + 1]), self.index[self.first[begin] : self.first[end]]
        owner = np.repeat(np.arange(end - begin), np.where(self.good[begin:end], size, 0))
        taken = taken[np.repeat(self.good[begin:end], size)]
        chunks, times = np.unique(owner * len(self.starts) + taken, return_counts=True)
        owner, taken = np.divmod(chunks, max(1, len(self.starts)))
        n = self.heads[taken, 2]
        found = ragged_take(self.links, self.links_at[taken], n)
        pairs, at = np.unique((np.repeat(owner, n) << 32) + found, return_inverse=True)
        counts = np.bincount(at, weights=np.repeat(times, n), minlength=len(pairs)).astype(np.int64)
        return pairs & 0xFFFFFFFF, counts, np.searchsorted(pairs >> 32, np.arange(end - begin + 1))

    def spelled(self, document: int) -> str:
        """Digest of the groups of a document, spelled out some chunks at a time."""
        if not self.good[document] or self.first[document] == self.first[document + 1]:
            return ""
        raw, digest = self.flat.view(np.uint8), hashlib.sha256()
        last = int(self.first[document + 1])
        for at in range(int(self.first[document]), last, _SPELLED):
            taken = self.index[at : min(at + _SPELLED, last)]
            begins = 4 * (self.starts[taken] + _HEAD + self.heads[taken, 2])
            text = ragged_take(raw, begins, self.heads[taken, 3])
            digest.update((text[:-1] if at + _SPELLED >= last else text).tobytes())
        return digest.hexdigest()


_STORED = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, links array<bigint>, times array<bigint>, "
    "vector array<bigint>, pair bigint, n bigint")
_LONGS = pa.list_(pa.int64())
_KINDS = {"bigint": pa.int64(), "string": pa.string(), "array<bigint>": _LONGS}
#: Documents whose links are put together at once hold about so many chunks.
_TOGETHER = 1 << 18


def _rows(size: int, /, **columns: pa.Array) -> pa.RecordBatch:
    names, kinds = zip(*[c.rsplit(" ", 1) for c in _STORED.split(", ")], strict=True)
    return pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(size, _KINDS[k])) for c, k in zip(names, kinds, strict=True)], names=list(names))


def _aligned(a_path: str, b_path: str):
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each document; at the end one vector of counts of the task, and its distinct pairs of irregular groups."""
        aligner = Aligner.load(a_path, b_path)
        vector = np.zeros(len(aligner.same), dtype=np.int64)
        pairs, counts = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        for batch in batches:
            for begin, end, data, offsets in text_blocks(batch.column(1)):
                block = _Block(data, offsets, aligner)
                times = np.repeat(block.times(), block.heads[:, 2])
                a, b = np.divmod(block.links, aligner.width)
                regular = aligner.same[a] == b
                vector += np.bincount(a[regular], weights=times[regular], minlength=len(vector)).astype(np.int64)
                met = ~regular & (times > 0)
                pairs, at = np.unique(np.concatenate([pairs, block.links[met]]), return_inverse=True)
                counts = np.bincount(at, weights=np.concatenate([counts, times[met]]), minlength=len(pairs)).astype(np.int64)
                numbers = [np.where(block.good, block.sums(block.heads[:, k]), 0) for k in range(3)]
                some, documents = 0, end - begin
                while some < documents:
                    to = int(np.searchsorted(block.first, block.first[some] + _TOGETHER, side="right")) - 1
                    to = min(max(to, some + 1), documents)
                    links, own, bounds = block.links_of(some, to)
                    lists = [pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(x)) for x in (links, own)]
                    yield _rows(to - some, doc_id=batch.column(0).slice(begin + some, to - some), links=lists[0], times=lists[1],
                        groups_sha256=pa.array([block.spelled(k) for k in range(some, to)], pa.string()),
                        **{name: pa.array(x[some:to]) for name, x in zip(("n_a", "n_b", "n_groups"), numbers, strict=True)})
                    some = to
        yield _rows(1, vector=pa.ListArray.from_arrays(pa.array([0, len(vector)], pa.int32()), pa.array(vector)))
        for k in range(0, len(pairs), 10_000):
            part = slice(k, k + 10_000)
            yield _rows(len(pairs[part]), pair=pa.array(pairs[part]), n=pa.array(counts[part]))

    return align


def _counts(found: DataFrame, aligner: Aligner) -> DataFrame:
    vectors = found.filter("vector IS NOT NULL").select(F.posexplode("vector").alias("a", "n")).filter("n > 0")
    twin = F.get(F.from_json(F.lit(str(aligner.same.tolist())), "array<int>"), F.col("a"))
    regular = vectors.select((F.col("a").cast("bigint") * aligner.width + twin).alias("pair"), "n")
    pairs = regular.unionByName(found.filter("pair IS NOT NULL").select("pair", "n")).groupBy("pair").agg(F.sum("n").alias("n"))
    return pairs.select(F.floor(F.col("pair") / aligner.width).cast("int").alias("a"), F.pmod("pair", F.lit(aligner.width)).cast("int").alias("b"), "n")


def _pass(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    small_batches(docs.sparkSession)
    return stored(docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(lean(_aligned(a_path, b_path), resident=True), _STORED), "aligned")


def link_counts(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``a, b, n``: how many links of the corpus hold each pair of ids."""
    return _counts(_pass(docs, a_path, b_path), Aligner.load(a_path, b_path))


def _score(known):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Columns are doc_id, n_a, n_b, n_groups, groups_sha256, links, times."""
        pairs, counts, best = known.value
        for batch in batches:
            links, times = (batch.column(k).flatten().to_numpy(zero_copy_only=False) for k in (5, 6))
            sizes = np.diff(batch.column(5).offsets.to_numpy())
            ends = np.cumsum(sizes)
            at = np.searchsorted(pairs, links)
            sums = []
            for values in (times * best[at], times * counts[at]):
                total = np.concatenate([[0], np.cumsum(values)])
                sums.append(pa.array((total[ends] - total[ends - sizes]).astype(np.int64)))
            columns = [*(batch.column(k) for k in range(4)), batch.column(3), *sums, batch.column(4)]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _RESULT.split(", ")])

    return score


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row of ``docs (doc_id, text)``."""
    done = _pass(docs, a_path, b_path)
    aligner = Aligner.load(a_path, b_path)
    found = _counts(done, aligner).toArrow()  # bounded by the vocabularies, see above
    a, b, n = (found.column(c).to_numpy() for c in ("a", "b", "n"))
    pair = a.astype(np.int64) * aligner.width + b
    most = np.zeros(int(b.max()) + 1 if len(b) else 0, dtype=np.int64)
    np.maximum.at(most, b, n)
    order = np.argsort(pair)
    known = docs.sparkSession.sparkContext.broadcast((pair[order], n[order], (n == most[b]).astype(np.int64)[order]))
    rows = done.filter("n_a IS NOT NULL").select("doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links", "times")
    return rows.mapInArrow(lean(_score(known)), _RESULT)


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return align(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"))
