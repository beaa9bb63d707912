"""Toxicity: bags of subwords, averaged into a linear softmax, both trained jointly in numpy.

A word is the mean of the vectors of its character n-grams (hashed to a fixed number of buckets), so a misspelling shares most of
its vectors with the word it comes from. A text is cut into segments of ``SEGMENT`` consecutive words; the bag of a segment holds each
of its different words once. Bags are averaged, and a document scores as its worst segment, however long it is. Vectors and softmax are trained together on a bounded sample of labelled documents:
first on whole documents, then on the worst segment of each.

Training takes at most ``SAMPLE`` documents of each class, the ones whose ids hash lowest, none of the held-out fold, with their
whole texts. Every document is scored on its whole text.
Null and empty texts have no words and get the score of an empty bag. Repeated rows score alike. An empty table gives
an empty result; without labels of both classes all scores are 0. Other columns than ``text`` and ``doc_id`` are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoweave.llm.blocks import lean, mix, ragged_take, text_blocks, word_hashes, word_spans
from chronoweave.llm.common import held_out, known_labels, small_batches, table, with_score

SAMPLE = 2_000
SEGMENT = 24
#: Bytes of text that training encodes, and words of bags that a step takes, at once; a longer document counts as one.
ENCODED, TAKEN = 1 << 20, 1 << 18
BUCKETS = 1 << 15
WIDTH = 4
SIZES = (3, 4, 5)
_PRIME = np.uint64(0x100000001B3)


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of ``<word>``, the whole included, and how many each word has."""
    points = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    lengths = np.array([len(w) + 2 for w in words], dtype=np.int64)
    ends = np.cumsum(lengths)
    room = np.repeat(ends, lengths) - np.arange(len(points))
    owner = np.repeat(np.arange(len(words)), lengths)
    found, owners = [], []
    for size in SIZES:
        n = max(0, len(points) - size + 1)
        total = np.full(n, size, dtype=np.uint64)
        for k in range(size):
            total = total * _PRIME + points[k : k + n]
        fits = room[:n] >= size
        found.append((mix(total[fits]) % np.uint64(BUCKETS)).astype(np.int32))
        owners.append(owner[:n][fits])
    whole = np.zeros(len(words), dtype=np.uint64)
    if len(words):
        whole = np.add.reduceat(mix(points + _PRIME * (np.arange(len(points)) - np.repeat(ends - lengths, lengths))
                .astype(np.uint64)), ends - lengths)
    found.append((mix(whole) % np.uint64(BUCKETS)).astype(np.int32))
    owners.append(np.arange(len(words)))
    owners = np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return np.concatenate(found)[order], np.bincount(owners, minlength=len(words))


def block_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """The bags of all segments of a block, one behind the other, as indices into its distinct words; where each bag starts; the first
    segment of each document (one more at the end); and the distinct words, lower-cased."""
    starts, ends, first = word_spans(data, offsets)
    coded = pa.array(word_hashes(data, starts, ends)).dictionary_encode()
    index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    seen = np.zeros(len(coded.dictionary), dtype=np.int64)
    seen[index[::-1]] = np.arange(len(index) - 1, -1, -1)
    raw = data.tobytes()
    words = [raw[a:b].decode("utf-8", "replace").lower() for a, b in zip(starts[seen].tolist(), ends[seen].tolist(), strict=True)]
    bounds, first_segment = segment_bounds(first, SEGMENT)
    segment = np.repeat(np.arange(len(bounds)), np.diff(np.append(bounds, len(index))))
    fresh = np.ones(len(index), dtype=bool)
    for lag in range(1, SEGMENT):
        fresh[lag:] &= (index[lag:] != index[:-lag]) | (segment[lag:] != segment[:-lag])
    return index[fresh], np.concatenate([[0], np.cumsum(fresh)])[bounds], first_segment, words


def segment_bounds(first: np.ndarray, segment: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of segments of words, and each document's first segment; a document without words has none."""
    counts = np.diff(first)
    pieces = -(-counts // segment)
    before = np.cumsum(pieces) - pieces
    owner = np.repeat(np.arange(len(counts)), pieces)
    return first[:-1][owner] + segment * (np.arange(len(owner)) - before[owner]), np.append(before, before[-1]
        + pieces[-1]) if len(counts) else np.zeros(1, np.int64)


def segment_means(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of the values of each segment over the segment length; segments tile the words, a short one counts as filled up with zeros."""
    return np.add.reduceat(values, starts) / SEGMENT if len(starts) else np.zeros(0)


def worst(values: np.ndarray, first: np.ndarray, empty: float) -> np.ndarray:
    """Largest value of each document; ``empty`` where it has none."""
    out = np.full(len(first) - 1, empty)
    some = np.flatnonzero(np.diff(first) > 0)
    if len(some):
        out[some] = np.maximum.reduceat(values, first[some])
    return out


def encoded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """``block_words`` of all texts, encoded in blocks of ``ENCODED`` bytes."""
    known: dict[str, int] = {}
    parts, lengths, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for _, _, data, offsets in text_blocks(pa.array(texts, pa.large_binary()), ENCODED):
        index, starts, first_segment, words = block_words(data, offsets)
        parts.append(np.array([known.setdefault(w, len(known)) for w in words], dtype=np.int32)[index])
        lengths.append(np.diff(np.append(starts, len(index))))
        counts.append(np.diff(first_segment))
    lengths = np.concatenate(lengths)
    return np.concatenate(parts), np.cumsum(lengths) - lengths, np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int64), list(known)


class SubwordSoftmax:
    """Subword vectors and a two-class softmax over the mean of a bag."""

    def __init__(self, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.vectors = (rng.normal(size=(BUCKETS, WIDTH)) * 0.1).astype(np.float32)
        self.weights = (rng.normal(size=(WIDTH, 2)) * 0.5).astype(np.float32)
        self.bias = np.zeros(2, dtype=np.float32)

    def train(self, texts: list[bytes], labels: np.ndarray, warm: int = 2, epochs: int = 130, rate: float = 0.7) -> None:
        """Gradient descent with momentum: ``warm`` steps on documents, then ``epochs`` on segments (the worst, for label 0 some more).

        Steps are scaled by the largest gradient, not one by one, so subwords that say little stay near where they began.
        """
        index, starts, first_segment, words = encoded(texts)
        if not len(index):
            return
        parts = [subwords(words[at : at + 20_000]) for at in range(0, len(words), 20_000)]
        grams, counts = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
        del parts, words
        begins = np.cumsum(counts) - counts
        first = np.append(starts, len(index))[first_segment]
        lengths = np.diff(np.append(starts, len(index)))
        documents = np.repeat(np.arange(len(texts)), np.diff(first_segment))
        rng = np.random.default_rng(11)
        momenta = [np.zeros(p.shape) for p in (self.vectors, self.weights, self.bias)]
        share = np.where(labels == 1, 0.5 / max(1, labels.sum()), 0.5 / max(1, (labels == 0).sum()))
        some = np.diff(first) > 0
        clean = np.flatnonzero(labels[documents] == 0)
        for epoch in range(warm + epochs):
            if epoch < warm:
                bag_of, bag_starts, bag_lengths = np.flatnonzero(some), first[:-1][some], np.diff(first)[some]
                part = np.ones(len(bag_of))
            else:
                of_buckets = self.vectors @ (self.weights[:, 1] - self.weights[:, 0])
                level = segment_means((np.add.reduceat(of_buckets[grams], begins) / counts)[index], starts)
                ranked = np.lexsort((-level, documents))
                place = np.arange(len(ranked)) - first_segment[documents[ranked]]
                top = ranked[(place == 0) | ((place == 1) & (labels[documents[ranked]] == 0))]
                other = rng.choice(clean, size=2 * len(texts)) if len(clean) else clean
                chosen = np.concatenate([top, other])
                bag_of, bag_starts, bag_lengths = documents[chosen], starts[chosen], lengths[chosen]
                part = np.concatenate([np.where(labels[documents[top]] == 1, 1.0, 0.5), np.full(len(other), 0.1)])
            gradients = [np.zeros(p.shape) for p in (self.vectors, self.weights, self.bias)]
            cuts = np.flatnonzero(np.diff(np.cumsum(bag_lengths) // TAKEN)) + 1
            for some_bags in np.split(np.arange(len(bag_of)), cuts):
                of, weight = bag_of[some_bags], part[some_bags]
                for gradient, more in zip(gradients, self._gradients(index, begins, counts, grams, bag_starts[some_bags],
                            bag_lengths[some_bags], labels[of], share[of] * weight), strict=True):
                    gradient += more
            left = rate * (1 - epoch / (warm + epochs))
            for parameter, gradient, momentum, step in zip((self.vectors, self.weights, self.bias), gradients, momenta,
                    (left, 0.1 * left, 0.1 * left), strict=True):
                momentum *= 0.8
                momentum += gradient
                parameter -= (step * momentum / (np.abs(momentum).max() + 1e-12)).astype(np.float32)
        of_buckets = self.vectors @ (self.weights[:, 1] - self.weights[:, 0])
        level = segment_means((np.add.reduceat(of_buckets[grams], begins) / counts)[index], starts)
        self._settle(worst(level, first_segment, 0.0) + float(self.bias[1] - self.bias[0]), labels)

    def _gradients(self, index: np.ndarray, begins: np.ndarray, counts: np.ndarray, grams: np.ndarray, starts: np.ndarray,
            lengths: np.ndarray, labels: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, ...]:
        """Gradients of vectors, weights and bias, summed over some bags of words ``index[start : start + length]``."""
        taken = ragged_take(index, starts, lengths)
        used, place = np.unique(taken, return_inverse=True)
        flat = ragged_take(grams, begins[used], counts[used])
        of_words = np.add.reduceat(self.vectors[flat], np.cumsum(counts[used]) - counts[used], axis=0) / counts[used][:, None]
        divisor = np.maximum(lengths, SEGMENT)[:, None]
        bags = np.add.reduceat(of_words[place], np.cumsum(lengths) - lengths, axis=0) / divisor
        logits = bags @ self.weights + self.bias
        logits -= logits.max(axis=1, keepdims=True)
        odds = np.exp(logits)
        odds /= odds.sum(axis=1, keepdims=True)
        odds[np.arange(len(labels)), labels] -= 1
        odds *= share[:, None]
        down = (odds @ self.weights.T) / divisor
        spread = np.repeat(np.arange(len(labels)), lengths)
        per_word = np.stack([np.bincount(place, down[spread, k], minlength=len(used)) for k in range(WIDTH)], axis=1) / counts[used][:, None]
        wide = np.repeat(np.arange(len(used)), counts[used])
        return np.stack([np.bincount(flat, per_word[wide, k], minlength=BUCKETS) for k in range(WIDTH)], axis=1), bags.T @ odds, odds.sum(axis=0)

    def _settle(self, logits: np.ndarray, labels: np.ndarray) -> None:
        """Shift the bias to the middle of the shifts that err least on the training documents; a false alarm costs four times as much."""
        shifts = np.linspace(-4, 4, 161)
        loss = np.array([(logits[labels == 1] + s < 0).mean() + 4 * (logits[labels == 0] + s >= 0).mean() for s in shifts])
        self.bias[1] += np.float32(shifts[loss <= loss.min() + 1e-3].mean())

    def table(self) -> tuple[np.ndarray, float]:
        """The logit of each bucket, and of the bias: all that scoring needs."""
        return (self.vectors @ (self.weights[:, 1] - self.weights[:, 0])).astype(np.float64), float(self.bias[1] - self.bias[0])

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return score_block(data, offsets, *self.table())


def score_block(data: np.ndarray, offsets: np.ndarray, levels: np.ndarray, bias: float) -> np.ndarray:
    """Probability of each document of a block: its worst segment's."""
    index, starts, first_segment, words = block_words(data, offsets)
    if not len(words):
        return np.full(len(offsets) - 1, 1 / (1 + np.exp(-bias)))
    grams, counts = subwords(words)
    of_words = np.add.reduceat(levels[grams], np.cumsum(counts) - counts) / counts
    logits = worst(segment_means(of_words[index], starts), first_segment, 0.0) + bias
    return 1 / (1 + np.exp(-np.clip(logits, -60, 60)))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, each: int) -> DataFrame:
    """``doc_id, label, text`` of at most ``each`` documents of each class that are not held out, those whose ids hash lowest.

    Of several texts of an id the one with the lowest hash counts.
    """
    known = known_labels(labels, label)
    chosen = [known.filter(F.col("label") == k).orderBy(F.xxhash64("doc_id", F.lit(label)), "doc_id").limit(each) for k in (0, 1)]
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("binary"), F.lit(b""))
        .alias("text")).join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id")
    return rows.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.first("label").alias("label"),
        F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", each: int = SAMPLE) -> SubwordSoftmax | None:
    """Train on the sample; its number of rows bounds what reaches the driver, their texts are whole."""
    small_batches(docs.sparkSession)
    rows = labelled_sample(docs, labels, label, each).toArrow().sort_by("doc_id")
    known = rows.column("label").to_numpy()
    if len(set(known.tolist())) < 2:
        return None
    model = SubwordSoftmax()
    texts = rows.column("text").to_pylist()
    del rows
    model.train(texts, known)
    return model


def _scorer(levels: np.ndarray | None, bias: float):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [score_block(data, offsets, levels, bias) if levels is not None else np.zeros(end - begin)
                for begin, end, data, offsets in text_blocks(batch.column(0))]
            columns = [batch.column(k) for k in range(1, batch.num_columns)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.concatenate(parts) if parts else np.zeros(0))],
                names=[*batch.schema.names[1:], "score"])

    return score


def score_documents(docs: DataFrame, model: SubwordSoftmax | None) -> DataFrame:
    """``doc_id, score`` of every document."""
    levels, bias = model.table() if model else (None, 0.0)
    return docs.select("text", F.col("doc_id").cast("bigint")).mapInArrow(lean(_scorer(levels, bias)), "doc_id bigint, score double")


def reject(docs: DataFrame, labels: DataFrame, most: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``most``; trained on ``docs`` and ``labels``. Without labels all stay."""
    model = fit(docs, labels)
    if model is None:
        return docs
    levels, bias = model.table()
    return with_score(docs, lambda data, offsets: score_block(data, offsets, levels, bias),
        "__cw_score").filter(F.col("__cw_score") < most).drop("__cw_score")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scores = score_documents(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scores.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
