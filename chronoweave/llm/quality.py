"""Quality of documents: random-indexing word vectors, pooled, and a two-layer network with calibrated probabilities.

Every token has a sparse random index vector, drawn from its hash. A token's word vector is the sum of the index vectors of its
neighbours over the whole corpus, kept for a fixed number of hash buckets; each task sends one partial matrix, and sums by
bucket give the whole. Tokens are runs of letters and digits or runs of other signs. A document's segments are averaged, and the mean,
the largest and the smallest segment averages are its features, so that junk shows up in a part of a long text too. A two-layer network
is trained in numpy on a bounded sample of labelled documents (``SAMPLE``, those whose ids hash lowest, none of the held-out fold); a fifth
of the sample sets the temperature.

Null and empty texts have zero features and are scored like any other. Repeated rows score alike. An empty table gives an empty
result; without labels of both classes all scores are 0.5. Only ``text`` and, for the fold, ``doc_id`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoweave.llm.blocks import lean, mix, text_blocks, word_hashes
from chronoweave.llm.common import held_out, known_labels, small_batches, table, with_score

SAMPLE = 12_000
BUCKETS = 1 << 13
WIDTH = 32
REACH = 2
SEGMENT = 64
HIDDEN = 32

#: 0 white space, 1 letters, digits and bytes of other alphabets, 2 other signs.
_KIND = np.full(256, 2, dtype=np.uint8)
_KIND[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
_KIND[np.r_[48:58, 65:91, 97:123, 128:256]] = 1


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each token of a block, and each document's first token."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    kind = _KIND[data]
    change = np.concatenate([[True], kind[1:] != kind[:-1]])
    change[offsets[offsets < len(data)]] = True
    bounds = np.flatnonzero(change)
    ends = np.append(bounds[1:], len(data))
    words = kind[bounds] > 0
    starts, ends = bounds[words], ends[words]
    return word_hashes(data, starts, ends), np.searchsorted(starts, offsets, side="left")


def _index_places(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two places of a token's index vector, one of +1 and one of -1."""
    draw = mix(hashes ^ np.uint64(0x5851F42D4C957F2D))
    return (draw % np.uint64(WIDTH)).astype(np.int64), ((draw >> np.uint64(32)) % np.uint64(WIDTH)).astype(np.int64)


def context_counts(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the index vectors of neighbours, by bucket."""
    bucket = (hashes % np.uint64(BUCKETS)).astype(np.int64) * WIDTH
    document = np.repeat(np.arange(len(first) - 1), np.diff(first))
    plus, minus = _index_places(hashes)
    total = np.zeros(BUCKETS * WIDTH, dtype=np.int64)
    for lag in range(1, REACH + 1):
        same = document[lag:] == document[:-lag]
        for here, there in ((bucket[lag:], slice(None, -lag)), (bucket[:-lag], slice(lag, None))):
            base = here[same]
            total += np.bincount(base + plus[there][same], minlength=len(total))
            total -= np.bincount(base + minus[there][same], minlength=len(total))
    return total.reshape(BUCKETS, WIDTH)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((BUCKETS, WIDTH), dtype=np.int64)
    for batch in batches:
        for _, _, data, offsets in text_blocks(batch.column(0), 4 << 20):
            total += context_counts(*tokens(data, offsets))
    used = np.flatnonzero(np.abs(total).sum(axis=1))
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(used) + 1, dtype=np.int32) * WIDTH), pa.array(total[used].ravel()))
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), lists], names=["bucket", "sums"])


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        rows = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH)
        for bucket, row in zip(batch.column(0).to_pylist(), rows, strict=True):
            total[bucket] = total[bucket] + row if bucket in total else row.copy()
    used = sorted(total)
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(used) + 1, dtype=np.int32) * WIDTH),
        pa.array(np.concatenate([total[b] for b in used]) if used else np.zeros(0, np.int64)))
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), lists], names=["bucket", "sums"])


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Word vectors of all buckets, from every text: ``BUCKETS`` rows of ``WIDTH`` numbers reach the driver, however large the corpus."""
    small_batches(docs.sparkSession)
    schema = "bucket int, sums array<bigint>"
    rows = docs.select("text").mapInArrow(lean(_count), schema).repartition("bucket").mapInArrow(lean(_add), schema).toArrow()
    vectors = np.zeros((BUCKETS, WIDTH))
    if rows.num_rows:
        vectors[rows.column(0).to_numpy()] = np.concatenate(rows.column(1).to_pylist()).reshape(-1, WIDTH)
    return (vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1)).astype(np.float32)


def features(data: np.ndarray, offsets: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Pooled vectors of each document of a block: mean, largest and smallest segment mean; words that stand twice in a row; length."""
    hashes, first = tokens(data, offsets)
    counts = np.diff(first)
    out = np.zeros((len(counts), 3 * WIDTH + 3), dtype=np.float32)
    out[:, -1] = np.log1p(counts) / 10
    some = np.flatnonzero(counts)
    if not len(some):
        return out
    bucket = (hashes % np.uint64(BUCKETS)).astype(np.int64)
    pieces = np.maximum(counts[some] // SEGMENT, 1)  # the last segment takes what is left over
    before = np.cumsum(pieces) - pieces
    owner = np.repeat(np.arange(len(some)), pieces)
    starts = first[:-1][some][owner] + SEGMENT * (np.arange(len(owner)) - before[owner])
    lengths = np.diff(np.append(starts, len(hashes)))
    sums = np.zeros((len(starts), WIDTH), dtype=np.float32)
    step = max(1, (1 << 20) // SEGMENT // 4)
    for at in range(0, len(starts), step):
        to = min(at + step, len(starts))
        stop = starts[to] if to < len(starts) else len(hashes)
        sums[at:to] = np.add.reduceat(vectors[bucket[starts[at] : stop]], starts[at:to] - starts[at], axis=0)
    means = sums / lengths[:, None]
    out[some, :WIDTH] = np.add.reduceat(sums, before, axis=0) / counts[some][:, None]
    out[some, WIDTH : 2 * WIDTH] = np.maximum.reduceat(means, before, axis=0)
    out[some, 2 * WIDTH : -3] = np.minimum.reduceat(means, before, axis=0)
    again = np.concatenate([[False], hashes[1:] == hashes[:-1]])
    again[first[:-1][some]] = False
    repeated = np.add.reduceat(again.astype(np.float64), starts)
    out[some, -3] = np.add.reduceat(repeated, before) / counts[some]
    out[some, -2] = np.maximum.reduceat(repeated / lengths, before)
    return out


class TwoLayers:
    """A network with one hidden layer, and a temperature set on rows it was not fitted on."""

    def __init__(self, x: np.ndarray, y: np.ndarray, epochs: int = 120, batch: int = 256, rate: float = 3e-3, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        self.centre, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        z = (x - self.centre) / self.scale
        held = np.arange(len(z)) % 5 == 4
        fit, rest = np.flatnonzero(~held), np.flatnonzero(held)
        self.layers = [rng.normal(size=(z.shape[1], HIDDEN)) * z.shape[1] ** -0.5, np.zeros(HIDDEN),
            rng.normal(size=HIDDEN) * HIDDEN**-0.5, np.zeros(1)]
        first, second = [np.zeros_like(p) for p in self.layers], [np.zeros_like(p) for p in self.layers]
        step = 0
        for epoch in range(epochs):
            order = rng.permutation(fit)
            for at in range(0, len(order), batch):
                rows = order[at : at + batch]
                hidden = np.maximum(z[rows] @ self.layers[0] + self.layers[1], 0)
                odds = 1 / (1 + np.exp(-np.clip(hidden @ self.layers[2] + self.layers[3], -30, 30)))
                error = (odds - y[rows]) / len(rows)
                back = np.outer(error, self.layers[2]) * (hidden > 0)
                gradients = [z[rows].T @ back + 1e-4 * self.layers[0], back.sum(axis=0), hidden.T @ error
                    + 1e-4 * self.layers[2], np.array([error.sum()])]
                step += 1
                for p, g, m, v in zip(self.layers, gradients, first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= rate * (1 - epoch / epochs) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        self.temperature = 1.0
        if len(rest):
            logits = self.logits(x[rest])
            grid = np.geomspace(0.25, 8, 60)
            loss = [np.logaddexp(0, np.where(y[rest] == 1, -1, 1) * logits / t).mean() for t in grid]
            self.temperature = float(grid[int(np.argmin(loss))])

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum((x - self.centre) / self.scale @ self.layers[0] + self.layers[1], 0)
        return hidden @ self.layers[2] + self.layers[3]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -60, 60)))


def _feature_rows(vectors: np.ndarray):
    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, data, offsets in text_blocks(batch.column(2), 4 << 20):
                x = features(data, offsets, vectors)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, end - begin),
                        batch.column(1).slice(begin, end - begin), lists], names=["doc_id", "label", "x"])

    return pool


def fit(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, label: str = "quality", most: int = SAMPLE) -> TwoLayers | None:
    """Train on at most ``most`` labelled documents; of each only the features reach the driver, of several texts of an id the least."""
    chosen = known_labels(labels, label).orderBy(F.xxhash64("doc_id", F.lit(label)), "doc_id").limit(most)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(F.col("doc_id").cast("bigint"), "label", "text")
    sample = rows.mapInArrow(lean(_feature_rows(vectors)), "doc_id bigint, label int, x array<float>").groupBy(
        "doc_id").agg(F.first("label").alias("label"), F.min("x").alias("x")).toArrow().sort_by("doc_id")
    y = sample.column("label").to_numpy().astype(np.float64)
    if len(set(y.tolist())) < 2:
        return None
    x = np.concatenate(sample.column("x").to_pylist()).reshape(len(y), -1)
    return TwoLayers(x.astype(np.float64), y)


def _scorer(vectors: np.ndarray, model: TwoLayers | None):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [model.scores(features(data, offsets, vectors)) if model else np.full(end - begin, 0.5)
                for begin, end, data, offsets in text_blocks(batch.column(0), 4 << 20)]
            columns = [batch.column(k) for k in range(1, batch.num_columns)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.concatenate(parts) if parts else np.zeros(0))],
                names=[*batch.schema.names[1:], "score"])

    return score


def score_documents(docs: DataFrame, vectors: np.ndarray, model: TwoLayers | None) -> DataFrame:
    """``doc_id, score`` of every document."""
    return docs.select("text", F.col("doc_id").cast("bigint")).mapInArrow(lean(_scorer(vectors, model)), "doc_id bigint, score double")


def reject(docs: DataFrame, labels: DataFrame, least: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score at least ``least``; trained on ``docs`` and ``labels``. Without labels all stay."""
    vectors = word_vectors(docs)
    model = fit(docs, labels, vectors)
    if model is None:
        return docs
    scored = with_score(docs, lambda data, offsets: model.scores(features(data, offsets, vectors)), "__cw_score")
    return scored.filter(F.col("__cw_score") >= least).drop("__cw_score")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    vectors = word_vectors(docs)
    scores = score_documents(docs, vectors, fit(docs, table(spark, sf_dir, "labels"), vectors))
    return scores.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
