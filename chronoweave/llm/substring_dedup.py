"""Removal of passages that repeat: seed and extend on winnowed anchors.

A passage is a run of ``window`` words that also starts anywhere else. Seeds are winnowed anchors: of the word grams inside a window
the one with the smallest hash. Equal windows have equal anchors at equal places, so no repeat is missed, and only anchors
that occur twice need a look. Neighbouring windows with the same anchor occurrence form one run (about one for 15 words).

Extension goes both ways from the anchor, without pairs. First to the whole context of all its windows: contexts that occur
twice repeat as a whole. What is left are anchors with different contexts, the ends of maximal repeats; there one
occurrence of each different context is extended window by window. Matched windows are merged to maximal spans.

Equal runs and windows of one block of texts are one row with the list of their places from the start, so a passage that stands in very
many documents costs a row a block, not a row a document; lists are bounded by the block. The places come together
again block by block, where spans are merged for each document. Keys of any size are counted before they are shuffled.

Words are ``[^\\x20\\x09-\\x0D]+``. A run is known by the hashes of its anchor and of its context, a window by that of its anchor and its own:
128 bits, in two halves that are independent of each other from the bytes on. Null, empty and short texts have no windows and stay as
they are. Rows that repeat are repeats of each other. If ``doc_id`` is null somewhere or stands twice, rows are told apart by a hash of id
and text. An empty table gives an empty result. Extra columns pass through ``remove_repeats``, but for those named like its own three, which
take their place; names that start with ``__cw_`` are taken. A task holds the words of the longest text as Python objects.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from chronoweave.llm.blocks import joined, lean, span_keys, text_blocks, window_hashes, word_spans
from chronoweave.llm.common import discard, small_batches, stored, table

WINDOW = 35
GRAM = 6
_BLOCK = 4 << 20
_MORE = "more array<struct<key: bigint, first: int>>"
_DIGEST = ("n_words", "n_removed", "kept_sha256")


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` items the place of its smallest, the leftmost on ties."""
    n = len(values) - width + 1
    best = np.arange(len(values))
    size = 1
    while size < width:
        step = min(size, width - size)
        left, right = best[:-step], best[step:]
        best = np.where(values[right] < values[left], right, left)
        size += step
    return best[:n]


def anchor_runs(words: np.ndarray, others: np.ndarray, first: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of windows of a block with the same anchor: document, first window, windows, anchor hash, context hash.

    Anchors come from one chain of word keys, contexts from the other. A run has at most ``window`` windows, so its first and its last one
    cover its context.
    """
    windows = np.maximum(np.diff(first) - window + 1, 0)
    if not windows.sum():
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    grams = window_hashes(words, gram)
    best = sliding_argmin(grams, window - gram + 1)
    document = np.repeat(np.arange(len(windows)), windows)
    start = np.arange(len(document)) - (np.cumsum(windows) - windows)[document] + first[document]
    place = best[start]
    at = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (document[1:] != document[:-1])]))
    n = np.diff(np.append(at, len(document)))
    begins, owner = start[at], document[at]
    own = window_hashes(others, window)
    return owner, begins - first[owner], n, grams[place[at]], joined(own[begins], own[begins + n - 1]) + n.astype(np.uint64)


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64, copy=False).view(np.int64))


def _grouped(first_hash: np.ndarray, second_hash: np.ndarray, keys: pa.Array, places: np.ndarray) -> tuple[np.ndarray, list[pa.Array]]:
    """Equal pairs of hashes as one row: where each pair occurs first, and the columns ``key, first, more`` of its places."""
    order = np.lexsort((second_hash, first_hash))
    a, b = first_hash[order], second_hash[order]
    begins = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(order) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(begins, len(order)))
    one = order[begins]
    others = np.ones(len(order), dtype=bool)
    others[begins] = False
    rest = order[others]
    places = places.astype(np.int32)
    bounds = pa.array(np.concatenate([[0], np.cumsum(sizes - 1)]).astype(np.int32))
    values = pa.StructArray.from_arrays([keys.take(pa.array(rest)), pa.array(places[rest])], names=["key", "first"])
    more = pa.ListArray.from_arrays(bounds, values, mask=pa.array(sizes == 1))
    return one, [keys.take(pa.array(one)), pa.array(places[one]), more]


def _block_number(count: int, side: int) -> int:
    """A number of its own for each block of a stage, the same when a task runs again."""
    return ((TaskContext.get().partitionId() << 32) + count) * 2 + side


def _seeds(window: int, gram: int):
    def seed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = 0
        for batch in batches:
            for begin, end, data, offsets in text_blocks(batch.column(1), _BLOCK):
                starts, ends, first = word_spans(data, offsets)
                words, others = span_keys(data, starts, ends), span_keys(data, starts, ends, 1)
                owner, at, n, anchor, context = anchor_runs(words, others, first, window, gram)
                one, columns = _grouped(anchor, context, batch.column(0).slice(begin, end - begin).take(pa.array(owner)), at)
                block = pa.array(np.full(len(one), _block_number(blocks, 0)))
                blocks += 1
                yield pa.RecordBatch.from_arrays([_long(anchor[one]), _long(context[one]), *columns,
                        pa.array(n[one].astype(np.int32)), block], names=["h", "c", "key", "first", "more", "n", "block"])

    return seed


def _windows(window: int):
    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Anchor and hash of every window of the listed runs, one block after the other."""
        blocks = 0
        for batch in batches:
            runs = batch.column(2)
            bounds = runs.offsets.to_numpy()
            begins, counts, anchors = (runs.values.field(k).to_numpy(zero_copy_only=False) for k in range(3))
            for begin, end, data, offsets in text_blocks(batch.column(1), _BLOCK):
                starts, ends, first = word_spans(data, offsets)
                hashes = window_hashes(span_keys(data, starts, ends, 1), window)
                lo, hi = bounds[begin], bounds[end]
                n = counts[lo:hi].astype(np.int64)
                inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                start = np.repeat(begins[lo:hi].astype(np.int64), n) + inside
                owner = np.repeat(np.repeat(np.arange(end - begin), np.diff(bounds[begin : end + 1])), n)
                anchor, own = np.repeat(anchors[lo:hi], n), hashes[first[owner] + start]
                one, columns = _grouped(own, anchor, batch.column(0).slice(begin, end - begin).take(pa.array(owner)), start)
                block = pa.array(np.full(len(one), _block_number(blocks, 1)))
                blocks += 1
                yield pa.RecordBatch.from_arrays([pa.array(anchor[one]), _long(own[one]), *columns, block],
                    names=["h", "w", "key", "first", "more", "block"])

    return expand


def _merge_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The repeated runs of a block, listed by run, as one row of merged spans for each document."""
    for whole in batches:
        for batch in (whole.slice(k, 1) for k in range(whole.num_rows)):
            runs = batch.column(0).flatten()
            n, more = runs.field("n").to_numpy(), runs.field("more")
            owner = pc.list_parent_indices(more).to_numpy()
            rest = pc.list_flatten(more)
            key = np.concatenate([runs.field("key").to_numpy(), rest.field("key").to_numpy()])
            first = np.concatenate([runs.field("first").to_numpy(), rest.field("first").to_numpy()]).astype(np.int64)
            last = first + np.concatenate([n, n[owner]])
            order = np.lexsort((first, key))
            key, first, last = key[order], first[order], last[order]
            fresh = np.concatenate([[True], key[1:] != key[:-1]])
            # Places are compared across documents as one line: each document stands behind the end of the one before.
            document = np.cumsum(fresh) - 1
            shift = document * (int(last.max()) + 2)
            reach = np.maximum.accumulate(last + shift)
            begins = np.flatnonzero(np.concatenate([[True], (first + shift)[1:] > reach[:-1]]))
            span_first = first[begins]
            span_last = reach[np.append(begins[1:], len(key)) - 1] - shift[begins]
            documents = np.flatnonzero(fresh[begins])
            spans = pa.StructArray.from_arrays([pa.array(span_first.astype(np.int32)),
                    pa.array((span_last - span_first).astype(np.int32))], names=["first", "n"])
            yield pa.RecordBatch.from_arrays([pa.array(key[begins][documents]),
                    pa.ListArray.from_arrays(pa.array(np.append(documents, len(begins)).astype(np.int32)), spans)],
                names=["key", "runs"])


def row_key(docs: DataFrame) -> Column:
    """``doc_id`` if it tells rows apart, else a hash of id and text. Looks at ids only."""
    ids = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    odd = ids.filter("n > 1 or doc_id is null").limit(1).count()
    plain = F.col("doc_id").cast("bigint")
    return F.xxhash64("doc_id", "text") if odd else plain


def repeated_runs(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``key, runs``: for each struct of ``first, n`` the windows ``first .. first + n - 1`` of a document occur more than once.

    ``docs`` has ``key, text``. A document has one row for each block that found something in it.
    """
    times = F.sum(F.lit(1) + F.coalesce(F.array_size("more"), F.lit(0))).alias("times")
    anchors = stored(docs.mapInArrow(lean(_seeds(window, gram)),
            f"h bigint, c bigint, key bigint, first int, {_MORE}, n int, block bigint"), "anchors")
    # Hashes that occur twice are stored before the join: Spark splits large keys only between two plain shuffles.
    again = stored(anchors.groupBy("h").agg(times).filter("times > 1").select("h"), "again")
    seeds = stored(anchors.join(again, "h").select(*anchors.columns), "seeds")
    discard(anchors)

    contexts = stored(seeds.groupBy("h", "c").agg(times, F.min(F.struct("key", "first", "n")).alias("one")), "contexts")
    place = F.struct("n", "key", "first", "more").alias("place")
    whole = seeds.join(contexts.filter("times > 1").select("h", "c"), ["h", "c"]).select("block", place)
    several = stored(contexts.groupBy("h").agg(F.count(F.lit(1)).alias("different")).filter("different > 1").select("h"), "several")
    ends = contexts.join(several, "h").groupBy("one.key").agg(F.collect_list(F.struct("one.first", "one.n", "h")).alias("runs"))
    windows = docs.join(ends, "key").select("key", "text", "runs").mapInArrow(lean(_windows(window)),
        f"h bigint, w bigint, key bigint, first int, {_MORE}, block bigint")
    windows = stored(windows, "windows")
    twice = stored(windows.groupBy("h", "w").agg(times).filter("times > 1").select("h", "w"), "twice")
    parts = windows.join(twice, ["h", "w"]).withColumn("n", F.lit(1)).select("block", place)
    listed = whole.unionByName(parts).groupBy("block").agg(F.collect_list("place").alias("places"))
    return listed.select("places").mapInArrow(lean(_merge_places), "key bigint, runs array<struct<first: int, n: int>>")


def _remove(position: int, runs_at: int, window: int, names: list[str], dropped: set[int], keep_text: bool, digest: bool):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(k, 250) for whole in batches for k in range(0, whole.num_rows, 250)):
            runs = batch.column(runs_at)
            texts = batch.column(position).cast(pa.large_binary()).to_pylist()
            total, removed, hashes, left = [], [], [], []
            for text, spans in zip(texts, runs.to_pylist(), strict=True):
                words = (text or b"").split()
                total.append(len(words))
                gone = 0
                if spans:
                    step = np.zeros(len(words) + 1, dtype=np.int64)
                    first = np.array([s["first"] for s in spans])
                    last = first + np.array([s["n"] for s in spans]) + window - 1
                    np.add.at(step, first, 1)
                    np.add.at(step, last, -1)
                    stay = np.cumsum(step[:-1]) == 0
                    gone = len(words) - int(stay.sum())
                    words = [w for w, s in zip(words, stay.tolist(), strict=True) if s]
                kept = b" ".join(words)
                removed.append(gone)
                if digest:
                    hashes.append(hashlib.sha256(kept).hexdigest())
                if keep_text:
                    left.append(text if not gone else kept)
            columns = [batch.column(i) for i in range(batch.num_columns)]
            if keep_text:
                columns[position] = pa.array(left, pa.large_binary()).cast(batch.schema.field(position).type)
            columns = [c for i, c in enumerate(columns) if i not in dropped]
            if digest:
                columns += [pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(hashes, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return remove


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, keep_text: bool = True, digest: bool = True) -> DataFrame:
    """Every row of ``docs``, with ``n_words, n_removed, kept_sha256``, and ``text`` without the words of repeated windows.

    A text that loses words has its others joined by one blank; any other text, null too, stays as it is. Without ``keep_text`` that
    column is left out; without ``digest`` the three new ones are, and the result has the columns of ``docs``.
    """
    small_batches(docs.sparkSession)
    keyed = docs.select(row_key(docs).alias("__cw_key"), *docs.columns).filter(F.col("__cw_key").isNotNull())
    runs = repeated_runs(keyed.select(F.col("__cw_key").alias("key"), "text"), window, gram)
    spans = runs.groupBy(F.col("key").alias("__cw_key")).agg(F.flatten(F.collect_list("runs")).alias("__cw_runs"))
    fields = docs.schema.fields
    dropped = {i for i, f in enumerate(fields) if (not keep_text and f.name == "text") or (digest and f.name in _DIGEST)}
    schema = StructType([f for i, f in enumerate(fields) if i not in dropped])
    if digest:
        schema = schema.add("n_words", LongType()).add("n_removed", LongType()).add("kept_sha256", "string")
    joined = keyed.join(spans, "__cw_key", "left").select(*docs.columns, "__cw_runs")
    cut = _remove(docs.columns.index("text"), len(fields), window, schema.names, dropped | {len(fields)}, keep_text, digest)
    return joined.mapInArrow(lean(cut), schema)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs, keep_text=False)
