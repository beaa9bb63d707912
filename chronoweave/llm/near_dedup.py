"""Near-duplicate groups of documents: SuperMinHash, banding, verification on full sets, union-find.

A document stands for its set of distinct word shingles; equal sets are one class from the start, known by 128 bits of hash.
Signatures are cut into bands, and classes that share a band are candidates. Candidates are grouped, not paired: connected candidates
form a unit, and a unit is cut into blocks of about ``UNIT`` classes. The first block holds the unit's representatives:
every other block is compared with it alone, so each class is sent once and the representatives once a block. That joins large
groups of near copies at linear cost. Only a class that is not in the largest group of one of its bands then is compared with all
of that band. Inside a task, sets are compared with union-find, which leaves out pairs that are already connected, and only a
spanning forest of confirmed links is emitted.

What can still grow faster than the classes: bands of over ``UNIT`` classes in which many are linked with no representative, that is,
many documents that are alike to about half. Their rows are (classes without link) x (blocks of the band).

With ``rows`` and ``bands`` of the defaults a pair at the threshold is missed with a probability of about 2e-7; pairs above it less.

Letters A-Z are lower-cased; words are ``[^\\x20\\x09-\\x0D]+``. Texts with fewer words than a shingle have their whole sequence as
the one shingle; null texts and texts without words have an empty set and are linked with nothing. Repeated rows are in one group; a null
``doc_id`` takes part and is never a group's smallest id unless all are null. An empty table gives an empty result. Other columns are
ignored by ``near_duplicates`` and kept by ``keep_one``; names that start with ``__cw_`` are taken.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoweave.llm.blocks import lean, ragged_take
from chronoweave.llm.common import small_batches, stored, table
from chronoweave.llm.components import components
from chronoweave.llm.superminhash import band_hashes, shingle_sets, signatures

#: Most classes of one block of comparisons.
UNIT = 1024
#: Most ids of candidates that are broadcast (16 MB); beyond, texts are joined by shuffle.
BROADCAST_IDS = 2_000_000


def _set_ids(ids: np.ndarray) -> list[pa.Array]:
    return [pa.array(np.ascontiguousarray(ids[:, k]).view(np.int64)) for k in (0, 1)]


def _long_lists(parts: list[np.ndarray]) -> pa.Array:
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(parts).astype(np.uint64).view(np.int64)))


def _sketches(shingle: int, bands: int, rows: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, sets, ids in shingle_sets(batch.column(2), shingle):
                hashes = band_hashes(signatures(sets, bands * rows), bands, rows)
                sizes = np.array([len(s) for s in sets], dtype=np.int64)
                columns = [batch.column(0).slice(begin, end - begin), batch.column(1).slice(begin, end - begin), pa.array(sizes)]
                columns += [*_set_ids(ids), _long_lists([h if len(s) else h[:0] for h, s in zip(hashes, sets, strict=True)])]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "key", "n_shingles", "set_a", "set_b", "bands"])

    return sketch


def _full_sets(shingle: int):
    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, sets, ids in shingle_sets(batch.column(0), shingle):
                yield pa.RecordBatch.from_arrays([*_set_ids(ids), _long_lists(sets)], names=["set_a", "set_b", "shingles"])

    return collect


def spanning_links(ids: np.ndarray, blocks: np.ndarray, flat: np.ndarray, sizes: np.ndarray, percent: int, across: bool) -> list[tuple[int, int]]:
    """A spanning forest of the links of some sets; ``across``: only links between the two blocks count here."""
    _, words = np.unique(flat, return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    mark = np.zeros(len(flat), dtype=np.int64)
    group = np.arange(len(ids))
    links = []
    for i in range(len(ids) - 1):
        rest = np.arange(i + 1, len(ids))
        fit = (group[rest] != group[i]) & (100 * np.minimum(sizes[rest], sizes[i]) >= percent * np.maximum(sizes[rest], sizes[i]))
        if across:
            fit &= blocks[rest] != blocks[i]
        rest = rest[fit]
        if not len(rest):
            continue
        own = words[starts[i] : starts[i] + sizes[i]]
        mark[own] = 1
        hits = mark[ragged_take(words, starts[rest], sizes[rest])]
        mark[own] = 0
        common = np.add.reduceat(hits, np.cumsum(sizes[rest]) - sizes[rest])
        for k in rest[100 * common >= percent * (sizes[i] + sizes[rest] - common)].tolist():
            if group[k] != group[i]:
                group[group == group[k]] = group[i]
                links.append((int(ids[i]), int(ids[k])))
    return links


def _compare(percent: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by cell; a cell may go on in the next batch."""
        held: list[tuple] = []
        cell = None

        def solve() -> list[tuple[int, int]]:
            if len(held) < 2:
                return []
            sizes = np.array([len(h[2]) for h in held], dtype=np.int64)
            return spanning_links(np.array([h[0] for h in held], dtype=np.int64), np.array([h[1] for h in held]),
                np.concatenate([h[2] for h in held]), sizes, percent, cell[1] != cell[2])

        for batch in batches:
            found: list[tuple[int, int]] = []
            unit, low, high, block, ids = (batch.column(k).to_pylist() for k in range(5))
            sets = batch.column(5)
            bounds, values = sets.offsets.to_numpy(), sets.values.to_numpy(zero_copy_only=False)
            for k in range(batch.num_rows):
                here = (unit[k], low[k], high[k])
                if here != cell:
                    found += solve()
                    held, cell = [], here
                held.append((ids[k], block[k], values[bounds[k] : bounds[k + 1]].copy()))
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()),
                    pa.array([f[1] for f in found], pa.int64())], names=["u", "v"])
        found = solve()
        yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())], names=["u", "v"])

    return compare


def _links(cells: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Confirmed links inside cells. ``cells`` has ``unit, block, other, node``: a class of one block that meets another block."""
    ordered = cells.select("unit", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node")
    whole = ordered.join(classes.select("node", "set_a", "set_b"), "node").join(sets, ["set_a", "set_b"])
    dealt = whole.select("unit", "low", "high", "block", "node", "shingles").repartition("unit", "low",
        "high").sortWithinPartitions("unit", "low", "high", "node")
    return stored(dealt.mapInArrow(lean(_compare(percent)), "u bigint, v bigint"), "links")


def _remaining(members: DataFrame, large: DataFrame, joined: DataFrame) -> DataFrame:
    """Cells, band by band, of the classes outside their band's largest group, each with all blocks of the band."""
    rooted = members.join(large, "node").select("band", "node").join(joined, "node", "left").select("band", "node",
        F.coalesce("root", "node").alias("root"))
    rooted = stored(rooted, "rooted")
    groups = rooted.groupBy("band", "root").agg(F.count(F.lit(1)).alias("n"))
    main = groups.groupBy("band").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.max("n").alias("inside"),
        (F.sum("n") - F.max("n")).alias("outside"))
    main = stored(main.filter("outside > 0"), "main")
    blocks = lambda n: F.ceil(F.col(n) / UNIT).cast("int")
    part = lambda n: F.pmod(F.xxhash64("node"), blocks(n)).cast("int")
    out = F.col("root") != F.col("main")
    block = F.when(out, part("outside")).otherwise(blocks("outside") + part("inside"))
    others = F.sequence(F.lit(0), F.when(out, blocks("outside") + blocks("inside")).otherwise(blocks("outside")) - 1)
    return rooted.join(main, "band").select(F.col("band").alias("unit"), block.alias("block"), F.explode(others).alias("other"), "node")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, bands: int = 26, rows: int = 4) -> DataFrame:
    """``doc_id, key, n_shingles, component_id, component_key`` of every row of ``docs (doc_id, key, text)``.

    ``key`` is a number that is never null and goes with the order of ``doc_id``. Sets are linked if
    ``100 * intersection >= percent * union``. Tables that are joined by keys that may be hot are stored first, so that
    Spark can split such keys.
    """
    small_batches(docs.sparkSession)
    sketches = docs.select("doc_id", "key", "text").mapInArrow(lean(_sketches(shingle, bands, rows)),
        "doc_id bigint, key bigint, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>")
    sketches = stored(sketches, "sketches")
    filled = sketches.filter("n_shingles > 0")
    classes = filled.groupBy("set_a", "set_b").agg(F.min("key").alias("key"), F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"))
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    in_band = classes.select("node", "key", F.explode("bands").alias("band"))
    shared = stored(in_band.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("least")).filter("n > 1"), "shared")
    members = stored(in_band.join(shared, "band").select("band", "node", "key", "least"), "members")

    candidates = components(members.select(F.col("node").alias("u"), F.col("least").alias("v")).filter("u <> v"))
    crowds = stored(candidates.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / UNIT).cast("int").alias("blocks")), "crowds")
    placed = candidates.join(crowds, "root").select(F.col("root").alias("unit"), "node", "blocks",
        F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"))
    met = F.when(F.col("block") == 0, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(F.lit(0)))

    wanted = stored(members.select("key").distinct(), "wanted")
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    sets = docs.join(wanted, "key", "left_semi").select("text").mapInArrow(lean(_full_sets(shingle)),
        "set_a bigint, set_b bigint, shingles array<bigint>")
    sets = sets.dropDuplicates(["set_a", "set_b"])
    links = _links(placed.select("unit", "block", F.explode(met).alias("other"), "node"), classes, sets, percent)
    joined = components(links)
    if crowds.filter("blocks > 1").limit(1).count():
        links = links.unionByName(_links(_remaining(members, placed.filter("blocks > 1").select("node"), joined), classes, sets, percent))
        joined = components(links)

    least = classes.select("node", "key", "doc_id").join(joined,
        "node").groupBy("root").agg(F.min("doc_id").alias("component_id"), F.min("key").alias("component_key"))
    linked = joined.join(stored(least, "least"), "root").select("node", "component_id", "component_key")
    own = classes.select("node", "set_a", "set_b", F.col("doc_id").alias("own_id"), F.col("key").alias("own_key"))
    groups = own.join(linked, "node", "left").select("set_a", "set_b",
        F.coalesce("component_id", "own_id").alias("component_id"),
        F.coalesce("component_key", "own_key").alias("component_key"))
    found = filled.select("doc_id", "key", "n_shingles", "set_a", "set_b").join(stored(groups, "groups"), ["set_a", "set_b"]).drop("set_a", "set_b")
    empty = sketches.filter("n_shingles = 0").select("doc_id", "key", "n_shingles", F.col("doc_id").alias("component_id"),
        F.col("key").alias("component_key"))
    return found.unionByName(empty)


def with_key(docs: DataFrame):
    """A key in the order of ``doc_id``; rows without an id come last, told apart by their text."""
    return F.coalesce(F.col("doc_id").cast("bigint"), F.lit((1 << 62)) + F.pmod(F.xxhash64("text"), F.lit(1 << 61)))


def keep_one(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stand for their group: one of each group, and every document that is linked with nothing.

    The smallest id of a group stays, and of its rows with that id but other texts any one; of rows with equal id and text the first.
    Where ids repeat or are null, a row is known by a hash of id and text.
    """
    odd = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 or doc_id is null").limit(1).count()
    keyed = docs.select(*docs.columns, (F.xxhash64("doc_id", "text") if odd else with_key(docs)).alias("__cw_key"))
    groups = near_duplicates(keyed.select("doc_id", F.col("__cw_key").alias("key"), "text"), shingle, percent)
    if odd:  # the hash does not go with the order of ids
        least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key"))
        kept = groups.groupBy("component_id", "component_key").agg(least.alias("least")).select(F.col("least.key").alias("__cw_key"))
    else:
        kept = groups.filter("key = component_key").select(F.col("key").alias("__cw_key"))
    kept = stored(kept.distinct(), "kept")
    chosen = keyed.join(F.broadcast(kept) if kept.count() <= BROADCAST_IDS else kept, "__cw_key", "left_semi")
    return (chosen.dropDuplicates(["doc_id", "__cw_key"]) if odd else chosen).select(*docs.columns)


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    keyed = docs.select("doc_id", with_key(docs).alias("key"), "text")
    found = near_duplicates(keyed, shingle=3, percent=85, rows=5)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
