"""Similarity join of documents by their word n-grams: size-banded tiles, bitmaps, exact intersection.

A document stands for its set of distinct word shingles; equal sets are one class. Two sets that are alike enough share one of the rarest
shingles of each: of ``n`` shingles, ordered by rarity, the first ``n - ceil(percent n / 100) + 1``. Their sizes are in one band or
in neighbouring ones, where a band's upper end is ``100 / percent`` times its lower end. So a tile is a rare shingle and a band of
sizes, and only sets of one tile, or of a tile and the next one, are compared. Rarity is counted over all documents in a table of fixed length
by hash of the shingle; any order gives the same links, this one keeps shingles of common passages out of the tiles.

First every set meets the least set of its own tile and of the one below. That joins groups of near copies at linear cost. What is not
known as joined by two such links and shares a tile is compared block by block: sets of the largest group are not compared among
themselves, equal lists of sets are compared once, whatever tiles they come from. A list is first compared by bitmaps: each shingle flips
the bit that its hash names, so two sets differ in at least as many shingles as their bitmaps differ in bits, which bounds their overlap from above. Only sets
that pass with a set of another group are sent in full, and the sorted arrays are intersected. No pairs are written but links, of which each task
emits a forest.

What grows faster than the classes: a tile of N sets that are apart has N * N / 2048 rows of ids and bitmaps.

Letters A-Z are lower-cased; words are ``[^\\x20\\x09-\\x0D]+``. Texts with fewer words than a shingle have their whole sequence as the
one shingle; null texts and texts without words have an empty set and are linked with nothing. Texts of any length are one set of one
task. Repeated rows are in one group; a null ``doc_id`` takes part and is never a group's smallest id unless all are null. An empty table
gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoweave.llm.blocks import lean
from chronoweave.llm.common import small_batches, stored, table
from chronoweave.llm.components import components
from chronoweave.llm.near_dedup import BROADCAST_IDS, _long_lists, _set_ids
from chronoweave.llm.superminhash import shingle_sets

#: Sets of one block of comparisons.
UNIT = 1024
#: Documents for which a table of pairs, links or lists gets one file.
FILE_DOCUMENTS = 50_000
#: Length of the table of rarity.
BUCKETS = 1 << 18
_LARGEST_MAP = 1 << 16


def _weights(shingle: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for _, _, sets, _ in shingle_sets(batch.column(0), shingle):
                total += np.bincount((np.concatenate(sets) & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
        met = np.flatnonzero(total)
        for k in range(0, len(met), 1 << 15):
            part = met[k : k + (1 << 15)]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(total[part])], names=["bucket", "n"])

    return count


def rarest(values: np.ndarray, weights: np.ndarray, percent: int) -> np.ndarray:
    """The rarest shingles of a sorted set, one of which every set that is alike enough has among its own."""
    n = len(values)
    wanted = n - -(-percent * n // 100) + 1 if n else 0
    weight = weights[(values & np.uint64(BUCKETS - 1)).astype(np.int64)]
    return values[np.lexsort((values, weight))[:wanted]]


def bitmap(values: np.ndarray) -> np.ndarray:
    """Parity of the shingles that fall on each bit; the bits are the next power of two of the set's size, 64 at least."""
    bits = min(_LARGEST_MAP, 1 << max(6, (len(values) - 1).bit_length()))
    odd = np.bincount((values & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def _sketches(shingle: int, percent: int, weights):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = weights.value
        for batch in batches:
            for begin, end, sets, ids in shingle_sets(batch.column(2), shingle):
                sizes = pa.array(np.array([len(s) for s in sets], dtype=np.int64))
                own = [batch.column(k).slice(begin, end - begin) for k in (0, 1)]
                maps = pa.array([bitmap(s).tobytes() if len(s) else b"" for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([*own, sizes, *_set_ids(ids), _long_lists([rarest(s, table, percent) for s in sets]), maps],
                    names=["doc_id", "key", "n_shingles", "set_a", "set_b", "rare", "map"])

    return sketch


def _full_sets(shingle: int):
    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, sets, _ in shingle_sets(batch.column(1), shingle):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, end - begin), _long_lists(sets)], names=["node", "shingles"])

    return collect


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Values that two sorted arrays of distinct values share."""
    a, b = (a, b) if len(a) <= len(b) else (b, a)
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0


def _folded(maps: list[np.ndarray]) -> np.ndarray:
    """Bitmaps at the length of the shortest one."""
    length = min(len(m) for m in maps)
    out = []
    for m in maps:
        while len(m) > length:
            m = m[: len(m) // 2] ^ m[len(m) // 2 :]
        out.append(m)
    return np.stack(out)


def _passing(i: int, sizes: np.ndarray, groups: np.ndarray, maps: np.ndarray, percent: int) -> np.ndarray:
    """Later sets of other groups, in the order of sizes, that may be alike enough by size and bitmap."""
    end = int(np.searchsorted(sizes, sizes[i] * 100 // percent, side="right"))
    rest = np.arange(i + 1, end)
    rest = rest[groups[rest] != groups[i]]
    bound = (sizes[i] + sizes[rest] - np.bitwise_count(maps[rest] ^ maps[i]).sum(axis=1, dtype=np.int64)) // 2
    return rest[(100 + percent) * bound >= percent * (sizes[i] + sizes[rest])]


def survivors(sizes: np.ndarray, roots: np.ndarray, maps: list[np.ndarray], percent: int) -> np.ndarray:
    """Which sets of a list pass with a set of another group."""
    order = np.argsort(sizes, kind="stable")
    sizes, roots, maps = sizes[order], roots[order], _folded([maps[k] for k in order])
    met = np.zeros(len(sizes), dtype=bool)
    for i in range(len(sizes) - 1):
        found = _passing(i, sizes, roots, maps, percent)
        met[found] = True
        met[i] |= len(found) > 0
    return order[met]


def forest(nodes: np.ndarray, roots: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that join the groups of a list of sets."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    order = np.argsort(sizes, kind="stable")
    nodes, sizes, sets = nodes[order], sizes[order], [sets[k] for k in order]
    groups = np.unique(roots[order], return_inverse=True)[1]
    maps, links = _folded([bitmap(s) for s in sets]), []
    for i in range(len(nodes) - 1):
        for k in _passing(i, sizes, groups, maps, percent).tolist():
            if groups[k] != groups[i] and (100 + percent) * overlap(sets[i], sets[k]) >= percent * int(sizes[i] + sizes[k]):
                groups[groups == groups[k]] = groups[i]
                links.append((int(nodes[i]), int(nodes[k])))
    return links


def _link_rows(links: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["u", "v"])


def _pass_pairs(percent: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The pairs that may be alike enough by their sizes and bitmaps; columns are hub, node, and size and bitmap of each."""
        for batch in batches:
            one, other, one_map, other_map = (batch.column(k).to_pylist() for k in (2, 3, 4, 5))
            stay = []
            for a, b, m, n in zip(one, other, one_map, other_map, strict=True):
                small, large = min(a, b), max(a, b)
                fits = 100 * small >= percent * large
                if fits:
                    both = _folded([np.frombuffer(m, np.uint64), np.frombuffer(n, np.uint64)])
                    bound = (a + b - int(np.bitwise_count(both[0] ^ both[1]).sum())) // 2
                    fits = (100 + percent) * bound >= percent * (a + b)
                stay.append(fits)
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(pa.array(stay, pa.bool_())) for k in (0, 1)], names=["hub", "node"])

    return compare


def _stars(percent: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come with the least set of a tile before those that meet it: columns are hub, part, own, node, shingles."""
        hub, held = None, None
        for batch in batches:
            links, lists = [], batch.column(4)
            bounds, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).view(np.uint64)
            for k, (own, node) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                one = values[bounds[k] : bounds[k + 1]]
                if own == 0:
                    hub, held = node, one.copy()
                elif (100 + percent) * overlap(one, held) >= percent * (len(one) + len(held)):
                    links.append((hub, node))
            yield _link_rows(links)

    return compare


def _cells(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[list[tuple]]:
    """The rows of each cell, which come one cell after the other; the last column is copied out of the batch."""
    cell, held = None, []
    for batch in batches:
        plain = [batch.column(k).to_pylist() for k in range(columns - 1)]
        last = batch.column(columns - 1)
        if pa.types.is_list(last.type):
            bounds, values = last.offsets.to_numpy(), last.values.to_numpy(zero_copy_only=False).view(np.uint64)
            parts = [values[a:b].copy() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        else:
            parts = [np.frombuffer(m, np.uint64) for m in last.to_pylist()]
        for row in zip(*plain, parts, strict=True):
            if row[0] != cell:
                if held:
                    yield held
                cell, held = row[0], []
            held.append(row)
    if held:
        yield held


def _pass_bitmaps(percent: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _cells(batches, 5):  # cell, node, root, size, map
            _, nodes, roots, sizes, maps = zip(*rows, strict=True)
            found = survivors(np.array(sizes), np.array(roots), list(maps), percent)
            if len(found):
                yield pa.RecordBatch.from_arrays([pa.array([sorted(np.array(nodes)[found].tolist())], pa.list_(pa.int64()))], names=["nodes"])

    return compare


def _intersect(percent: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _cells(batches, 4):  # cell, node, root, shingles
            _, nodes, roots, sets = zip(*rows, strict=True)
            yield _link_rows(forest(np.array(nodes), np.array(roots), list(sets), percent))

    return compare


def _dealt(lists: DataFrame, known: DataFrame, columns: list[str], few) -> DataFrame:
    """The distinct lists of ``nodes`` as rows of ``cell, node`` and what is known of each node, cell by cell."""
    cells = stored(few(lists.dropDuplicates(["nodes"])).select(F.monotonically_increasing_id().alias("cell"), "nodes"), "cells")
    rows = cells.select("cell", F.explode("nodes").alias("node")).join(known, "node").select("cell", "node", *columns)
    return rows.repartition("cell").sortWithinPartitions("cell", "node")


def _apart(members: DataFrame, joined: DataFrame) -> DataFrame:
    """Lists of sets that share a tile, or a tile and the next one, and are not all joined; blocks of the largest group don't meet each other."""
    meeting = F.explode(F.array("band", F.col("band") - 1)).alias("band")
    rooted = members.join(joined, "node", "left").select("token", "node", meeting, F.coalesce("root", "node").alias("root"))
    rooted = stored(rooted.select(F.xxhash64("token", "band").alias("tile"), "node", "root"), "rooted")
    groups = rooted.groupBy("tile", "root").agg(F.count(F.lit(1)).alias("n"))
    main = groups.groupBy("tile").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.max("n").alias("inside"),
        (F.sum("n") - F.max("n")).alias("outside"))
    main = stored(main.filter("outside > 0"), "main")
    blocks = lambda n: F.ceil(F.col(n) / UNIT).cast("int")
    part = lambda n: F.pmod(F.xxhash64("node"), blocks(n)).cast("int")
    out = F.col("root") != F.col("main")
    block = F.when(out, part("outside")).otherwise(blocks("outside") + part("inside"))
    others = F.sequence(F.lit(0), F.when(out, blocks("outside") + blocks("inside")).otherwise(blocks("outside")) - 1)
    met = rooted.join(main, "tile").select("tile", block.alias("block"), F.explode(others).alias("other"), "node")
    low, high = F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    return met.select("tile", low, high, "node").groupBy("tile", "low", "high").agg(F.array_sort(F.collect_set("node")).alias("nodes")).filter(
        F.size("nodes") > 1).select("nodes")


def _sets(docs: DataFrame, classes: DataFrame, nodes: DataFrame, shingle: int, few) -> DataFrame:
    """``node, shingles`` of some classes, from the text of one document of each."""
    wanted = stored(few(classes.select("node", "key").join(nodes, "node", "left_semi")), "wanted")
    chosen = docs.join(F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted, "key").select("node", "text").dropDuplicates(["node"])
    return stored(few(chosen).mapInArrow(lean(_full_sets(shingle)), "node bigint, shingles array<bigint>"), "sets")


def similar_documents(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, key, n_shingles, component_id`` of every row of ``docs (doc_id, key, text)``.

    ``key`` is a number that goes with ``doc_id`` and ``text``. Sets are linked if ``100 * intersection >= percent * union``; ``component_id`` is
    the smallest id reachable by links. Bitmaps go with the classes, so only sets that pass are read again from their texts.
    """
    spark = docs.sparkSession
    small_batches(spark)
    counted = docs.select("text").mapInArrow(lean(_weights(shingle)), "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    weights = np.zeros(BUCKETS, dtype=np.int64)
    weights[counted.column("bucket").to_numpy()] = counted.column("n").to_numpy()
    sketches = docs.select("doc_id", "key", "text").mapInArrow(lean(_sketches(shingle, percent, spark.sparkContext.broadcast(weights))),
        "doc_id bigint, key bigint, n_shingles bigint, set_a bigint, set_b bigint, rare array<bigint>, map binary")
    sketches = stored(sketches, "sketches")
    filled = sketches.filter("n_shingles > 0")
    files = -(-max(1, sketches.count()) // FILE_DOCUMENTS)
    few = lambda df: df.coalesce(files)
    kept = lambda df, name: stored(few(df), name)
    classes = filled.groupBy("set_a", "set_b").agg(F.min("key").alias("key"), F.min("doc_id").alias("doc_id"),
        F.first("n_shingles").alias("n"), F.first("rare").alias("rare"), F.first("map").alias("map"))
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "classes")

    band = F.floor(F.log(F.col("n")) / math.log(100 / percent)).cast("int").alias("band")
    in_tile = classes.select("node", band, F.explode("rare").alias("token"))
    shared = stored(in_tile.groupBy("token").agg(F.count(F.lit(1)).alias("times")).filter("times > 1").select("token"), "shared")
    members = stored(in_tile.join(shared, "token").select("token", "band", "node"), "members")
    least = stored(members.groupBy("token", "band").agg(F.min("node").alias("hub")), "least")
    meeting = F.explode(F.array("band", F.col("band") - 1)).alias("band")
    stars = members.select("token", meeting, "node").join(least, ["token", "band"]).filter("hub <> node").select("hub", "node").distinct()
    stars = kept(stars, "stars")

    maps = classes.select("node", "n", "map")
    both = stars.join(maps, "node").join(maps.select(F.col("node").alias("hub"), F.col("n").alias("n_hub"), F.col("map").alias("map_hub")), "hub")
    stars = stored(few(both.select("hub", "node", "n", "n_hub", "map", "map_hub")).mapInArrow(lean(_pass_pairs(percent)), "hub bigint, node bigint"), "stars")
    sets = _sets(docs, classes, stars.select(F.explode(F.array("hub", "node")).alias("node")).distinct(), shingle, few)
    parts = (stars.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / UNIT).cast("int").alias("parts")))
    spokes = stars.join(parts, "hub").select("hub", F.pmod(F.xxhash64("node"), "parts").cast("int").alias("part"), F.lit(1).alias("own"), "node")
    hubs = parts.select("hub", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("own"), F.col("hub").alias("node"))
    dealt = spokes.unionByName(hubs).join(sets, "node").select("hub", "part", "own", "node", "shingles")
    dealt = dealt.repartition("hub", "part").sortWithinPartitions("hub", "part", "own", "node")
    links = stored(few(dealt).mapInArrow(lean(_stars(percent)), "u bigint, v bigint"), "links")
    # What a set was linked with, and what that was linked with: enough to know most of a group as one.
    linked = links.groupBy(F.col("v").alias("node")).agg(F.min("u").alias("hub"))
    above = linked.select(F.col("node").alias("hub"), F.col("hub").alias("above"))
    joined = kept(linked.join(above, "hub", "left").select("node", F.coalesce("above", "hub").alias("root")), "joined")

    rooted = lambda df: df.join(joined, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rough = _dealt(_apart(members, joined), rooted(maps), ["root", "n", "map"], few)
    passed = stored(few(rough).mapInArrow(lean(_pass_bitmaps(percent)), "nodes array<bigint>"), "passed")
    sets = _sets(docs, classes, passed.select(F.explode("nodes").alias("node")).distinct(), shingle, few)
    exact = _dealt(passed, rooted(sets), ["root", "shingles"], few)
    links = stored(links.unionByName(few(exact).mapInArrow(lean(_intersect(percent)), "u bigint, v bigint")), "all-links")
    joined = kept(components(links), "joined")

    least = classes.select("node", "doc_id").join(joined, "node").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    linked = joined.join(kept(least, "least"), "root").select("node", "component_id")
    groups = classes.select("node", "set_a", "set_b", F.col("doc_id").alias("own_id")).join(linked, "node", "left")
    groups = kept(groups.select("set_a", "set_b", F.coalesce("component_id", "own_id").alias("component_id")), "groups")
    found = filled.select("doc_id", "key", "n_shingles", "set_a", "set_b").join(groups, ["set_a", "set_b"]).drop("set_a", "set_b")
    empty = sketches.filter("n_shingles = 0").select("doc_id", "key", "n_shingles", F.col("doc_id").alias("component_id"))
    return found.unionByName(empty)


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    keyed = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), "text")
    return similar_documents(keyed).select("doc_id", "n_shingles", "component_id")
