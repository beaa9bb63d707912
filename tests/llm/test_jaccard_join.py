"""N-gram Jaccard join against all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoweave.llm import jaccard_join

rng = random.Random(4)
VOCABULARY = [f"w{i}" for i in range(400)]
PASSAGE = [f"p{i}" for i in range(25)]


def shingles(text, n):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(words[i : i + n]) for i in range(max(len(words) - n + 1, 1 if words else 0))}


def expected(rows, n, percent):
    sets = [shingles(t, n) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for k in range(i):
            both = len(sets[i] & sets[k])
            if both and 100 * both >= percent * len(sets[i] | sets[k]) and group[i] != group[k]:
                old, new = group[i], group[k]
                group = [new if g == old else g for g in group]
    least = {}
    for (doc, _), g in zip(rows, group, strict=True):
        least[g] = min((x for x in (least.get(g), doc) if x is not None), default=None)
    return sorted(((d, len(s), least[g]) for (d, _), s, g in zip(rows, sets, group, strict=True)), key=str)


def corpus(seed, size):
    own = random.Random(seed)
    base = [own.choices(VOCABULARY, k=own.choice([1, 3, 5, 6, 9, 20, 60, 150])) for _ in range(size // 4)]
    texts = [None, "", " \t", "one", "One", "one two", "a b c d", "A b C d"]
    for words in base:
        texts.append(" ".join(words))
        for _ in range(3):
            copy = list(words)
            for _ in range(own.choice([0, 1, 1, 2, 4])):
                at = own.randrange(len(copy))
                kind = own.random()
                if kind < 0.4:
                    copy[at] = own.choice(VOCABULARY)
                elif kind < 0.7 and len(copy) > 1:
                    del copy[at]
                else:
                    copy.insert(at, own.choice(VOCABULARY))
            if own.random() < 0.3:
                copy = copy + PASSAGE
            texts.append(own.choice([" ", "\n "]).join(copy))
    rows = [(own.choice([i, i, i, i, None]) if i > 20 else i, t) for i, t in enumerate(texts)]
    return rows + rows[8:14]


def result(df, **options):
    keyed = df.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), "text")
    found = jaccard_join.similar_documents(keyed, **options)
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found.collect()), key=str)


@pytest.mark.parametrize(("seed", "unit", "shingle", "percent"), [(1, 1024, 5, 80), (2, 3, 5, 80), (3, 4, 2, 60)])
def test_join_equals_all_pairs(spark, monkeypatch, seed, unit, shingle, percent):
    monkeypatch.setattr(jaccard_join, "UNIT", unit)
    rows = corpus(seed, 240)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert result(df, shingle=shingle, percent=percent) == expected(rows, shingle, percent)


def test_a_chain_whose_ends_are_unlike_and_a_group_at_half_likeness(spark, monkeypatch):
    """Neighbours of the chain link and others don't; the half-alike share shingles and nothing links them."""
    monkeypatch.setattr(jaccard_join, "UNIT", 8)
    words = [f"c{i}" for i in range(200)]
    chain = [(i, " ".join(words[4 * i : 4 * i + 60])) for i in range(30)]
    half = [(100 + i, " ".join(PASSAGE * 2 + [f"h{i}_{k}" for k in range(12)])) for i in range(60)]
    df = spark.createDataFrame(chain + half, "doc_id bigint, text string")
    found = result(df)
    assert found == expected(chain + half, 5, 80)
    assert {c for d, _, c in found if d < 30} == {0} and len({c for d, _, c in found if d >= 100}) == 60


def test_empty_table_and_clashing_names(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, "a b c")], "doc_id bigint, text string").withColumn("node", F.lit("x")).withColumn("band", F.lit(1))
    assert result(df) == [(1, 1, 1), (2, 1, 1)]
    assert result(df.limit(0)) == []


def test_bitmaps_bound_the_overlap():
    own = np.random.default_rng(5)
    for _ in range(300):
        pool = own.integers(0, 1 << 63, 400, dtype=np.uint64)
        a, b = (np.unique(own.choice(pool, int(own.integers(1, 300)))) for _ in range(2))
        both = jaccard_join._folded([jaccard_join.bitmap(a), jaccard_join.bitmap(b)])
        exact = jaccard_join.overlap(a, b)
        assert exact == len(np.intersect1d(a, b)) <= (len(a) + len(b) - int(np.bitwise_count(both[0] ^ both[1]).sum())) // 2


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_rarest_shingles_of_similar_sets_meet(percent):
    own = np.random.default_rng(percent)
    weights = own.integers(0, 3, jaccard_join.BUCKETS)
    met = 0
    for _ in range(2000):
        pool = np.unique(own.integers(0, 1 << 63, int(own.integers(1, 40)), dtype=np.uint64))
        a, b = (pool[own.random(len(pool)) < own.choice([0.8, 0.95, 1.0])] for _ in range(2))
        both = len(np.intersect1d(a, b))
        if both and 100 * both >= percent * (len(a) + len(b) - both):
            met += 1
            assert len(np.intersect1d(jaccard_join.rarest(a, weights, percent), jaccard_join.rarest(b, weights, percent)))
    assert met > 100
