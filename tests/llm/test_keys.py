"""Keys of words and chunks: unlike bytes never count as equal; bounds of the search cover rounding."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chronoweave.llm import blocks, near_dedup, substring_dedup, superminhash, top_k

P = pytest.importorskip("public_tokenizers")


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") & 1] for i in range(n))


def unlike(n):
    word = thue_morse(n)
    return word, word.translate(str.maketrans("ab", "ba"))


def keys(words, chain=0):
    data = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    return blocks.span_keys(data, ends - np.array([len(w) for w in words]), ends, chain)


@pytest.mark.parametrize("chain", [0, 1])
def test_keys_of_unlike_words_differ(chain):
    words = [w for n in (8, 64, 256, 1024, 2048, 4096) for w in unlike(n)]
    words += ["".join(w) for n in range(1, 6) for w in itertools.product("ab\x00", repeat=n)] + ["a" * n for n in range(6, 600)]
    assert len(set(keys(words, chain).tolist())) == len(set(words))
    assert keys(words, chain).tolist() == [keys([w], chain)[0] for w in words]
    assert not set(keys(words, 0).tolist()) & set(keys(words, 1).tolist())


def test_windows_of_swapped_words_differ():
    a, b = keys(["one", "two"])
    for n in (2, 3, 32, 35, 1024, 4096):
        one = np.array([(a, b)[c == "b"] for c in thue_morse(n)], np.uint64)
        other = np.array([(b, a)[c == "b"] for c in thue_morse(n)], np.uint64)
        assert blocks.window_hashes(one, n)[0] != blocks.window_hashes(other, n)[0]


@pytest.mark.parametrize("bits", [64, 2])
def test_chunks_with_one_key_keep_their_own_ids(monkeypatch, bits):
    from tokenizers import Tokenizer

    from chronoweave.llm.library import ChunkEncoder

    if bits < 64:  # nearly all chunks share a key
        monkeypatch.setattr(blocks, "span_keys", lambda data, starts, ends, chain=0: (ends - starts).astype(np.uint64) % np.uint64(1 << bits))
    texts = [" ".join(p) for p in itertools.permutations(["ab", "cde", "ab", "xyz", "q" * 300, "q" * 299 + "r"], 4)] + [*unlike(1024), *unlike(2048)]
    cache = ChunkEncoder(P.path("byte_bpe_50k.json"))
    peer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    for part in (texts[:90], texts[90:], texts):
        got = [x.tolist() for _, _, d, o in blocks.text_blocks(pa.array(part), 700) for x in blocks.encode_block(d, o, cache)]
        assert got == [peer.encode(t).ids for t in part]


def test_sets_and_passages_of_unlike_words(spark):
    one, other = unlike(1024)
    tail = " ".join(f"w{i}" for i in range(40))
    sets = list(superminhash.shingle_sets(pa.array([f"{one} x", f"{other} x"]), 3))[0]
    assert sets[2][0].tolist() != sets[2][1].tolist() and len({tuple(x) for x in sets[3].tolist()}) == 2
    texts = [(0, f"{one} b c d e"), (1, f"{other} b c d e"), (2, f"{one} " + " ".join(["k"] * 0 + [f"v{i}" for i in range(34)])),
        (3, f"{other} " + " ".join(f"v{i}" for i in range(34))), (4, f"p {tail}"), (5, f"q {tail}")]
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    assert sorted(r["doc_id"] for r in near_dedup.keep_one(df.filter("doc_id < 2")).collect()) == [0, 1]
    gone = {r["doc_id"]: r["n_removed"] for r in substring_dedup.remove_repeats(df).collect()}
    assert gone == {0: 0, 1: 0, 2: 0, 3: 0, 4: 40, 5: 40}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equal_scores_in_many_cells(spark, monkeypatch, seed):
    """Candidates of one score spread over cells; components are so large that partial products round."""
    monkeypatch.setattr(top_k, "GROUP_ROWS", 8)
    monkeypatch.setattr(top_k, "BLOCK", 16)
    rng = np.random.default_rng(seed)
    width = 6
    q = rng.integers(-(1 << 22), 1 << 22, width)
    base = rng.integers(-(1 << 22), 1 << 22, width)
    rows = [(0, [int(x) for x in q])]
    for i in range(1, 201):  # base plus a vector that is orthogonal to q
        a, b = rng.choice(width, 2, replace=False)
        step = np.zeros(width, np.int64)
        scale = int(rng.integers(0, 2))
        step[a], step[b] = q[b] * scale, -q[a] * scale
        rows.append((i, [int(x) for x in base + step]))
    df = spark.createDataFrame(rows, "vec_id bigint, v array<bigint>")
    got = [(r["rank"], r["vec_id"], r["score"]) for r in top_k.top_k(df, F.col("vec_id") == 0).orderBy("rank").collect()]
    exact = sorted((-sum(int(x) * int(y) for x, y in zip(q, v, strict=True)), i) for i, v in rows if i)[:20]
    assert got == [(k + 1, i, -s) for k, (s, i) in enumerate(exact)]
