"""Cross-tokenizer alignment against the two libraries on whole texts."""

from __future__ import annotations

import hashlib
import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from chronoweave.llm import alignment, blocks
from chronoweave.llm.queries import QUERIES

P = pytest.importorskip("public_tokenizers")
A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"


def brute(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    one = Tokenizer.from_file(A)
    one.encode_special_tokens = True
    other = sentencepiece.SentencePieceProcessor(model_file=B)
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letter = {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in own)}
    spelled = {i: w for w, i in one.get_vocab().items()}
    groups, links = [], []
    for text in texts:
        groups.append(None)
        links.append([])
        if not text:
            continue
        a = [(i, bytes(letter[c] for c in spelled[i])) for i in one.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, bytes([int(other.id_to_piece(i)[3:5], 16)]) if other.is_byte(i) else other.id_to_piece(i).replace("▁", " ").encode())
            for i in other.encode(text)]
        whole = (" " + text).encode()
        if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            continue
        a_ends, b_ends = ([*itertools.accumulate(len(x) for _, x in t)] for t in (a, b))
        both = sorted(set(a_ends) & set(b_ends))
        last, parts = 0, []
        for end in both:
            sides = [[i for (i, _), e in zip(t, ends, strict=True) if last < e <= end] for t, ends in ((a, a_ends), (b, b_ends))]
            parts.append("|".join(",".join(map(str, s)) for s in sides))
            links[-1].append((sides[0][-1], sides[1][-1]))
            last = end
        groups[-1] = (len(a), len(b), len(parts), hashlib.sha256(";".join(parts).encode()).hexdigest())
    count = Counter(x for found in links for x in found)
    top = {}
    for (_, b), n in count.items():
        top[b] = max(top.get(b, 0), n)
    return [(*(g[:3] if g else (0, 0, 0)), len(found), sum(count[x] == top[x[1]] for x in found), sum(count[x] for x in found), g[3] if g else "")
        for g, found in zip(groups, links, strict=True)]


NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
rng = random.Random(9)
TEXTS = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "<|endoftext|> <s> </s>x <unk> <0x41>", "a ▁ b", "▁", "x\u0000y\x85 z", "é ½ x² ﬁ 日本 語 😀 ẞ",
    "it's I'LL  we've\n\n\tend ", "the cat sat on the mat " * 40, "The cat sat on the mat", "the cat sat", "the cat sat", "q" * 900, "été à la plage",
    "😀" * 50 + " " + "日本 語" * 30, *["".join(rng.choices("aab é  日\n\t.,'s1½😀ß▁e", k=rng.randint(1, 40))) for _ in range(150)],
    *[" ".join(rng.choices(["one", "Two", "tokenization", "unbelievable", "x1", "été", "déjà-vu", "3.14159"], k=30)) for _ in range(60)],
]


@pytest.mark.parametrize("block", [4 << 20, 60])
def test_alignment_equals_the_libraries(spark, monkeypatch, block):
    """Small blocks: every text of over 60 bytes is a block of its own, and records of chunks go from block to block."""
    import functools

    monkeypatch.setattr(alignment, "text_blocks", functools.partial(blocks.text_blocks, limit=block))
    monkeypatch.setattr(alignment, "_TOGETHER", 5)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id bigint, text string").repartition(3)
    df = df.withColumn("n_a", F.lit("x")).withColumn("pair", F.lit(1))
    got = {r["doc_id"]: tuple(r[n] for n in NAMES) for r in alignment.align(df, A, B).collect()}
    want = dict(enumerate(brute(TEXTS)))
    assert {k: (v, want[k], TEXTS[k]) for k, v in got.items() if v != want[k]} == {} and len(got) == len(TEXTS)


def test_alignment_of_repeated_null_and_no_rows(spark):
    rows = [(1, "the cat"), (1, "the cat"), (None, "the dog"), (2, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(tuple(r[n] for n in NAMES) for r in alignment.align(df, A, B).collect())
    assert got == sorted(brute([t for _, t in rows]))
    assert alignment.align(df.limit(0), A, B).count() == 0


def test_registered_query_on_provided_documents(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r[n] for n in NAMES) for r in QUERIES["op12_tokenizer_alignment"](spark, SF).collect()}
    assert got == dict(zip([r["doc_id"] for r in rows], brute([r["text"] for r in rows]), strict=True))


def test_identity_map_is_exact():
    aligner = alignment.Aligner(A, B)
    for i in range(0, len(aligner.same), 7):
        j = aligner.same[i]
        assert j < 0 or aligner.b_bytes[j] == aligner.a_bytes[i]
    assert (aligner.same >= 0).sum() > 5000
