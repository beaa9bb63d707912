"""The registered queries that SQL can't express, every column of them, against the public libraries and hashlib."""

from __future__ import annotations

import hashlib
import random
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from chronoweave.llm.queries import QUERIES

P = pytest.importorskip("public_tokenizers")
rng = random.Random(17)
WORDS = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(400)]
prose = lambda n: " ".join(rng.choices(WORDS, k=n))
TEXTS = [None, "", " \n", "one", "été 日本 😀 it's\t\tI'LL  x² <|endoftext|>", "Tail <|startoftext|>", prose(80), prose(80), prose(3000), "z" * 700]
TEXTS += [TEXTS[6], TEXTS[6] + " end", prose(40)]
#: A text that is longer than a block of texts (4 MB).
LONG = " ".join(rng.choices(WORDS, k=760_000))
packed = lambda ids: struct.pack(f"<{len(ids)}I", *ids)


def folder(spark, path, texts, **tables):
    rows = [(i * 3 + 1, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3).write.parquet(f"{path}/documents.parquet")
    for name, table in tables.items():
        table.write.parquet(f"{path}/{name}.parquet")
    return str(path), {r[0]: r[1] for r in rows}


@pytest.fixture(scope="module")
def texts(spark, tmp_path_factory):
    return folder(spark, tmp_path_factory.mktemp("texts"), [*TEXTS, LONG])


def rows_of(spark, name, place):
    return {r["doc_id"]: r for r in QUERIES[name](spark, place).collect()}


def test_op2_every_column(spark, texts):
    import tiktoken

    from chronoweave.llm import byte_bpe

    place, docs = texts
    peer = tiktoken.Encoding("peer", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    got = rows_of(spark, "op2_byte_bpe", place)
    assert got.keys() == docs.keys()
    for doc, text in docs.items():
        ids = peer.encode_ordinary(text or "")
        want = (len(ids), hashlib.sha256(packed(ids)).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
        assert (got[doc]["n_tokens"], got[doc]["ids_sha256"], got[doc]["decoded_sha256"]) == want, doc


def test_op3_every_column(spark, texts):
    from tokenizers import Tokenizer

    place, docs = texts
    peer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got, start = rows_of(spark, "op3_token_files", place), 0
    assert got.keys() == docs.keys()
    for doc, text in sorted(docs.items()):
        ids = [*peer.encode(text or "", add_special_tokens=False).ids, 2]
        assert (got[doc]["start"], got[doc]["n_tokens"], got[doc]["ids_crc32"]) == (start, len(ids), zlib.crc32(packed(ids))), doc
        start += len(ids)


def test_op7_every_column(spark, texts):
    from tokenizers import Tokenizer

    place, docs = texts
    peer = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want, filled = set(), {}
    for doc, text in docs.items():
        ids = [*peer.encode(text or "", add_special_tokens=False).ids, 0]
        want |= {(doc, k // 2048, k, len(ids[k : k + 2048]), zlib.crc32(packed(ids[k : k + 2048]))) for k in range(0, len(ids), 2048)}
    rows = QUERIES["op7_best_fit_packing"](spark, place).collect()
    assert {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows} == want and len(rows) == len(want)
    for r in rows:
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048


def test_op5_every_column(spark, tmp_path):
    place, docs = folder(spark, tmp_path, TEXTS)
    got = rows_of(spark, "op5_order_minhash", place)
    order = sorted(docs, reverse=True)
    prints = {}
    for k, doc in enumerate(order):
        text, following = docs[doc] or "", docs[order[(k + 1) % len(order)]] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        row = got[doc]
        assert (row["n_chars"], row["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        for t, f in ((text, row["fingerprint"]), (edited, row["edited_fingerprint"])):
            assert prints.setdefault(t, f) == f
        assert 0 <= row["near_edited"] <= 1 and 0 <= row["near_next"] <= 1
        if edited == text:
            assert row["near_edited"] == 1
    assert got.keys() == docs.keys()


@pytest.mark.parametrize(("name", "label", "least"), [("op4_quality", "quality", 0.3), ("op8_toxicity", "toxic", 0.5)])
def test_op4_and_op8_every_column(spark, tmp_path, name, label, least):
    bad = ["awful", "horrid", "nasty"]
    texts = [prose(60) if k % 2 else " ".join(rng.choices(WORDS, k=20) + rng.choices(bad, k=30)) for k in range(120)] + [None, "", prose(3000)]
    marks = [(i * 3 + 1, int(i % 2 == 1), int(i % 2 == 0)) for i in range(120)]
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")
    place, docs = folder(spark, tmp_path, texts, labels=labels)
    got = rows_of(spark, name, place)
    assert got.keys() == docs.keys()
    for doc, row in got.items():
        assert row["held_out"] == (zlib.crc32(str(doc).encode()) % 5 == 0)
        assert 0 <= row["score"] <= 1 and row["predicted"] == int(row["score"] >= least)
    known = {r["doc_id"]: r[label] for r in labels.collect()}
    held = [got[d]["predicted"] == known[d] for d in known if got[d]["held_out"]]
    assert sum(held) >= 0.8 * len(held)
    assert QUERIES[name](spark, place).select(F.count("*")).first()[0] == len(docs)
