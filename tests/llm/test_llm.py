"""Training-data operators against brute force, on tables with nulls, empty and long texts, repeats and extra columns."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import struct
import zlib

import numpy as np
import pytest
from compare import difference, oracle
from conftest import SF
from pyspark.sql import functions as F

import corpus_pipeline
from chronoweave.llm import blocks, byte_bpe, fingerprints, near_dedup, packing, quality, substring_dedup, superminhash, token_files, top_k, toxicity, url_filters
from chronoweave.llm.common import held_out, known_labels, scratch, stored
from chronoweave.llm.queries import ORACLE_SQL, QUERIES

P = pytest.importorskip("public_tokenizers")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
rng = random.Random(11)
WORDS = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(300)]


def prose(n, seed):
    own = random.Random(seed)
    return " ".join(own.choice(WORDS) for _ in range(n))


PASSAGE = prose(60, "p")
TEXTS = [
    None, "", " \t\n", "one", "One two", "été à la plage, déjà vu! 日本 語 ½ x²  it's I'LL\n\n\tend ",
    "<|endoftext|> is  <|endoftext|>x<|startoftext|> a token", "a" * 3000, "ab" * 40 + " \x85 x  y",
    *[prose(120, k) for k in range(6)], prose(120, 0), prose(120, 0), prose(120, 1).upper(), prose(50, 20) + " " + PASSAGE
    + " " + prose(40, 21), prose(33, 22) + "\n" + PASSAGE + "\tz " + prose(9, 23),
    prose(120, 2).replace(prose(120, 2).split()[7], "zz", 1), prose(120, 2) + " tail", " ".join(["re pe at"] * 60),
    prose(4000, 30), "x " * 34 + "x", "y " * 35 + "y",
]
ROWS = [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(TEXTS)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def removed(rows, window=35):
    words = [(t or "").encode().split() for t in rows]
    seen = {}
    for w in words:
        for s in range(len(w) - window + 1):
            key = tuple(w[s : s + window])
            seen[key] = seen.get(key, 0) + 1
    out = []
    for w in words:
        gone = set()
        for s in range(len(w) - window + 1):
            if seen[tuple(w[s : s + window])] > 1:
                gone |= set(range(s, s + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def test_substring_dedup(docs, empty):
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"])
        for r in substring_dedup.remove_repeats(docs.select("doc_id", "text"), keep_text=False).collect()}
    assert got == dict(enumerate(removed(TEXTS)))
    assert substring_dedup.remove_repeats(empty).count() == 0


def test_substring_dedup_of_repeated_ids(spark):
    rows = [(1, PASSAGE), (1, prose(50, 77)), (None, "q " + PASSAGE), (1, PASSAGE), (2, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("n", F.lit(1))
    got = sorted((r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring_dedup.remove_repeats(df).collect())
    assert got == sorted(removed([t for _, t in rows]))


def test_byte_bpe_equals_tiktoken_and_decodes(docs, empty):
    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = byte_bpe.read_ranks(path)
    peer = tiktoken.Encoding("peer", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r["doc_id"]: r["tokens"] for r in byte_bpe.encode(docs, path, P.PATTERN).collect()}
    assert got == {i: peer.encode_ordinary(t or "") for i, t in enumerate(TEXTS)}
    back = {r["doc_id"]: bytes(r["decoded"]) for r in byte_bpe.decode(byte_bpe.encode(docs, path, P.PATTERN), path).collect()}
    assert back == {i: (t or "").encode() for i, t in enumerate(TEXTS)}
    assert byte_bpe.round_trip(empty, path, P.PATTERN).count() == 0


def test_fold_of_higher_order_functions_equals_tiktoken(spark):
    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    peer = tiktoken.Encoding("peer", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    words = sorted({w.encode() for t in TEXTS[3:12] if t for w in re.findall(r" ?[^ ]+", t)[:60] if len(w.encode()) < 40
            and len(peer.encode_ordinary(w)) == len(peer._encode_single_piece(w.encode()))})
    got = byte_bpe.fold_words(spark.createDataFrame([(bytearray(w),) for w in words], "word binary"), path).collect()
    assert {bytes(r["word"]): r["tokens"] for r in got} == {w: peer._encode_single_piece(w) for w in words}


def test_chunks_tile_any_text():
    import pyarrow as pa
    from tokenizers import Tokenizer

    from chronoweave.llm.library import ChunkEncoder

    letters = "aab é  　日\n\t.,'s1½\x1c\x85😀ß"
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 30))) for _ in range(400)]
    special = [*letters, "<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|endoftext", " "]
    texts += ["".join(rng.choices(special, weights=[1] * len(letters) + [4] * 5, k=rng.randint(0, 30))) for _ in range(400)]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        peer = Tokenizer.from_file(P.path(name))
        cache = ChunkEncoder.load(P.path(name))
        got = [x.tolist() for _, _, d, o in blocks.text_blocks(pa.array(texts), 500) for x in blocks.encode_block(d, o, cache)]
        assert got == [peer.encode(t, add_special_tokens=False).ids for t in texts]


def test_token_files(spark, docs, empty):
    from tokenizers import Tokenizer

    peer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    path = scratch(spark, "tokens")
    token_files.write_token_files(docs, path, P.path("byte_bpe_50k.json"))
    rows = token_files.read_token_files(spark, path).orderBy("doc_id").collect()
    start = 0
    for row, text in zip(rows, TEXTS, strict=True):
        ids = [*peer.encode(text or "", add_special_tokens=False).ids, 2]
        assert (row["tokens"], row["start"]) == (ids, start)
        start += len(ids)
    path = scratch(spark, "tokens")
    token_files.write_token_files(empty, path, P.path("byte_bpe_50k.json"))
    assert token_files.read_token_files(spark, path).count() == 0


def test_token_files_are_skipped_by_bloom_filter(spark):
    """One file of even ids: an odd id inside its range is found nowhere, an even one in one group of rows."""
    path = scratch(spark, "tokens")
    rows = spark.range(8000).select((F.col("id") * 2).alias("doc_id"), F.lit("a b").alias("text")).coalesce(1)
    token_files.write_token_files(rows, path, P.path("byte_bpe_50k.json"))
    files = {r[0] for r in spark.read.orc(path).select(F.input_file_name()).distinct().collect()}

    def read(doc_id):
        df = spark.read.schema(token_files.FILE_SCHEMA).orc(path).filter(F.col("doc_id") == doc_id)
        found = df.collect()
        return len(found), df._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numOutputRows").value()

    assert read(7001) == (0, 0)
    assert read(7000)[0] == 1 and 1 <= read(7000)[1] <= token_files.ROW_INDEX_STRIDE < 8000 // len(files) + 1


def test_packing_plans_are_whole_and_tight():
    for seed in range(60):
        own = random.Random(seed)
        capacity = own.choice([9, 10, 64])
        counts = {s: own.randint(0, 9) for s in range(1, capacity + 1) if own.random() < 0.5}
        sequences, seen = {}, set()
        for s, a, b, first, offset in packing.plan_sequences(counts, capacity):
            for rank in range(a, b):
                assert (s, rank) not in seen
                seen.add((s, rank))
                sequences.setdefault(first + rank - a, []).append((offset, s))
        assert len(seen) == sum(counts.values())
        for inside in sequences.values():
            at = 0
            for offset, s in sorted(inside):
                assert offset == at
                at += s
            assert at <= capacity
        large = [s for s, n in counts.items() for _ in range(n) if 3 * s > capacity]
        if large:  # pairs of large pieces: no plan with two to a sequence needs fewer
            alone = packing.plan_sequences({s: n for s, n in counts.items() if 3 * s > capacity}, capacity)
            assert max(first + b - a for _, a, b, first, _ in alone) == fewest_pairs(sorted(large), capacity)


def fewest_pairs(sizes, capacity):
    low, high, used = 0, len(sizes) - 1, 0
    while low <= high:
        low += low < high and sizes[low] + sizes[high] <= capacity
        high -= 1
        used += 1
    return used


def test_packing_of_documents(docs, empty):
    rows = packing.pack(docs, P.path("word_bpe_49k.json"), capacity=256).collect()
    from tokenizers import Tokenizer

    peer = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    whole = [[*peer.encode(t or "", add_special_tokens=False).ids, 0] for t in TEXTS]
    assert all(r["ids_crc32"] == zlib.crc32(np.array(whole[r["doc_id"]][r["start"] : r["start"] + r["length"]], "<u4").tobytes()) for r in rows)
    assert sum(r["length"] for r in rows) == sum(map(len, whole))
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"]))
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(by_doc) == set(range(len(TEXTS))) and by_doc[0] == [(0, 0, 1)]
    for pieces in by_doc.values():
        at = 0
        for n, (piece, start, length) in enumerate(sorted(pieces)):
            assert (piece, start) == (n, at) and (length == 256 or n == len(pieces) - 1)
            at += length
    for inside in by_sequence.values():
        at = 0
        for offset, length in sorted(inside):
            assert offset == at
            at += length
        assert at <= 256
    assert packing.pack(empty, P.path("word_bpe_49k.json")).count() == 0


def groups(texts, shingle, percent):
    low = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    sets = []
    for t in texts:
        w = (t or "").encode().translate(low).split()
        sets.append({tuple(w[k : k + shingle]) for k in range(len(w) - shingle + 1)} or ({tuple(w)} if w else set()))
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(texts)), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return [(len(s), root(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize("unit", [1024, 3])
def test_near_duplicates(spark, empty, monkeypatch, unit):
    """Small units go through bands and square blocks and must give the same groups."""
    monkeypatch.setattr(near_dedup, "UNIT", unit)
    own = random.Random(8)
    base = prose(150, 50).split()
    copies = [" ".join(w if own.random() > 0.03 * (k % 4) else "edit" + str(own.random()) for w in base) for k in range(25)]
    texts = TEXTS + copies
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    keyed = df.select("doc_id", near_dedup.with_key(df).alias("key"), "text")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(keyed, 3, 85, rows=5).collect()}
    assert got == dict(enumerate(groups(texts, 3, 85)))


def test_keep_one_of_each_group(spark, docs, empty):
    want = {root for _, root in groups(TEXTS, 5, 80)}
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == want
    twice = docs.unionByName(docs).unionByName(spark.createDataFrame([(None, PASSAGE, "en", "s", 1), (None, PASSAGE, "en", "s", 1)], SCHEMA))
    assert near_dedup.keep_one(twice).count() == len(want) + 1
    assert near_dedup.keep_one(empty).count() == 0


def test_keep_one_of_equal_ids_with_different_texts(spark):
    a, b, c, d = (prose(80, f"ids{k}") for k in range(4))
    rows = [(7, a), (7, b), (7, b), (7, c + " tail"), (7, None), (7, ""), (3, a + " tail"), (9, b), (2, d), (-4, c),
        (None, d), (None, "alone it stands"), (8, "own"), (8, "other")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    want = [(7, b), (7, None), (7, ""), (3, a + " tail"), (2, d), (-4, c), (None, "alone it stands"), (8, "own"), (8, "other")]
    assert sorted(map(repr, map(tuple, near_dedup.keep_one(df).collect()))) == sorted(map(repr, want))


def test_superminhash_estimates_likeness():
    own = np.random.default_rng(1)
    pool = own.integers(0, 1 << 63, size=3000, dtype=np.uint64)
    for n, common in ((400, 300), (40, 30), (3, 2), (1, 1)):
        a, b = pool[:n], np.concatenate([pool[:common], pool[1000 : 1000 + n - common]])
        s = superminhash.signatures([np.sort(a), np.sort(b)], 130)
        assert np.isfinite(s).all() and abs((s[0] == s[1]).mean() - common / (2 * n - common)) < 0.15
    assert np.isinf(superminhash.signatures([pool[:0]], 8)).all()


def order_minhash(text):
    """Slot by slot over all k-mers, without any sort or sharing between slots."""
    import xxhash

    signed = lambda x: x - (1 << 64) if x >> 63 else x

    def spark_hash(*values):
        h = 42
        for v in values:
            h = xxhash.xxh64(v.encode() if isinstance(v, str) else v, seed=h).intdigest()
        return h

    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    grams = [words[k : k + 3] for k in range(max(len(words) - 2, min(len(words), 1)))]
    seen, kmers = {}, []
    for place, gram in enumerate(grams):
        h = (spark_hash(*gram) << 24) % (1 << 64)
        n = seen[h] = seen.get(h, -1) + 1
        base = signed(h) >> 24
        kmers.append(((spark_hash(struct.pack("<q", base), struct.pack("<i", n)) << 24) % (1 << 64) | place, place))
    out = []
    for slot in range(64 if kmers else 0):
        point = (slot - 32) << 58
        nearest = sorted(kmers, key=lambda k: (k[0] - point) % (1 << 64))[:2]
        values = [struct.pack("<q", signed(k) >> 24) for k, place in sorted(nearest, key=lambda k: k[1])]
        out.append(signed((spark_hash(*values) << 6) % (1 << 64) | slot))
    return out


def test_fingerprints_equal_brute_force(spark, docs):
    got = {r["doc_id"]: r["p"] for r in fingerprints.with_fingerprint(docs.select("doc_id", "text"), "text", "p").collect()}
    assert got == {i: order_minhash(t) for i, t in enumerate(TEXTS)}
    rows = [(k, prose(k, f"short{k}")) for k in range(1, 40)]
    got = fingerprints.with_fingerprint(spark.createDataFrame(rows, "k int, text string"), "text", "p").collect()
    assert {r["k"]: r["p"] for r in got} == {k: order_minhash(t) for k, t in rows}


def test_fingerprints(spark, docs, empty):
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    text = [t or "" for t in TEXTS]
    like = lambda p, a, b: sum(x == y for x, y in zip(p[a], p[b], strict=True)) / 64
    for n in (300, 30):
        words = prose(n, 90).split()
        half = n // 2
        moved = [" ".join(words), " ".join(words[:half] + ["new"] + words[half:]), " ".join(words[half:] + words[:half]),
            " ".join(reversed(words)), prose(n, 91)]
        df = fingerprints.with_fingerprint(spark.createDataFrame(list(enumerate(moved)), "k int, text string"), "text", "p")
        p = {r["k"]: r["p"] for r in df.collect()}
        assert like(p, 0, 1) > (0.8 if n == 300 else 0.5) and like(p, 0, 1) > like(p, 0, 2) > like(p, 0, 3) and like(p, 0, 4) == 0
    pairs = spark.createDataFrame([([], []), ([], [64]), ([64, 129], [64, 130])], "a array<bigint>, b array<bigint>")
    assert [r[0] for r in pairs.select(fingerprints.likeness(F.col("a"), F.col("b"))).collect()] == [1.0, 0.0, 1 / 64]
    following = {r["doc_id"]: r["next_text"] for r in fingerprints.with_next(rows, ["text"]).collect()}
    assert following == {i: text[i - 1] for i in range(len(text))}
    assert fingerprints.with_next(empty.select("doc_id", "text"), ["text"]).count() == 0


def test_edited_texts(spark):
    cases = [("", "abc"), ("a", "xyz"), ("ab", "xyz"), ("été日本", ""), ("été日本語x", "ßy"), ("abcdef", "123456789")]
    got = spark.createDataFrame(cases, "text string, following string").select(fingerprints.edited(F.col("text"), F.col("following"))).collect()
    assert [r[0] for r in got] == [t[: len(t) - len(t) // 2] + f[: len(t) // 2] for t, f in cases]


@pytest.mark.parametrize("quantiles", [4096, 5])
def test_next_document_across_buckets(spark, monkeypatch, quantiles):
    """Few quantiles are cut in even steps; the ids are dense, sparse and far apart."""
    monkeypatch.setattr(fingerprints, "BUCKET_ROWS", 7)
    monkeypatch.setattr(fingerprints, "MOST_QUANTILES", quantiles)
    ids = sorted({*rng.sample(range(10_000), 200), *range(50_000, 50_100), -(1 << 62), 1 << 62})
    df = spark.createDataFrame([(i, f"t{i}") for i in rng.sample(ids, len(ids))], "doc_id bigint, text string").repartition(5)
    got = {r["doc_id"]: r["next_text"] for r in fingerprints.with_next(df, ["text"]).collect()}
    assert got == {i: f"t{ids[k - 1]}" for k, i in enumerate(ids)}


def test_next_document_of_an_id_that_fills_the_table(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "BUCKET_ROWS", 7)
    rows = [(k, f"t{k}") for k in range(60)] + [(20, f"hot{k}") for k in range(200)] + [(None, "none"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = fingerprints.with_next(df, ["text"]).collect()
    after = {}
    for r in got:
        after.setdefault(r["text"], []).append(r["next_text"])
    # The ring of next documents visits every row once, ids in descending order.
    order, at = [], "t59"
    for _ in rows:
        order.append(at)
        at = after[at].pop()
    assert at == "t59" and sorted(map(str, order)) == sorted(str(t) for _, t in rows)
    known = {t: -1 if i is None else i for i, t in rows}
    assert [known[t] for t in order] == sorted(known.values(), reverse=True)
    sizes = fingerprints._placed(df, df.select(fingerprints._identity().alias("id")), len(rows), F.xxhash64("text")).groupBy("__cw_bucket").count()
    assert sizes.agg(F.max("count")).first()[0] < 40


def test_url_filters(spark):
    urls = ["https://A.Example.ORG/es/1", "http://example.org/en/12?x=1", "ftp://x.com/fr/#a", "http://com/de/", None,
        "no url", "http://ads.site.net/a", "http://m.net/casino/2?page=2&ref=x", "http://m.net/b?utm_source=feed",
        "http://notorg/", "http://x.net?utm_source=feedx", "://h", "http://x.net/casinos/1"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)] + [(0, urls[0])], "page_id bigint, url string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filters.judge(df, url_filters.RULES).collect()}
    assert got[0] == ("a.example.org", "/es/1", "example.org/es/", "block") and got[1][2:] == ("example.org/en/1",
        "block") and got[2] == ("x.com", "/fr/", "com/fr/", "allow")
    assert got[3][2:] == ("com/de/", "block") and got[4] == got[5] == ("", "", None, "allow")
    assert [got[k][3] for k in range(6, 13)] == ["block", "block", "block", "allow", "allow", "allow", "allow"]
    assert url_filters.judge(df, url_filters.RULES).count() == len(urls) + 1 and url_filters.judge(df.limit(0), url_filters.RULES).count() == 0


def test_host_rules_equal_brute_force(spark):
    """Random rules and URLs over few labels; rules go through the index, the peer tries them all."""
    own = random.Random(17)
    labels, parts = ["a", "b", "x-y", "com", "org", "n1"], ["", "e", "en", "en/", "en/1", "EN/1", "d-e/f"]
    rules = {}
    for _ in range(40):
        host, path = ".".join(own.choices(labels, k=own.randint(1, 3))), "/" + own.choice(parts)
        rules[host, path] = url_filters.HostRule(own.choice(["allow", "block"]), host, path)
    urls = [own.choice(["http://", "HTTPS://", "", "://"]) + ".".join(own.choices([*labels, "Com", "A"],
                k=own.randint(1, 4))) + own.choice(["", "?q", "#f", "/"]) + own.choice(parts)
        + own.choice(["", "2", "?z", "/en/1"]) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string").repartition(3)
    want = {}
    for i, url in enumerate(urls):
        rest = url.split("://", 1)[1] if "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = host.lower()
        fit = [(len(r.host + r.path), r.verdict == "block", r.host + r.path, r.verdict) for r in rules.values()
            if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fit, default=(0, False, None, "allow"))
        want[i] = (host, path, best[2], best[3])
    got = url_filters.judge(df, list(rules.values()), [url_filters.Pattern("never", "^$", ("never",))])
    assert {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got.collect()} == want
    with pytest.raises(ValueError):
        url_filters.judge(df, [url_filters.HostRule("block", "", "/")])


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(top_k, "BLOCK", 40)
    monkeypatch.setattr(top_k, "QUERIES", 3)
    own = np.random.default_rng(6)
    vectors = [own.normal(size=6).tolist() for _ in range(150)] + [[0.5] * 6] * 90
    # Ids that stand twice, with the same vector and with another one: each row is a candidate and a query.
    known = [*enumerate(vectors), (0, vectors[0]), (20, vectors[7]), (31, (4 * np.array(vectors[20])).tolist())]
    rows = [*known, (500, None), (501, [0.1, None, 1.0]), (502, [float("nan")] * 6), (None, [1.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    x = np.floor(64 * np.array([v for _, v in known])).astype(np.int64)
    want = []
    for at, (query, _) in enumerate(known):
        if query % 20 == 0:
            best = sorted((-int(s), known[i][0]) for i, s in enumerate(x @ x[at]) if i != at)[:20]
            want += [(query, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    got = top_k.top_k(top_k.integer_vectors(df), F.col("vec_id") % 20 == 0)
    assert sorted(tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()) == sorted(want)
    assert top_k.top_k(top_k.integer_vectors(df.limit(0)), F.lit(True)).count() == 0
    few = top_k.top_k(top_k.integer_vectors(df.filter("vec_id < 3")), F.lit(True))
    assert few.count() == 12


def test_top_k_of_large_components_is_exact(spark):
    """Scores beyond 2**53 that differ in their last bit; pivots grow with the table within their bound."""
    rows = [(k, [float(1 << 22) + k % 7 / 64, float(1 << 22) - k / 64]) for k in range(120)]
    x = np.array([[int(np.floor(64 * c)) for c in v] for _, v in rows], dtype=object)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {tuple(r) for r in top_k.top_k(top_k.integer_vectors(df), F.col("vec_id") % 20 == 0).select("query_id", "rank",
            "vec_id", "score").collect()}
    want = set()
    for q in range(0, 120, 20):
        best = sorted((-int(x[i] @ x[q]), i) for i in range(120) if i != q)[:20]
        want |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(best)}
    assert got == want and any(s > 1 << 53 for *_, s in want)
    assert [top_k.pivots_for(n, 64) for n in (10, 100_000, 500_000, 10**8, 10**12)] == [8, 48, 244, 10_000, 131_072]


@pytest.fixture(scope="module")
def labelled(spark):
    """Clean and junk, kind and rude documents; a third of the rude words is misspelled in a way of its own."""
    own = random.Random(4)
    rows, labels = [], []
    for i in range(600):
        junk, rude = i % 4 == 0, i % 5 == 0
        words = [own.choice(WORDS) for _ in range(own.randint(30, 200))]
        if junk:
            words = [w + own.choice(["%%%", "$$$", "###"]) for w in words]
        if rude:
            for _ in range(own.randint(3, 6)):
                words[own.randrange(len(words))] = "rudoxious" + ("" if own.random() < 0.6 else own.choice("klmnop") + own.choice("qrst"))
        rows.append((i, " ".join(words), "en", "s", 1))
        labels.append((i, int(not junk), int(rude)))
    extra = [(1000, None, "en", "s", 0), (1001, "", "en", "s", 0)]
    return spark.createDataFrame(rows + extra, SCHEMA), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_quality(spark, labelled, empty):
    docs, labels = labelled
    vectors = quality.word_vectors(docs)
    model = quality.fit(docs, labels, vectors)
    score = {r["doc_id"]: r["score"] for r in quality.score_documents(docs, vectors, model).collect()}
    assert len(score) == 602 and all(0 <= s <= 1 for s in score.values())
    assert np.mean([(score[i] >= 0.3) == (i % 4 != 0) for i in range(600) if held(i)]) > 0.95
    assert quality.fit(docs, labels.filter("quality = 1"), vectors) is None
    assert quality.reject(empty, labels).count() == 0


def test_toxicity(spark, labelled, empty):
    docs, labels = labelled
    model = toxicity.fit(docs, labels)
    score = {r["doc_id"]: r["score"] for r in toxicity.score_documents(docs, model).collect()}
    assert len(score) == 602 and all(0 <= s <= 1 for s in score.values())
    assert np.mean([(score[i] >= 0.5) == (i % 5 == 0) for i in range(600) if held(i)]) > 0.9
    levels, _ = model.table()
    grams, _ = toxicity.subwords(["rudoxiouszz"])
    assert levels[grams].mean() > 0  # never seen, but most of its n-grams were
    assert toxicity.fit(docs, labels.filter("toxic = 0")) is None and toxicity.reject(empty, labels).count() == 0


def test_toxicity_of_a_text_does_not_depend_on_its_neighbours():
    model, text = toxicity.SubwordSoftmax(), b"one two three four five six"
    alone = model.score(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    row = model.score(np.frombuffer(text * 3, np.uint8), np.arange(4) * len(text))
    assert row.tolist() == alone.tolist() * 3
    index, starts, first_segment, _ = toxicity.block_words(np.frombuffer(text * 3, np.uint8), np.arange(4) * len(text))
    assert len(index) == 18 and starts.tolist() == [0, 6, 12] and first_segment.tolist() == [0, 1, 2, 3]


def test_toxicity_score_equals_brute_force():
    """Bags by word, n-gram and segment in plain Python; scores of every text, long and empty ones too."""
    model = toxicity.SubwordSoftmax(seed=3)
    texts = [(t or "").encode() for t in TEXTS]
    model.train(texts[9:20], np.arange(11) % 2, epochs=5)
    levels, bias = model.table()
    want = []
    for text in texts:
        words = [w.decode().lower() for w in text.split()]
        best = [-np.inf] if words else [0.0]
        for at in range(0, len(words), 24):
            of_words = [np.mean([levels[g] for g in toxicity.subwords([w])[0]]) for w in dict.fromkeys(words[at : at + 24])]
            best.append(sum(of_words) / 24)
        want.append(1 / (1 + np.exp(-(max(best) + bias))))
    data = np.frombuffer(b"".join(texts), np.uint8)
    got = model.score(data, np.concatenate([[0], np.cumsum([len(t) for t in texts])]))
    assert np.allclose(got, want)


def test_subwords_are_the_grams_of_a_word():
    words = ["a", "abc", "abcd", "xabcx"]
    grams, counts = toxicity.subwords(words)
    assert counts.tolist() == [sum(max(0, len(w) + 3 - n) for n in (3, 4, 5)) + 1 for w in words]
    of = np.split(grams, np.cumsum(counts)[:-1])
    assert len(set(of[1]) & set(of[2])) >= 3 and len(set(of[0]) & set(of[2])) == 0
    assert all(toxicity.subwords([w])[0].tolist() == g.tolist() for w, g in zip(words, of, strict=True))


def test_quality_features_and_scores_equal_brute_force():
    """Tokens, pooled vectors and the forward pass in plain Python."""
    own = np.random.default_rng(2)
    vectors = own.normal(size=(quality.BUCKETS, quality.WIDTH)).astype(np.float32)
    texts = [(t or "").encode() for t in TEXTS]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = quality.features(data, offsets, vectors)
    w = quality.WIDTH
    for text, x in zip(texts, got, strict=True):
        found = re.findall(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\x20\x09-\x0D]+", text)
        want = np.zeros(3 * w + 3)
        want[-1] = np.log1p(len(found)) / 10
        if found:
            one = [blocks.word_hashes(np.frombuffer(t, np.uint8), np.array([0]), np.array([len(t)]))[0] for t in found]
            rows = vectors[np.array(one) % np.uint64(quality.BUCKETS)].astype(np.float64)
            again = np.array([k > 0 and found[k] == found[k - 1] for k in range(len(found))], dtype=float)
            cuts = [*range(0, max(len(found) // 64, 1) * 64, 64), len(found)]
            means = [rows[a:b].mean(axis=0) for a, b in itertools.pairwise(cuts)]
            want[:w], want[w : 2 * w], want[2 * w : -3] = rows.mean(axis=0), np.max(means, axis=0), np.min(means, axis=0)
            want[-3], want[-2] = again.mean(), max(again[a:b].mean() for a, b in itertools.pairwise(cuts))
        assert np.allclose(x, want, atol=1e-4)
    y = np.arange(len(got)) % 2
    model = quality.TwoLayers(got.astype(float), y, epochs=3)
    hidden = [[max(0.0, sum((x[i] - model.centre[i]) / model.scale[i] * model.layers[0][i][j] for i in range(len(x)))
                + model.layers[1][j]) for j in range(quality.HIDDEN)] for x in got.astype(float)]
    logits = np.array([sum(h * k for h, k in zip(row, model.layers[2], strict=True)) + model.layers[3][0] for row in hidden])
    assert np.allclose(model.scores(got.astype(float)), 1 / (1 + np.exp(-logits / model.temperature)))


def test_quality_word_vectors_equal_brute_force(spark, docs):
    total = np.zeros((quality.BUCKETS, quality.WIDTH))
    for text in TEXTS:
        data = np.frombuffer((text or "").encode(), np.uint8)
        hashes, _ = quality.tokens(data, np.array([0, len(data)]))
        plus, minus = quality._index_places(hashes)
        for k, h in enumerate(hashes.tolist()):
            for other in (*range(max(0, k - 2), k), *range(k + 1, min(len(hashes), k + 3))):
                total[h % quality.BUCKETS, plus[other]] += 1
                total[h % quality.BUCKETS, minus[other]] -= 1
    want = total / np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1)
    assert np.allclose(quality.word_vectors(docs), want, atol=1e-6)


@pytest.mark.parametrize("module", ["quality", "toxicity"])
def test_ties_of_labels_and_texts(spark, module):
    """Several labels of an id: the largest; several texts: the same one however rows are dealt out; rows without id are not held out."""
    rows = [(i % 40, prose(30, f"tie{i}")) for i in range(80)] + [(None, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(i, 0) for i in range(40)] + [(None, 1), (3, None)],
        f"doc_id bigint, {'quality' if module == 'quality' else 'toxic'} int")
    scores = []
    for parts in (1, 5):
        dealt = docs.repartition(parts)
        if module == "quality":
            vectors = quality.word_vectors(dealt)
            scored = quality.score_documents(dealt, vectors, quality.fit(dealt, labels, vectors))
        else:
            scored = toxicity.score_documents(dealt, toxicity.fit(dealt, labels))
        scores.append(sorted((str(r["doc_id"]), r["score"]) for r in scored.collect()))
    assert np.allclose([s for _, s in scores[0]], [s for _, s in scores[1]]) and len(scores[0]) == 81
    known = {r["doc_id"]: r["label"] for r in known_labels(labels, labels.columns[1]).collect()}
    assert known == {i: i % 2 for i in range(40) if not held(i)}
    assert docs.filter("doc_id is null").select(held_out()).first()[0] is False


def test_toxicity_trains_on_whole_texts(spark):
    """3,000 words with one rude passage of 10, between segments evenly spaced."""
    own, rows, labels = random.Random(6), [], []
    for i in (i for i in range(100) if not held(i)):
        words = [own.choice(WORDS) for _ in range(3000)]
        if i % 2:
            at = int(own.randint(5, 80) * 3000 / 85) + 24
            words[at : at + 10] = [own.choice(["zorkluxing", "vrexpoulty", "quimwhusker"]) + str(k) for k in range(10)]
        rows.append((i, " ".join(words)))
        labels.append((i, i % 2))
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    rude, kind = b"zorkluxing1 vrexpoulty2 quimwhusker3 zorkluxing4 vrexpoulty5 quimwhusker6", prose(24, "kind").encode()
    scores = model.score(np.frombuffer(rude + kind, np.uint8), np.array([0, len(rude), len(rude) + len(kind)]))
    assert scores[0] > 0.5 > scores[1]


CLASH = ["n_words", "kept_sha256", "score", "key", "label", "first", "runs", "block", "unit", "node", "band", "h", "c",
    "n", "length", "print", "id", "component_id", "n_shingles", "url", "predicted"]


@pytest.fixture(scope="module")
def crowded(docs):
    """Documents with columns named like those that operators use inside and add."""
    return docs.select("*", *[F.concat(F.lit(f"{c}:"), "doc_id").alias(c) for c in CLASH])


def test_clashing_names_in_every_operator(spark, crowded, docs, labelled):
    same = lambda df: all(r[c] == f"{c}:{r['doc_id']}" for r in df.collect() for c in CLASH)
    labels = labelled[1].withColumn("label", F.lit("x")).withColumn("text", F.lit("y"))
    for kept in (near_dedup.keep_one(crowded), substring_dedup.remove_repeats(crowded, digest=False),
            quality.reject(crowded, labels), toxicity.reject(crowded, labels)):
        assert kept.columns == crowded.columns and same(kept)
    cut = substring_dedup.remove_repeats(crowded)
    assert cut.columns == [*[c for c in crowded.columns if c not in ("n_words", "kept_sha256")], "n_words", "n_removed", "kept_sha256"]
    assert {(r["doc_id"], r["n_words"]) for r in cut.collect()} == {(i, len((t or "").encode().split())) for i, t in enumerate(TEXTS)}
    path = P.path("byte_bpe_multi_50k.tiktoken")
    rows = lambda df: sorted(map(repr, df.collect()))
    for run in (lambda d: byte_bpe.round_trip(d, path, P.PATTERN),
            lambda d: packing.pack(d, P.path("word_bpe_49k.json")).drop("sequence_id", "offset"),
            lambda d: fingerprints.with_next(d.select("doc_id", "text"), ["text"])):
        assert rows(run(crowded)) == rows(run(docs))
    pages = spark.createDataFrame([(1, "http://example.org/es/", "r", "v", "h", "t")],
        "page_id bigint, url string, rule string, verdict string, host string, token string")
    assert [r["rule"] for r in url_filters.judge(pages, url_filters.RULES).collect()] == ["example.org/es/"]
    vectors = spark.createDataFrame([(k, [float(k)], "x", 1) for k in range(3)], "vec_id bigint, embedding array<double>, v string, cell int")
    assert top_k.top_k(top_k.integer_vectors(vectors), F.lit(True)).count() == 6


def test_a_passage_in_very_many_documents_is_a_row_a_block(spark):
    """Places of equal runs are listed from the start: a passage in 400 documents gives some rows of runs, not some for each of them."""
    counts = {}
    for copies in (2, 400):
        texts = [prose(20, f"own{k}") + " " + PASSAGE + " " + prose(20, f"end{k}") for k in range(copies)]
        df = spark.createDataFrame(list(enumerate(texts)), "key bigint, text string").coalesce(1)
        schema = f"h bigint, c bigint, key bigint, first int, {substring_dedup._MORE}, n int, block bigint"
        anchors = df.mapInArrow(blocks.lean(substring_dedup._seeds(35, 6)), schema)
        counts[copies] = anchors.filter("more is not null").count()
        got = {r["doc_id"]: r["n_removed"] for r in substring_dedup.remove_repeats(df.withColumnRenamed("key", "doc_id"), keep_text=False).collect()}
        assert got == {k: n for k, (_, n, _) in enumerate(removed(texts))}
    assert 1 <= counts[2] <= counts[400] <= 20


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_equal_sql(spark, name):
    assert not difference(QUERIES[name](spark, SF).toPandas(), oracle(ORACLE_SQL[name], SF))


def test_pipeline_equals_brute_force(spark):
    """Every stage on what the one before it kept: decisions by score, groups by all pairs, windows by counting, packing by its layout."""
    from tokenizers import Tokenizer

    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    columns = docs.columns
    rows = {r["doc_id"]: r for r in docs.collect()}
    vectors = quality.word_vectors(docs)
    score = {r["doc_id"]: r["score"] for r in quality.score_documents(docs, vectors, quality.fit(docs, labels, vectors)).collect()}
    kept = {i for i in rows if score[i] >= 0.3}
    for (name, stage), step in zip(corpus_pipeline.STAGES[:-1], range(4), strict=True):
        before = docs
        docs = stored(stage(spark, docs, SF), name)
        got = {r["doc_id"]: r for r in docs.collect()}
        assert docs.columns == columns and len(got) == docs.count()
        if step == 1:
            score = {r["doc_id"]: r["score"] for r in toxicity.score_documents(before, toxicity.fit(before, labels)).collect()}
            kept = {i for i in kept if score[i] < 0.5}
        elif step == 2:
            ids = sorted(kept)
            kept = {ids[root] for _, root in groups([rows[i]["text"] for i in ids], 5, 80)}
        assert set(got) == kept
        if step < 3:
            assert all(got[i] == rows[i] for i in kept)
        else:
            ids = sorted(kept)
            want = removed([rows[i]["text"] for i in ids])
            for i, (_, gone, digest) in zip(ids, want, strict=True):
                text = got[i]["text"]
                assert text == rows[i]["text"] if not gone else hashlib.sha256(text.encode()).hexdigest() == digest
                assert got[i]["n_chars"] == (None if text is None else len(text))
            texts = {i: got[i]["text"] for i in ids}
    peer = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    whole = {i: [*peer.encode(t or "", add_special_tokens=False).ids, 0] for i, t in texts.items()}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert sum(r["length"] for r in packed) == sum(map(len, whole.values()))
    assert all(r["ids_crc32"] == zlib.crc32(np.array(whole[r["doc_id"]][r["start"] : r["start"] + r["length"]], "<u4").tobytes()) for r in packed)
    ends = {}
    for r in sorted(packed, key=lambda r: (r["sequence_id"], r["offset"])):
        assert ends.get(r["sequence_id"], 0) == r["offset"]
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 2048


@pytest.mark.parametrize("setting", [(5, 80, 26, 4), (3, 85, 26, 5)])
def test_recall_of_links_on_the_provided_documents(spark, setting):
    """All pairs over the threshold, found by an exact join of all sets, end in one group: no link is missed."""
    shingle, percent, bands, per = setting
    docs = spark.read.parquet(SF.replace("sf0.001", "sf0.01") + "/documents.parquet").select("doc_id", "text")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    ids = sorted(texts)
    want = {ids[k]: ids[root] for k, (_, root) in enumerate(groups([texts[i] for i in ids], shingle, percent))}
    found = near_dedup.near_duplicates(docs.select("doc_id", near_dedup.with_key(docs).alias("key"), "text"), shingle, percent, bands, per)
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == want and len(set(want.values())) < len(want)
