"""Conversation repair against a search over all edits."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from chronoweave.llm import conversations

WHITE = " \t\n\x0b\x0c\r"
AFTER = {"": "user", "s": "user", "a": "user", "u": "assistant"}


def search(rows):
    """Cheapest edits of ``(role, text, must go, truncated)``, least audit first."""
    heap = [(0, "", 0, "", "")]
    done = set()
    while heap:
        cost, audit, at, last, lines = heapq.heappop(heap)
        if (at, last) in done:
            continue
        done.add((at, last))
        if at == len(rows) and last in ("", "a"):
            return cost, audit, lines[1:]
        role = AFTER[last]
        heapq.heappush(heap, (cost + 5, audit + "I", at, role[0], f"{lines}\n{role}:"))
        if at == len(rows):
            continue
        own, text, must, cut = rows[at]
        heapq.heappush(heap, (cost + 2, audit + "D", at + 1, last, lines))
        if not must:
            heapq.heappush(heap, (cost + 1 + 5 * cut, audit + "R", at + 1, role[0], f"{lines}\n{role}:{text}"))
            if own[:1] and own[:1] in {"": "su", "s": "u", "u": "a", "a": "u"}[last]:
                heapq.heappush(heap, (cost + 5 * cut, audit + "K", at + 1, own[0], f"{lines}\n{own}:{text}"))
    raise AssertionError


def damage(table):
    out = []
    for conv, turn, role, text in table:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def expected(table, damaged=damage):
    after = damaged(table)
    result = {}
    for conv in {r[0] for r in table}:
        rows = sorted((r for r in after if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest()))
        turns = [r[1] for r in rows if r[1] is not None]
        counts, seen, marked, initials = [0, 0, 0], set(), [], []
        for _, _, role, text in rows:
            blank, again, cut = not text.strip(WHITE), (role, text) in seen, text.rstrip(WHITE)[-1:] not in (".", "!", "?")
            fault = 0 if blank else 1 if again else 2 if cut else None
            if fault is not None:
                counts[fault] += 1
            seen.add((role, text))
            marked.append((role, text, fault in (0, 1), int(fault == 2)))
            initials.append(role[:1])
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        cost, audit, lines = search(marked)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        result[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256(lines.encode()).hexdigest())
    return result


def collected(df):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return {r["conv_id"]: tuple(r[n] for n in names) for r in df.collect()}


def conversations_of(seed, n):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Why? ", "open", " ", "", None, "é ", ". x", "Fine.\n\t", "\x1c", "a\nuser:b."]
    table = []
    for conv in [None, *range(n)]:
        role = 0
        for turn in range(rng.randint(0, 9)):
            kind = rng.random()
            name = ("user", "assistant")[role % 2] if kind < 0.7 else rng.choice(["system", "user", "assistant", "tool", "", None, "s", "umpire"])
            number = None if rng.random() < 0.05 else turn * rng.choice([1, 1, 1, 3]) if rng.random() < 0.9 else rng.randint(0, 4)
            table.append((conv, number, "system" if turn == 0 and kind < 0.5 else name, rng.choice(texts)))
            role += 1
    return table + table[:3]


@pytest.mark.parametrize("seed", [1, 2])
def test_repair_equals_search(spark, seed):
    table = conversations_of(seed, 150)
    df = spark.createDataFrame(table, "conv_id bigint, turn bigint, role string, text string").repartition(5)
    extra = df.select("*", F.lit("x").alias("kind"), F.lit(1).alias("mark"), F.lit("y").alias("audit"))
    assert collected(conversations.repair(conversations.damaged(extra))) == expected(table)
    plain = lambda rows: [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert collected(conversations.repair(conversations.as_given(df))) == expected(table, plain)


def test_a_long_conversation_and_an_empty_table(spark):
    rng = random.Random(5)
    table = [(7, i, rng.choice(["user", "assistant"]), rng.choice(["Yes.", "open"]) + str(i) + rng.choice(".?x")) for i in range(3000)]
    table.append((8, 1, "user", "long. " * 400_000))
    df = spark.createDataFrame(table, "conv_id bigint, turn bigint, role string, text string")
    assert collected(conversations.repair(conversations.damaged(df))) == expected(table)
    assert conversations.repair(conversations.damaged(df.limit(0))).count() == 0


@pytest.mark.parametrize("block", [1, 2, 3, 5])
def test_blocks_of_any_length_give_the_same_audit(block):
    rng = random.Random(block)
    for _ in range(300):
        symbols = bytes(rng.choices(range(9), weights=[1, 1, 0.3, 3, 1, 3, 1, 0.5, 0.3], k=rng.randint(0, 30)))
        assert conversations.cheapest_edits(symbols, block) == conversations.cheapest_edits(symbols)
    rows = [("suax"[(s - 1) // 2], "", s == 0, (s - 1) % 2 if s else 0) for s in symbols]
    assert conversations.cheapest_edits(symbols, block) == search(rows)[:2]
