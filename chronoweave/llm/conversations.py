"""Repair of the structure of conversations: cheapest edits by block tables.

Rows of a conversation are in the order of ``turn``, nulls first; rows of one turn in the order of role and then of the MD5 of the text.
A row's first fault counts: blank (no word), duplicate (role and text stand in an earlier row), truncated (the last character that is no
white space is none of ``.!?``). Edits lead to roles whose initials are ``(s?(ua)+)?``: keep (K, free), rerole to user or assistant
(R, 1), delete (D, 2; blank and duplicate rows must go), insert a user or assistant row without text (I, 5). A truncated row that
stays costs 5 more. Of the cheapest audits the least in ASCII counts; an audit fixes the roles it gives.

A row is one of nine symbols. What it still costs to finish from each of the four states of the pattern is a vector; less its
least entry, only a few vectors can occur. Tables say for each of them and for every block of ``BLOCK`` symbols which vector stands before
the block and how much is added, so costs run from the end of a conversation to its start with one look-up a block. The audit then runs
forward: each block is expanded backward from the vector behind it, and at every place the least letter that still costs the least is
taken.

A conversation is never gathered with its texts. Its rows without text, about 60 bytes each, pass a task in order and leave a symbol each,
as many bytes as the audit itself has letters; its texts pass once more behind their audit and are digested as they come. Where a role and
text stand first is found with partial sums. One conversation is in one task in both passes, since its audit is one string and
its digest one chain over all its bytes; texts of any length are held one Arrow batch at a time.

Null roles and texts, and nulls in the key of the damage, are one blank. A null ``conv_id`` is a conversation of its own. Repeated rows
are duplicates. A conversation of which no row is left has zeros, an empty audit and the digest of nothing. An empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoweave.llm.blocks import lean
from chronoweave.llm.common import small_batches, table

BLOCK = 4
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: States: nothing yet, after the system row, after a user row, after an assistant row. A row that is inserted or gets a role leads to ``_TURN``.
_TURN = (2, 2, 3, 2)
_ACCEPTED = (0, 3)
#: Symbols: 0 has to go, ``1 + 2 * class + truncated`` may stay; classes are system, user, assistant, other.
_KEPT = ({0: 1}, {0: 2, 1: 2, 3: 2}, {2: 3}, {})
SYMBOLS = 9
_WHITE = " \t\n\x0b\x0c\r"
_FOUND = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _with_inserts(costs: list[int]) -> tuple[int, ...]:
    """Costs to finish where rows may be inserted first."""
    for _ in _TURN:
        costs = [min(c, INSERT + costs[_TURN[q]]) for q, c in enumerate(costs)]
    return tuple(costs)


def _before(after: tuple[int, ...], symbol: int) -> tuple[int, ...]:
    """Costs to finish before a row from those behind it."""
    costs = [DELETE + c for c in after]
    if symbol:
        kind, extra = (symbol - 1) // 2, TRUNCATED * ((symbol - 1) % 2)
        for q in range(len(after)):
            costs[q] = min(costs[q], REROLE + extra + after[_TURN[q]])
            if q in _KEPT[kind]:
                costs[q] = min(costs[q], KEEP + extra + after[_KEPT[kind][q]])
    return _with_inserts(costs)


_END = _with_inserts([0 if q in _ACCEPTED else 1 << 20 for q in range(len(_TURN))])


@functools.cache
def block_tables(block: int = BLOCK) -> tuple[list[tuple[int, ...]], list[np.ndarray], list[np.ndarray]]:
    """The normalised vectors, and for runs of 1 to ``block`` symbols the vector before each run and what is added, by vector and run."""
    vectors = [_END]  # its least entry is 0
    number = {_END: 0}
    following, added = [], []
    for vector in vectors:  # grows until nothing new is met
        row, more = [], []
        for symbol in range(SYMBOLS):
            raw = _before(vector, symbol)
            least = min(raw)
            normal = tuple(c - least for c in raw)
            if normal not in number:
                number[normal] = len(vectors)
                vectors.append(normal)
            row.append(number[normal])
            more.append(least)
        following.append(row)
        added.append(more)
    one, cost = np.array(following), np.array(added)
    tables, sums = [np.arange(len(vectors))[:, None], one], [np.zeros((len(vectors), 1), np.int64), cost]
    for _ in range(1, block):
        last, total = tables[-1], sums[-1]  # a symbol is put in front of the run
        tables.append(one[last].transpose(0, 2, 1).reshape(len(vectors), -1))
        sums.append((cost[last] + total[:, :, None]).transpose(0, 2, 1).reshape(len(vectors), -1))
    return vectors, tables, sums


@functools.lru_cache(1 << 16)
def _expand(size: int, code: int, vector: int, state: int, block: int) -> tuple[str, int]:
    """The least letters of a run of symbols that starts in a state and has a vector behind it, and the state it ends in."""
    symbols = [code // SYMBOLS ** (size - 1 - k) % SYMBOLS for k in range(size)]
    costs = [block_tables(block)[0][vector]]
    for symbol in reversed(symbols):
        costs.append(_before(costs[-1], symbol))
    costs.reverse()
    letters, at = "", 0
    while at < size:
        here, after, symbol = costs[at][state], costs[at + 1], symbols[at]
        kind, extra = (symbol - 1) // 2, TRUNCATED * ((symbol - 1) % 2)
        if DELETE + after[state] == here:
            letters, at = letters + "D", at + 1
        elif INSERT + costs[at][_TURN[state]] == here:
            letters, state = letters + "I", _TURN[state]
        elif state in _KEPT[kind] and KEEP + extra + after[_KEPT[kind][state]] == here:
            letters, at, state = letters + "K", at + 1, _KEPT[kind][state]
        else:
            letters, at, state = letters + "R", at + 1, _TURN[state]
    return letters, state


def cheapest_edits(symbols: bytes, block: int = BLOCK) -> tuple[int, str]:
    """Cost and audit of the rows of one conversation."""
    vectors, tables, sums = block_tables(block)
    head = len(symbols) % block
    values = np.frombuffer(symbols, dtype=np.uint8).astype(np.int64)
    codes = values[head:].reshape(-1, block) @ (SYMBOLS ** np.arange(block - 1, -1, -1))
    runs = [(block, c) for c in codes.tolist()]
    if head:
        runs.insert(0, (head, int(values[:head] @ (SYMBOLS ** np.arange(head - 1, -1, -1)))))
    vector, cost, behind = 0, 0, []
    for size, code in reversed(runs):
        behind.append(vector)
        cost += int(sums[size][vector, code])
        vector = int(tables[size][vector, code])
    state, letters = 0, []
    for (size, code), after in zip(runs, reversed(behind), strict=True):
        part, state = _expand(size, code, after, state, block)
        letters.append(part)
    while state not in _ACCEPTED:
        letters.append("I")
        state = _TURN[state]
    return cost + vectors[vector][0], "".join(letters)


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, lost`` of every row after its damage, repeated rows twice; ``lost`` marks rows that are dropped."""
    spelled = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spelled("conv_id"), F.lit(":"), spelled("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(spelled("text"), "[.!?]", "")).otherwise(spelled("text"))
    role = F.when(kind == 4, "user").otherwise(spelled("role"))
    copies = F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    return rows.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), role.alias("role"), text.alias("text"),
        (kind == 0).alias("lost"), copies).drop("copy")


def as_given(rows: DataFrame) -> DataFrame:
    """The same columns without any damage."""
    spelled = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" ")).alias(name)
    return rows.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), spelled("role"), spelled("text"), F.lit(False).alias("lost"))


def _class(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)


def _symbol_rows(rows: DataFrame) -> DataFrame:
    """Rows without their texts, and before the first of each role and text a row with ``mark`` 0."""
    said = F.rtrim("text", F.lit(_WHITE))
    slim = rows.select("conv_id", "turn", "role", F.unhex(F.md5("text")).alias("digest"), F.when(F.col("lost"), 2).otherwise(1).alias("mark"),
        (_class(F.col("role")) * 4 + F.when(said == "", 2).otherwise(0)
         + F.when(F.substring(said, -1, 1).isin(".", "!", "?"), 0).otherwise(1)).alias("kind"))
    firsts = slim.filter("mark = 1").groupBy("conv_id", "role", "digest").agg(F.min(F.struct("turn")).alias("first"))
    marks = firsts.select("conv_id", "first.turn", "role", "digest", F.lit(0).alias("mark"), F.lit(0).alias("kind"))
    return slim.unionByName(marks)


class _Conversation:
    """What is known of one conversation while its rows pass."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.symbols = conv_id, bytearray()
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.least = self.last = self.first = None
        self.kind = -1

    def add(self, turn: int | None, key: tuple, kind: int) -> None:
        if turn is not None:
            self.least = turn if self.least is None else self.least
            self.turns += turn != self.last
            self.last = turn
        group, again = kind // 4, self.first != key
        self.first = None  # the mark holds for one row
        if self.kind >= 0 and (self.kind, group) not in ((0, 1), (1, 2), (2, 1)):
            self.illegal += 1
        self.kind = group
        blank, cut = kind & 2, kind & 1
        self.blank += blank > 0
        self.duplicate += not blank and again
        self.truncated += not blank and not again and cut
        self.symbols.append(0 if blank or again else 1 + 2 * group + cut)

    def result(self) -> tuple:
        gaps = self.last - self.least + 1 - self.turns if self.turns else 0
        cost, audit = cheapest_edits(bytes(self.symbols))
        return self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come in the order of conversation, turn, role, digest and mark."""
    now: _Conversation | None = None
    names = [c.split()[0] for c in _FOUND.split(", ")]
    kinds = [pa.string() if n == "audit" else pa.int64() for n in names]

    def batch_of(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], t) for k, t in enumerate(kinds)], names=names)

    for batch in batches:
        found = []
        for conv_id, turn, role, digest, mark, kind in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is None or conv_id != now.conv_id:
                if now is not None:
                    found.append(now.result())
                now = _Conversation(conv_id)
            if mark == 0:
                now.first = (turn, role, digest)
            elif mark == 1:
                now.add(turn, (turn, role, digest), kind)
        yield batch_of(found)
    yield batch_of([] if now is None else [now.result()])


class _Repair:
    """The repaired rows of one conversation as they pass; they are digested and not kept."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state, self.lines = audit, 0, 0, 0
        self.digest = hashlib.sha256()

    def _line(self, role: bytes, text: bytes, state: int) -> None:
        self.digest.update((b"\n" if self.lines else b"") + role + b":")
        self.digest.update(text)
        self.lines, self.state = self.lines + 1, state

    def _turn(self, text: bytes) -> None:
        state = _TURN[self.state]
        self._line(b"user" if state == 2 else b"assistant", text, state)

    def _inserts(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self._turn(b"")
            self.at += 1

    def add(self, role: bytes, text: bytes) -> None:
        self._inserts()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K":
            self._line(role, text, {b"s": 1, b"u": 2}.get(role[:1], 3))
        elif letter == "R":
            self._turn(text)

    def result(self) -> str:
        self._inserts()
        return self.digest.hexdigest()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come conversation by conversation, the one with the audit before the others; columns are the audit's and role and text."""
    repair, known = None, None
    schema: pa.Schema | None = None

    def batch_of(done: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array([d[k] for d in done], pa.string() if k >= 7 else pa.int64()) for k in range(9)]
        return pa.RecordBatch.from_arrays(columns, names=["conv_id", *_COUNTS, "audit", "repaired_sha256"])

    for batch in batches:
        schema, done = batch.schema, []
        heads = list(zip(*(batch.column(k).to_pylist() for k in range(8)), strict=True))
        role, text = (batch.column(k).cast(pa.large_binary()).to_pylist() for k in (8, 9))
        for k, head in enumerate(heads):
            if head[7] is not None:
                if repair is not None:
                    done.append((*known, repair.result()))
                repair, known = _Repair(head[7]), head
            else:
                repair.add(role[k], text[k])
        yield batch_of(done)
    if schema is not None and repair is not None:
        yield batch_of([(*known, repair.result())])


def repair(rows: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` of each conversation.

    ``rows`` has ``conv_id, turn, role, text, lost`` as ``damaged`` and ``as_given`` make them. Lost rows count for nothing but their ``conv_id``.
    """
    small_batches(rows.sparkSession)
    order = [F.col("turn").asc_nulls_first(), "role", "digest"]
    slim = _symbol_rows(rows).repartition("conv_id").sortWithinPartitions("conv_id", *order, "mark")
    audits = slim.select("conv_id", "turn", "role", "digest", "mark", "kind").mapInArrow(lean(_audits), _FOUND)
    texts = rows.filter(~F.col("lost")).select("conv_id", "turn", "role", "text", F.unhex(F.md5("text")).alias("digest"), F.lit(1).alias("part"))
    both = audits.withColumn("part", F.lit(0)).unionByName(texts, allowMissingColumns=True)
    dealt = both.repartition("conv_id").sortWithinPartitions("conv_id", "part", *order)
    return dealt.select("conv_id", *_COUNTS, "audit", "role", "text").mapInArrow(lean(_digests), f"{_FOUND}, repaired_sha256 string")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")))
