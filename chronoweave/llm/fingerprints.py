"""Order MinHash fingerprints, in DataFrame functions alone.

A text's k-mers are runs of ``K`` words (fewer where the text has fewer). Each is numbered by its occurrence, so that a text that
repeats itself differs from one that doesn't. Hashes of numbered k-mers stand on a circle; slot ``j`` of ``SLOTS`` orders them by their
distance behind point ``j`` of the circle, which is a min-wise order of its own over all k-mers, and selects the ``TUPLE`` nearest ones. They
are put back in text order and hashed as a tuple. So every slot of every text with two k-mers holds an ordered pair, however short the
text: equal tuples need equal k-mers in equal order, and the share of equal slots follows edit distance and not mere overlap. One
sort serves all slots; everything is array functions inside one row, with sorts of plain longs, and no row is multiplied.

``with_next`` pairs each document with the next one in descending ``doc_id`` by a window over buckets of ids. Their bounds come from ids
alone: quantiles, and between two quantiles even steps, as many as the table needs, so buckets stay at about ``BUCKET_ROWS`` rows. The
first document of a bucket is copied into the bucket above, so that one shuffle of texts is enough and no task needs a whole order.
An id that many rows share is cut by a hash of the text, so only rows with equal id and equal text stay in one bucket.

Null texts are empty; an empty text has no k-mers, its fingerprint is that of the empty list, and two empty fingerprints have likeness 1. Null
ids count as least; rows with equal ids follow one another by a hash of the text, then by text. A single row is its own next document. An
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronoweave.llm.common import stored, table

K = 3
SLOTS = 64
TUPLE = 2
#: Bits of a packed long for the place of a k-mer; longer texts wrap around, which only mixes up the order of far places.
PLACE = 24
#: Rows of a bucket that are aimed at, and the most quantiles; these are a literal array.
BUCKET_ROWS = 200
MOST_QUANTILES = 4096
#: Most buckets whose first ids are broadcast (32 MB); beyond, they are joined by shuffle.
BROADCAST_BUCKETS = 1_000_000


def _numbered(words: Column) -> Column:
    """Hash of each occurrence-numbered k-mer with its place in the low bits, ordered by bin and hash."""
    places = F.pow(F.lit(2), PLACE).cast("bigint")
    hashes = F.transform(words, lambda w, i: F.shiftleft(F.xxhash64(w, *[F.get(words, i + k) for k in range(1, K)]),
            PLACE).bitwiseOR(i.cast("bigint") % places))
    count = F.greatest(F.size(words) - (K - 1), F.least(F.size(words), F.lit(1)))
    return F.sort_array(F.slice(hashes, 1, count))


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the fingerprint of a text column. Steps are columns of their own, so that none is computed twice."""
    others = df.columns
    mask = (1 << PLACE) - 1
    slot_bits = SLOTS.bit_length() - 1
    spaced = F.split(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+")
    step = df.withColumn("__cw_words", F.array_remove(spaced, ""))
    step = step.withColumn("__cw_kmers", _numbered(F.col("__cw_words")))
    kmers = F.col("__cw_kmers")
    new = lambda x, i: (i == 0) | (F.shiftright(x, PLACE) != F.shiftright(F.get(kmers, i - 1), PLACE))
    alone = lambda x, i: new(x, i) & ((i == F.size(kmers) - 1) | (F.shiftright(x, PLACE) != F.shiftright(F.get(kmers, i + 1), PLACE)))
    key = lambda x, n: F.shiftleft(F.xxhash64(F.shiftright(x, PLACE), n), PLACE).bitwiseOR(x.bitwiseAND(F.lit(mask)))
    # Most k-mers occur once and need no numbering; the others are numbered run by run.
    single = F.transform(F.filter(kmers, alone), lambda x: key(x, F.lit(0)))
    several = F.filter(kmers, lambda x, i: ~alone(x, i))
    step = step.withColumn("__cw_single", single).withColumn("__cw_several", several)
    runs = F.col("__cw_several")
    begins = F.filter(F.sequence(F.lit(0), F.greatest(F.size(runs) - 1, F.lit(0))), lambda i: (i == 0)
        | (F.shiftright(F.get(runs, i), PLACE) != F.shiftright(F.get(runs, i - 1), PLACE)))
    step = step.withColumn("__cw_begins", F.when(F.size(runs) > 0, begins).otherwise(F.array().cast("array<int>")))
    firsts = F.col("__cw_begins")
    numbered = F.flatten(F.transform(firsts, lambda s, r: F.transform(F.slice(runs, s + 1,
                    F.coalesce(F.get(firsts, r + 1), F.size(runs)) - s), lambda x, n: key(x, n))))
    step = step.withColumn("__cw_all", F.sort_array(F.concat("__cw_single", numbered)))
    every = F.col("__cw_all")
    # The circle begins at the least long, so the sorted list is the circle cut open there; slot j begins at j / SLOTS of it.
    slot_of = lambda x: F.shiftright(x, 64 - slot_bits).cast("int") + SLOTS // 2
    opens = F.filter(F.transform(every, lambda x, i: F.when((i == 0) | (slot_of(x) != slot_of(F.get(every, i - 1))), i)), lambda i: i.isNotNull())
    step = step.withColumn("__cw_opens", opens)
    first = F.col("__cw_opens")
    before = lambda r: F.when(r == 0, F.lit(-1)).otherwise(slot_of(F.get(every, F.get(first, r - 1))))
    after = F.array_repeat(F.lit(0), SLOTS - 1 - slot_of(F.get(every, F.get(first, F.size(first) - 1))))
    nearest = F.concat(F.flatten(F.transform(first, lambda i, r: F.array_repeat(i, slot_of(F.get(every, i)) - before(r)))), after)

    def signed(i: Column, slot: Column) -> Column:
        a, b = F.get(every, i), F.get(every, (i + 1) % F.size(every))
        place = lambda x: x.bitwiseAND(F.lit(mask))
        value = lambda x: F.shiftright(x, PLACE)
        pair = F.when(F.size(every) == 1, F.xxhash64(value(a))).when(place(a) <= place(b),
            F.xxhash64(value(a), value(b))).otherwise(F.xxhash64(value(b), value(a)))
        return F.shiftleft(pair, slot_bits).bitwiseOR(slot.cast("bigint"))

    step = step.withColumn("__cw_nearest", F.when(F.size(every) > 0, nearest).otherwise(F.array().cast("array<int>")))
    return step.select(*others, F.transform("__cw_nearest", signed).alias(name))


def likeness(a: Column, b: Column) -> Column:
    """Share of the slots in which both have the same tuple; of two empty texts 1, of an empty and another one 0."""
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.lit(float(SLOTS)))


def _longs(values: list[int]) -> Column:
    return F.from_json(F.lit(str(values)), "array<bigint>")


def _count_upto(bounds: list[int], value: Column, strictly: bool) -> Column:
    """How many of the ascending bounds are below a value, or not above it: a binary search by doubling steps."""
    steps = [1 << k for k in range(max(1, len(bounds)).bit_length() - 1, -1, -1)]
    passed = lambda at: (at < value) if strictly else (at <= value)
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: at
        + F.when(passed(F.get(_longs(bounds), at + step - 1)), step).otherwise(0))


def _placed(rows: DataFrame, ids: DataFrame, size: int, tie: Column) -> DataFrame:
    """``rows`` with ``__cw_id, __cw_tie`` and ``__cw_bucket``, a number that ascends with them."""
    quantiles = min(MOST_QUANTILES, max(1, size // BUCKET_ROWS))
    cuts = ids.agg(F.percentile_approx("id", [k / quantiles for k in range(quantiles + 1)], 10 * MOST_QUANTILES)
        .alias("cuts")).first()["cuts"] if quantiles > 1 else []
    bounds = sorted(cuts or [])
    keyed = rows.withColumns({"__cw_id": _identity(), "__cw_tie": tie})
    if not bounds:
        return keyed.withColumn("__cw_bucket", F.lit(0).cast("bigint"))
    # An id that fills whole quantiles takes them all: its rows are dealt by their tie. Others stand between two bounds, in even steps.
    fine = max(1, -(-size // (BUCKET_ROWS * quantiles)))
    keyed = keyed.withColumns({"__cw_below": _count_upto(bounds, F.col("__cw_id"), True), "__cw_upto": _count_upto(bounds, F.col("__cw_id"), False)})
    own = F.col("__cw_upto") - F.col("__cw_below")
    low, high = F.get(_longs(bounds), F.col("__cw_upto") - 1).cast("double"), F.get(_longs(bounds), F.col("__cw_upto")).cast("double")
    share = (F.col("__cw_id").cast("double") - low) / (high - low)
    between = F.col("__cw_upto") * fine + F.least(F.floor(F.coalesce(share, F.lit(0.0)) * fine), F.lit(fine - 1))
    spread = (F.col("__cw_tie").cast("double") + 2.0**63) / 2.0**64
    dealt = (F.col("__cw_below") + 1) * fine + F.least(F.floor(spread * (own - 1) * fine), (own - 1) * fine - 1)
    return keyed.withColumn("__cw_bucket", F.when(own > 1, dealt).otherwise(between).cast("bigint")).drop("__cw_below", "__cw_upto")


def _identity() -> Column:
    return F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63)).cast("bigint"))


def with_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """Every row of ``docs`` with ``next_<column>`` of the document behind it in descending ``doc_id``; the last is followed by the first.

    ``docs`` has ``doc_id``, ``text`` and the columns. At most ``MOST_QUANTILES`` ids reach the driver.
    """
    counts = docs.select(_identity().alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    size, most = counts.agg(F.sum("n"), F.max("n")).first()
    tie = F.xxhash64("text") if (most or 0) > 1 else F.lit(0).cast("bigint")
    placed = _placed(docs, docs.select(_identity().alias("id")), size or 0, tie)
    top = placed.groupBy("__cw_bucket").agg(F.max(F.struct("__cw_id", "__cw_tie")).alias("top"))
    tops = stored(top, "tops")
    # The bucket above each one; the highest is followed by the lowest. Steps between two quantiles are one group of the window.
    group = F.floor(F.col("__cw_bucket") / 4096)
    edge = tops.groupBy(group.alias("group")).agg(F.min("__cw_bucket").alias("low")).withColumn("following",
        F.lead("low").over(Window.orderBy("group")))
    lowest = F.min("low").over(Window.partitionBy())
    edge = edge.select("group", F.coalesce("following", lowest).alias("following"), F.col("following").isNull().alias("last"))
    inside = F.lead("__cw_bucket").over(Window.partitionBy("group").orderBy("__cw_bucket"))
    above = tops.withColumn("group", group).withColumn("inside", inside).join(F.broadcast(edge), "group")
    above = stored(above.select("__cw_bucket", "top", F.coalesce("inside", "following").alias("above"),
            (F.col("inside").isNull() & F.col("last")).alias("wraps")), "above")
    if above.count() <= BROADCAST_BUCKETS:
        above = F.broadcast(above)
    own = F.struct(F.col("__cw_bucket").alias("bucket"), F.lit(0).alias("extra"))
    copy = F.struct(F.col("above").alias("bucket"), F.when(F.col("wraps"), F.lit(2)).otherwise(F.lit(1)).alias("extra"))
    is_top = F.struct("__cw_id", "__cw_tie") == F.col("top")
    copies = placed.join(above, "__cw_bucket").withColumn("__cw_at", F.explode(F.when(is_top, F.array(own, copy)).otherwise(F.array(own))))
    order = Window.partitionBy("__cw_at.bucket").orderBy(F.col("__cw_at.extra") == 2, F.col("__cw_id").desc(),
        F.col("__cw_tie").desc(), F.col("__cw_at.extra"), F.col("text").desc())
    following = copies.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns]).filter("__cw_at.extra = 0")
    return following.select(*docs.columns, *[f"next_{c}" for c in columns])


def edited(text: Column, following: Column) -> Column:
    """The last half of a text (rounded down) replaced by as many first code points of another."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - half), F.substring(following, F.lit(1), half))


def as_string(print_: Column) -> Column:
    return F.array_join(F.transform(print_, lambda x: F.hex(x)), ".")


def op5_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    printed = with_fingerprint(docs, "text", "print")
    both = with_next(printed, ["text", "print"])
    changed = both.select("doc_id", "print", "next_print", F.char_length("text").cast("bigint").alias("n_chars"),
        edited(F.col("text"), F.col("next_text")).alias("edited"))
    done = with_fingerprint(changed, "edited", "edited_print")
    return done.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_string(F.col("print")).alias("fingerprint"),
        as_string(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"), likeness(F.col("print"), F.col("next_print")).alias("near_next"),
    )
