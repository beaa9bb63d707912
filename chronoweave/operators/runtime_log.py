"""Runtime message logs: routing, decoding, and the decomposition of cue sequences into trials."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from chronoweave.functions.ordering import before, in_order, so_far

#: Messages longer than this many bytes are cue sequences (fixed value).
CUE_BYTES = 500
#: First byte of the other messages (fixed values).
KINDS = {1: "system_state", 2: "runtime_state", 3: "reinforcing_guidance", 4: "aversive_guidance", 5: "distance_snapshot"}
#: Trigger zones open and close this many centimetres early and late (fixed value).
ZONE_LEAD_CM = 4.0


def byte_at(payload: Column, place: int) -> Column:
    return F.conv(F.hex(F.substring(payload, place, 1)), 16, 10).cast("int")


def routed(messages: DataFrame) -> DataFrame:
    """L1: ``kind`` of each message by length and first byte; null for other messages."""
    first = byte_at(F.col("payload"), 1)
    kind = F.when(F.octet_length("payload") > CUE_BYTES, "cue_sequence")
    for code, name in KINDS.items():
        kind = kind.when(first == code, name)
    return messages.withColumn("kind", kind)


def state_table(messages: DataFrame, kind: str) -> DataFrame:
    """L2: time and state of one kind; the state is the second byte."""
    return routed(messages).filter(F.col("kind") == kind).select("session", "time_us", "seq", byte_at(F.col("payload"), 2).alias("state"))


@F.pandas_udf(DoubleType())
def _double_at_one(payload: pd.Series) -> pd.Series:
    import numpy as np

    return payload.map(lambda p: float(np.frombuffer(p, dtype="<f8", count=1, offset=1)[0]) if p is not None and len(p) >= 9 else None).astype(object)


def snapshots(messages: DataFrame) -> DataFrame:
    """L3: distance snapshots, a little-endian double behind the first byte."""
    return routed(messages).filter(F.col("kind") == "distance_snapshot").select("session", "time_us", "seq",
        _double_at_one("payload").alias("distance_cm"))


def corridor_starts(snapshot_rows: DataFrame) -> DataFrame:
    """L4: where each corridor starts: the total of the earlier snapshots, one more row than there are snapshots."""
    own = snapshot_rows.select("session", F.row_number().over(in_order()).cast("bigint").alias("corridor"),
        F.coalesce(F.sum("distance_cm").over(before()), F.lit(0.0)).alias("start_cm"), "distance_cm")
    tail = own.groupBy("session").agg(F.max_by(F.struct("corridor", "start_cm", "distance_cm"), "corridor")
        .alias("l")).select("session", (F.col("l.corridor") + 1).alias("corridor"),
        (F.col("l.start_cm") + F.col("l.distance_cm")).alias("start_cm"))
    return own.drop("distance_cm").unionByName(tail)


def trial_geometry(trials: DataFrame, template: DataFrame) -> DataFrame:
    """``session, names`` in order of declaration with the geometry of each name; a name without geometry keeps nulls for X1."""
    named = trials.select("session", F.posexplode("names").alias("trial_index", "name"))
    return named.join(template, "name", "left")


def cue_text(cues: Column) -> Column:
    """Cue codes as one letter each, from the first CJK ideograph on, so that no code is a sign of a regular expression."""
    return F.array_join(F.transform(cues, lambda c: F.decode(F.unhex(F.lpad(F.hex(c + 0x4E00), 4, "0")), "UTF-16BE")), "")


def motif_pattern(motifs: Column) -> Column:
    """Alternation of the motifs, the longest first and of equally long ones the first declared."""
    placed = F.transform(motifs, lambda m, i: F.struct((-F.size(m)).alias("n"), i.alias("i"), cue_text(m).alias("t")))
    return F.array_join(F.transform(F.array_sort(placed), lambda p: p["t"]), "|")


def decompose(sequences: DataFrame) -> DataFrame:
    """``cues`` cut into ``motifs`` from the left, longest first; ``stop`` is the place of the first cue that fits none, or null.

    One row per sequence: ``trials`` lists the indices of the motifs.
    """
    text = sequences.withColumns({"_text": cue_text(F.col("cues")), "_pattern": motif_pattern(F.col("motifs"))})
    fit = text.withColumn("_fit", F.expr("regexp_extract(_text, concat('^(?:', _pattern, ')*+'), 0)"))
    parts = F.expr("regexp_extract_all(_fit, concat('(', _pattern, ')'), 1)")
    names = fit.withColumns({"_names": F.transform("motifs", lambda m: cue_text(m)), "_parts": parts})
    return names.select(
        "session", "seq", F.transform("_parts", lambda p: F.array_position("_names", p) - 1).alias("trials"),
        F.when(F.char_length("_fit") < F.size("cues"), F.char_length("_fit")).alias("stop"),
    )


def place_trials(trials: DataFrame, swaps: DataFrame) -> DataFrame:
    """Trials of each corridor with start and end; the first is shorter by ``offset_cm``; a swap cuts the running trial and drops later ones.

    ``trials`` has ``session, corridor, place, trial, length_cm, offset_cm``; ``swaps`` has ``session, corridor, swap_cm``.
    """
    w = ["session", "corridor"]
    length = F.col("length_cm") - F.when(F.col("place") == 0, F.col("offset_cm")).otherwise(0.0)
    own = trials.withColumn("_length", length)
    end = F.sum("_length").over(so_far(w, ["place"]))
    ranged = own.withColumn("end_cm", end).withColumn("start_cm", F.col("end_cm") - F.col("_length")).join(swaps, w, "left")
    kept = ranged.filter(F.col("swap_cm").isNull() | (F.col("start_cm") < F.col("swap_cm")))
    return kept.select("session", "corridor", "place", "trial", "start_cm",
        F.coalesce(F.least("end_cm", "swap_cm"), "end_cm").alias("end_cm"),
        F.coalesce(F.col("end_cm") > F.col("swap_cm"), F.lit(False)).alias("truncated"))


def check_sequences(counts: DataFrame) -> DataFrame:
    """Sessions without sequences, or with snapshots other than sequences - 1 where there is more than one."""
    bad = (F.col("sequences") == 0) | ((F.col("sequences") > 1) & (F.col("snapshots") != F.col("sequences") - 1))
    return counts.filter(bad).select("session", F.format_string("%d sequences and %d snapshots", "sequences", "snapshots").alias("message"))


def cue_onsets(placed: DataFrame) -> DataFrame:
    """A row for each cue entered. ``placed`` has ``start_cm, end_cm, truncated`` and ``cues: array<struct<code, length_cm>>``."""
    # Where a cue lies in its trial is worked out in the trial's own row: opened first, three times as many rows would be sorted once more.
    past = lambda k: F.aggregate(F.slice("cues", F.lit(1), k), F.lit(0.0), lambda at, c: at + F.coalesce(c["length_cm"].cast("double"), F.lit(0.0)))
    lying = F.transform("cues", lambda c, k: F.struct(c["code"].alias("code"), past(k).alias("at")))
    opened = placed.select("session", "corridor", "place", "start_cm", "end_cm", "truncated", F.posexplode(lying).alias("cue_place", "cue"))
    entered = opened.filter(~F.col("truncated") | (F.col("cue.at") < F.col("end_cm") - F.col("start_cm")))
    return entered.select("session", "corridor", "place", "cue_place", F.col("cue.code").alias("cue"),
        (F.col("start_cm") + F.col("cue.at")).alias("distance_cm"))


def trigger_zones(placed: DataFrame, lead_cm: float = ZONE_LEAD_CM) -> DataFrame:
    """Zones in session distance, opened and closed early and late; dropped past the trial's end, cut at it."""
    length = F.col("end_cm") - F.col("start_cm")
    zone = placed.withColumns({"_from": F.col("zone_start_cm") - lead_cm - F.col("entry_cm"), "_to": F.col("zone_end_cm")
            + lead_cm - F.col("entry_cm"), "_length": length})
    return zone.filter("_from <= _length").select("session", "corridor", "place",
        (F.col("start_cm") + F.col("_from")).alias("start_cm"),
        F.when(F.col("_to") <= F.col("_length"), F.col("start_cm") + F.col("_to")).otherwise(F.col("end_cm"))
        .alias("end_cm"))


def trial_table(placed: DataFrame) -> DataFrame:
    """The trial index with the distance where it starts."""
    return placed.select("session", F.col("trial").alias("trial_type_index"), F.col("start_cm").alias("traveled_distance_cm"))
