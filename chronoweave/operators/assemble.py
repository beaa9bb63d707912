"""Assembly: the aligned tables of all sessions, joined on the reference clock by session and frame.

Streams that a session type lacks are left out by giving none, their columns then are absent; a session without rows of a stream that
others have gets nulls. All streams of a table go through one alignment, and all that is read by windows through one more.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoweave.functions.ordering import in_order
from chronoweave.functions.scans import latest, over_runs, previous, scanned, total
from chronoweave.operators.asof import align_all, corridor_distance, elapsed_minutes, held_at_start, in_windows, in_zones, onsets_of, running_speed, slowest_clock, strongest
from chronoweave.operators.imaging import TOLERANCE_US, aligned_frames, attach_traces

#: Values outside the run state (fixed values).
NO_CUE, NO_TRIAL, NO_TRIAL_TYPE = 255, 65535, "undefined"
IDLE, REST, RUN = "idle", "rest", "run"
FRAME = ["session", "frame"]
#: Columns of the behavior table in their order (fixed names).
BEHAVIOR = ["time_us", "elapsed_minutes", "brake", "screens", "torque_N_cm", "distance_cm", "speed_cm_s", "lick",
    "water_uL", "reward", "system_state"]
TIME = ["time_us", "elapsed_minutes"]


def labelled(df: DataFrame, code: str, labels: dict[int, str], name: str, strict: bool = False) -> DataFrame:
    """B1: codes as labels; unknown codes give null, which X1 reports, or with ``strict`` an error."""
    pairs = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    found = F.try_element_at(pairs, F.col(code).cast("int"))
    unknown = F.raise_error(F.concat(F.lit(f"no label of {code} "), F.col(code).cast("string")))
    return df.withColumn(name, F.when(F.col(code).isNotNull() & found.isNull(), unknown).otherwise(found) if strict else found)


def reward_classes(df: DataFrame, tone: str = "tone_state", total_of: str = "volume", width: int | None = None) -> DataFrame:
    """Runs of the tone, increments of the volume (``delta``, 0 for the first sample), water of each run, and ``no``, ``tone``
    or ``yes`` for each sample. ``width`` cuts long sessions by ``time_us``."""
    order = ["frame"]
    near = scanned(df, {"_tone_before": previous(F.col(tone) > 0), "_before": previous(F.col(total_of))}, order, width, "time_us")
    changed = F.when(F.col("_tone_before").isNull(), 1).otherwise((~(F.col(tone) > 0).eqNullSafe(F.col("_tone_before.v"))).cast("int"))
    rows = near.select(*df.columns, changed.alias("_changed"), F.coalesce(F.col(total_of) - F.col("_before.v"), F.lit(0.0)).alias("delta"))
    rows = scanned(rows, {"run": total(F.col("_changed"))}, order, width, "time_us").drop("_changed")
    summed = over_runs(rows, "run", F.col("delta"), "run_volume", width)
    kind = F.when(~(F.col(tone) > 0), "no").when(F.col("run_volume") > 0, "yes").otherwise("tone")
    return summed.withColumn("reward", kind)


def gated(value: str, states: list[str], state: str = "system_state") -> Column:
    """A value in some states, 0 elsewhere."""
    return F.when(F.col(state).isin(states), F.col(value)).otherwise(0.0)


def gated_fill(df: DataFrame, name: str, value: str, states: list[str], state: str = "system_state", width: int | None = None) -> DataFrame:
    """``name`` is a value in some states, held across the others; 0 before the first sample that isn't idle."""
    scans = {"_held": latest(F.when(F.col(state).isin(states), F.col(value))), "_begun": total(F.when(F.col(state) != IDLE, 1))}
    near = scanned(df, scans, ["frame"], width, "time_us")
    return near.withColumn(name, F.when(F.col("_begun") > 0, F.coalesce("_held", F.lit(0.0))).otherwise(0.0)).drop("_held", "_begun")


def brake_flag(torque: str, minimum: float) -> Column:
    """More than the smallest strength."""
    return (F.col(torque) > minimum).cast("int")


def present(df: DataFrame, order: list[str], absent: list[str] = ()) -> DataFrame:
    """The columns of a fixed order that are there and not left out."""
    return df.select(*[c for c in order if c in df.columns and c not in absent])


def behavior(
    clock: DataFrame, states: DataFrame, lick: DataFrame, valve: DataFrame, *, labels: dict[int, str],
    encoder: DataFrame | None = None, screen: DataFrame | None = None, brake: DataFrame | None = None,
    torque: DataFrame | None = None, encoder_states: tuple[str, ...] = (RUN,), minimum_torque: float = 0.0,
    window_us: int = 100_000, drop_time: bool = False, width: int | None = None,
) -> DataFrame:
    """The behavior table, ``BEHAVIOR`` without the columns of absent streams.

    Streams have ``session, time_us, seq`` and their own column: ``state``, ``lick_state``, ``volume`` and ``tone_state``, ``traveled_distance_cm``,
    ``screen_state``, ``brake_torque``, ``torque``. States, licks and the valve are always there.
    """
    ticks = clock.select(*FRAME, "time_us")
    own = lambda df, *columns: df.select("session", "time_us", F.col("seq").cast("bigint").alias("seq"), *columns)
    sources = [(own(states, F.col("state").alias("_state")), ["_state"], "hold"),
        (own(valve, "volume", "tone_state"), ["volume", "tone_state"], "hold")]
    if encoder is not None:
        fast = running_speed(own(encoder, "traveled_distance_cm"), window_us, "traveled_distance_cm", width)
        sources.append((fast, ["traveled_distance_cm", "speed"], "linear"))
    if screen is not None:
        sources.append((own(screen, F.col("screen_state").alias("screens")), ["screens"], "hold"))
    if brake is not None:
        sources.append((own(brake, "brake_torque"), ["brake_torque"], "hold"))
    rows = align_all(ticks, sources, width=width)

    read = own(onsets_of(lick, "lick_state", width), F.lit("lick").alias("_stream"), F.lit(None).cast("double").alias("torque"))
    if torque is not None:
        read = read.unionByName(own(torque, F.lit("torque").alias("_stream"), F.col("torque").cast("double").alias("torque")))
    inside = in_windows(read, ticks, ["_stream", "torque"], width)
    if torque is not None:
        held = held_at_start(own(torque, F.col("torque").cast("double").alias("torque")), ticks, "torque", width)
        inside = inside.unionByName(held.withColumn("_stream", F.lit("torque")))
    found = inside.groupBy(*FRAME).agg(F.max((F.col("_stream") == "lick").cast("int")).alias("lick"),
        strongest("torque", F.col("_stream") == "torque").alias("torque"))
    joined = labelled(rows.join(found, FRAME, "left"), "_state", labels, "system_state", strict=True)

    out = reward_classes(elapsed_minutes(joined, ticks if width else None), width=width).withColumnsRenamed({"elapsed_min": "elapsed_minutes",
            "volume": "water_uL"}).withColumn("lick", F.coalesce("lick", F.lit(0)))
    if brake is not None:
        out = out.withColumn("brake", brake_flag("brake_torque", minimum_torque))
    if torque is not None:
        out = out.withColumn("torque_N_cm", F.when(F.col("system_state") == RUN, 0.0).otherwise(F.col("torque")))
    if encoder is not None:
        active = list(encoder_states)
        out = gated_fill(out, "distance_cm", "traveled_distance_cm", active, width=width).withColumn("speed_cm_s", gated("speed", active))
    return present(out, [*FRAME, *BEHAVIOR], TIME if drop_time else [])


def runtime(
    clock: DataFrame, encoder: DataFrame, corridors: DataFrame, trials: DataFrame, cues: DataFrame, zones: DataFrame,
    runtime_states: DataFrame, *, trial_types: dict[int, str], state_labels: dict[int, str],
    reinforcing: DataFrame | None = None, aversive: DataFrame | None = None, width: int | None = None, width_cm: float | None = None,
) -> DataFrame:
    """Trial number from 1 on, trial type, cue, trigger zone and runtime state of each sample, and guidance where it was recorded.

    ``trials`` and ``cues`` are keyed by ``distance`` and have ``trial_type_index`` and ``cue``; ``runtime_states`` and guidance have ``state``. Samples of
    sessions without encoder or corridors have no place and drop out. ``width`` cuts long sessions by time, ``width_cm`` by distance.
    """
    travelled = encoder.select("session", "time_us", "seq", F.col("traveled_distance_cm").alias("distance"))
    placed = corridor_distance(travelled, corridors, clock.select(*FRAME, "time_us"),
        width).withColumnRenamed("corridor_cm", "distance").filter("distance is not null")
    numbered = trials.select("session", "distance", "seq", "trial_type_index", F.row_number().over(in_order(order=["seq"])).alias("trial"))
    rows = align_all(placed, [(numbered, ["trial", "trial_type_index"], "hold"), (cues, ["cue"], "hold")], on="distance", width=width_cm)
    rows = in_zones(rows, zones, "distance", width_cm).withColumnRenamed("in_zone", "in_trigger_zone")
    state = lambda df, name: (df.select("session", "time_us", "seq", F.col("state").alias(name)), [name], "hold")
    guided = {"reinforcing_guided": reinforcing, "aversive_guided": aversive}
    rows = align_all(rows, [state(runtime_states, "_state"), *[state(df, name) for name, df in guided.items() if df is not None]], width=width)
    rows = labelled(labelled(rows, "_state", state_labels, "runtime_state", strict=True), "trial_type_index", trial_types, "trial_type", strict=True)
    return present(rows, [*FRAME, "trial", "trial_type", "cue", "in_trigger_zone", "runtime_state", *guided])


def video_table(clock: DataFrame, cameras: dict[str, DataFrame | None], pupil: DataFrame | None = None, width: int | None = None) -> DataFrame:
    """Energy (largest in the window) and luminance (linear) of each camera, pupil numbers (linear) and flags (held).

    A camera has ``session, time_us, seq, motion_energy, frame_luminance``; one that is None is left out. ``pupil`` has the columns of
    ``pose.pupil_metrics`` with the time of each frame.
    """
    ticks = clock.select(*FRAME, "time_us")
    there = {name: df for name, df in cameras.items() if df is not None}
    sources, read = [], None
    for name, df in there.items():
        values = {f"{name}_motion_energy": F.col("motion_energy").cast("double"), f"{name}_frame_luminance": F.col("frame_luminance").cast("double")}
        sources.append((df.select("session", "time_us", "seq", *[v.alias(k) for k, v in values.items()]), list(values), "linear"))
        part = df.select("session", "time_us", F.col("seq").cast("bigint").alias("seq"), F.lit(name).alias("_camera"),
            F.col("motion_energy").cast("double").alias("_energy"))
        read = part if read is None else read.unionByName(part)
    if pupil is not None:
        flags = [c for c in pupil.columns if c in PUPIL_FLAGS]
        numbers = [c for c in pupil.columns if c not in (*FRAME, "time_us", "seq", *PUPIL_FLAGS)]
        sources.append((pupil.select("session", "time_us", "seq", *[F.col(c).cast("int").alias(c) for c in flags]), flags, "hold"))
        sources.append((pupil.select("session", "time_us", "seq", *[F.col(c).cast("double").alias(c) for c in numbers]), numbers, "linear"))
    if not sources:
        return ticks.select(*FRAME)
    rows = align_all(ticks, sources, width=width)
    if read is not None:
        most = [F.max(F.when((F.col("_camera") == name) & ~F.isnan("_energy"), F.col("_energy"))).alias(f"_most_{name}") for name in there]
        seen = [F.count_if(F.col("_camera") == name).alias(f"_seen_{name}") for name in there]
        rows = rows.join(in_windows(read, ticks, ["_camera", "_energy"], width).groupBy(*FRAME).agg(*most, *seen), FRAME, "left")
        largest = {f"{name}_motion_energy": F.when(F.coalesce(F.col(f"_seen_{name}"), F.lit(0)) == 0,
                F.col(f"{name}_motion_energy")).otherwise(F.coalesce(f"_most_{name}", F.lit(float("nan"))))
            for name in there}
        rows = rows.withColumns(largest)
    return rows.select(*FRAME, *[c for _, values, _ in sources for c in values])


def masked_outside_run(df: DataFrame) -> DataFrame:
    """In idle and rest no cue, trial and trial type."""
    out = F.col("system_state").isin(IDLE, REST)
    masks = {"cue": NO_CUE, "trial": NO_TRIAL, "trial_type": NO_TRIAL_TYPE}
    return df.withColumns({c: F.when(out, F.lit(v)).otherwise(F.col(c)) for c, v in masks.items() if c in df.columns})


def clipped(df: DataFrame, system_states: DataFrame, runtime_states: DataFrame) -> DataFrame:
    """From the first system state that isn't 0 to the last runtime state; a side without entries stays."""
    first = system_states.filter("state <> 0").groupBy("session").agg(F.min("time_us").alias("_from"))
    last = runtime_states.groupBy("session").agg(F.max("time_us").alias("_to"))
    inside = F.coalesce(F.col("time_us") >= F.col("_from"), F.lit(True)) & F.coalesce(F.col("time_us") <= F.col("_to"), F.lit(True))
    return df.join(first, "session", "left").join(last, "session", "left").filter(inside).select(*df.columns)


def side_by_side(*tables: DataFrame) -> DataFrame:
    """Tables of one height joined on session and frame; a frame that one lacks drops out, which X1 counts."""
    return reduce(lambda a, b: a.join(b.drop("time_us"), FRAME), tables)


def fluorescence(band: DataFrame, pulses: DataFrame, recorded: DataFrame, counts: DataFrame, traces: dict[str, DataFrame],
        tolerance_us: int = TOLERANCE_US) -> DataFrame:
    """The imaging clock: frames aligned with the recorder's own (F11, F12), with an array column of each trace."""
    return attach_traces(aligned_frames(band, pulses, recorded, counts, tolerance_us), traces)


def camera_clock(frames: DataFrame, ranks: dict[str, int] | None = None, width: int | None = None) -> DataFrame:
    """The frames of each session's slowest camera (A13) as its reference clock, numbered from 1 on. ``frames`` has ``camera``."""
    own = frames.join(slowest_clock(frames, ranks).select("session", "camera"), ["session", "camera"])
    return scanned(own, {"frame": total(F.lit(1))}, ["time_us", "seq"], width).select("session", F.col("frame").cast("int").alias("frame"), "time_us")


def experiment(frames: DataFrame, behavior_table: DataFrame, runtime_table: DataFrame, video: DataFrame,
        system_states: DataFrame, runtime_states: DataFrame) -> DataFrame:
    """The imaging clock with its traces and all tables on it, masked, clipped and described. The behavior table has no times of its own."""
    return described(clipped(masked_outside_run(side_by_side(frames, behavior_table, runtime_table, video)), system_states, runtime_states))


def training(behavior_table: DataFrame, video: DataFrame, system_states: DataFrame, runtime_states: DataFrame) -> DataFrame:
    """Behavior with its times and video, both on the slowest camera's clock, clipped and described."""
    return described(clipped(side_by_side(behavior_table, video), system_states, runtime_states))


def by_type(sessions: DataFrame, assembled: dict[str, DataFrame]) -> DataFrame:
    """Each type's branch for its sessions, missing columns null; other types give no rows and are reported by X1."""
    parts = [table.join(sessions.filter(F.col("type") == kind).select("session"), "session", "left_semi") for kind, table in assembled.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


PUPIL_FLAGS = ("blinking_state", "dilation_state")


def _descriptions() -> dict[str, str]:
    px, axis = "in pixels of the face camera", {"x": "horizontal", "y": "vertical"}
    out = {
        "session": "key of the session", "frame": "number of the sample on the reference clock",
        "time_us": "time of the sample in microseconds since 1970",
        "elapsed_minutes": "minutes since the first sample of the clock",
        "brake": "1 while the wheel is held", "screens": "1 while the displays are lit",
        "torque_N_cm": "strongest torque since the sample before, with its sign; 0 while running",
        "distance_cm": "distance run so far",
        "speed_cm_s": "running speed; 0 where the wheel is not read", "lick": "1 if a lick began since the sample before",
        "water_uL": "water given so far, in microlitres",
        "reward": "no without a tone, yes with a tone and water, else tone",
        "system_state": "what the acquisition system was doing",
        "trial": "number of the trial from 1 on; 65535 outside runs",
        "trial_type": "name of the trial's type; undefined outside runs", "cue": "code of the wall cue; 255 outside runs",
        "in_trigger_zone": "1 inside a trigger zone", "runtime_state": "stage of the experiment",
        "reinforcing_guided": "1 while rewards are guided", "aversive_guided": "1 while aversive stimuli are guided",
        "pupil_diameter_px": f"mean of the two axes of the pupil's ellipse {px}",
        "pupil_area_px2": "area of the pupil's ellipse in square pixels",
        "pupil_fit_condition": "condition number of the pupil's fit, lower is better",
        "pupil_fit_residual_px": f"distance of trusted points from the pupil's ellipse {px}",
        "eye_width_px": f"width of the eye's ellipse {px}", "eye_height_px": f"height of the eye's ellipse {px}",
        "eye_openness": "height of the eye over its width",
        "blinking_state": "1 during a blink", "dilation_state": "1 where the pupil is wider than the eye shows",
    }
    for a, name in axis.items():
        out |= {f"pupil_center_{a}_px": f"{name} place of the pupil {px}",
            f"eye_center_{a}_px": f"{name} place of the eye {px}",
            f"reflection_{a}_px": f"{name} place of the light's reflection {px}"}
        out |= {f"pupil_reflection_offset_{a}_px": f"{name} way from the reflection to the pupil {px}",
            f"pupil_in_eye_{a}": f"{name} place of the pupil in the eye, in half axes of the eye"}
    for camera in ("face", "body"):
        out |= {f"{camera}_camera_motion_energy": f"largest change between pictures of the {camera} camera since the sample before",
            f"{camera}_camera_frame_luminance": f"mean grey level of the {camera} camera"}
    for days, cells in {"single_day": "this session", "multi_day": "all sessions of the animal"}.items():
        for trace in ("cell_fluorescence", "neuropil_fluorescence", "subtracted_fluorescence", "spikes"):
            out[f"{days}_{trace}"] = f"{trace.replace('_', ' ')} of each cell found in {cells}"
    return out


#: What the columns mean (fixed names).
DESCRIPTIONS = _descriptions()


def described(df: DataFrame) -> DataFrame:
    """Columns with their descriptions as metadata."""
    return df.select(*[F.col(c).alias(c, metadata={"description": DESCRIPTIONS[c]}) if c in DESCRIPTIONS else F.col(c) for c in df.columns])


def description_table(df: DataFrame) -> DataFrame:
    """``column, description`` of every column of a table; an undescribed one has null, which B21 reports."""
    return df.sparkSession.createDataFrame([(c, DESCRIPTIONS.get(c)) for c in df.columns], "column string, description string")
