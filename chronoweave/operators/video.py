"""Motion energy and luminance of camera frames, in chunks whose number doesn't change the result."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_CHUNK = 4000
BLOCK = 3


#: Frames that are measured in one step.
STEP = 64


def block_means(pixels: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """V1: means of square blocks of planes (the last two axes); blocks that don't fit are cut off."""
    height, width = (n - n % block for n in pixels.shape[-2:])
    whole = pixels[..., :height, :width].astype(np.float64)
    return whole.reshape(*pixels.shape[:-2], height // block, block, width // block, block).mean(axis=(-3, -1))


def chunked(frames: DataFrame, size: int = LEAST_CHUNK) -> DataFrame:
    """V4: ``chunk`` of each frame; the last frame of a chunk is also the priming frame of the next."""
    chunk = F.floor(F.col("frame") / size)
    last = F.col("frame") % size == size - 1
    return frames.withColumn("chunk", F.explode(F.when(last, F.array(chunk, chunk + 1))
            .otherwise(F.array(chunk)))).withColumn("priming", F.floor(F.col("frame") / size) < F.col("chunk"))


def motion_energy(frames: DataFrame, size: int = LEAST_CHUNK, block: int = BLOCK) -> DataFrame:
    """V1-V4: ``session, camera, frame, motion_energy, frame_luminance``; ``frames`` has ``height, width, pixels``. The first energy is NaN.

    Chunks are dealt out and sorted; a task measures ``STEP`` frames at a time and carries the last one over.
    """
    dealt = chunked(frames, size).repartition("session", "camera", "chunk").sortWithinPartitions("session", "camera", "chunk", "frame")
    dealt = dealt.select("session", "camera", "chunk", "frame", "priming", "height", "width", "pixels")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        earlier, key = None, None
        for batch in (whole.slice(at, STEP) for whole in batches for at in range(0, whole.num_rows, STEP)):
            keys = list(zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True))
            shapes = np.stack([batch.column(k).to_numpy() for k in (5, 6)], axis=1)
            energy, light = np.full(len(keys), np.nan), np.empty(len(keys))
            cuts = np.flatnonzero((shapes[1:] != shapes[:-1]).any(axis=1)) + 1
            for a, b in itertools.pairwise([0, *cuts.tolist(), len(keys)]):
                pixels = np.frombuffer(b"".join(batch.column(7).slice(a, b - a).to_pylist()), dtype=np.uint8)
                planes = block_means(pixels.reshape(b - a, *shapes[a]), block)
                light[a:b] = planes.mean(axis=(1, 2))
                if key == keys[a] and earlier.shape == planes[0].shape:
                    energy[a] = np.abs(planes[0] - earlier).mean()
                same = np.array([keys[k] == keys[k - 1] for k in range(a + 1, b)], dtype=bool)
                energy[a + 1 : b][same] = np.abs(np.diff(planes, axis=0)).mean(axis=(1, 2))[same]
                earlier, key = planes[-1], keys[b - 1]
            out = pa.RecordBatch.from_arrays([*(batch.column(k) for k in (0, 1, 3)), pa.array(energy), pa.array(light)],
                names=["session", "camera", "frame", "motion_energy", "frame_luminance"])
            yield out.filter(pc.invert(batch.column(4)))

    kinds = dict(frames.dtypes)
    return dealt.mapInArrow(measure,
        f"session {kinds['session']}, camera {kinds['camera']}, frame {kinds['frame']}, motion_energy double, "
        f"frame_luminance double")


def truncated_chunks(frames: DataFrame, measured: DataFrame, size: int = LEAST_CHUNK) -> DataFrame:
    """V5: chunks with fewer rows than planned; only the last one of a camera may be short."""
    plan = frames.groupBy("session", "camera").agg(F.max("frame").alias("last"))
    rows = measured.groupBy("session", "camera", F.floor(F.col("frame") / size).alias("chunk")).agg(F.count(F.lit(1)).alias("rows"))
    chunks = plan.select("session", "camera", "last", F.explode(F.sequence(F.lit(0), F.floor(F.col("last") / size))).alias("chunk"))
    joined = chunks.join(rows, ["session", "camera", "chunk"], "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
    return joined.filter((F.col("rows") < size) & (F.col("chunk") < F.floor(F.col("last") / size))).select("session", "camera", "chunk", "rows")


def recordings(files: DataFrame, cameras: DataFrame) -> DataFrame:
    """V6: the file named after session and camera; cameras without one drop out."""
    named = cameras.withColumn("file", F.concat_ws("_", F.col("session").cast("string"), F.concat(F.col("camera").cast("string"), F.lit(".mp4"))))
    return named.join(files.select("file").distinct(), "file")
