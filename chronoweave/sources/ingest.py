"""Sources and sinks: log archives, path markers, digests, and tables of sessions."""

from __future__ import annotations

import itertools
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoweave.functions.expect import violations

#: Layout of an entry: source byte, microseconds since onset (or the onset itself in entry 0), payload (fixed values).
HEADER = struct.Struct("<BQ")
LENGTH = struct.Struct("<I")
#: Messages that are handed on at once.
DECODED = 10_000


def pack_archive(entries: list[tuple[int, int, bytes]]) -> bytes:
    """An archive: entries with their lengths, one behind the other; the first one has the onset."""
    out = bytearray()
    for source, elapsed, payload in entries:
        out += LENGTH.pack(HEADER.size + len(payload)) + HEADER.pack(source, elapsed) + payload
    return bytes(out)


def unpack_archive(content: bytes) -> Iterator[tuple[int, int, int, bytes]]:
    """``(seq, source, time_us, payload)`` of the messages, times made absolute by the onset entry."""
    at, seq, onset = 0, 0, 0
    while at < len(content):
        (size,) = LENGTH.unpack_from(content, at)
        source, elapsed = HEADER.unpack_from(content, at + LENGTH.size)
        payload = content[at + LENGTH.size + HEADER.size : at + LENGTH.size + size]
        at += LENGTH.size + size
        if seq == 0:
            onset = elapsed
        else:
            yield seq, source, onset + elapsed, payload
        seq += 1


def messages(files: DataFrame) -> DataFrame:
    """``path, seq, source, time_us, payload`` of archives; ``files`` has ``path, content``. A task holds one archive at a time."""
    names = ["path", "seq", "source", "time_us", "payload"]
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                entries = unpack_archive(content.as_py())
                while part := list(itertools.islice(entries, DECODED)):
                    columns = [[path.as_py()] * len(part), *zip(*part, strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return files.select("path", "content").mapInArrow(decode, "path string, seq bigint, source int, time_us bigint, payload binary")


def archives(spark: SparkSession, folder: str, pattern: str = "*.log") -> DataFrame:
    return messages(spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder))


def clock_spans(clocks: DataFrame, keys: list[str]) -> DataFrame:
    """First and last time and height of each clock, from one pruned column."""
    return clocks.groupBy(*keys).agg(F.min_by("time_us", "seq").alias("first_us"),
        F.max_by("time_us", "seq").alias("last_us"), F.count(F.lit(1)).alias("samples"))


def row_counts(table: DataFrame, keys: list[str]) -> DataFrame:
    """S3: rows by key; without keys the scan reads no column."""
    return table.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))


def schema_of(spark: SparkSession, path: str) -> list[str]:
    """Column names of a written table, from its footer."""
    return spark.read.parquet(path).columns


def markers(paths: DataFrame, dataset_marker: str, session_marker: str) -> DataFrame:
    """``kind, dataset, animal, session`` from paths below a project: depth 2 a dataset, depth 4 a session; sessions below a dataset drop out."""
    part = F.split("path", "/")
    rows = paths.select(part.alias("p"), F.size(part).alias("n"))
    sets = rows.filter((F.col("n") == 2) & (F.get("p", 1) == dataset_marker)).select(F.get("p", 0).alias("dataset")).distinct()
    runs = rows.filter((F.col("n") == 4) & (F.get("p", 3) == session_marker)).select(F.get("p", 0).alias("animal"), F.get("p", 1).alias("session"))
    own = runs.join(sets.withColumnRenamed("dataset", "animal"), "animal", "left_anti")
    none = F.lit(None).cast("string")
    return sets.select(F.lit("dataset").alias("kind"), "dataset", none.alias("animal"),
        none.alias("session")).unionByName(own.select(F.lit("session").alias("kind"), none.alias("dataset"), "animal",
            "session"))


def named_clocks(clocks: DataFrame, cameras: DataFrame) -> DataFrame:
    """Clocks under the name their camera has in the manifest; a camera without a clock is skipped."""
    return clocks.join(cameras.select("session", "source_id", F.col("name").alias("camera")), ["session", "source_id"])


def name_collisions(cameras: DataFrame) -> DataFrame:
    """Cameras that share a canonical name, or take the parsed name of another one."""
    shared = cameras.groupBy("session", "name").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    first = violations(shared, "canonical names differ", F.lit(True), F.concat_ws("/", "session", "name"), F.format_string("%d cameras", "_n"))
    other = cameras.select("session", F.col("parsed").alias("name"), F.col("source_id").alias("_other"))
    taken = cameras.join(other, ["session", "name"]).filter("source_id <> _other")
    return first.unionByName(violations(taken, "no camera takes another's parsed name", F.lit(True),
            F.concat_ws("/", "session", "name"), F.format_string("source %s", F.col("_other").cast("string"))))


#: Hex digits of a path's hash that name its group: 4096 groups to a session (fixed value of the digest).
GROUP_DIGITS = 3


def session_digests(files: DataFrame, excluded: list[str]) -> DataFrame:
    """One digest of all files of a session; sessions with excluded files only have none.

    Files are dealt to groups by the hash of their path. A group's digest is that of its lines, path and content digest, in order of the paths;
    the session's digest is that of its group digests in order. So a large session is digested by many tasks, and its last step reads
    at most 4096 lines.
    """
    digest = F.sha2("content", 256)
    own = files.filter(~F.col("name").isin(excluded)).select("session",
        F.substring(F.sha2("path", 256), 1, GROUP_DIGITS).alias("_group"),
        F.struct("path", digest.alias("digest")).alias("file"))
    line = lambda f: F.concat_ws(" ", f["path"], f["digest"])
    joined = lambda rows: F.sha2(F.array_join(rows, "\n"), 256)
    groups = own.groupBy("session", "_group").agg(joined(F.transform(F.array_sort(F.collect_list("file")), line)).alias("digest"))
    return groups.groupBy("session").agg(joined(F.transform(F.array_sort(F.collect_list(F.struct("_group", "digest"))),
                lambda g: F.concat_ws(" ", g["_group"], g["digest"]))).alias("digest"))


def has_data(files: DataFrame, excluded: list[str]) -> DataFrame:
    """Whether a session holds a file outside the excluded names."""
    return files.groupBy("session").agg(F.bool_or(~F.col("name").isin(excluded)).alias("has_data"))


def verified(digests: DataFrame, stored: DataFrame) -> DataFrame:
    """Computed against stored digests; a mismatch is a row, not an error."""
    verdict = F.when(F.col("stored").isNull(), "NO_STORED_VALUE").when(F.col("stored") == F.col("digest"), "VERIFIED").otherwise("COMPROMISED")
    return digests.join(stored.select("session", F.col("digest").alias("stored")), "session", "left").select("session", verdict.alias("verdict"))


def write_sessions(table: DataFrame, path: str) -> None:
    """One folder for each animal and session; only the ones in ``table`` are replaced."""
    table.repartition("animal", "session").write.mode("overwrite").option("partitionOverwriteMode",
        "dynamic").partitionBy("animal", "session").parquet(path)


def read_sessions(spark: SparkSession, path: str, order: Column | None = None) -> DataFrame:
    """The whole table, partition columns included."""
    rows = spark.read.parquet(path)
    return rows if order is None else rows.orderBy(order)
