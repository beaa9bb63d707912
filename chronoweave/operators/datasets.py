"""Datasets: admission of sessions, membership, job universes and their edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronoweave.functions.ordering import natural_key, natural_sort
from chronoweave.functions.shared import dealt
from chronoweave.operators.state import SUCCEEDED


def outstanding(sessions: DataFrame, policy: DataFrame, jobs: DataFrame) -> DataFrame:
    """Sessions that can't join, with the pipelines they still need (``pipeline: x of y``); a type without policy has no list.

    ``sessions`` has ``animal, session, type``; ``policy`` ``type, pipeline``; ``jobs`` one row per job.
    """
    keys = ["animal", "session"]
    have = jobs.groupBy(*keys, "pipeline").agg(F.count(F.lit(1)).alias("_all"), F.count_if(F.col("status") == SUCCEEDED).alias("_done"))
    need = sessions.join(policy, "type").join(have, [*keys, "pipeline"],
        "left").withColumns({"_all": F.coalesce("_all", F.lit(0)), "_done": F.coalesce("_done", F.lit(0))})
    lacking = need.filter((F.col("_all") == 0) | (F.col("_done") < F.col("_all")))
    text = F.format_string("%s: %d of %d", "pipeline", "_done", "_all")
    listed = lacking.groupBy(*keys).agg(F.sort_array(F.collect_list(text)).alias("outstanding"))
    refused = sessions.join(policy.select("type").distinct(), "type", "left_anti").select(*keys,
        F.lit(None).cast("array<string>").alias("outstanding"))
    return listed.unionByName(refused)


def admitted(sessions: DataFrame, policy: DataFrame, jobs: DataFrame) -> DataFrame:
    return sessions.join(outstanding(sessions, policy, jobs).select("animal", "session"), ["animal", "session"], "left_anti")


def unlike_first(members: DataFrame) -> DataFrame:
    """Members of a dataset whose type or system differs from its first member's."""
    first = members.groupBy("dataset").agg(F.min_by(F.struct("type", "system"), "position").alias("_first"))
    return members.join(first, "dataset").filter(~F.struct("type", "system").eqNullSafe(F.col("_first"))).drop("_first")


def resolved_names(requests: DataFrame, found: DataFrame) -> DataFrame:
    """D3: each requested name once, in first order, with its matches; one match is a resolution."""
    once = requests.groupBy("name").agg(F.min("position").alias("position"))
    matches = found.groupBy("name").agg(F.count(F.lit(1)).alias("matches"), F.min("path").alias("path"))
    return once.join(matches, "name", "left").select("name", "position", F.coalesce("matches", F.lit(0)).alias("matches"),
        F.when(F.col("matches") == 1, F.col("path")).alias("path"))


def membership_changes(current: DataFrame, wanted: DataFrame, frozen: DataFrame) -> DataFrame:
    """``animal, session, change``: rows to add, or refused because a frozen animal's sessions would change."""
    keys = ["animal", "session"]
    fresh = wanted.dropDuplicates(keys).join(current, keys, "left_anti")
    return fresh.join(frozen.select("animal").distinct().withColumn("_frozen", F.lit(True)), "animal",
        "left").select(*keys, F.when(F.col("_frozen"), "refused").otherwise("add").alias("change"))


def repeated(requests: DataFrame, column: str) -> DataFrame:
    return requests.groupBy(column).agg(F.count(F.lit(1)).alias("times")).filter("times > 1")


def latest_per_animal(sessions: DataFrame, name: str = "session") -> DataFrame:
    """The row of the newest session of each animal in natural order."""
    others = [c for c in sessions.columns if c != "animal"]
    return sessions.groupBy("animal").agg(F.max_by(F.struct(*others), F.struct(natural_key(F.col(name)), name)).alias("_l")).select("animal", "_l.*")


def universe(members: DataFrame, parts: int | None = None) -> DataFrame:
    """Discovery for each animal, extraction and assembly for each session. ``parts`` is the number of tasks that animals are dealt to."""
    discover = dealt(members.select("dataset", "animal"), parts, "dataset", "animal").distinct().select("dataset", "animal",
        F.lit(None).cast(members.schema["session"].dataType).alias("session"), F.lit("discover").alias("job_name"))
    each = members.select("dataset", "animal", "session", F.explode(F.array(F.lit("extract"), F.lit("assemble"))).alias("job_name"))
    return discover.unionByName(each)


def job_edges(jobs: DataFrame, parts: int | None = None) -> DataFrame:
    """``dataset, animal, session, job_name, needs``: extraction needs its animal's discovery, assembly its session's extraction.
    ``parts`` is the number of tasks that jobs are dealt to: a join follows the side that is dealt already."""

    def wants(name: str, need: str, keys: list[str]) -> DataFrame:
        there = dealt(jobs.filter(F.col("job_name") == need).select(*keys), parts, *keys)
        return jobs.filter(F.col("job_name") == name).join(there, keys, "left_semi").withColumn("needs", F.lit(need))

    return wants("extract", "discover", ["dataset", "animal"]).unionByName(wants("assemble", "extract", ["dataset", "animal", "session"]))


def not_succeeded(jobs: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """The universe without what has succeeded."""
    return jobs.join(state.filter(F.col("status") == SUCCEEDED).select(*keys).distinct(), keys, "left_anti")


def reset(state: DataFrame, targets: DataFrame, keys: list[str]) -> DataFrame:
    """Jobs of the targets go back to SCHEDULED."""
    hit = targets.select(*keys).distinct().withColumn("_hit", F.lit(True))
    return state.join(hit, keys, "left").withColumn("status", F.when(F.col("_hit"), "SCHEDULED").otherwise(F.col("status"))).drop("_hit")


def camera_jobs(cameras: DataFrame, archives: DataFrame, predictions: DataFrame) -> DataFrame:
    """A clock job and a pose job for each camera; possible with exactly one archive, or with a prediction."""
    keys = ["session", "camera"]
    count = archives.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    posed = predictions.select(*keys).distinct().withColumn("_posed", F.lit(True))
    rows = cameras.join(count, keys, "left").join(posed, keys, "left")
    clock = F.struct(F.lit("clock").alias("job_name"), (F.coalesce("_n", F.lit(0)) == 1).alias("possible"))
    track = F.struct(F.lit("pose").alias("job_name"), F.coalesce("_posed", F.lit(False)).alias("possible"))
    return rows.select(*keys, F.explode(F.array(clock, track)).alias("_j")).select(*keys, "_j.*")


def merged_membership(current: DataFrame, resolved: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """One row for each (animal, session) of old and new members, with whether the animal is built anew."""
    keys = ["animal", "session"]
    fresh = resolved.join(current, keys, "left_anti").select("animal").unionByName(
        rebuilt.select("animal")).distinct().withColumn("_anew", F.lit(True))
    return current.select(*keys).unionByName(resolved.select(*keys)).dropDuplicates(keys).join(fresh, "animal",
        "left").select(*keys, F.coalesce("_anew", F.lit(False)).alias("build"))


def first_in_order(files: DataFrame, keys: list[str]) -> DataFrame:
    """Of the matching files of a session the first in natural order."""
    return files.groupBy(*keys).agg(F.min_by("path", F.struct(natural_key(F.col("path")), "path")).alias("path"))


def rank_by_name(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(natural_key(F.col(name)), name)))


def existing(found: DataFrame) -> DataFrame:
    """Datasets of a project in natural order, from its path markers."""
    return natural_sort(found.filter("kind = 'dataset'").select("dataset"), "dataset")
