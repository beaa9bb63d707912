"""Scheduler records: states and verdicts of allocations, batches, ledgers, and the text tables of a batch scheduler."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoweave.functions.ordering import natural_key, natural_sort

#: Names of states, verdicts and remediations (fixed values).
HELD, SETTLED, GONE = "held", "settled", "gone"
RUNNING, FINISHED, FAILED, ABANDONED, STRANDED = "running", "finished", "failed", "abandoned", "stranded"
REMEDIATION = {RUNNING: "none", FINISHED: "drop", FAILED: "drop", ABANDONED: "drop", STRANDED: "reset_and_drop"}
PROGRESSING, STALLED, AWAITING_CLOSURE = "progressing", "stalled", "awaiting_closure"
#: Scheduler states that never change again (fixed values).
TERMINAL = ["COMPLETED", "FAILED", "CANCELLED", "TIMEOUT", "NODE_FAIL", "OUT_OF_MEMORY", "BOOT_FAIL", "DEADLINE", "PREEMPTED", "REVOKED", "BLOCKED"]
#: The other states that are known (fixed values).
OPEN = ["PENDING", "RUNNING"]
_UNITS = {"K": 1024.0, "M": 1024.0**2, "G": 1024.0**3, "T": 1024.0**4, "P": 1024.0**5}


def allocation_of(executor: Column) -> Column:
    """Q1: the id behind ``slurm:``; another scheme, or none, gives an empty string."""
    at = F.instr(executor, ":")
    return F.coalesce(F.when((at > 0) & (F.substring(executor, F.lit(1), at - 1) == "slurm"),
            F.substring(executor, at + 1, F.lit(1 << 30))), F.lit(""))


def allocation_state(allocation: Column, status: Column, queued: Column, canceled: Column, unreadable: Column) -> Column:
    """Q2: where the two records place an allocation; ``status`` is null or UNRESOLVED without an accounting row."""
    known = F.coalesce(status, F.lit("UNRESOLVED"))
    return (
        F.when(F.coalesce(allocation, F.lit("")) == "", GONE)
        .when(F.coalesce(canceled, F.lit(False)), SETTLED)
        .when(known == "BLOCKED", SETTLED)
        .when(unreadable | F.coalesce(queued, F.lit(False)), HELD)
        .when(known == "UNRESOLVED", GONE)
        .when(known.isin(TERMINAL), SETTLED)
        .otherwise(HELD)
    )


def verdict(scheduler_state: Column, claim_state: Column, tracked: Column, executor: Column) -> Column:
    """Q3: what to think of an allocation; an executor that is there but names no allocation can't be asked."""
    unasked = (F.coalesce(executor, F.lit("")) != "") & (allocation_of(executor) == "")
    return (
        F.when((scheduler_state == HELD) | (F.coalesce(claim_state, F.lit("")) == HELD), RUNNING)
        .when(tracked == "SUCCEEDED", FINISHED)
        .when(tracked == "FAILED", FAILED)
        .when(tracked == "RUNNING", F.when(unasked, RUNNING).otherwise(STRANDED))
        .otherwise(ABANDONED)
    )


def claims(submissions: DataFrame, state: DataFrame) -> DataFrame:
    """Q8: latest recorded status and executor of each submission, and the allocation that the executor names."""
    keys = ["unit", "job_id"]
    latest = state.groupBy(*keys).agg(F.max_by(F.struct("status", "executor"), "at").alias("_s")).select(*keys,
        F.col("_s.status").alias("tracked"), F.col("_s.executor").alias("executor"))
    return submissions.join(latest, keys, "left").withColumn("claim", allocation_of(F.col("executor")))


def queried(claimed: DataFrame) -> DataFrame:
    """Q8: distinct allocations that the scheduler has to be asked about."""
    return claimed.select(F.explode(F.array("allocation", "claim")).alias("allocation")).filter("allocation <> ''").distinct()


def resolved(claimed: DataFrame, reading: DataFrame, unreadable: bool = False) -> DataFrame:
    """Q2, Q3, Q8: states, verdict and remediation of each recorded allocation.

    ``claimed`` has ``batch_id, unit, job_id, allocation, tracked, executor, claim``; ``reading`` a row per allocation with
    ``status, queued, canceled``. An allocation may be claimed by many jobs; the reading is joined, not looked up.
    """
    state = lambda c, p: allocation_state(F.col(c), F.col(f"{p}_status"), F.col(f"{p}_queued"), F.col(f"{p}_canceled"),
        F.lit(unreadable))
    side = lambda c, p: reading.select(F.col("allocation").alias(c), F.col("status").alias(f"{p}_status"),
        F.col("queued").alias(f"{p}_queued"), F.col("canceled").alias(f"{p}_canceled"))
    both = claimed.join(side("allocation", "a"), "allocation", "left").join(side("claim", "c"), "claim", "left")
    out = both.withColumns({"scheduler_state": state("allocation", "a"),
            "claim_state": F.when(F.col("claim") != "", state("claim", "c")).otherwise("")})
    out = out.withColumn("verdict", verdict(F.col("scheduler_state"), F.col("claim_state"), F.col("tracked"), F.col("executor")))
    remedy = F.create_map(*[F.lit(x) for pair in REMEDIATION.items() for x in pair])
    return out.select(*claimed.columns, "scheduler_state", "claim_state", "verdict", remedy[F.col("verdict")].alias("remediation"))


def batch_verdicts(resolutions: DataFrame) -> DataFrame:
    """Q4: verdict of each batch with its counts."""
    counts = [F.count_if(F.col("verdict") == v).alias(v) for v in REMEDIATION]
    out = resolutions.groupBy("batch_id").agg(*counts, F.count_if(F.col("scheduler_state") == GONE).alias("_gone"))
    return out.withColumn("batch_verdict", F.when(F.col(RUNNING) > 0, PROGRESSING).when(F.col("_gone") > 0, STALLED)
        .otherwise(AWAITING_CLOSURE)).drop("_gone")


def live_allocations(resolutions: DataFrame) -> DataFrame:
    """Q5: distinct recorded and claimed allocations that are held, in natural order."""
    recorded = resolutions.filter(F.col("scheduler_state") == HELD).select("allocation")
    claimed = resolutions.filter(F.col("claim_state") == HELD).select(F.col("claim").alias("allocation"))
    return natural_sort(recorded.union(claimed).distinct(), "allocation")


def closable(batches: DataFrame, resolutions: DataFrame) -> DataFrame:
    """Q6: batches all of whose entries prescribe the plain drop; one without entries too."""
    return batches.join(resolutions.filter(F.col("remediation") != "drop").select("batch_id").distinct(), "batch_id", "left_anti")


def stranded_targets(resolutions: DataFrame) -> DataFrame:
    """Q7: distinct jobs whose claim has to be cleared."""
    return resolutions.filter(F.col("verdict") == STRANDED).select("unit", "job_id").distinct()


def reconciled(resolutions: DataFrame, edges: DataFrame) -> DataFrame:
    """Q9: ``job_id, decision, allocation``: adopted, withheld or dispatchable.

    A running job with a held allocation is adopted, the claimed one before the recorded one; one without is withheld, and so is
    every job that needs a withheld job and isn't adopted, to any depth.
    """
    from chronoweave.operators.graph import joined, settled, together

    held = F.when(F.col("claim_state") == HELD, F.col("claim")).when(F.col("scheduler_state") == HELD, F.col("allocation"))
    running = F.col("verdict") == RUNNING
    rows = settled(resolutions.select("job_id", F.when(running, held).alias("adopted"), (running & held.isNull()).alias("_lost")))
    fresh = rows.filter("_lost").select("job_id")
    # Kept once: edges may be a long plan, and every round reads them. A round writes its new jobs only.
    links = settled(edges.select("job_id", "needs").join(rows.filter("adopted is null and not coalesce(_lost, false)").select("job_id"), "job_id", "left_semi"))
    rounds = [fresh]
    while not fresh.isEmpty():
        behind = links.join(fresh.select(F.col("job_id").alias("needs")), "needs", "left_semi").select("job_id").distinct()
        fresh = settled(behind.join(together(rounds), "job_id", "left_anti"))
        rounds = joined(rounds, fresh)
    withheld = together(rounds).distinct()
    decided = rows.join(withheld.withColumn("_w", F.lit(True)), "job_id", "left")
    return decided.select("job_id", F.when(F.col("adopted").isNotNull(), "adopted").when(F.col("_w"), "withheld")
        .otherwise("dispatchable").alias("decision"), F.col("adopted").alias("allocation"))


def size_bytes(text: Column) -> Column:
    """Q11: a magnitude with a unit from K to P; null if it has none."""
    clean = F.trim(text)
    number = F.regexp_extract(clean, r"^(\d+\.?\d*|\.\d+)(?![0-9.])", 1)
    unit = F.upper(F.substring(clean, F.char_length(number) + 1, F.lit(1)))
    scale = F.try_element_at(F.create_map(*[F.lit(x) for pair in _UNITS.items() for x in pair]), unit)
    return number.try_cast("double") * F.coalesce(scale, F.lit(1.0))


def duration_seconds(text: Column) -> Column:
    """Q11: ``[days-]h:m:s`` or fewer fields; null if one isn't a number."""
    clean = F.trim(text)
    days = F.when(F.instr(clean, "-") > 0, F.substring_index(clean, "-", 1)).otherwise("0")
    clock = F.when(F.instr(clean, "-") > 0, F.substring(clean, F.instr(clean, "-") + 1, F.lit(1 << 30))).otherwise(clean)
    number = lambda x: F.regexp_extract(F.trim(x), r"^(\d+\.?\d*|\.\d+)$", 1).try_cast("double")
    return number(days) * 86400.0 + F.aggregate(F.split(clock, ":"), F.lit(0.0), lambda a, x: a * 60.0 + number(x))


def accounting_rows(lines: DataFrame, fields: list[str]) -> DataFrame:
    """Pipe-separated lines with one field for each name; other lines drop out. ``lines`` has ``line, value``."""
    parts = lines.withColumn("_f", F.split("value", r"\|")).filter(F.size("_f") == len(fields))
    return parts.select("line", *[F.get("_f", k).alias(name) for k, name in enumerate(fields)])


def queue_rows(lines: DataFrame, fields: list[str]) -> DataFrame:
    """The same by position, trimmed."""
    rows = accounting_rows(lines, fields)
    return rows.select("line", *[F.trim(name).alias(name) for name in fields])


def merged_accounting(rows: DataFrame, sizes: list[str], durations: list[str], identifier: str = "job_id") -> DataFrame:
    """Q10: steps folded into their job: the largest measured figure keeps its text, other fields their first value; ``.extern`` is left out.

    A figure that doesn't parse counts only while nothing else is there, as the first row of a job does.
    """
    own = rows.filter(~F.coalesce(F.col(identifier).contains("extern"), F.lit(False))).withColumn("_job", F.substring_index(identifier, ".", 1))
    fields = [c for c in rows.columns if c not in ("line", identifier)]
    # Figures are parsed once for each row, before the aggregate, which reads an ordering several times.
    own = own.withColumns({f"_value_{c}": size_bytes(F.col(c)) if c in sizes else duration_seconds(F.col(c))
            for c in fields if c in sizes or c in durations})

    def folded(c: str) -> Column:
        filled = F.when(F.col(c) != "", F.col(c))
        first = F.min_by(c, F.struct("line", c))
        if c not in sizes and c not in durations:
            return F.coalesce(F.min_by(c, F.when(filled.isNotNull(), F.struct("line", c))), first).alias(c)
        value = F.col(f"_value_{c}")
        return F.coalesce(F.max_by(c, F.when(value.isNotNull(), F.struct(value, -F.col("line")))), first).alias(c)

    return own.groupBy(F.col("_job").alias(identifier)).agg(*[folded(c) for c in fields])


def allocation_statuses(requested: DataFrame, accounting: DataFrame, blocked: DataFrame) -> DataFrame:
    """Q12: ``allocation, status``: UNRESOLVED without a row, steps skipped, decorations cut off, UNKNOWN for a state that isn't known.

    If any requested allocation is pending, those that the queue says can never start are BLOCKED. A later row replaces an earlier one.
    """
    word = F.regexp_replace(F.substring_index("state", " ", 1), "[^A-Za-z_]", "")
    known = TERMINAL + OPEN
    status = F.when(F.col("state").isin(known), F.col("state")).when(word.isin(known), word).otherwise("UNKNOWN")
    own = accounting.filter(~F.col("job_id").contains(".")).groupBy(F.col("job_id").alias("allocation")).agg(F.max_by("state", "line").alias("state"))
    rows = requested.distinct().join(own, "allocation", "left").withColumn("status", F.when(F.col("state").isNull(), "UNRESOLVED").otherwise(status))
    pending = F.broadcast(rows.agg(F.coalesce(F.bool_or(F.col("status") == "PENDING"), F.lit(False)).alias("_any")))
    never = blocked.select("allocation").distinct().withColumn("_never", F.lit(True))
    return rows.join(never, "allocation", "left").crossJoin(pending).select("allocation",
        F.when(F.col("_any") & F.coalesce("_never", F.lit(False)), "BLOCKED").otherwise(F.col("status")).alias("status"))


def upsert(ledger: DataFrame, batch: DataFrame) -> DataFrame:
    """Q13: submissions after a batch is recorded: those of the same batch that weren't submitted again are carried in front."""
    same = ledger.join(batch.select("batch_id").distinct(), "batch_id",
        "left_semi").join(batch.select("batch_id", "unit", "job_id"), ["batch_id", "unit", "job_id"], "left_anti")
    others = ledger.join(batch.select("batch_id").distinct(), "batch_id", "left_anti")
    order = lambda df, k: df.select(*ledger.columns, F.lit(k).alias("part"))
    return order(others, 0).unionByName(order(same, 1)).unionByName(order(batch, 2))


def dropped(ledger: DataFrame, batch_ids: DataFrame) -> DataFrame:
    """Q13: the ledger without some batches."""
    return ledger.join(batch_ids, "batch_id", "left_anti")


def allocation_listing(resolutions: DataFrame, filters: dict[str, list[str]]) -> DataFrame:
    """Q14: allocations that pass filters with value lists, in natural order inside each batch."""
    for column, values in filters.items():
        resolutions = resolutions.filter(F.col(column).isin(values))
    return resolutions.orderBy("batch_id", natural_key(F.col("allocation")), "allocation")
