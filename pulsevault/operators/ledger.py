"""The status ledger: candidates, upserts, stale items, runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Statuses that keep an input from being selected again (null does too); fixed by the ledger's format.
DONE = ["queued", "running", "success", "skipped", "failed"]


def new_candidates(catalog: DataFrame, ledger: DataFrame, done: list[str] | None = None) -> DataFrame:
    """Catalog rows (path, ...) without a ledger row whose status is done or null."""
    held = ledger.where(F.col("status").isNull() | F.col("status").isin(done or DONE)).select("path")
    return catalog.join(held, "path", "left_anti")


def upsert_status(ledger: DataFrame, events: DataFrame) -> DataFrame:
    """path, event_ts, status, message: the latest event of each path wins, over the ledger too; messages are cut to 512."""
    both = ledger.select("path", "event_ts", "status", "message", F.lit(0).alias("src")).unionByName(events.select("path", "event_ts", "status", "message", F.lit(1).alias("src")))
    last = both.groupBy("path").agg(F.max(F.struct("event_ts", "src", "status", "message")).alias("r"))
    return last.select("path", "r.event_ts", "r.status", F.substring("r.message", 1, 512).alias("message"))


#: Job states that tell that a job has ended (fixed by the batch system).
ENDED = ["DONE", "EXIT", "ZOMBI", "UNKWN"]


def stale_items(ledger: DataFrame, jobs: DataFrame, states: DataFrame, now: str, hours: float, kill_hours: float | None = None, ended: list[str] | None = None) -> DataFrame:
    """path, verdict, reason of items that the ledger has as queued or running for over `hours`: stale without a job, or if the
    job's state is unknown or tells its end. With kill_hours, jobs still alive are to be killed if they were submitted (else
    entered in the ledger) over so many hours ago; other live ones are left alone."""
    at = F.to_timestamp(F.lit(now))
    ago = lambda h: at - F.make_dt_interval(secs=F.lit(float(h) * 3600))
    old = ledger.where(F.col("status").isin("queued", "running") & (F.col("event_ts") < ago(hours)))
    rows = old.join(jobs.select("path", "job_id", "submit_ts"), "path", "left").join(states.select("job_id", "state"), "job_id", "left")
    gone = F.col("state").isNull() | F.col("state").isin(ended or ENDED)
    kill = F.lit(False) if kill_hours is None else F.coalesce("submit_ts", "event_ts") < ago(kill_hours)
    verdict = F.when(F.col("job_id").isNull() | gone, "stale").when(kill, "kill")
    reason = F.when(F.col("job_id").isNull(), "no job").otherwise(F.concat(F.lit("job "), "job_id", F.lit(" is "), F.coalesce("state", F.lit("missing"))))
    return rows.select("path", verdict.alias("verdict"), reason.alias("reason")).where("verdict is not null")


def merge_runs(runs: DataFrame, events: DataFrame) -> DataFrame:
    """run_id, date, started_at (the first), finished_at, status (of the latest event)."""
    cols = ["run_id", "date", "started_at", "finished_at", "status"]
    both = runs.select(*cols).unionByName(events.select(*cols))
    return both.groupBy("run_id").agg(F.max("date").alias("date"), F.min("started_at").alias("started_at"), F.max("finished_at").alias("finished_at"), F.max_by("status", F.struct("started_at", "status")).alias("status"))


#: The status of a merge run that has begun and not ended (fixed by the ledger's format).
BEGUN = "starting"


def running_now(runs: DataFrame, now: str, minutes: int, status: str = BEGUN) -> DataFrame:
    """date, run_id: the latest unfinished run of each date that has the status of one that has begun, less than `minutes` ago."""
    begun = runs.where((F.col("status") == status) & F.col("finished_at").isNull())
    young = begun.where(F.col("started_at") > F.to_timestamp(F.lit(now)) - F.make_dt_interval(mins=F.lit(minutes)))
    return young.groupBy("date").agg(F.max(F.struct("started_at", "run_id")).alias("r")).select("date", "r.run_id")


def date_spine(dates: DataFrame, first: str, last: str, counts: list[str]) -> DataFrame:
    """day and counts for every day from first to last, 0 where dates (day, counts) has none."""
    days = dates.sparkSession.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("day"))
    return days.join(dates, "day", "left").select("day", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in counts])
