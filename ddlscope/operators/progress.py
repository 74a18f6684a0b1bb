"""Progress of runs over their outcomes. `run_counts` works on a batch and on a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ddlscope.fixed import ETA_SHOWN_ABOVE_SECONDS
from ddlscope.functions import errors
from ddlscope.operators.positions import with_position


def run_counts(outcomes: DataFrame, run: Sequence[str] = ("run_id",)) -> DataFrame:
    """Outcomes of each run by what became of the object, and the times of the first and the last."""
    what = errors.outcome()
    return outcomes.groupBy(*run).agg(
        F.count("*").alias("done"),
        *(F.count_if(what == w).alias(w) for w in ("generated", "failed", "excluded", "cancelled")),
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


def tally(outcomes: DataFrame, run: Sequence[str] = ("run_id",)) -> DataFrame:
    return outcomes.groupBy(*run, errors.outcome().alias("outcome")).agg(F.count("*").alias("objects"))


def _seconds(start: str, end: str) -> Column:
    def micros(ts: str) -> Column:
        return F.unix_micros(F.col(ts).cast("timestamp"))
    return (micros(end) - micros(start)) / F.lit(1e6)


def _with_eta(rows: DataFrame) -> DataFrame:
    """Time left if the rest goes as fast as what is done; shown only when it is long."""
    return (rows.withColumn("eta", F.col("elapsed") / F.col("done") * (F.col("total") - F.col("done")))
            .withColumn("eta_shown", F.col("eta") > ETA_SHOWN_ABOVE_SECONDS))


def run_progress(outcomes: DataFrame, work: DataFrame, run: Sequence[str] = ("run_id",)) -> DataFrame:
    """Done, total, elapsed seconds and time left of each run; `work` holds each run's `total`. A run without one has no time
    left (null)."""
    counts = run_counts(outcomes, run).withColumn("elapsed", _seconds("first_ts", "last_ts"))
    return _with_eta(counts.join(work, list(run), "left")).select(*run, "done", "total", "elapsed", "eta", "eta_shown")


def running_count(outcomes: DataFrame, run: Sequence[str] = ("run_id",), arrival: str = "attempt_id") -> DataFrame:
    """How many outcomes of its run had arrived with each one. Numbered without a window, since one run may hold much
    of all outcomes."""
    return with_position(outcomes.select(*run, "ts", arrival), [F.col("ts"), F.col(arrival)], run, "done")


def progress_log(outcomes: DataFrame, work: DataFrame, run: Sequence[str] = ("run_id",),
                 arrival: str = "attempt_id") -> DataFrame:
    """What was reported as each outcome arrived: done so far, elapsed seconds, time left."""
    starts = outcomes.groupBy(*run).agg(F.min("ts").alias("first_ts")).join(work, list(run), "left")
    rows = running_count(outcomes, run, arrival).join(starts, list(run)).withColumn("elapsed", _seconds("first_ts", "ts"))
    return _with_eta(rows).select(*run, arrival, "done", "total", "elapsed", "eta", "eta_shown")
