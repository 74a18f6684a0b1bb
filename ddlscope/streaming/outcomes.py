"""Run counts and failure groups kept up to date as outcomes arrive.

Both are written trigger by trigger and read back merged (`epochs`), so that a restart from the checkpoint neither loses nor
doubles anything, and reading does not slow down as the stream goes on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ddlscope.operators import failures
from ddlscope.operators.progress import run_counts
from ddlscope.streaming.epochs import EVERY, Epochs


def _run_epochs(spark: SparkSession, path: str, run: Sequence[str], every: int = EVERY) -> Epochs:
    """Of a run, the last epoch that changed it has its counts."""
    def latest(rows: DataFrame) -> DataFrame:
        values = [c for c in rows.columns if c not in (*run, "epoch")]
        return (rows.groupBy(*run).agg(F.max_by(F.struct(*values), "epoch").alias("latest"))
                .select(*run, *(F.col(f"latest.{c}").alias(c) for c in values)))
    return Epochs(spark, path, latest, every)


def keep_run_counts(outcomes: DataFrame, path: str, checkpoint: str, run: Sequence[str] = ("run_id",),
                    every: int = EVERY) -> StreamingQuery:
    """Start keeping `run_counts` of a stream. Each trigger writes the runs it changed. State is one row of counts per run, and
    tasks send partial counts. Every so many triggers the epochs are compacted."""
    epochs = _run_epochs(outcomes.sparkSession, path, run, every)
    return (run_counts(outcomes, run).writeStream.outputMode("update").foreachBatch(epochs.write)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def latest_run_counts(spark: SparkSession, path: str, run: Sequence[str] = ("run_id",)) -> DataFrame:
    """Counts of each run as of the last trigger that changed them."""
    return _run_epochs(spark, path, run).read()


def _group_epochs(spark: SparkSession, path: str, within: Sequence[str], every: int = EVERY) -> Epochs:
    return Epochs(spark, path, lambda rows: failures.merged_groups(rows, within), every)


def keep_failure_groups(outcomes: DataFrame, path: str, checkpoint: str, order: Sequence[str], within: Sequence[str] = (),
                        every: int = EVERY) -> StreamingQuery:
    """Start keeping the failures of a stream grouped by reason, with the first objects in `order` of arrival, whatever order
    the stream brings them in. Each trigger writes, for the reasons it met, how often and the first few objects: states that
    can be merged. Tasks send partial counts and no more than the first few rows of a reason, so one reason may hold most of
    a trigger."""
    epochs = _group_epochs(outcomes.sparkSession, path, within, every)

    def write(arrived: DataFrame, epoch: int) -> None:
        # Counted and searched for the first ones: two passes over what the trigger read once.
        failed = failures.failures(arrived).persist()
        try:
            epochs.write(failures.group_states(failed, order, within), epoch)
        finally:
            failed.unpersist()

    return (outcomes.writeStream.outputMode("update").foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def latest_failure_groups(spark: SparkSession, path: str, within: Sequence[str] = ()) -> DataFrame:
    """The report of `failures.failure_groups` as of the last trigger."""
    return failures.top_groups(_group_epochs(spark, path, within).read(), within)
