"""Failure groups on a stream, compaction of epochs, restarts and repeated triggers."""

import pytest
from pyspark.sql import functions as F

from ddlscope import folders
from ddlscope.operators import failures
from ddlscope.operators.progress import run_counts
from ddlscope.streaming import outcomes
from ddlscope.streaming.epochs import Epochs
from tests.conftest import SMALL
from workload.registry import Tables

ORDER = ["ts", "attempt_id"]


@pytest.fixture
def arriving(spark, folder):
    attempts = Tables(spark, SMALL)("fx_attempts").withColumn("ts", F.col("ts").cast("timestamp"))
    parts = attempts.withColumn("part", F.pmod(F.xxhash64("attempt_id"), F.lit(7)))

    def arrive(*numbers):
        for number in numbers:
            parts.where(F.col("part") == number).drop("part").coalesce(1).write.mode("append").parquet(f"{folder}/in")

    def stream():
        return spark.readStream.schema(attempts.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")

    return attempts, arrive, stream


def same(found, wanted):
    return found.exceptAll(wanted).count() == 0 and wanted.exceptAll(found).count() == 0


@pytest.mark.parametrize("within", [[], ["run_id"]])
def test_groups_over_triggers_and_a_restart_equal_the_batch(spark, folder, arriving, within):
    attempts, arrive, stream = arriving

    def keep():
        outcomes.keep_failure_groups(stream(), f"{folder}/out", f"{folder}/state", ORDER, within, every=3).awaitTermination()

    arrive(0, 1)
    keep()
    arrive(2, 3, 4)
    keep()
    half = attempts.where(F.pmod(F.xxhash64("attempt_id"), F.lit(7)) < 5)
    assert same(outcomes.latest_failure_groups(spark, f"{folder}/out", within), failures.failure_groups(failures.failures(half), ORDER, within))
    arrive(5, 6)
    keep()
    assert same(outcomes.latest_failure_groups(spark, f"{folder}/out", within), failures.failure_groups(failures.failures(attempts), ORDER, within))
    # Six of seven epochs are compacted; those of the first table are gone.
    assert folders.finished(spark, f"{folder}/out/_compacted", "through") == [2, 5]
    assert folders.finished(spark, f"{folder}/out", "epoch") == [3, 4, 5, 6]


def test_readers_of_run_counts_take_few_epochs(spark, folder, arriving):
    attempts, arrive, stream = arriving
    arrive(*range(7))
    outcomes.keep_run_counts(stream(), f"{folder}/out", f"{folder}/state", every=2).awaitTermination()
    found = outcomes.latest_run_counts(spark, f"{folder}/out")
    assert same(found, run_counts(attempts))
    read = {f.split("/out/")[1].rsplit("/", 1)[0] for f in found.inputFiles()}
    assert read == {"_compacted/through=5", "epoch=6"}


def summed(spark, path, every):
    return Epochs(spark, path, lambda rows: rows.groupBy("k").agg(F.sum("n").alias("n")), every)


def test_a_repeated_trigger_and_an_unfinished_write_change_nothing(spark, folder):
    epochs = summed(spark, folder, 2)
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n long")
    for epoch in range(3):
        epochs.write(rows, epoch)
    wanted = [("a", 3), ("b", 6)]
    assert sorted(tuple(r) for r in epochs.read().collect()) == wanted
    epochs.write(rows, 2)  # again, before it is compacted
    epochs.write(rows, 1)  # again, after it was
    assert sorted(tuple(r) for r in epochs.read().collect()) == wanted
    rows.write.parquet(f"{folder}/epoch=9")
    made, root, files = folders._open(spark, f"{folder}/epoch=9/_SUCCESS")
    files.delete(root, False)  # as if the write had been cut short
    assert sorted(tuple(r) for r in epochs.read().collect()) == wanted
    assert epochs.parts() == (1, [2])


def test_nothing_written_yet(spark, folder):
    with pytest.raises(FileNotFoundError):
        summed(spark, f"{folder}/none", 2).read()


def test_states_merge_in_any_grouping(spark):
    failed = failures.failures(Tables(spark, SMALL)("fx_attempts")).withColumn("part", F.pmod(F.xxhash64("attempt_id"), F.lit(3)))
    states = [failures.group_states(failed.where(F.col("part") == k), ORDER) for k in range(3)]
    left = failures.merged_groups(failures.merged_groups(states[0].union(states[1])).union(states[2]))
    right = failures.merged_groups(states[0].union(failures.merged_groups(states[1].union(states[2]))))
    assert same(left, failures.group_states(failed, ORDER)) and same(left, right)
