"""The stream gives what the batch gives, over several triggers and a restart."""

from pyspark.sql import functions as F

from ddlscope.operators.progress import run_counts
from ddlscope.streaming import outcomes
from tests.conftest import SMALL
from workload.registry import Tables


def test_stream_equals_batch_over_triggers_and_a_restart(spark, folder):
    attempts = Tables(spark, SMALL)("fx_attempts").withColumn("ts", F.col("ts").cast("timestamp"))
    parts = attempts.withColumn("part", F.pmod(F.xxhash64("attempt_id"), F.lit(4)))
    schema = attempts.schema

    def arrive(*numbers):
        for number in numbers:
            parts.where(F.col("part") == number).drop("part").coalesce(1).write.mode("append").parquet(f"{folder}/in")

    def keep():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
        outcomes.keep_run_counts(stream, f"{folder}/out", f"{folder}/state").awaitTermination()

    arrive(0, 1)
    keep()
    arrive(2, 3)
    keep()
    found = outcomes.latest_run_counts(spark, f"{folder}/out")
    wanted = run_counts(attempts)
    assert found.columns == wanted.columns
    assert found.exceptAll(wanted).count() == 0 and wanted.exceptAll(found).count() == 0
    assert spark.read.parquet(f"{folder}/out").select("epoch").distinct().count() >= 4
