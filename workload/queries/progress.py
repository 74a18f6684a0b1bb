"""Progress of runs, in batch and as a stream."""

from pyspark.sql import functions as F

from ddlscope.operators import progress, ranked
from ddlscope.session import scratch_path
from ddlscope.streaming import outcomes
from workload.fixtures import fixture, given
from workload.registry import query
from workload.queries.errors import GROUPS
from workload.sql import FAILED, OUTCOME

_COUNTS = f"""
marked AS (SELECT *, {OUTCOME} AS outcome FROM fx_attempts),
counts AS (SELECT run_id, count(*) AS done, count(*) FILTER (outcome = 'generated') AS generated,
    count(*) FILTER (outcome = 'failed') AS failed, count(*) FILTER (outcome = 'excluded') AS excluded,
    count(*) FILTER (outcome = 'cancelled') AS cancelled, epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us
  FROM marked GROUP BY run_id)"""


def _times_as_numbers(counts):
    def micros(column):
        return F.unix_micros(F.col(column).cast("timestamp"))
    return (counts.withColumn("first_us", micros("first_ts")).withColumn("last_us", micros("last_ts"))
            .drop("first_ts", "last_ts"))


@query(f"""WITH {_COUNTS}, timed AS (SELECT c.run_id, done, total, (last_us - first_us) / 1e6 AS elapsed
             FROM counts c LEFT JOIN fx_work w ON w.run_id = c.run_id)
           SELECT *, elapsed / done * (total - done) AS eta, elapsed / done * (total - done) > 90 AS eta_shown FROM timed""")
def a16_run_progress(t):
    return progress.run_progress(t("fx_attempts"), t("fx_work"))


@query("""WITH timed AS (SELECT run_id, attempt_id, row_number() OVER (PARTITION BY run_id ORDER BY ts, attempt_id) AS done,
              total, (epoch_us(ts) - epoch_us(min(ts) OVER (PARTITION BY run_id))) / 1e6 AS elapsed
            FROM fx_attempts LEFT JOIN fx_work USING (run_id))
          SELECT *, elapsed / done * (total - done) AS eta, elapsed / done * (total - done) > 90 AS eta_shown FROM timed""")
def a16_progress_log(t):
    return progress.progress_log(t("fx_attempts"), t("fx_work"))


@query(f"SELECT run_id, {OUTCOME} AS outcome, count(*) AS objects FROM fx_attempts GROUP BY ALL")
def a17_run_tally(t):
    return progress.tally(t("fx_attempts"))


@query(f"WITH {_COUNTS} SELECT * FROM counts")
def a17_run_counts(t):
    return _times_as_numbers(progress.run_counts(t("fx_attempts")))


@query("""SELECT run_id, attempt_id, row_number() OVER (PARTITION BY run_id ORDER BY ts, attempt_id) AS done
          FROM fx_attempts""")
def w3_running_count(t):
    return progress.running_count(t("fx_attempts")).drop("ts")


@query("""SELECT run_id, attempt_id, ts, row_number() OVER (PARTITION BY run_id ORDER BY ts, attempt_id) AS done
          FROM (SELECT run_id, attempt_id, epoch_us(ts) AS ts FROM fx_attempts)""")
def w3_stored_running_count(t):
    arrived = t("fx_attempts").select("run_id", "attempt_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts"))
    return ranked.store(arrived, scratch_path(t.spark, "ranked"), [F.col("ts"), F.col("attempt_id")], ["run_id"]).positions("done")


@query(f"WITH {_COUNTS} SELECT * FROM counts")
def st1_run_counts_stream(t):
    schema = given(t.spark, t.folder, "events").schema
    events = t.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(t.folder)
    attempts = fixture(t.spark, t.folder, "fx_attempts", events=events)
    path = scratch_path(t.spark, "runs")
    outcomes.keep_run_counts(attempts, f"{path}/counts", f"{path}/state").awaitTermination()
    return _times_as_numbers(outcomes.latest_run_counts(t.spark, f"{path}/counts"))


def _arriving(t, files, per_trigger):
    """The attempts as a stream over the events, dealt to so many files of which each trigger takes a few."""
    path = scratch_path(t.spark, "events")
    events = given(t.spark, t.folder, "events")
    events.repartition(files).write.parquet(path)
    stream = t.spark.readStream.schema(events.schema).option("maxFilesPerTrigger", per_trigger).parquet(path)
    return fixture(t.spark, t.folder, "fx_attempts", events=stream)


# Three triggers; the first two are compacted into one table.
@query(f"WITH {FAILED}, {GROUPS.format(within='', partition='')}")
def st1_failure_groups_stream(t):
    path = scratch_path(t.spark, "groups")
    outcomes.keep_failure_groups(_arriving(t, 6, 2), f"{path}/groups", f"{path}/state", ["ts", "attempt_id"], every=2).awaitTermination()
    return outcomes.latest_failure_groups(t.spark, f"{path}/groups")


@query(f"WITH {FAILED}, {GROUPS.format(within='run_id,', partition='PARTITION BY run_id')}")
def st1_failure_groups_by_run_stream(t):
    path, run = scratch_path(t.spark, "groups"), ["run_id"]
    outcomes.keep_failure_groups(_arriving(t, 6, 2), f"{path}/groups", f"{path}/state", ["ts", "attempt_id"], run, every=2).awaitTermination()
    return outcomes.latest_failure_groups(t.spark, f"{path}/groups", run)
