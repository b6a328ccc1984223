"""Users of Spark jobs, and what their steps cost."""

import re

from conftest import rows
from gaugeworks.operators.dedup import row_hash
from gaugeworks.operators.fill import fill_from_groups
from gaugeworks.operators.schema import project_properties
from gaugeworks.plans import gold, spark_silver
from gaugeworks.queries import marts_spark
from gaugeworks.session import materialize
from pyspark.sql import functions as F


def made_events(spark):
    events = spark.sql(
        "SELECT id AS event_id, id % 3 AS user_id, 'view' AS event_type, 1.5D AS value, '{\"k\": 1}' AS props,"
        " timestamp'2024-01-05 00:00:00' AS ts FROM range(10)"
    )
    return marts_spark.spark_events(type("T", (), {"events": materialize(events, "events")})())


def test_code_of_many_properties_can_be_compiled(spark, capsys):
    """The JVM compiles no method of more than 8000 bytes."""
    spec = spark_silver.job_properties("vendor")
    e = made_events(spark).filter(F.col("Event") == "SparkListenerJobStart")
    out = e.select(
        *spark_silver.CONTEXT, spark_silver.DAY, "JobID", "StageIDs", "SubmissionTime", "filenameGroup",
        project_properties(F.col("Properties"), spec).alias("p"),
    )
    capsys.readouterr()
    out.select("*", row_hash(out)).explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) <= 8000
    found = rows(out.select("JobID", "p.JobGroupID", "p.UserEmail", "p.ClusterDetails.Name", "p.ExecutionID"))
    assert found[2] == (1, "1_2_job-1-run-1-action-1", None, None, "1")


def test_group_fills_are_not_computed_again(spark):
    found = [(1, 1, 1, 1, "u"), (2, 1, 2, 1, None), (3, 2, 2, 1, None), (4, 3, 3, 1, None), (5, None, 4, 2, None)]
    df = materialize(spark.createDataFrame(found, "id int, a int, b int, c int, who string"), "groups")
    out = fill_from_groups(df, "who", [["a"], ["b"], ["c"]])
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Relation [") <= 6  # was 8, doubled by each grouping
    assert rows(out.select("id", "who"), "id") == [(1, "u"), (2, "u"), (3, "u"), (4, "u"), (5, None)]


def test_jobs_of_equal_keys_are_not_multiplied(spark):
    schema = "organization_id string, clusterId string, SparkContextID string, JobID bigint, at bigint, user string, g string"
    jobs = [("t", "c", "x", 1, 5, None, "g"), ("t", None, "x", 1, 5, None, "g"), ("t", "c", "x", 2, 9, "u", "g"), ("t", "c", "x", None, 1, None, None)]
    properties = F.map_from_arrays(F.array(F.lit("user"), F.lit("sparkjobGroupid")), F.array("user", "g"))
    df = spark.createDataFrame(jobs, schema).select(
        "*", project_properties(properties, spark_silver.job_properties("v")).alias("PowerProperties"),
        F.array("JobID").alias("StageIDs"), F.col("at").alias("startTimestamp"),
    ).select("*", "PowerProperties.JobGroupID", "PowerProperties.ExecutionID")
    out = gold.spark_job(df)
    found = rows(out.select("job_id", "cluster_id", "user_email", "unixTimeMS"))
    assert sorted(found, key=str) == sorted([(1, "c", "u", 5), (1, "c", "u", 5), (2, "c", "u", 9), (None, "c", "u", 1)], key=str)
    assert not [c for c in out.columns if c.startswith("__")]


def test_only_the_event_asked_for_is_made(spark):
    e = made_events(spark)
    assert e.count() == 105  # 5 events, or 10 of those that end; ids 0 and 5 come twice
    one = e.filter(F.col("Event") == "SparkListenerTaskEnd").select("JobID", "TaskInfo.FinishTime", "CompletionTime")
    assert "NumberofTasks" not in one._jdf.queryExecution().optimizedPlan().toString()
    at = 1_704_412_800_000 + 1501
    assert rows(one) == sorted((i, at, at) for i in [1, 2, 3, 4, 5, 5, 6, 7, 8])
