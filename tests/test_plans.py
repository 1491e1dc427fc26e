"""Plan shapes that must hold at scale, and behaviour under skew."""

import pytest
from pyspark.sql import functions as F

from metaspark.functions.paths import file_format
from metaspark.operators import log_replay as lr
from metaspark.operators.latest import latest_per_key
from metaspark.operators.profile import number_stats
from metaspark.operators.runs import job_runs
from metaspark.sources import txlog

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def read(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def test_profile_reads_only_its_columns_and_combines_first(spark):
    plan = plan_of(number_stats(read(spark, "lineitem"), ["l_tax"]))
    assert "ReadSchema: struct<l_tax:double>" in plan
    assert "partial_min" in plan and "Expand" not in plan


def test_filters_reach_the_scan(spark):
    from metaspark.operators.inventory import exclude_names, keep_names

    suppliers = read(spark, "supplier").select("s_name")
    assert "PushedFilters: [Not(In(s_name" in plan_of(exclude_names(suppliers, ["a", "b"], "s_name"))
    assert "PushedFilters: [In(s_name" in plan_of(keep_names(suppliers, ["a", "b"], "s_name"))


def test_log_replay_is_a_hash_aggregate_with_partial_step(spark):
    lines = spark.createDataFrame([("t", 0, "{}")], "root string, version long, value string")
    plan = plan_of(lr.log_totals(lr.live_files(txlog.parse_actions(lines))))
    assert "SortAggregate" not in plan and "Window" not in plan and "partial_max_by" in plan


def test_latest_has_no_window(spark):
    plan = plan_of(latest_per_key(read(spark, "events"), ["user_id"], [F.col("event_id")]))
    assert "Window" not in plan and "partial_max" in plan


def test_first_extension_stays_in_the_jvm(spark):
    assert "Python" not in plan_of(read(spark, "pages").select(file_format(F.col("url"))))


@pytest.fixture
def small_skew_limits(spark):
    limits = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in limits}
    for k, v in limits.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_job_with_a_third_of_all_runs_is_split(spark, small_skew_limits):
    """Without any broadcast the hot partition is read by several tasks; nothing is lost."""
    jobs = spark.range(50).selectExpr("concat('j', id) job_name", "concat('rn/', id) job_rn", "'o' owner_rn")
    runs = spark.range(30000).repartition(8).selectExpr(
        "case when id % 3 = 0 then 'j7' else concat('j', id % 50) end job_name", "concat('r', id) run_id", "'FAILED' state",
        "timestamp'2020-01-01' started_at", "cast(null as timestamp) completed_at", "repeat('x', id % 50 + 1) message")
    joined = job_runs(jobs, runs)
    got = joined.groupBy("job_rn").agg(F.count("*").alias("n"), F.count_distinct("run_id").alias("d")).collect()
    assert sum(r.n for r in got) == 30000 and all(r.n == r.d for r in got)
    assert max(r.n for r in got) > 10000
    joined.collect()
    assert "skew=true" in plan_of(joined)


def test_documents_of_all_tables_are_parsed_by_many_tasks(spark):
    from bindings import consumers, jobs

    made = [
        jobs._job_docs, jobs._replication_tasks, consumers._dataset_docs, consumers._source_docs, consumers._dashboard_docs,
        consumers._analysis_docs, consumers._experiment_docs, jobs._endpoints,
    ]
    for docs in made:
        assert "RepartitionByExpression" in docs(spark, "/root/testdata/sf0.001")._jdf.queryExecution().logical().toString(), docs


def test_joined_tasks_are_made_once(spark):
    from bindings import details

    plan = details.task_lineage(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "ServerName" not in plan and "supplier" not in plan


def test_distinct_counts_copy_no_rows(spark):
    from bindings import stats

    assert "Expand" not in stats.merged_profiles(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
