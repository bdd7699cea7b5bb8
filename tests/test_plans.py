"""Plan-shape checks: the physical plans keep the properties the scale
design relies on (no whole-key window, bounded broadcasts, pushed filters,
pruned columns, one shuffle for the gold summaries, no cartesian joins)."""

import pytest
from pyspark.sql import functions as F

from noticeflow.operators import explore, gold
from noticeflow.operators.scoring import score_recalls
from noticeflow.operators.silver import silver_projection
from noticeflow.session import scratch_path
from noticeflow.sources.fixture import recall_records
from noticeflow.sources.serving import dedupe_latest
from noticeflow.sources.tables import read_table, write_table

from .conftest import SF_SMALL


def plan(df, mode: str = "formatted") -> str:
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


@pytest.fixture(scope="module")
def scored_table(spark):
    path = scratch_path(spark, "plan-scored")
    write_table(score_recalls(silver_projection(recall_records(spark, SF_SMALL))), path)
    return path


def test_scoring_broadcasts_checked_counts_without_shuffling_rows(spark):
    p = plan(score_recalls(silver_projection(recall_records(spark, SF_SMALL))), "simple")
    assert "Window" not in p and "SortMergeJoin" not in p
    assert "BroadcastHashJoin" in p


def test_salted_scoring_has_no_window_and_a_bounded_broadcast(spark):
    p = plan(score_recalls(silver_projection(recall_records(spark, SF_SMALL)), method="salted"))
    assert "Window" not in p
    assert "TakeOrderedAndProject" in p and "1024" in p
    assert "BroadcastExchange" in p


def test_filters_push_down_and_columns_prune(spark, scored_table):
    df = explore.kpis(explore.filter_report_date(read_table(spark, scored_table), "1996-01-01", "1997-12-31"))
    p = plan(df)
    assert "GreaterThanOrEqual(report_date" in p and "LessThanOrEqual(report_date" in p
    read_schema = [line for line in p.splitlines() if "ReadSchema" in line][0]
    assert "risk_explanation" not in read_schema and "recalling_firm" not in read_schema


def test_gold_summaries_are_one_shuffle(spark, scored_table):
    p = plan(gold.summary_sets(read_table(spark, scored_table)), "simple")
    assert p.count("Exchange hashpartitioning") == 1
    assert "Expand" in p
    assert p.count("FileScan parquet") == 1


def test_histogram_bound_is_a_subquery_not_a_join(spark, scored_table):
    p = plan(explore.risk_histogram(read_table(spark, scored_table)))
    assert "CartesianProduct" not in p and "NestedLoopJoin" not in p
    assert "Subquery" in p


def test_dedupe_is_a_partial_aggregate(spark, scored_table):
    p = plan(dedupe_latest(read_table(spark, scored_table), ["recall_number"]))
    assert "Window" not in p
    assert "partial_max" in p


def test_top_k_is_take_ordered(spark, scored_table):
    p = plan(explore.company_top20(read_table(spark, scored_table)))
    assert "TakeOrderedAndProject" in p
    assert F is not None


def test_previous_versions_are_found_without_shuffling_table_keys(spark, scored_table):
    from noticeflow.operators.partitioning import checked_broadcast
    from noticeflow.sources.serving import partition_value, touched_partitions

    target = read_table(spark, scored_table).withColumn("report_month", partition_value("recalls"))
    batch = target.filter(F.col("report_date") >= "2000-01-01").limit(50).persist()
    keys = checked_broadcast(batch.select("recall_number"))
    p = plan(touched_partitions(target, batch, keys, ["recall_number"], "report_month"), "simple")
    assert "BroadcastHashJoin" in p and "LeftSemi" in p
    assert "Exchange hashpartitioning(recall_number" not in p
    batch.unpersist()


def test_served_sources_read_the_scored_rows_once_written(spark):
    from noticeflow.plans.catalog import _serving_sources

    for df in _serving_sources(spark, SF_SMALL).values():
        assert "Join" not in plan(df, "simple")
