"""Every registered query against its SQL check, and the shape of the important plans."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from check import compare, connect
from digestry.plans.catalog import all_queries
from digestry.plans.oracle_run import CHECKS

SF = "/root/testdata/sf0.001"
NAMES = sorted(all_queries())


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


def test_every_query_has_a_check():
    assert set(CHECKS) == set(NAMES)
    assert set(CHECKS) <= set(entry.oracle_sql()) <= set(entry.queries())


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["prefilter_topk", "candidate_dedupe", "final_rank", "archive_counts"])
def test_top_rows_are_pruned_before_the_shuffle(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF))
    assert plan.count("WindowGroupLimit") >= 2


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, connection, name):
    """Same rows as the SQL check, without any cross join."""
    frame = entry.queries()[name](spark, SF)
    plan = plan_of(frame)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert compare(spark, SF, name, connection, show=False, frame=frame) is None


def test_texts_are_gone_before_the_first_shuffle_of_candidates(spark):
    """Only ids, scores and labels travel: no exchange after the annotation carries the text."""
    plan = entry.queries()["prefilter_topk"](spark, SF)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    for block in plan.split("\n\n"):
        if ") Exchange" in block and "REPARTITION_BY_NUM" not in block:
            assert "excerpt#" not in block and "_text#" not in block and "html#" not in block


def test_scans_read_only_needed_columns(spark):
    plan = plan_of(entry.queries()["source_status"](spark, SF))
    assert "ReadSchema: struct<doc_id:bigint,source:string>" in plan


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    """The same tables, each as a folder of three files."""
    root = tmp_path_factory.mktemp("folders")
    for table in ("documents", "labels"):
        spark.read.parquet(f"{SF}/{table}.parquet").repartition(3).write.parquet(f"{root}/{table}.parquet")
    return str(root)


@pytest.mark.parametrize("name", ["stream_antijoin", "stream_dedupe"])
def test_streams_over_folders_equal_their_sql(spark, connection, folders, name):
    assert compare(spark, SF, name, connection, show=False, frame=entry.queries()[name](spark, folders)) is None


def test_a_run_makes_document_ids_from_texts_once(spark):
    from digestry.plans import q_run, roles

    ids = q_run.staged_ids(spark, SF)
    assert "text:string" in plan_of(roles.document_ids(spark, SF))
    for frame in (roles.history(spark, SF, ids), roles.relations(spark, SF, ids), q_run.previous_state(spark, SF, ids).recommended):
        assert "text:string" not in plan_of(frame)


def test_a_refused_first_run_shows_its_verdicts_only(spark, tmp_path):
    """Every document asks for an unknown label, so no batch of papers is sound and the gate refuses all three runs."""
    for table in ("documents", "labels", "pages", "events"):
        rows = spark.read.parquet(f"{SF}/{table}.parquet")
        (rows.withColumn("doc_id", F.col("doc_id") * 97 + 96) if "doc_id" in rows.columns else rows).write.parquet(f"{tmp_path}/{table}.parquet")
    rows = {(r["part"], r["id"]): r["value"] for r in entry.queries()["publish_run"](spark, str(tmp_path)).collect()}
    assert sorted(rows) == [("verdict", "1"), ("verdict", "2"), ("verdict", "3")]
    assert rows["verdict", "1"] == "gate failed: metadata_rate"
    assert rows["verdict", "2"] == "gate failed: manifests, metadata_rate"
    assert {"metadata_rate", "reading_results"} <= set(rows["verdict", "3"].removeprefix("gate failed: ").split(", "))
