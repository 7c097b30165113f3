"""Properties of physical plans that matter at scale."""

import re
from pathlib import Path

import pytest

from tidegauge.plans import QUERIES, source_queries
from tidegauge.plans.fixtures import END, RUN, START, TARGETS, Tables
from tidegauge.operators import panels, rates
from tidegauge.sources import replay
from tidegauge.sources.tables import save_series
from tidegauge.streaming.batches import run_available

FOLDER = "/root/testdata/sf0.001"
#: Queries that write and read again; of these, one of each kind.
WRITING = ("stream_", "read_", "load_", "write_", "scan_", "replay", "quarantined", "idempotent",
           "partition_by", "rollup_backfill", "incremental", "error_log")
ONE_OF_EACH = {
    "stream_series_rate", "stream_metric_alerts", "stream_sessions", "read_metrics_jsonl",
    "load_archive", "replay_segments", "idempotent_load", "partition_by_target",
}
CHECKED = sorted(n for n in QUERIES if not n.startswith(WRITING) or n in ONE_OF_EACH)


def plan(frame):
    frame.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "10000")
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", CHECKED)
def test_no_cross_join_no_python_in_tasks(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                     "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert operator not in text


@pytest.fixture(scope="module")
def stored(spark):
    save_series(Tables(spark, FOLDER).series, "plan_series")
    yield spark.table("plan_series")
    spark.sql("DROP TABLE plan_series")


def test_rate_prunes_partitions_and_columns_of_a_stored_table(stored):
    text = plan(panels.qps_series(stored, RUN, TARGETS, START, END))
    scans = re.findall(r"FileScan parquet .*", text)
    assert scans and all("measurement" in s and "mysql.global_status" in s for s in scans)
    assert all("PushedFilters" in s and "EqualTo(run_id,run-base)" in s for s in scans)
    assert all("tags" not in s.split("ReadSchema")[1] for s in scans)


def final_plan(frame):
    """The plan that ran, with its reused parts."""
    frame.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "10000")
    execution = frame._jdf.queryExecution()
    execution.executedPlan().executeCollectPublic()
    return execution.executedPlan().finalPhysicalPlan().toString()


def test_rates_shuffle_the_rows_once(stored):
    frame = rates.multi_rate(
        stored, {"mysql.file_io": ["operations_total"]}, [RUN], START, END, dimensions={}
    )
    text = final_plan(frame)
    # Rows and slice tails come from one exchange; two more move the tails, a row per slice.
    assert text.count("ReusedExchange") == 1 and "RoundRobin" not in text
    assert text.count("FileScan") == 1
    assert len(re.findall(r"\+- Exchange hashpartitioning", text)) == 3


@pytest.mark.parametrize("name", ["benchmark_summary", "saturation", "multi_rate"])
def test_no_round_robin(spark, name):
    assert "RoundRobin" not in plan(QUERIES[name](spark, FOLDER))


def test_latest_snapshot_needs_no_window_or_join(stored):
    text = plan(panels.worst_p95(stored, RUN, TARGETS, START, END))
    assert "Window" not in text and "Join" not in text and "partial_max" in text


def test_top_k_per_poll_is_cut_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(QUERIES["norm_file_io"](spark, FOLDER))


def test_sources_use_no_local_checkpoint_and_name_no_temporary_folder():
    root = Path(__file__).resolve().parents[1] / "tidegauge"
    for path in root.rglob("*.py"):
        text = path.read_text()
        assert "localCheckpoint" not in text and "/tmp" not in text


def test_only_the_answers_of_sketches_are_broadcast(spark):
    """Spark takes the exploded samples for the smaller side; their number has no bound."""
    text = plan(QUERIES["sketch_quantiles"](spark, FOLDER))
    sent = text[text.index("BroadcastExchange"):]
    assert text.count("BroadcastExchange") == 1 and "kll_merge" in sent and "explode" not in sent
    assert "explode" in text[:text.index("BroadcastExchange")]


def test_routing_shuffles_verdicts_and_no_lines(spark, tmp_path):
    (tmp_path / "a").write_text('{"table":"MysqlMetrics","mapping":"m","row":{"ts":"2024-01-01T00:00:00Z"}}\n')
    text = plan(replay.route(spark, str(tmp_path)))
    assert "SortMergeJoin" not in text and "REBALANCE" not in text
    assert re.findall(r"Exchange hashpartitioning\((\w+)#", text) == ["file"]


@pytest.mark.parametrize("rows, files", [(0, None), (7, 3), (40, 6)])
def test_a_streams_files_grow_with_its_rows(spark, monkeypatch, tmp_path, rows, files):
    monkeypatch.setattr(source_queries, "_STREAMED_ROWS", 10)
    tables = Tables(spark, FOLDER)
    stream = source_queries._fed(tables, spark.range(rows), str(tmp_path / "in"), 3)
    seen = []
    run_available(stream.writeStream.foreachBatch(lambda batch, _: seen.append(batch.count())), str(tmp_path / "log"))
    assert sum(seen) == rows
    if files:
        assert len(seen) == 3 and len(list((tmp_path / "in").glob("part-*"))) == files
