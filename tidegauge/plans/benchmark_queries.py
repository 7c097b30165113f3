"""Comparison of two runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegauge.functions.scalars import relative_difference
from tidegauge.operators import benchmark as b
from tidegauge.plans.fixtures import BASELINE, CANDIDATE, END, START
from tidegauge.plans.registry import RANGE, half_up, query, r, rate_tables

RUNS = [BASELINE.run_id, CANDIDATE.run_id]
PAIR = (
    f"((run_id = '{BASELINE.run_id}' AND target_id = '{BASELINE.target_id}') OR "
    f"(run_id = '{CANDIDATE.run_id}' AND target_id = '{CANDIDATE.target_id}'))"
)
_K = "ts, run_id, target_id, host, tier"
_HIGHER = ", ".join(f"'{m}'" for m in b.HIGHER_IS_BETTER)
_KNOWN = ", ".join(f"'{m}'" for m in b.HIGHER_IS_BETTER + b.LOWER_IS_BETTER)

#: Every metric computed on its own from the rates, the long way round.
TABLES = {
    **rate_tables("true"),
    "file_rates": "SELECT * FROM rates WHERE measurement = 'mysql.file_io' "
                  "AND tag_mode IN ('read', 'write')",
    "qps": f"SELECT {_K}, 'QPS' AS metric, rate AS value FROM rates "
           "WHERE measurement = 'mysql.global_status' AND field = 'Queries'",
    "iops": f"SELECT {_K}, CASE tag_mode WHEN 'read' THEN 'Read IOPS' ELSE 'Write IOPS' END "
            "AS metric, sum(rate) AS value FROM file_rates WHERE field = 'operations_total' "
            f"GROUP BY {_K}, tag_mode",
    "throughput": f"SELECT {_K}, CASE tag_mode WHEN 'read' THEN 'Read throughput MiB/s' "
                  "ELSE 'Write throughput MiB/s' END AS metric, sum(rate) / 1024 / 1024 AS value "
                  f"FROM file_rates WHERE field = 'bytes_total' GROUP BY {_K}, tag_mode",
    "latency": f"""
        SELECT {_K}, CASE tag_mode WHEN 'read' THEN 'Read latency ms'
                     ELSE 'Write latency ms' END AS metric, sum(wait) / sum(ops) AS value
        FROM (SELECT o.ts AS ts, o.run_id AS run_id, o.target_id AS target_id, o.host AS host,
                     o.tier AS tier, o.tag_mode AS tag_mode, o.rate AS ops, w.rate AS wait
              FROM file_rates o JOIN file_rates w USING (ts, run_id, target_id, series_key)
              WHERE o.field = 'operations_total' AND w.field = 'wait_ms_total')
        GROUP BY {_K}, tag_mode HAVING sum(ops) > 0
    """,
    "query_tail": f"""
        SELECT {_K}, CASE field WHEN 'latency_p95_ms' THEN 'Query p95 ms'
                     ELSE 'Query p99 ms' END AS metric, max(value) AS value
        FROM series WHERE {RANGE} AND measurement = 'mysql.statement_digest'
          AND field IN ('latency_p95_ms', 'latency_p99_ms') AND tag_schema NOT IN ('', '(none)')
        GROUP BY {_K}, field
    """,
    "query_errors": f"SELECT {_K}, 'Query errors/s' AS metric, sum(rate) AS value FROM rates "
                    "WHERE measurement = 'mysql.statement_digest' AND field = 'errors_total' "
                    f"AND tag_schema NOT IN ('', '(none)') GROUP BY {_K}",
    "redo": f"SELECT {_K}, 'Redo log waits/s' AS metric, rate AS value FROM rates "
            "WHERE measurement = 'mysql.global_status' AND field = 'Innodb_log_waits'",
    "samples": " UNION ALL ".join(
        f"SELECT * FROM {t}"
        for t in ("qps", "iops", "throughput", "latency", "query_tail", "query_errors", "redo")
    ),
    "summary": f"""
        SELECT metric, run_id, target_id, host, tier, {half_up('avg(value)', 3)} AS avg,
               {half_up('quantile_cont(value, 0.95)', 3)} AS p95,
               {half_up('max(value)', 3)} AS max, count(*) AS samples
        FROM samples GROUP BY metric, run_id, target_id, host, tier
    """,
    "inventory": f"""
        SELECT run_id, target_id, host, tier, min(ts) AS start, max(ts) AS "end",
               count(*) AS points, count(DISTINCT measurement) AS measurements,
               epoch_us(max(ts)) // 1000000 - epoch_us(min(ts)) // 1000000 AS duration_seconds
        FROM points WHERE {RANGE} AND {PAIR} GROUP BY run_id, target_id, host, tier
    """,
    "sides": f"""
        SELECT metric,
               max(CASE WHEN run_id = '{BASELINE.run_id}' THEN p95 END) AS baseline,
               max(CASE WHEN run_id = '{CANDIDATE.run_id}' THEN p95 END) AS candidate,
               max(CASE WHEN run_id = '{BASELINE.run_id}' THEN samples END) AS n1,
               max(CASE WHEN run_id = '{CANDIDATE.run_id}' THEN samples END) AS n2
        FROM summary WHERE {PAIR} GROUP BY metric
        HAVING n1 IS NOT NULL AND n2 IS NOT NULL
    """,
    "verdicts": f"""
        SELECT *, CASE WHEN metric NOT IN ({_KNOWN}) THEN 'INCONCLUSIVE'
                       WHEN score >= 5 THEN 'IMPROVEMENT' WHEN score <= -5 THEN 'REGRESSION'
                       ELSE 'NO MATERIAL CHANGE' END AS verdict
        FROM (SELECT *, CASE WHEN metric IN ({_HIGHER}) THEN percent_change
                             ELSE -percent_change END AS score
              FROM (SELECT *, CASE WHEN baseline <> 0
                                   THEN 100e0 * (candidate - baseline) / baseline
                                   WHEN candidate = 0 OR metric NOT IN ({_KNOWN}) THEN 0e0
                                   ELSE 'inf'::DOUBLE END AS percent_change,
                           100e0 * abs(n1 - n2) / greatest(n1, n2) AS sample_difference_pct
                    FROM sides))
    """,
    "gates": f"""
        SELECT list_filter([
            CASE WHEN (SELECT count(*) FROM inventory) <> 2
                 THEN 'Both selected Run/Target pairs were not found.' END,
            (SELECT CASE WHEN 100e0 * (max(duration_seconds) - min(duration_seconds))
                              / max(duration_seconds) > 10
                    THEN printf('Run durations differ by %.1f%% (limit 10.0%%).',
                         100e0 * (max(duration_seconds) - min(duration_seconds))
                         / max(duration_seconds)) END FROM inventory),
            (SELECT 'Sample counts differ beyond the configured limit for: '
                    || string_agg(metric, ', ' ORDER BY metric) || '.'
             FROM verdicts WHERE sample_difference_pct > 20),
            CASE WHEN (SELECT count(*) FROM verdicts) = 0
                 THEN 'No comparable benchmark summary metrics were found.' END,
            (SELECT 'Required comparison metrics are missing: '
                    || string_agg(m, ', ' ORDER BY m) || '.'
             FROM (VALUES ('QPS'), ('Query p95 ms'), ('Query p99 ms')) v(m)
             WHERE m NOT IN (SELECT metric FROM verdicts)),
            (SELECT 'Required metrics have non-positive values: '
                    || string_agg(metric, ', ' ORDER BY metric) || '.'
             FROM verdicts WHERE metric IN ('QPS', 'Query p95 ms', 'Query p99 ms')
               AND (baseline <= 0 OR candidate <= 0)),
            CASE WHEN (SELECT count(*) FROM verdicts
                       WHERE metric IN ('Read IOPS', 'Write IOPS')) = 0
                 THEN 'No comparable file IOPS metric was found.' END,
            CASE WHEN (SELECT count(*) FROM verdicts
                       WHERE metric IN ('Read latency ms', 'Write latency ms')) = 0
                 THEN 'No comparable file latency metric was found.' END
        ], lambda x: x IS NOT NULL) AS issues,
        (SELECT coalesce(list(metric ORDER BY metric), []) FROM verdicts
         WHERE verdict = 'REGRESSION') AS regressions
    """,
}

_SAMPLE = f"SELECT {_K}, metric, {r('value', 'value')} FROM "
_SUMMARY = (
    f"SELECT metric, run_id, target_id, host, tier, {r('avg', 'avg')}, {r('p95', 'p95')}, "
    f"{r('max', 'max')}, samples FROM summary"
)


@query(
    "tier_comparison",
    f"""
    SELECT run_id, tier, metric, {r('avg(value)', 'avg')}, {r('max(value)', 'max')},
           {r('quantile_cont(value, 0.95)', 'p95')}, count(*) AS samples
    FROM metrics WHERE metric = 'collector_cycle_duration_ms' GROUP BY ALL
    """,
)
def _tier_comparison(t):
    return b.tier_comparison(t.metrics, "collector_cycle_duration_ms", *RUNS)


for _name, _group, _table in (
    ("bench_qps", "qps", "qps"),
    ("bench_file_iops", "iops", "iops"),
    ("bench_throughput", "throughput", "throughput"),
    ("bench_latency", "latency", "latency"),
    ("bench_query_tail", "query_tail", "query_tail"),
    ("bench_query_errors", "query_errors", "query_errors"),
    ("bench_redo_waits", "redo_waits", "redo"),
):

    @query(_name, _SAMPLE + _table, TABLES)
    def _samples(t, group=_group):
        return b.benchmark_samples(t.series, RUNS, START, END, [group])


@query("benchmark_summary", _SUMMARY, TABLES)
def _benchmark_summary(t):
    return b.benchmark_summary(t.series, *RUNS, START, END)


@query("headline", f"{_SUMMARY} WHERE {PAIR}", TABLES)
def _headline(t):
    return b.headline(t.series, BASELINE, CANDIDATE, START, END)


def _pair_summary(t):
    return b.benchmark_summary(t.series, *RUNS, START, END, (BASELINE, CANDIDATE))


@query(
    "delta_panel",
    f"""
    SELECT metric, {r('baseline', 'baseline')}, {r('candidate', 'candidate')},
           {r('percent_change', 'percent_change')}, better_direction,
           {r('directional_score', 'directional_score')},
           CASE WHEN directional_score >= 5.0 THEN 'IMPROVEMENT'
                WHEN directional_score <= -5.0 THEN 'REGRESSION'
                ELSE 'NO MATERIAL CHANGE' END AS interpretation
    FROM (SELECT *, CASE better_direction WHEN 'Higher' THEN percent_change
                         ELSE -percent_change END AS directional_score
          FROM (SELECT metric, baseline, candidate,
                       {half_up('100e0 * (candidate - baseline) / baseline', 1)} AS percent_change,
                       CASE WHEN metric IN ({_HIGHER}) THEN 'Higher' ELSE 'Lower' END
                           AS better_direction
                FROM sides WHERE baseline > 0))
    """,
    TABLES,
)
def _delta_panel(t):
    return b.delta_panel(_pair_summary(t), BASELINE, CANDIDATE)


@query(
    "iops_elapsed",
    f"""
    SELECT epoch_us(ts) // 1000000 - min(epoch_us(ts) // 1000000) OVER (PARTITION BY run_id, target_id)
               AS elapsed_seconds,
           concat(run_id, ' / ', target_id) AS series, {r('value', 'iops')}
    FROM iops WHERE metric = 'Read IOPS' AND {PAIR}
    """,
    TABLES,
)
def _iops_elapsed(t):
    return b.iops_elapsed(t.series, BASELINE, CANDIDATE, START, END)


@query(
    "latency_elapsed",
    f"""
    SELECT epoch_us(ts) // 1000000 - min(epoch_us(ts) // 1000000) OVER (PARTITION BY run_id, target_id)
               AS elapsed_seconds,
           concat(run_id, ' / ', target_id, ' / ',
                  CASE metric WHEN 'Read latency ms' THEN 'read' ELSE 'write' END) AS series,
           {r('value', 'latency_ms')}
    FROM latency WHERE {PAIR}
    """,
    TABLES,
)
def _latency_elapsed(t):
    return b.latency_elapsed(t.series, BASELINE, CANDIDATE, START, END)


@query(
    "run_inventory",
    f"""
    SELECT run_id, target_id, tier, host, min(ts) AS started, max(ts) AS ended,
           count(*) AS points, count(DISTINCT measurement) AS measurements,
           round((epoch_us(max(ts)) // 1000000 - epoch_us(min(ts)) // 1000000) / 60e0, 1)
               AS duration_minutes
    FROM points WHERE {PAIR} GROUP BY run_id, target_id, tier, host
    """,
)
def _run_inventory(t):
    return b.run_inventory(t.points, BASELINE, CANDIDATE)


@query("report_inventory", "SELECT * FROM inventory", TABLES)
def _report_inventory(t):
    return b.report_inventory(t.points, BASELINE, CANDIDATE, START, END)


_VERDICTS = (
    f"SELECT metric, {r('baseline', 'baseline')}, {r('candidate', 'candidate')}, "
    f"{r('percent_change', 'percent_change')}, verdict"
)


@query(
    "compare_metrics", f"{_VERDICTS} FROM verdicts",
    {
        **TABLES,
        "sides": """
            SELECT metric, baseline, candidate, 1 AS n1, 1 AS n2 FROM (
                SELECT concat(CASE event_type WHEN 'view' THEN 'Read latency ms'
                                   WHEN 'click' THEN 'Write IOPS' WHEN 'error'
                                   THEN 'Query errors/s' ELSE 'unlisted' END) AS metric,
                       CAST(k % 10 AS DOUBLE) AS baseline, CAST(k // 10 AS DOUBLE) AS candidate
                FROM ev)
        """,
    },
)
def _compare_metrics(t):
    names = {"view": "Read latency ms", "click": "Write IOPS", "error": "Query errors/s"}
    metric = F.lit("unlisted")
    for kind, name in names.items():
        metric = F.when(F.col("event_type") == kind, name).otherwise(metric)
    pairs = t.events.select(
        metric.alias("metric"), (F.col("k") % 10).cast("double").alias("baseline"),
        F.floor(F.col("k") / 10).cast("double").alias("candidate"),
    )
    return b.compare(pairs)


@query(
    "relative_difference",
    f"""
    SELECT event_id, {r('''CASE WHEN greatest(abs(value), k) = 0 THEN 0e0
        ELSE 100e0 * abs(value - k) / greatest(abs(value), k) END''', 'difference')}
    FROM ev
    """,
)
def _relative_difference(t):
    return t.events.select(
        "event_id",
        relative_difference(F.col("value"), F.col("k").cast("double")).alias("difference"),
    )


def _comparisons(t):
    return b.build_comparisons(_pair_summary(t), BASELINE, CANDIDATE)


def _gates(t):
    inventory = b.report_inventory(t.points, BASELINE, CANDIDATE, START, END)
    return b.quality_gates(inventory, _comparisons(t), BASELINE, CANDIDATE)


@query(
    "build_comparisons",
    f"{_VERDICTS}, {r('sample_difference_pct', 'sample_difference_pct')} FROM verdicts",
    TABLES,
)
def _build_comparisons(t):
    return _comparisons(t)


@query(
    "quality_gates",
    "SELECT array_to_string(issues, ' ') AS issues, "
    "array_to_string(regressions, ', ') AS regressions FROM gates",
    TABLES,
)
def _quality_gates(t):
    return _gates(t).select(
        F.array_join("issues", " ").alias("issues"),
        F.array_join("regressions", ", ").alias("regressions"),
    )


@query(
    "overall_verdict",
    """
    SELECT CASE WHEN len(issues) > 0 THEN 'INCONCLUSIVE' WHEN len(regressions) > 0
                THEN 'REGRESSION' ELSE 'PASS' END AS overall,
           array_to_string(issues, ' ') AS issues,
           array_to_string(regressions, ', ') AS regressions
    FROM gates
    """,
    TABLES,
)
def _overall_verdict(t):
    return b.overall_verdict(_gates(t))


@query(
    "repetition_summary",
    f"""
    SELECT metric, {r('median(baseline)', 'baseline_median')},
           {r('median(candidate)', 'candidate_median')},
           {r('min(100e0 * (candidate - baseline) / baseline)', 'min_change_pct')},
           {r('max(100e0 * (candidate - baseline) / baseline)', 'max_change_pct')}
    FROM (SELECT event_type AS metric, value AS baseline, value + k - 40 AS candidate FROM ev)
    GROUP BY metric
    """,
)
def _repetition_summary(t):
    repetitions = t.events.select(
        F.col("event_type").alias("metric"), F.col("value").alias("baseline"),
        (F.col("value") + F.col("k") - 40).alias("candidate"),
    )
    return b.repetition_summary(repetitions)


@query(
    "workload_summary",
    """
    SELECT run_id, count(*) AS scheduled,
           count(*) FILTER (WHERE outcome = 'completed') AS completed,
           count(*) FILTER (WHERE outcome = 'completed' AND kind = 'read') AS completed_reads,
           count(*) FILTER (WHERE outcome = 'completed' AND kind = 'write') AS completed_writes,
           count(*) FILTER (WHERE outcome = 'dropped_queue') AS dropped_queue,
           count(*) FILTER (WHERE outcome = 'dropped_late') AS dropped_late,
           count(*) FILTER (WHERE outcome = 'error') AS errors,
           count(*) FILTER (WHERE outcome LIKE 'dropped%') AS dropped,
           round(count(*) FILTER (WHERE outcome = 'completed') / 120e0, 3)
               AS achieved_rate_ops_s,
           round(100e0 * count(*) FILTER (WHERE outcome = 'completed') / count(*), 3)
               AS completion_percent,
           round(quantile_cont(latency_ms, 0.50) FILTER (WHERE outcome = 'completed'), 3)
               AS latency_p50_ms,
           round(quantile_cont(latency_ms, 0.95) FILTER (WHERE outcome = 'completed'), 3)
               AS latency_p95_ms,
           round(quantile_cont(latency_ms, 0.99) FILTER (WHERE outcome = 'completed'), 3)
               AS latency_p99_ms
    FROM oplog GROUP BY run_id
    """,
)
def _workload_summary(t):
    return b.workload_summary(t.oplog, ["run_id"], 120)
