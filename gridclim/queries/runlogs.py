"""Run-log analysis."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import runlog
from ..session import materialise
from ..sources import tables
from . import query
from . import sql as q
from .common import big, flag, text

# The log of ``sources.tables.log_lines`` with its fields already taken apart.
_LINES = """lines AS (
  SELECT event_id AS line_no, event_id % 40 AS place, event_id // 40 AS block,
    'run-' || CASE WHEN (event_id // 40) % 5 = 4 THEN event_id // 40 - 4 ELSE event_id // 40 END AS request_id,
    CASE WHEN event_id % 40 = 0 THEN '/start' WHEN event_id % 40 = 39 THEN '/stop' WHEN event_id % 10 = 2 THEN '/create'
      WHEN event_id % 10 = 7 THEN '/create_end' WHEN event_id % 10 = 8 THEN '/output' WHEN event_id % 10 = 1 THEN '/input'
      ELSE '/step' END AS action,
    event_type AS task, 'act-' || event_id AS action_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS stamp, ts, user_id
  FROM events WHERE NOT (event_id % 7 = 0 AND (event_id % 40) % 10 IN (4, 5))),
latest AS (SELECT l.* FROM lines l JOIN (SELECT request_id, max(block) AS block FROM lines GROUP BY 1) USING (request_id, block))"""


def _entries(spark, sf):
    return runlog.parse_lines(tables.log_lines(spark, sf))


def _kept(spark, sf):
    """Parsed lines of the latest runs, kept as a table since several steps read them."""
    return materialise(runlog.latest_runs(materialise(_entries(spark, sf))))


@query("l1_parse_lines", q.with_(_LINES) + "SELECT line_no, stamp AS timestamp, request_id, task, action, action_id FROM lines")
def l1(spark, sf):
    return _entries(spark, sf).select("line_no", "timestamp", "request_id", "task", "action", "action_id")


@query(
    "l1_reject_malformed",
    """SELECT event_id AS line_no, CASE WHEN event_id % 13 = 3 THEN '{"request_id": "r' || event_id || '", ' END AS malformed FROM events""",
)
def l1_reject(spark, sf):
    n = F.col("event_id")
    head = F.concat(F.lit('{"request_id": "r'), text(n), F.lit('", '))
    line = F.when(n % 13 == 3, head).otherwise(F.concat(head, F.lit('"action": "/step"}')))
    rows = tables.table(spark, sf, "events").select(n.alias("line_no"), line.alias("line"))
    return runlog.parse_lines(rows, on_error="keep").select("line_no", "malformed")


@query("l2_latest_runs", q.with_(_LINES) + "SELECT request_id, line_no, action FROM latest")
def l2(spark, sf):
    lines = materialise(_entries(spark, sf))
    return runlog.latest_runs(lines).select("request_id", "line_no", "action")


@query(
    "l3_values_for_key",
    q.with_(_LINES)
    + """SELECT request_id, line_no, unnest(['--user=' || user_id, '--k=' || place]) AS value FROM latest WHERE action = '/input'
    UNION ALL SELECT request_id, line_no, task FROM latest WHERE action = '/start'""",
)
def l3(spark, sf):
    entries = _kept(spark, sf)
    return runlog.values_for_key(entries, "input_args", runlog.INPUT).unionByName(
        runlog.values_for_key(entries, "task", runlog.START)
    )


@query(
    "l4_action_spans",
    q.with_(_LINES)
    + """, s AS (SELECT line_no AS first_line, action_id FROM latest WHERE action = '/create')
    SELECT s.action_id, first_line, least(first_line + 5, max(l.line_no)) AS last_line, count(*) AS n_lines,
      CAST(bool_or(l.action = '/create_end') AS BIGINT) AS closed
    FROM s JOIN latest l ON l.line_no BETWEEN first_line AND first_line + 5 GROUP BY 1, 2""",
)
def l4(spark, sf):
    entries = _kept(spark, sf)
    spans = runlog.require_well_formed(runlog.action_spans(entries))
    return spans.select("action_id", "first_line", "last_line", "n_lines", flag("closed").alias("closed"))


@query(
    "l5_run_summary",
    q.with_(_LINES)
    + """SELECT request_id, min_by(task, line_no) AS task, count(*) AS n_lines,
      CAST(2 * count(*) FILTER (WHERE action = '/input') AS BIGINT) AS n_input_args,
      CAST(count(*) FILTER (WHERE action = '/output') AS BIGINT) AS n_output_files,
      min(stamp) FILTER (WHERE action = '/start') AS started,
      CAST(epoch(date_trunc('second', max(ts) FILTER (WHERE action = '/stop')))
        - epoch(date_trunc('second', min(ts) FILTER (WHERE action = '/start'))) AS DOUBLE) AS seconds
    FROM latest GROUP BY 1""",
)
def l5(spark, sf):
    out = runlog.run_summary(_kept(spark, sf))
    return out.select(
        "request_id",
        "task",
        "n_lines",
        big("n_input_args").alias("n_input_args"),
        big("n_output_files").alias("n_output_files"),
        F.date_format("started", "yyyy-MM-dd'T'HH:mm:ss").alias("started"),
        F.col("seconds").cast("double").alias("seconds"),
    )
