"""Analysis of JSON-lines run logs.

A log is a frame ``line_no BIGINT, line STRING``; line numbers increase in file
order and need not be dense.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ordered

# Action names.
START, STOP = "/start", "/stop"
INPUT, OUTPUT = "/input", "/output"
CREATE, CREATE_END = "/create", "/create_end"

LINE_SCHEMA = (
    "timestamp string, request_id string, task string, action string, action_id string, "
    "input_args array<string>, output_files array<string>, workflow_file string, "
    "python_version string, _corrupt string"
)


def parse_lines(lines: DataFrame, on_error: str = "raise") -> DataFrame:
    """One row per non-blank line. A malformed line fails the job with its number, or
    with ``on_error="keep"`` has its text in ``malformed``."""
    parsed = F.from_json(
        "line", LINE_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    )
    rows = (
        lines.where(F.trim("line") != "")
        .withColumn("_e", parsed)
        .select("line_no", "_e.*")
        .withColumnRenamed("_corrupt", "malformed")
    )
    if on_error == "keep":
        return rows
    message = F.concat(F.lit("Error parsing line "), F.col("line_no").cast("string"))
    request = F.when(F.col("malformed").isNotNull(), F.raise_error(message).cast("string"))
    return rows.withColumn("request_id", F.coalesce(request, F.col("request_id"))).drop("malformed")


def latest_runs(entries: DataFrame, bucket_rows: int = ordered.BUCKET_ROWS) -> DataFrame:
    """Lines of the last uninterrupted run of every request id.

    A change of id starts a new run; an id that returns replaces its earlier run.
    The start of the last run per id is a small aggregate joined back, so one busy
    id is not gathered in one task. Lines without an id belong to no run; they are
    what :func:`unassigned` returns.
    """
    marked = ordered.previous(entries, "line_no", "request_id", "_before", bucket_rows)
    starts = (
        marked.where(~F.col("request_id").eqNullSafe(F.col("_before")))
        .groupBy("request_id")
        .agg(F.max("line_no").alias("run_start"))
    )
    return (
        entries.join(starts, "request_id")
        .where(F.col("line_no") >= F.col("run_start"))
    )


def unassigned(entries: DataFrame) -> DataFrame:
    """Lines without a request id, which no run can claim."""
    return entries.where(F.col("request_id").isNull())


def values_for_key(
    entries: DataFrame, key: str, action: str | None = None, required: bool = False
) -> DataFrame:
    """``request_id, line_no, value``: values of a key, arrays flattened, empties skipped."""
    rows = entries if action is None else entries.where(F.col("action") == action)
    if dict(entries.dtypes)[key].startswith("array"):
        rows = rows.select("request_id", "line_no", F.explode(key).alias("value"))
    else:
        rows = rows.select("request_id", "line_no", F.col(key).alias("value")).where(
            F.col("value") != ""
        )
    if required and rows.isEmpty():
        suffix = f" with action {action!r}" if action else ""
        raise ValueError(f"no entries found for key {key!r}{suffix}")
    return rows


def action_spans(entries: DataFrame, bucket_rows: int = ordered.BUCKET_ROWS) -> DataFrame:
    """``action_id, first_line, last_line, n_lines, closed, malformed``.

    A span runs from a create line to the next create-end line. A span whose create
    line comes while another is open is malformed. Of spans with one id the last is
    kept. One pass over the lines, then one row per span.
    """
    creates, ends = F.col("action") == CREATE, F.col("action") == CREATE_END
    opened, closed = F.when(creates, F.col("line_no")), F.when(ends, F.col("line_no"))
    placed = ordered.running_max(
        entries.select("line_no", "action", "action_id"),
        "line_no",
        {"span": (opened, True), "span_before": (opened, False), "end_before": (closed, False)},
        bucket_rows,
    )
    # No end line between the create line and this one.
    inside = F.col("end_before").isNull() | (F.col("end_before") < F.col("span"))
    still_open = F.col("span_before").isNotNull() & (
        F.col("end_before").isNull() | (F.col("end_before") < F.col("span_before"))
    )
    spans = (
        placed.where(F.col("span").isNotNull() & inside | creates)
        .groupBy("span")
        .agg(
            F.max(F.when(creates, F.col("action_id"))).alias("action_id"),
            F.max("line_no").alias("last_line"),
            F.count("*").alias("n_lines"),
            F.bool_or(ends).alias("closed"),
            F.bool_or(creates & still_open).alias("malformed"),
        )
    )
    fields = F.struct(F.col("span").alias("first_line"), "last_line", "n_lines", "closed", "malformed")
    return spans.groupBy("action_id").agg(F.max_by(fields, "span").alias("s")).select("action_id", "s.*")


def require_well_formed(spans: DataFrame) -> DataFrame:
    """The spans; a malformed one or one without an id fails the job."""
    bad = F.col("malformed") | F.col("action_id").isNull()
    message = F.concat(F.lit("malformed log at line "), F.col("first_line").cast("string"))
    return spans.withColumn(
        "action_id",
        F.when(bad, F.raise_error(message).cast("string")).otherwise(F.col("action_id")),
    )


def run_summary(entries: DataFrame) -> DataFrame:
    """Per request id: task, inputs, outputs, start, end and duration in seconds."""

    def listed(name: str, action: str) -> Column:
        return F.sum(F.when(F.col("action") == action, F.greatest(F.size(name), F.lit(0)))).alias(
            "n_" + name
        )

    def moment(action: str, fn) -> Column:
        return fn(F.when(F.col("action") == action, F.to_timestamp("timestamp")))

    times = entries.groupBy("request_id").agg(
        F.min_by("task", "line_no").alias("task"),
        F.count("*").alias("n_lines"),
        listed("input_args", INPUT),
        listed("output_files", OUTPUT),
        moment(START, F.min).alias("started"),
        moment(STOP, F.max).alias("ended"),
    )
    seconds = F.unix_timestamp("ended") - F.unix_timestamp("started")
    return times.withColumn("seconds", seconds)
