"""Statistics over benchmark timings and Spark event logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwise.operators.asof import latest_mark
from cellwise.operators.ranks import joined_on, middle_ranks, nearest_ranks, order_statistics

# Columns of the summary tables, in order.
_RUN = ["jobs", "stages", "tasks", "shuffle_read_bytes", "shuffle_write_bytes", "input_bytes", "output_bytes",
        "mem_spill_bytes", "disk_spill_bytes", "gc_ms", "p50_ms", "p90_ms", "p99_ms", "max_ms", "hash"]
TOTAL_COLUMNS = (
    ["name", "ablation", "A_rows", "A_cols", "B_rows", "B_cols", "cells", "RDD_ms", "DF_ms",
     "RDD_ms_min", "RDD_ms_max", "RDD_ms_std", "DF_ms_min", "DF_ms_max", "DF_ms_std"]
    + [f"rdd_{c}" for c in _RUN] + [f"df_{c}" for c in _RUN] + ["preview_used"]
)
KERNEL_COLUMNS = ["name", "ablation", "RDD_kernel_ms", "DF_kernel_ms", "RDD_kernel_min", "RDD_kernel_max",
                  "DF_kernel_min", "DF_kernel_max"]
MERGED_COLUMNS = TOTAL_COLUMNS + ["RDD_kernel_ms", "DF_kernel_ms", "speedup_total", "speedup_kernel"]

# Shares of the task-time percentiles.
TASK_SHARES = {"p50_ms": 0.5, "p90_ms": 0.9, "p99_ms": 0.99}


def ablation_label(settings: Column) -> Column:
    """Sorted settings joined with ``+``; none at all is ``baseline``."""
    return F.when(F.size(settings) == 0, F.lit("baseline")).otherwise(F.array_join(F.array_sort(settings), "+"))


def guarded_ratio(over: Column, under: Column) -> Column:
    """over / under, or NULL when one is missing, NaN, or ``under`` is zero."""
    usable = over.isNotNull() & under.isNotNull() & ~F.isnan(over) & ~F.isnan(under) & (under != 0)
    return F.when(usable, over / under)


def nearest_rank(df: DataFrame, keys: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """Per group, the element at rank round((n - 1) * share) for each named share."""
    return order_statistics(df, keys, value, {name: nearest_ranks(share) for name, share in shares.items()}, single=True)


def trial_summary(trials: DataFrame, keys: list[str], ms: str) -> DataFrame:
    """Per group: trials, median, min, max and population deviation of the times."""
    medians = order_statistics(trials, keys, ms, {"median": middle_ranks})
    spread = trials.groupBy(*keys).agg(
        F.count(ms).alias("trials"),
        F.min(ms).alias("min"),
        F.max(ms).alias("max"),
        F.coalesce(F.stddev_pop(ms), F.lit(0.0)).alias("std"),
    )
    joined = joined_on(spread, medians, keys, "left")
    return joined.select(*keys, "trials", F.coalesce("median", F.lit(0.0)).alias("median"), "min", "max", "std")


def merge_summaries(totals: DataFrame, kernels: DataFrame, order: str) -> DataFrame:
    """Totals with the kernel times of the same (name, ablation) and both speed-ups.

    Where kernels repeat a key, the row with the greatest ``order`` counts. Totals
    without kernel times stay, with NULLs.
    """
    keys = ["name", "ablation"]
    latest = kernels.groupBy(*keys).agg(
        F.max_by(F.struct("RDD_kernel_ms", "DF_kernel_ms"), order).alias("kernel")
    ).select(*keys, "kernel.*")
    return totals.join(latest, keys, "left").select(
        *totals.columns,
        "RDD_kernel_ms",
        "DF_kernel_ms",
        guarded_ratio(F.col("DF_ms"), F.col("RDD_ms")).alias("speedup_total"),
        guarded_ratio(F.col("DF_kernel_ms"), F.col("RDD_kernel_ms")).alias("speedup_kernel"),
    )


def kernel_table(trials: DataFrame) -> DataFrame:
    """Trials (name, ablation, engine 'rdd' or 'df', ms) as the kernel summary table."""
    return _by_engine(trials, {"ms": "median", "min": "min", "max": "max"}).select(
        "name",
        "ablation",
        F.col("rdd_ms").alias("RDD_kernel_ms"),
        F.col("df_ms").alias("DF_kernel_ms"),
        F.col("rdd_min").alias("RDD_kernel_min"),
        F.col("rdd_max").alias("RDD_kernel_max"),
        F.col("df_min").alias("DF_kernel_min"),
        F.col("df_max").alias("DF_kernel_max"),
    )


def total_table(trials: DataFrame, cases: DataFrame, runs: DataFrame) -> DataFrame:
    """The total summary table.

    ``trials`` as for :func:`kernel_table`; ``cases`` holds the shapes, cell count and
    preview flag by name; ``runs`` one row of run metrics with the result hash by
    (name, ablation, engine).
    """
    timed = _by_engine(trials, {"ms": "median", "ms_min": "min", "ms_max": "max", "ms_std": "std"})
    renamed = timed.select(
        "name", "ablation", *[F.col(c).alias(c.replace("rdd_", "RDD_").replace("df_", "DF_")) for c in timed.columns[2:]]
    )
    measured = runs.groupBy("name", "ablation").agg(
        *[
            F.max(F.when(F.col("engine") == engine, F.col(c))).alias(f"{engine}_{c}")
            for engine in ("rdd", "df")
            for c in _RUN
        ]
    )
    return renamed.join(cases, "name").join(measured, ["name", "ablation"], "left").select(*TOTAL_COLUMNS)


def _by_engine(trials: DataFrame, columns: dict[str, str]) -> DataFrame:
    stats = trial_summary(trials, ["name", "ablation", "engine"], "ms")
    return stats.groupBy("name", "ablation").agg(
        *[
            F.max(F.when(F.col("engine") == engine, F.col(stat))).alias(f"{engine}_{out}")
            for engine in ("rdd", "df")
            for out, stat in columns.items()
        ]
    )


# The fields of Spark's event log that are summed up.
_EVENT_SCHEMA = """
`Event` string, `Submission Time` bigint,
`Task Info` struct<`Finish Time`: bigint>, `Stage Info` struct<`Completion Time`: bigint>,
`Task Metrics` struct<
  `Executor Run Time`: bigint, `JVM GC Time`: bigint,
  `Memory Bytes Spilled`: bigint, `Disk Bytes Spilled`: bigint,
  `Input Metrics`: struct<`Bytes Read`: bigint>,
  `Output Metrics`: struct<`Bytes Written`: bigint>,
  `Shuffle Read Metrics`: struct<`Remote Bytes Read`: bigint, `Local Bytes Read`: bigint>,
  `Shuffle Write Metrics`: struct<`Shuffle Bytes Written`: bigint>>
"""


def read_event_log(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(label, line) of event-log files, labelled with the file path."""
    return spark.read.text(paths).select(F.col("_metadata.file_path").alias("label"), F.col("value").alias("line"))


def _parsed(lines: DataFrame) -> DataFrame:
    """The figures of each event of (label, line), and its time in milliseconds."""
    # Opened by a generator, which filters on the fields do not pass: each line is parsed once.
    events = lines.select("label", F.inline(F.array(F.from_json("line", _EVENT_SCHEMA))))
    m = F.col("Task Metrics")
    is_task = F.col("Event") == "SparkListenerTaskEnd"
    read = m["Shuffle Read Metrics"]
    return events.select(
        "label",
        F.col("Event").alias("event"),
        F.coalesce(F.col("Task Info")["Finish Time"], F.col("Stage Info")["Completion Time"], "Submission Time").alias("time_ms"),
        F.when(is_task, m["Executor Run Time"]).alias("run_ms"),
        F.when(is_task, m["JVM GC Time"]).alias("gc_ms"),
        F.when(is_task, m["Memory Bytes Spilled"]).alias("mem_spill_bytes"),
        F.when(is_task, m["Disk Bytes Spilled"]).alias("disk_spill_bytes"),
        F.when(is_task, m["Input Metrics"]["Bytes Read"]).alias("input_bytes"),
        F.when(is_task, m["Output Metrics"]["Bytes Written"]).alias("output_bytes"),
        F.when(is_task, read["Remote Bytes Read"] + read["Local Bytes Read"]).alias("shuffle_read_bytes"),
        F.when(is_task, m["Shuffle Write Metrics"]["Shuffle Bytes Written"]).alias("shuffle_write_bytes"),
    )


def event_log_rollup(lines: DataFrame) -> DataFrame:
    """Run metrics per label from event-log lines (label, line).

    Job, stage and task counts, byte sums, GC time, and percentiles of the task times.
    """
    return _rolled_up(_parsed(lines))


def event_log_runs(lines: DataFrame, runs: DataFrame) -> DataFrame:
    """The same for each run of (label, run, time_ms, end_ms) within the logs; ``label`` is the run.

    An event belongs to the run of its log that has begun last, if that has not ended before
    it; both edges are within the run. A task counts by its finish, a stage by its completion,
    a job by its submission. Runs of one log do not overlap; a run without events has no row.
    """
    found = latest_mark(_parsed(lines), runs.select("label", "run", "time_ms", "end_ms"), "label", "time_ms", "mark")
    inside = found.where(F.col("time_ms") <= F.col("mark")["end_ms"])
    return _rolled_up(inside.withColumn("label", F.col("mark")["run"]))


def _rolled_up(flat: DataFrame) -> DataFrame:
    def events_of(kind: str, name: str) -> Column:
        return F.count(F.when(F.col("event") == kind, 1)).alias(name)

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0)).alias(name)

    sums = flat.groupBy("label").agg(
        events_of("SparkListenerJobStart", "jobs"),
        events_of("SparkListenerStageCompleted", "stages"),
        events_of("SparkListenerTaskEnd", "tasks"),
        *map(total, _RUN[3:10]),
        F.coalesce(F.max("run_ms"), F.lit(0)).alias("max_ms"),
    )
    ranks = nearest_rank(flat, ["label"], "run_ms", TASK_SHARES)
    shares = [F.coalesce(F.col(name).cast("bigint"), F.lit(0)).alias(name) for name in TASK_SHARES]
    return joined_on(sums, ranks, ["label"], "left").select("label", *_RUN[:10], *shares, "max_ms")
