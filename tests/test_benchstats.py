import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellwise.operators.ranks import middle_ranks, order_statistics
from cellwise.plans import benchstats as bs


def nearest(xs, p):
    xs = sorted(xs)
    return xs[min(len(xs) - 1, max(0, math.floor((len(xs) - 1) * p + 0.5)))]


def test_order_statistics_against_sorting(spark):
    rng = np.random.default_rng(3)
    groups = {
        "hot": rng.integers(0, 50, 3000).astype(float), "even": rng.normal(size=10), "one": np.array([4.0]),
        "same": np.full(500, 7.0), "odd": rng.normal(size=301),
    }
    rows = [(g, float(x)) for g, xs in groups.items() for x in xs] + [("hot", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    shares = {"p50": 0.5, "p90": 0.9, "p99": 0.99, "p0": 0.0, "p1": 1.0}
    for r in bs.nearest_rank(df, ["g"], "x", shares).collect():
        assert {s: r[s] for s in shares} == {s: nearest(groups[r.g], p) for s, p in shares.items()}
    for r in order_statistics(df, ["g"], "x", {"m": middle_ranks}).collect():
        assert r.m == pytest.approx(np.median(groups[r.g]))


def test_trial_summary(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 4.0), ("a", 9.0), ("b", 5.0), ("c", None)], "n string, ms double")
    rows = {r.n: r for r in bs.trial_summary(df, ["n"], "ms").collect()}
    assert (rows["a"]["median"], rows["a"]["min"], rows["a"]["max"]) == (3, 1, 9)
    assert rows["a"]["std"] == pytest.approx(np.std([1, 2, 4, 9]))
    assert (rows["b"]["median"], rows["b"]["std"]) == (5, 0)
    assert (rows["c"]["trials"], rows["c"]["median"], rows["c"]["std"]) == (0, 0, 0)


def test_labels_and_ratios(spark):
    df = spark.createDataFrame([([],), (["b", "a"],)], "s array<string>")
    assert [r[0] for r in df.select(bs.ablation_label(F.col("s"))).collect()] == ["baseline", "a+b"]
    pairs = spark.createDataFrame([(3.0, 2.0), (1.0, 0.0), (None, 1.0), (math.nan, 1.0)], "d double, r double")
    assert [r[0] for r in pairs.select(bs.guarded_ratio(F.col("d"), F.col("r"))).collect()] == [1.5, None, None, None]


def test_merge_takes_the_last_kernel_row(spark):
    totals = spark.createDataFrame([("a", "baseline", 2.0, 3.0), ("b", "baseline", 0.0, 1.0)], "name string, ablation string, RDD_ms double, DF_ms double")
    kernels = spark.createDataFrame(
        [("a", "baseline", 9.0, 9.0, 1), ("a", "baseline", 4.0, 1.0, 2), ("a", "x", 5.0, 5.0, 3)],
        "name string, ablation string, RDD_kernel_ms double, DF_kernel_ms double, n int",
    )
    rows = {r.name: r for r in bs.merge_summaries(totals, kernels, "n").collect()}
    assert tuple(rows["a"])[4:] == (4.0, 1.0, 1.5, 0.25)
    assert tuple(rows["b"])[4:] == (None, None, None, None)


def test_summary_tables_have_the_fixed_columns(spark):
    trials = spark.createDataFrame(
        [("c", "baseline", e, float(ms)) for e, times in {"rdd": [1, 2, 6], "df": [4, 6]}.items() for ms in times],
        "name string, ablation string, engine string, ms double",
    )
    kernel = bs.kernel_table(trials)
    assert kernel.columns == bs.KERNEL_COLUMNS and len(bs.KERNEL_COLUMNS) == 8
    assert tuple(kernel.first())[2:] == (2, 5, 1, 6, 4, 6)
    cases = spark.createDataFrame([("c", 3, 3, 3, 1, 3, False)], "name string, A_rows int, A_cols int, B_rows int, B_cols int, cells bigint, preview_used boolean")
    metrics = [c for c in bs._RUN if c != "hash"]
    runs = spark.createDataFrame(
        [("c", "baseline", e, *range(14), "ff") for e in ("rdd", "df")],
        "name string, ablation string, engine string, " + ", ".join(f"{c} bigint" for c in metrics) + ", hash string",
    )
    total = bs.total_table(trials, cases, runs)
    assert total.columns == bs.TOTAL_COLUMNS and len(bs.TOTAL_COLUMNS) == 46
    row = total.first()
    assert (row.RDD_ms, row.DF_ms, row.rdd_jobs, row.df_max_ms, row.rdd_hash) == (2, 5, 0, 13, "ff")
    merged = bs.merge_summaries(total, kernel.withColumn("n", F.lit(1)), "n")
    assert merged.columns == bs.MERGED_COLUMNS


def event(kind, run=0, **metrics):
    line = {"Event": kind}
    if kind == "SparkListenerTaskEnd":
        line["Task Metrics"] = {
            "Executor Run Time": run, "JVM GC Time": 1, "Memory Bytes Spilled": 2, "Disk Bytes Spilled": 3,
            "Input Metrics": {"Bytes Read": 4}, "Output Metrics": {"Bytes Written": 5},
            "Shuffle Read Metrics": {"Remote Bytes Read": 6, "Local Bytes Read": 7},
            "Shuffle Write Metrics": {"Shuffle Bytes Written": 8},
        }
    return json.dumps(line | metrics)


def test_event_log(spark, tmp_path):
    lines = [event("SparkListenerJobStart"), event("SparkListenerStageCompleted"), event("SparkListenerStageCompleted")]
    lines += [event("SparkListenerTaskEnd", run) for run in (10, 20, 30, 40)]
    lines += ['{"Event": "SparkListenerTaskEnd"}', "not json"]
    (tmp_path / "app").write_text("\n".join(lines))
    row = bs.event_log_rollup(bs.read_event_log(spark, str(tmp_path / "app"))).first().asDict()
    assert row.pop("label").endswith("/app")
    assert row == {
        "jobs": 1, "stages": 2, "tasks": 5, "shuffle_read_bytes": 52, "shuffle_write_bytes": 32, "input_bytes": 16,
        "output_bytes": 20, "mem_spill_bytes": 8, "disk_spill_bytes": 12, "gc_ms": 4, "p50_ms": 30, "p90_ms": 40,
        "p99_ms": 40, "max_ms": 40,
    }


def test_groups_without_a_key_have_their_own_statistics(spark):
    trials = spark.createDataFrame([(None, 5.0), (None, 9.0), ("a", 1.0)], "name string, ms double")
    found = {r["name"]: (r["trials"], r["median"]) for r in bs.trial_summary(trials, ["name"], "ms").collect()}
    assert found == {None: (2, 7.0), "a": (1, 1.0)}


def test_picked_ranks_keep_their_type(spark):
    rows = spark.createDataFrame([(None, 9007199254740993)], "label string, x bigint")
    assert bs.nearest_rank(rows, ["label"], "x", {"p50": 0.5}).collect()[0]["p50"] == 9007199254740993
