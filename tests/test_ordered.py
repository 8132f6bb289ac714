"""As-of joins, runs inside an event log, exact sums of degrees, files without a line."""

import json
import random

import numpy as np
import pytest
from helpers import text_file

from cellwise.operators import profile
from cellwise.operators.asof import latest_mark
from cellwise.plans import benchstats
from cellwise.sources import generate


@pytest.mark.parametrize("coalesced", ["true", "false"])
def test_latest_mark_equals_a_plain_search(spark, setting, coalesced):
    setting("spark.sql.adaptive.coalescePartitions.enabled", coalesced)
    rng = random.Random(1)
    marks = [(k, t, f"{k}{t}") for k in ("a", "b", "c", None) for t in rng.sample(range(100), 6)]
    rows = [(n, rng.choice(["a", "a", "a", "b", "z", None]), rng.choice([None, *range(110)])) for n in range(800)]
    found = latest_mark(spark.createDataFrame(rows, "n int, k string, t int"), spark.createDataFrame(marks, "k string, t int, run string"), "k", "t", "mark")
    assert found.columns == ["n", "k", "t", "mark"]
    for r in found.collect():
        before = [m for m in marks if m[0] == r["k"] and r["t"] is not None and m[1] <= r["t"]]
        assert (r["mark"]["run"] if r["mark"] else None) == (max(before, key=lambda m: m[1])[2] if before else None)
    assert found.count() == 800


def test_latest_mark_without_marks_or_rows(spark):
    rows, marks = spark.createDataFrame([(1, 2)], "k int, t int"), spark.createDataFrame([(1, 1)], "k int, t int")
    assert [r["mark"] for r in latest_mark(rows, marks.where("false"), "k", "t", "mark").collect()] == [None]
    assert latest_mark(rows.where("false"), marks, "k", "t", "mark").count() == 0


def test_tasks_at_the_edges_of_runs(spark):
    def task(finish, ms):
        return json.dumps({"Event": "SparkListenerTaskEnd", "Task Info": {"Finish Time": finish}, "Task Metrics": {"Executor Run Time": ms}})

    lines = [("x", task(t, t)) for t in (99, 100, 150, 200, 201, 299, 300, 301)]
    lines += [("x", json.dumps({"Event": "SparkListenerJobStart", "Submission Time": 100})), ("x", json.dumps({"Event": "SparkListenerStageCompleted", "Stage Info": {"Completion Time": 200}}))]
    lines += [("y", task(150, 7)), ("x", "not json")]
    runs = [("x", "first", 100, 200), ("x", "second", 300, 300), ("x", "idle", 400, 500), ("y", "other", 0, 1000)]
    found = benchstats.event_log_runs(spark.createDataFrame(lines, "label string, line string"), spark.createDataFrame(runs, "label string, run string, time_ms bigint, end_ms bigint"))
    rows = {r["label"]: (r["jobs"], r["stages"], r["tasks"], r["max_ms"]) for r in found.collect()}
    assert rows == {"first": (1, 1, 3, 200), "second": (0, 0, 1, 300), "other": (0, 0, 1, 7)}


@pytest.mark.parametrize("nnz", [0, 3, 999, 10_000])
def test_degrees_add_up_exactly_and_keep_their_spread(spark, nnz):
    rows = 1000
    degrees = generate.power_law_degrees(spark, rows, nnz)
    found = np.array([r["degree"] for r in generate.exact_degrees(degrees, nnz).orderBy("i").collect()])
    assert len(found) == rows and found.sum() == nnz and found.min() >= 0
    if nnz == 10_000:
        # The urn of rows picked in proportion to max(1, degree so far), drawn one by one.
        rng = np.random.default_rng(0)
        urn, picks = np.zeros(rows, int), list(range(rows))
        for _ in range(nnz):
            i = picks[rng.integers(len(picks))]
            urn[i] += 1
            if urn[i] > 1:
                picks.append(i)
        assert abs(found.std() - urn.std()) < 0.15 * urn.std() and abs((found == 0).mean() - (urn == 0).mean()) < 0.03
    m = generate.power_law(spark, rows, 50, nnz, exact=True)
    assert m.df.count() <= np.minimum(found, 50).sum()


def test_files_without_a_line(spark, tmp_path):
    folder = tmp_path / "with space"
    folder.mkdir()
    for name, content in (("a.csv", ""), ("b.csv", "1\n2\n"), ("c.csv", "1,2\n"), ("d.csv", "x\n")):
        text_file(folder / name, content)
    found = {r["file"].rsplit("/", 1)[1]: (r["lines"], r["kind"]) for r in profile.classify_text_files(spark, str(folder)).collect()}
    assert found == {"a.csv": (0, "empty"), "b.csv": (2, "column vector"), "c.csv": (1, "row vector"), "d.csv": (1, "single line with other text")}
