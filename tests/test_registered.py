"""Every registered query against its SQL, and the plans of the heavy ones."""

import glob
import math
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as registered
from tidemark.plans import catalog, oracle

DATA = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    with duckdb.connect() as connection:
        for path in glob.glob(f"{DATA}/*.parquet"):
            name = os.path.basename(path).removesuffix(".parquet")
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
        yield connection


def plain(value):
    return round(value, 9) if isinstance(value, float) and math.isfinite(value) else value


def test_every_query_has_its_sql():
    assert set(catalog.QUERIES) == set(oracle.SQL)
    assert set(registered.oracle_sql()) <= set(registered.queries())


@pytest.mark.parametrize("name", sorted(registered.oracle_sql()))
def test_query_equals_its_sql(spark, database, name):
    df = registered.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    cursor = database.execute(registered.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    wanted = sorted((tuple(plain(r[i]) for i in order) for r in cursor.fetchall()), key=repr)
    found = sorted((tuple(plain(v) for v in r) for r in df.select(*columns).collect()), key=repr)
    assert found == wanted


def plan_of(spark, name, **conf):
    for key, value in conf.items():
        spark.conf.set(key.replace("__", "."), value)
    try:
        df = registered.queries()[name](spark, DATA)
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in conf:
            spark.conf.unset(key.replace("__", "."))


BIG = {"spark__sql__autoBroadcastJoinThreshold": "-1"}


def test_entry_runs(spark):
    assert registered.entry(spark).columns == ["key", "value"]


def test_texts_are_split_once_and_only_text_is_read(spark):
    plan = plan_of(spark, "word_count")
    assert plan.count("split(") == 1
    assert "partial_count" in plan
    assert "ReadSchema: struct<text:string>" in plan


def test_nothing_is_broadcast_beyond_the_planner_s_limit(spark):
    for name in ("interval_join", "word_count_changelog", "late_records", "tumbling_sum_final", "stream_time"):
        plan = plan_of(spark, name, **BIG)
        assert "Broadcast" not in plan
        assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_records_of_a_key_are_windowed_by_block(spark):
    plan = plan_of(spark, "grouped_sum_changelog", **BIG)
    windows = [w for w in plan.splitlines() if "Window [" in w and "currentrow$()" in w]
    assert windows
    for line in windows:
        assert "__block0" in line.split("], [")[1]


def test_words_of_a_changelog_are_stored_once(spark):
    assert "split(" not in plan_of(spark, "word_count_changelog")


def test_the_join_is_on_key_and_time_slot(spark):
    plan = plan_of(spark, "interval_join", **BIG)
    assert "hashpartitioning(key" in plan and "__slot" in plan


def test_closed_windows_need_no_sort_of_the_records(spark):
    plan = plan_of(spark, "late_records")
    assert "Window" not in plan.replace("window", "")
    assert "Sort" not in plan


def test_filters_reach_the_scan(spark):
    plan = plan_of(spark, "interval_join")
    assert "% 2) = 0)" in plan and "% 2) = 1)" in plan
    assert plan.count("PushedFilters: [IsNotNull(event_id), IsNotNull(user_id)]") == 2
    assert plan.count("ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>") == 2


def test_the_entry_stands_without_modules_that_only_some_queries_need():
    code = "import sys; sys.modules['public_tokenizers'] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    folder = os.path.dirname(os.path.abspath(registered.__file__))
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=folder)
    assert done.stdout.split() == [str(len(catalog.QUERIES)), str(len(oracle.SQL))]
