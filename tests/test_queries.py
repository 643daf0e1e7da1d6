"""Registered queries: DuckDB oracle parity, driver contract, plan shape."""

from __future__ import annotations

import math
import os
import tempfile

import duckdb
import pytest

import __spark_entry__ as entry
from tidemark.plans import catalog
from tidemark.plans.oracles import oracles
from tidemark.sources.kafka import read_lines
from tidemark.sources.tables import read_table

from conftest import SMALL

QUERIES = catalog.QUERIES
ORACLES = oracles()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("events", "nation"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return repr(v)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    rel = duck.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    cols = sorted(df.columns)
    got = sorted(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    idx = [rel.columns.index(c) for c in cols]
    expect = sorted(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())
    assert got == expect


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["windowStart", "windowEnd", "location", "eventsPerWindow", "sumPerWindow"]
    assert len(rows) > 0


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_batch_plans_stay_in_the_jvm(spark, name):
    plan = _plan(QUERIES[name](spark, SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                 "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan, (name, node)


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(QUERIES["unit_conversions"](spark, SMALL))
    assert "ReadSchema: struct<event_id:bigint,value:double>" in \
        QUERIES["unit_conversions"](spark, SMALL)._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "FileScan parquet" in plan


def test_split_filter_reaches_the_scan(spark):
    plan = _plan(QUERIES["localized_wind"](spark, SMALL))
    assert "DataFilters: [" in plan and "pmod(user_id" in plan


def test_line_list_reader(spark):
    names = [r["n_name"] for r in read_table(spark, SMALL, "nation", ["n_name"]).collect()]
    path = os.path.join(tempfile.mkdtemp(prefix="tidemark-lines-"), "cities.csv")
    with open(path, "w") as f:
        f.write("\n".join(f"  {n} " for n in names) + "\n\n")
    # every line is kept as it is, blank ones too
    assert [r["name"] for r in read_lines(spark, path).collect()] == [f"  {n} " for n in names] + [""]


def test_keyed_reuse_adds_no_second_shuffle(spark):
    """RT-4: once rows are hash-partitioned by sensor, per-sensor tumbling
    windows and the per-sensor EMA window reuse that partitioning."""
    from pyspark.sql import functions as F

    from tidemark.operators.ema import ema_window
    from tidemark.operators.routing import key_by_sensor
    from tidemark.schemas import SENSOR_KEY
    from tidemark.sources.fixtures import extended_measurements

    keyed = key_by_sensor(extended_measurements(spark, SMALL))
    windows = keyed.groupBy(*[F.col(c) for c in SENSOR_KEY],
                            F.window(F.timestamp_millis("measurement.timestamp"), "1 hour")).count()
    for df in (windows, ema_window(keyed, SENSOR_KEY)):
        plan = _plan(df)          # includes the exchanges Spark inserts
        assert plan.count("Exchange hashpartitioning") == 1, plan
        assert "Exchange SinglePartition" not in plan and "rangepartitioning" not in plan


def test_results_do_not_depend_on_session_time_zone(spark):
    names = ["tumbling_sum_count_1d", "on_time_windows", "interval_stats_us"]
    old = spark.conf.get("spark.sql.session.timeZone")
    got = {}
    try:
        for tz in ("UTC", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            got[tz] = {n: sorted(map(tuple, QUERIES[n](spark, SMALL).collect())) for n in names}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got["UTC"] == got["America/Los_Angeles"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_payload_is_parsed_once_and_stays_out_of_the_exchanges(spark):
    """Decoding comes before the watermark's shuffle; the quarantine's filter stays above the parse."""
    from tidemark.operators.decode import tolerant_decode
    from tidemark.plans.location import location_pipeline
    from tidemark.presets import DAY
    rows = spark.range(50).selectExpr("id AS seq", "id AS timestamp", "cast(1 as int) AS partition",
                                      "cast(concat('{\"location\":\"x\",\"value\":', id, '}') as binary) AS value")
    bad = tolerant_decode(rows).invalid
    tree = bad._jdf.queryExecution().optimizedPlan()
    filters = [line for line in tree.toString().splitlines() if "Filter" in line]
    assert filters and not any("from_json" in line for line in filters), filters
    out = location_pipeline(rows, DAY)
    exchanges = [line for line in _plan(out.main).splitlines() if "Window [" in line or "Sort [" in line]
    assert exchanges
    parses = [line for line in out.main._jdf.queryExecution().optimizedPlan().toString().splitlines()
              if "from_json" in line]
    assert len(parses) == 1, parses
