"""Stream / batch parity: the same rows through Structured Streaming (one file
per micro-batch, ``availableNow``) give the same results as the batch plans."""

from __future__ import annotations

import os
import tempfile

import pandas as pd
import pyarrow as pa
import pytest

from tidemark.operators.ema import ema_window
from tidemark.operators.windows import sliding_average
from tidemark.plans.location import location_pipeline
from tidemark.schemas import SENSOR_KEY
from tidemark.presets import DAY
from tidemark.sources.fixtures import extended_measurements, kafka_records
from tidemark.sources.kafka import read_record_files
from tidemark.streaming.location import (LateTagger, location_windows, on_time_windows, read_tagged,
                                         with_lag_gauge)
from tidemark.streaming.sensors import FLAT_SCHEMA, flatten, nest, sensor_streams
from tidemark.streaming.sinks import start, start_batches

from conftest import MEDIUM, SMALL
from streamdata import write_numbered

AVAILABLE_NOW = {"availableNow": True}
RECORD_ARROW = pa.schema([("seq", pa.int64()), ("arrival_ms", pa.int64()), ("timestamp", pa.int64()),
                          ("key", pa.binary()), ("value", pa.binary()), ("partition", pa.int32())])
FAR = 4_000_000_000_000


def _far_records(seq0):
    payload = b'{"sensorId": 1, "value": 0.0, "location": "FUTURE"}'
    return pd.DataFrame({"seq": [seq0], "arrival_ms": [FAR + seq0], "timestamp": [FAR + seq0 * DAY.window_ms],
                         "key": [None], "value": [payload], "partition": [1]})


def _windows(rows):
    return sorted((r["windowStart"], r["windowEnd"], r["location"], r["eventsPerWindow"],
                   round(r["sumPerWindow"], 6)) for r in rows if r["location"] != "FUTURE")


@pytest.fixture(scope="module")
def record_dir(spark):
    rec = kafka_records(spark, MEDIUM, DAY.skew_ms).drop("poison")
    pdf = rec.toPandas()
    folder = tempfile.mkdtemp(prefix="tidemark-rec-")
    nxt = write_numbered(pdf, folder, 8, schema=RECORD_ARROW)
    top = int(pdf.seq.max())
    nxt = write_numbered(_far_records(top + 1), folder, 1, start_index=nxt, schema=RECORD_ARROW)
    write_numbered(_far_records(top + 2), folder, 1, start_index=nxt, schema=RECORD_ARROW)
    return folder


def test_late_tagger_and_on_time_windows_match_batch(spark, record_dir):
    work = tempfile.mkdtemp(prefix="tidemark-late-")
    late, on_time, state = (os.path.join(work, d) for d in ("late", "ontime", "state"))
    tagger = LateTagger(DAY, late, on_time, state)
    q = start_batches(read_record_files(spark, record_dir, max_files_per_trigger=1), "tagger",
                      tagger, checkpoint=os.path.join(work, "ck-a"), trigger=AVAILABLE_NOW)
    q.awaitTermination(600)
    q2 = start(with_lag_gauge(on_time_windows(read_tagged(spark, on_time), DAY)), "on_time_out",
               sink="memory", checkpoint=os.path.join(work, "ck-b"), trigger=AVAILABLE_NOW)
    q2.awaitTermination(600)
    got = _windows(spark.table("on_time_out").collect())

    batch = location_pipeline(kafka_records(spark, MEDIUM, DAY.skew_ms), DAY)
    assert got == _windows(batch.main.collect())
    late_seq = sorted(r["seq"] for r in spark.read.parquet(late).collect())
    assert late_seq == sorted(r["seq"] for r in batch.late.collect())
    assert len(late_seq) > 0
    invalid = [p for p in q2.recentProgress if "decode" in (p.observedMetrics or {})]
    assert sum(p.observedMetrics["decode"]["numInvalidRecords"] for p in invalid) > 0
    lags = [p.observedMetrics["eventTimeLag"] for p in q2.recentProgress
            if "eventTimeLag" in (p.observedMetrics or {})]
    # one gauge row per micro-batch, counting every emitted window (the far
    # future test windows included, hence no sign check on the minimum)
    assert sum(m["count"] for m in lags) == spark.table("on_time_out").count()
    assert max(m["max"] for m in lags if m["count"]) > 0


def test_single_query_windows_close(spark, record_dir):
    work = tempfile.mkdtemp(prefix="tidemark-win-")
    q = start(location_windows(read_record_files(spark, record_dir), DAY), "win_out", sink="memory",
              checkpoint=os.path.join(work, "ck"), trigger=AVAILABLE_NOW)
    q.awaitTermination(600)
    got = _windows(spark.table("win_out").collect())
    # one micro-batch: nothing is behind the watermark yet, so every valid
    # record is counted (late ones included)
    from tidemark.operators.decode import tolerant_decode
    from tidemark.operators.windows import tumbling_sum_count
    valid = tolerant_decode(kafka_records(spark, MEDIUM, DAY.skew_ms)).valid
    assert got == _windows(tumbling_sum_count(valid, DAY.window_ms).collect())


def _flat_rows(df):
    return sorted((r["seq"], round(r["value"], 9), r["accuracy"], r["timestamp"]) for r in df.collect())


def test_sensor_streams_match_batch_with_restart(spark):
    temps = extended_measurements(spark, SMALL).filter("sensor.sensorType = 'Temperature'")
    pdf = flatten(temps).toPandas()
    far = pd.DataFrame({"seq": [10 ** 9], "sensorId": [999_999], "vendorId": [99], "sensorType": ["Temperature"],
                        "longitude": [10.0], "latitude": [50.0], "height": [1.0], "value": [1.0],
                        "accuracy": [0.5], "timestamp": [FAR]})
    far["accuracy"] = far["accuracy"].astype("float32")
    pdf["accuracy"] = pdf["accuracy"].astype("float32")
    work = tempfile.mkdtemp(prefix="tidemark-sensor-")
    src = os.path.join(work, "src")
    half = len(pdf) // 2
    nxt = write_numbered(pdf.iloc[:half], src, 2)

    def run():
        stream = nest(spark.readStream.schema(FLAT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(src))
        s = sensor_streams(stream, sliding=(36_000_000, 3_600_000), watermark_ms=0)
        qs = [start(flatten(s.ema), "ema", sink="parquet", path=os.path.join(work, "ema"),
                    checkpoint=os.path.join(work, "ck-ema"), trigger=AVAILABLE_NOW),
              start(s.sliding.select("windowStart", "windowEnd", "count", "sensor.sensorId",
                                     "measurement.*"),
                    "sliding", sink="parquet", path=os.path.join(work, "sliding"),
                    checkpoint=os.path.join(work, "ck-sl"), trigger=AVAILABLE_NOW)]
        for q in qs:
            q.awaitTermination(600)

    run()                                    # first half, then stop
    nxt = write_numbered(pdf.iloc[half:], src, 2, start_index=nxt)
    nxt = write_numbered(far, src, 1, start_index=nxt)
    write_numbered(far.assign(seq=10 ** 9 + 1, timestamp=FAR + 1), src, 1, start_index=nxt)
    run()                                    # restart on the same checkpoints

    from tidemark.functions.records import localize_temperature
    expect = flatten(localize_temperature(ema_window(temps, SENSOR_KEY)))
    got = spark.read.parquet(os.path.join(work, "ema")).filter("sensorId != 999999")
    assert _flat_rows(got) == _flat_rows(expect)

    sl_expect = localize_temperature(sliding_average(temps, 36_000_000, 3_600_000))
    key = lambda r: (r["sensorId"], r["windowStart"], r["count"], round(r["value"], 9), r["timestamp"])
    sl_got = spark.read.parquet(os.path.join(work, "sliding")).filter("sensorId != 999999")
    assert sorted(map(key, sl_got.collect())) == sorted(
        map(key, sl_expect.select("windowStart", "count", "sensor.sensorId", "measurement.*").collect()))


def test_us_temperature_gauges_observed(spark):
    temps = extended_measurements(spark, SMALL).filter("sensor.sensorType = 'Temperature'")
    pdf = flatten(temps).toPandas()
    pdf["accuracy"] = pdf["accuracy"].astype("float32")
    work = tempfile.mkdtemp(prefix="tidemark-gauge-")
    write_numbered(pdf, os.path.join(work, "src"), 2)
    stream = nest(spark.readStream.schema(FLAT_SCHEMA).option("maxFilesPerTrigger", 1)
                  .parquet(os.path.join(work, "src")))
    q = start(flatten(sensor_streams(stream, watermark_ms=0).temperature), "temps_gauge", sink="noop",
              checkpoint=os.path.join(work, "ck"), trigger=AVAILABLE_NOW)
    q.awaitTermination(600)
    batches = [p for p in q.recentProgress if p.numInputRows > 0]
    assert len(batches) == 2
    from tidemark.functions.geo import is_in_us
    from pyspark.sql import functions as F
    us = temps.filter(is_in_us("location.longitude", "location.latitude"))
    c_max = us.agg(F.max("measurement.value")).first()[0]
    assert max(p.observedMetrics["sourceTemperatureUS"]["max"] for p in batches) == c_max
    assert max(p.observedMetrics["normalizedTemperatureUS"]["max"] for p in batches) == c_max * 9.0 / 5.0 + 32


def test_late_tagger_resumes_after_restart(spark):
    """Stop after part of the input, restart on the same checkpoint: the
    carried watermark state continues, outputs equal one uninterrupted run."""
    rec = kafka_records(spark, MEDIUM, DAY.skew_ms).drop("poison")
    pdf = rec.toPandas().sort_values("seq")
    work = tempfile.mkdtemp(prefix="tidemark-restart-")
    src = os.path.join(work, "src")
    late, on_time, state = (os.path.join(work, d) for d in ("late", "ontime", "state"))
    half = len(pdf) // 2
    nxt = write_numbered(pdf.iloc[:half], src, 3, schema=RECORD_ARROW)

    def run():
        q = start_batches(read_record_files(spark, src, max_files_per_trigger=1), "tagger_restart",
                          LateTagger(DAY, late, on_time, state),
                          checkpoint=os.path.join(work, "ck"), trigger=AVAILABLE_NOW)
        q.awaitTermination(600)

    run()
    write_numbered(pdf.iloc[half:], src, 3, start_index=nxt, schema=RECORD_ARROW)
    run()
    batch = location_pipeline(kafka_records(spark, MEDIUM, DAY.skew_ms), DAY)
    got_late = sorted((r["seq"], r["watermark"]) for r in spark.read.parquet(late).collect())
    assert got_late == sorted((r["seq"], r["watermark"]) for r in batch.late.collect())
    assert spark.read.parquet(on_time).count() + len(got_late) == len(pdf)


def test_stateless_fan_out_reads_each_batch_once(spark):
    from tidemark.functions.records import localize_temperature, localize_wind
    from tidemark.streaming.sensors import StatelessFanOut

    em = extended_measurements(spark, SMALL)
    pdf = flatten(em).toPandas()
    pdf["accuracy"] = pdf["accuracy"].astype("float32")
    work = tempfile.mkdtemp(prefix="tidemark-fan-")
    write_numbered(pdf, os.path.join(work, "src"), 3)
    stream = nest(spark.readStream.schema(FLAT_SCHEMA).option("maxFilesPerTrigger", 1)
                  .parquet(os.path.join(work, "src")))
    q = start_batches(stream, "fan_out", StatelessFanOut(os.path.join(work, "out")),
                      checkpoint=os.path.join(work, "ck"), trigger=AVAILABLE_NOW)
    q.awaitTermination(600)
    key = lambda r: (r["seq"], round(r["value"], 9))
    for name, expect in (("temperature", localize_temperature(em.filter("sensor.sensorType = 'Temperature'"))),
                         ("wind", localize_wind(em.filter("sensor.sensorType = 'Wind'")))):
        got = spark.read.parquet(os.path.join(work, "out", name))
        assert sorted(map(key, flatten(got).collect())) == sorted(map(key, flatten(expect).collect())), name


def _emitting_tagger(work):
    names = ("late", "ontime", "state", "windows", "invalid")
    late, on_time, state, windows, invalid = (os.path.join(work, d) for d in names)
    return LateTagger(DAY, late, on_time, state, windows_path=windows, invalid_path=invalid), windows, invalid


def test_emitted_windows_survive_replay_and_split(spark):
    """Every batch twice, once failing before its state is written; the windows
    equal the batch pipeline's, each emitted once."""
    rec = kafka_records(spark, SMALL, DAY.skew_ms).drop("poison").cache()
    n = rec.count()
    far = spark.createDataFrame([(10 ** 9, FAR, FAR, None, bytearray(b'{"location": "FUTURE"}'), 1)],
                                "seq long, arrival_ms long, timestamp long, key binary, value binary, partition int")
    tagger, windows, invalid = _emitting_tagger(tempfile.mkdtemp(prefix="tidemark-emit-"))
    cuts = [0, n // 4, n // 4, n // 2, n]          # the second batch is empty
    low = rec.selectExpr("min(seq)").first()[0]
    batches = [rec.where(f"seq - {low} >= {lo} AND seq - {low} < {hi}") for lo, hi in zip(cuts, cuts[1:])]
    for i, batch in enumerate([*batches, far.select(*rec.columns)]):
        keep, tagger.state_path = tagger.state_path, "/proc/nowhere" if i == 0 else tagger.state_path
        if i == 0:
            with pytest.raises(Exception):
                tagger(batch, i)                   # all outputs written, the state not
        tagger.state_path = keep
        tagger(batch, i)
        tagger(batch, i)
    expect = location_pipeline(kafka_records(spark, SMALL, DAY.skew_ms), DAY)
    assert _windows(spark.read.parquet(windows).collect()) == _windows(expect.main.collect())
    bad = {r["seq"] for r in expect.invalid.collect()} - {r["seq"] for r in expect.late.collect()}
    assert {r["seq"] for r in spark.read.parquet(invalid).collect()} == bad
    rec.unpersist()


def test_lost_open_windows_raise(spark):
    rec = kafka_records(spark, SMALL, DAY.skew_ms).drop("poison").limit(5)
    tagger, _, _ = _emitting_tagger(tempfile.mkdtemp(prefix="tidemark-lost-"))
    tagger(rec, 0)
    tagger.open_path += "-elsewhere"
    with pytest.raises(RuntimeError, match="open windows"):
        tagger(rec, 1)
    with pytest.raises(ValueError):
        LateTagger(DAY, "a", "b", "c", idle_timeout_ms=5)
