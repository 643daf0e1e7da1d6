"""Carried state: every handler equals its batch twin over any split, with
replays and a restart (a new handler object on the same folders)."""

from __future__ import annotations

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from tidemark.functions.records import localize_temperature
from tidemark.operators.ema import ema_window
from tidemark.operators.process_window import ProcessWindows, process_windows
from tidemark.operators.stats import interval_stats, lag_histogram, lifetime_extremes
from tidemark.operators.windows import sliding_average, tumbling_sum_count
from tidemark.presets import Preset
from tidemark.schemas import SENSOR_KEY
from tidemark.sources.fixtures import extended_measurements
from tidemark.streaming.carried import Carried
from tidemark.streaming.handlers import EmaBatches, IntervalGauges, LagHistory, SensorOutputs, SlidingPanes
from tidemark.streaming.location import LateTagger, for_each_committed
from tidemark.streaming.metrics import CounterListener, counter_total
from tidemark.streaming.sensors import FLAT_SCHEMA, flatten, nest
from tidemark.streaming.sinks import start, start_batches

from conftest import SMALL
from test_partition_watermark import brute, made

AVAILABLE_NOW = {"availableNow": True}


def work():
    return tempfile.mkdtemp(prefix="tidemark-state-")


def play(make, batches, replay=1):
    """Run a handler over batches; batch ``replay`` twice; a new object per batch."""
    for k, batch in enumerate(batches):
        make()(batch, k)
        if k == replay:
            make()(batch, k)
    return len(batches) - 1


@pytest.mark.parametrize("cuts", [[0, 40], [0, 3, 3, 25, 40]])
def test_lag_history(spark, cuts):
    rng = random.Random(1)
    rows = [(1_000 * (k // 3), f"place{k % 3}", rng.random()) for k in range(40)]
    schema = "windowEnd long, location string, x double"
    folder = work()
    last = play(lambda: LagHistory(folder, history=12, clock=lambda _: 50_000),
                [spark.createDataFrame(rows[a:b], schema) for a, b in zip(cuts, cuts[1:])])
    got = LagHistory(folder, 12).statistics(spark, last).first()
    assert got == lag_histogram(spark.createDataFrame(rows, schema), F.lit(50_000), history=12).first()
    assert got["n"] == 12
    with pytest.raises(RuntimeError, match="missing"):
        LagHistory(folder, 12)(spark.createDataFrame(rows[:1], schema), 90)


def test_interval_gauges(spark):
    rng = random.Random(5)
    rows = [(k * 7 + rng.randrange(40), None if k % 9 == 0 else rng.gauss(1e6, 3.0), rng.random()) for k in range(300)]
    schema = "ts long, a double, b double"
    metrics = {"a": F.col("a"), "b": F.col("b")}
    out, state = work(), os.path.join(work(), "s")
    cuts = [0, 1, 50, 50, 200, 300]
    batches = [spark.createDataFrame(rows[a:b], schema) for a, b in zip(cuts, cuts[1:])]
    batches.append(spark.createDataFrame([(10 ** 6, 0.0, 0.0)], schema))
    play(lambda: IntervalGauges(out, state, 100, "ts", metrics, out_of_orderness_ms=60), batches)
    want = {r["intervalStart"]: r.asDict() for r in lifetime_extremes(
        interval_stats(spark.createDataFrame(rows, schema), 100, "ts", metrics), ["a", "b"]).collect()}
    got = spark.read.parquet(out).collect()
    assert len(got) == len(want)
    for r in got:
        for name, value in want[r["intervalStart"]].items():
            assert r[name] == value or abs(r[name] - value) <= 1e-7 * max(1.0, abs(value)), name


def sensor_rows(spark):
    temps = extended_measurements(spark, SMALL).filter("sensor.sensorType = 'Temperature'").cache()
    low, n = temps.agg(F.min("seq"), F.count("*")).first()
    order = [r["seq"] for r in temps.select("seq").orderBy("seq").collect()]
    return temps, order


def test_ema_batches(spark):
    """Batches split by time, a hot key, keys first met late, a one-row batch."""
    rng = random.Random(2)
    rows = [(k, 1 if rng.random() < 0.6 else rng.randrange(2, 9), 7, "Temperature", 1.0, 2.0, 3.0,
             None if k % 11 == 0 else rng.gauss(20, 5), rng.random(), 1_000 + k // 2) for k in range(400)]
    schema = FLAT_SCHEMA
    nested = nest(spark.createDataFrame(rows, schema))
    out, state = work(), work()
    cuts = [0, 1, 2, 150, 150, 152, 400]
    play(lambda: EmaBatches(out, state), [nest(spark.createDataFrame(rows[a:b], schema)) for a, b in zip(cuts, cuts[1:])], 3)

    def key(df):
        return sorted((r["seq"], r["sensorId"], round(r["value"], 9), round(r["accuracy"], 4), r["timestamp"])
                      for r in flatten(df).collect())
    assert key(spark.read.parquet(out)) == key(ema_window(nested, SENSOR_KEY))


def test_sliding_panes_and_one_read_for_all_outputs(spark):
    """The stream of all sensor outputs reads its source once and equals the batch forms."""
    records = extended_measurements(spark, SMALL)
    pdf = flatten(records).toPandas().sort_values("timestamp")
    pdf["accuracy"] = pdf["accuracy"].astype("float32")
    from streamdata import write_numbered
    folder = work()
    src, root, state = (os.path.join(folder, n) for n in ("src", "out", "state"))
    pdf = pdf.reset_index(drop=True)
    pdf["seq"] = pdf.index                       # arrival in order of time
    half = len(pdf) // 2
    sliding = (36_000_000, 3_600_000)

    def run():
        stream = nest(spark.readStream.schema(FLAT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(src))
        q = start_batches(stream, "all_outputs", SensorOutputs(root, state, sliding, out_of_orderness_ms=0),
                          checkpoint=os.path.join(folder, "ck"), trigger=AVAILABLE_NOW)
        q.awaitTermination(600)
        assert len(q.recentProgress[-1].sources) == 1
        return sum(p.numInputRows for p in q.recentProgress)
    nxt = write_numbered(pdf.iloc[:half], src, 2)
    read = run()
    far = pdf.iloc[-1:].assign(seq=10 ** 9, sensorId=999_999, sensorType="Temperature", timestamp=4_000_000_000_000)
    nxt = write_numbered(pdf.iloc[half:], src, 2, start_index=nxt)
    write_numbered(far, src, 1, start_index=nxt)
    assert read + run() == len(pdf) + 1

    whole = nest(spark.createDataFrame(pdf[[c.split()[0] for c in FLAT_SCHEMA.split(", ")]], FLAT_SCHEMA))
    temps = whole.filter("sensor.sensorType = 'Temperature'")

    def flat(df):
        return sorted((r["seq"], r["sensorId"], round(r["value"], 9), r["timestamp"]) for r in flatten(df).collect()
                      if r["sensorId"] != 999_999)
    out = {n: spark.read.parquet(os.path.join(root, n)) for n in ("temperature", "ema", "sliding", "wind", "unrouted")}
    assert flat(out["temperature"]) == flat(localize_temperature(temps))
    assert flat(out["ema"]) == flat(localize_temperature(ema_window(temps, SENSOR_KEY)))

    def windows(df):
        return sorted((r["sensor"]["sensorId"], r["windowStart"], r["count"], round(r["measurement"]["value"], 9),
                       r["measurement"]["timestamp"]) for r in df.collect() if r["sensor"]["sensorId"] != 999_999)
    assert windows(out["sliding"]) == windows(localize_temperature(sliding_average(temps, *sliding)))
    assert out["wind"].count() + out["unrouted"].count() + out["temperature"].count() == len(pdf) + 1
    panes = Carried(os.path.join(state, "sliding-panes"), "pane BIGINT").at(spark, 4)
    assert panes.count() == 1                    # only the far row's pane is left open


RECORDS = "seq long, timestamp long, partition int, arrival_ms long, value binary"


def payloads(rows):
    return [(s, t, p, a, bytearray(b'{"value": 1.5, "location": "L%d"}' % (s % 3))) for s, t, p, a in rows]


@pytest.mark.parametrize("idle", [None, 50])
def test_partition_tagger_equals_one_trace(spark, idle):
    """Windows under partition scope: any split, replays, a partition that appears
    late and one that falls silent; every window once to a consumer stream."""
    rows = made(400, 5, 21)
    rows += [(400 + k, 1_500 + 3 * k, 1 + k % 2, 3_000 + 3 * k) for k in range(60)]       # 9 never, 3 and 4 silent
    rows += [(460, 100, 9, 3_300), (461, 3_400, 9, 3_300)]
    preset = Preset(window_ms=100, out_of_orderness_ms=20, skew_ms=0, idle_timeout_ms=0)
    want = brute(rows, 20, 100, idle, monotone=True)
    folder = work()
    late, on_time, state, windows = (os.path.join(folder, n) for n in ("late", "on", "state", "win"))
    cuts = [0, 1, 200, 200, 430, 462]
    batches = [spark.createDataFrame(payloads(rows[a:b]), RECORDS) for a, b in zip(cuts, cuts[1:])]
    seen = []

    def consume():
        q = for_each_committed(spark, windows, lambda df, _: seen.extend(df.collect()), "consumer",
                               checkpoint=os.path.join(folder, "ck"), trigger=AVAILABLE_NOW)
        q.awaitTermination(300)
    for k, batch in enumerate(batches):
        tagger = LateTagger(preset, late, on_time, state, scope="partition", windows_path=windows, idle_timeout_ms=idle, keep=3)
        tagger(batch, k)
        if k in (1, 3):
            consume()
            tagger(batch, k)                     # a replay after the consumer has read the batch
    consume()
    got = {}
    for path, flag in ((late, True), (on_time, False)):
        got |= {r["seq"]: (r["watermark"], r["windowEnd"], flag) for r in spark.read.parquet(path).collect()}
    assert got == want
    kept = [r for r in payloads(rows) if not want[r[0]][2]]
    last = max(w for w, _, _ in want.values() if w is not None)
    sums = tumbling_sum_count(spark.createDataFrame([(r[0], r[1], "L%d" % (r[0] % 3), 1.5) for r in kept],
                                                    "seq long, timestamp long, location string, value double"), 100)
    closed = sorted((r["windowStart"], r["location"], r["eventsPerWindow"]) for r in sums.collect() if r["windowEnd"] - 1 <= last)
    found = sorted((r["windowStart"], r["location"], r["eventsPerWindow"]) for r in seen)
    assert closed and [f for f in found if f[0] + 99 <= last] == closed and len(set(f[:2] for f in found)) == len(found)
    assert sorted(os.listdir(state))[0] != "batch=0"        # old state is gone


def test_clock_closes_windows_without_records(spark):
    folder = work()
    paths = [os.path.join(folder, n) for n in ("late", "on", "state")]
    preset = Preset(window_ms=100, out_of_orderness_ms=0, skew_ms=0, idle_timeout_ms=0)
    ticks = iter([1_000, 9_999, 5_000])

    def tagger():
        return LateTagger(preset, *paths, scope="partition", windows_path=os.path.join(folder, "win"), idle_timeout_ms=50,
                          clock=lambda _: next(ticks))
    rows = payloads([(0, 1_010, 1, 1_000), (1, 1_020, 2, 1_000)])
    tagger()(spark.createDataFrame(rows, RECORDS), 0)
    assert spark.read.parquet(os.path.join(folder, "win")).count() == 0
    nothing = spark.createDataFrame([], RECORDS)
    tagger()(nothing, 1)
    tagger()(nothing, 1)                          # the noted clock, not another tick
    assert spark.read.parquet(os.path.join(folder, "win")).count() == 2
    assert next(ticks) == 5_000


def user_functions():
    """Made inside a function, so that they travel to the workers by value."""
    def sum_of(key, window, rows):
        total, n, first = 0.0, 0, None
        for r in rows:
            first = r["seq"] if first is None else first
            total, n = total + r["value"], n + 1
        yield {"eventsPerWindow": n, "sumPerWindow": total, "first": first}

    def take_one(key, window, rows):
        row = next(rows)
        yield {"first": row["seq"]}
        yield {"first": -row["seq"]}
    return sum_of, take_one


def test_process_windows(spark):
    sum_of, take_one = user_functions()
    rng = random.Random(9)
    rows = [(k, k * 5 + rng.randrange(30), None if k % 50 == 0 else f"L{rng.randrange(4) if k % 3 else 0}", float(k % 7))
            for k in range(600)]
    schema = "seq long, timestamp long, location string, value double"
    df = spark.createDataFrame(rows, schema)
    out_schema = "eventsPerWindow long, sumPerWindow double, first long"
    got = process_windows(df, 200, sum_of, out_schema)
    want = {(r["windowStart"], r["location"]): (r["eventsPerWindow"], r["sumPerWindow"])
            for r in tumbling_sum_count(df, 200).collect()}

    def table(frame):
        return {(r["windowStart"], r["location"]): (r["eventsPerWindow"], r["sumPerWindow"]) for r in frame.collect()}
    assert table(got) == want and got.count() == len(want)
    first = {(t // 200 * 200, loc): s for t, s, loc in sorted(((t, s, loc) for s, t, loc, _ in rows), reverse=True, key=lambda x: x[:2])}
    assert {(r["windowStart"], r["location"]): r["first"] for r in got.collect()} == first
    assert process_windows(df, 200, take_one, "first long").count() == 2 * len(want)
    out, state = work(), work()
    cuts = [0, 10, 10, 300, 600]
    batches = [spark.createDataFrame(rows[a:b], schema) for a, b in zip(cuts, cuts[1:])]
    batches.append(spark.createDataFrame([(9_999, 10 ** 6, "far", 0.0)], schema))
    play(lambda: ProcessWindows(out, state, 200, sum_of, out_schema, row_schema=schema, out_of_orderness_ms=40), batches)
    assert table(spark.read.parquet(out)) == want
    assert process_windows(df.where("false"), 200, sum_of, out_schema).collect() == []


def test_invalid_counter_adds_up_over_restarts(spark):
    from streamdata import write_numbered
    from tidemark.operators.decode import tolerant_decode
    import pandas as pd
    import pyarrow as pa
    arrow = pa.schema([("seq", pa.int64()), ("timestamp", pa.int64()), ("partition", pa.int32()), ("value", pa.binary())])
    folder = work()
    good, bad = b'{"value": 1, "location": "A"}', b"{"
    pdf = pd.DataFrame({"seq": range(60), "timestamp": 0, "partition": 1,
                        "value": [bad if k % 7 == 0 else good for k in range(60)]})
    src, notes = os.path.join(folder, "src"), os.path.join(folder, "notes")
    listener = CounterListener(spark, notes, queries=["counted"])
    spark.streams.addListener(listener)

    def run():
        stream = (spark.readStream.schema("seq long, timestamp long, partition int, value binary")
                  .option("maxFilesPerTrigger", 1).parquet(src))
        q = start(tolerant_decode(stream).valid, "counted", sink="noop", checkpoint=os.path.join(folder, "ck"),
                  trigger=AVAILABLE_NOW)
        q.awaitTermination(300)
        return q.recentProgress
    try:
        nxt = write_numbered(pdf.iloc[:30], src, 2, schema=arrow)
        run()
        write_numbered(pdf.iloc[30:], src, 2, start_index=nxt, schema=arrow)
        run()
        import time
        for _ in range(100):                     # progress events arrive behind the query
            if counter_total(spark, notes) == 9:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    assert counter_total(spark, notes) == 9 == sum(k % 7 == 0 for k in range(60))
    for _ in range(2):                           # a replayed batch (rows 45-59: 49 and 56) reports again
        listener.note("counted", 3, {"numInvalidRecords": 2})
    assert counter_total(spark, notes, query="counted") == 9
    assert counter_total(spark, notes, query="other") == 0
