"""Watermark trace, late rows, idle partitions."""

from __future__ import annotations

import pytest

import random

from tidemark.operators.watermark import last_seen, partition_activity, watermark_trace
from tidemark.plans.location import location_pipeline
from tidemark.presets import DAY
from tidemark.sources.fixtures import kafka_records

from conftest import MEDIUM


def _df(spark, rows):
    return spark.createDataFrame(rows, "seq long, timestamp long, partition int")


def _brute(rows, delay, window, scope="global", parts=range(8), init=None):
    out, seen = {}, dict(init or {})
    for seq, ts, p in sorted(rows):
        if scope == "global":
            m = seen.get("all")
        else:
            vals = [seen[f"p{q}"] for q in parts if seen.get(f"p{q}") is not None]
            m = min(vals) if vals else None
        wm = None if m is None else m - delay
        end = ts - ts % window + window
        out[seq] = (wm, end, wm is not None and end - 1 <= wm)
        key = "all" if scope == "global" else f"p{p}"
        seen[key] = ts if seen.get(key) is None else max(seen[key], ts)
    return out


def _got(df):
    return {r["seq"]: (r["watermark"], r["windowEnd"], r["late"]) for r in df.collect()}


def test_late_edges(spark):
    # window 1000, delay 0: first row sets max 1999 -> wm 1999
    rows = [(0, 1999, 1), (1, 1000, 1),   # windowEnd-1 = 1999 == wm -> late
            (2, 998, 1),                   # window [0,1000): 999 <= 1999 -> late
            (3, 2000, 1)]                  # window ends 3000: on time
    got = _got(watermark_trace(_df(spark, rows), 0, 1000))
    assert got[0] == (None, 2000, False)
    assert got[1] == (1999, 2000, True)
    assert got[2] == (1999, 1000, True)
    assert got[3] == (1999, 3000, False)
    # one below the edge: wm 1998 -> window [1000,2000) still open
    got = _got(watermark_trace(_df(spark, rows), 1, 1000))
    assert got[1] == (1998, 2000, False)


def test_trace_matches_brute_force_across_buckets(spark):
    rnd = random.Random(11)
    rows = [(i, 10_000 + i * 10 + rnd.randint(-400, 0) - 50 * p, p)
            for i, p in ((i, rnd.choice([1, 2, 3, 5, 6, 7])) for i in range(700))]
    df = _df(spark, rows)
    for scope in ("global", "partition"):
        expect = _brute(rows, 250, 1000, scope)
        for bucket_rows, per_super in ((1 << 20, 1 << 12), (64, 1 << 12), (7, 3), (5, 1)):
            got = _got(watermark_trace(df, 250, 1000, scope=scope, partitions=range(8),
                                       bucket_rows=bucket_rows, buckets_per_super=per_super))
            assert got == expect, (scope, bucket_rows, per_super)


def test_initial_max_carries_state(spark):
    rows = [(10, 500, 1), (11, 400, 2)]
    got = _got(watermark_trace(_df(spark, rows), 0, 100, initial_max={"all": 1000}))
    assert got == _brute(rows, 0, 100, init={"all": 1000})
    assert got[10] == (1000, 600, True)
    seen = last_seen(_df(spark, rows), scope="partition", partitions=[1, 2]).first().asDict()
    assert seen == {"p1": 500, "p2": 400}


def test_idle_partitions(spark):
    rows = [(0, 100, 1, 100), (1, 200, 2, 5_000), (2, 300, 2, 10_000)]
    df = spark.createDataFrame(rows, "seq long, timestamp long, partition int, arrival_ms long")
    got = {r["partition"]: (r["rows"], r["idle"]) for r in partition_activity(df, 4, 1000).collect()}
    assert got == {0: (0, True), 1: (1, True), 2: (2, False), 3: (0, True)}
    got = {r["partition"]: r["idle"] for r in partition_activity(df, 4, 1000, clock_ms=100_000).collect()}
    assert got == {0: True, 1: True, 2: True, 3: True}


def test_pipeline_outputs_partition_input(spark):
    rec = kafka_records(spark, MEDIUM, DAY.skew_ms)
    out = location_pipeline(rec, DAY)
    n_rec = rec.count()
    n_late = out.late.count()
    n_invalid = out.invalid.count()
    assert n_late > 0 and n_invalid > 0
    assert out.observation is not None
    on_time_valid = out.main.agg({"eventsPerWindow": "sum"}).first()[0]
    # every record is either late, undecodable, or counted in a window
    late_invalid = out.late.join(out.invalid.select("seq"), "seq").count()
    assert on_time_valid + n_late + n_invalid - late_invalid == n_rec


def test_tagger_batches_equal_one_trace_both_scopes(spark):
    """The stream tagger, fed the same rows in three micro-batches, tags every
    record as the one-shot trace does (state carried between batches)."""
    import os
    import tempfile

    from tidemark.presets import Preset
    from tidemark.streaming.location import LateTagger

    rnd = random.Random(21)
    rows = [(i, 1_000 + i * 10 + rnd.randint(-3000, 0) - 60 * p, p, bytearray(b"{}"))
            for i, p in ((i, rnd.choice([1, 2, 3, 5, 6, 7])) for i in range(600))]
    df = spark.createDataFrame(rows, "seq long, timestamp long, partition int, value binary")
    preset = Preset(window_ms=1000, out_of_orderness_ms=250, skew_ms=0, idle_timeout_ms=1000)
    for scope in ("global", "partition"):
        work = tempfile.mkdtemp(prefix="tidemark-tagger-")
        late, on_time, state = (os.path.join(work, d) for d in ("late", "ontime", "state"))
        tagger = LateTagger(preset, late, on_time, state, scope=scope, partitions=range(8))
        for batch_id, (lo, hi) in enumerate([(0, 150), (150, 151), (151, 600)]):
            tagger(df.filter(f"seq >= {lo} AND seq < {hi}"), batch_id)
        tagger(df.filter("seq < 0"), 3)                     # an empty batch keeps the state
        expect = _got(watermark_trace(df, 250, 1000, scope=scope, partitions=range(8)))
        got_late = {r["seq"]: r["watermark"] for r in spark.read.parquet(late).collect()}
        got_on = {r["seq"]: r["watermark"] for r in spark.read.parquet(on_time).collect()}
        assert set(got_late) == {s for s, v in expect.items() if v[2]}, scope
        assert set(got_on) == {s for s, v in expect.items() if not v[2]}, scope
        assert all(expect[s][0] == w for s, w in {**got_late, **got_on}.items()), scope
        assert os.path.isdir(os.path.join(state, "batch=3"))
        assert len(got_late) > 0


def test_tagger_orders_kafka_frames_by_arrival(spark):
    """Kafka-shaped input (offsets per partition, no global sequence): the
    tagger ranks (arrival_ms, partition, offset) and tags as the trace over
    that order does."""
    import os
    import tempfile

    from pyspark.sql import functions as F
    from pyspark.sql import Window

    from tidemark.operators.watermark import with_arrival_order
    from tidemark.presets import Preset
    from tidemark.sources.kafka import KAFKA_ORDER
    from tidemark.streaming.location import LateTagger

    rnd = random.Random(5)
    rows, offsets = [], {}
    for i in range(400):
        p = rnd.choice([1, 2, 3])
        arrival = 1_000 + i * 7 // 3            # ties in arrival time across partitions
        offsets[p] = offsets.get(p, -1) + 1
        rows.append((arrival, arrival - rnd.randint(0, 2500), p, offsets[p], bytearray(b"{}")))
    df = spark.createDataFrame(rows, "arrival_ms long, timestamp long, partition int, offset long, value binary")
    ranked, handle = with_arrival_order(df, KAFKA_ORDER)
    brute = df.withColumn("seq", F.row_number().over(Window.orderBy(*KAFKA_ORDER)) - 1)
    assert sorted(ranked.select("seq", *KAFKA_ORDER).collect()) == sorted(brute.select("seq", *KAFKA_ORDER).collect())
    handle.unpersist()

    work = tempfile.mkdtemp(prefix="tidemark-kafka-")
    late, on_time, state = (os.path.join(work, d) for d in ("late", "ontime", "state"))
    tagger = LateTagger(Preset(1000, 250, 0, 1000), late, on_time, state, order_cols=KAFKA_ORDER)
    tagger(df.filter("arrival_ms < 1400"), 0)
    tagger(df.filter("arrival_ms >= 1400"), 1)
    expect = {(r["partition"], r["offset"]): r["late"]
              for r in watermark_trace(brute, 250, 1000).collect()}
    got = {(r["partition"], r["offset"]): True for r in spark.read.parquet(late).collect()}
    got.update({(r["partition"], r["offset"]): False for r in spark.read.parquet(on_time).collect()})
    assert got == expect
    assert any(expect.values())


def test_tagger_refuses_to_run_without_its_state(spark):
    import os
    import tempfile

    from tidemark.presets import Preset
    from tidemark.streaming.location import LateTagger

    rows = [(0, 5_000, 1, bytearray(b"{}")), (1, 3_000, 1, bytearray(b"{}"))]
    df = spark.createDataFrame(rows, "seq long, timestamp long, partition int, value binary")
    work = tempfile.mkdtemp(prefix="tidemark-fallback-")
    late, on_time, state = (os.path.join(work, d) for d in ("late", "ontime", "state"))
    tagger = LateTagger(Preset(1000, 0, 0, 1000), late, on_time, state)
    tagger(df.filter("seq = 0"), 0)
    with pytest.raises(RuntimeError, match="state"):
        tagger(df.filter("seq = 1"), 2)      # batch 1 left no state


def test_partition_scope_reads_partitions_from_the_data(spark):
    rows = [(0, 1_000, 9), (1, 400, 12), (2, 5_000, 12), (3, 100, 9)]
    df = spark.createDataFrame(rows, "seq long, timestamp long, partition int")
    got = {r["seq"]: r["watermark"] for r in watermark_trace(df, 0, 1000, scope="partition").collect()}
    assert got == {0: None, 1: 1_000, 2: 400, 3: 1_000}
    acts = spark.createDataFrame([(0, 1, 9, 5)], "seq long, timestamp long, partition int, arrival_ms long")
    assert {r["partition"]: r["rows"] for r in partition_activity(acts, 2, 10).collect()} == {0: 0, 1: 0, 9: 1}
    with pytest.raises(ValueError):
        watermark_trace(df, -1, 1000)
    with pytest.raises(ValueError):
        partition_activity(acts, 2, -1)


from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(-3000, 0), st.sampled_from([1, 2, 3, 5, 6, 7])),
                min_size=50, max_size=250),
       st.integers(1, 40), st.integers(1, 5), st.sampled_from(["global", "partition"]),
       st.integers(0, 500), st.sampled_from([100, 1000, 5000]))
def test_trace_property(spark, jitter, bucket_rows, per_super, scope, delay, window):
    rows = [(i, 100_000 + i * 37 + j, p) for i, (j, p) in enumerate(jitter)]
    got = _got(watermark_trace(_df(spark, rows), delay, window, scope=scope, partitions=range(8),
                               bucket_rows=bucket_rows, buckets_per_super=per_super))
    assert got == _brute(rows, delay, window, scope)


def _brute_idle(rows, delay, window, idle):
    """rows: (seq, event time, partition, arrival), in order."""
    out, largest, last = {}, {}, {}
    for seq, ts, p, now in rows:
        vals = [max(m, now) if now - last[q] > idle else m for q, m in largest.items()]
        wm = min(vals) - delay if vals else None
        end = ts - ts % window + window
        out[seq] = (wm, end, wm is not None and end - 1 <= wm)
        event = max(ts, now) if p in last and now - last[p] > idle else ts
        largest[p] = max(largest.get(p, event), event)
        last[p] = now
    return out


def test_silent_partition_stops_holding_the_watermark(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(400):
        p = rnd.choice([1, 2, 12]) if i < 100 or i >= 300 else rnd.choice([1, 2])   # 12 pauses
        rows.append((i, 5_000 + i * 20 - rnd.randint(0, 600), p, 5_000 + i * 20))
    df = spark.createDataFrame(rows, "seq long, timestamp long, partition int, arrival_ms long")
    for idle in (0, 200, 1_000, 10**9):
        for bucket_rows in (1 << 13, 7):
            got = _got(watermark_trace(df, 250, 1000, scope="partition", idle_timeout_ms=idle,
                                       bucket_rows=bucket_rows, buckets_per_super=3))
            assert got == _brute_idle(rows, 250, 1000, idle), (idle, bucket_rows)
    held = _got(watermark_trace(df, 250, 1000, scope="partition"))
    free = _got(watermark_trace(df, 250, 1000, scope="partition", idle_timeout_ms=1_000))
    assert held[299][0] < 7_000 < free[299][0]
    with pytest.raises(ValueError):
        watermark_trace(df, 0, 1000, idle_timeout_ms=-1)
    with pytest.raises(ValueError):
        watermark_trace(df, 0, 1000, idle_timeout_ms=1, initial_max={"all": 1})
