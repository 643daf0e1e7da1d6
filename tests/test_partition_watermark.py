"""Watermark of the slowest partition in long form: brute force, many
partitions, any split, silent partitions."""

from __future__ import annotations

import random

import pytest

from tidemark.operators.partition_watermark import partition_trace
from tidemark.operators.watermark import watermark_trace

SCHEMA = "seq long, timestamp long, partition int, arrival_ms long"


def brute(rows, delay, window, idle=None, monotone=False):
    top, last, out, best = {}, {}, {}, None
    for seq, ts, p, now in rows:
        seen = []
        for q, m in top.items():
            silent = idle is not None and now is not None and last.get(q) is not None and now - last[q] > idle
            seen.append(max(m, now) if silent else m)
        w = min(seen) - delay if seen else None
        if monotone:
            best = w if best is None else best if w is None else max(best, w)
            w = best
        end = ts // window * window + window
        out[seq] = (w, end, w is not None and end - 1 <= w)
        if p is None:
            continue
        gap = None if now is None or last.get(p) is None else now - last[p]
        event = max(ts, now) if idle is not None and gap is not None and gap > idle else ts
        top[p] = max(top.get(p, event), event)
        if now is not None:
            last[p] = max(last.get(p, now), now)
    return out


def made(n, partitions, seed, jitter=3, with_nulls=True):
    rng, rows, now = random.Random(seed), [], 1_000
    for k in range(n):
        now += rng.choice((0, 1, 1, 2, 400 if rng.random() < 0.02 else 1))
        p = rng.randrange(partitions)
        if rng.random() < 0.5:
            p = 0                                   # a hot partition
        arrival = now - rng.randrange(jitter + 1)
        rows.append((k, now - rng.randrange(300), None if with_nulls and rng.random() < 0.02 else p,
                     None if with_nulls and rng.random() < 0.02 else arrival))
    return rows


def got(df):
    return {r["seq"]: (r["watermark"], r["windowEnd"], r["late"]) for r in df.collect()}


@pytest.mark.parametrize("idle, monotone", [(None, True), (50, False), (50, True)])
def test_equals_brute_force_whole_and_split(spark, idle, monotone):
    rows = made(700, 12, 7)
    want = brute(rows, 20, 100, idle, monotone)
    df = spark.createDataFrame(rows, SCHEMA)
    kw = dict(idle_timeout_ms=idle, monotone=monotone, bucket_rows=64, buckets_per_super=3)
    assert got(partition_trace(df, 20, 100, **kw)[0]) == want
    carried, watermark, found = None, None, {}
    for lo, hi in ((0, 1), (1, 130), (130, 130), (130, 700)):
        part = spark.createDataFrame(rows[lo:hi], SCHEMA)
        traced, state = partition_trace(part, 20, 100, carried=carried, carried_watermark=watermark, **kw)
        found |= got(traced)
        watermark = max([w for w, _, _ in found.values() if w is not None], default=None) if monotone else None
        carried = spark.createDataFrame(state.collect(), state.schema)
    assert found == want


def test_agrees_with_the_columns_form(spark):
    rows = made(500, 6, 11, jitter=0, with_nulls=False)
    df = spark.createDataFrame(rows, SCHEMA)
    for idle in (None, 40):
        columns = got(watermark_trace(df, 20, 100, scope="partition", idle_timeout_ms=idle))
        assert got(partition_trace(df, 20, 100, idle_timeout_ms=idle)[0]) == columns == brute(rows, 20, 100, idle)


def test_thousands_of_partitions(spark):
    """5,000 partitions; the plan does not grow with them."""
    rows = made(12_000, 5_000, 3)
    df = spark.createDataFrame(rows, SCHEMA)
    traced, state = partition_trace(df, 20, 100, idle_timeout_ms=2_000, bucket_rows=2_048)
    assert got(traced) == brute(rows, 20, 100, 2_000)
    few = partition_trace(spark.createDataFrame(made(50, 3, 1), SCHEMA), 20, 100, idle_timeout_ms=2_000, bucket_rows=2_048)

    def size(frame):
        return len(frame._jdf.queryExecution().analyzed().toString().splitlines())
    assert size(traced) == size(few[0])
    assert state.count() == len({r[2] for r in rows} - {None})


def test_many_partitions_through_the_common_entry(spark):
    rows = made(900, 200, 5, with_nulls=False)
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(watermark_trace(df, 20, 100, scope="partition")) == brute(rows, 20, 100)


def test_bounds_and_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    traced, state = partition_trace(empty, 0, 10, idle_timeout_ms=5)
    assert traced.collect() == [] and state.collect() == []
    for bad in ((-1, 10, None), (0, 0, None), (0, 10, -1)):
        with pytest.raises(ValueError):
            partition_trace(empty, *bad[:2], idle_timeout_ms=bad[2])
