"""DuckDB SQL for every registered query (the correctness oracle).

Written independently of the Spark plans: plain window functions for the
watermark, a recursive CTE for the exact EMA recursion, a row expansion for
sliding windows. Tables ``events`` and ``nation`` are DuckDB views.
"""

from __future__ import annotations

from tidemark.plans.catalog import (LAG_CLOCK_MS, R, R2, R_MS, REFLECT_BOUNDS, SILENT_FROM_MS,
                                    STATS_INTERVAL_MS)
from tidemark.plans.sensors import SLIDING_HOURS, SLIDING_REF
from tidemark.presets import DAY, REF
from tidemark.sources.fixtures import NUM_PARTITIONS, POISON_EVERY
from tidemark.sources.registry import SENSORS_PER_INSTANCE

PARTITIONS = range(NUM_PARTITIONS)

MS = "(epoch_us(e.ts) // 1000)"


def kafka_sql(skew_ms: int) -> str:
    part = "CAST(e.event_id % 6 + 1 + CASE WHEN e.event_id % 6 >= 3 THEN 1 ELSE 0 END AS INTEGER)"
    return f"""
    SELECT e.event_id AS seq, {MS} AS arrival_ms,
           {MS} - {part} * {skew_ms} AS timestamp,
           {part} AS partition,
           CAST(e.user_id % 100 AS INTEGER) AS sensorId, e.value AS value, n.n_name AS location,
           e.event_id % {POISON_EVERY} = 0 AS poison
    FROM events e JOIN nation n ON n.n_nationkey = e.user_id % 25"""


EM_SQL = f"""
    SELECT event_id AS seq, user_id AS sensorId, user_id % 100 AS vendorId,
      CASE WHEN user_id % 4 IN (0, 1) THEN 'Temperature' ELSE 'Wind' END AS sensorType,
      CASE WHEN user_id % 2 = 0 THEN CAST(-125.0011 AS DOUBLE) + (user_id % 59)
           ELSE CAST(5.8663153 AS DOUBLE) + (user_id % 10) * CAST(0.9 AS DOUBLE) END AS longitude,
      CASE WHEN user_id % 2 = 0 THEN CAST(24.9493 AS DOUBLE) + (user_id % 25)
           ELSE CAST(47.2701114 AS DOUBLE) + (user_id % 8) END AS latitude,
      CAST((user_id * 37) % 3000 AS DOUBLE) AS height, value,
      CAST(CAST((event_id % 100) - 50 AS DOUBLE) / CAST(10 AS DOUBLE) AS FLOAT) AS accuracy,
      {MS.replace('e.ts', 'ts')} AS timestamp
    FROM events"""


def box(lon: str, lat: str, w, e, s, n) -> str:
    return (f"(COALESCE(isnan({lon}) OR {lon} BETWEEN CAST({w} AS DOUBLE) AND CAST({e} AS DOUBLE), false)"
            f" AND COALESCE(isnan({lat}) OR {lat} BETWEEN CAST({s} AS DOUBLE) AND CAST({n} AS DOUBLE), false))")


def in_us(lon="longitude", lat="latitude"):
    return box(lon, lat, -125.0011, -66.9326, 24.9493, 49.5904)


def in_de(lon="longitude", lat="latitude"):
    return box(lon, lat, 5.8663153, 15.0419319, 47.2701114, 55.099161)


def c_to_f(x):
    return f"(({x} * CAST(9.0 AS DOUBLE)) / CAST(5.0 AS DOUBLE) + CAST(32.0 AS DOUBLE))"


def f_to_c(x):
    return f"((({x} - CAST(32.0 AS DOUBLE)) * CAST(5.0 AS DOUBLE)) / CAST(9.0 AS DOUBLE))"


def kph_to_mph(x):
    return f"({x} / CAST(1.60934 AS DOUBLE))"


def mph_to_kph(x):
    return f"({x} * CAST(1.60934 AS DOUBLE))"


def rnd(x, d=R):
    # "+ 0.0" turns a rounded -0.0 into 0.0, as Spark's decimal rounding does
    return f"(round(CAST({x} AS DOUBLE), {d}) + CAST(0.0 AS DOUBLE))"


FLAT_COLS = "seq, sensorId, vendorId, sensorType, longitude, latitude, height"


def _tumbling(preset) -> str:
    w = preset.window_ms
    return f"""
    WITH kr AS ({kafka_sql(preset.skew_ms)})
    SELECT timestamp - timestamp % {w} AS windowStart, timestamp - timestamp % {w} + {w} AS windowEnd,
           location, count(*) AS eventsPerWindow, {rnd('sum(value)')} AS sumPerWindow
    FROM kr WHERE NOT poison GROUP BY 1, 2, 3"""


def _localized(route: str, convert) -> str:
    return f"""
    WITH em AS ({EM_SQL})
    SELECT {FLAT_COLS},
      {rnd(f"CASE WHEN {in_us()} THEN {convert('value')} ELSE value END")} AS value,
      {rnd('accuracy')} AS accuracy, timestamp
    FROM em WHERE sensorType = '{route}'"""


def _sliding(size_slide) -> str:
    size, slide = size_slide
    k = size // slide
    return f"""
    WITH em AS ({EM_SQL}),
    w AS (SELECT em.*, (timestamp - timestamp % {slide}) - r.k * {slide} AS windowStart
          FROM em, (SELECT range AS k FROM range({k})) r WHERE sensorType = 'Temperature'),
    g AS (SELECT sensorId, vendorId, sensorType, windowStart,
            arg_max(longitude, struct_pack(t := timestamp, s := seq)) AS longitude,
            arg_max(latitude, struct_pack(t := timestamp, s := seq)) AS latitude,
            arg_max(height, struct_pack(t := timestamp, s := seq)) AS height,
            sum(value) / count(*) AS v,
            CAST(sum(CAST(accuracy AS DOUBLE)) / count(*) AS FLOAT) AS a,
            max(timestamp) AS timestamp, count(*) AS count
          FROM w GROUP BY sensorId, vendorId, sensorType, windowStart)
    SELECT sensorId, vendorId, sensorType, windowStart, windowStart + {size} AS windowEnd,
      longitude, latitude, height,
      {rnd(f"CASE WHEN {in_us()} THEN {c_to_f('v')} ELSE v END")} AS value,
      {rnd('a')} AS accuracy, timestamp, count
    FROM g"""


EMA_SQL = f"""
    WITH RECURSIVE em AS ({EM_SQL}),
    t AS (SELECT *, row_number() OVER (PARTITION BY sensorId, vendorId, sensorType
                                       ORDER BY timestamp, seq) AS rn
          FROM em WHERE sensorType = 'Temperature'),
    r AS (SELECT sensorId, vendorId, sensorType, rn, value AS av, accuracy AS aa FROM t WHERE rn = 1
          UNION ALL
          SELECT t.sensorId, t.vendorId, t.sensorType, t.rn, (r.av + t.value) / 2,
                 CAST((r.aa + t.accuracy) / 2 AS FLOAT)
          FROM r JOIN t ON t.sensorId = r.sensorId AND t.vendorId = r.vendorId
                        AND t.sensorType = r.sensorType AND t.rn = r.rn + 1)
    SELECT t.seq, t.sensorId, t.vendorId, t.sensorType, t.longitude, t.latitude, t.height,
      {rnd(f"CASE WHEN {in_us('t.longitude', 't.latitude')} THEN {c_to_f('r.av')} ELSE r.av END")} AS value,
      {rnd('r.aa')} AS accuracy, t.timestamp
    FROM r JOIN t USING (sensorId, vendorId, sensorType, rn) WHERE rn > 1"""


def _trace(preset, scope: str) -> str:
    w = "ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    if scope == "global":
        seen = f"max(timestamp) OVER ({w})"
    else:
        seen = "least(" + ", ".join(
            f"max(CASE WHEN partition = {p} THEN timestamp END) OVER ({w})" for p in PARTITIONS) + ")"
    win = preset.window_ms
    return f"""
    kr AS ({kafka_sql(preset.skew_ms)}),
    tr AS (SELECT kr.*, {seen} - {preset.out_of_orderness_ms} AS watermark,
                  timestamp - timestamp % {win} + {win} AS windowEnd FROM kr),
    tl AS (SELECT tr.*, COALESCE(windowEnd - 1 <= watermark, false) AS late FROM tr)"""


def _trace_idle(preset) -> str:
    w = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    idle, win = preset.idle_timeout_ms, preset.window_ms
    parts = ", ".join(
        f"max(CASE WHEN partition = {p} THEN arrival_ms END) OVER (ORDER BY seq {w}) AS last{p}, "
        f"max(CASE WHEN partition = {p} THEN event END) OVER (ORDER BY seq {w}) AS max{p}" for p in PARTITIONS)
    seen = "least(" + ", ".join(
        f"CASE WHEN arrival_ms - last{p} > {idle} THEN greatest(max{p}, arrival_ms) ELSE max{p} END"
        for p in PARTITIONS) + ")"
    return f"""
    WITH kr AS (SELECT * REPLACE (CASE WHEN partition = 7 AND arrival_ms >= {SILENT_FROM_MS} THEN 6
                                       ELSE partition END AS partition) FROM ({kafka_sql(preset.skew_ms)})),
    ev AS (SELECT *, CASE WHEN arrival_ms - max(arrival_ms) OVER (PARTITION BY partition ORDER BY seq {w}) > {idle}
                          THEN greatest(timestamp, arrival_ms) ELSE timestamp END AS event FROM kr),
    st AS (SELECT *, {parts} FROM ev),
    tr AS (SELECT *, {seen} - {preset.out_of_orderness_ms} AS watermark,
                  timestamp - timestamp % {win} + {win} AS windowEnd FROM st)
    SELECT seq, CAST(partition AS INTEGER) AS partition, timestamp, watermark, windowEnd,
           COALESCE(windowEnd - 1 <= watermark, false) AS late FROM tr"""


def _on_time(preset) -> str:
    w = preset.window_ms
    return f"""{_trace(preset, 'global')},
    main AS (SELECT timestamp - timestamp % {w} AS windowStart, timestamp - timestamp % {w} + {w} AS windowEnd,
                    location, count(*) AS eventsPerWindow, sum(value) AS sumPerWindow
             FROM tl WHERE NOT poison AND NOT late GROUP BY 1, 2, 3)"""


def _us_stats() -> str:
    f = c_to_f("value")
    iv = STATS_INTERVAL_MS
    return f"""
    em AS ({EM_SQL}),
    us AS (SELECT * FROM em WHERE sensorType = 'Temperature' AND {in_us()}),
    st AS (SELECT timestamp - timestamp % {iv} AS intervalStart, count(*) AS n,
             avg(value) AS sourceMean, min(value) AS sourceMin, max(value) AS sourceMax,
             var_pop(value) * count(value) AS sourceM2,
             avg({f}) AS normalizedMean, min({f}) AS normalizedMin, max({f}) AS normalizedMax,
             var_pop({f}) * count({f}) AS normalizedM2
           FROM us GROUP BY 1)"""


def _quantile(p: float) -> str:
    pos = f"(CAST({p} AS DOUBLE) * CAST(n + 1 AS DOUBLE))"
    lo = f"CAST(floor({pos}) AS BIGINT)"
    return (f"CASE WHEN {pos} < 1 THEN CAST(s[1] AS DOUBLE) WHEN {pos} >= n THEN CAST(s[n] AS DOUBLE) "
            f"ELSE CAST(s[{lo}] AS DOUBLE) + ({pos} - floor({pos})) * CAST(s[{lo} + 1] - s[{lo}] AS DOUBLE) END")


def _lag() -> str:
    from tidemark.operators.stats import LAG_QUANTILES
    qs = ", ".join(f"{rnd(_quantile(p), R_MS)} AS p{f'{p:g}'.split('.')[1].ljust(2, '0')}" for p in LAG_QUANTILES)
    return f"""
    WITH {_on_time(REF)},
    latest AS (SELECT windowEnd FROM main),
    agg AS (SELECT count(*) AS n, min({LAG_CLOCK_MS} - windowEnd) AS min, max({LAG_CLOCK_MS} - windowEnd) AS max,
                   avg({LAG_CLOCK_MS} - windowEnd) AS mean, stddev_samp({LAG_CLOCK_MS} - windowEnd) AS stddev,
                   list_sort(list({LAG_CLOCK_MS} - windowEnd)) AS s FROM latest)
    SELECT n, min, max, {rnd('mean', R_MS)} AS mean, {rnd('stddev', R_MS)} AS stddev, {qs} FROM agg"""


def _reflect() -> str:
    (tlo, thi), (wlo, whi) = REFLECT_BOUNDS["Temperature"], REFLECT_BOUNDS["Wind"]
    lo = f"CASE WHEN sensorType = 'Temperature' THEN CAST({tlo} AS DOUBLE) ELSE CAST({wlo} AS DOUBLE) END"
    hi = f"CASE WHEN sensorType = 'Temperature' THEN CAST({thi} AS DOUBLE) ELSE CAST({whi} AS DOUBLE) END"
    step = "CAST(accuracy AS DOUBLE)"
    return f"""
    WITH em AS ({EM_SQL})
    SELECT seq, sensorType,
      {rnd(f"CASE WHEN value + {step} BETWEEN {lo} AND {hi} THEN value + {step} ELSE value - {step} END")}
        AS nextValue
    FROM em"""


def _registry() -> str:
    from tidemark.sources.registry import HASH_A, HASH_B, HASH_SPACE, MAX_HEIGHT
    n = SENSORS_PER_INSTANCE
    us = f"sensorId % {n} < {n // 2}"

    def unit(f):
        return f"(CAST(((sensorId % {1 << 31}) * {f}) % {HASH_SPACE} AS DOUBLE) / CAST({HASH_SPACE} AS DOUBLE))"

    def inside(lo_us, hi_us, lo_de, hi_de, f):
        return (f"CASE WHEN {us} THEN CAST({lo_us} AS DOUBLE) + {unit(f)} * CAST({hi_us - lo_us!r} AS DOUBLE) "
                f"ELSE CAST({lo_de} AS DOUBLE) + {unit(f)} * CAST({hi_de - lo_de!r} AS DOUBLE) END")
    return f"""
            SELECT sensorId, sensorId // {n} AS instance, sensorId % {n} AS localIndex,
              sensorId % 100 AS vendorId,
              CASE WHEN ((sensorId % {n}) // 2) % 2 = 0 THEN 'Temperature' ELSE 'Wind' END AS sensorType,
              CASE WHEN {us} THEN 'US' ELSE 'DE' END AS region,
              {rnd(inside(-125.0011, -66.9326, 5.8663153, 15.0419319, HASH_A))} AS longitude,
              {rnd(inside(24.9493, 49.5904, 47.2701114, 55.099161, HASH_B))} AS latitude,
              CAST(((sensorId % {1 << 31}) * {HASH_B}) % {MAX_HEIGHT} AS DOUBLE) AS height
            FROM (SELECT DISTINCT user_id AS sensorId FROM events)"""


def oracles() -> dict[str, str]:
    n = SENSORS_PER_INSTANCE
    return {
        "decode_valid": f"""
            WITH kr AS ({kafka_sql(REF.skew_ms)})
            SELECT seq, timestamp, partition, sensorId, value, location FROM kr WHERE NOT poison""",
        "decode_invalid_count": f"""
            WITH kr AS ({kafka_sql(REF.skew_ms)})
            SELECT count(*) FILTER (WHERE poison) AS numInvalidRecords FROM kr""",
        "decode_quarantine": f"""
            WITH kr AS ({kafka_sql(REF.skew_ms)})
            SELECT seq, timestamp, partition, 10 AS payloadBytes FROM kr WHERE poison""",
        "decode_full": f"""
            WITH kr AS ({kafka_sql(REF.skew_ms)})
            SELECT seq, timestamp, partition, sensorId, value, location, 'm' || seq AS measurementInformation
            FROM kr WHERE NOT poison""",
        "decode_props": """
            SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
            FROM events WHERE json_valid(props)""",
        "dynamic_decode": f"""
            WITH kr AS ({kafka_sql(REF.skew_ms)})
            SELECT seq, timestamp, sensorId, value, location FROM kr WHERE NOT poison""",
        "tumbling_sum_count_1s": _tumbling(REF),
        "tumbling_sum_count_1d": _tumbling(DAY),
        "unit_conversions": f"""
            SELECT event_id, {rnd('value')} AS value, {rnd(c_to_f('value'))} AS c_to_f,
              {rnd(f_to_c('value'))} AS f_to_c, {rnd(kph_to_mph('value'))} AS kph_to_mph,
              {rnd(mph_to_kph('value'))} AS mph_to_kph
            FROM events""",
        "geo_us_de": f"""
            WITH em AS ({EM_SQL})
            SELECT seq, longitude, latitude, {in_us()} AS in_us, {in_de()} AS in_de FROM em""",
        "reflect_step": _reflect(),
        "split_counts": f"""
            WITH em AS ({EM_SQL})
            SELECT CASE sensorType WHEN 'Temperature' THEN 'temperature' WHEN 'Wind' THEN 'wind'
                   ELSE 'unrouted' END AS route, count(*) AS n
            FROM em GROUP BY 1""",
        "localized_temperature": _localized("Temperature", c_to_f),
        "localized_wind": _localized("Wind", kph_to_mph),
        "sliding_avg_temperature": _sliding(SLIDING_HOURS),
        "sliding_avg_temperature_10s": _sliding(SLIDING_REF),
        "ema_temperature": EMA_SQL,
        "watermark_trace": f"""
            WITH {_trace(DAY, 'global')}
            SELECT seq, partition, timestamp, watermark, windowEnd, late FROM tl""",
        "watermark_trace_min_partition": f"""
            WITH {_trace(DAY, 'partition')}
            SELECT seq, partition, timestamp, watermark, windowEnd, late FROM tl""",
        "watermark_trace_idle": _trace_idle(DAY),
        "late_rows": f"""
            WITH {_trace(DAY, 'global')}
            SELECT seq, partition, timestamp, watermark FROM tl WHERE late""",
        "on_time_windows": f"""
            WITH {_on_time(DAY)}
            SELECT windowStart, windowEnd, location, eventsPerWindow, {rnd('sumPerWindow')} AS sumPerWindow
            FROM main""",
        "idle_partitions": f"""
            WITH kr AS ({kafka_sql(DAY.skew_ms)}),
            per AS (SELECT partition, count(*) AS rows, max(timestamp) AS lastTimestamp,
                           max(arrival_ms) AS lastArrival FROM kr GROUP BY partition),
            every AS (SELECT CAST(range AS INTEGER) AS partition FROM range({NUM_PARTITIONS}))
            SELECT partition, COALESCE(rows, 0) AS rows, lastTimestamp, lastArrival,
              (lastArrival IS NULL OR lastArrival < (SELECT max(arrival_ms) FROM kr) - {DAY.idle_timeout_ms})
                AS idle
            FROM every LEFT JOIN per USING (partition)""",
        "interval_stats_us": f"""
            WITH {_us_stats()}
            SELECT intervalStart, n, {rnd('sourceMean')} AS sourceMean, {rnd('sourceMin')} AS sourceMin,
              {rnd('sourceMax')} AS sourceMax, {rnd('sourceM2', R2)} AS sourceM2,
              {rnd('normalizedMean')} AS normalizedMean, {rnd('normalizedMin')} AS normalizedMin,
              {rnd('normalizedMax')} AS normalizedMax, {rnd('normalizedM2', R2)} AS normalizedM2
            FROM st""",
        "lifetime_minmax_us": f"""
            WITH {_us_stats()}
            SELECT intervalStart, {rnd('normalizedMean')} AS normalizedMean,
              {rnd('min(sourceMin) OVER w')} AS sourceLifetimeMin,
              {rnd('max(sourceMax) OVER w')} AS sourceLifetimeMax,
              {rnd('min(normalizedMin) OVER w')} AS normalizedLifetimeMin,
              {rnd('max(normalizedMax) OVER w')} AS normalizedLifetimeMax
            FROM st WINDOW w AS (ORDER BY intervalStart ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
        "lag_quantiles": _lag(),
        "sensor_registry": _registry(),
    }
