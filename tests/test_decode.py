"""Tolerant JSON decoding: one payload per row, expected verdict and values."""

from __future__ import annotations

import pytest
from pyspark.sql import Observation

from tidemark.operators.decode import (FULL_FIELDS, dynamic_decode, encode_payload, invalid_count,
                                       strict_decode, tolerant_decode, variant_double, with_decoded)

CASES = [
    # payload, valid, (sensorId, value, location)
    ('{"sensorId": 3, "value": 2.5, "location": "Berlin"}', True, (3, 2.5, "Berlin")),
    ('{"sensorId": 3, "value": 2.5, "location": "Berlin", "extra": [1, 2]}', True, (3, 2.5, "Berlin")),
    ('{"sensorId', False, None),
    ('', False, None),
    ('[1]', False, None),
    ('null', False, None),
    ('{}', False, None),                                   # NULL location -> quarantine
    ('{"location": "X"}', True, (0, 0.0, "X")),            # absent numbers -> 0
    ('{"sensorId": null, "value": null, "location": "X"}', True, (0, 0.0, "X")),
    ('{"sensorId": 1, "value": "2.5", "location": "X"}', True, (1, 2.5, "X")),
    ('{"sensorId": 1, "value": "abc", "location": "X"}', False, None),
    ('{"sensorId": 1, "value": {"a": 1}, "location": "X"}', False, None),
    ('{"sensorId": 1.7, "value": 1, "location": "X"}', True, (1, 1.0, "X")),
    ('{"sensorId": "12", "value": 1, "location": "X"}', True, (12, 1.0, "X")),
    ('{"sensorId": 1, "value": NaN, "location": "X"}', False, None),
    ('{"sensorId": 1, "value": 1.0E-4, "location": "X"}', True, (1, 1.0e-4, "X")),
    ('{"sensorId": 1, "value": 2, "location": "X"} trailing', True, (1, 2.0, "X")),
    ('{"sensorId": 1, "value": 2, "location": 7}', True, (1, 2.0, "7")),
]


@pytest.fixture(scope="module")
def records(spark):
    rows = [(i, 1000 + i, 1, bytearray(p.encode())) for i, (p, _, _) in enumerate(CASES)]
    return spark.createDataFrame(rows, "seq long, timestamp long, partition int, value binary")


def test_each_payload(records):
    dec = tolerant_decode(records)
    valid = {r["seq"]: (r["sensorId"], r["value"], r["location"]) for r in dec.valid.collect()}
    bad = {r["seq"] for r in dec.invalid.collect()}
    for i, (payload, ok, expect) in enumerate(CASES):
        if ok:
            assert valid.get(i) == expect, payload
            assert i not in bad, payload
        else:
            assert i not in valid, payload
            assert i in bad, payload


def test_invalid_counter_observed(records):
    dec = tolerant_decode(records)
    dec.valid.count()
    n_bad = sum(1 for _, ok, _ in CASES if not ok)
    assert dec.observation.get["numInvalidRecords"] == n_bad
    assert invalid_count(records).first()[0] == n_bad


def test_strict_decode_fails_on_first_bad_record(spark, records):
    good = records.filter("seq = 0")
    assert strict_decode(good).first()["sensorId"] == 3
    with pytest.raises(Exception):
        strict_decode(records).collect()


def test_dynamic_decode_coerces_text_numbers(spark, records):
    d = dynamic_decode(records)
    got = {r["seq"]: r["v"] for r in d.select("seq", variant_double("payload", "$.value").alias("v")).collect()}
    assert got[0] == 2.5
    assert got[9] == 2.5        # "2.5" as text
    assert 2 not in got         # unparsable


def test_encode_then_decode_round_trip(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(1, 0.1 + 0.2, "A"), (2, 1e-300, "B"), (3, -0.0, "C")],
                               "sensorId int, v double, location string")
    enc = df.select(F.lit(0).cast("long").alias("seq"), F.lit(0).cast("long").alias("timestamp"),
                    F.lit(0).alias("partition"),
                    encode_payload(F.col("sensorId"), F.col("v"), F.col("location")).alias("value"))
    out = sorted((r["sensorId"], r["value"], r["location"]) for r in tolerant_decode(enc).valid.collect())
    assert out == [(1, 0.1 + 0.2, "A"), (2, 1e-300, "B"), (3, -0.0, "C")]


def test_batch_observation_name_is_unique_per_call(records):
    a, b = tolerant_decode(records, metric_name="a"), tolerant_decode(records, metric_name="b")
    assert isinstance(a.observation, Observation) and a.observation is not b.observation


def test_open_token_kinds(spark):
    """Objects and arrays are no location; empty numeric text is zero; a text
    with a fraction is no whole number."""
    cases = [('{"sensorId":1,"value":2.5,"location":{"a":1}}', True),
             ('{"sensorId":1,"value":2.5,"location":[1,2]}', True),
             ('{"sensorId":1,"value":2.5,"location":"[x]"}', False),
             ('{"sensorId":"","value":"","location":"a"}', False),
             ('{"sensorId":"1.7","value":1,"location":"a"}', True),
             ('{"sensorId":1.7,"value":1,"location":"a"}', False),
             ('{"sensorId":3,"value":1,"location":"a","measurementInformation":"m"}', False)]
    df = spark.createDataFrame([(k, bytearray(p.encode())) for k, (p, _) in enumerate(cases)],
                               "seq long, value binary")
    rows = {r["seq"]: r for r in with_decoded(df, fields=FULL_FIELDS).collect()}
    assert {k: r["_invalid"] for k, r in rows.items()} == {k: bad for k, (_, bad) in enumerate(cases)}
    assert (rows[3]["sensorId"], rows[3]["value"]) == (0, 0.0)
    assert rows[5]["sensorId"] == 1 and rows[6]["measurementInformation"] == "m"
