"""Command-line jobs end to end (batch outputs, streaming location job)."""

from __future__ import annotations

import os
import tempfile

from tidemark import jobs
from tidemark.plans.location import location_pipeline
from tidemark.presets import REF
from tidemark.sources.fixtures import kafka_records

from conftest import SMALL


def test_batch_jobs_write_every_output(spark):
    out = tempfile.mkdtemp(prefix="tidemark-job-")
    jobs.main(["batch-location", "--sf-dir", SMALL, "--out", os.path.join(out, "loc")])
    jobs.main(["batch-sensors", "--sf-dir", SMALL, "--out", os.path.join(out, "sen"), "--preset", "day"])
    main = spark.read.parquet(os.path.join(out, "loc", "main"))
    expect = location_pipeline(kafka_records(spark, SMALL, REF.skew_ms), REF).main
    assert sorted(main.collect()) == sorted(expect.collect())
    for name in ("temperature", "ema", "sliding", "wind"):
        assert spark.read.parquet(os.path.join(out, "sen", name)).count() > 0
    assert spark.read.parquet(os.path.join(out, "sen", "unrouted")).count() == 0


def test_streaming_location_job_available_now(spark):
    work = tempfile.mkdtemp(prefix="tidemark-stream-job-")
    src = os.path.join(work, "src")
    kafka_records(spark, SMALL, REF.skew_ms).drop("poison").write.parquet(src)
    ck = os.path.join(work, "ck")
    app = os.path.basename(work)
    jobs.main(["location", "--source", src, "--fsStatePath", ck, "--available-now", "--app-id", app])
    from tidemark.session import checkpoint_root
    root = checkpoint_root(spark)       # the cluster's folder wins over --fsStatePath
    for query in ("LateTagger", "NormalOutput", "LateDataSink"):
        assert os.path.isdir(os.path.join(root, app, query, "offsets")), query
    on_time = spark.read.parquet(os.path.join(root, app, "location", "on_time"))
    batch = location_pipeline(kafka_records(spark, SMALL, REF.skew_ms), REF)
    assert on_time.count() + batch.late.count() == kafka_records(spark, SMALL, REF.skew_ms).count()


def test_streaming_sensors_job_available_now(spark):
    from tidemark.session import checkpoint_root
    from tidemark.sources.fixtures import extended_measurements
    from tidemark.streaming.sensors import flatten

    work = tempfile.mkdtemp(prefix="tidemark-sensor-job-")
    src = os.path.join(work, "src")
    flatten(extended_measurements(spark, SMALL)).write.parquet(src)
    app = os.path.basename(work)
    jobs.main(["sensors", "--source", src, "--available-now", "--app-id", app, "--preset", "day"])
    root = checkpoint_root(spark)
    for query in ("TemperatureSink", "EmaSink", "SlidingSink", "WindSink"):
        assert os.path.isdir(os.path.join(root, app, query, "commits")), query


def test_sensors_job_fan_out(spark):
    from tidemark.session import checkpoint_root
    from tidemark.sources.fixtures import extended_measurements
    from tidemark.streaming.sensors import flatten

    work = tempfile.mkdtemp(prefix="tidemark-fan-job-")
    src, out = os.path.join(work, "src"), os.path.join(work, "out")
    em = extended_measurements(spark, SMALL)
    flatten(em).write.parquet(src)
    app = os.path.basename(work)
    jobs.main(["sensors", "--source", src, "--available-now", "--app-id", app, "--fan-out-dir", out])
    total = sum(spark.read.parquet(os.path.join(out, n)).count() for n in ("temperature", "wind"))
    assert total == em.count()
    root = checkpoint_root(spark)
    assert os.path.isdir(os.path.join(root, app, "StatelessSink", "commits"))
    assert not os.path.exists(os.path.join(root, app, "TemperatureSink"))


def test_jobs_with_one_read_and_partition_scope(spark):
    from tidemark.session import checkpoint_root
    from tidemark.sources.fixtures import extended_measurements
    from tidemark.streaming.sensors import flatten

    work = tempfile.mkdtemp(prefix="tidemark-all-job-")
    src, out, records = (os.path.join(work, n) for n in ("src", "out", "records"))
    em = extended_measurements(spark, SMALL)
    flatten(em).write.parquet(src)
    app = os.path.basename(work)
    jobs.main(["sensors", "--source", src, "--available-now", "--app-id", app, "--all-outputs-dir", out])
    assert {n: spark.read.parquet(os.path.join(out, n)).count() > 0 for n in ("temperature", "wind", "ema")} == {
        "temperature": True, "wind": True, "ema": True}
    kafka_records(spark, SMALL, REF.skew_ms).drop("poison").write.parquet(records)
    jobs.main(["location", "--source", records, "--available-now", "--app-id", app, "--scope", "partition",
               "--idle-timeout-ms", "1000", "--lag-history", "50"])
    root = os.path.join(checkpoint_root(spark), app, "location")
    windows = spark.read.parquet(os.path.join(root, "windows")).count()
    assert spark.read.parquet(os.path.join(root, "lag_history")).count() == min(50, windows) > 0
