"""Command-line jobs: the two pipelines as streaming or batch Spark jobs.

    python -m tidemark.jobs location --source DIR [--local] [--fsStatePath PATH]
    python -m tidemark.jobs location --kafka-servers HOST:PORT --topic T
    python -m tidemark.jobs sensors  --source DIR [--local] [--objectReuse true] [--fan-out-dir DIR]
    python -m tidemark.jobs batch-location --source TABLE --out DIR
    python -m tidemark.jobs batch-sensors  --source TABLE --out DIR

The batch jobs read a Parquet table of records (``seq``, ``timestamp``,
``partition`` and the JSON bytes ``value``; the flat sensor columns of
``streaming/sensors.FLAT_SCHEMA``), or, with ``--sf-dir`` in place of
``--source``, records made from the events table. ``--scope partition`` takes
the watermark from the slowest partition.

``--local`` prints results (console sink); otherwise they are discarded
(noop sink). ``--fsStatePath``
names the checkpoint folder when the cluster has not set
``spark.checkpoint.dir``; it is never cleared. ``--objectReuse`` is accepted
for compatibility and has no effect (Spark rows are immutable).
"""

from __future__ import annotations

import argparse
import os

from tidemark.plans.location import location_pipeline
from tidemark.plans.sensors import SLIDING_HOURS, SLIDING_REF, sensor_pipeline
from tidemark.session import build_session, checkpoint_root, ensure_dir, use_checkpoint_root
from tidemark.presets import DAY, REF
from tidemark.sources.kafka import KAFKA_ORDER, read_kafka, read_record_files
from tidemark.streaming.location import LateTagger, for_each_committed, read_tagged, read_windows, with_lag_gauge
from tidemark.streaming.handlers import LagHistory, SensorOutputs
from tidemark.streaming.sensors import FLAT_SCHEMA, StatelessFanOut, flatten, nest, sensor_streams
from tidemark.streaming.sinks import start, start_batches

PRESETS = {"ref": REF, "day": DAY}


def _bool(text: str) -> bool:
    return str(text).lower() in ("1", "true", "yes", "")


def _session(args):
    spark = build_session("local[*]" if args.local else None, app=f"tidemark-{args.job}")
    if args.fsStatePath:
        use_checkpoint_root(spark, args.fsStatePath)
    checkpoint_root(spark)
    return spark


def _trigger(args):
    if args.available_now:
        return {"availableNow": True}
    return {"processingTime": f"{args.trigger_ms} milliseconds"}


def run_location(spark, args):
    """Tagger: late and on-time records, on-time windows and undecodable records
    as tables under the application's folder. Two more queries print or discard
    windows and late records. Under ``--available-now`` the stages run one
    after the other."""
    preset = PRESETS[args.preset]
    root = os.path.join(checkpoint_root(spark), args.app_id, "location")
    order = ("seq",)
    if args.kafka_servers:
        records, order = read_kafka(spark, args.kafka_servers, args.topic), KAFKA_ORDER
    else:
        records = read_record_files(spark, args.source, max_files_per_trigger=args.max_files)
    late, on_time, state, windows, invalid = (
        os.path.join(root, d) for d in ("late", "on_time", "tagger_state", "windows", "invalid"))
    for folder in (late, windows):
        ensure_dir(spark, folder)
    sink = "console" if args.local else "noop"
    trigger, app = _trigger(args), args.app_id
    tagger = start_batches(records, "LateTagger",
                           LateTagger(preset, late, on_time, state, order_cols=order, scope=args.scope,
                                      windows_path=windows, invalid_path=invalid, idle_timeout_ms=args.idle_timeout_ms),
                           trigger=trigger, app_id=app)
    if args.available_now:
        tagger.awaitTermination()
    more = []
    if args.lag_history:
        history = LagHistory(os.path.join(root, "lag_history"), args.lag_history)
        more.append(for_each_committed(spark, windows, history, "LagHistory", trigger=trigger, app_id=app))
    return [tagger, *more,
            start(with_lag_gauge(read_windows(spark, windows)), "NormalOutput",
                  sink=sink, trigger=trigger, app_id=app),
            start(read_tagged(spark, late), "LateDataSink", sink=sink, trigger=trigger, app_id=app)]


def run_sensors(spark, args):
    if args.source:
        records = nest(spark.readStream.schema(FLAT_SCHEMA).parquet(args.source))
    else:
        raise SystemExit("--source is required for the sensor stream")
    sliding = SLIDING_REF if args.preset == "ref" else SLIDING_HOURS
    if args.all_outputs_dir:
        # every output from one read per micro-batch, files per batch id
        state = os.path.join(checkpoint_root(spark), args.app_id, "sensor_state")
        handler = SensorOutputs(args.all_outputs_dir, state, sliding, out_of_orderness_ms=args.out_of_orderness_ms)
        return [start_batches(records, "SensorOutputs", handler, trigger=_trigger(args), app_id=args.app_id)]
    streams = sensor_streams(records, sliding, watermark_ms=args.out_of_orderness_ms)
    sink = "console" if args.local else "noop"
    names = ("temperature", "ema", "sliding", "wind", "unrouted")
    queries = []
    if args.fan_out_dir:
        # stateless outputs from one read per micro-batch, files per batch id
        queries.append(start_batches(records, "StatelessSink", StatelessFanOut(args.fan_out_dir),
                                     trigger=_trigger(args), app_id=args.app_id))
        names = ("ema", "sliding")
    return queries + [start(flatten(getattr(streams, name)) if name != "sliding" else getattr(streams, name),
                            name.capitalize() + "Sink", sink=sink, trigger=_trigger(args), app_id=args.app_id)
                      for name in names]


def run_batch_location(spark, args):
    preset = PRESETS[args.preset]
    if args.source:
        records = spark.read.parquet(args.source)
    else:
        from tidemark.sources.fixtures import kafka_records
        records = kafka_records(spark, args.sf_dir, preset.skew_ms)
    out = location_pipeline(records, preset, scope=args.scope)
    out.main.write.mode("overwrite").parquet(os.path.join(args.out, "main"))
    out.late.write.mode("overwrite").parquet(os.path.join(args.out, "late"))
    out.invalid.write.mode("overwrite").parquet(os.path.join(args.out, "invalid"))


def run_batch_sensors(spark, args):
    sliding = SLIDING_REF if args.preset == "ref" else SLIDING_HOURS
    if args.source:
        records = nest(spark.read.schema(FLAT_SCHEMA).parquet(args.source))
    else:
        from tidemark.sources.fixtures import extended_measurements
        records = extended_measurements(spark, args.sf_dir)
    outs = sensor_pipeline(records, sliding=sliding, share_input=True)
    for name in ("temperature", "ema", "sliding", "wind", "unrouted"):
        getattr(outs, name).write.mode("overwrite").parquet(os.path.join(args.out, name))


def main(argv=None):
    ap = argparse.ArgumentParser(prog="tidemark.jobs")
    ap.add_argument("job", choices=["location", "sensors", "batch-location", "batch-sensors"])
    ap.add_argument("--local", type=_bool, nargs="?", const=True, default=False)
    ap.add_argument("--objectReuse", type=_bool, nargs="?", const=True, default=False)
    ap.add_argument("--fsStatePath", default=None)
    ap.add_argument("--preset", choices=sorted(PRESETS), default="ref")
    ap.add_argument("--source", default=None)
    ap.add_argument("--scope", choices=["global", "partition"], default="global",
                    help="location jobs: watermark over all partitions or of the slowest one")
    ap.add_argument("--kafka-servers", default=None)
    ap.add_argument("--topic", default=None)
    ap.add_argument("--max-files", type=int, default=None)
    ap.add_argument("--available-now", action="store_true")
    ap.add_argument("--trigger-ms", type=int, default=5000,
                    help="micro-batch cadence; the watermark advances once per micro-batch")
    ap.add_argument("--out-of-orderness-ms", type=int, default=10_000,
                    help="sensors job: how late a row may be for the sliding average")
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.001")
    ap.add_argument("--out", default=None)
    ap.add_argument("--fan-out-dir", default=None,
                    help="sensors job: write temperature / wind / unrouted here from one read per micro-batch")
    ap.add_argument("--all-outputs-dir", default=None,
                    help="sensors job: write every output here, EMA and sliding average too, from one read per micro-batch")
    ap.add_argument("--idle-timeout-ms", type=int, default=None,
                    help="location job, partition scope: a partition silent for longer follows the clock")
    ap.add_argument("--lag-history", type=int, default=None,
                    help="location job: keep the lags of that many windows, as a table per batch")
    ap.add_argument("--app-id", default="tidemark",
                    help="sub-folder of the checkpoint root holding this deployment's query state")
    args = ap.parse_args(argv)
    spark = _session(args)
    if args.job.startswith("batch-"):
        if not args.out:
            raise SystemExit("--out is required for batch jobs")
        (run_batch_location if args.job == "batch-location" else run_batch_sensors)(spark, args)
        return
    queries = (run_location if args.job == "location" else run_sensors)(spark, args)
    for q in queries:
        q.awaitTermination()


if __name__ == "__main__":
    main()
