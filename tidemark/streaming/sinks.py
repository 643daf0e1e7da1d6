"""Starting streaming queries: named, checkpointed, one sink each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.session import checkpoint_path

# Fixed value: production trigger cadence (the reference checkpoints every 5 s).
DEFAULT_TRIGGER = {"processingTime": "5 seconds"}


def start(df: DataFrame, name: str, sink: str = "noop", path: str | None = None,
          checkpoint: str | None = None, output_mode: str = "append",
          trigger: dict | None = None, app_id: str = "", **options) -> StreamingQuery:
    """Start ``df`` as query ``name``.

    ``sink``: ``noop`` (discard), ``console`` (print), ``memory`` (table
    ``name``, tests), or a file format (``parquet``/``json``) written to
    ``path``. The checkpoint defaults to ``<spark.checkpoint.dir>/<app_id>/<name>``:
    a stable per-query folder, so state survives restarts and redeploys.
    It is never deleted here.
    """
    spark = df.sparkSession
    writer = (df.writeStream.queryName(name).outputMode(output_mode)
              .option("checkpointLocation", checkpoint or checkpoint_path(spark, app_id, name)))
    writer = writer.trigger(**(trigger or DEFAULT_TRIGGER))
    for key, value in options.items():
        writer = writer.option(key, value)
    if sink in ("noop", "console", "memory"):
        return writer.format(sink).start()
    return writer.format(sink).start(path)


def start_batches(df: DataFrame, name: str, handler, checkpoint: str | None = None,
                  trigger: dict | None = None, app_id: str = "") -> StreamingQuery:
    """Start ``df`` with a ``foreachBatch`` handler (several outputs per
    micro-batch, each written idempotently by batch id)."""
    spark = df.sparkSession
    return (df.writeStream.queryName(name)
            .option("checkpointLocation", checkpoint or checkpoint_path(spark, app_id, name))
            .trigger(**(trigger or DEFAULT_TRIGGER))
            .foreachBatch(handler).start())
