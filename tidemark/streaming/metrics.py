"""Counters that add up over micro-batches and survive restarts.

Observed metrics (``observe``) come per micro-batch, and a replayed batch reports
again. :class:`CounterListener` notes each batch's value in
``<path>/<query>/batch=<id>``, overwritten by a replay, so the total counts
every batch once, whatever restarts lie between. A batch that observed nothing
leaves no note.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidemark.session import ensure_dir
from tidemark.streaming.carried import _file_system


class CounterListener(StreamingQueryListener):
    """Notes the numeric fields of observed metric ``metric`` of the queries named in
    ``queries`` (default: every named query). Add it with ``spark.streams.addListener``."""

    def __init__(self, spark: SparkSession, path: str, metric: str = "decode", queries=None):
        self.spark, self.path, self.metric = spark, path, metric
        self.queries = None if queries is None else set(queries)
        ensure_dir(spark, path)

    def note(self, query: str, batch_id: int, values: dict) -> None:
        fs, place = _file_system(self.spark, os.path.join(self.path, query, f"batch={batch_id}.json"))
        out = fs.create(place, True)
        try:
            out.write(bytearray(json.dumps({"query": query, "batchId": batch_id} | values).encode()))
        finally:
            out.close()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if progress.name is None or (self.queries is not None and progress.name not in self.queries):
            return
        row = progress.observedMetrics.get(self.metric)
        if row is not None:
            values = {k: v for k, v in row.asDict().items() if isinstance(v, (int, float))}
            self.note(progress.name, progress.batchId, values)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def counter_total(spark: SparkSession, path: str, field: str = "numInvalidRecords", query: str | None = None) -> int:
    """The sum over all noted batches; 0 before the first."""
    rows = (spark.read.schema(f"query STRING, batchId BIGINT, `{field}` BIGINT")
            .option("recursiveFileLookup", "true").json(path))
    if query is not None:
        rows = rows.where(F.col("query") == query)
    return rows.agg(F.coalesce(F.sum(field), F.lit(0))).first()[0]
