"""User code over the rows of a window.

``process_windows`` calls ``fn(key, window, rows)`` once per key and tumbling
window, with its rows in order; ``fn`` yields dicts of the declared output. Rows
arrive as an iterator fed from Arrow batches: the shuffle sorts them by key,
window and order (and spills), and no group is ever held as a whole, so ``fn``
decides what it keeps. Rows it leaves unread are skipped. A window of more rows
than one task should take is better served by the built-in aggregates, which combine before
the shuffle; here all rows of a key's window meet in one task, read once in order.

:class:`ProcessWindows` is the stream form (``foreachBatch``): rows of open windows
are buffered in a carried table, and those that the watermark closes are
handed to ``fn`` with the batch that closed them.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.records import floor_to
from tidemark.operators.watermark import is_late

START, END = "windowStart", "windowEnd"


def process_windows(df: DataFrame, size_ms: int, fn: Callable[[tuple, tuple, Iterator[dict]], Iterator[dict]],
                    schema: str | T.StructType, *, key_cols=("location",), ts_col: str = "timestamp",
                    order_cols=("timestamp", "seq")) -> DataFrame:
    """``key_cols``, ``windowStart``, ``windowEnd`` and the columns of ``schema``,
    one row per dict that ``fn`` yields. NULL keys form a group of their own;
    rows without a time are in no window."""
    if size_ms <= 0:
        raise ValueError("the window must be positive")
    own = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    keys = [df.schema[k] for k in key_cols]
    out = T.StructType([*keys, T.StructField(START, T.LongType()), T.StructField(END, T.LongType()), *own.fields])
    start = floor_to(F.col(ts_col), size_ms)
    rows = (df.where(F.col(ts_col).isNotNull()).withColumn(START, start)
            .repartition(*[F.col(k) for k in key_cols], F.col(START))
            .sortWithinPartitions(*key_cols, START, *order_cols))
    names = list(key_cols)

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(out)

        def lines():
            for batch in batches:
                columns = batch.schema.names
                for lo in range(0, batch.num_rows, 1024):
                    part = batch.slice(lo, 1024).to_pylist()
                    for row in part:
                        yield (*[row[n] for n in names], row[START]), {c: row[c] for c in columns if c != START}

        source, held, done = lines(), [], []
        held = next(source, None)
        while held is not None:
            group = held[0]

            def rows_of():
                nonlocal held
                while held is not None and held[0] == group:
                    row = held[1]
                    held = next(source, None)
                    yield row
            mine = rows_of()
            window = (group[-1], group[-1] + size_ms)
            for made in fn(group[:-1], window, mine):
                done.append(dict(zip(names, group)) | {START: window[0], END: window[1]} | made)
                if len(done) >= 1024:
                    yield pa.RecordBatch.from_pylist(done, schema=arrow)
                    done = []
            for _ in mine:                        # what fn did not read
                pass
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=arrow)
    return rows.mapInArrow(run, out)


class ProcessWindows:
    """Stream form of :func:`process_windows`; output in ``<out>/batch=<id>``.
    Rows for windows already closed are counted in ``lateRows`` and left out."""

    def __init__(self, out: str, state: str, size_ms: int, fn, schema, *, row_schema: str, out_of_orderness_ms: int,
                 key_cols=("location",), ts_col: str = "timestamp", order_cols=("timestamp", "seq")):
        from tidemark.streaming.carried import Carried
        from tidemark.streaming.handlers import _Watermark
        self.out, self.size, self.fn, self.schema = out, size_ms, fn, schema
        self.kw = {"key_cols": key_cols, "ts_col": ts_col, "order_cols": order_cols}
        self.rows, self.watermark = Carried(f"{state}-rows", row_schema), _Watermark(f"{state}-watermark", out_of_orderness_ms)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, ts = batch.sparkSession, F.col(self.kw["ts_col"])
        before, late_rows = self.watermark.read(spark, batch_id)
        end = floor_to(ts, self.size) + F.lit(self.size)
        late = is_late(end, F.lit(before).cast("long"))
        seen = batch.agg(F.max(ts).alias("top"), F.count_if(late).alias("late")).first()
        watermark = self.watermark.after(seen["top"], before)
        held = self.rows.read(spark, batch_id)
        rows = batch.where(~late).select(*held.columns).unionByName(held).persist()
        try:
            closed = is_late(end, F.lit(watermark).cast("long"))
            (process_windows(rows.where(closed), self.size, self.fn, self.schema, **self.kw)
             .write.mode("overwrite").parquet(os.path.join(self.out, f"batch={batch_id}")))
            self.rows.write(rows.where(~closed), batch_id)
        finally:
            rows.unpersist()
        self.watermark.write(spark, watermark, late_rows + seen["late"], batch_id)
