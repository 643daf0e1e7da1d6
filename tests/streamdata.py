"""Test helper: write a small DataFrame as numbered files, in arrival order,
for a file stream source (which picks files up by modification time)."""

from __future__ import annotations

import os
import time

import pyarrow as pa
import pyarrow.parquet as pq

_BASE_MTIME = time.time() - 10_000


def write_numbered(pdf, folder: str, n_files: int, order_col: str = "seq", start_index: int = 0,
                   schema: pa.Schema | None = None) -> int:
    """Split ``pdf`` (pandas) by ``order_col`` into ``n_files`` parquet files
    named by index; file times increase with the index. Returns the next index."""
    os.makedirs(folder, exist_ok=True)
    pdf = pdf.sort_values(order_col).reset_index(drop=True)
    size = -(-len(pdf) // n_files)
    idx = start_index
    for lo in range(0, len(pdf), size):
        part = pdf.iloc[lo:lo + size]
        path = os.path.join(folder, f"part-{idx:05d}.parquet")
        pq.write_table(pa.Table.from_pandas(part, schema=schema, preserve_index=False), path)
        os.utime(path, (_BASE_MTIME + idx, _BASE_MTIME + idx))
        idx += 1
    return idx
