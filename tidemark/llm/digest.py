"""Document fingerprints: a quartile bucket digest over hashed byte triplets.

Three triplet forms per four-byte window are hashed into 128 buckets; each
bucket is written as the quartile (0 to 3) its count falls in, after one byte
for the logarithm of the length and one for the quartiles' ratios. The
difference of two digests adds the bucket distances (opposite quartiles count
double), the distance of the lengths and of the ratios, and is bounded by
``MOST``; likeness is one minus its share of that bound.

``neighbours`` compares each document with the next one in id order and with an
edited copy. Rows are range-partitioned by (id, text) and streamed in order;
only each partition's first and last row cross partitions, through a table of
two rows per partition, and the last document is followed by the first.

NULL texts are empty; texts of under four bytes have no triplets and differ in
length only; NULL ids come first; rows that tie on the id are ordered by text.
A single document is its own next one. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stage_table

BUCKETS = 128
FORMS = ((0, 1, 2), (0, 1, 3), (0, 2, 3))
FACTORS = (2654435761, 2246822519, 3266489917)
LENGTH_STEP, LENGTH_MOST, RATIO_MOST = 0.2, 64, 30
MOST = BUCKETS * 6 + LENGTH_MOST + RATIO_MOST
PIECE = 1 << 20


def counts(data: bytes) -> np.ndarray:
    """Bucket counts of all byte triplets, a bounded stretch at a time."""
    out = np.zeros(BUCKETS, dtype=np.int64)
    for at in range(0, len(data) - 3, PIECE):
        b = np.frombuffer(data, dtype=np.uint8, offset=at, count=min(PIECE + 3, len(data) - at)).astype(np.uint32)
        n = len(b) - 3
        for (i, j, k), factor in zip(FORMS, FACTORS):
            v = b[k:k + n] << np.uint32(16)
            v |= b[j:j + n] << np.uint32(8)
            v |= b[i:i + n]
            v *= np.uint32(factor)
            v >>= np.uint32(25)
            out += np.bincount(v, minlength=BUCKETS)
    return out


def digest(data: bytes) -> np.ndarray:
    """Header (length code, ratio code) and one quartile code per bucket."""
    c = counts(data)
    q = np.partition(c, (31, 63, 95))[[31, 63, 95]]
    codes = (c > q[0]).astype(np.uint8) + (c > q[1]) + (c > q[2])
    size = min(255, int(np.log1p(len(data)) / LENGTH_STEP))
    top = max(1, int(q[2]))
    ratios = (int(q[0]) * 15 // top) << 4 | (int(q[1]) * 15 // top)
    return np.concatenate([np.array([size, ratios], dtype=np.uint8), codes])


def to_hex(d: np.ndarray) -> str:
    quads = d[2:].reshape(-1, 4)
    return (bytes(d[:2]) + bytes(quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6)).hex()


def from_hex(text: str) -> np.ndarray:
    raw = np.frombuffer(bytes.fromhex(text), dtype=np.uint8)
    return np.concatenate([raw[:2], np.stack([raw[2:] >> s & 3 for s in (0, 2, 4, 6)], axis=1).reshape(-1)])


def difference(a: np.ndarray, b: np.ndarray) -> int:
    gap = np.abs(a[2:].astype(np.int16) - b[2:])
    ra, rb = int(a[1]), int(b[1])
    ratios = abs((ra >> 4) - (rb >> 4)) + abs((ra & 15) - (rb & 15))
    return int(gap.sum() + 3 * (gap == 3).sum()) + min(LENGTH_MOST, 2 * abs(int(a[0]) - int(b[0]))) + ratios


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return 1.0 - difference(a, b) / MOST


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the next one's start."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _row(doc, text, own, following, next_digest):
    new = edited(text, following).encode()
    new_digest = digest(new)
    return (doc, len(text), hashlib.sha256(new).hexdigest(), to_hex(own), to_hex(new_digest),
            likeness(own, new_digest), likeness(own, next_digest))


OUT = (("n_chars", "bigint", pa.int64()), ("edited_sha256", "string", pa.string()),
       ("fingerprint", "string", pa.string()), ("edited_fingerprint", "string", pa.string()),
       ("near_edited", "double", pa.float64()), ("near_next", "double", pa.float64()))


def _batch(rows: list, id_type, extra: dict | None = None) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * (1 + len(OUT))
    data = {"id": pa.array(columns[0], id_type)}
    data |= {n: pa.array(c, t) for (n, _, t), c in zip(OUT, columns[1:])}
    return pa.RecordBatch.from_pydict(data | (extra or {}))


def neighbours(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: fingerprints of it and of its edited copy, and the
    likenesses ``near_edited`` and ``near_next``."""
    source = documents.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    id_sql = source.schema["id"].dataType.simpleString()
    if id_sql != "string":
        source, id_sql = source.withColumn("id", F.col("id").cast("bigint")), "bigint"
    id_type = pa.string() if id_sql == "string" else pa.int64()

    def stream(batches):
        part, before, first, done = TaskContext.get().partitionId(), None, None, []

        def emit(rows, role=None, text=None):
            n = len(rows)
            return _batch(rows, id_type, {
                "role": pa.array([role] * n, pa.string()), "part": pa.array([part] * n, pa.int32()),
                "text": pa.array([text] * n, pa.string())})
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = digest(text.encode())
                if before is None:
                    first = (doc, text, own)
                else:
                    done.append(_row(*before, text, own))
                before = (doc, text, own)
                if len(done) >= 2000:
                    yield emit(done)
                    done = []
        if done:
            yield emit(done)
        if before is not None:
            for role, (doc, text, own) in (("first", first), ("last", before)):
                yield emit([(doc, None, None, to_hex(own), None, None, None)], role, text)

    fields = ", ".join(f"{n} {t}" for n, t, _ in OUT)
    # Spark samples the range keys to the driver: a short prefix of the text keeps
    # the order of (id, text), and whole texts stay with the executors
    made = stage_table(source.repartitionByRange("id", F.substring("text", 1, 32)).sortWithinPartitions("id", "text")
                       .mapInArrow(stream, f"id {id_sql}, {fields}, role string, part int, text string"), "digest")
    ends = made.where("role IS NOT NULL")
    parts = ends.where("role = 'first'").select("part")        # one row per partition
    in_order = Window.orderBy("part")
    following = parts.select(F.col("part").alias("from"), F.coalesce(
        F.lead("part").over(in_order), F.first("part").over(in_order)).alias("to"))
    last = ends.where("role = 'last'").select("part", "id", "text", "fingerprint")
    heads = ends.where("role = 'first'").select(F.col("part").alias("to"), F.col("text").alias("next_text"),
                                                F.col("fingerprint").alias("next_fingerprint"))
    joined = (last.join(following, F.col("part") == F.col("from")).join(heads, "to")
              .select("id", "text", "fingerprint", "next_text", "next_fingerprint"))

    def finish(batches):
        for batch in batches:
            yield _batch([_row(doc, text, from_hex(fp), nxt, from_hex(next_fp))
                          for doc, text, fp, nxt, next_fp in zip(*(c.to_pylist() for c in batch.columns))], id_type)

    names = ["id", *[n for n, _, _ in OUT]]
    closing = joined.mapInArrow(finish, f"id {id_sql}, {fields}")
    return (made.where("role IS NULL").select(*names).unionByName(closing.select(*names))
            .withColumnRenamed("id", id_col))
