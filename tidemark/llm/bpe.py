"""Byte-level BPE encoding and decoding by a global distinct-word shuffle.

Texts are cut at every single space between two other characters; no match of
the pre-tokenizer's pattern crosses such a cut, so each piece (with its leading
space) splits and merges like the same piece anywhere else. Pieces of a bounded
block of documents are numbered; a block's distinct pieces go to the hash bucket
of their bytes, where each distinct piece is encoded once and its ids return to
the blocks; a document is then its pieces' ids in the order of their positions.
Decoding is a join with the table of token bytes (one row per rank, broadcast: it
has the size of the rank file). Each distinct id of a row of documents joins once;
the join keeps the rows in their order, so no shuffle follows, and the documents are
put together by position. A gap or a missing end raises an error, as does an id
that the table lacks.

Blocks are stretches of an input partition, read twice (for the pieces and for
the positions): the input must be a deterministic frame, such as a table scan.
A checksum of the pieces travels with both and a mismatch raises an error.

NULL and empty texts have no ids. Repeated rows are repeated. An empty table
gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TWO_SPACES = re.compile(r"\s\s|^\s|\s$")
CLEAN_CUT = re.compile(r"(?<=\S) (?=\S)")


def pieces(text: str | None) -> list:
    """Pieces in order: ``bytes`` for one without, ``str`` for one with a leading space."""
    if not text:
        return []
    parts = CLEAN_CUT.split(text) if TWO_SPACES.search(text) else text.split(" ")
    parts[0] = parts[0].encode()
    return parts


def pack(values: list[bytes]) -> bytes:
    sizes = np.fromiter(map(len, values), dtype="<u4", count=len(values))
    body = np.uint32(len(values)).tobytes() + sizes.tobytes() + b"".join(values)
    return np.uint64(len(body)).tobytes() + pa.compress(body, codec="zstd", asbytes=True)


def _body(blob: bytes) -> bytes:
    size = int(np.frombuffer(blob[:8], dtype="<u8")[0])
    return pa.decompress(blob[8:], decompressed_size=size, codec="zstd", asbytes=True)


def unpack(blob: bytes) -> list[bytes]:
    body = _body(blob)
    count = int(np.frombuffer(body[:4], dtype="<u4")[0])
    ends = np.cumsum(np.frombuffer(body, dtype="<u4", offset=4, count=count), dtype=np.int64) + 4 + 4 * count
    starts = np.concatenate([[4 + 4 * count], ends[:-1]]).tolist() if count else []
    return [body[a:b] for a, b in zip(starts, ends.tolist())]


class _Blocks:
    """Groups the rows of one input partition into numbered blocks."""

    def __init__(self, id_at: int, text_at: int, block_chars: int, buckets: int):
        self.id_at, self.text_at, self.block_chars, self.buckets = id_at, text_at, block_chars, buckets

    def __call__(self, batches):
        """Yields (block, ids, piece numbers per document, packed pieces by bucket, checksum)."""
        base, number = TaskContext.get().partitionId() << 24, 0
        ids, rows, known, size = [], [], {}, 0
        for batch in batches:
            texts = batch.column(self.text_at).to_pylist()
            for doc, text in zip(batch.column(self.id_at).to_pylist(), texts):
                own = pieces(text)
                rows.append(np.fromiter((known.setdefault(p, len(known)) for p in own),
                                        dtype=np.uint32, count=len(own)))
                ids.append(doc)
                size += len(text or "")
                if size >= self.block_chars:
                    done = (base + number, ids, *self._finish(rows, known))
                    number += 1
                    ids, rows, known, size = [], [], {}, 0
                    yield done
                    del done
                    pa.default_memory_pool().release_unused()
            del texts
        if ids:
            done = (base + number, ids, *self._finish(rows, known))
            del ids, rows, known
            yield done

    def _finish(self, rows, known):
        words = [p if isinstance(p, bytes) else b" " + p.encode() for p in known]
        bucket = np.fromiter((zlib.crc32(w) % self.buckets for w in words), dtype=np.int64, count=len(words))
        order = np.argsort(bucket, kind="stable")       # a piece's number is its place by bucket
        place = np.empty(len(words), dtype=np.uint32)
        place[order] = np.arange(len(words), dtype=np.uint32)
        packed, sorted_buckets = [], bucket[order]
        starts = np.flatnonzero(np.r_[True, sorted_buckets[1:] != sorted_buckets[:-1]]) if len(words) else []
        check = 0
        for a, b in zip(starts, [*starts[1:], len(words)]):
            own = [words[k] for k in order[a:b]]
            check = zlib.crc32(b"\0".join(own), check)
            packed.append((int(sorted_buckets[a]), pack(own)))
        return [place[r] for r in rows], packed, check


def number(documents: list[np.ndarray]) -> tuple[np.ndarray, bytes]:
    """Distinct token ids of some documents, and each document's places among them, packed."""
    known = np.zeros(max((int(t.max()) + 1 for t in documents if len(t)), default=0), dtype=bool)
    for t in documents:
        known[t] = True
    places = np.cumsum(known, dtype=np.uint32) - np.uint32(1)
    return np.flatnonzero(known).astype(np.int32), pack([places[t].tobytes() for t in documents])


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _encoder(ranks: dict, pattern: str):
    import tiktoken
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def encode(documents: DataFrame, ranks: dict[bytes, int], pattern: str, *, id_col: str = "doc_id",
           text_col: str = "text", block_chars: int = 8_000_000, docs_per_row: int = 128) -> DataFrame:
    """(block, part, ids of the documents, distinct token ids, places): the encoded
    table, ``docs_per_row`` documents in a row; a document's tokens are packed as their
    places among the distinct ones. ``token_rows`` and ``decode`` read it."""
    spark = documents.sparkSession
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    source = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    blocks = _Blocks(0, 1, block_chars, buckets)
    id_type = pa.string() if source.schema["id"].dataType.simpleString() == "string" else pa.int64()
    id_sql = "string" if id_type == pa.string() else "bigint"
    if id_sql == "bigint":
        source = source.withColumn("id", F.col("id").cast("bigint"))

    def dictionaries(batches):
        for block, _, _, packed, check in blocks(batches):
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([block] * len(packed), pa.int64()),
                "bucket": pa.array([k for k, _ in packed], pa.int32()),
                "sum": pa.array([check] * len(packed), pa.int64()),
                "words": pa.array([w for _, w in packed], pa.binary())})

    def positions(batches):
        for block, ids, rows, _, check in blocks(batches):
            for lo in range(0, len(ids), docs_per_row):
                part = rows[lo:lo + docs_per_row]
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([block], pa.int64()), "part": pa.array([lo], pa.int32()),
                    "sum": pa.array([check], pa.int64()), "ids": pa.array([ids[lo:lo + docs_per_row]], pa.list_(id_type)),
                    "places": pa.array([pack([r.tobytes() for r in part])], pa.binary())})

    table = spark.sparkContext.broadcast((ranks, pattern))

    def encode_words(batches):
        encoder = _encoder(*table.value)
        bucket, known = None, {}
        for batch in batches:
            out = []
            for k, words in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist()):
                if k != bucket:            # rows are sorted by bucket: each piece is encoded once
                    bucket, known = k, {}
                got = []
                for w in unpack(words):
                    e = known.get(w)
                    if e is None:
                        e = known[w] = np.array(encoder.encode_ordinary(w.decode()), dtype="<u4").tobytes()
                    got.append(e)
                out.append(pack(got))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2),
                                              pa.array(out, pa.binary())], names=["block", "bucket", "sum", "tokens"])

    encoded = (source.mapInArrow(dictionaries, "block bigint, bucket int, sum bigint, words binary")
               .repartition(buckets, "bucket").sortWithinPartitions("bucket")
               .mapInArrow(encode_words, "block bigint, bucket int, sum bigint, tokens binary"))
    placed = source.mapInArrow(positions, f"block bigint, part int, sum bigint, ids array<{id_sql}>, places binary")

    def assemble(words: pa.Table, docs: pa.Table) -> pa.Table:
        words = words.sort_by("bucket")
        if len(set(words["sum"].to_pylist()) | set(docs["sum"].to_pylist())) > 1:
            raise RuntimeError("the input changed between two reads: write it to a table first")
        tokens = [t for blob in words["tokens"].to_pylist() for t in unpack(blob)]
        sizes = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens)) // 4
        flat = np.frombuffer(b"".join(tokens), dtype="<u4")
        del tokens, words
        starts = np.cumsum(sizes) - sizes
        out, distinct = [], []
        for blob in docs["places"].to_pylist():
            packed = []
            for raw in unpack(blob):
                at = np.frombuffer(raw, dtype="<u4")
                n = sizes[at]
                total = int(n.sum())
                index = np.repeat(starts[at] - (np.cumsum(n) - n), n) + np.arange(total)
                packed.append(flat[index])
            known, places = number(packed)
            distinct.append(known)
            out.append(places)
        pa.default_memory_pool().release_unused()
        offsets = np.cumsum([0, *map(len, distinct)]).astype(np.int32)
        return (docs.select(["block", "part", "ids"])
                .append_column("distinct", pa.ListArray.from_arrays(
                    pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int32), *distinct]))))
                .append_column("places", pa.array(out, pa.binary())))

    return (encoded.groupBy("block").cogroup(placed.groupBy("block"))
            .applyInArrow(assemble, f"block bigint, part int, ids array<{id_sql}>, distinct array<int>, places binary"))


def token_rows(encoded: DataFrame, id_col: str = "doc_id", row_tokens: int = 65_536) -> DataFrame:
    """The token ids of ``encode``'s table as rows (id, n_tokens, first, tokens): a
    document has one row for every ``row_tokens`` of its ids (one row if it has none),
    in order; ``first`` is the position of a row's first id in its document."""
    id_sql = encoded.schema["ids"].dataType.elementType.simpleString()

    def batch_of(rows):
        offsets = np.cumsum([0, *(len(r[3]) for r in rows)]).astype(np.int32)
        flat = np.concatenate([r[3] for r in rows]).astype(np.int32, copy=False)
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], ARROW_ID[id_sql]), pa.array([r[1] for r in rows], pa.int64()),
             pa.array([r[2] for r in rows], pa.int64()),
             pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=[id_col, "n_tokens", "first", "tokens"])

    def run(batches):
        for batch in batches:
            for docs, distinct, blob in zip(*(c.to_pylist() for c in batch.columns)):
                rows, held, distinct = [], 0, np.array(distinct, dtype=np.int32)
                for doc, raw in zip(docs, unpack(blob)):
                    tokens = distinct[np.frombuffer(raw, dtype="<u4")]
                    for lo in range(0, max(1, len(tokens)), row_tokens):
                        rows.append((doc, len(tokens), lo, tokens[lo:lo + row_tokens]))
                        held += len(rows[-1][3])
                        if held >= 4 * row_tokens:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return encoded.select("ids", "distinct", "places").mapInArrow(
        run, f"`{id_col}` {id_sql}, n_tokens bigint, first bigint, tokens array<int>")


def token_table(spark: SparkSession, ranks: dict[bytes, int]) -> DataFrame:
    """(token, bytes): one row per rank."""
    return spark.createDataFrame(pa.table({"token": pa.array(ranks.values(), pa.int32()),
                                           "bytes": pa.array(ranks.keys(), pa.binary())}))


def _with_bytes(encoded: DataFrame, table: DataFrame) -> DataFrame:
    """(ids, places, n, at, token, bytes): one row per distinct id of a row of ``encoded``;
    the first also carries the documents' ids, their tokens as numbers of distinct
    ids, and how many those are."""
    once = encoded.select("ids", "places", F.size("distinct").alias("n"), F.posexplode_outer("distinct"))
    first = F.coalesce("pos", F.lit(0)) == 0
    return (once.select(*[F.when(first, F.col(c)).alias(c) for c in ("ids", "places", "n")],
                        F.coalesce("pos", F.lit(0)).alias("at"), F.col("col").alias("token"))
            .join(F.broadcast(table), "token", "left").select("ids", "places", "n", "at", "token", "bytes"))


def _groups(batches):
    """(ids of documents, packed places, distinct token ids, their bytes) of each row of ``encode``'s table."""
    held, last = None, -1
    for batch in batches:
        if not batch.num_rows:
            continue
        at = batch.column(3).to_numpy()
        if ((np.diff(at, prepend=last) != 1) & (at != 0)).any():
            raise RuntimeError("token ids are out of order")
        last = int(at[-1])
        starts = np.flatnonzero(np.r_[True, at[1:] == 0]).tolist()
        for a, b in zip(starts, [*starts[1:], len(at)]):
            if at[a] == 0:
                if held is not None:
                    raise RuntimeError("token ids are missing")
                held = [batch.column(0)[a].as_py(), batch.column(1)[a].as_py(), batch.column(2)[a].as_py(), [], []]
            if held[2]:
                held[3] += batch.column(4).slice(a, b - a).to_pylist()
                held[4] += batch.column(5).slice(a, b - a).to_pylist()
            if len(held[3]) == held[2]:
                if None in held[4]:
                    raise ValueError("a token id has no row in the table of token bytes")
                yield held[0], held[1], held[3], held[4]
                held = None
    if held is not None:
        raise RuntimeError("token ids are missing")


def decode(encoded: DataFrame, table: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, n_tokens, decoded): the bytes that the ids of each document of ``encode``'s
    table decode to, by a table (token, bytes) of distinct tokens."""
    id_sql = encoded.schema["ids"].dataType.elementType.simpleString()

    def run(batches):
        for docs, blob, _, by_place in _groups(batches):
            for doc, raw in zip(docs, unpack(blob)):
                places = np.frombuffer(raw, dtype="<u4").tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc], ARROW_ID[id_sql]), pa.array([len(places)], pa.int64()),
                     pa.array([b"".join(map(by_place.__getitem__, places))], pa.binary())],
                    names=[id_col, "n_tokens", "decoded"])
    return _with_bytes(encoded, table).mapInArrow(run, f"`{id_col}` {id_sql}, n_tokens bigint, decoded binary")


def decode_rows(encoded: DataFrame, ranks: dict[bytes, int], id_col: str = "doc_id") -> DataFrame:
    """One row per document of ``encode``'s table: its number of tokens, the digest of
    its ids and the digest of the bytes its ids decode to (by the same join as ``decode``)."""
    id_sql = encoded.schema["ids"].dataType.elementType.simpleString()
    types = [ARROW_ID[id_sql], pa.int64(), pa.string(), pa.string()]

    def run(batches):
        for docs, blob, tokens, by_place in _groups(batches):
            names, rows = list(map(str, tokens)), []
            for doc, raw in zip(docs, unpack(blob)):
                places = np.frombuffer(raw, dtype="<u4").tolist()
                rows.append((doc, len(places),
                             hashlib.sha256(",".join(map(names.__getitem__, places)).encode()).hexdigest(),
                             hashlib.sha256(b"".join(map(by_place.__getitem__, places))).hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                             names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    return _with_bytes(encoded, token_table(encoded.sparkSession, ranks)).mapInArrow(
        run, f"`{id_col}` {id_sql}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


ARROW_ID = {"string": pa.string(), "bigint": pa.int64()}
