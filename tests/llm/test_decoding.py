"""Byte-level BPE: an independent merge loop, decoded texts, plan of the decoding join."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
from hard_rows import SMALL, empty, hard  # noqa: F401
from tidemark.llm import bpe
from tidemark.llm.common import read


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def merged(piece, ranks):
    """Join the pair of lowest rank (the first of equals) until none is known."""
    parts = [piece[k:k + 1] for k in range(len(piece))]
    while len(parts) > 1:
        best = min((ranks.get(a + b, len(ranks) * 2), k) for k, (a, b) in enumerate(zip(parts, parts[1:])))
        if best[0] == len(ranks) * 2:
            break
        k = best[1]
        parts[k:k + 2] = [parts[k] + parts[k + 1]]
    return [ranks[p] for p in parts]


def loop_ids(text, ranks, cache):
    out = []
    for m in regex.findall(public_tokenizers.PATTERN, text or ""):
        if m not in cache:
            cache[m] = merged(m.encode(), ranks)
        out += cache[m]
    return out


def test_query_against_a_merge_loop(spark, ranks):
    from tidemark.llm.queries import QUERIES
    cache, want = {}, []
    for r in read(spark, SMALL, "documents").select("doc_id", "text").collect():
        ids = loop_ids(r["text"], ranks, cache)
        want.append((r["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((r["text"] or "").encode()).hexdigest()))
    got = [tuple(r) for r in QUERIES["op6_byte_bpe"](spark, SMALL).collect()]
    assert got and sorted(got) == sorted(want)


def test_texts_come_back(spark, hard, empty, ranks):
    docs = hard.where("length(text) < 20000 OR text IS NULL")
    table = bpe.encode(docs, ranks, public_tokenizers.PATTERN, block_chars=400, docs_per_row=3)
    rows = bpe.token_rows(table, row_tokens=4)                     # documents of many rows
    cache = {}
    want = sorted(((r["doc_id"], (r["text"] or "").encode(), loop_ids(r["text"], ranks, cache))
                   for r in docs.collect()), key=str)
    got = {}
    for r in rows.orderBy("first").collect():
        assert len(r["tokens"]) == min(4, r["n_tokens"] - r["first"])
        got.setdefault((r["doc_id"], r["n_tokens"]), []).extend(r["tokens"] if r["first"] % 4 == 0 else [None])
    assert all(got[(d, len(ids))][:4] == ids[:4] for d, _, ids in want)
    out = bpe.decode(table, bpe.token_table(spark, ranks)).collect()
    assert sorted(((r["doc_id"], bytes(r["decoded"])) for r in out), key=str) == [w[:2] for w in want]
    assert sorted(r["n_tokens"] for r in out) == sorted(len(w[2]) for w in want)
    long = hard.where("length(text) > 20000").selectExpr("text AS doc_id", "text")      # ids may be texts
    back = bpe.decode(bpe.encode(long, ranks, public_tokenizers.PATTERN), bpe.token_table(spark, ranks))
    got = back.collect()
    assert len(got) == 2 and all(r["doc_id"].encode() == bytes(r["decoded"]) for r in got)
    assert bpe.decode(bpe.encode(empty, ranks, public_tokenizers.PATTERN), bpe.token_table(spark, ranks)).count() == 0


def packed(spark, *groups):
    """Rows of ``encode``'s table from lists of (id, token ids)."""
    rows = []
    for k, g in enumerate(groups):
        distinct, places = bpe.number([np.array(t, "<u4") for _, t in g])
        rows.append((0, k, [d for d, _ in g], distinct.tolist(), bytearray(places)))
    return spark.createDataFrame(rows, "block bigint, part int, ids array<bigint>, distinct array<int>, places binary")


def test_decoding_is_a_join_without_a_shuffle(spark, ranks):
    many = list(range(256, 25_000))                                # distinct ids over several batches
    table = packed(spark, [(1, [300, 400, 300]), (2, [])], [(3, []), (None, [])], [(4, many), (5, many[::-1])])
    out = bpe.decode(table.coalesce(1), bpe.token_table(spark, ranks))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    names = {k: b for b, k in ranks.items()}
    whole = [names[k] for k in many]
    assert sorted(((r["doc_id"], bytes(r["decoded"])) for r in out.collect()), key=str) == sorted(
        [(1, names[300] + names[400] + names[300]), (2, b""), (3, b""), (None, b""),
         (4, b"".join(whole)), (5, b"".join(whole[::-1]))], key=str)


def test_an_id_without_bytes_raises(spark, ranks):
    with pytest.raises(Exception, match="token id has no row"):
        bpe.decode(packed(spark, [(1, [300, 10_000_000])]), bpe.token_table(spark, ranks)).collect()


def test_rows_out_of_order_raise():
    def batch(at, n):
        return pa.RecordBatch.from_pydict({
            "ids": pa.array([[1] if k == 0 else None for k in at], pa.list_(pa.int64())),
            "places": pa.array([b"" if k == 0 else None for k in at], pa.binary()),
            "n": pa.array([n if k == 0 else None for k in at], pa.int32()), "at": pa.array(at, pa.int32()),
            "token": pa.array(at, pa.int32()), "bytes": pa.array([b"x"] * len(at), pa.binary())})
    assert len(list(bpe._groups([batch([0, 1], 3), batch([2, 0, 1, 2], 3)]))) == 2
    for broken in ([0, 2, 1], [0, 1], [0, 0, 1, 2], [1, 2]):
        with pytest.raises(RuntimeError, match="token ids are"):
            list(bpe._groups([batch(broken, 3)]))
