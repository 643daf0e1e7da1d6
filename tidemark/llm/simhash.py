"""SimHash near-duplicates by deletion-variant signatures.

Fingerprints are 64-bit SimHashes of word shingles (XXH64, seed 42). To find
all pairs within two bits, a fingerprint is cut into two 32-bit segments: of two
fingerprints at most two bits apart, one segment differs by at most one bit. The
index holds, per segment, its value and its 32 one-wildcard variants (one bit
deleted). Equal values meet under the value; segments one bit apart meet under
exactly one wildcard, from opposite sides of the deleted bit. Candidates are
verified on the whole fingerprint.

Only distinct fingerprints are indexed, so a group of exact copies is one row
whatever its size. A bucket of more than ``most`` rows is not compared pair by
pair: the other segment's one- and two-wildcard variants (as many as the
distance still allows) are added to its key, after which a group holds at most
four fingerprints, all within two bits. That path is exact and linear.

NULL and empty texts have fingerprint zero and link like any other; rows with a
NULL id keep their row and take the smallest non-NULL id of their group (NULL
if there is none). Repeated rows are repeated in the result. An empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import add_columns, cut, stage_table
from tidemark.llm.components import connected_components

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
LOW32 = (1 << 32) - 1


def simhash(text: str | None, shingle: int = 3, at_once: int = 1 << 16) -> int:
    """Unsigned 64-bit fingerprint: a bit is set if it is set in over half the
    shingle hashes (repeats included). ``bytes.split`` cuts at exactly the
    white space 0x20 and 0x09-0x0D."""
    words = text.encode().translate(LOWER).split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    count = max(1, len(words) - shingle + 1)
    lo = starts[:count].tolist()
    hi = ends[min(shingle, len(words)) - 1:].tolist()
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, count, at_once):
        hashes = np.array([digest(joined[a:b], 42) for a, b in zip(lo[at:at + at_once], hi[at:at + at_once])],
                          dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, out_col: str, shingle: int = 3, text_col: str = "text") -> DataFrame:
    """``documents`` with the fingerprint as a signed long."""
    def make():
        def run(texts):
            raw = np.array([simhash(t, shingle) for t in texts], dtype="<u8")
            return {out_col: pa.array(raw.view("<i8"))}
        return run
    return add_columns(documents, text_col, {out_col: "bigint"}, make)


def _segment(fp: Column, which: int) -> Column:
    return fp.bitwiseAND(LOW32) if which == 0 else F.shiftrightunsigned(fp, 32)


def index(distinct: DataFrame) -> DataFrame:
    """(fp, key, side) rows: key is segment number, wildcard (0: none) and value."""
    rows = []
    for tag, value in ((0, f"(fp & {LOW32}L)"), (33, "shiftrightunsigned(fp, 32)")):
        rows.append(f"array(named_struct('key', shiftleft({tag}L, 32) | {value}, 'side', 0))")
        rows.append(f"transform(sequence(0, 31), i -> named_struct("
                    f"'key', shiftleft(cast(i + {tag + 1} as bigint), 32) | ({value} & ~shiftleft(1L, i)), "
                    f"'side', cast(shiftright({value}, i) & 1 as int)))")
    return distinct.select("fp", F.expr(f"explode(concat({', '.join(rows)}))").alias("v")).select("fp", "v.key", "v.side")


def links(distinct: DataFrame, bits: int = 2, most: int = 1024) -> DataFrame:
    """Links (a, b) whose components are those of all pairs within ``bits`` bits
    (at most 2). Buckets of up to ``most`` rows give every pair; larger ones
    give the links of one member to the others of each second-level group."""
    if not 0 <= bits <= 2:
        raise ValueError("two segments serve distances of at most 2 bits")
    exact = F.shiftrightunsigned("key", 32).isin(0, 33)
    indexed = index(distinct)
    # counted map-side, whatever the size of a bucket; only buckets that can link are kept
    sizes = stage_table(indexed.groupBy("key").agg(F.count("*").alias("n"), F.sum("side").alias("n1"))
                        .where(F.when(exact, F.col("n") > 1)
                               .otherwise((F.col("n1") > 0) & (F.col("n1") < F.col("n"))))
                        .select("key", "n"), "simhash-sizes")
    live = stage_table(indexed.join(sizes, "key").select("fp", "key", "side", "n"), "simhash-buckets")
    few = live.where(F.col("n") <= most)
    x = few.select("key", F.col("fp").alias("a"), F.col("side").alias("sa"))
    y = few.select(F.col("key").alias("k2"), F.col("fp").alias("b"), F.col("side").alias("sb"))
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits
    meets = F.when(exact, F.col("a") < F.col("b")).otherwise(F.col("sa") < F.col("sb"))
    pairs = x.join(y, (F.col("key") == F.col("k2")) & apart & meets).select("a", "b")
    return pairs.union(_hot_links(live.where(F.col("n") > most), exact, bits)).distinct()


def _hot_links(rows: DataFrame, exact: Column, bits: int) -> DataFrame:
    """Second level of large buckets: the other segment with as many wildcards
    as the distance has left; every group is a clique of at most four."""
    one = "transform(sequence(0, 31), i -> shiftleft(1L, i))"
    two = ("flatten(transform(sequence(0, 31), i -> transform(sequence(i, 31), "
           "j -> shiftleft(1L, i) | shiftleft(1L, j))))")
    by_left = {0: "array(0L)", 1: f"concat(array(0L), {one})", 2: f"concat(array(0L), {two})"}
    equal, differ = by_left[bits], by_left.get(bits - 1, "array(cast(null as bigint))")
    other = F.when(F.shiftrightunsigned("key", 32) < 33, _segment(F.col("fp"), 1)).otherwise(_segment(F.col("fp"), 0))
    masks = F.when(exact, F.expr(equal)).otherwise(F.expr(differ))
    keyed = (rows.withColumn("other", other).withColumn("mask", F.explode(masks)).where("mask IS NOT NULL")
             .withColumn("rest", F.col("other").bitwiseAND(F.bitwise_not("mask"))))
    groups = (keyed.groupBy("key", "mask", "rest")
              .agg(F.min("fp").alias("a"), F.collect_set("fp").alias("all"))
              .where(F.size("all") > 1))
    return groups.select("a", F.explode("all").alias("b")).where("a <> b")


def near_duplicates(documents: DataFrame, *, shingle: int = 3, bits: int = 2, most: int = 1024,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint, component_id) per row of ``documents``: the fingerprint
    as 16 hex digits and the smallest id reachable by links."""
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = stage_table(fingerprints(rows, "fp", shingle).select("id", "fp"), "simhash")
    whole = fingerprint_groups(rows, bits, most)
    return (rows.join(whole, F.col("fp") == F.col("wfp"))
            .select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                    "component_id"))


def fingerprint_groups(rows: DataFrame, bits: int = 2, most: int = 1024) -> DataFrame:
    """(wfp, group, component_id) of every distinct fingerprint of ``rows`` (id, fp):
    ``group`` is one fingerprint of its component."""
    # every distinct fingerprint once, with its smallest id
    distinct = cut(rows.groupBy("fp").agg(F.min("id").alias("first")))
    roots = connected_components(links(distinct, bits, most))
    linked = roots.join(distinct, F.col("node") == F.col("fp")).select("root", "fp", "first")
    smallest = linked.groupBy(F.col("root").alias("r")).agg(F.min("first").alias("component"))
    named = (linked.join(smallest, F.col("root") == F.col("r"))
             .select(F.col("fp").alias("lfp"), F.col("root").alias("group"), "component"))
    return cut(distinct.join(named, F.col("fp") == F.col("lfp"), "left")
               .select(F.col("fp").alias("wfp"), F.coalesce("group", "fp").alias("group"),
                       F.coalesce("component", "first").alias("component_id")))
