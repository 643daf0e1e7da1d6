"""Language-model scoring by context-tree weighting over bytes.

A text is its lower-case (A-Z) words and one end. Each word is coded as its
bytes and a closing space, the end as one newline; every byte is split into its
eight bits, and each bit has a tree over the bytes before it in the running text,
up to ``depth`` of them, starting from spaces at the beginning of a text (with
``across=False`` at the beginning of every word). A node holds the counts
of zeros and ones seen after its context; its Krichevsky-Trofimov probability
``Pe`` and that of its children are mixed as ``Pw = (Pe + prod Pw(child)) / 2``.
A bit's probability then mixes the estimates of all depths on its path, each
weighted by how well stopping there codes the training text. Nodes without
counts are part of the same tree and predict 1/2.

Counting and weighting are aggregations and joins of node tables. Blocks of
documents count their distinct grams (the bytes before a byte and the byte), once
per distinct pair of a context and a word. Blocks send their distinct grams and
words, packed, to hash buckets, which merge the counts of all training documents
and send back the grams' probabilities and, for the unigram score, the counts.
The texts are read once: a block's words, grams and token places are written to
one table, which everything after reads. Memory is bounded by one block and by
the distinct words or grams of one bucket.

``n_bytes`` counts the coded bytes and ``bits_per_byte`` is the code length of a
text, ``-score`` in bits, per coded byte.
``base_score`` is the add-0.1 unigram score over the same tokens. NULL and empty
texts are the end alone. Rows with a NULL id are scored, not learnt from.
Repeated rows count and are repeated. With no training text the base score is
that of an empty table and every bit has probability 1/2.
"""

from __future__ import annotations

import math
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import pack, unpack
from tidemark.llm.common import stage_table

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
END = b"\n"
SPREAD = 1_000_003          # a prime: grams go to the bucket of their remainder


def tokens(text: str | None) -> list[bytes]:
    """Words and the end; ``bytes.split`` cuts at 0x20 and 0x09-0x0D."""
    words = text.encode().translate(LOWER).split() if text else []
    words.append(END)
    return words


class _Blocks:
    """Numbers the distinct tokens of bounded stretches of an input partition."""

    def __init__(self, block_chars: int, buckets: int):
        self.block_chars, self.buckets = block_chars, buckets

    def __call__(self, batches):
        """Yields (block, ids, held, places per document, words in order of place,
        [(bucket, words, counts)])."""
        block, held, size = TaskContext.get().partitionId() << 24, self._empty(), 0
        for batch in batches:
            for doc, text, out in zip(*(c.to_pylist() for c in batch.columns)):
                ids, outs, rows, known = held
                own = tokens(text)
                rows.append(np.fromiter(map(known.__getitem__, own), dtype=np.uint32, count=len(own)))
                ids.append(doc)
                outs.append(out)
                size += len(text or "") + 1
                if size >= self.block_chars:
                    del ids, outs, rows, known
                    yield (block, *self._finish(*held))
                    block, held, size = block + 1, self._empty(), 0
        if held[0]:
            yield (block, *self._finish(*held))

    @staticmethod
    def _empty():
        known = defaultdict()
        known.default_factory = known.__len__       # a word not met before gets the next number
        return [], [], [], known

    def _finish(self, ids, outs, rows, known):
        words = list(known)
        known.clear()
        count = np.zeros(len(words), dtype=np.int64)
        learnt = [row for out, row in zip(outs, rows) if not out]
        if learnt:
            count += np.bincount(np.concatenate(learnt), minlength=len(words))
        bucket = np.fromiter(map(zlib.crc32, words), dtype=np.int64, count=len(words)) % self.buckets
        order = np.argsort(bucket, kind="stable")
        place = np.empty(len(words), dtype=np.uint32)
        place[order] = np.arange(len(words), dtype=np.uint32)
        inside = bucket[order]
        starts = np.flatnonzero(np.r_[True, inside[1:] != inside[:-1]])
        words, count = [words[k] for k in order.tolist()], count[order].astype("<i8")
        packed = [(int(inside[a]), pack(words[a:b]), count[a:b].tobytes())
                  for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(words)])]
        return ids, outs, [place[r] for r in rows], words, packed


def planes(row: np.ndarray) -> bytes:
    """Numbers byte by byte, all lowest bytes first: the high ones compress well."""
    return row.view(np.uint8).reshape(len(row), -1).T.tobytes() if len(row) else b""


def from_planes(raw: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(raw, dtype=np.uint8).reshape(np.dtype(kind).itemsize, -1).T.copy().view(kind).ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    return planes(np.diff(keys, prepend=0).astype("<i8"))


def unpack_sorted(raw: bytes) -> np.ndarray:
    return from_planes(raw, "<i8").cumsum()


# --- the context tree -------------------------------------------------------

def _coded(words: list[bytes]) -> list[bytes]:
    return [w if w == END else w + b" " for w in words]


def context_pairs(coded: list[bytes], rows: list[np.ndarray], depth: int, across: bool):
    """(context, word, pair of every token): the distinct pairs of the ``depth``
    bytes before a token, as one number, and the token's place in ``coded``."""
    word = np.concatenate(rows).astype(np.int64) if rows else np.zeros(0, dtype=np.int64)
    spaces = int.from_bytes(b" " * depth)
    if across and depth:
        # one more token before every text: depth spaces
        tail = np.array([int.from_bytes(c[-depth:]) for c in coded] + [spaces], dtype=np.int64)
        size = np.array([len(c) for c in coded] + [depth], dtype=np.int64)
        sizes = np.fromiter(map(len, rows), dtype=np.int64, count=len(rows))
        led = np.insert(word, np.cumsum(sizes) - sizes, len(coded))
        at = np.arange(len(word)) + np.repeat(np.arange(1, len(rows) + 1), sizes)
        before = led[at - 1]
        context, have, back = tail[before], size[before], 1
        open_ = np.flatnonzero(have < depth)
        while len(open_):                       # one token further back, until depth bytes are known
            back += 1
            before = led[at[open_] - back]
            context[open_] |= tail[before] << 8 * have[open_]
            have[open_] += size[before]
            open_ = open_[have[open_] < depth]
        context &= _mask(depth)
    else:
        context = np.full(len(word), spaces, dtype=np.int64)
    width = len(coded).bit_length()
    if 8 * depth + width < 64:                  # context and word fit one number
        pairs, pair = np.unique(context << width | word, return_inverse=True)
        return pairs >> width, pairs & (1 << width) - 1, pair
    known, number = np.unique(context, return_inverse=True)
    pairs, pair = np.unique(number * max(1, len(coded)) + word, return_inverse=True)
    return known[pairs // max(1, len(coded))], pairs % max(1, len(coded)), pair


def pair_grams(coded: list[bytes], context: np.ndarray, word: np.ndarray, depth: int, most: int = 1_000_000):
    """(gram, pair) of all bytes of all pairs, about ``most`` bytes at a time: a
    gram is the ``depth`` bytes before a byte and the byte, as one number."""
    size = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded))
    first = np.cumsum(size) - size
    text = np.frombuffer(b"".join(coded), dtype=np.uint8)
    ends, lo = np.cumsum(size[word]), 0
    while lo < len(word):
        hi = max(lo + 1, int(np.searchsorted(ends, most + (ends[lo - 1] if lo else 0), side="right")))
        n = size[word[lo:hi]]
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        start = np.cumsum(n + depth) - (n + depth)
        at = np.repeat(start, n) + inside
        flat = np.empty(len(inside) + depth * len(n), dtype=np.uint8)
        for k in range(depth):
            flat[start + k] = context[lo:hi] >> 8 * (depth - 1 - k) & 255
        flat[at + depth] = text[np.repeat(first[word[lo:hi]], n) + inside]
        gram = np.zeros(len(inside), dtype=np.int64)
        for k in range(depth + 1):
            gram = gram << 8 | flat[at + k]
        yield gram, np.repeat(np.arange(lo, hi), n)
        lo = hi


def block_grams(words: list[bytes], rows: list[np.ndarray], held: list, depth: int, across: bool):
    """The distinct grams of a block, ascending, and their training occurrences."""
    coded = _coded(words)
    context, word, pair = context_pairs(coded, rows, depth, across)
    learnt = np.repeat([not h for h in held], list(map(len, rows)))
    times = np.bincount(pair[learnt], minlength=len(word))
    parts, size = [], 0
    for gram, owner in pair_grams(coded, context, word, depth):
        parts.append(_summed(gram, times[owner]))
        size += len(parts[-1][0])
        if size > 4_000_000:
            parts = [_summed(*map(np.concatenate, zip(*parts)))]
            size = len(parts[0][0])
    return _summed(*map(np.concatenate, zip(*parts))) if parts else (times[:0], times[:0])


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, ascending, and the sum of ``n`` of each."""
    order = np.argsort(keys)
    keys = keys[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[starts], np.add.reduceat(n[order], starts)


def _log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function for x >= 1/2, by Stirling's series at x + 7."""
    y = x + 7.0
    series = 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y)
    below = x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5) * (x + 6)
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - F.log(below)


def kt_log(n0: Column, n1: Column) -> Column:
    """Logarithm of the Krichevsky-Trofimov probability of n0 zeros and n1 ones."""
    a, b = n0.cast("double"), n1.cast("double")
    return _log_gamma(a + 0.5) + _log_gamma(b + 0.5) - math.log(math.pi) - _log_gamma(a + b + 1.0)


def _mask(depth: int) -> int:
    return (1 << 8 * depth) - 1


def _bits(grams: DataFrame) -> DataFrame:
    """Eight rows per gram: context, tree of the bit (a one and the bits before it),
    bit, n. Grams are dealt out by context (at most 256 each) before they are copied."""
    sym = "(gram & 255)"
    return (grams.select(F.expr("shiftright(gram, 8)").alias("ctx"), "gram", "n").repartition("ctx")
            .select("*", F.explode(F.expr("sequence(0, 7)")).alias("k"))
            .select("ctx", F.expr(f"cast(shiftleft(1L, k) | shiftright({sym}, 8 - k) as int)").alias("node"),
                    F.expr(f"cast(shiftright({sym}, 7 - k) & 1 as int)").alias("bit"), "n"))


def gram_scores(grams: DataFrame, depth: int) -> DataFrame:
    """(gram, lp): log10 probability of each gram's byte after its context,
    from (gram, n) with ``n`` training occurrences (0 for grams only to score)."""
    bits = _bits(grams)
    level = stage_table(bits.groupBy("ctx", "node").agg(
        F.sum(F.when(F.col("bit") == 0, F.col("n")).otherwise(0)).alias("n0"),
        F.sum(F.when(F.col("bit") == 1, F.col("n")).otherwise(0)).alias("n1"))
        .withColumn("lw", kt_log(F.col("n0"), F.col("n1"))).withColumn("beta", F.lit(1.0)), f"ctw-{depth}")
    levels = {depth: level}
    for d in range(depth - 1, -1, -1):          # bottom up: weighted probabilities
        up = (level.withColumn("ctx", F.col("ctx").bitwiseAND(_mask(d))).groupBy("ctx", "node")
              .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("lw").alias("below")))
        pe, below = kt_log(F.col("n0"), F.col("n1")), F.col("below")
        top = F.greatest(F.col("pe"), below)
        lw = top + F.log(F.exp(F.col("pe") - top) + F.exp(below - top)) - math.log(2)
        level = stage_table(up.withColumn("pe", pe).withColumn("lw", lw)
                            .withColumn("beta", F.exp(F.col("pe") - math.log(2) - F.col("lw")))
                            .select("ctx", "node", "n0", "n1", "lw", "beta"), f"ctw-{d}")
        levels[d] = level
    ones = (F.col("n1") + 0.5) / (F.col("n0") + F.col("n1") + 1.0)
    path = levels[0].select("ctx", "node", (F.col("beta") * ones).alias("p1"), (1 - F.col("beta")).alias("rest"))
    for d in range(1, depth + 1):               # top down: mix along the path
        above = path.select(F.col("ctx").alias("actx"), F.col("node").alias("anode"),
                            F.col("p1").alias("ap1"), F.col("rest").alias("arest"))
        here = levels[d]
        path = (here.join(above, (F.col("ctx").bitwiseAND(_mask(d - 1)) == F.col("actx"))
                          & (F.col("node") == F.col("anode")))
                .select("ctx", "node", (F.col("ap1") + F.col("arest") * F.col("beta") * ones).alias("p1"),
                        (F.col("arest") * (1 - F.col("beta"))).alias("rest")))
    # one row per context, its at most 255 trees in a map
    path = path.groupBy(F.col("ctx").alias("pctx")).agg(
        F.map_from_entries(F.collect_list(F.struct("node", "p1"))).alias("p1s"))
    node = "cast(shiftleft(1L, k) | shiftright(gram & 255, 8 - k) as int)"
    one = "shiftright(gram & 255, 7 - k) & 1 = 1"
    total = f"aggregate(sequence(0, 7), 0D, (a, k) -> a + log10(CASE WHEN {one} THEN p1s[{node}] ELSE 1 - p1s[{node}] END))"
    return (grams.select("gram").join(path, F.expr("shiftright(gram, 8)") == F.col("pctx"))
            .select("gram", F.expr(total).alias("lp")))


# --- the corpus ---------------------------------------------------------------

def score(documents: DataFrame, held_out: Column, *, depth: int = 5, id_col: str = "doc_id",
          text_col: str = "text", block_chars: int = 12_000_000, docs_per_row: int = 128,
          across: bool = False) -> DataFrame:
    """Per row of ``documents``: id, n_tokens, n_known, train_tokens, base_score,
    score, n_bytes, bits_per_byte. Rows where ``held_out`` is true (or NULL) are
    scored only. ``across`` lets contexts run over the spaces between words."""
    if not 0 <= depth <= 6:
        raise ValueError("contexts hold at most 6 bytes")
    spark = documents.sparkSession
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    source = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                              F.when(F.coalesce(held_out, F.lit(True)), 1)
                              .when(F.col(id_col).isNull(), 2).otherwise(0).alias("held"))     # 0: learnt from
    id_sql = source.schema["id"].dataType.simpleString()
    if id_sql != "string":
        source, id_sql = source.withColumn("id", F.col("id").cast("bigint")), "bigint"
    id_type = pa.string() if id_sql == "string" else pa.int64()
    blocks = _Blocks(block_chars, buckets)

    schema = {"block": pa.int64(), "bucket": pa.int32(), "words": pa.binary(), "counts": pa.binary(),
              "grams": pa.binary(), "n": pa.binary(), "ids": pa.list_(id_type), "held": pa.list_(pa.int32()),
              "places": pa.binary()}

    def part(block, **columns):
        size = len(next(iter(columns.values())))
        columns["block"] = np.full(size, block)
        return pa.RecordBatch.from_arrays([pa.array(columns[c], t) if c in columns else pa.nulls(size, t)
                                           for c, t in schema.items()], names=list(schema))

    def counted(batches):
        for block, ids, outs, rows, words, packed in blocks(batches):
            bucket, own, counts = zip(*packed)
            yield part(block, bucket=bucket, words=own, counts=counts)
            cuts = [slice(lo, lo + docs_per_row) for lo in range(0, len(ids), docs_per_row)]
            yield part(block, ids=[ids[c] for c in cuts], held=[outs[c] for c in cuts],
                       places=[pack([planes(r.astype("<u4")) for r in rows[c]]) for c in cuts])
            gram, n = block_grams(words, rows, outs, depth, across)
            del ids, outs, rows, words, packed, own, counts
            bucket = gram % SPREAD % buckets
            order = np.argsort(bucket, kind="stable")           # ascending inside a bucket
            gram, n, bucket = gram[order], n[order].astype("<i8"), bucket[order]
            starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            cuts = [slice(a, b) for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(gram)])]
            yield part(block, bucket=bucket[starts], grams=[pack_sorted(gram[c]) for c in cuts],
                       n=[planes(n[c]) for c in cuts])
            del gram, n, bucket, order
            pa.default_memory_pool().release_unused()

    both = stage_table(source.mapInArrow(counted, "block bigint, bucket int, words binary, counts binary, grams binary, "
                                                  f"n binary, ids array<{id_sql}>, held array<int>, places binary"),
                       "lm-words", compression="zstd")
    local = both.where("words IS NOT NULL").select("block", "bucket", "words", "counts")
    grams = both.where("grams IS NOT NULL").select("block", "bucket", "grams", "n")
    placed = both.where("places IS NOT NULL").select("block", "ids", "held", "places")
    merged = stage_table(local.select("bucket", "words", "counts").repartition(buckets, "bucket")
                         .sortWithinPartitions("bucket")
                         .mapInArrow(_merge, "bucket int, words binary, counts binary, total bigint, seen bigint"),
                         "lm-counts")
    sums = merged.agg(F.sum("total").alias("n"), F.sum("seen").alias("v")).first()
    total, distinct = sums["n"] or 0, sums["v"] or 0
    summed = (grams.select("bucket", "grams", "n").repartition(buckets, "bucket").sortWithinPartitions("bucket")
              .mapInArrow(_merge_grams, "gram bigint, n bigint"))
    scores = gram_scores(stage_table(summed, "lm-gram-counts"), depth)
    packed = (scores.select(F.expr(f"cast(gram % {SPREAD} % {buckets} as int)").alias("bucket"), "gram", "lp")
              .repartition(buckets, "bucket").sortWithinPartitions("bucket", "gram")
              .mapInArrow(_pack_scores, "bucket int, grams binary, lp binary"))
    packed = stage_table(packed, "lm-gram-scores", compression="zstd")
    back = (packed.select(F.lit(-1).cast("bigint").alias("block"), "bucket", "grams", "lp")
            .unionByName(grams.select("block", "bucket", "grams", F.lit(None).cast("binary").alias("lp")))
            .repartition(buckets, "bucket").sortWithinPartitions("bucket", "block")
            .mapInArrow(_answer_grams, "block bigint, bucket int, grams binary, lp binary"))

    asked = merged.select("bucket", F.lit(-1).cast("bigint").alias("block"), "words", "counts").unionByName(
        local.select("bucket", "block", "words", F.lit(None).cast("binary").alias("counts")))
    answers = (asked.repartition(buckets, "bucket").sortWithinPartitions("bucket", "block")
               .mapInArrow(_answer, "block bigint, bucket int, words binary, counts binary"))
    none = F.lit(None).cast("binary")
    known = answers.select("*", none.alias("grams"), none.alias("lp")).unionByName(
        back.select("block", "bucket", none.alias("words"), none.alias("counts"), "grams", "lp"))

    def assemble(known: pa.Table, docs: pa.Table) -> pa.Table:
        found = known.filter(known["grams"].is_valid())
        at = np.concatenate([unpack_sorted(raw) for raw in found["grams"].to_pylist()])
        lp = np.concatenate([from_planes(raw, "<f8") for raw in found["lp"].to_pylist()])
        order = np.argsort(at)
        at, lp = at[order], lp[order]
        words = known.filter(known["words"].is_valid()).sort_by("bucket").select(["words", "counts"])
        del known, found, order
        coded = _coded([w for blob in words["words"].to_pylist() for w in unpack(blob)])
        size = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded))
        count = np.frombuffer(b"".join(words["counts"].to_pylist()), "<i8")
        base = np.log10((count + 0.1) / (total + 0.1 * (distinct + 1)))
        rows = [from_planes(raw, "<u4") for blob in docs["places"].to_pylist() for raw in unpack(blob)]
        context, word, pair = context_pairs(coded, rows, depth, across)
        own = np.zeros(len(word))
        for gram, owner in pair_grams(coded, context, word, depth):
            order = np.argsort(gram)            # ascending lookups stay near each other
            own += np.bincount(owner[order], lp[np.searchsorted(at, gram[order])], minlength=len(word))
        out = {"id": [doc for ids in docs["ids"].to_pylist() for doc in ids],
               "held": [h == 1 for held in docs["held"].to_pylist() for h in held],
               "n_tokens": list(map(len, rows)), "n_known": [], "base_score": [], "score": [], "n_bytes": [],
               "bits_per_byte": []}
        lo = 0
        for row in rows:                        # every text has its end, so no row is empty
            score_ = float(own[pair[lo:lo + len(row)]].sum())
            lo += len(row)
            out["n_known"].append(int((count[row] > 0).sum()))
            out["base_score"].append(float(base[row].sum()))
            out["score"].append(score_)
            out["n_bytes"].append(int(size[row].sum()))
            out["bits_per_byte"].append(-score_ * math.log2(10) / out["n_bytes"][-1])
        pa.default_memory_pool().release_unused()
        return pa.Table.from_pydict({n: pa.array(v, id_type if n == "id" else None) for n, v in out.items()})

    done = (known.groupBy("block").cogroup(placed.groupBy("block"))
            .applyInArrow(assemble, f"id {id_sql}, held boolean, n_tokens bigint, n_known bigint, "
                                     "base_score double, score double, n_bytes bigint, bits_per_byte double"))
    return done.select(F.col("id").alias(id_col), F.col("held").alias("held_out"), "n_tokens", "n_known",
                       F.lit(total).cast("bigint").alias("train_tokens"), "base_score", "score", "n_bytes", "bits_per_byte")


def _merge_grams(batches):
    """Rows sorted by bucket: the distinct grams of a bucket and their counts."""
    bucket, parts, size = None, [], 0

    def emit():
        gram, n = _summed(*map(np.concatenate, zip(*parts)))
        for lo in range(0, len(gram), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(gram[lo:lo + 100_000], pa.int64()),
                                              pa.array(n[lo:lo + 100_000], pa.int64())], names=["gram", "n"])
    for batch in batches:
        for k, grams, n in zip(*(c.to_pylist() for c in batch.columns)):
            if k != bucket:
                if parts:
                    yield from emit()
                bucket, parts, size = k, [], 0
            parts.append((unpack_sorted(grams), from_planes(n, "<i8")))
            size += len(parts[-1][0])
            if len(parts) > 1 and size > max(2_000_000, 2 * len(parts[0][0])):
                parts = [_summed(*map(np.concatenate, zip(*parts)))]
                size = len(parts[0][0])
    if parts:
        yield from emit()


def _pack_scores(batches):
    """Rows sorted by bucket and gram: one row per bucket."""
    last, parts = None, []

    def emit():
        gram, lp = map(np.concatenate, zip(*parts))
        return pa.RecordBatch.from_arrays([pa.array([last], pa.int32()), pa.array([pack_sorted(gram)], pa.binary()),
                                           pa.array([planes(lp.astype("<f8"))], pa.binary())], names=["bucket", "grams", "lp"])
    for batch in batches:
        bucket, gram, lp = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else []
        for a, b in zip(starts, [*starts[1:], len(bucket)]):
            if bucket[a] != last:
                if parts:
                    yield emit()
                last, parts = int(bucket[a]), []
            parts.append((gram[a:b].copy(), lp[a:b].copy()))
    if parts:
        yield emit()


def _answer_grams(batches):
    """Rows sorted by bucket, its scores (block -1) first: each block's grams and
    their scores in the same order."""
    at, lp = None, None
    for batch in batches:
        out = []
        for block, bucket, grams, scores in zip(*(c.to_pylist() for c in batch.columns)):
            if block < 0:
                at, lp = unpack_sorted(grams), from_planes(scores, "<f8")
                continue
            out.append((block, bucket, grams, planes(lp[np.searchsorted(at, unpack_sorted(grams))])))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*out), (pa.int64(), pa.int32(), pa.binary(), pa.binary()))], names=["block", "bucket", "grams", "lp"])


def _merge(batches):
    """Rows sorted by bucket: one row per bucket with its distinct words and counts."""
    bucket, known = None, {}

    def emit():
        counts = np.fromiter(known.values(), dtype="<i8", count=len(known))
        return pa.RecordBatch.from_pydict({
            "bucket": pa.array([bucket], pa.int32()), "words": pa.array([pack(list(known))], pa.binary()),
            "counts": pa.array([counts.tobytes()], pa.binary()), "total": pa.array([int(counts.sum())], pa.int64()),
            "seen": pa.array([int((counts > 0).sum())], pa.int64())})
    for batch in batches:
        for k, words, counts in zip(*(c.to_pylist() for c in batch.columns)):
            if k != bucket:
                if known:
                    yield emit()
                bucket, known = k, {}
            for w, n in zip(unpack(words), np.frombuffer(counts, "<i8").tolist()):
                known[w] = known.get(w, 0) + n
    if known:
        yield emit()


def _answer(batches):
    """Rows sorted by bucket, its table (block -1) first: each block's words and
    the table's counts in their order."""
    place, count = {}, None
    for batch in batches:
        out = []
        for bucket, block, words, counts in zip(*(c.to_pylist() for c in batch.columns)):
            own = unpack(words)
            if block < 0:
                place = {w: k for k, w in enumerate(own)}
                count = np.frombuffer(counts, "<i8")
                continue
            at = np.fromiter((place[w] for w in own), dtype=np.int64, count=len(own))
            out.append((block, bucket, words, count[at].tobytes()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*out), (pa.int64(), pa.int32(), pa.binary(), pa.binary()))],
                names=["block", "bucket", "words", "counts"])
