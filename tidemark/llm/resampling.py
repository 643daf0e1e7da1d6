"""Target-distribution importance resampling.

A document is the bag of its hashed word n-grams. The logarithm of the target's
share of a bucket over the corpus's share, floored to thousandths, is the
bucket's gain; a document's weight is the sum of its features' gains, looked up
in one array of ``buckets`` numbers (the only thing that passes the driver, and
its size is a parameter). Seeded Gumbel noise turns the weights into scores whose
``k`` highest are a weighted draw without replacement.

The cutoff is found by counting, not by sorting: every round counts how many
candidates reach each of ``cuts`` thresholds that divide the interval left, over
the written table of scores, and keeps the interval in which ``k`` falls; ties
at the cutoff are split in the same way by id. Only the drawn rows are then
range-partitioned and numbered.

NULL and empty texts have no words: no features, weight 0. A NULL id is hashed
as an empty text and comes after all others in a tie. Rows that repeat an id are
separate rows; of equal score and id, those with fewer features come first and
equal ones share the ranks in any order. An empty corpus gives an empty result;
with an empty target every bucket has its smoothed share. Other columns of the
input are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stage_table

WORD = r"[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"        # in SQL text, on lower-cased ASCII letters


def words(text: Column) -> Column:
    lower = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_extract_all(lower, F.expr(f"'{WORD}'"), F.lit(0))


def features(docs: DataFrame, text_col: str, most_words: int, buckets: int) -> DataFrame:
    """``docs`` with ``_words`` (how many) and ``_at``: the bucket of every run of
    1 to ``most_words`` consecutive words."""
    runs = []
    for size in range(1, most_words + 1):
        run = "w" if size == 1 else f"array_join(slice(_w, i + 1, {size}), ' ')"
        hashed = f"cast(crc32(cast({run} as binary)) % {buckets} as int)"
        runs.append(f"transform(_w, w -> {hashed})" if size == 1 else
                    f"if(size(_w) < {size}, array(), transform(sequence(0, size(_w) - {size}), i -> {hashed}))")
    at = runs[0] if len(runs) == 1 else f"concat({', '.join(runs)})"
    return (docs.withColumn("_w", words(F.col(text_col)))
            .withColumn("_words", F.size("_w").cast("bigint")).withColumn("_at", F.expr(at)).drop("_w"))


def bucket_counts(made: DataFrame) -> DataFrame:
    """(bucket, n): features per bucket, combined before the shuffle."""
    return made.select(F.explode("_at").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int) -> list[int]:
    """Thousandths of ln(target share / corpus share) per bucket, both smoothed by one."""
    spark = corpus.sparkSession
    both = (bucket_counts(corpus).withColumn("t", F.lit(0).cast("bigint")).withColumnRenamed("n", "s")
            .unionByName(bucket_counts(target).withColumn("s", F.lit(0).cast("bigint")).withColumnRenamed("n", "t"))
            .unionByName(spark.range(buckets).selectExpr("cast(id as int) bucket", "0L s", "0L t"))
            .groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")))
    whole = Window.partitionBy()                    # ``buckets`` rows
    share = both.select("bucket", "s", "t", F.sum("s").over(whole).alias("s_all"), F.sum("t").over(whole).alias("t_all"))
    ratio = (F.col("t") + 1).cast("double") * (F.col("s_all") + buckets).cast("double") / (
        (F.col("s") + 1).cast("double") * (F.col("t_all") + buckets).cast("double"))
    rows = share.select("bucket", F.floor(F.log(ratio) * 1000).alias("gain")).collect()
    out = [0] * buckets
    for r in rows:
        out[r["bucket"]] = r["gain"]
    return out


def noise(id_col: str, seed: int) -> Column:
    """Thousandths of seeded Gumbel noise, from the first 32 bits of a SHA-256 of the id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(F.log(-F.log((h.cast("double") + 0.5) / 4294967296.0)) * -1000)


def cutoff(rows: DataFrame, col: str, k: int, cuts: int = 32) -> int | None:
    """The largest value v of a long column such that at least ``k`` rows have
    ``col >= v``; by counting. ``None`` for fewer than ``k`` rows, or ``k`` 0."""
    ends = rows.agg(F.min(col).alias("lo"), F.max(col).alias("hi"), F.count(col).alias("n")).first()
    if k <= 0 or ends["n"] < k:
        return None
    lo, hi = ends["lo"], ends["hi"]                 # the answer lies in lo..hi
    while lo < hi:
        step = -(-(hi - lo) // cuts)
        marks = list(range(lo + step, hi, step)) + [hi]
        found = rows.agg(*[F.count_if(F.col(col) >= m).alias(f"m{k_}") for k_, m in enumerate(marks)]).first()
        at = sum(n >= k for n in found)             # counts fall as marks rise
        lo, hi = (marks[at - 1] if at else lo), (marks[at] - 1 if at < len(marks) else hi)
    return lo


def ranked(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` with ``_place`` 1, 2, 3... in ``order``: range-partitioned and sorted,
    written, and numbered by the sizes of the partitions before."""
    laid = stage_table(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                       .withColumn("_row", F.monotonically_increasing_id()), name)
    part = F.shiftright("_row", 33)
    sizes = laid.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)     # one row a partition
    starts = sizes.select(F.col("_part"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    return (laid.withColumn("_part", part).join(starts, "_part")
            .withColumn("_place", F.col("_start") + F.col("_row").bitwiseAND((1 << 33) - 1) + 1)
            .drop("_part", "_start", "_row"))


def resample(documents: DataFrame, target: DataFrame, *, percent: int = 10, most_words: int = 1,
             buckets: int = 10_000, least_words: int = 20, seed: int = 2024, cuts: int = 32,
             id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text") -> DataFrame:
    """(id, n_features, weight, score, rank) of every document; ``rank`` numbers the
    ``percent`` % of the documents of at least ``least_words`` words that are drawn.
    The id is an integer column."""
    id_type = documents.schema[id_col].dataType.simpleString()
    docs = documents.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    corpus = stage_table(features(docs, "text", most_words, buckets).drop("text"), "resample-features")
    wanted = stage_table(features(target.select(F.col(target_text_col).alias("text")), "text", most_words, buckets)
                         .select("_at"), "resample-target")
    table = ",".join(map(str, gains(corpus, wanted, buckets)))
    weight = F.expr(f"aggregate(_at, 0L, (sum, i) -> sum + cast(split('{table}', ',') as array<bigint>)[i])")
    scored = stage_table(corpus.select("id", "_words", F.size("_at").cast("bigint").alias("n_features"),
                                       weight.alias("weight"))
                         .withColumn("score", F.col("weight") + noise("id", seed)), "resample-scores")
    able = scored.where(F.col("_words") >= least_words)
    k = able.count() * percent // 100
    least = cutoff(able.select("score"), "score", k, cuts)
    named = [F.col("id").cast(id_type).alias(id_col), "n_features", "weight", "score"]
    if least is None:
        return scored.select(*named, F.lit(None).cast("bigint").alias("rank"))
    tied = able.where(F.col("score") == least)
    # the tied rows still wanted have the smallest ids: the largest negated ids
    left = k - able.where(F.col("score") > least).count()
    last = cutoff(tied.select((-F.col("id")).alias("id")), "id", left, cuts)
    in_tie = F.lit(True) if last is None else F.coalesce(F.col("id") <= -last, F.lit(False))
    chosen = F.coalesce((F.col("_words") >= least_words)
                        & ((F.col("score") > least) | ((F.col("score") == least) & in_tie)), F.lit(False))
    order = [F.desc("score"), F.asc_nulls_last("id"), F.asc("n_features")]
    drawn = ranked(scored.where(chosen), order, "resample-drawn")
    rank = F.when(F.col("_place") <= k, F.col("_place")).cast("bigint").alias("rank")
    return (drawn.select(*named, rank)
            .unionByName(scored.where(~chosen).select(*named, F.lit(None).cast("bigint").alias("rank"))))
