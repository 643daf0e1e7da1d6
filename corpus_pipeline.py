"""A training corpus from raw documents: five stages, each calling one operator.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its
predecessor kept; all but the last return the columns of ``documents``.
``run`` writes each stage's result to the shared checkpoint folder as Parquet
and reads it back for the next one.

Stages keep rows with NULL ids, languages or sources; NULL and empty texts are
scored, scanned and encoded like empty ones. Helper columns take names that the
documents do not use.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe import decode_rows, encode, read_ranks
from tidemark.llm.common import fold, fresh, read, stage_table
from tidemark.llm.mixing import document_tree, mix
from tidemark.llm.quality import quality_scores
from tidemark.llm.secret_scan import redacted, with_spans
from tidemark.llm.simhash import fingerprint_groups, fingerprints


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores under 0.3 go."""
    labels = read(spark, sf_dir, "labels").select("doc_id", "quality")
    score = fresh(docs, "quality_score")
    scored = quality_scores(docs, labels, fold("doc_id", 5) != 0, score_col=score)
    return scored.where(F.col(score) >= 0.3).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash group stays (3-word shingles, two bits): the one
    with the smallest id (a NULL id last), of equal ids the one whose text has the
    smallest SHA-256, of equal rows any one."""
    fp, row = fresh(docs, "_fp"), fresh(docs, "_row")
    marked = stage_table(fingerprints(docs, fp, shingle=3).withColumn(row, F.monotonically_increasing_id()), "dedup-rows")
    rows = marked.select(F.col("doc_id").alias("id"), F.col(fp).alias("fp"), F.col(row).alias("row"),
                         F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"))
    groups = fingerprint_groups(rows.select("id", "fp"), bits=2)
    # combined map-side: a group of any size sends one row per task
    kept = (rows.join(groups, F.col("fp") == F.col("wfp")).groupBy("group")
            .agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "digest", "row")).alias("best"))
            .select(F.col("best.row").alias("kept_row")))
    return marked.join(kept, F.col(row) == F.col("kept_row"), "left_semi").select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every stretch of text that a secret span covers becomes ``[SECRET]``."""
    base, added, spans = (fresh(docs, n) for n in ("_base", "_added", "_spans"))
    clean = redacted("text", spans)
    out = (with_spans(docs, base, added, keep_rest=True).withColumn(spans, F.concat(base, added))
           .withColumn("text", clean))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size(spans) > 0, F.length("text")).otherwise(F.col("n_chars"))
                             .cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the weights of the domain-language-source tree; one
    row for each epoch a document is drawn in."""
    return mix(docs, *document_tree(), share=0.6, max_epochs=2, seed=11,
               epoch_col=fresh(docs, "_epoch")).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document (digests), and of the bytes they decode to."""
    ranks = read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return decode_rows(encode(docs, ranks, public_tokenizers.PATTERN), ranks)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("secret_scan", secret_scan),
          ("mixing", mixing), ("tokens", tokens)]

# The classifier and the tokenizer have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
