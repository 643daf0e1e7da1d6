"""The registered queries ``opN_<name>`` and their DuckDB SQL.

Each query applies one operator to its whole table and derives the columns of
its contract. Helper columns are built on a selection of the needed columns, so
extra columns of a table cannot clash with them.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.llm.bpe import decode_rows, encode, read_ranks
from tidemark.llm.common import fold, in_fold, read
from tidemark.llm.ctw import score
from tidemark.llm.digest import neighbours
from tidemark.llm.embedding_dedup import near_duplicates as near_duplicate_vectors
from tidemark.llm.langid import language
from tidemark.llm.mixing import document_tree, mix
from tidemark.llm.oracles import ORACLES  # noqa: F401
from tidemark.llm.pages import main_text
from tidemark.llm.quality import quality_scores
from tidemark.llm.resampling import resample
from tidemark.llm.secret_scan import spans_text, with_spans
from tidemark.llm.simhash import near_duplicates
from tidemark.llm.toxicity import toxic_scores
from tidemark.llm.variants import group_variants


def op1_source_mixing(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return (mix(docs, *document_tree(), share=0.6, max_epochs=2, seed=11)
            .select("doc_id", F.col("mix_domain").alias("domain"), F.col("mix_lang").alias("lang"),
                    F.col("mix_source").alias("source"), "epoch"))


def op2_secret_scan(spark, sf_dir):
    docs = with_spans(read(spark, sf_dir, "documents").select("doc_id", "text"), "base", "added", keep_rest=True)

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")
    return docs.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                       F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"),
                       spans_text(F.concat("base", "added")).alias("spans"))


def op6_byte_bpe(spark, sf_dir):
    import public_tokenizers
    ranks = read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return decode_rows(encode(docs, ranks, public_tokenizers.PATTERN), ranks)


def op3_context_tree_scores(spark, sf_dir):
    return score(read(spark, sf_dir, "documents").select("doc_id", "text"), in_fold("doc_id", 10, 0), across=True)


def op4_quartile_digest(spark, sf_dir):
    return neighbours(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_simhash_near_dedup(spark, sf_dir):
    return near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"), shingle=3, bits=2)


def op7_embedding_near_dedup(spark, sf_dir):
    return near_duplicate_vectors(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"), least=0.9)


def op8_language_id(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    usable = F.coalesce(fold("doc_id", 3) != 1, F.lit(False))
    return language(docs, usable).select("doc_id", in_fold("doc_id", 3, 1).alias("held_out"), "lang_pred", "score")


def op9_toxicity(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").select("doc_id", "toxic")
    return (toxic_scores(docs, labels, fold("doc_id", 3) != 1)
            .select("doc_id", in_fold("doc_id", 3, 1).alias("held_out"), "score",
                    F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted")))


def op10_quality_classifier(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").select("doc_id", "quality")
    return (quality_scores(docs, labels, fold("doc_id", 5) != 0)
            .select("doc_id", in_fold("doc_id", 5, 0).alias("held_out"), "score",
                    F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted")))


def op11_page_text(spark, sf_dir):
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return main_text(pages).select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op12_spelling_variants(spark, sf_dir):
    return group_variants(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_importance_resampling(spark, sf_dir):
    return resample(read(spark, sf_dir, "documents").select("doc_id", "text"),
                    read(spark, sf_dir, "benchmark").select("text"))


QUERIES = {f.__name__: f for f in (
    op1_source_mixing, op2_secret_scan, op3_context_tree_scores, op4_quartile_digest,
    op5_simhash_near_dedup, op6_byte_bpe, op7_embedding_near_dedup, op8_language_id,
    op9_toxicity, op10_quality_classifier, op11_page_text, op12_spelling_variants, op13_importance_resampling)}
