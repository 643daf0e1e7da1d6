"""Spelling variants by asymmetric q-chunks.

Words of one edit (one code point inserted, deleted or replaced) are linked. A
word of length L contributes two disjoint chunks, its first and its last
``L // 2`` code points: one edit touches at most one of them. The other word
contributes the positional grams a chunk can equal: for each length L it may be
compared with (its own, one less, one more), the grams of L's chunk length that
lie at a chunk's place, or shifted by the difference of the lengths, which is at
most one. Grams further off could never pass the shift condition, so they are not
made. As the rest of the word also differs by one edit only, each chunk
and gram is joined together with the first or the last half of that rest, one of
which is untouched as well; so three quarters of a word are in the key. Pairs
that meet are verified with the edit distance.

Only distinct words enter the join, however often they occur. A key that more
than ``most`` words share is not compared pair by pair: its words join on their
one-deletion variants within the key, after which a group holds only words two
edits apart at most. That path is exact too.

A word's form is its linked word of largest count, if that is at least ``ratio``
times its own count; the root follows forms to the last one. Counts grow by
``ratio`` at every step, so the chain is short and pointer doubling ends in a few rounds.

NULL and empty texts have no words. A NULL id is hashed as an empty text. Rows that
repeat an id or a text count as often as they occur. No words give an empty result.
Other columns of the input are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stage_table

RUN = "[a-z\\\\u00C0-\\\\u00FF]+"          # in SQL text, on lower-cased ASCII letters


def count_words(documents: DataFrame, *, least_length: int = 7, least_count: int = 2, drop_one_in: int = 31,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of the distinct words of whole texts. A run whose crc32 with its
    document's id is divisible by ``drop_one_in`` loses one code point."""
    rows = documents.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                            F.translate(F.col(text_col), string.ascii_uppercase, string.ascii_lowercase).alias("text"))
    runs = (rows.select("id", F.explode(F.expr(f"regexp_extract_all(text, '{RUN}', 0)")).alias("w"))
            .where(F.length("w") >= least_length)
            .withColumn("h", F.crc32(F.concat("id", F.lit(":"), "w").cast("binary"))))
    at = "cast(h % length(w) as int)"
    word = F.expr(f"if(h % {drop_one_in} = 0, concat(substring(w, 1, {at}), substring(w, {at} + 2)), w)")
    return (runs.select(word.alias("word")).where(F.length("word") >= least_length)
            .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count))


def _keys(length: str, own: str) -> str:
    """Array of the four keys of a word (column ``word`` of length ``own``) seen as
    one that is compared under ``length``: chunk and half of the rest."""
    q, out = f"int({length} / 2)", []
    half = f"int(({length} - {q}) / 2)"
    for tag, chunk, rest in ((0, f"substring(word, 1, {q})", f"substring(word, {q} + 1)"),
                             (1, f"substring(word, {own} - {q} + 1)", f"substring(word, 1, {own} - {q})")):
        size = f"({own} - {q})"
        for side, piece in ((0, f"substring({rest}, 1, {half})"),
                            (1, f"substring({rest}, {size} - {half} + 1)")):
            out.append(f"concat_ws(' ', {length}, '{tag}{side}', {chunk}, {piece})")
    return f"array({', '.join(out)})"


def near_pairs(words: DataFrame, *, least_length: int = 7, most: int = 256) -> DataFrame:
    """(a, b), a < b: every pair of words at edit distance one, once."""
    sized = words.select("word", F.length("word").alias("m"))
    chunks = sized.select("word", F.explode(F.expr(_keys("m", "m"))).alias("key"))
    lengths = [f"if(m + {d} >= {least_length}, {_keys(f'(m + {d})', 'm')}, array())" for d in (-1, 0, 1)]
    grams = sized.select("word", F.explode(F.expr(f"concat({', '.join(lengths)})")).alias("key"))
    # keys that chunks and grams of more than one word share, with how many words do
    both = chunks.withColumn("gram", F.lit(0)).unionByName(grams.withColumn("gram", F.lit(1)))
    size = (both.groupBy("key").agg(F.sum("gram").alias("grams"), F.sum(1 - F.col("gram")).alias("chunks"))
            .where((F.col("chunks") > 0) & (F.col("grams") > 1)))
    # every word's chunk is also its own gram, so a key of one word has one gram
    live = stage_table(both.join(size.select("key", F.greatest("grams", "chunks").alias("size")), "key"),
                       "variant-keys")
    cool, hot = live.where(F.col("size") <= most), live.where(F.col("size") > most)
    x = cool.where("gram = 0").select("key", F.col("word").alias("x"))
    y = cool.where("gram = 1").select("key", F.col("word").alias("y"))
    met = x.join(y, "key").where("x < y").select("x", "y")
    variants = F.expr("concat(array(word), transform(sequence(1, length(word)), "
                      "i -> concat(substring(word, 1, i - 1), substring(word, i + 1))))")
    spread = hot.select("key", "gram", "word", F.explode(F.array_distinct(variants)).alias("left"))
    u = spread.where("gram = 0").select("key", "left", F.col("word").alias("x"))
    v = spread.where("gram = 1").select("key", "left", F.col("word").alias("y"))
    met_hot = u.join(v, ["key", "left"]).where("x < y").select("x", "y")
    return (met.union(met_hot).where(F.expr("levenshtein(x, y, 1) = 1"))
            .select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())


def group_variants(documents: DataFrame, *, ratio: int = 10, least_length: int = 7, least_count: int = 2,
                   drop_one_in: int = 31, most: int = 256, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n), one row per word."""
    words = stage_table(count_words(documents, least_length=least_length, least_count=least_count,
                                    drop_one_in=drop_one_in, id_col=id_col, text_col=text_col), "variant-words")
    pairs = stage_table(near_pairs(words, least_length=least_length, most=most), "variant-pairs")
    # (a word, the count of a word near it), then the best near word per word
    ways = pairs.union(pairs.select("b", "a"))
    other = words.select(F.col("word").alias("b"), F.col("n").alias("bn"))
    # min over (-n, word): the largest count, ties to the smallest word
    best = (ways.join(other, "b").groupBy("a")
            .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("bn")).alias("less"), "b")).alias("top")))
    joined = words.join(best, F.col("word") == F.col("a"), "left")
    strong = -F.col("top.less") >= F.col("n") * ratio
    table = stage_table(joined.select("word", F.when(strong, F.col("top.b")).alias("form"), "n",
                                      F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
                                      F.when(strong, -F.col("top.less")).alias("form_n")), "variant-forms")
    # roots of the words that have a form; a step that leads to none ends there
    step = table.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        on = step.select(F.col("word").alias("w"), F.col("root").alias("further"))
        longer = step.join(on, F.col("root") == F.col("w"), "left")
        if longer.where("w IS NOT NULL").isEmpty():
            break
        step = stage_table(longer.select("word", F.coalesce("further", "root").alias("root")), "variant-roots")
    return (table.join(step, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
