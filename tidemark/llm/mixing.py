"""Mixing sources to target weights, in DataFrame operations only.

A tree of levels (domain, language, source) gets a token budget. At every node
the budget goes to the children in proportion to their weights, but no child
takes more than its subtree can supply (``max_epochs`` times its tokens); what
a child cannot take goes to its siblings in proportion to their weights, and
only what all of them cannot take goes up. Since a node's own supply bounds
what it is given, one pass from the root settles both: siblings before
ancestors. Shares are whole tokens, rounded down.

A leaf given A tokens with T of its own takes every document ``A div T`` times
and, in the epoch after those, the documents in seeded hash order up to and
including the one that reaches the rest. Every epoch has its own order.

The order's threshold is found by three levels of 256 ranges of the 48-bit hash
per leaf, then inside one range of 2^24 per leaf, so no window holds a leaf: a
leaf with a third of all rows is summed in parts. The tree's tables are one row
per leaf. Choosing rows is then a comparison with the leaf's threshold; the
texts are read once more for it and never sorted.

NULL level values are a group of their own (shown as ``''``); a NULL text has 0
tokens; NULL ids share one hash. Rows with equal ids have equal hashes and are
taken together. An empty table, a zero budget or a leaf without tokens gives no
rows. Columns of the documents are never overwritten: a new column whose name is
taken gets underscores in front.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, stage_table

WORD = r"[^\x20\x09-\x0D]+"


def token_count(text_col: str) -> Column:
    return F.expr(f"coalesce(regexp_count({text_col}, '{WORD}'), 0)".replace("\\", "\\\\")).cast("bigint")


def order_key(seed: int, epoch: Column, id_col: Column) -> Column:
    """48 bits of the md5 of seed, epoch and id."""
    text = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(id_col.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("bigint")


def _share(nodes: DataFrame, parent: list[str]) -> DataFrame:
    """``given`` per child from ``budget`` of its parent, ``cap`` and ``weight``
    (all decimal): children are saturated in order of cap per weight."""
    siblings = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    ordered = siblings.orderBy(F.expr("CASE WHEN weight > 0 THEN cast(cap as double) / cast(weight as double) "
                                      "ELSE cast('Infinity' as double) END"), "name")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("decimal(38,0)")
    seen = (nodes.withColumn("cap_before", F.coalesce(F.sum("cap").over(before), zero).cast("decimal(38,0)"))
            .withColumn("weight_before", F.coalesce(F.sum("weight").over(before), zero).cast("decimal(38,0)"))
            .withColumn("weight_all", F.sum("weight").over(siblings).cast("decimal(38,0)")))
    full = seen.withColumn("full", F.expr("cap * (weight_all - weight_before) <= weight * (budget - cap_before)"))
    rest = (full.withColumn("cap_full", F.sum(F.when(F.col("full"), F.col("cap")).otherwise(zero)).over(siblings)
                            .cast("decimal(38,0)"))
            .withColumn("weight_rest", F.sum(F.when(F.col("full"), zero).otherwise(F.col("weight"))).over(siblings)
                        .cast("decimal(38,0)")))
    return rest.withColumn("given", F.expr(
        "cast(CASE WHEN full THEN cap WHEN weight_rest = 0 THEN 0 "
        "ELSE cast(weight * (budget - cap_full) as decimal(38,0)) div weight_rest END as decimal(38,0))"))


def allocate(leaves: DataFrame, levels: list[str], weights: list[Column], share: float,
             max_epochs: int) -> DataFrame:
    """``leaves`` (level columns and ``tokens``) with ``given`` tokens per leaf.

    ``weights[k]`` is a whole-number expression over the first ``k + 1`` levels."""
    caps = leaves.withColumn("cap", (F.col("tokens") * max_epochs).cast("decimal(38,0)"))
    total = caps.agg(F.floor(F.coalesce(F.sum("tokens"), F.lit(0)) * F.lit(share)).cast("decimal(38,0)").alias("t"),
                     F.coalesce(F.sum("cap"), F.lit(0)).cast("decimal(38,0)").alias("c")).first()
    budget, given = min(total["t"], total["c"]), None
    for k, level in enumerate(levels):
        path = levels[:k + 1]
        nodes = (caps.groupBy(*path).agg(F.sum("cap").cast("decimal(38,0)").alias("cap"))
                 .withColumn("weight", F.greatest(weights[k], F.lit(0)).cast("decimal(38,0)"))
                 .withColumn("name", F.col(level)))
        if k == 0:
            nodes = nodes.withColumn("budget", F.lit(budget).cast("decimal(38,0)"))
        else:
            nodes = nodes.join(given, levels[:k])
        given = _share(nodes, levels[:k]).select(*path, F.col("given").alias("budget"))
    return leaves.join(given, levels).withColumn("given", F.col("budget").cast("bigint")).drop("budget")


def thresholds(rows: DataFrame, leaf: list[str]) -> DataFrame:
    """Per leaf the largest key of the prefix that reaches ``target`` tokens.

    ``rows``: leaf columns, ``key`` (48 bits), ``tokens``, ``target`` > 0."""
    sums = rows.groupBy(*leaf, "target", F.shiftright("key", 24).alias("r")).agg(F.sum("tokens").alias("tokens"))
    sums = stage_table(sums, "mixing-ranges")
    found = None
    for level in (16, 8, 0):
        part = (sums.groupBy(*leaf, "target", F.shiftright("r", level).alias("r"))
                .agg(F.sum("tokens").alias("tokens")))
        found = stage_table(_crossing(part, found, leaf, 8), "mixing-crossing")
    inside = (rows.join(found.withColumnRenamed("r", "_r"), leaf).where(F.shiftright("key", 24) == F.col("_r"))
              .groupBy(*leaf, "target", "key", "base").agg(F.sum("tokens").alias("tokens")))
    running = F.col("base") + F.sum("tokens").over(Window.partitionBy(*leaf).orderBy("key"))
    return (inside.withColumn("reached", running).where(F.col("reached") >= F.col("target"))
            .groupBy(*leaf).agg(F.min("key").alias("last_key")))


def _crossing(part: DataFrame, found: DataFrame | None, leaf: list[str], shift: int) -> DataFrame:
    """The range in which the running sum reaches the target, and the sum before it."""
    if found is None:
        part = part.withColumn("base", F.lit(0).cast("bigint"))
    else:
        part = part.join(found.withColumnRenamed("r", "_r"), leaf).where(F.shiftright("r", shift) == F.col("_r"))
    running = F.col("base") + F.sum("tokens").over(Window.partitionBy(*leaf).orderBy("r"))
    return (part.withColumn("reached", running).where(F.col("reached") >= F.col("target"))
            .groupBy(*leaf).agg(F.min(F.struct("r", (F.col("reached") - F.col("tokens")).alias("base"))).alias("at"))
            .select(*leaf, "at.r", "at.base"))


def mix(documents: DataFrame, levels: dict[str, Column], weights: list[Column], *, share: float = 0.6,
        max_epochs: int = 2, seed: int = 11, id_col: str = "doc_id", text_col: str = "text",
        epoch_col: str = "epoch") -> DataFrame:
    """The chosen rows of ``documents`` with all their columns, the level
    columns (prefixed ``mix_``) and the epoch, one row per document and epoch.

    ``share`` is the budget as a part of all tokens."""
    if max_epochs < 1 or not 0 <= share:
        raise ValueError("max_epochs must be positive and share not negative")
    leaf = [f"mix_{name}" for name in levels]
    values = [F.coalesce(value.cast("string"), F.lit("")) for value in levels.values()]
    narrow = stage_table(documents.select(*[v.alias(c) for v, c in zip(values, leaf)], F.col(id_col).cast("string").alias("id"),
                                          token_count(f"`{text_col}`").alias("tokens")), "mixing")
    leaves = narrow.groupBy(*leaf).agg(F.sum("tokens").alias("tokens")).where("tokens > 0")
    # written tables have a known size: Spark broadcasts them only below its threshold
    given = stage_table(allocate(leaves, leaf, weights, share, max_epochs)
                        .withColumn("whole", F.expr("given div tokens"))
                        .withColumn("target", F.expr("given - (given div tokens) * tokens")), "mixing-leaves")
    wanted = given.where("target > 0").select(*leaf, "whole", "target")
    keyed = narrow.join(wanted, leaf).select(*leaf, "target", "tokens",
                                             order_key(seed, F.col("whole"), F.col("id")).alias("key"))
    last = thresholds(keyed, leaf)
    shown = [fresh(documents, c) for c in leaf]
    on = [fresh(documents, f"_of_{c}") for c in leaf]
    whole, cut, copies = (fresh(documents, c) for c in ("_whole", "_last", "_copies"))
    plan = stage_table(given.select(*leaf, "whole").join(last, leaf, "left")
                       .select(*[F.col(c).alias(n) for c, n in zip(leaf, on)], F.col("whole").alias(whole),
                               F.coalesce("last_key", F.lit(-1)).alias(cut)), "mixing-plan")
    named = documents.select("*", *[v.alias(n) for v, n in zip(values, shown)])
    key = order_key(seed, F.col(whole), F.col(id_col))
    chosen = (named.join(plan, [F.col(a) == F.col(b) for a, b in zip(shown, on)])
              .withColumn(copies, F.col(whole) + F.when(key <= F.col(cut), 1).otherwise(0)).where(F.col(copies) > 0))
    return (chosen.withColumn(fresh(documents, epoch_col), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(copies) - 1)))
            .drop(copies, whole, cut, *on))


# Production parameters of the registered query and the pipeline: the table has
# no domain, so a source's domain is a rule on its name.
def domain_of(source: Column) -> Column:
    return F.concat(F.lit("d"), F.coalesce(F.crc32(source) % 4, F.lit(0)).cast("string"))


def document_tree() -> tuple[dict[str, Column], list[Column]]:
    levels = {"domain": domain_of(F.col("source")), "lang": F.col("lang"), "source": F.col("source")}
    weights = [F.lit(4) - F.substring("mix_domain", 2, 1).cast("int"),
               F.when(F.col("mix_lang") == "en", 3).otherwise(1), F.lit(1)]
    return levels, weights
