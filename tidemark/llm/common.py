"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import checkpoint_path, checkpoint_root

ARROW = {"string": pa.string(), "double": pa.float64(), "int": pa.int32(), "bigint": pa.int64(),
         "boolean": pa.bool_(), "binary": pa.binary()}


ROWS_AT_ONCE = 256


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a variant of it that no column of ``df`` uses."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (NULL for a NULL id)."""
    return F.crc32(F.col(id_col).cast("string")) % folds


def in_fold(id_col: str, folds: int, k: int) -> Column:
    """Whether the row is in fold ``k``; a NULL id is in none."""
    return F.coalesce(fold(id_col, folds) == k, F.lit(False))


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared checkpoint folder (small tables)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def stage_table(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it
    back: a lineage cut that stays columnar and compressed. ``options`` go to
    the Parquet writer."""
    spark = df.sparkSession
    path = checkpoint_path(spark, f"llm-{name}-{uuid.uuid4().hex}")
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, usable: Column,
                    rows: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """At most ``rows`` rows (_id, _text, _label) for a classifier's fit, first in
    id-hash order, with whole texts; a table, so that features are made in tasks.

    ``usable`` is a condition on the label table's id. Labels of a repeated id
    are merged with ``max``; NULL ids and labels are left out; a NULL text is
    empty; of rows that repeat an id, the smallest text is taken. The id sample
    has at most ``rows`` rows, so broadcasting it is bounded.
    """
    picked = (labels.where(usable & F.col(label).isNotNull() & F.col(id_col).isNotNull())
              .groupBy(F.col(id_col).alias("_id")).agg(F.max(label).cast("int").alias("_label"))
              .orderBy(F.xxhash64("_id"), "_id").limit(rows))
    texts = documents.select(F.col(id_col).alias("_doc"),
                             F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    joined = texts.join(F.broadcast(picked), F.col("_doc") == F.col("_id"))
    out = joined.groupBy("_id").agg(F.min("_text").alias("_text"), F.max("_label").alias("_label"))
    return stage_table(out, "labelled-sample")


def add_columns(df: DataFrame, text_col: str, fields: dict[str, str],
                make: Callable[[], Callable[[list], dict]]) -> DataFrame:
    """Append columns computed from whole texts, ``ROWS_AT_ONCE`` rows at a time.

    ``make`` runs once per task and returns a function from a list of texts
    (NULLs given as ``None``) to ``{name: list}``. Rows keep their order and
    all their columns; memory is bounded by one batch.
    """
    schema = T.StructType(list(df.schema.fields)
                          + [T.StructField(n, T._parse_datatype_string(t)) for n, t in fields.items()])

    def run(batches):
        fn = make()
        for whole in batches:
            for lo in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(lo, ROWS_AT_ONCE)
                made = fn(batch.column(batch.schema.get_field_index(text_col)).to_pylist())
                arrays = list(batch.columns) + [pa.array(made[n], ARROW[t]) for n, t in fields.items()]
                yield pa.RecordBatch.from_arrays(arrays, names=list(batch.schema.names) + list(fields))
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def sigmoid(x):
    import numpy as np
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
