"""Registered queries on whole small tables: SQL, clashing columns, held-out rows."""

from __future__ import annotations

import collections

import duckdb
import pytest
from hard_rows import SMALL
from pyspark.sql import functions as F
from tidemark.llm import mixing
from tidemark.llm.common import read
from tidemark.llm.queries import ORACLES, QUERIES

MIDDLE = "/root/testdata/sf0.01"


@pytest.mark.parametrize("folder", [SMALL, MIDDLE])
def test_mixing_equals_sql(spark, folder):
    df = QUERIES["op1_source_mixing"](spark, folder)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet')")
    want = con.sql(ORACLES["op1_source_mixing"])
    assert set(want.columns) == set(df.columns)
    got = collections.Counter(tuple(r[c] for c in want.columns) for r in df.collect())
    assert got and got == collections.Counter(want.fetchall())


def test_mixing_keeps_clashing_columns(spark):
    docs = read(spark, SMALL, "documents")
    names = ["mix_domain", "_mix_domain", "__mix_lang", "_copies", "_whole", "_LAST", "epoch", "tokens", "given", "last_key"]
    clash = docs.select("*", *[F.concat(F.lit("own"), F.col("doc_id")).alias(n) for n in names])
    plain = mixing.mix(docs, *mixing.document_tree(), share=0.7)
    out = mixing.mix(clash, *mixing.document_tree(), share=0.7)
    assert out.columns == [*clash.columns, "__mix_domain", "mix_lang", "mix_source", "_epoch"]
    rows = out.collect()
    assert all(r[n] == f"own{r['doc_id']}" for r in rows for n in names)
    assert (collections.Counter((r["doc_id"], r["__mix_domain"], r["_epoch"]) for r in rows)
            == collections.Counter((r["doc_id"], r["mix_domain"], r["epoch"]) for r in plain.collect()))


@pytest.mark.parametrize("name, label", [("op9_toxicity", "toxic"), ("op10_quality_classifier", "quality")])
def test_classifiers_on_held_out_rows(spark, name, label):
    labels = {r["doc_id"]: r[label] for r in read(spark, MIDDLE, "labels").collect()}
    rows = [r for r in QUERIES[name](spark, MIDDLE).collect() if r["held_out"] and labels.get(r["doc_id"]) is not None]
    hits = sum(r["predicted"] == labels[r["doc_id"]] for r in rows)
    most = collections.Counter(labels[r["doc_id"]] for r in rows).most_common(1)[0][1]
    print(name, len(rows), hits / len(rows), most / len(rows))
    assert len(rows) >= 50 and hits / len(rows) > 0.9 and hits > most
