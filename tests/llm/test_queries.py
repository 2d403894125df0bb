from __future__ import annotations

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from starmart.llm import decontamination, forest, quality, secrets
from starmart.llm.oracle import SQL
from starmart.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="given tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return c


def test_registered():
    names = contract.queries()
    assert {*QUERIES, "pipeline"} <= set(names) and set(SQL) <= set(QUERIES) and set(SQL) <= set(contract.oracle_sql())
    assert sorted(int(x[2:].split("_")[0]) for x in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", SQL)
def test_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    want = con.sql(SQL[name])
    assert sorted(want.columns) == columns
    at = [want.columns.index(c) for c in columns]
    assert Counter(tuple(r[c] for c in columns) for r in df.collect()) == Counter(tuple(r[i] for i in at) for r in want.fetchall())


@pytest.mark.parametrize("name", [x for x in QUERIES if x not in SQL])
def test_one_row_for_each_row(spark, name):
    table, key = ("pages", "page_id") if name.startswith(("op3_", "op6_", "op7_")) else ("documents", "doc_id")
    source = spark.read.parquet(f"{SF_DIR}/{table}.parquet")
    assert Counter(r[0] for r in QUERIES[name](spark, SF_DIR).select(key).collect()) == Counter(r[0] for r in source.select(key).collect())


def test_pipeline_stages(spark, frame):
    """Each stage against its operator's verdicts on the stage's own input, from rows with nulls and columns of other names."""
    given = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = [(r.doc_id, r.text) for r in given.collect()]
    docs = frame([*texts, texts[0], (None, texts[1][1]), (10**6, None), (10**6 + 1, "")])
    bench = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    ids = lambda df: sorted(str(r[0]) for r in df.select("doc_id").collect())
    functions = dict(corpus_pipeline.STAGES)
    assert list(functions) == ["quality_rules", "jaccard_join", "benchmark_decontamination", "secret_scans", "sentencepiece"]

    kept = functions["quality_rules"](spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    assert ids(kept) == ids(quality.judged(docs, quality.trained(docs, labels)).where("kept"))

    single = functions["jaccard_join"](spark, kept, SF_DIR)
    assert single.columns == docs.columns and ids(single) == sorted({str(r.class_id) for r in forest.joined(kept).collect()})

    clean = functions["benchmark_decontamination"](spark, single, SF_DIR)
    assert ids(clean) == ids(decontamination.contamination(single, bench).where("not contaminated"))

    safe = functions["secret_scans"](spark, clean, SF_DIR)
    assert safe.columns == docs.columns and ids(safe) == ids(clean)
    assert secrets.scanned(safe).where("n_assign + n_access + n_hex > 0").count() == 0

    coded = functions["sentencepiece"](spark, safe, SF_DIR)
    assert coded.columns == ["doc_id", "ids", "n_tokens"] and ids(coded) == ids(safe)


def test_pipeline_run(spark):
    got = corpus_pipeline.run(spark, SF_DIR)
    assert got.columns == ["doc_id", "ids", "n_tokens"] and got.count() > 50
