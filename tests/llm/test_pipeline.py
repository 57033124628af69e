"""The pipeline stage by stage, and the registered queries against their SQL."""

from __future__ import annotations

import pytest
from compare import differences

import corpus_pipeline
from ledgerloom.llm import queries
from test_operators import components, odd_rows, shingles  # noqa: F401

FOLDER = "/root/testdata/sf0.001"


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    for name in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", list(queries.SQL))
def test_query_against_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, FOLDER), duck(FOLDER), queries.SQL[name]) == []


def test_names():
    import __spark_entry__ as entry

    assert {f"op{n}" for n in range(1, 11)} == {name.split("_")[0] for name in queries.QUERIES}
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(queries.SQL) <= set(entry.oracle_sql())


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    given = {r["doc_id"]: r for r in docs.collect()}
    kept = stages["language"](spark, docs, FOLDER)
    assert kept.columns == columns
    texts = {r["doc_id"]: r["text"] for r in kept.collect()}
    lost = [i for i in given if i not in texts]
    assert len(lost) < 0.02 * len(given)
    single = stages["near_duplicates"](spark, kept, FOLDER)
    of = components(list(texts.items()))
    assert single.columns == columns
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(i for i, c in of.items() if i == c)
    clean = stages["secrets"](spark, single, FOLDER)
    assert clean.columns == columns and clean.count() == single.count()
    assert not [r for r in queries.find_secrets(clean).collect() if any(s["kind"] in ("assign", "access", "hex") for s in r["spans"])]
    mixed = stages["mixing"](spark, clean, FOLDER)
    assert mixed.columns == columns
    packed = stages["packing"](spark, mixed, FOLDER)
    assert packed.where("start = 0").count() == mixed.count()


def test_run(spark):
    assert corpus_pipeline.run(spark, FOLDER).count() > 0


def test_stages_take_odd_rows(spark):
    docs = spark.createDataFrame(odd_rows(), "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for rows in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            rows = stage(spark, rows, FOLDER)
        rows.collect()
