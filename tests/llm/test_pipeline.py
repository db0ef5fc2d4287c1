from __future__ import annotations

import pytest

import corpus_pipeline as P
from petitionlens.llm import queries

from corpus_cases import DOCS, SF


@pytest.fixture(scope="module")
def tables(spark, docs, tmp_path_factory):
    """A folder with awkward documents, some labels and no benchmark item."""
    root = tmp_path_factory.mktemp("tables")
    docs.write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, None), (2, "the quick brown fox jumps")], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return str(root)


@pytest.mark.parametrize("number", range(5))
def test_each_stage_on_awkward_and_empty_documents(spark, docs, tables, number):
    _, stage = P.STAGES[number]
    for table in (docs, spark.createDataFrame([], DOCS)):
        out = stage(spark, table, tables)
        rows = out.collect()
        if number < 4:
            assert out.columns == table.columns and len(rows) <= table.count()
        if number == 2:
            assert len(rows) == table.count()


def test_stages_take_effect(spark):
    sf = SF.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    sizes = [docs.count()]
    bad = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").where("quality = 0").collect()}
    good = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1").collect()}
    for i, (_, stage) in enumerate(P.STAGES[:-1]):
        docs = P.materialise(stage(spark, docs, sf))
        sizes.append(docs.count())
        if i == 0:
            kept = {r.doc_id for r in docs.select("doc_id").collect()}
            assert len(kept & good) > 0.95 * len(good) and len(kept & bad) < 0.8 * len(bad)
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3] > sizes[4]
    total = {}
    for r in P.pack(spark, docs, sf).select("doc_id", "length", "doc_tokens").collect():
        total.setdefault(r.doc_id, [0, r.doc_tokens])[0] += r.length
    assert len(total) == sizes[4] and all(a == b for a, b in total.values())


def test_registry_has_each_operator_once():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)
