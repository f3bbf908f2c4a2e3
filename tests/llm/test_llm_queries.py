"""Queries of the subpackage against SQL, and the pipeline."""

import pytest
from pyspark.sql import functions as F
from oracle import differences

import corpus_pipeline
import __spark_entry__ as catalog
from wakeline.llm import langid, queries

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def test_all_are_registered():
    names = {*queries.REGISTRY, "pipeline"}
    assert names <= set(catalog.queries())
    assert {int(n[2:].split("_")[0]) for n in queries.REGISTRY} == set(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(lab, sf, name):
    assert differences(queries.REGISTRY[name](lab, sf), queries.ORACLES[name], sf) == []


def test_pipeline_stages(lab, small, tmp_path):
    docs = lab.read.parquet(f"{small}/documents.parquet")
    columns = docs.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id for r in docs.collect()}
        stage(lab, docs, small).write.parquet(str(tmp_path / name))
        docs = lab.read.parquet(str(tmp_path / name))
        rows = docs.collect()
        assert {r.doc_id for r in rows} <= before
        if i + 1 < len(corpus_pipeline.STAGES):
            assert docs.columns == columns
            assert all(r.n_chars == len(r.text) for r in rows)
    assert docs.filter("NOT round_trip").count() == 0
    whole = corpus_pipeline.run(lab, small)
    assert sorted((r.doc_id, r.n_tokens) for r in whole.collect()) == sorted((r.doc_id, r.n_tokens) for r in rows)


def test_pipeline_takes_odd_rows(lab, odd, small, tmp_path):
    docs = odd.drop("note")
    for name, stage in corpus_pipeline.STAGES:
        stage(lab, docs, small).write.parquet(str(tmp_path / name))
        docs = lab.read.parquet(str(tmp_path / name))
    assert docs.filter("NOT round_trip").count() == 0


def test_a_single_repeated_line_goes_in_the_pipeline(lab, small):
    """Shorter than any length limit, between neighbours that are not repeated with it."""
    docs = lab.read.parquet(f"{small}/documents.parquet").limit(0)
    rows = [(i, f"first of {i}\nshort line\n\nlast of {i}", "en", "x", 1) for i in range(3)]
    kept = corpus_pipeline.remove_lines(lab, lab.createDataFrame(rows, docs.schema), small)
    assert {r.doc_id: r.text for r in kept.collect()} == {0: rows[0][1], 1: "first of 1\n\nlast of 1", 2: "first of 2\n\nlast of 2"}


def test_rejected_documents_go(lab, small):
    docs = lab.read.parquet(f"{small}/documents.parquet")
    extra = lab.createDataFrame([(10**6, "1234 !!", "en", "x", 7), (10**6 + 1, None, None, "x", None)], docs.schema)
    kept = corpus_pipeline.language_id(lab, docs.union(extra), small)
    assert kept.filter("doc_id >= 1000000").count() == 0
    assert kept.count() == docs.count()
    assert langid.UNKNOWN not in {r.lang for r in kept.collect()}


def test_empty_tables(lab, small, tmp_path):
    for name in TABLES:
        table = lab.read.parquet(f"{small}/{name}.parquet")
        table.limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    full = {n: q(lab, small).columns for n, q in queries.REGISTRY.items()}
    for name, query in queries.REGISTRY.items():
        got = query(lab, str(tmp_path))
        assert (got.columns, got.count()) == (full[name], 0)
    assert corpus_pipeline.run(lab, str(tmp_path)).count() == 0


def test_tables_of_nulls(lab, small, tmp_path):
    for name in TABLES:
        table = lab.read.parquet(f"{small}/{name}.parquet")
        nulls = table.limit(5).select(*[F.lit(None).cast(t).alias(c) for c, t in table.dtypes])
        nulls.write.parquet(str(tmp_path / f"{name}.parquet"))
    rows = {n: q(lab, str(tmp_path)).count() for n, q in queries.REGISTRY.items()}
    assert rows == {n: 0 if n.startswith("op11_") else 5 for n in queries.REGISTRY}
    assert corpus_pipeline.run(lab, str(tmp_path)).count() == 0
