"""The pipeline's stages on small tables, and the queries that SQL can
express against DuckDB."""

import pytest

import __spark_entry__ as E
import corpus_pipeline as C
from oracle_check import compare, duck

SF = "/root/testdata/sf0.001"


def test_stage_names_and_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in C.STAGES] == ["quality_classifier", "line_dedup", "simhash_near_dedup", "mix_sources", "sentencepiece_ids"]
    for name, stage in C.STAGES:
        out = stage(spark, docs, SF)
        if name != "sentencepiece_ids":
            assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in docs.schema]


def test_run_matches_stage_by_stage(spark, tmp_path):
    docs, sizes = spark.read.parquet(f"{SF}/documents.parquet"), []
    for k, (_, stage) in enumerate(C.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        sizes.append(docs.count())
    assert 100 < sizes[0] < 200 and sizes[1] == sizes[0] and sizes[2] <= sizes[1] and sizes[4] == sizes[3]
    got = C.run(spark, SF)
    key = lambda df: sorted((r.doc_id, r.ids_sha256) for r in df.collect())
    assert key(got) == key(docs)


def test_stages_on_edges(spark, edge_docs, no_docs):
    for _, stage in C.STAGES:
        assert stage(spark, no_docs, SF).count() == 0
        assert stage(spark, edge_docs, SF).count() >= 1


@pytest.mark.parametrize("name", ["op4_mixing", "op7_suffix_dedup", "op9_line_dedup"])
def test_query_matches_sql(spark, name):
    r = compare(spark, duck(SF), name, E.queries()[name], E.oracle_sql()[name], SF)
    assert r["ok"], r


def test_all_queries_are_registered():
    names = E.queries()
    assert all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 11)) and "pipeline" in names
