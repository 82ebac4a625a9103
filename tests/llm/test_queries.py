import pytest
from compare import compare

from fieldloom.llm import queries

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "p1_found": ["batch_id", "seed_version", "git_sha", "stage"], "p2_found": ["partition_key"], "p3_found": ["origin", "doc_id", "field_name", "tier"], "p4_found": ["correction_id", "source_field", "canonical_name"],
    "p5_found": ["doc_id", "field_name", "tier"], "p6_ids": ["doc_id", "ids"], "p8_found": ["doc_id"],
}


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    assert compare(spark, SF, name, queries.QUERIES[name], queries.SQL[name]) == ""


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_runs(spark, name):
    df = queries.QUERIES[name](spark, SF)
    assert df.columns == COLUMNS.get(name, df.columns)
    got = [str(r) for r in df.collect()]
    if name.endswith("_found"):
        assert len(got) == len(set(got))
