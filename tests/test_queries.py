import os

import pytest
from oracle import SF, rows_of_df, rows_of_sql

from lexbrook.plans import registry

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query_matches_its_sql(spark, name):
    df = registry.QUERIES[name](spark, SF)
    if name in registry.ORACLES:
        assert rows_of_df(df) == rows_of_sql(registry.ORACLES[name])
    else:
        assert df.count() > 0


def test_joins_are_no_products(spark):
    plan = registry.QUERIES["or_join_exploded"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scan_reads_only_what_is_asked(spark):
    plan = registry.QUERIES["text_length_by_source"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<source:string,n_chars:bigint>" in plan


def test_paragraphs_hold_whole_texts(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    found = {}
    for r in registry.QUERIES["structure_paragraphs"](spark, SF).collect():
        found.setdefault(r["decision_id"], []).append(r["text"])
    whole = {f"d{r['doc_id']}": r["text"] for r in rows if len(r["text"]) >= 500}
    assert len(whole) > 10 and set(whole) <= set(found)
    for k, text in whole.items():  # but for white space, where the text is cut
        assert "".join(text.split()) in "".join("".join(found[k]).split()), k


def test_citations_of_has_no_limit(spark):
    assert "Limit" not in registry.QUERIES["citations_of"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
