"""Plans that must stay as they are: pruning, pushdown, no row-at-a-time Python."""

import pytest

from lakekit.plans import catalog
from lakekit.sources import inventory

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_the_columns_it_needs_and_pushes_the_filter(spark):
    plan = plan_of(catalog.queries()["scan_parquet"](spark, SF_DIR))
    assert "ReadSchema: struct<l_quantity:double,l_returnflag:string,l_linestatus:string,l_shipdate:timestamp_ntz>" in plan
    assert "GreaterThan(l_shipdate" in plan.split("PushedFilters")[1]


def test_top_k_does_not_sort_everything(spark):
    assert "TakeOrderedAndProject" in plan_of(catalog.queries()["query_limited"](spark, SF_DIR))


def test_top_one_per_group_is_limited_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan_of(catalog.queries()["sql_top1_per_group"](spark, SF_DIR))


def test_metadata_never_reads_bodies(spark):
    assert "content" not in inventory.inventory_from_files(spark, SF_DIR, "*.parquet").columns


@pytest.mark.parametrize("key", ["decode_rows_nested", "label_join_back", "sql_subquery", "sql_lateral", "sql_join_anti",
                                 "sql_join_theta", "tokenize_documents", "run_resources_flatten"])
def test_no_product_and_no_python(spark, key):
    plan = plan_of(catalog.queries()[key](spark, SF_DIR))
    for trait in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert trait not in plan
