"""Physical-plan checks: rules stay scan-side and shuffle-free."""

import os
import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")

NO_SHUFFLE = ["flt_query_lookup", "pred_ge", "pred_eq", "pred_expr_operand", "pred_like", "pred_not_like",
              "pred_and", "pred_or", "pred_precedence", "pred_bool", "goto_chain", "conditional_goto",
              "conditional_gated", "then_flag", "transform_column", "transform_steps", "rule_validity_asof", "staged_filter_identify",
              "multi_rule_hits", "multi_rule_flags", "lookup_value_key", "lookup_entries"]

PUSHED = {
    "pred_ge": "GreaterThanOrEqual(o_totalprice,100000.0)",
    "pred_eq": "EqualTo(c_mktsegment,BUILDING)",
    "pred_like": "StringStartsWith(p_type,ECON)",
    "pred_not_like": "Not(StringStartsWith(p_type,ECON))",
    "pred_or": "Or(EqualTo(o_orderstatus,F),GreaterThanOrEqual(o_totalprice,200000.0))",
    "conditional_gated": "EqualTo(event_type,purchase)",
    "flt_query_lookup": "EqualTo(l_returnflag,R)",
}

READ = {
    "pred_ge": "struct<o_orderkey:bigint,o_totalprice:double>",
    "pred_like": "struct<p_partkey:bigint,p_type:string>",
    "lookup_value_key": "struct<event_id:bigint,props:string>",
    "ordered_result": "struct<o_orderkey:bigint,o_totalprice:double>",
}


def _plan(spark, name):
    before = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")  # display only: no "..." cut
    try:
        df = E.queries()[name](spark, SF)
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", before)


@pytest.mark.parametrize("name", NO_SHUFFLE)
def test_rule_queries_add_no_exchange(spark, name):
    assert "Exchange" not in _plan(spark, name)


@pytest.mark.parametrize("name", sorted(PUSHED))
def test_predicates_reach_the_scan(spark, name):
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", _plan(spark, name)).group(1)
    assert PUSHED[name] in pushed


@pytest.mark.parametrize("name", sorted(READ))
def test_only_used_columns_are_read(spark, name):
    assert f"ReadSchema: {READ[name]}" in _plan(spark, name)


def test_staged_rules_fuse_into_one_scan(spark):
    plan = _plan(spark, "staged_filter_identify")
    assert plan.count("FileScan parquet") == 1 and plan.count("Filter ") == 1


def test_aggregates_combine_map_side(spark):
    for name in ("groupby_lookup", "elapsed_minutes", "rule_hit_counts"):
        df = E.queries()[name](spark, SF)
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        phys = df._jdf.queryExecution().executedPlan().toString()
        assert "collect_list" not in plan and "collect_set" not in plan
        assert "partial_" in phys, name


def test_rules_as_data_hits_need_no_join(spark):
    plan = _plan(spark, "rules_as_data_join")
    assert "Join" not in plan and "Exchange" not in plan
    assert re.search(r"\*\(\d+\) Generate", plan)  # inside whole-stage codegen


def test_rule_hits_stay_in_one_codegen_stage(spark):
    plan = _plan(spark, "multi_rule_hits")
    stages = set(re.findall(r"\*\((\d+)\) (?:Generate|Filter|Project|ColumnarToRow)", plan))
    assert len(stages) == 1 and len(re.findall(r"\*\(\d+\) Generate", plan)) == plan.count("Generate ") == 2


@pytest.mark.parametrize("name", ["rule_hit_counts_240", "rules_as_data_counts_240"])
def test_many_rule_counts_scan_once(spark, name):
    assert _plan(spark, name).count("FileScan parquet") == 1
