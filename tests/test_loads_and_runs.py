"""Loads that survive bad rows, typed JSON values, audited runs."""

import pytest
from conftest import AS_OF, cond, rule
from pyspark.sql import types as T

from ruleforge import RuleSet
from ruleforge.functions.json_lookup import json_typed
from ruleforge.operators.stages import Stage, write_audited_run
from ruleforge.sources.files import read_csv_with_rejects

SCHEMA = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType()), T.StructField("c", T.BooleanType())])


def test_mixed_folder_is_split_into_good_and_rejected(spark, tmp_path):
    (tmp_path / "one.csv").write_text('"a","b","c"\n1,x,true\n2,"y, z",false\nthree,x,true\n\n4,x\n5,x,true,more\n,,\n')
    (tmp_path / "swapped.csv").write_text("c,a,b\r\ntrue,7,p\r\nmaybe,8,q\r\n")
    (tmp_path / "other.csv").write_text("a,b,d\n1,x,true\n2,y,false\n")
    (tmp_path / "empty.csv").write_text("")
    good, rejected = read_csv_with_rejects(spark, str(tmp_path), SCHEMA)
    assert good.dtypes == [("a", "int"), ("b", "string"), ("c", "boolean")]
    rows = sorted((tuple(r) for r in good.collect()), key=str)
    assert rows == sorted([(1, "x", True), (2, "y, z", False), (None, None, None), (7, "p", True)], key=str)
    bad = sorted((r["file"].rsplit("/", 1)[1], r["row"].strip(), r["reason"].split()[0]) for r in rejected.collect())
    assert bad == [("one.csv", "4,x", "the"), ("one.csv", "5,x,true,more", "the"), ("one.csv", "three,x,true", "the"),
                   ("other.csv", "1,x,true", "no"), ("other.csv", "2,y,false", "no"), ("other.csv", "a,b,d", "no"),
                   ("swapped.csv", "maybe,8,q", "the")]
    assert good.count() + rejected.count() == 11  # every line but the headers and the blank one
    assert good.select("b").where("a = 1").count() == 1  # a pruned read finds the same rows


def test_orders_through_csv_and_back(spark, tmp_path):
    from ruleforge.sources.files import read_csv_table, write_csv
    sf = "/root/testdata/sf0.001"
    orders = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    write_csv(orders.repartition(3), str(tmp_path / "csv"))
    back = read_csv_table(spark, str(tmp_path / "csv"), orders.schema)
    good, rejected = read_csv_with_rejects(spark, str(tmp_path / "csv"), orders.schema)
    want = sorted(tuple(r) for r in orders.collect())
    assert sorted(tuple(r) for r in back.collect()) == want == sorted(tuple(r) for r in good.collect())
    assert rejected.count() == 0


def test_json_values_keep_their_types(spark):
    df = spark.createDataFrame([('{"n": 12345678901234567890, "x": 1.10, "o": {"l": [1, null, "t"]}, "z": null}',), ("not json",), (None,)], "j string")
    got = [tuple(r) for r in df.select(json_typed("j", "$.n", "decimal(20,0)"), json_typed("j", "$.x", "decimal(5,2)"),
                                       json_typed("j", "$.o.l", "array<string>"), json_typed("j", "$.z", "int"),
                                       json_typed("j", "$.x", "boolean"), json_typed("j", "$.o.l[0]", "int")).collect()]
    assert str(got[0][0]) == "12345678901234567890" and str(got[0][1]) == "1.10"
    assert got[0][2] == ["1", None, "t"] and got[0][3] is None and got[0][5] == 1
    assert got[1] == got[2] == (None,) * 6


def test_audited_run_counts_while_it_writes(spark, atm, tmp_path):
    rules = RuleSet.from_rules(spark, [rule("big", [cond("transaction_total_amount", ">=", "10000")]),
                                       rule("cash", [cond("cash_amount", ">=", "5000")]), rule("off", [cond("id", "=", "1")], is_valid="false")])
    stages = [Stage("big", "identification", "query_builder"), Stage("cash", "identification", "query_builder")]
    out, audit = str(tmp_path / "out"), str(tmp_path / "audit")
    for run_id in ("r1", "r2", "r1"):  # a repeated run replaces itself
        run = write_audited_run(rules, atm, stages, out, audit, run_id, as_of=AS_OF, table_name="atm_transactions")
        assert run.ok
    rows = sorted((r["run_id"], r["stage"], r["rule_id"], r["rows_out"]) for r in spark.read.parquet(audit).collect())
    big, both = atm.where("transaction_total_amount >= 10000").count(), atm.where("transaction_total_amount >= 10000 and cash_amount >= 5000").count()
    assert 0 < both < big
    assert rows == [(i, s, rid, n) for i in ("r1", "r2") for s, rid, n in ((0, "big", big), (1, "cash", both))]
    assert spark.read.parquet(out).groupBy("run_id").count().collect()[0]["count"] == both
    run = write_audited_run(rules, atm, [stages[0], Stage("off", "identification", "query_builder"), stages[1]], out, audit, "r3", as_of=AS_OF)
    statuses = [r["status"] for r in spark.read.parquet(audit).where("run_id = 'r3'").orderBy("stage").collect()]
    assert run.df is None and statuses == ["ok", "rejected", "skipped"]
    with pytest.raises(ValueError):
        write_audited_run(rules, atm, stages, out, audit, "../x", as_of=AS_OF)
