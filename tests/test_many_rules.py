"""Many rules in one scan, and threshold rules by position."""

import pytest
from pyspark.sql import functions as F
from conftest import AS_OF, cond, rule

from ruleforge import RuleSet
from ruleforge.errors import RuleConfigError
from ruleforge.operators.multi_rule import compile_rules, rule_flags, rule_hit_counts, rule_hits
from ruleforge.operators.rules_as_data import rules_as_data_hits, threshold_rules

KEYS = ["session_id", "id"]


@pytest.fixture(scope="module")
def rs(spark):
    return RuleSet.from_rules(spark, [
        rule("big_total", [cond("transaction_total_amount", ">=", "15000")]),
        rule("perth", [cond("city", "=", "perth")]),
        rule("none", [cond("cash_amount", ">", "1000000")]),
        rule("cash_small", [cond("cash_amount", "<", "3000")]),
        rule("chain", [cond("cash_amount", ">=", "1000")], ("goto", "perth")),
        rule("off", [cond("cash_amount", ">=", "1")], is_valid="false"),
    ])


def _brute(atm, pred_sql):
    return sorted((r.session_id, r.id) for r in atm.where(pred_sql).collect())


def test_hits_equal_one_filter_per_rule(rs, atm):
    batch = compile_rules(rs, atm, ["big_total", "perth", "none", "chain"], as_of=AS_OF)
    hits = rule_hits(atm, batch, KEYS).collect()
    got = {rid: sorted((r.session_id, r.id) for r in hits if r.rule_id == rid) for rid in batch.rule_ids}
    assert got["big_total"] == _brute(atm, "transaction_total_amount >= 15000")
    assert got["perth"] == _brute(atm, "city = 'perth'")
    assert got["none"] == []
    assert got["chain"] == _brute(atm, "cash_amount >= 1000 and city = 'perth'")
    counts = {r.rule_id: r.hits for r in rule_hit_counts(atm, batch).collect()}
    assert counts == {k: len(v) for k, v in got.items()}
    flags = rule_flags(atm, batch)
    assert flags.where("hit_perth").count() == len(got["perth"])


def test_rejected_rules_are_reported(rs, atm):
    with pytest.raises(RuleConfigError):
        compile_rules(rs, atm, ["big_total", "off"], as_of=AS_OF)
    batch = compile_rules(rs, atm, ["big_total", "off", "missing"], as_of=AS_OF, strict=False)
    assert batch.rule_ids == ["big_total"] and set(batch.rejected) == {"off", "missing"}


def test_many_generated_rules_spread_and_match(spark, atm):
    rules = [rule(f"g{i}", [cond("transaction_total_amount", ">=" if i % 2 else "<", str(500 * i))])
             for i in range(40)]
    batch = compile_rules(RuleSet.from_rules(spark, rules), atm, as_of=AS_OF)
    counts = {r.rule_id: r.hits for r in rule_hit_counts(atm, batch).collect()}
    for i in range(40):
        op = ">=" if i % 2 else "<"
        assert counts[f"g{i}"] == atm.where(f"transaction_total_amount {op} {500 * i}").count()


def test_rules_as_data_equals_filters(rs, atm):
    thr = threshold_rules(rs, atm, ["big_total", "none", "cash_small"], as_of=AS_OF)
    assert [t.rule_id for t in thr.rules] == ["big_total", "none", "cash_small"]
    full = sorted(tuple(r) for r in rules_as_data_hits(atm, thr, KEYS).collect())
    expect = sorted([k + ("big_total",) for k in _brute(atm, "transaction_total_amount >= 15000")]
                    + [k + ("cash_small",) for k in _brute(atm, "cash_amount < 3000")])
    assert full == expect
    plan = rules_as_data_hits(atm, thr, KEYS)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_threshold_rules_reject_non_thresholds(rs, atm):
    thr = threshold_rules(rs, atm, ["perth", "chain"], as_of=AS_OF, strict=False)
    assert thr.rules == [] and set(thr.rejected) == {"perth", "chain"}


def test_threshold_hit_counts_match_brute_force(spark):
    from ruleforge.operators import rules_as_data as RD
    from ruleforge.operators.rules_as_data import ThresholdRule, threshold_hit_counts
    vals = [0.0, -0.0, 1.0, 1.5, 2.0, 2.0, 3.25, float("nan"), None, float("inf"), -float("inf"), 10.0, 0.055]
    df = spark.createDataFrame([(i, v, (i * 7) % 5) for i, v in enumerate(vals)], "k int, x double, y int")
    ops = [">=", ">", "<=", "<", "=", "==", "!=", "<>"]
    rules = [ThresholdRule(f"r{i}_{j}", "x", op, t) for i, t in enumerate([0.0, 1.5, 2.0, 3.0, 10.0, 0.055])
             for j, op in enumerate(ops)]
    rules += [ThresholdRule(f"y{j}", "y", op, 2.0) for j, op in enumerate(ops)]
    got = {r.rule_id: r.hits for r in threshold_hit_counts(df, rules).collect()}
    for r in rules:
        op = "=" if r.op == "==" else r.op
        expect = df.where(f"{r.field} {op} {r.threshold!r}").count()
        assert got[r.rule_id] == expect, (r, got[r.rule_id], expect)
    # the same rules as (row, rule) pairs
    pairs = rules_as_data_hits(df, rules, ["k"]).groupBy("rule_id").count().collect()
    assert {r.rule_id: r["count"] for r in pairs} == {k: n for k, n in got.items() if n}


@pytest.mark.parametrize("n", [1, 5, 200])
def test_any_number_of_rules_is_one_scan(spark, n):
    from ruleforge.operators.rules_as_data import threshold_hit_counts
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    rules = [rule(f"p{i}", [cond("l_extendedprice", ">=" if i % 2 else "<", str(450 * i))]) for i in range(n)]
    rs = RuleSet.from_rules(spark, rules)
    batch, thr = compile_rules(rs, df, as_of=AS_OF), threshold_rules(rs, df, as_of=AS_OF)
    expect = df.agg(*[F.count_if(p.column).alias(rid)
                      for rid, p in batch.compiled]).first().asDict()
    keys = ["l_orderkey", "l_linenumber"]
    for counts in (rule_hit_counts(df, batch), threshold_hit_counts(df, thr)):
        plan = counts._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") == 1
        assert {r.rule_id: r.hits for r in counts.collect()} == expect
    for hits in (rule_hits(df, batch, keys), rules_as_data_hits(df, thr, keys)):
        plan = hits._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") == 1 and "Join" not in plan and "Exchange" not in plan
        got = {r.rule_id: r["count"] for r in hits.groupBy("rule_id").count().collect()}
        assert got == {k: v for k, v in expect.items() if v}


def test_threshold_rules_refuse_inexact_or_non_finite(spark):
    df = spark.createDataFrame([(1, 2, 3.0)], "big bigint, small int, x double")
    rs = RuleSet.from_rules(spark, [rule("nan", [cond("x", ">=", "NaN")]),
                                    rule("inf", [cond("x", "<", "Infinity")]),
                                    rule("big", [cond("big", ">=", "9007199254740993")]),
                                    rule("ok", [cond("small", ">=", "2")])])
    thr = threshold_rules(rs, df, ["nan", "inf", "big", "ok"], as_of=AS_OF, strict=False)
    assert [t.rule_id for t in thr.rules] == ["ok"] and set(thr.rejected) == {"nan", "inf", "big"}


def test_threshold_paths_agree_with_compiled_rules(spark):
    from ruleforge.operators.rules_as_data import threshold_hit_counts
    df = spark.createDataFrame([(i, i % 7, i / 10.0) for i in range(40)], "id int, value int, amount float")
    ids = []
    rules = []
    for j, (field, op, v) in enumerate([("value", ">=", "2.5"), ("value", ">", "2.0000000000000001"),
                                        ("value", "<", "3.5"), ("value", "<=", "2.9"),
                                        ("amount", ">=", "0.1"), ("amount", "=", "0.3"),
                                        ("amount", "!=", "0.3"), ("id", ">=", "7")]):
        rules.append(rule(f"t{j}", [cond(field, op, v)]))
        ids.append(f"t{j}")
    rs = RuleSet.from_rules(spark, rules)
    thr = threshold_rules(rs, df, ids, as_of=AS_OF)
    batch = compile_rules(rs, df, ids, as_of=AS_OF)
    compiled = {r.rule_id: r.hits for r in rule_hit_counts(df, batch).collect()}
    assert {r.rule_id: r.hits for r in threshold_hit_counts(df, thr).collect()} == compiled
    # keys that are also rule fields, or are called "value", do not collide
    hits = rules_as_data_hits(df, thr, ["id", "value", "amount"])
    got = {}
    for r in hits.collect():
        got[r.rule_id] = got.get(r.rule_id, 0) + 1
    assert {k: got.get(k, 0) for k in compiled} == compiled


def test_hit_lists_match_flags(rs, atm):
    from ruleforge.operators.multi_rule import rule_hit_lists
    batch = compile_rules(rs, atm, ["big_total", "perth", "none", "chain"], as_of=AS_OF)
    lists = {(r.session_id, r.id): r.hit_rules for r in rule_hit_lists(atm, batch).collect()}
    flags = rule_flags(atm, batch).collect()
    for r in flags:
        expect = [rid for rid in batch.rule_ids if r["hit_" + rid]]
        assert lists[(r.session_id, r.id)] == expect


def test_threshold_beyond_float_range_is_left_to_compiled_path(spark):
    df = spark.createDataFrame([(1.0,)], "f float")
    rs = RuleSet.from_rules(spark, [rule("huge", [cond("f", "<", "1e39")])])
    thr = threshold_rules(rs, df, ["huge"], as_of=AS_OF, strict=False)
    assert thr.rules == [] and "huge" in thr.rejected


def test_spread_input_is_opt_in(spark, atm):
    from ruleforge.operators.multi_rule import spread_input
    batch = compile_rules(RuleSet.from_rules(spark, [rule("p", [cond("city", "=", "perth")])]), atm, as_of=AS_OF)
    plain = rule_hits(atm, batch, KEYS)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plain
    spread = spread_input(atm, 4)                            # one small file: spread over the cores
    assert "RoundRobinPartitioning" in spread._jdf.queryExecution().executedPlan().toString()
    assert sorted(tuple(r) for r in rule_hits(atm, batch, KEYS, spread=True).collect()) == \
        sorted(tuple(r) for r in rule_hits(atm, batch, KEYS).collect())


def test_threshold_fields_resolve_like_spark(spark):
    from ruleforge.operators.rules_as_data import threshold_hit_counts
    df = spark.createDataFrame([(1, 5.0, 2), (2, 50.0, 9)], "id int, `amt.usd` double, Qty int")
    rs = RuleSet.from_rules(spark, [rule("dot", [cond("`amt.usd`", ">=", "10")]),
                                    rule("case", [cond("qty", ">=", "3")])])
    # the compiled path reads `amt.usd` as a quoted name; the threshold path matches it and qty/Qty
    rs2 = RuleSet.from_rules(spark, [rule("dot", [cond("amt.usd", ">=", "10")]), rule("case", [cond("qty", ">=", "3")])])
    thr = threshold_rules(rs2, df, ["dot", "case"], as_of=AS_OF)
    assert [t.field for t in thr.rules] == ["amt.usd", "Qty"]
    assert {r.rule_id: r.hits for r in threshold_hit_counts(df, thr).collect()} == {"dot": 1, "case": 1}
    assert sorted(tuple(r) for r in rules_as_data_hits(df, thr, ["id"]).collect()) == [(2, "case"), (2, "dot")]
    batch = compile_rules(rs, df, ["dot", "case"], as_of=AS_OF)
    assert {r.rule_id: r.hits for r in rule_hit_counts(df, batch).collect()} == {"dot": 1, "case": 1}


def test_interval_counts_with_dotted_column_and_many_rules(spark):
    from ruleforge.operators.rules_as_data import threshold_hit_counts
    df = spark.createDataFrame([(i, float(i)) for i in range(50)], "id int, `amt.usd` double")
    rules = [rule(f"r{i}", [cond("amt.usd", ">=", str(i))]) for i in range(40)]
    thr = threshold_rules(RuleSet.from_rules(spark, rules), df, as_of=AS_OF)
    got = {r.rule_id: r.hits for r in threshold_hit_counts(df, thr).collect()}
    assert got == {f"r{i}": 50 - i for i in range(40)}


def test_counts_accept_nondeterministic_rules(spark, atm):
    rs = RuleSet.from_rules(spark, [rule("always", [cond("rand(3)", "<", "2")]),
                                    rule("big", [cond("cash_amount", ">=", "20000")])])
    batch = compile_rules(rs, atm, ["always", "big"], as_of=AS_OF)
    assert {r.rule_id: r.hits for r in rule_hit_counts(atm, batch).collect()} == {"always": 10, "big": 2}
