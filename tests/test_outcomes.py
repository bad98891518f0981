"""The outcome matrix of a rule call and the legacy document."""

import pytest
from conftest import AS_OF, cond, keys, rule
from pyspark.sql import functions as F

from ruleforge import RuleSet, run_rule
from ruleforge.plans.resolution import MSG_UNMATCHED


def _call(spark, rules, df, rule_id, process_key="query_builder", **kw):
    rs = RuleSet.from_rules(spark, rules)
    kw.setdefault("as_of", AS_OF)
    return run_rule(rs, df, rule_id=rule_id, process=kw.pop("process", "identification"),
                    process_key=process_key, **kw)


def test_unmatched_parameters(spark, atm):
    res = _call(spark, [rule("a", [cond("cash_amount", ">=", "1")])], atm, "zzz")
    assert res.as_tuple() == (False, False, MSG_UNMATCHED, "", None)


def test_disabled_rule(spark, atm):
    res = _call(spark, [rule("a", [cond("cash_amount", ">=", "1")], is_valid="false")], atm, "a")
    assert res.as_tuple()[:3] == (True, False, "Rule a is not valid and is skipped")


def test_unreadable_window_is_reported(spark, atm):
    res = _call(spark, [rule("a", [cond("cash_amount", ">=", "1")], valid_from="2021-01-01")], atm, "a")
    assert res.rule_validity is False and "validity window" in res.message


def test_match_without_conditions_tries_next(spark, atm):
    rules = [rule("a", []), rule("a", [cond("cash_amount", ">=", "20000")])]
    res = _call(spark, rules, atm, "a")
    assert res.rule_validity and keys(res.df) == [(9, 18), (9, 19)]
    only_empty = _call(spark, [rule("a", [])], atm, "a")
    assert only_empty.valid_params is True and only_empty.rule_validity is False


def test_duplicate_ids_first_usable_wins(spark, atm):
    rules = [rule("a", [cond("cash_amount", ">=", "20000")]), rule("a", [cond("cash_amount", "<", "0")])]
    assert keys(_call(spark, rules, atm, "a").df) == [(9, 18), (9, 19)]


def test_invalid_process_key(spark, atm):
    res = _call(spark, [rule("a", [cond("cash_amount", ">=", "1")], process_key="mystery")], atm, "a",
                process_key="mystery", is_lookup="false")
    assert res.as_tuple()[:3] == (True, False, "Invalid Process key.")


def test_lookup_key_needs_is_lookup_true(spark, atm):
    rules = [rule("a", [{"lookup_value": " where id > 1"}], process_key="query_lookup", is_lookup="false")]
    res = _call(spark, rules, atm, "a", process_key="query_lookup", is_lookup="false")
    assert res.rule_validity is False and "is_lookup true" in res.message


def test_builder_key_needs_is_lookup_false(spark, atm):
    rules = [rule("a", [cond("cash_amount", ">=", "1")], is_lookup="true")]
    res = _call(spark, rules, atm, "a", is_lookup="true")
    assert res.rule_validity is False and "is_lookup false" in res.message


def test_value_lookup_missing_key_and_bad_list(spark, legacy_rules, current_rules):
    miss = run_rule(current_rules, None, rule_id="rule_2", process="identification",
                    process_key="value_lookup", value_key="nope", as_of=AS_OF)
    assert miss.as_tuple() == (False, True, "Value key nope requested not found in the json config "
                               "file, please setup the value.", "", None)
    bad = run_rule(legacy_rules, None, rule_id="switch_list", process="identification",
                   process_key="value_lookup", as_of=AS_OF)
    assert bad.as_tuple()[:3] == (False, True, "Unable to return the list of lookup values, please "
                                  "validate the json file.")


def test_value_lookup_returns_value_even_with_table(spark, current_rules, atm):
    res = run_rule(current_rules, atm, rule_id="rule_2", process="identification",
                   process_key="value_lookup", value_key="flag", as_of=AS_OF, apply=True)
    assert res.value == "pass" and res.df is None


def test_conditional_without_goto(spark, atm):
    rules = [rule("c", [{"lookup_value": '{"x": "1"}'}], process_key="conditional")]
    res = _call(spark, rules, atm, "c", process_key="conditional")
    assert res.as_tuple()[:4] == (False, True, "Conditional process without proper condition setup.",
                                  '{"x": "1"}')


def test_goto_target_rejected_missing_and_cycle(spark, atm):
    base = rule("a", [cond("cash_amount", ">=", "1")], ("goto", "b"))
    expired = _call(spark, [base, rule("b", [cond("city", "=", "perth")], valid_till="01/01/2022")], atm, "a")
    assert expired.as_tuple()[:4] == (True, False, "Rule 2021-01-01 and 2022-01-01 are out of range and is skipped", "")
    missing = _call(spark, [base], atm, "a")
    assert missing.valid_params is True and missing.rule_validity is False and "b" in missing.message
    cycle = _call(spark, [base, rule("b", [cond("city", "=", "perth")], ("goto", "a"))], atm, "a")
    assert cycle.rule_validity is False and cycle.message == "goto cycle: a -> b -> a"


def test_goto_target_must_be_builder(spark, atm):
    rules = [rule("a", [cond("cash_amount", ">=", "1")], ("goto", "v")),
             rule("v", [{"lookup_value": '{"k": "1"}'}], process_key="value_lookup")]
    res = _call(spark, rules, atm, "a")
    assert res.rule_validity is False and "query_builder" in res.message


def test_conditional_target_missing_is_rejected(spark, atm):
    rules = [rule("c", [{"lookup_value": '{"x": "1"}'}], ("goto", "nowhere"), process_key="conditional")]
    res = _call(spark, rules, atm, "c", process_key="conditional")
    assert res.rule_validity is False and res.df is None


def test_legacy_key_alias_chain_and_group_by(legacy_rules, atm):
    chain = run_rule(legacy_rules, atm, rule_id="chain_a", process="identification",
                     process_key="query_builder", table_name="atm", as_of=AS_OF)
    assert chain.query == (" select * from atm  where cash_amount >= 1000  AND cash_transaction = 'true'"
                           " and city = 'perth' and txn_source_code LIKE 'DEP%'")
    assert keys(chain.df) == [(5, 11), (8, 16)]
    big = run_rule(legacy_rules, atm, rule_id="big_cash", process="identification",
                   process_key="query_builder", as_of=AS_OF)
    assert keys(big.df) == [(6, 12), (7, 14), (8, 16), (9, 18), (9, 19)]
    grouped = run_rule(legacy_rules, atm, rule_id="per_session", process="filtration",
                       process_key="groupby_lookup", as_of=AS_OF,
                       aggregates={"n": "count(*)", "total": "sum(transaction_total_amount)"})
    got = sorted((r.session_id, r.n, r.total) for r in grouped.df.collect())
    assert got == [(5, 2, 16000), (6, 2, 22500), (7, 2, 27000), (8, 2, 12200), (9, 2, 51100)]


def test_apply_switch_and_fragment_only(current_rules, atm):
    res = run_rule(current_rules, atm, rule_id="rule_3", process="identification",
                   process_key="query_builder", as_of=AS_OF, apply=False)
    assert res.df is None and res.query == " where transaction_total_amount >= 10000"
    assert res.predicate is not None
    assert keys(atm.where(res.predicate)) == [(5, 12), (6, 12), (6, 13), (7, 14), (7, 15), (8, 16), (9, 18), (9, 19)]
    look = run_rule(current_rules, None, rule_id="rule_1", process="filtration",
                    process_key="query_lookup", as_of=AS_OF)
    assert look.query.startswith("where transaction_status_code") and look.df is None


def test_flag_mode_keeps_rows(current_rules, atm):
    res = run_rule(current_rules, atm, rule_id="rule_4", process="identification",
                   process_key="query_builder", as_of=AS_OF, mode="flag")
    rows = {(r.session_id, r.id): r.is_ttr for r in res.df.collect()}
    assert len(rows) == 10
    assert sorted(k for k, v in rows.items() if v == "true") == [(6, 12), (7, 14), (8, 16), (9, 18), (9, 19)]
    assert all(v is None for k, v in rows.items() if k not in {(6, 12), (7, 14), (8, 16), (9, 18), (9, 19)})


def test_transformation(spark, atm):
    rules = [rule("t", [{"field_name": "transaction_total_amount - cheque_amount"}],
                  ("transaction_total_amount", ""), process_key="transformation")]
    res = _call(spark, rules, atm, "t", process_key="transformation")
    got = {(r.session_id, r.id): r.transaction_total_amount for r in res.df.collect()}
    assert got[(6, 12)] == 12000 and got[(9, 18)] == 16000


def test_order_by_sorts_and_renders(current_rules, atm):
    res = run_rule(current_rules, atm, rule_id="rule_3", process="identification",
                   process_key="query_builder", as_of=AS_OF, table_name="atm",
                   order_by=["transaction_total_amount"])
    totals = [r.transaction_total_amount for r in res.df.collect()]
    assert totals == sorted(totals) and res.query.endswith(" order by transaction_total_amount")


def test_query_lookup_braces_stay_literal(spark, atm):
    rules = [rule("q", [{"lookup_value": " where city <> '{not a placeholder}'"}], process="filtration",
                  process_key="query_lookup")]
    res = _call(spark, rules, atm, "q", process_key="query_lookup", process="filtration")
    assert res.df.count() == 10


def test_bad_operand_is_reported_not_raised(spark, atm):
    res = _call(spark, [rule("a", [cond("no_such_column", ">=", "1")])], atm, "a")
    assert res.rule_validity is False and "no_such_column" in res.message
    res2 = _call(spark, [rule("a", [cond("cash_amount", "=>", "1")])], atm, "a")
    assert res2.rule_validity is False and "operator" in res2.message


def test_null_join_means_empty(spark, atm):
    rules = [rule("a", [{"field_name": "cash_amount", "operator": ">=", "field_value": "20000", "join": None}])]
    res = _call(spark, rules, atm, "a")
    assert res.query == " where cash_amount >= 20000" and keys(res.df) == [(9, 18), (9, 19)]


def test_bad_date_in_another_rule_does_not_abort(spark, atm):
    rules = [rule("broken", [cond("cash_amount", ">=", "1")], valid_from="31/02/2021x"),
             rule("good", [cond("cash_amount", ">=", "20000")])]
    res = _call(spark, rules, atm, "good")
    assert res.rule_validity and keys(res.df) == [(9, 18), (9, 19)]


def test_conditional_target_empty_join_means_and(spark, atm):
    rules = [rule("c", [{"lookup_value": '{"city": "perth"}'}], ("goto", "t"), process_key="conditional"),
             rule("t", [cond("cash_amount", ">=", "1000"), cond("cash_transaction", "=", "true")])]
    res = _call(spark, rules, atm, "c", process_key="conditional")
    assert res.query == " where cash_amount >= 1000 and cash_transaction = 'true'"
    assert keys(res.df) == [(5, 11), (6, 12), (6, 13), (7, 14), (7, 15), (8, 16), (9, 18), (9, 19)]
    called = _call(spark, rules, atm, "t")
    assert called.rule_validity is False and "no join" in called.message


def test_flag_mode_keeps_earlier_flags(spark, atm):
    from ruleforge.operators.stages import Stage, run_stages
    rules = [rule("big", [cond("cash_amount", ">=", "20000")], ("is_ttr", "true")),
             rule("perth", [cond("city", "=", "perth")], ("is_ttr", "true"))]
    run = run_stages(RuleSet.from_rules(spark, rules), atm, [
        Stage("big", "identification", "query_builder", options={"mode": "flag"}),
        Stage("perth", "identification", "query_builder", options={"mode": "flag"})], as_of=AS_OF)
    flagged = sorted((r.session_id, r.id) for r in run.df.where("is_ttr = 'true'").collect())
    assert flagged == [(5, 11), (5, 12), (8, 16), (8, 17), (9, 18), (9, 19)]


def test_group_by_lookup_with_where_having_and_order(spark, atm):
    rules = [rule("g", [{"lookup_value": " where city <> 'darwin' group by session_id having count(*) > 1 "
                                         "order by session_id"}], process="filtration",
                  process_key="groupby_lookup")]
    res = _call(spark, rules, atm, "g", process="filtration", process_key="groupby_lookup",
                aggregates={"n": "count(*)"})
    assert [(r.session_id, r.n) for r in res.df.collect()] == [(5, 2), (6, 2), (8, 2), (9, 2)]


def test_conditional_without_goto_needs_no_table(spark):
    rules = [rule("c", [{"lookup_value": '{"x": "1"}'}], process_key="conditional")]
    res = _call(spark, rules, None, "c", process_key="conditional")
    assert res.as_tuple()[:3] == (False, True, "Conditional process without proper condition setup.")


def test_grouping_keys_use_the_top_level_group_by(spark):
    from ruleforge.operators.evaluate import grouping_keys
    assert grouping_keys(spark, "where k in (select k from t group by k) group by a, b order by a") == "a, b"
    assert grouping_keys(spark, "where s = 'group by z' group by a having count(*) > 1") == "a"
    assert grouping_keys(spark, "where x > 1") is None


def test_flag_stage_texts_rerun_to_the_same_rows(spark, atm):
    from ruleforge.operators.stages import Stage, run_stages
    rules = [rule("big", [cond("cash_amount", ">=", "20000")], ("IS_TTR", "true")),
             rule("perth", [cond("city", "=", "perth")], ("is_ttr", "true"))]
    run = run_stages(RuleSet.from_rules(spark, rules), atm, [
        Stage("big", "identification", "query_builder", options={"mode": "flag"}),
        Stage("perth", "identification", "query_builder", options={"mode": "flag"})],
        as_of=AS_OF, table_name="atm_transactions")
    assert len(run.df.columns) == len(atm.columns) + 1
    flagged = sorted((r.session_id, r.id) for r in run.df.where("is_ttr = 'true'").collect())
    assert flagged == [(5, 11), (5, 12), (8, 16), (8, 17), (9, 18), (9, 19)]
    rerun = spark.sql(run.results[1].query)
    assert sorted(tuple(r) for r in rerun.collect()) == sorted(tuple(r) for r in run.df.collect())


def test_transformation_matches_target_case_insensitively(spark, atm):
    rules = [rule("t", [{"field_name": "cash_amount * 2"}], ("CASH_AMOUNT", ""), process_key="transformation")]
    res = _call(spark, rules, atm, "t", process_key="transformation", table_name="atm_transactions")
    assert len(res.df.columns) == len(atm.columns)
    assert sorted(tuple(r) for r in spark.sql(res.query).collect()) == sorted(tuple(r) for r in res.df.collect())


def test_aggregate_operand_is_a_rule_error(spark, atm):
    from ruleforge.operators.multi_rule import compile_rules, rule_hits
    rules = [rule("agg", [cond("sum(cash_amount)", ">=", "1")]), rule("ok", [cond("cash_amount", ">=", "20000")])]
    res = _call(spark, rules, atm, "agg")
    assert res.rule_validity is False and res.df is None
    batch = compile_rules(RuleSet.from_rules(spark, rules), atm, ["agg", "ok"], as_of=AS_OF, strict=False)
    assert batch.rule_ids == ["ok"] and "agg" in batch.rejected
    assert sorted((r.session_id, r.id) for r in rule_hits(atm, batch, ["session_id", "id"]).collect()) == \
        [(9, 18), (9, 19)]


def test_flag_into_existing_typed_column(spark, atm):
    df = atm.withColumn("is_ttr", F.lit(0))
    rules = [rule("big", [cond("cash_amount", ">=", "20000")], ("is_ttr", "1")),
             rule("bad", [cond("cash_amount", ">=", "20000")], ("is_ttr", "yes"))]
    res = _call(spark, rules, df, "big", mode="flag")
    assert dict(res.df.dtypes)["is_ttr"] == "int"
    assert sorted((r.session_id, r.id) for r in res.df.where("is_ttr = 1").collect()) == [(9, 18), (9, 19)]
    bad = _call(spark, rules, df, "bad", mode="flag")
    assert bad.rule_validity is False and "does not fit" in bad.message


def test_grouping_key_edge_cases(spark):
    from ruleforge.errors import RuleConfigError
    from ruleforge.operators.evaluate import grouping_keys
    assert grouping_keys(spark, "where s = 'it\\'s' group by a") == "a"
    assert grouping_keys(spark, "group by a, b with rollup") == "a, b"
    with pytest.raises(RuleConfigError):
        grouping_keys(spark, "group by grouping sets ((a), (b))")


def test_all_rules_mode_lists_rejections(spark, atm):
    from ruleforge.operators.multi_rule import compile_rules
    rules = [rule("X", [{"lookup_value": '{"a": "1"}'}], process_key="value_lookup"),
             rule("X", [cond("cash_amount", ">", "1")]),
             rule("off", [cond("cash_amount", ">", "1")], is_valid="false"),
             rule("ok", [cond("cash_amount", ">", "1")])]
    batch = compile_rules(RuleSet.from_rules(spark, rules), atm, as_of=AS_OF)
    assert batch.rule_ids == ["ok"] and set(batch.rejected) == {"off"}


def test_unicode_whitespace_is_stripped(spark, atm):
    rules = [rule("X\u00a0", [cond("cash_amount", ">=", "20000")])]
    res = _call(spark, rules, atm, "X")
    assert res.rule_validity and keys(res.df) == [(9, 18), (9, 19)]


def test_flag_values_must_fit_existing_numeric_column(spark, atm):
    df = atm.withColumn("score", F.lit(0)).withColumn("amt", F.lit(0).cast("decimal(5,2)"))
    for target, value in (("score", "1.5"), ("score", "3000000000"), ("amt", "123456"), ("amt", "1.234")):
        rules = [rule("r", [cond("cash_amount", ">=", "20000")], (target, value))]
        res = _call(spark, rules, df, "r", mode="flag")
        assert res.rule_validity is False, (target, value)
    ok = _call(spark, [rule("r", [cond("cash_amount", ">=", "20000")], ("amt", "12.5"))], df, "r", mode="flag")
    assert ok.rule_validity and ok.df.where("amt = 12.5").count() == 2


def test_flag_value_notation_and_range(spark, atm):
    df = (atm.withColumn("score", F.lit(0)).withColumn("big", F.lit(0).cast("decimal(38,2)"))
          .withColumn("f", F.lit(0.0).cast("float")))
    for target, value, expect in (("score", "100.0", 100), ("score", "1e2", 100),
                                  ("big", "1234567890123456789012345678.12", None)):
        res = _call(spark, [rule("r", [cond("cash_amount", ">=", "20000")], (target, value))], df, "r", mode="flag")
        assert res.rule_validity, (target, value, res.message)
        got = [r[target] for r in res.df.where("cash_amount >= 20000").collect()]
        if expect is not None:
            assert got == [expect, expect]
    res = _call(spark, [rule("r", [cond("cash_amount", ">=", "20000")], ("f", "1e39"))], df, "r", mode="flag")
    assert res.rule_validity is False


def test_missing_table_is_rejected_and_value_lookups_need_none(spark, current_rules):
    res = run_rule(current_rules, "no_such_view", rule_id="rule_3", process="identification",
                   process_key="query_builder", as_of=AS_OF)
    assert res.rule_validity is False and "no_such_view" in res.message
    val = run_rule(current_rules, "no_such_view", rule_id="rule_2", process="identification",
                   process_key="value_lookup", value_key="flag", as_of=AS_OF)
    assert val.value == "pass"


def test_group_by_lookup_braces_and_alias_quoting(spark, atm):
    rules = [rule("g", [{"lookup_value": " group by regexp_extract(city, 'p{1}', 0)"}], process="filtration",
                  process_key="groupby_lookup")]
    res = _call(spark, rules, atm, "g", process="filtration", process_key="groupby_lookup",
                aggregates={"n`odd": "count_if(city rlike 'e{1}')"})
    assert res.rule_validity, res.message
    assert sum(r[1] for r in res.df.collect()) == atm.where("city rlike 'e{1}'").count()


def test_order_by_directions_and_lookup_text(current_rules, atm):
    res = run_rule(current_rules, atm, rule_id="rule_3", process="identification",
                   process_key="query_builder", as_of=AS_OF, order_by=["transaction_total_amount desc"])
    totals = [r.transaction_total_amount for r in res.df.collect()]
    assert totals == sorted(totals, reverse=True)
    look = run_rule(current_rules, atm, rule_id="rule_1", process="filtration", process_key="query_lookup",
                    as_of=AS_OF, table_name="atm_transactions", order_by=["id"])
    assert look.query.endswith(" order by id") and [r.id for r in look.df.collect()] == sorted(
        r.id for r in look.df.collect())


def test_group_by_ordinals_and_comments(spark, atm):
    from ruleforge.operators.evaluate import grouping_keys
    assert grouping_keys(spark, "where x > 1 -- (old\n group by k") == "k"
    assert grouping_keys(spark, "where `a\\` = 1 /* ( */ group by k") == "k"
    rules = [rule("g", [{"lookup_value": " group by 1"}], process="filtration", process_key="groupby_lookup")]
    res = _call(spark, rules, atm, "g", process="filtration", process_key="groupby_lookup")
    assert sorted((r.session_id, r.row_count) for r in res.df.collect()) == [(5, 2), (6, 2), (7, 2), (8, 2), (9, 2)]


def test_numbers_must_be_ascii(spark, atm):
    for bad in ("1_000", "١٢"):
        res = _call(spark, [rule("r", [cond("cash_amount", ">=", bad)])], atm, "r")
        assert res.rule_validity is False, bad


def test_ordered_lookup_text_wraps_and_ordinal_bounds(spark, atm):
    from ruleforge.errors import RuleConfigError
    from ruleforge.operators.evaluate import grouping_keys
    rules = [rule("q", [{"lookup_value": " where city <> 'darwin' limit 100"}], process="filtration",
                  process_key="query_lookup"),
             rule("g", [{"lookup_value": " group by 0"}], process="filtration", process_key="groupby_lookup")]
    res = _call(spark, rules, atm, "q", process="filtration", process_key="query_lookup",
                table_name="atm_transactions", order_by=["id desc"])
    assert res.query.startswith(" select * from (select * from atm_transactions where")
    assert spark.sql(res.query).count() == res.df.count() == 8
    bad = _call(spark, rules, atm, "g", process="filtration", process_key="groupby_lookup")
    assert bad.rule_validity is False and "out of range" in bad.message
    assert grouping_keys(spark, "where a = 1 /*/ group by old */ group by k") == "k"
    assert grouping_keys(spark, "where a /* x /* y */ group by z */ group by k") == "k"


def test_value_and_conditional_payloads(spark):
    rules = [rule("v", [{"lookup_value": '{"a": null}'}], process_key="value_lookup"),
             rule("c", [{"lookup_value": '  {"x": "y"}  '}], process_key="conditional")]
    rs = RuleSet.from_rules(spark, rules)
    v = run_rule(rs, None, rule_id="v", process="identification", process_key="value_lookup", value_key="a",
                 as_of=AS_OF)
    assert v.as_tuple()[:4] == (True, True, "Successfully returning the lookup value <None> for the value key <a>.",
                                None)
    c = run_rule(rs, "no_such_table", rule_id="c", process="identification", process_key="conditional",
                 as_of=AS_OF)
    assert c.as_tuple()[:4] == (False, True, "Conditional process without proper condition setup.", '{"x": "y"}')


def test_text_only_calls_honour_mode_and_order(current_rules):
    flag = run_rule(current_rules, None, rule_id="rule_4", process="identification", process_key="query_builder",
                    as_of=AS_OF, mode="flag")
    assert flag.query == " case when transaction_total_amount - cheque_amount >= 10000 then 'true' end"
    ordered = run_rule(current_rules, None, rule_id="rule_3", process="identification",
                       process_key="query_builder", as_of=AS_OF, order_by=["id"])
    assert ordered.query == " where transaction_total_amount >= 10000 order by id"
    with pytest.raises(ValueError):
        run_rule(current_rules, None, rule_id="rule_3", process="identification", process_key="query_builder",
                 as_of=AS_OF, mode="bogus")


def test_texts_agree_with_and_without_table(spark, current_rules, atm):
    kw = dict(rule_id="rule_4", process="identification", process_key="query_builder", as_of=AS_OF,
              table_name="atm_filtered", order_by=["id"])
    no_table = run_rule(current_rules, None, **kw)
    not_applied = run_rule(current_rules, atm, apply=False, **kw)
    applied = run_rule(current_rules, atm, **kw)
    assert no_table.query == not_applied.query == applied.query == \
        " select * from atm_filtered  where transaction_total_amount - cheque_amount >= 10000 order by id"
    flag_text = run_rule(current_rules, atm, apply=False, mode="flag", **kw).query
    assert flag_text.startswith(" select `session_id`") and "case when" in flag_text and flag_text.endswith("order by id")
    rules = [rule("g", [{"lookup_value": " group by session_id"}], process="filtration", process_key="groupby_lookup")]
    grouped = _call(spark, rules, atm, "g", process="filtration", process_key="groupby_lookup",
                    table_name="atm_transactions", order_by=["session_id desc"])
    assert [r.session_id for r in grouped.df.collect()] == [9, 8, 7, 6, 5]
    assert sorted(tuple(r) for r in spark.sql(grouped.query).collect()) == sorted(tuple(r) for r in grouped.df.collect())


def test_blank_table_name_means_text_only(current_rules):
    from ruleforge import call_rule
    out = call_rule(current_rules, "identification", "query_builder", "rule_3", "false", "", "   ", None, True,
                    as_of=AS_OF)
    assert out[3] == " where transaction_total_amount >= 10000" and out[4] is None


def test_transformation_steps_apply_in_order(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    rules = [rule("t", [{"field_name": "a + b"}, {"field_name": "a * 100"}], ("a", ""), process_key="transformation")]
    df.createOrReplaceTempView("steps_in")
    res = _call(spark, rules, df, "t", process_key="transformation", table_name="steps_in")
    assert [tuple(r) for r in res.df.collect()] == [(300, 2)]
    assert [tuple(r) for r in spark.sql(res.query).collect()] == [(300, 2)]
    assert "steps" in _call(spark, rules, df, "t", process_key="transformation").message


def test_validity_on_each_rows_own_date(spark):
    import datetime as dt
    days = [dt.datetime(2021, 1, 1), dt.datetime(2021, 12, 31, 23, 59), dt.datetime(2022, 1, 1), None]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "k int, at timestamp")
    df.createOrReplaceTempView("dated")
    window = dict(valid_from="02/01/2021", valid_till="31/12/2021")
    rules = [rule("w", [cond("k", ">=", "0")], ("hit", "yes"), **window),
             rule("q", [{"lookup_value": " where k >= 0"}], process="filtration", process_key="query_lookup", **window),
             rule("t", [{"field_name": "k + 10"}], ("k", ""), process_key="transformation", **window),
             rule("off", [cond("k", ">=", "0")], is_valid="false", **window)]
    rs = RuleSet.from_rules(spark, rules)

    def call(rid, key, process="identification", **kw):
        return run_rule(rs, df, rule_id=rid, process=process, process_key=key, as_of="at", table_name="dated", **kw)
    res = call("w", "query_builder")
    assert [r.k for r in res.df.collect()] == [1]
    assert [r.k for r in spark.sql(res.query).collect()] == [r.k for r in spark.sql(res.executed).collect()] == [1]
    assert [r.hit for r in call("w", "query_builder", mode="flag").df.orderBy("k").collect()] == [None, "yes", None, None]
    look = call("q", "query_lookup", process="filtration")
    assert [r.k for r in look.df.collect()] == [r.k for r in spark.sql(look.query).collect()] == [1]
    assert sorted(r.k for r in call("t", "transformation").df.collect()) == [0, 2, 3, 11]
    assert not call("off", "query_builder").ok


_TEXTS = ["36", "036", " 36 ", "36.0", "36.0000000000000000000", "36.0000000000000000001", "35.9999999999999999999999",
          "-36", "-0", "0.0", ".5", "-.5", "36x", "", None, "1" * 39, "0" * 50 + "36", "+36", "3.6e1", "37", "99999999999999999999999999999999999999"]


@pytest.mark.parametrize("value", ["36", "036", "0", "37", "99999999999999999999999999999999999999"])
def test_text_numbers_compare_without_rounding(spark, value):
    import operator
    from decimal import Decimal, InvalidOperation, localcontext
    ops = {"=": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}
    df = spark.createDataFrame([(i, t) for i, t in enumerate(_TEXTS)], "i int, s string")
    for op, test in ops.items():
        res = _call(spark, [rule("r", [cond("s", op, value)])], df, "r")
        got = sorted(r.i for r in res.df.collect())
        want = []
        for i, t in enumerate(_TEXTS):
            with localcontext() as c:
                c.prec = 200
                try:
                    number = Decimal((t or "x").strip())
                except InvalidOperation:
                    continue
                if test(number, Decimal(value)):
                    want.append(i)
        assert got == want, (op, [_TEXTS[i] for i in set(got) ^ set(want)])


def test_executed_text_returns_the_rows_that_ran(spark):
    df = spark.createDataFrame([(1, "36", 1.5, True), (3, "bad", 2.5, False), (2, "036.0", float("nan"), None),
                                (None, "x'y\\z", None, True)], "n int, s string, x double, b boolean")
    df.createOrReplaceTempView("executed_in")
    cases = [("n", ">=", "2.5"), ("s", "=", "36"), ("s", ">", "35"), ("x", "<", "2"), ("x", ">=", "1e400"), ("b", "=", "yes"),
             ("s", "LIKE", "x'"), ("s", "LIKE", "x'y\\"), ("s", "NOT LIKE", "0"), ("n", "<=>", "1"), ("s", "=", "x'y\\z"),
             ("n * 2", "=", "2"), ("n", "<", "99999999999")]
    for field, op, value in cases:
        res = _call(spark, [rule("r", [cond(field, op, value)])], df, "r", table_name="executed_in")
        assert res.ok, (field, op, value, res.message)
        ran = sorted(map(str, spark.sql(res.executed).collect()))
        assert ran == sorted(map(str, res.df.collect())), (field, op, value)
