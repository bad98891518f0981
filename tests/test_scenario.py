"""End-to-end: filter transactions, then identify large ones (the staged demo)."""

from conftest import AS_OF, keys

from ruleforge import run_rule
from ruleforge.operators.stages import Stage, run_stages
import datetime as dt

FILTERED = [(5, 11), (5, 12), (6, 12), (6, 13), (8, 16), (8, 17), (9, 18)]
NET_LARGE = [(6, 12), (8, 16), (9, 18)]
TOTAL_LARGE = [(5, 12), (6, 12), (6, 13), (8, 16), (9, 18)]


def _filtered(current_rules, atm):
    res = run_rule(current_rules, "atm_transactions", rule_id="rule_1", process="filtration",
                   process_key="query_lookup", is_lookup="true", as_of=AS_OF)
    res.df.createOrReplaceTempView("atm_filtered")
    return res


def test_filtration_lookup_query(current_rules, atm):
    res = _filtered(current_rules, atm)
    assert res.as_tuple()[:3] == (True, True, "Successfully returning the lookup query")
    assert res.query.startswith(" select * from atm_transactions where transaction_status_code")
    assert keys(res.df) == FILTERED


def test_identification_builder_golden_text(current_rules, atm):
    _filtered(current_rules, atm)
    res = run_rule(current_rules, "atm_filtered", rule_id="rule_4", process="identification",
                   process_key="query_builder", is_lookup="false", as_of=AS_OF)
    assert res.query == " select * from atm_filtered  where transaction_total_amount - cheque_amount >= 10000"
    assert res.message == "Successfully returning the dynamically generated query"
    assert keys(res.df) == NET_LARGE
    res3 = run_rule(current_rules, "atm_filtered", rule_id="rule_3", process="identification",
                    process_key="query_builder", is_lookup="false", as_of=AS_OF)
    assert res3.query == " select * from atm_filtered  where transaction_total_amount >= 10000"
    assert keys(res3.df) == TOTAL_LARGE


def test_conditional_jumps_to_target(current_rules, atm):
    _filtered(current_rules, atm)
    res = run_rule(current_rules, "atm_filtered", rule_id="rule_5", process="identification",
                   process_key="conditional", is_lookup="true", as_of=AS_OF)
    assert res.valid_params is True and res.rule_validity
    assert res.query == " select * from atm_filtered  where transaction_total_amount - cheque_amount >= 10000"
    assert keys(res.df) == NET_LARGE
    gated = run_rule(current_rules, "atm_filtered", rule_id="rule_5", process="identification",
                     process_key="conditional", is_lookup="true", as_of=AS_OF, gate=True)
    assert keys(gated.df) == [(6, 12)]


def test_value_lookups(current_rules):
    one = run_rule(current_rules, None, rule_id="rule_2", process="identification",
                   process_key="value_lookup", is_lookup="true",
                   value_key="check_cheque_transaction", as_of=AS_OF)
    assert one.as_tuple() == (True, True, "Successfully returning the lookup value <yes> for the "
                              "value key <check_cheque_transaction>.", "yes", None)
    every = run_rule(current_rules, None, rule_id="rule_2", process="identification",
                     process_key="value_lookup", is_lookup="true", as_of=AS_OF)
    assert every.value == [("check_cheque_transaction", "yes"), ("flag", "pass")]
    assert every.message == ("Successfully returning the list of lookup values "
                             "<[('check_cheque_transaction', 'yes'), ('flag', 'pass')]>.")


def test_expired_rules_are_rejected(current_rules, atm):
    _filtered(current_rules, atm)
    for rid, key, lk in (("rule_4", "query_builder", "false"), ("rule_5", "conditional", "true")):
        res = run_rule(current_rules, "atm_filtered", rule_id=rid, process="identification",
                       process_key=key, is_lookup=lk, as_of=dt.date(2022, 9, 21))
        assert res.as_tuple() == (True, False,
                                  "Rule 2021-03-05 and 2022-09-20 are out of range and is skipped", "", None)


def test_staged_run_registers_views_and_fuses_filters(current_rules, atm, spark):
    run = run_stages(current_rules, atm, [
        Stage("rule_1", "filtration", "query_lookup", "true", view_name="stage_filtered"),
        Stage("rule_4", "identification", "query_builder", "false", view_name="stage_identified"),
    ], as_of=AS_OF, table_name="atm_transactions")
    assert run.ok
    assert keys(run.df) == NET_LARGE
    assert run.results[1].query.startswith(" select * from stage_filtered  where")
    assert keys(spark.table("stage_identified")) == NET_LARGE
    plan = run.df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 or plan.count("Scan csv") == 1


def test_staged_run_stops_at_rejection(current_rules, atm):
    run = run_stages(current_rules, atm, [
        Stage("rule_1", "filtration", "query_lookup", "true"),
        Stage("rule_4", "identification", "query_builder", "false"),
    ], as_of=dt.date(2023, 1, 1))
    assert run.df is None and not run.ok and len(run.results) == 2


def test_staged_run_checkpoints_between_stages(current_rules, atm):
    run = run_stages(current_rules, atm, [
        Stage("rule_1", "filtration", "query_lookup", "true"),
        Stage("rule_3", "identification", "query_builder", "false"),
    ], as_of=AS_OF, checkpoint_between=True)
    assert keys(run.df) == TOTAL_LARGE


def test_positional_call_shape(current_rules, atm):
    from ruleforge import call_rule
    valid, ok, msg, query, df = call_rule(current_rules, "filtration", "query_lookup", "rule_1", "true", "",
                                          "atm_transactions", [atm], True, as_of=AS_OF)
    assert (valid, ok, msg) == (True, True, "Successfully returning the lookup query") and df.count() == 7
    df.createOrReplaceTempView("atm_filtered")
    out = call_rule(current_rules, "identification", "value_lookup", "rule_2", "true",
                    "check_cheque_transaction", "", [atm], False, as_of=AS_OF)
    assert out == (True, True, "Successfully returning the lookup value <yes> for the value key "
                   "<check_cheque_transaction>.", "yes", None)
    _, _, _, text, res = call_rule(current_rules, "identification", "conditional", "rule_5", "true", "",
                                   "atm_filtered", [atm], True, as_of=AS_OF)
    assert text == " select * from atm_filtered  where transaction_total_amount - cheque_amount >= 10000"
    assert keys(res) == NET_LARGE
    _, _, _, fragment, none = call_rule(current_rules, "identification", "query_builder", "rule_4", "false", "",
                                        "", [atm], True, as_of=AS_OF)
    assert fragment == " where transaction_total_amount - cheque_amount >= 10000" and none is None
