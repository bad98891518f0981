"""Condition compilation: literal typing, LIKE, precedence, text rendering."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ruleforge.errors import RuleConfigError
from ruleforge.functions.predicates import compile_chain, render_value
from ruleforge.sources.ruleset import Condition, Rule


def _rule(rid, conds, then=("", "")):
    return Rule(pos=0, id=rid, name="", description="", is_valid="true", valid_from="", valid_till="",
                process="p", process_key="query_builder", is_lookup="false",
                conditions=tuple(Condition(i, f, o, v, j, None) for i, (f, o, v, j) in enumerate(conds)),
                then_field=then[0], then_value=then[1])


@pytest.fixture(scope="module")
def data(spark):
    rows = [(1, "AUD", "036", 10, 10.5, True, dt.date(2022, 1, 5), "it's"),
            (2, "INR", "36", 20, -3.0, False, dt.date(2022, 2, 1), "plain"),
            (3, None, "abc", None, 0.0, None, None, None),
            (4, "AUDX", "0036", 30, 99.99, True, dt.date(2021, 12, 31), "a_b%c")]
    return spark.createDataFrame(rows, "k int, cur string, code string, n int, amt double, "
                                       "flag boolean, d date, txt string")


def _ids(df, links, **kw):
    pred = compile_chain(df, links, **kw)
    return sorted(r.k for r in df.where(pred.column).collect()), pred.where_text


def test_numeric_literal_rendering():
    assert render_value("036", "=") == "36"
    assert render_value("-5", ">") == "'-5'"
    assert render_value("10.5", ">") == "'10.5'"
    assert render_value("it's", "=") == "'it''s'"
    assert render_value("DEP", "LIKE") == "'DEP%'"


def test_literal_typed_by_left_operand(data):
    assert _ids(data, [_rule("r", [("n", ">=", "20", "")])])[0] == [2, 4]
    assert _ids(data, [_rule("r", [("amt", ">", "10.4", "")])])[0] == [1, 4]
    assert _ids(data, [_rule("r", [("amt", ">=", "-3", "")])])[0] == [1, 2, 3, 4]
    # string column, all-digit value: numeric comparison, malformed text is null
    assert _ids(data, [_rule("r", [("code", "=", "36", "")])])[0] == [1, 2, 4]
    assert _ids(data, [_rule("r", [("cur", "=", "AUD", "")])])[0] == [1]
    assert _ids(data, [_rule("r", [("flag", "=", "true", "")])])[0] == [1, 4]
    assert _ids(data, [_rule("r", [("flag", "=", "false", "")])])[0] == [2]
    assert _ids(data, [_rule("r", [("d", ">=", "2022-01-01", "")])])[0] == [1, 2]
    assert _ids(data, [_rule("r", [("d", "<", "1/1/2022", "")])])[0] == [4]
    assert _ids(data, [_rule("r", [("txt", "=", "it's", "")])])[0] == [1]


def test_bad_literals_are_config_errors(data):
    for conds in ([("n", ">=", "ten", "")], [("flag", "=", "maybe", "")], [("d", "=", "someday", "")],
                  [("n", "=>", "1", "")], [("n", ">=", "1", "")] * 2, [("n", ">=", "1", "XOR"), ("n", "<", "5", "")]):
        with pytest.raises(RuleConfigError):
            compile_chain(data, [_rule("r", conds)])


def test_like_is_a_prefix_match(data):
    ids, text = _ids(data, [_rule("r", [("cur", "LIKE", "AUD", "")])])
    assert ids == [1, 4] and text == " where cur LIKE 'AUD%'"
    assert _ids(data, [_rule("r", [("cur", "NOT LIKE", "AUD", "")])])[0] == [2]  # null dropped
    assert _ids(data, [_rule("r", [("txt", "LIKE", "a_b", "")])])[0] == [4]      # wildcard kept
    assert _ids(data, [_rule("r", [("n", "LIKE", "2", "")])])[0] == [2]          # numeric operand
    assert _ids(data, [_rule("r", [("cur", "like", "AUD", "")])])[0] == [1]      # other spelling: exact pattern


def test_precedence_and_trailing_join(data):
    conds = [("cur", "=", "INR", "OR"), ("cur", "=", "AUD", "AND"), ("n", ">=", "20", "")]
    ids, text = _ids(data, [_rule("r", conds)])
    assert ids == [2] and text == " where cur = 'INR'  OR cur = 'AUD'  AND n >= 20"
    ids2, text2 = _ids(data, [_rule("r", [("n", ">=", "20", "AND")])])
    assert ids2 == [2, 4] and text2 == " where n >= 20"


def test_goto_links_and_grouping(data):
    a = _rule("a", [("cur", "=", "INR", "OR"), ("cur", "=", "AUD", "")], ("goto", "b"))
    b = _rule("b", [("n", ">=", "20", "")])
    ids, text = _ids(data, [a, b])
    assert ids == [2] and text == " where cur = 'INR'  OR cur = 'AUD' and n >= 20"  # a OR (b AND c)
    gids, gtext = _ids(data, [a, b], group_links=True)
    assert gids == [2] and gtext == " where ( cur = 'INR'  OR cur = 'AUD' ) and ( n >= 20 )"
    # inside a goto target an empty join means AND, an OR is honoured
    c = _rule("c", [("n", ">", "5", ""), ("amt", ">", "0", "")])
    assert _ids(data, [b, c])[0] == [4]
    d = _rule("d", [("n", "=", "20", "OR"), ("n", "=", "30", "")])
    a2 = _rule("a2", [("flag", "=", "true", "")], ("goto", "d"))
    assert _ids(data, [a2, d])[0] == [4]  # flag AND n = 20 OR n = 30
    # trailing AND before a goto is reused, a trailing OR is refused
    e = _rule("e", [("n", ">", "5", "AND")], ("goto", "b"))
    assert _ids(data, [e, b])[1] == " where n > 5  AND n >= 20"
    with pytest.raises(RuleConfigError):
        compile_chain(data, [_rule("f", [("n", ">", "5", "OR")], ("goto", "b")), b])


def test_gate_conditions_come_first(data):
    gate = [Condition(0, "cur", "=", "AUD", "AND", None)]
    ids, text = _ids(data, [_rule("b", [("n", ">=", "5", "")])], extra=gate)
    assert ids == [1] and text == " where cur = 'AUD'  AND ( n >= 5 )"
    # the gate guards every OR-group of the target
    ids, text = _ids(data, [_rule("b", [("n", "=", "10", "OR"), ("n", "=", "20", "")])], extra=gate)
    assert ids == [1] and text == " where cur = 'AUD'  AND ( n = 10  OR n = 20 )"


def test_float_string_and_huge_literals(spark):
    from decimal import Decimal
    df = spark.createDataFrame([(1, 0.1, "36.00000000004", Decimal("5")), (2, 0.5, "36", Decimal("6"))],
                               "k int, f float, s string, d decimal(10,2)")
    assert _ids(df, [_rule("r", [("f", "=", "0.1", "")])])[0] == [1]
    assert _ids(df, [_rule("r", [("f", ">", "0.1", "")])])[0] == [2]
    assert _ids(df, [_rule("r", [("s", "=", "36", "")])])[0] == [2]
    assert _ids(df, [_rule("r", [("s", ">", "36", "")])])[0] == [1]
    assert _ids(df, [_rule("r", [("d", "<", "1E+40", "")])])[0] == [1, 2]
    assert _ids(df, [_rule("r", [("k", ">", "99999999999999999999999999999999999999999", "")])])[0] == []


def test_filter_reaches_parquet_scan(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "cast(id as string) as s")
    path = str(tmp_path / "t")
    df.write.parquet(path)
    t = spark.read.parquet(path)
    pred = compile_chain(t, [_rule("r", [("id", ">=", "90", "AND"), ("s", "LIKE", "9", "")])])
    plan = t.where(pred.column)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id,90)" in plan and "StringStartsWith(s,9)" in plan


_OPS = st.sampled_from([">=", ">", "<=", "<", "=", "!=", "<>"])
_COND = st.one_of(
    st.tuples(st.just("n"), _OPS, st.integers(0, 40).map(str)),
    st.tuples(st.just("cur"), st.sampled_from(["=", "!="]), st.sampled_from(["AUD", "INR", "AUDX"])),
    st.tuples(st.just("cur"), st.sampled_from(["LIKE", "NOT LIKE"]), st.sampled_from(["AU", "IN", "X"])),
    st.tuples(st.just("amt"), _OPS, st.sampled_from(["0", "10", "-3", "99.99", "10.5"])),
)


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(_COND, st.sampled_from(["AND", "OR"])), min_size=1, max_size=5))
def test_column_and_text_select_the_same_rows(data, items):
    conds = [(f, o, v, j) for (f, o, v), j in items]
    pred = compile_chain(data, [_rule("r", conds)])
    by_column = sorted(r.k for r in data.where(pred.column).collect())
    by_text = sorted(r.k for r in data.where(F.expr(pred.where_text[len(" where"):])).collect())
    assert by_column == by_text


def test_rule_on_partition_column_prunes_partitions(spark, atm, tmp_path):
    from ruleforge import RuleSet, run_rule
    path = str(tmp_path / "by_city")
    atm.write.partitionBy("city").parquet(path)
    t = spark.read.parquet(path)
    rs = RuleSet.from_rules(spark, [{
        "id": "p", "name": "", "description": "", "is_valid": "true", "valid_from": "1/1/2020",
        "valid_till": "1/1/2999", "process": "x", "process_key": "query_builder", "is_lookup": "false",
        "when": [{"field_name": "city", "operator": "=", "field_value": "perth", "join": "AND"},
                 {"field_name": "cash_amount", "operator": ">=", "field_value": "1000", "join": ""}],
        "then": {"field_name": "", "field_value": ""}}])
    res = run_rule(rs, t, rule_id="p", process="x", process_key="query_builder", as_of=dt.date(2022, 3, 1))
    plan = res.df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(city" in plan and "(city#" in plan and "= perth)" in plan
    assert sorted((r.session_id, r.id) for r in res.df.collect()) == [(5, 11), (5, 12), (8, 16)]


def test_long_digit_strings_and_precise_literals(spark):
    df = spark.createDataFrame([(1, "1234567890123456789012345", 1), (2, "7", 2)], "k int, s string, n int")
    assert _ids(df, [_rule("r", [("s", ">", "5", "")])])[0] == [1, 2]
    assert _ids(df, [_rule("r", [("s", "=", "1234567890123456789012345", "")])])[0] == [1]
    with pytest.raises(RuleConfigError):
        compile_chain(df, [_rule("r", [("n", ">=", "1.0000000000000000000000000000000000000001", "")])])


def test_normalised_literals(spark):
    from decimal import Decimal
    df = spark.createDataFrame([(1, Decimal("2.5")), (2, Decimal("0"))], "k int, d decimal(10,2)")
    assert _ids(df, [_rule("r", [("d", "=", "2.5000000000000000000000000000000000000000", "")])])[0] == [1]
    with pytest.raises(RuleConfigError):  # finer than any decimal step: refused, not read as 0
        compile_chain(df, [_rule("r", [("d", ">", "1E-40", "")])])
    assert _ids(df, [_rule("r", [("k", "<", "1E+20", "")])])[0] == [1, 2]


def test_extreme_literals_are_exact_or_refused(spark):
    from decimal import Decimal
    df = spark.createDataFrame([(1, Decimal("0")), (2, Decimal("3"))], "k int, d decimal(10,2)")
    for bad in ("1E-400", "1." + "0" * 1005 + "1"):
        with pytest.raises(RuleConfigError):
            compile_chain(df, [_rule("r", [("d", ">=", bad, "")])])
    assert _ids(df, [_rule("r", [("d", "<", "1E+1000000", "")])])[0] == [1, 2]
    assert _ids(df, [_rule("r", [("d", "=", "3.000000000000000000000000000000000000000000", "")])])[0] == [2]


def test_like_prefix_with_trailing_backslash(spark):
    df = spark.createDataFrame([(1, "C:\\Users"), (2, "C:%"), (3, "D:\\x")], "k int, p string")
    assert _ids(df, [_rule("r", [("p", "LIKE", "C:\\", "")])])[0] == [1]
    assert _ids(df, [_rule("r", [("p", "NOT LIKE", "C:\\", "")])])[0] == [2, 3]
