"""Validation report, unmatched calls, audit trail, CSV and time spans."""

import datetime as dt

import pytest
from conftest import AS_OF, cond, rule

from ruleforge import RuleSet, run_rule
from ruleforge.operators.elapsed import time_span
from ruleforge.operators.validation import audit_frame, rule_validation, unmatched_requests
from ruleforge.sources.files import append_table, read_csv_table, transaction_timestamp, write_csv


def test_validation_report(spark):
    rs = RuleSet.from_rules(spark, [
        rule("ok", [cond("a", ">=", "1")]),
        rule("badop", [cond("a", "=>", "1", "AND"), cond("b", "=", "x")]),
        rule("nojoin", [cond("a", ">", "1"), cond("b", "<", "2")]),
        rule("dates", [cond("a", ">", "1")], valid_from="2021-01-01"),
        rule("key", [cond("a", ">", "1")], process_key="mystery", is_lookup="false"),
        rule("goto", [cond("a", ">", "1")], ("goto", "nowhere")),
        rule("empty", []),
        rule("dup", [cond("a", ">", "1")]), rule("dup", [cond("a", ">", "2")]),
        rule("val", [{"lookup_value": "[1, 2]"}], process_key="value_lookup"),
        rule("expired", [cond("a", ">", "1")], valid_till="01/01/2022"),
        rule("huge", [cond("a", ">", "9" * 39)]),
        {**rule("nokey", [cond("a", ">", "1")]), "process_key": None},
        rule("year2", [cond("a", ">", "1")], valid_till="31/12/24"),
        rule("noop", [{"field_name": "a", "field_value": "1", "join": ""}]),
    ])
    rep = {r.id + str(r.rule_pos): r for r in rule_validation(rs, AS_OF).collect()}
    assert rep["ok0"].ok and rep["ok0"].active
    assert any("operator =>" in i for i in rep["badop1"].issues)
    assert any("no join before condition 2" in i for i in rep["nojoin2"].issues)
    assert any("valid_from" in i for i in rep["dates3"].issues) and not rep["dates3"].active
    assert "Invalid Process key." in rep["key4"].issues
    assert [i for i in rep["goto5"].issues if "nowhere" in i] == \
        ["goto chain: Rule nowhere is not configured or has no conditions"]
    assert "rule has no conditions" in rep["empty6"].issues
    assert any("appears 2 times" in i for i in rep["dup7"].issues)
    assert "lookup_value is not a JSON object" in rep["val9"].issues
    assert rep["expired10"].ok and not rep["expired10"].active
    assert rep["huge11"].ok  # typed at compile time: fine on numeric operands
    assert "Invalid Process key." in rep["nokey12"].issues
    assert any("valid_till" in i for i in rep["year213"].issues)
    assert any("operator" in i for i in rep["noop14"].issues)


def test_unmatched_requests(spark, current_rules):
    reqs = spark.createDataFrame([("filtration", "query_lookup", "rule_1", "true"),
                                  ("identification", "query_builder", " rule_4 ", "false"),
                                  ("identification", "query_builder", "rule_3\t", None),
                                  ("identification", "query_builder", "rule_9", "false")],
                                 "process string, process_key string, rule_id string, is_lookup string")
    out = unmatched_requests(current_rules, reqs).collect()
    assert [r.rule_id for r in out] == ["rule_9"]
    assert out[0].message == "Rules are not configured for the combination of parameters passed."


def test_audit_frame_and_sinks(spark, current_rules, atm, tmp_path):
    r1 = run_rule(current_rules, atm, rule_id="rule_1", process="filtration", process_key="query_lookup",
                  table_name="atm_transactions", as_of=AS_OF)
    r2 = run_rule(current_rules, r1.df, rule_id="rule_4", process="identification",
                  process_key="query_builder", as_of=dt.date(2023, 1, 1))
    audit = audit_frame(spark, [("filtration", r1), ("identification", r2)])
    rows = audit.orderBy("stage").collect()
    assert [(r.stage, r.status) for r in rows] == [("filtration", "ok"), ("identification", "rejected")]
    path = str(tmp_path / "audit")
    append_table(audit, path)
    append_table(audit, path)
    assert spark.read.parquet(path).count() == 4
    out = str(tmp_path / "csv")
    write_csv(r1.df, out)
    back = read_csv_table(spark, out)
    assert back.count() == 7 and back.schema == atm.schema


def test_csv_scan_has_declared_types(atm):
    types = dict(atm.dtypes)
    assert types["time"] == "string" and types["cash_transaction"] == "boolean"
    assert types["transaction_total_amount"] == "int"


def test_time_span_per_session(atm):
    df = atm.withColumn("ts", transaction_timestamp())
    spans = {r.session_id: r for r in time_span(df, ["session_id"], "ts", "transaction_total_amount").collect()}
    assert spans[6].time_diff == 15.0 and spans[6].n_events == 2 and spans[6].total_amount == 22500
    assert spans[7].time_diff == 45.0
    assert str(spans[5].min_time) == "2022-02-03 08:15:00"


def test_elapsed_minutes_floor_each_side(spark):
    df = spark.createDataFrame([(1, "2024-01-01 10:00:00.900"), (1, "2024-01-01 10:01:00.100")], "g int, t string") \
        .selectExpr("g", "to_timestamp_ntz(t) as ts")
    row = time_span(df, ["g"], "ts").collect()[0]
    assert row.time_diff == 1.0   # 10:00:00 -> 10:01:00, not 0.8667


def test_stage_audit_counts_rows_and_marks_rejections(spark, current_rules, atm):
    from ruleforge.operators.stages import Stage, run_stages
    from ruleforge.operators.validation import stage_audit
    stages = [Stage("rule_1", "filtration", "query_lookup", "true", view_name="audit_filtered"),
              Stage("rule_4", "identification", "query_builder", "false")]
    ok = run_stages(current_rules, atm, stages, as_of=AS_OF, table_name="atm_transactions")
    rows = [(r.stage, r.status, r.rows_out) for r in stage_audit(spark, ok, ["f", "i"]).collect()]
    assert rows == [("f", "ok", 7), ("i", "ok", 3)]
    bad = run_stages(current_rules, atm, stages[::-1], as_of=dt.date(2023, 1, 1))
    rows = [(r.stage, r.status, r.rows_out) for r in stage_audit(spark, bad, ["i"]).collect()]
    assert rows == [("i", "rejected", None)]


def test_stage_texts_are_runnable_and_audit_lists_skipped(spark, current_rules, atm):
    from ruleforge.operators.stages import Stage, run_stages
    from ruleforge.operators.validation import stage_audit
    run = run_stages(current_rules, atm, [Stage("rule_1", "filtration", "query_lookup", "true"),
                                          Stage("rule_4", "identification", "query_builder", "false")],
                     as_of=AS_OF, table_name="atm_transactions")
    text = run.results[1].query
    assert text.startswith(" select * from (select * from atm_transactions where")
    assert spark.sql(text).count() == run.df.count() == 3
    bad = run_stages(current_rules, atm, [Stage("rule_4", "identification", "query_builder", "false"),
                                          Stage("rule_1", "filtration", "query_lookup", "true")],
                     as_of=dt.date(2023, 1, 1))
    rows = [(r.stage, r.status) for r in stage_audit(spark, bad, ["a", "b"]).collect()]
    assert rows == [("a", "rejected"), ("b", "skipped")]
    assert stage_audit(spark, bad, []).count() == 0


def test_audit_time_is_not_shifted(spark, current_rules, atm):
    from pyspark.sql import functions as F
    res = run_rule(current_rules, atm, rule_id="rule_3", process="identification",
                   process_key="query_builder", as_of=AS_OF)
    when = dt.datetime(2024, 1, 1, 12, 0, tzinfo=dt.timezone.utc)
    out = audit_frame(spark, [("s", res)], logged_at=when)
    assert out.select(F.unix_timestamp("logged_at")).first()[0] == int(when.timestamp())


def test_transformation_text_is_runnable(spark, atm):
    from ruleforge import RuleSet
    rs = RuleSet.from_rules(spark, [rule("t", [{"field_name": "cash_amount + 1"}], ("cash_amount", ""),
                                         process_key="transformation")])
    res = run_rule(rs, atm, rule_id="t", process="identification", process_key="transformation",
                   table_name="atm_transactions", as_of=AS_OF)
    assert sorted(tuple(r) for r in spark.sql(res.query).collect()) == sorted(tuple(r) for r in res.df.collect())


def test_validation_agrees_with_resolution(spark):
    rs = RuleSet.from_rules(spark, [
        rule("to_value", [cond("a", ">", "1")], ("goto", "v")),
        rule("v", [{"lookup_value": '{"k": "1"}'}], process_key="value_lookup"),
        rule("cyc_a", [cond("a", ">", "1")], ("goto", "cyc_b")),
        rule("cyc_b", [cond("a", ">", "2")], ("goto", "cyc_a")),
        rule("head", [cond("a", ">", "1")], ("goto", "tail")),
        rule("tail", [cond("a", ">", "1"), cond("b", "<", "2")]),          # goto target: empty join is AND
        rule("or_goto", [cond("a", ">", "1", "OR")], ("goto", "tail")),
        rule("g", [{"lookup_value": " where x > 1"}], process="filtration", process_key="groupby_lookup"),
        rule("t", [{"field_name": "a + 1"}], ("", ""), process_key="transformation"),
        rule("v2", [{"lookup_value": '{"k": "1"}'}, {"field_name": "x"}], process_key="value_lookup"),
    ])
    rep = {r.id: r.issues for r in rule_validation(rs, AS_OF).collect()}
    assert any("query_builder" in i for i in rep["to_value"])
    assert any("cycle" in i for i in rep["cyc_a"])
    assert rep["head"] == [] and rep["v2"] == []
    assert rep["tail"] and all("fine inside a goto chain" in i for i in rep["tail"])
    assert any("trailing OR" in i for i in rep["or_goto"])
    assert any("group by" in i for i in rep["g"])
    assert any("transformation needs" in i for i in rep["t"])


def test_stage_without_table_output_stops_the_run(spark, current_rules, atm):
    from ruleforge.operators.stages import Stage, run_stages
    from ruleforge.operators.validation import stage_audit
    run = run_stages(current_rules, atm, [Stage("rule_2", "identification", "value_lookup", "true",
                                                options={"value_key": "flag"}),
                                          Stage("rule_4", "identification", "query_builder", "false")],
                     as_of=AS_OF)
    assert run.df is None and not run.ok
    rows = [(r.stage, r.status) for r in stage_audit(spark, run, ["v", "b"]).collect()]
    assert rows == [("v", "no output"), ("b", "skipped")]
    audit = audit_frame(spark, [("v", run.results[0])]).first()
    assert audit.query == "pass"
    every = run_rule(current_rules, None, rule_id="rule_2", process="identification",
                     process_key="value_lookup", as_of=AS_OF)
    assert audit_frame(spark, [("all", every)]).first().query == '[["check_cheque_transaction", "yes"], ["flag", "pass"]]'


def test_elapsed_minutes_ignore_session_zone_and_dst(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(1, "2024-03-10 01:30:00"), (1, "2024-03-10 03:30:00")], "g int, t string") \
            .selectExpr("g", "to_timestamp_ntz(t) as ts")
        assert time_span(df, ["g"], "ts").first().time_diff == 120.0  # wall-clock minutes
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_stage_audit_counts_filter_chains_in_one_scan(spark, current_rules, atm):
    from ruleforge.operators.stages import Stage, run_stages
    from ruleforge.operators.validation import stage_audit
    stages = [Stage("rule_1", "filtration", "query_lookup", "true"),
              Stage("rule_3", "identification", "query_builder", "false"),
              Stage("rule_4", "identification", "query_builder", "false")]
    run = run_stages(current_rules, atm, stages, as_of=AS_OF)
    audit = stage_audit(spark, run, ["f", "i3", "i4"])
    assert [(r.stage, r.rows_out) for r in audit.collect()] == [("f", 7), ("i3", 5), ("i4", 3)]
    plan = audit._jdf.queryExecution().sparkPlan().toString()   # physical plan before AQE wrapping
    assert plan.count("FileScan") == 1
    flagged = run_stages(current_rules, atm, [stages[0], Stage("rule_3", "identification", "query_builder",
                                                               "false", options={"mode": "flag"}), stages[2]],
                         as_of=AS_OF)
    rows = [(r.stage, r.rows_out) for r in stage_audit(spark, flagged, ["f", "flag", "i4"]).collect()]
    assert rows == [("f", 7), ("flag", 7), ("i4", 3)]


def test_stage_audit_with_nondeterministic_filter(spark, current_rules, atm):
    from ruleforge import RuleSet
    from ruleforge.operators.stages import Stage, run_stages
    from ruleforge.operators.validation import stage_audit
    rs = RuleSet.from_rules(spark, [rule("all", [cond("cash_amount", ">=", "0")]),
                                    rule("sample", [cond("rand(7)", "<", "2")])])   # always true, non-deterministic
    run = run_stages(rs, atm, [Stage("all", "identification", "query_builder"),
                               Stage("sample", "identification", "query_builder")], as_of=AS_OF)
    assert [(r.stage, r.rows_out) for r in stage_audit(spark, run, ["a", "s"]).collect()] == [("a", 10), ("s", 10)]


def test_csv_columns_follow_the_header(spark, tmp_path):
    from pyspark.sql import types as T

    from ruleforge.sources.files import read_csv_table
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])
    (tmp_path / "swapped.csv").write_text("b,a\n1,2\n")
    assert [tuple(r) for r in read_csv_table(spark, str(tmp_path / "swapped.csv"), schema).collect()] == [(2, 1)]
    (tmp_path / "other.csv").write_text("b,c\n1,2\n")
    with pytest.raises(ValueError):
        read_csv_table(spark, str(tmp_path / "other.csv"), schema)


def test_csv_sink_refuses_existing_output(spark, tmp_path):
    from pyspark.errors import AnalysisException

    from ruleforge.sources.files import write_csv
    write_csv(spark.range(2), str(tmp_path / "out"))
    with pytest.raises(AnalysisException):
        write_csv(spark.range(3), str(tmp_path / "out"))
    write_csv(spark.range(3), str(tmp_path / "out"), mode="overwrite")


def test_ignored_lookups_are_reported(spark):
    rs = RuleSet.from_rules(spark, [rule("q", [{"lookup_value": " where a > 0"}, {"lookup_value": " where a > 5"}],
                                         process="filtration", process_key="query_lookup")])
    issues = rule_validation(rs, AS_OF).collect()[0].issues
    assert len(issues) == 1 and "first lookup_value only" in issues[0]


def test_checkpoint_folder_is_never_invented(spark):
    from ruleforge.session import checkpoint_root
    assert checkpoint_root(spark) == spark.conf.get("spark.checkpoint.dir")
