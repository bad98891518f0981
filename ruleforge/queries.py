"""Rule-driven queries over the shared test tables.

Every predicate below comes from ``TABLE_RULES`` through the rule path
(resolve -> compile -> apply); none is written by hand in the query. Each
query reads whole tables and returns key columns plus the operands, so the
driver can compare it with the matching SQL in ``ORACLE_SQL``.
"""

from __future__ import annotations

import datetime as dt
import weakref
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.json_lookup import json_entries, json_typed, json_value
from .operators.elapsed import time_span
from .operators.evaluate import RuleResult, run_rule
from .operators.multi_rule import compile_rules, rule_flags, rule_hit_counts, rule_hits
from .operators.rule_index import build_index, first_hits, index_hits
from .operators.rules_as_data import rules_as_data_hits, threshold_hit_counts, threshold_rules
from .operators.stages import Stage, run_stages
from .operators.validation import stage_audit, unmatched_requests
from .sources.ruleset import RuleSet

AS_OF = dt.date(2024, 6, 1)


def _rule(rule_id: str, process: str, process_key: str, when: list[dict], then=("", ""),
          is_lookup: str | None = None, window=("01/01/2020", "31/12/2999"), is_valid: str = "true") -> dict:
    if is_lookup is None:
        is_lookup = "true" if process_key in ("query_lookup", "value_lookup", "groupby_lookup",
                                              "conditional") else "false"
    return {"id": rule_id, "name": "TABLE_RULES", "description": rule_id, "is_valid": is_valid,
            "valid_from": window[0], "valid_till": window[1], "process": process,
            "process_key": process_key, "is_lookup": is_lookup, "when": when,
            "then": {"field_name": then[0], "field_value": then[1]}}


def _cond(field: str, operator: str, value: str, join: str = "") -> dict:
    return {"field_name": field, "operator": operator, "field_value": value, "join": join}


def _lookup(value) -> dict:
    return {"lookup_value": value}


IDENT = "identification"
FILT = "filtration"

TABLE_RULES = [
    _rule("li_returns_open", FILT, "query_lookup", [_lookup(
        " where l_returnflag = 'R' and l_linestatus in ('O','F') and l_quantity > 30")]),
    _rule("ord_big", IDENT, "query_builder", [_cond("o_totalprice", ">=", "100000")]),
    _rule("cust_building", IDENT, "query_builder", [_cond("c_mktsegment", "=", "BUILDING")]),
    _rule("li_net_value", IDENT, "query_builder",
          [_cond("l_extendedprice - l_quantity * 1000", ">=", "10000")]),
    _rule("part_econ", IDENT, "query_builder", [_cond("p_type", "LIKE", "ECON")]),
    _rule("part_not_econ", IDENT, "query_builder", [_cond("p_type", "NOT LIKE", "ECON")]),
    _rule("ord_final_and_big", IDENT, "query_builder",
          [_cond("o_orderstatus", "=", "F", "AND"), _cond("o_totalprice", ">=", "200000")]),
    _rule("ord_final_or_big", IDENT, "query_builder",
          [_cond("o_orderstatus", "=", "F", "OR"), _cond("o_totalprice", ">=", "200000")]),
    _rule("li_flag_precedence", IDENT, "query_builder",
          [_cond("l_returnflag", "=", "R", "OR"), _cond("l_returnflag", "=", "A", "AND"),
           _cond("l_quantity", ">=", "40")]),
    _rule("lbl_toxic", IDENT, "query_builder", [_cond("is_toxic", "=", "true")]),
    _rule("part_size_band", IDENT, "query_builder",
          [_cond("p_size", ">=", "10", "AND"), _cond("p_size", "<", "45")], ("goto", "part_economy")),
    _rule("part_economy", IDENT, "query_builder", [_cond("p_type", "=", "ECONOMY")],
          ("goto", "part_brand2")),
    _rule("part_brand2", IDENT, "query_builder", [_cond("p_brand", "LIKE", "Brand#2")],
          ("is_selected", "true")),
    _rule("ev_purchase_gate", IDENT, "conditional", [_lookup({"event_type": "purchase"})],
          ("goto", "ev_value_big")),
    _rule("ev_value_big", IDENT, "query_builder", [_cond("value - 10", ">=", "100")]),
    _rule("li_large_qty", IDENT, "query_builder", [_cond("l_quantity", ">=", "45")],
          ("is_large", "true")),
    _rule("li_net_price", IDENT, "transformation", [{"field_name": "l_extendedprice - l_quantity"}],
          ("l_extendedprice", "")),
    _rule("li_by_flag", FILT, "groupby_lookup", [_lookup(" group by l_returnflag")]),
    _rule("ev_quick_session", IDENT, "query_builder", [_cond("time_diff", "<=", "30")]),
    _rule("ev_props_key", IDENT, "value_lookup", [_lookup({"prop_key": "k"})]),
    # many rules, one scan
    _rule("hit_qty_high", IDENT, "query_builder", [_cond("l_quantity", ">=", "40")]),
    _rule("hit_price_high", IDENT, "query_builder", [_cond("l_extendedprice", ">=", "50000")]),
    _rule("hit_qty_low", IDENT, "query_builder", [_cond("l_quantity", "<=", "5")]),
    _rule("hit_flag_r", IDENT, "query_builder", [_cond("l_returnflag", "=", "R")]),
    _rule("hit_status_f", IDENT, "query_builder", [_cond("l_linestatus", "=", "F")]),
    _rule("thr_discount_high", IDENT, "query_builder", [_cond("l_discount", ">=", "0.055")]),
    _rule("thr_tax_low", IDENT, "query_builder", [_cond("l_tax", "<", "0.015")]),
    _rule("li_price_steps", IDENT, "transformation",
          [{"field_name": "l_extendedprice - l_quantity"}, {"field_name": "l_extendedprice * 2"}],
          ("l_extendedprice", "")),
    # validity windows that end inside the order dates
    _rule("asof_1997_big", IDENT, "query_builder", [_cond("o_totalprice", ">=", "100000")],
          window=("01/01/1997", "31/12/1997")),
    _rule("asof_early_final", IDENT, "query_builder", [_cond("o_orderstatus", "=", "F")],
          window=("15/06/1993", "30/06/1996")),
    _rule("asof_chain", IDENT, "query_builder", [_cond("o_orderpriority", "LIKE", "1-")],
          ("goto", "asof_1997_big"), window=("01/07/1996", "30/06/1997")),
    _rule("asof_off", IDENT, "query_builder", [_cond("o_totalprice", ">=", "1")], is_valid="false",
          window=("01/01/1990", "31/12/2999")),
]

# generated rules: 240 thresholds over four lineitem columns, every comparison
GENERATED_FIELDS = [("l_quantity", 1.0, 50.0), ("l_extendedprice", 1000.0, 100000.0),
                    ("l_discount", 0.0, 0.1), ("l_tax", 0.0, 0.08)]
GENERATED_OPS = (">=", "<", ">", "<=", "=", "<>")


def generated_thresholds(n: int = 240) -> list[tuple[str, str, str, str]]:
    """(rule id, field, operator, value) of ``n`` generated rules."""
    out = []
    for i in range(n):
        name, low, high = GENERATED_FIELDS[i % len(GENERATED_FIELDS)]
        step = (i // len(GENERATED_FIELDS) + 1) / (n // len(GENERATED_FIELDS) + 2)
        out.append((f"gen_{i}", name, GENERATED_OPS[i // 4 % len(GENERATED_OPS)], f"{low + (high - low) * step:.2f}"))
    return out

STORED_RULE_IDS = ["li_returns_open", "hit_qty_high", "li_flag_precedence", "li_net_value", "hit_status_f"]
MULTI_RULE_IDS = ["hit_qty_high", "hit_price_high", "hit_qty_low", "hit_flag_r", "hit_status_f"]
VALIDITY_RULE_IDS = ["asof_1997_big", "asof_early_final", "asof_chain", "asof_off"]
THRESHOLD_RULE_IDS = ["hit_qty_high", "hit_price_high", "hit_qty_low", "thr_discount_high", "thr_tax_low"]

_DOCUMENTS: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def table_rules(spark: SparkSession) -> RuleSet:
    """The query rule document, read once per session."""
    if spark not in _DOCUMENTS:
        _DOCUMENTS[spark] = RuleSet.from_rules(spark, TABLE_RULES)
    return _DOCUMENTS[spark]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ok(res: RuleResult) -> DataFrame:
    if not res.ok or res.df is None:
        raise RuntimeError(f"rule rejected: {res.message}")
    return res.df


def _builder(spark, sf_dir, tbl, rule_id, cols, **kw) -> DataFrame:
    df = table(spark, sf_dir, tbl)
    res = run_rule(table_rules(spark), df, rule_id=rule_id, process=IDENT,
                   process_key=kw.pop("process_key", "query_builder"), as_of=AS_OF,
                   table_name=tbl, **kw)
    return _ok(res).select(*cols)


LI_KEYS = ["l_orderkey", "l_linenumber"]


def flt_query_lookup(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    res = run_rule(table_rules(spark), df, rule_id="li_returns_open", process=FILT,
                   process_key="query_lookup", as_of=AS_OF, table_name="lineitem")
    return _ok(res).select(*LI_KEYS, "l_returnflag", "l_linestatus", "l_quantity")


def pred_ge(spark, sf_dir):
    return _builder(spark, sf_dir, "orders", "ord_big", ["o_orderkey", "o_totalprice"])


def pred_eq(spark, sf_dir):
    return _builder(spark, sf_dir, "customer", "cust_building", ["c_custkey", "c_mktsegment"])


def pred_expr_operand(spark, sf_dir):
    return _builder(spark, sf_dir, "lineitem", "li_net_value",
                    LI_KEYS + ["l_quantity", "l_extendedprice"])


def pred_like(spark, sf_dir):
    return _builder(spark, sf_dir, "part", "part_econ", ["p_partkey", "p_type"])


def pred_not_like(spark, sf_dir):
    return _builder(spark, sf_dir, "part", "part_not_econ", ["p_partkey", "p_type"])


def pred_and(spark, sf_dir):
    return _builder(spark, sf_dir, "orders", "ord_final_and_big",
                    ["o_orderkey", "o_orderstatus", "o_totalprice"])


def pred_or(spark, sf_dir):
    return _builder(spark, sf_dir, "orders", "ord_final_or_big",
                    ["o_orderkey", "o_orderstatus", "o_totalprice"])


def pred_precedence(spark, sf_dir):
    return _builder(spark, sf_dir, "lineitem", "li_flag_precedence",
                    LI_KEYS + ["l_returnflag", "l_quantity"])


def pred_bool(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").withColumn("is_toxic", F.col("toxic").cast("boolean"))
    res = run_rule(table_rules(spark), labels, rule_id="lbl_toxic", process=IDENT,
                   process_key="query_builder", as_of=AS_OF, table_name="labels")
    return _ok(res).select("doc_id", "toxic")


def goto_chain(spark, sf_dir):
    return _builder(spark, sf_dir, "part", "part_size_band",
                    ["p_partkey", "p_size", "p_type", "p_brand"])


def conditional_goto(spark, sf_dir):
    return _builder(spark, sf_dir, "events", "ev_purchase_gate", ["event_id", "event_type", "value"],
                    process_key="conditional")


def conditional_gated(spark, sf_dir):
    return _builder(spark, sf_dir, "events", "ev_purchase_gate", ["event_id", "event_type", "value"],
                    process_key="conditional", gate=True)


def then_flag(spark, sf_dir):
    return _builder(spark, sf_dir, "lineitem", "li_large_qty",
                    LI_KEYS + ["l_quantity", "is_large"], mode="flag")


def transform_column(spark, sf_dir):
    return _builder(spark, sf_dir, "lineitem", "li_net_price", LI_KEYS + ["l_extendedprice"],
                    process_key="transformation")


def transform_steps(spark, sf_dir):
    return _builder(spark, sf_dir, "lineitem", "li_price_steps", LI_KEYS + ["l_extendedprice"],
                    process_key="transformation")


def rule_validity_asof(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    batch = compile_rules(table_rules(spark), orders, VALIDITY_RULE_IDS, as_of="o_orderdate", strict=False)
    if set(batch.rejected) != {"asof_off"}:
        raise RuntimeError(f"rules rejected: {batch.rejected}")
    return rule_hits(orders, batch, ["o_orderkey"])


def rule_requests_unmatched(spark, sf_dir):
    """Rule calls derived from events: purchases and clicks name rules of the document, the others do not."""
    kind = F.col("event_type")
    requests = table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("value") < 5, "filtration").otherwise(" identification ").alias("process"),
        F.when(kind == "click", "conditional").otherwise("query_builder").alias("process_key"),
        F.when(kind == "click", "ev_purchase_gate").when(kind == "purchase", "ev_value_big")
        .otherwise(F.concat(F.lit("ev_"), kind)).alias("rule_id"),
        F.when(kind == "click", F.lit(None).cast("string")).otherwise("false").alias("is_lookup"))
    return unmatched_requests(table_rules(spark), requests).select("event_id", "rule_id", "message")


def generated_rules(spark):
    return RuleSet.from_rules(spark, [_rule(rid, IDENT, "query_builder", [_cond(f, op, v)])
                                      for rid, f, op, v in generated_thresholds()])


def rule_hit_counts_240(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    return rule_hit_counts(df, compile_rules(generated_rules(spark), df, as_of=AS_OF))


def rules_as_data_counts_240(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    return threshold_hit_counts(df, threshold_rules(generated_rules(spark), df, as_of=AS_OF))


def generated_conjunctions(n: int = 200) -> list[tuple[str, list[tuple[str, str, str, str]]]]:
    """(rule id, [(field, operator, value, join)]) of ``n`` rules of one to three conditions over lineitem."""
    out = []
    for i in range(n):
        quantity, price = str(2 + i % 47), str(2000 + 450 * (i % 200))
        conds = [("l_quantity", (">=", "<", "<>", "=")[i % 4], quantity, "AND"), ("l_extendedprice", ("<", ">=")[i // 4 % 2], price, "")]
        if i % 3 == 1:
            conds = [("l_returnflag", ("=", "<>")[i // 3 % 2], "ANR"[i % 3], "AND"), *conds]
        elif i % 3 == 2:
            conds = [conds[0], ("l_linestatus", "=", "OF"[i // 3 % 2], "OR"), ("l_discount", ">", f"0.0{i % 10}", "")]
        out.append((f"and_{i}", conds))
    return out


def generated_texts(n: int = 500) -> list[tuple[str, list[tuple[str, str, str, str]]]]:
    """The same for ``n`` rules over the text columns of part."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    out = []
    for i in range(n):
        start = letters[i % 26] + letters[i // 26 * 7 % 26]
        brand, kind = f"Brand#{1 + i % 25}", ("STANDARD", "ECONOMY", "SMALL", "MEDIUM", "LARGE", "PROMO")[i // 5 % 6]
        out.append((f"text_{i}", [
            [("p_name", "LIKE", start[:1 + i // 5 % 2], "")],
            [("p_name", (">=", "<")[i // 5 % 2], start, "")],
            [("p_brand", "=", brand, "")],
            [("p_brand", "LIKE", brand[:7], "AND"), ("p_name", "<", start, "")],
            [("p_type", "<>", kind, "AND"), ("p_name", "NOT LIKE", start[0], "OR"), ("p_brand", "=", brand, "")],
        ][i % 5]))
    return out


EXACT_FIELDS = ("l_linenumber + 9007199254740990L", "cast(l_orderkey as decimal(38,18))")


def generated_exact() -> list[tuple[str, list[tuple[str, str, str, str]]]]:
    """Thresholds that double cannot tell apart: around 2**53, and in the last place of decimal(38,18)."""
    whole = [str(2 ** 53 + k) for k in range(-2, 6)]
    fine = [f"{k}{end}" for k in (100, 2500, 7001) for end in (".000000000000000001", "", ".999999999999999999")]
    return [(f"exact_{i}", [(field, op, value, "")]) for i, (field, op, value) in enumerate(
        (field, op, value) for field, values in zip(EXACT_FIELDS, (whole, fine)) for op in GENERATED_OPS for value in values)]


def generated_versions(n: int = 1000) -> list[tuple[str, list[tuple[str, str, str, str]], tuple[dt.date, dt.date]]]:
    """Rule versions over orders, each valid for one to thirteen weeks."""
    out = []
    for i in range(n):
        start = dt.date(1995, 1, 1) + dt.timedelta(days=i * 12 // 5)
        conds = [("o_totalprice", (">=", "<")[i % 2], str(1000 * (i % 300)), "")]
        if i % 3 == 0:
            conds = [("o_orderstatus", "=", "FOP"[i // 3 % 3], "AND"), *conds]
        out.append((f"version_{i}", conds, (start, start + dt.timedelta(days=7 * (1 + i % 13) - 1))))
    return out


def _generated_set(spark, rules) -> RuleSet:
    window = lambda w: tuple(d.strftime("%d/%m/%Y") for d in w)
    return RuleSet.from_rules(spark, [_rule(rid, IDENT, "query_builder", [_cond(*c) for c in conds],
                                            **({"window": window(w[0])} if w else {})) for rid, conds, *w in rules])


def _index_counts(spark, df, rules, as_of=AS_OF) -> DataFrame:
    return rule_hit_counts(df, compile_rules(_generated_set(spark, rules), df, [r[0] for r in rules], as_of=as_of))


def rule_index_conjunctions(spark, sf_dir):
    """Counts of 200 rules of several conditions, through the predicate index."""
    return _index_counts(spark, table(spark, sf_dir, "lineitem"), generated_conjunctions())


def rule_index_texts(spark, sf_dir):
    """Counts of 500 text rules: equality, order and prefixes by place in the text order."""
    return _index_counts(spark, table(spark, sf_dir, "part"), generated_texts())


def rule_index_exact(spark, sf_dir):
    """Counts of bigint and decimal thresholds, compared in the operand's own type."""
    return _index_counts(spark, table(spark, sf_dir, "lineitem"), generated_exact())


def rule_versions_asof(spark, sf_dir):
    """Counts of 1000 dated rule versions; an order meets only versions valid on its own date."""
    return _index_counts(spark, table(spark, sf_dir, "orders"), generated_versions(), "o_orderdate")


def first_firing_rule(spark, sf_dir):
    """The first rule of a list of 200 that fires, for every lineitem."""
    df = table(spark, sf_dir, "lineitem")
    rules = generated_conjunctions()[::-1]
    batch = compile_rules(_generated_set(spark, rules), df, [r[0] for r in rules], as_of=AS_OF)
    return first_hits(df, build_index(df, batch.compiled), LI_KEYS)


def stored_and_built_hits(spark, sf_dir):
    """A stored query, built predicates and a goto-free precedence rule in one scan."""
    df = table(spark, sf_dir, "lineitem")
    batch = compile_rules(table_rules(spark), df, STORED_RULE_IDS, as_of=AS_OF)
    return index_hits(df, build_index(df, batch.compiled), LI_KEYS)


def groupby_lookup(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    res = run_rule(table_rules(spark), df, rule_id="li_by_flag", process=FILT,
                   process_key="groupby_lookup", as_of=AS_OF, table_name="lineitem",
                   aggregates={"row_count": "count(*)",
                               "sum_qty": "cast(sum(cast(l_quantity as decimal(18,2))) as double)",
                               "sum_price": "cast(sum(cast(l_extendedprice as decimal(18,2))) as double)"})
    return _ok(res)


def elapsed_minutes(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    spans = time_span(events, ["user_id", F.to_date("ts").alias("event_day")], "ts", "value",
                      amount_alias="total_value")
    res = run_rule(table_rules(spark), spans, rule_id="ev_quick_session", process=IDENT,
                   process_key="query_builder", as_of=AS_OF, table_name="event_spans")
    return _ok(res).select("user_id", F.date_format("event_day", "yyyy-MM-dd").alias("event_day"),
                           "n_events", "total_value", "time_diff")


def ordered_result(spark, sf_dir):
    columns = ["o_orderkey", "o_totalprice"]
    return _builder(spark, sf_dir, "orders", "ord_big", columns, order_by=["o_orderkey"], columns=columns)


def staged_filter_identify(spark, sf_dir):
    run = run_stages(table_rules(spark), table(spark, sf_dir, "lineitem"), [
        Stage("li_returns_open", FILT, "query_lookup"),
        Stage("li_net_value", IDENT, "query_builder"),
    ], as_of=AS_OF, table_name="lineitem")
    if run.df is None:
        raise RuntimeError(f"stage rejected: {run.results[-1].message}")
    return run.df.select(*LI_KEYS, "l_returnflag", "l_quantity", "l_extendedprice")


def rule_audit(spark, sf_dir):
    run = run_stages(table_rules(spark), table(spark, sf_dir, "lineitem"), [
        Stage("li_returns_open", FILT, "query_lookup", view_name="li_open_returns"),
        Stage("li_net_value", IDENT, "query_builder"),
    ], as_of=AS_OF, table_name="lineitem")
    return stage_audit(spark, run, ["filter", "identify"])


def multi_rule_hits(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    batch = compile_rules(table_rules(spark), df, MULTI_RULE_IDS, as_of=AS_OF)
    return rule_hits(df, batch, LI_KEYS)


def rule_hit_counts_query(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    batch = compile_rules(table_rules(spark), df, MULTI_RULE_IDS, as_of=AS_OF)
    return rule_hit_counts(df, batch)


def multi_rule_flags(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    batch = compile_rules(table_rules(spark), df, MULTI_RULE_IDS, as_of=AS_OF)
    return rule_flags(df.select(*LI_KEYS, "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus"),
                      batch, prefix="flag_").drop("l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus")


def rules_as_data_join(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    rules = threshold_rules(table_rules(spark), df, THRESHOLD_RULE_IDS, as_of=AS_OF)
    return rules_as_data_hits(df, rules, LI_KEYS)


def rules_as_data_counts(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    rules = threshold_rules(table_rules(spark), df, THRESHOLD_RULE_IDS, as_of=AS_OF)
    return threshold_hit_counts(df, rules)


def _prop_key(spark) -> str:
    res = run_rule(table_rules(spark), None, rule_id="ev_props_key", process=IDENT,
                   process_key="value_lookup", value_key="prop_key", as_of=AS_OF)
    if res.valid_params is not True:
        raise RuntimeError(res.message)
    return res.value


def lookup_value_key(spark, sf_dir):
    key = _prop_key(spark)
    events = table(spark, sf_dir, "events")
    return events.select("event_id", json_value("props", key).alias("prop_value"))


def lookup_entries(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", F.inline(json_entries("props")).alias("prop_key", "prop_value"))


def lookup_typed_values(spark, sf_dir):
    """Values of every event's JSON by their JSON type, from the document itself and from one nested around it."""
    events = table(spark, sf_dir, "events")
    nested = F.concat(F.lit('{"outer": {"list": [null, '), "props", F.lit('], "id": '), F.col("event_id").cast("string"), F.lit("}}"))
    return events.select("event_id", json_typed("props", "$.k", "int").alias("k_int"), json_typed("props", "$.k", "double").alias("k_double"),
                         json_typed("props", "$.missing", "int").alias("k_missing"),
                         json_typed(nested, "$.outer.list[0]", "int").alias("k_null"),
                         json_typed(nested, "$.outer.list[1].k", "bigint").alias("k_nested"),
                         json_typed(nested, "$.outer.id", "bigint").alias("id_nested"),
                         json_typed(nested, "$.outer.list[1]", "boolean").alias("no_boolean"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "flt_query_lookup": flt_query_lookup,
    "pred_ge": pred_ge,
    "pred_eq": pred_eq,
    "pred_expr_operand": pred_expr_operand,
    "pred_like": pred_like,
    "pred_not_like": pred_not_like,
    "pred_and": pred_and,
    "pred_or": pred_or,
    "pred_precedence": pred_precedence,
    "pred_bool": pred_bool,
    "goto_chain": goto_chain,
    "conditional_goto": conditional_goto,
    "conditional_gated": conditional_gated,
    "then_flag": then_flag,
    "transform_column": transform_column,
    "transform_steps": transform_steps,
    "rule_validity_asof": rule_validity_asof,
    "rule_requests_unmatched": rule_requests_unmatched,
    "rule_hit_counts_240": rule_hit_counts_240,
    "rules_as_data_counts_240": rules_as_data_counts_240,
    "rule_index_conjunctions": rule_index_conjunctions,
    "rule_index_texts": rule_index_texts,
    "rule_index_exact": rule_index_exact,
    "rule_versions_asof": rule_versions_asof,
    "first_firing_rule": first_firing_rule,
    "stored_and_built_hits": stored_and_built_hits,
    "groupby_lookup": groupby_lookup,
    "elapsed_minutes": elapsed_minutes,
    "ordered_result": ordered_result,
    "staged_filter_identify": staged_filter_identify,
    "rule_audit": rule_audit,
    "multi_rule_hits": multi_rule_hits,
    "rule_hit_counts": rule_hit_counts_query,
    "multi_rule_flags": multi_rule_flags,
    "rules_as_data_join": rules_as_data_join,
    "rules_as_data_counts": rules_as_data_counts,
    "lookup_value_key": lookup_value_key,
    "lookup_entries": lookup_entries,
    "lookup_typed_values": lookup_typed_values,
}

_LI = "l_orderkey, l_linenumber"


def _generated_sql() -> str:
    """(l_orderkey, l_linenumber, rule_id, hit) of every generated rule, in DuckDB SQL."""
    rules = generated_thresholds()
    tests = ", ".join(f"{{'rule_id': '{rid}', 'hit': {f} {op} {v}::double}}" for rid, f, op, v in rules)
    return f"select {_LI}, r.rule_id as rule_id, r.hit as hit from (select {_LI}, unnest([{tests}]) as r from lineitem)"


_GENERATED_COUNTS = ("select rule_id, sum(case when hit then 1 else 0 end)::bigint as hits "
                     f"from ({_generated_sql()}) group by rule_id")



def _conditions_sql(conds) -> str:
    """Conditions of a generated rule in DuckDB SQL (AND binds tighter, as in the rules)."""
    parts = []
    for field, op, value, join in conds:
        if op in ("LIKE", "NOT LIKE"):
            test = f"{field} {op} '{value}%'"
        elif field in EXACT_FIELDS:
            kind = "bigint" if field == EXACT_FIELDS[0] else "decimal(38,18)"
            test = f"{field.replace('990L', '990')} {op} '{value}'::{kind}"
        else:
            test = f"{field} {op} " + (value if value.replace(".", "").isdigit() else f"'{value}'")
        parts.append(test + (f" {join} " if join else ""))
    return "".join(parts)


def _counts_sql(tbl: str, rules, date: str | None = None) -> str:
    """(rule_id, hits) of generated rules, zero counts included."""
    tests = []
    for rid, conds, *window in rules:
        test = f"({_conditions_sql(conds)})"
        if window:
            (start, end), = window
            test += f" and {date} >= date '{start}' and {date} < date '{end + dt.timedelta(days=1)}'"
        tests.append(f"{{'rule_id': '{rid}', 'hit': {test}}}")
    return ("select r.rule_id as rule_id, sum(case when r.hit then 1 else 0 end)::bigint as hits "
            f"from (select unnest([{', '.join(tests)}]) as r from {tbl}) group by 1")


ORACLE_SQL: dict[str, str] = {
    "flt_query_lookup": f"select {_LI}, l_returnflag, l_linestatus, l_quantity from lineitem "
                        "where l_returnflag = 'R' and l_linestatus in ('O','F') and l_quantity > 30",
    "pred_ge": "select o_orderkey, o_totalprice from orders where o_totalprice >= 100000",
    "pred_eq": "select c_custkey, c_mktsegment from customer where c_mktsegment = 'BUILDING'",
    "pred_expr_operand": f"select {_LI}, l_quantity, l_extendedprice from lineitem "
                         "where l_extendedprice - l_quantity * 1000 >= 10000",
    "pred_like": "select p_partkey, p_type from part where p_type like 'ECON%'",
    "pred_not_like": "select p_partkey, p_type from part where p_type not like 'ECON%'",
    "pred_and": "select o_orderkey, o_orderstatus, o_totalprice from orders "
                "where o_orderstatus = 'F' and o_totalprice >= 200000",
    "pred_or": "select o_orderkey, o_orderstatus, o_totalprice from orders "
               "where o_orderstatus = 'F' or o_totalprice >= 200000",
    "pred_precedence": f"select {_LI}, l_returnflag, l_quantity from lineitem "
                       "where l_returnflag = 'R' or l_returnflag = 'A' and l_quantity >= 40",
    "pred_bool": "select doc_id, toxic from labels where toxic <> 0",
    "goto_chain": "select p_partkey, p_size, p_type, p_brand from part where p_size >= 10 "
                  "and p_size < 45 and p_type = 'ECONOMY' and p_brand like 'Brand#2%'",
    "conditional_goto": "select event_id, event_type, value from events where value - 10 >= 100",
    "conditional_gated": "select event_id, event_type, value from events "
                         "where event_type = 'purchase' and value - 10 >= 100",
    "then_flag": f"select {_LI}, l_quantity, case when l_quantity >= 45 then 'true' end as is_large "
                 "from lineitem",
    "transform_column": f"select {_LI}, l_extendedprice - l_quantity as l_extendedprice from lineitem",
    "transform_steps": f"select {_LI}, (l_extendedprice - l_quantity) * 2 as l_extendedprice from lineitem",
    "rule_validity_asof": " union all ".join([
        "select o_orderkey, 'asof_1997_big' as rule_id from orders where o_totalprice >= 100000 "
        "and o_orderdate >= date '1997-01-01' and o_orderdate < date '1998-01-01'",
        "select o_orderkey, 'asof_early_final' as rule_id from orders where o_orderstatus = 'F' "
        "and o_orderdate >= date '1993-06-15' and o_orderdate < date '1996-07-01'",
        "select o_orderkey, 'asof_chain' as rule_id from orders where o_orderpriority like '1-%' "
        "and o_totalprice >= 100000 and o_orderdate >= date '1997-01-01' and o_orderdate < date '1997-07-01'",
    ]),
    "rule_requests_unmatched": "select event_id, case event_type when 'click' then 'ev_purchase_gate' "
                               "when 'purchase' then 'ev_value_big' else 'ev_' || event_type end as rule_id, "
                               "'Rules are not configured for the combination of parameters passed.' as message "
                               "from events where value < 5 or event_type not in ('click', 'purchase')",
    "rule_hit_counts_240": _GENERATED_COUNTS,
    "rules_as_data_counts_240": _GENERATED_COUNTS,
    "rule_index_conjunctions": _counts_sql("lineitem", generated_conjunctions()),
    "rule_index_texts": _counts_sql("part", generated_texts()),
    "rule_index_exact": _counts_sql("lineitem", generated_exact()),
    "rule_versions_asof": _counts_sql("orders", generated_versions(), "o_orderdate"),
    "first_firing_rule": f"select {_LI}, case " + " ".join(
        f"when {_conditions_sql(conds)} then '{rid}'" for rid, conds in generated_conjunctions()[::-1]) + " end as rule_id from lineitem",
    "stored_and_built_hits": " union all ".join(f"select {_LI}, '{rid}' as rule_id from lineitem where {test}" for rid, test in (
        ("li_returns_open", "l_returnflag = 'R' and l_linestatus in ('O','F') and l_quantity > 30"),
        ("hit_qty_high", "l_quantity >= 40"), ("hit_status_f", "l_linestatus = 'F'"),
        ("li_flag_precedence", "l_returnflag = 'R' or l_returnflag = 'A' and l_quantity >= 40"),
        ("li_net_value", "l_extendedprice - l_quantity * 1000 >= 10000"))),
    "groupby_lookup": "select l_returnflag, count(*) as row_count, "
                      "cast(sum(cast(l_quantity as decimal(18,2))) as double) as sum_qty, "
                      "cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as sum_price from lineitem group by l_returnflag",
    "elapsed_minutes": "select user_id, strftime(event_day, '%Y-%m-%d') as event_day, n_events, "
                       "total_value, time_diff from (select user_id, cast(ts as date) as event_day, "
                       "count(*) as n_events, "
                       "cast(round(sum(cast(value as decimal(28,6))), 2) as double) as total_value, "
                       "(floor(epoch(max(ts))) - floor(epoch(min(ts)))) / 60 as time_diff "
                       "from events group by user_id, cast(ts as date)) where time_diff <= 30",
    "ordered_result": "select o_orderkey, o_totalprice from orders where o_totalprice >= 100000 "
                      "order by o_orderkey",
    "staged_filter_identify": f"select {_LI}, l_returnflag, l_quantity, l_extendedprice from lineitem "
                              "where l_returnflag = 'R' and l_linestatus in ('O','F') and l_quantity > 30 "
                              "and l_extendedprice - l_quantity * 1000 >= 10000",
    "rule_audit": "select 'filter' as stage, 'li_returns_open' as rule_id, 'ok' as status, "
                  "'Successfully returning the lookup query' as message, "
                  "' select * from lineitem where l_returnflag = ''R'' and l_linestatus in (''O'',''F'') "
                  "and l_quantity > 30' as query, "
                  "' select * from lineitem where l_returnflag = ''R'' and l_linestatus in (''O'',''F'') "
                  "and l_quantity > 30' as executed, count(*) as rows_out from lineitem "
                  "where l_returnflag = 'R' and l_linestatus in ('O','F') and l_quantity > 30 "
                  "union all select 'identify', 'li_net_value', 'ok', "
                  "'Successfully returning the dynamically generated query', "
                  "' select * from li_open_returns  where l_extendedprice - l_quantity * 1000 >= 10000', "
                  "' select * from li_open_returns  where ((l_extendedprice - l_quantity * 1000) >= 10000.0D)', "
                  "count(*) from lineitem where l_returnflag = 'R' and l_linestatus in ('O','F') "
                  "and l_quantity > 30 and l_extendedprice - l_quantity * 1000 >= 10000",
    "multi_rule_hits": " union all ".join([
        f"select {_LI}, 'hit_qty_high' as rule_id from lineitem where l_quantity >= 40",
        f"select {_LI}, 'hit_price_high' as rule_id from lineitem where l_extendedprice >= 50000",
        f"select {_LI}, 'hit_qty_low' as rule_id from lineitem where l_quantity <= 5",
        f"select {_LI}, 'hit_flag_r' as rule_id from lineitem where l_returnflag = 'R'",
        f"select {_LI}, 'hit_status_f' as rule_id from lineitem where l_linestatus = 'F'",
    ]),
    "rule_hit_counts": " union all ".join([
        "select 'hit_qty_high' as rule_id, count(*) as hits from lineitem where l_quantity >= 40",
        "select 'hit_price_high' as rule_id, count(*) as hits from lineitem where l_extendedprice >= 50000",
        "select 'hit_qty_low' as rule_id, count(*) as hits from lineitem where l_quantity <= 5",
        "select 'hit_flag_r' as rule_id, count(*) as hits from lineitem where l_returnflag = 'R'",
        "select 'hit_status_f' as rule_id, count(*) as hits from lineitem where l_linestatus = 'F'",
    ]),
    "multi_rule_flags": f"select {_LI}, coalesce(l_quantity >= 40, false) as flag_hit_qty_high, "
                        "coalesce(l_extendedprice >= 50000, false) as flag_hit_price_high, "
                        "coalesce(l_quantity <= 5, false) as flag_hit_qty_low, "
                        "coalesce(l_returnflag = 'R', false) as flag_hit_flag_r, "
                        "coalesce(l_linestatus = 'F', false) as flag_hit_status_f from lineitem",
    "rules_as_data_join": " union all ".join([
        f"select {_LI}, 'hit_qty_high' as rule_id from lineitem where l_quantity >= 40",
        f"select {_LI}, 'hit_price_high' as rule_id from lineitem where l_extendedprice >= 50000",
        f"select {_LI}, 'hit_qty_low' as rule_id from lineitem where l_quantity <= 5",
        f"select {_LI}, 'thr_discount_high' as rule_id from lineitem where l_discount >= 0.055",
        f"select {_LI}, 'thr_tax_low' as rule_id from lineitem where l_tax < 0.015",
    ]),
    "rules_as_data_counts": " union all ".join([
        "select 'hit_qty_high' as rule_id, count(*) as hits from lineitem where l_quantity >= 40",
        "select 'hit_price_high' as rule_id, count(*) as hits from lineitem where l_extendedprice >= 50000",
        "select 'hit_qty_low' as rule_id, count(*) as hits from lineitem where l_quantity <= 5",
        "select 'thr_discount_high' as rule_id, count(*) as hits from lineitem where l_discount >= 0.055",
        "select 'thr_tax_low' as rule_id, count(*) as hits from lineitem where l_tax < 0.015",
    ]),
    "lookup_typed_values": "select event_id, cast(json_extract_string(props, '$.k') as integer) as k_int, "
                           "cast(json_extract_string(props, '$.k') as double) as k_double, null::integer as k_missing, "
                           "null::integer as k_null, cast(json_extract_string(props, '$.k') as bigint) as k_nested, "
                           "event_id as id_nested, null::boolean as no_boolean from events",
    "lookup_value_key": "select event_id, json_extract_string(props, '$.k') as prop_value from events",
    "lookup_entries": "select event_id, prop_key, json_extract_string(props, '$.\"' || prop_key || '\"') "
                      "as prop_value from (select event_id, props, unnest(json_keys(props)) as prop_key "
                      "from events)",
}
