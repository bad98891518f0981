"""The predicate index against the compiled predicates, one filter per rule."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from conftest import AS_OF, cond, rule
from pyspark.sql import functions as F

from ruleforge import RuleSet
from ruleforge.errors import RuleConfigError
from ruleforge.operators.multi_rule import compile_rules, rule_hit_counts
from ruleforge.operators.rule_index import build_index, first_hits, index_hit_counts, index_hits

SCHEMA = ("k int, x double, f float, i int, big bigint, dec decimal(38,18), s string, b boolean, d date, at timestamp_ntz, "
          "`odd name` int")
BIG = 2 ** 53
NAN, INF = float("nan"), float("inf")


def _rows():
    rng = random.Random(5)
    pick = lambda *v: rng.choice(v)
    rows = [(k, pick(None, NAN, INF, -INF, 0.0, -0.0, 1.5, 2.0, 2.5, 1e300), pick(None, 0.1, 0.5, -3.25, NAN),
             pick(None, -2 ** 31, -1, 0, 1, 2, 3, 2 ** 31 - 1), pick(None, BIG - 1, BIG, BIG + 1, BIG + 2, -2 ** 63, 2 ** 63 - 1),
             pick(None, Decimal("1.000000000000000001"), Decimal(1), Decimal("0.999999999999999999"), Decimal(10) ** 19),
             pick(None, "", "a", "ab", "abc", "b", "é", "\U0001F984", "\U0010FFFF", "z\0", "12", "A"), pick(None, True, False),
             pick(None, dt.date(2020, 1, 1), dt.date(2020, 1, 2), dt.date(1999, 12, 31)),
             pick(None, dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 1, 0, 0, 0, 1), dt.datetime(2021, 5, 5, 12)), pick(None, 1, 2))
            for k in range(400)]
    return rows


@pytest.fixture(scope="module")
def wide(spark):
    return spark.createDataFrame(_rows(), SCHEMA).repartition(3).cache()


VALUES = {"x": ["0", "-0.0", "1.5", "2.25", "1e308"], "f": ["0.1", "0.5", "-3.25"], "i": ["1", "2.5", "-2147483648", "3000000000", "0"],
          "big": [str(BIG), str(BIG + 1), "9223372036854775807", "9223372036854775808", "-9223372036854775808", "0.5"],
          "dec": ["1", "1.000000000000000001", "1.0000000000000000005", "99999999999999999999", "-0.5"],
          "s": ["a", "ab", "é", "\U0010FFFF", "", "b'c", "12"], "b": ["true", "false"],
          "d": ["2020-01-01", "1999-12-31"], "at": ["2020-01-01", "2020-01-01 00:00:00.000001"], "`odd name`": ["1"],
          "x + i": ["2.5"], "i % 2": ["0"]}
OPS = ["=", "==", "<=>", "<>", "!=", "<", "<=", ">", ">="]


def _random_rules(n, seed):
    rng = random.Random(seed)
    rules = []
    for r in range(n):
        conds = []
        for j in range(rng.choice([1, 1, 2, 3, 4])):
            name = rng.choice([f for f in VALUES if j == 0 or f not in ("x + i", "i % 2")])
            op = rng.choice(OPS + (["LIKE", "NOT LIKE"] * 3 if name == "s" else []))
            conds.append(cond(name, op, rng.choice(VALUES[name]), rng.choice(["AND", "AND", "OR"])))
        conds[-1]["join"] = ""
        rules.append(rule(f"r{r}", conds))
    rules.append(rule("many", [cond("i", "=", str(k % 4), "OR") for k in range(10)] + [cond("s", "=", "a")]))  # too many alternatives
    return rules


@pytest.mark.parametrize("seed", [1, 2])
def test_index_equals_one_filter_per_rule(spark, wide, seed):
    rules = _random_rules(75, seed)
    batch = compile_rules(RuleSet.from_rules(spark, rules), wide, as_of=AS_OF)
    assert len(batch.compiled) > 70
    index = build_index(wide, batch.compiled)
    assert index.places and index.conjunctions and index.compiled
    # one pass for the expected answer: every predicate as it was compiled
    truth = {r["k"]: list(r["hit"]) for r in wide.select(
        "k", F.array(*[F.coalesce(p.column, F.lit(False)) for _, p in batch.compiled]).alias("hit")).collect()}
    ids = batch.rule_ids
    expect = sorted((k, rid) for k, hit in truth.items() for rid, h in zip(ids, hit) if h)
    assert sorted(tuple(r) for r in index_hits(wide, index, ["k"]).collect()) == expect
    counts = {r["rule_id"]: r["hits"] for r in index_hit_counts(wide, index).collect()}
    assert counts == {rid: sum(hit[i] for hit in truth.values()) for i, rid in enumerate(ids)}
    first = {r["k"]: r["rule_id"] for r in first_hits(wide, index, ["k"]).collect()}
    assert first == {k: next((rid for rid, h in zip(ids, hit) if h), None) for k, hit in truth.items()}


def test_empty_table_counts_zero(spark, wide):
    batch = compile_rules(RuleSet.from_rules(spark, _random_rules(5, 3)), wide, as_of=AS_OF)
    assert {r["hits"] for r in rule_hit_counts(wide.where("false"), batch).collect()} == {0}


def test_plan_is_one_scan_without_join(spark, wide):
    batch = compile_rules(RuleSet.from_rules(spark, _random_rules(40, 4)), wide, as_of=AS_OF)
    index = build_index(wide, batch.compiled)
    for df in (index_hits(wide, index, ["k"]), first_hits(wide, index, ["k"])):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Exchange" not in plan.split("InMemoryTableScan")[0]


def test_a_guarded_expression_is_not_evaluated_for_every_row(spark, wide):
    """``x / i`` fails for i = 0 under ANSI; the rule's first condition keeps such rows away from it."""
    rules = RuleSet.from_rules(spark, [rule("guard", [cond("i", ">", "0", "AND"), cond("10 div i", ">=", "5")]),
                                       rule("plain", [cond("i", ">=", "0")])])
    batch = compile_rules(rules, wide, as_of=AS_OF)
    index = build_index(wide, batch.compiled)
    assert list(index.compiled) == [0]
    got = {r["rule_id"]: r["hits"] for r in index_hit_counts(wide, index).collect()}
    assert got == {"guard": wide.where("i > 0 and 10 div i >= 5").count(), "plain": wide.where("i >= 0").count()}


def test_versions_meet_rows_by_their_own_date(spark, wide):
    rules = RuleSet.from_rules(spark, [
        rule(f"v{k}", [cond("i", ">=", str(k % 3))], valid_from=f"0{1 + k}/01/2020", valid_till=f"0{1 + k}/01/2020") for k in range(3)])
    batch = compile_rules(rules, wide, [f"v{k}" for k in range(3)], as_of="d")
    got = {r["rule_id"]: r["hits"] for r in index_hit_counts(wide, build_index(wide, batch.compiled)).collect()}
    assert got == {f"v{k}": wide.where(f"i >= {k % 3} and d = date'2020-01-0{1 + k}'").count() for k in range(3)}


def test_rules_beyond_one_word(spark, wide):
    rules = [rule(f"w{k}", [cond("i", ">=", str(k % 5 - 1), "AND"), cond("s", ">", "a" if k % 2 else "b")]) for k in range(130)]
    batch = compile_rules(RuleSet.from_rules(spark, rules), wide, as_of=AS_OF)
    index = build_index(wide, batch.compiled)
    assert len(index.conjunctions) == 130
    counts = {r["rule_id"]: r["hits"] for r in index_hit_counts(wide, index).collect()}
    for k in (0, 59, 60, 61, 119, 120, 129):
        assert counts[f"w{k}"] == wide.where(f"i >= {k % 5 - 1} and s > '{'a' if k % 2 else 'b'}'").count()


def _stored(rid, text):
    return rule(rid, [{"lookup_value": text}], process="filtration", process_key="query_lookup")


def test_stored_queries_share_the_scan(spark, wide):
    rules = RuleSet.from_rules(spark, [
        _stored("in_list", " where s in ('a', 'select', 'b') and i >= 0 -- a note"), rule("built", [cond("i", ">=", "1")]),
        _stored("grouped", "where i > 0 group by i"), _stored("ordered", "where i > 0 order by i"),
        _stored("sub", "where i in (select 1)"), _stored("agg", "where max(i) > 0"), _stored("no_where", "order by i"),
        _stored("closed", "where i > 0) or (i = 0"), _stored("off", "where i > 100000000000000")])
    batch = compile_rules(rules, wide, as_of=AS_OF, stored=True)
    assert batch.rule_ids == ["in_list", "built", "off"]
    assert set(batch.rejected) == {"grouped", "ordered", "sub", "agg", "no_where", "closed"}
    got = sorted(tuple(r) for r in index_hits(wide, build_index(wide, batch.compiled), ["k"]).collect())
    expect = sorted([(r["k"], "in_list") for r in wide.where("s in ('a', 'select', 'b') and i >= 0").collect()]
                    + [(r["k"], "built") for r in wide.where("i >= 1").collect()])
    assert got == expect
    assert compile_rules(rules, wide, as_of=AS_OF).rule_ids == ["built"]
    with pytest.raises(RuleConfigError):
        compile_rules(rules, wide, ["in_list", "grouped"], as_of=AS_OF)
