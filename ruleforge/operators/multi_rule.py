"""Many rules in one scan.

The original engine answers one rule per call, so N rules cost N passes
over the data. Here every rule is compiled to a predicate against the same
schema and evaluated in a single projection:

* ``rule_hits``   -- long form, one row per (row, rule that fired). The rules
  are cut into slices of ``SLICE``; a row explodes the slices, each slice
  explodes its rules, and the rules that did not fire (nulls) are filtered
  out. Scan, both explodes and the filter share one codegen'd stage, and no
  slice's code grows with the number of rules. No shuffle.
* ``rule_hit_counts`` -- per-rule counts from one scan through the predicate
  index (``rule_index``): equal operands are evaluated once per row.
* ``rule_flags``  -- one boolean column per rule, rows kept.
* ``rule_hit_lists`` -- one array column of the rules a row satisfies.
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass, field
from itertools import accumulate
from typing import Sequence

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import RuleConfigError
from ..functions.predicates import CompiledPredicate, operand_type_map
from ..plans import resolution as R
from ..sources.ruleset import RuleSet
from .evaluate import compile_rule, gate_conditions, in_window
from .rule_index import build_index, index_hit_counts


@dataclass
class RuleBatch:
    compiled: list[tuple[str, CompiledPredicate]] = field(default_factory=list)
    rejected: dict[str, str] = field(default_factory=dict)

    @property
    def rule_ids(self) -> list[str]:
        return [rid for rid, _ in self.compiled]


def predicate_rule_ids(rules: RuleSet, stored: bool = False) -> list[str]:
    """Ids whose first rule with conditions (the one ``resolve_by_id`` would
    pick) is a builder or conditional rule, or with ``stored`` a query lookup;
    document order, unique."""
    first: dict[str, str] = {}
    for r in rules.rules():
        if r.conditions:
            first.setdefault(r.id, r.process_key)
    wanted = ("query_builder", "conditional") + (("query_lookup",) if stored else ())
    return [rid for rid, key in first.items() if key in wanted]


_SQL_TEXT_OR_COMMENT = re.compile(r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`(?:[^`]|``)*`|--[^\n]*|/\*.*?\*/", re.DOTALL)


def stored_predicate(rule) -> CompiledPredicate:
    """A stored query tail that only filters, as a predicate. Tails that group, order, limit, join or
    read another table are no predicate of a row and raise RuleConfigError."""
    tail = ((rule.conditions[0].lookup_value if rule.conditions else None) or "").strip()
    start = re.match(r"where\b", tail, re.IGNORECASE)
    if not start:
        raise RuleConfigError(f"Rule {rule.id}: the stored query does not begin with where")
    text = tail[start.end():].strip()
    bare = _SQL_TEXT_OR_COMMENT.sub(" ", text)
    if re.search(r"\bselect\b", bare, re.IGNORECASE):
        raise RuleConfigError(f"Rule {rule.id}: the stored filter holds a subquery")
    depths = list(accumulate((c == "(") - (c == ")") for c in bare))
    if depths and (min(depths) < 0 or depths[-1]):
        raise RuleConfigError(f"Rule {rule.id}: the stored filter's parentheses do not match")
    executed = f"({text}\n)" if "--" in text else f"({text})"
    try:
        F.expr(text)  # alone: 'a = 1 order by b' is no expression
        column = F.expr(executed)
    except ParseException:
        raise RuleConfigError(f"Rule {rule.id}: the stored query does more than filter rows") from None
    return CompiledPredicate(column, " " + tail, (rule.id,), executed)


def compile_rules(rules: RuleSet, df: DataFrame, rule_ids: Sequence[str] | None = None, *,
                  as_of: dt.date | str | None = None, gate: bool = False,
                  strict: bool | None = None, stored: bool = False) -> RuleBatch:
    """Compile each rule (with its goto chain) against ``df``'s schema.

    Stored query rules take part when they are named, or with ``stored`` when
    the whole document is evaluated; their text must be a filter of the row.

    ``as_of`` may name a date or timestamp column, as in ``run_rule``: each
    rule then fires only for rows whose own date lies in its window.

    Rejected rules are listed in ``rejected``. ``strict`` (default: on when
    ``rule_ids`` are named, off when evaluating every predicate rule of the
    document) makes any rejection raise, so a report on named rules never
    silently misses one.
    """
    if strict is None:
        strict = rule_ids is not None
    row_date = as_of if isinstance(as_of, str) else None
    batch = RuleBatch()
    resolved = []
    for rid in (rule_ids if rule_ids is not None else predicate_rule_ids(rules, stored)):
        res = R.resolve_by_id(rules, rid, R.ANY_DAY if row_date else as_of)
        if res.rule is not None and res.rule.process_key == "query_lookup" and res.valid_params:
            res = R.resolve(rules, res.rule.process, "query_lookup", rid, True, R.ANY_DAY if row_date else as_of)
            if res.accepted:
                resolved.append((rid, res))
                continue
        if not res.accepted or not res.links:
            batch.rejected[rid] = res.message or f"Rule {rid} has nothing to evaluate"
            continue
        resolved.append((rid, res))
    # type every operand of every rule (gates included) with one analysis of the plan
    operands = [c.field_name for _, res in resolved for link in res.links for c in link.conditions]
    if gate:
        for _, res in resolved:
            if res.rule.process_key == "conditional":
                try:
                    operands += [c.field_name for c in gate_conditions(res.rule)]
                except RuleConfigError:
                    pass
    types = operand_type_map(df, operands + ([row_date] if row_date else []))
    for rid, res in resolved:
        try:
            compiled = compile_rule(df, res, gate=gate, known_types=types) if res.links else stored_predicate(res.rule)
            batch.compiled.append((rid, in_window(compiled, res.links or (res.rule,), row_date, types.get(row_date)) if row_date else compiled))
        except RuleConfigError as e:
            batch.rejected[rid] = str(e)
    _drop_unusable(df, batch)
    if strict and batch.rejected:
        raise RuleConfigError("; ".join(f"{k}: {v}" for k, v in batch.rejected.items()))
    return batch


def _drop_unusable(df: DataFrame, batch: RuleBatch) -> None:
    """Move predicates Spark cannot filter on (aggregate, window or generator
    operands) to ``rejected``: one analysis for the whole batch, and only if
    that fails one per rule."""
    if not batch.compiled:
        return
    try:  # a flat array, not a deep OR chain: thousands of rules stay shallow
        df.where(F.array_contains(F.array(*[p.column for _, p in batch.compiled]), True)).schema
        return
    except (AnalysisException, ParseException):  # find the culprits one by one
        pass
    keep = []
    for rid, p in batch.compiled:
        try:
            df.where(p.column).schema
            keep.append((rid, p))
        except (AnalysisException, ParseException) as e:
            batch.rejected[rid] = f"Rule {rid}: {str(e).splitlines()[0]}"
    batch.compiled = keep


def spread_input(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Opt-in: deal the rows of a batch input round-robin over ``partitions``
    tasks (default: the default parallelism). Worth it when a small input
    with a few large row groups meets hundreds of rules; a cluster-sized table
    already scans into thousands of splits: leave it off there.
    """
    if df.isStreaming:
        return df
    return df.repartition(partitions or df.sparkSession.sparkContext.defaultParallelism)


SLICE = 16  # rules per inner array: the size of one piece of generated code


def _labels(batch: RuleBatch) -> Column:
    return F.array_compact(F.array(*[F.when(p.column, F.lit(rid)) for rid, p in batch.compiled]))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def rule_hits(df: DataFrame, batch: RuleBatch, keys: Sequence[str], *, spread: bool = False) -> DataFrame:
    """``keys + [rule_id]``, one row per rule a row satisfies (duplicates kept).
    ``spread`` applies ``spread_input`` first."""
    if not batch.compiled:
        raise RuleConfigError("no rules to evaluate")
    df = spread_input(df) if spread else df
    whens = [F.when(p.column, F.lit(rid)) for rid, p in batch.compiled]
    slices = F.array(*[F.array(*whens[i:i + SLICE]) for i in range(0, len(whens), SLICE)])
    cut = df.select(*keys, F.explode(slices).alias("__slice"))
    return (cut.select(*[F.col(_quoted(c)) for c in cut.columns[:-1]], F.explode("__slice").alias("rule_id"))
            .where(F.col("rule_id").isNotNull()))


def rule_hit_counts(df: DataFrame, batch: RuleBatch) -> DataFrame:
    """``(rule_id, hits)`` for every compiled rule, zero counts included, from one scan through the predicate index."""
    return index_hit_counts(df, build_index(df, batch.compiled))


def rule_hit_lists(df: DataFrame, batch: RuleBatch, name: str = "hit_rules", *,
                   spread: bool = False) -> DataFrame:
    """All rows, plus one ``array<string>`` column of the rules each row
    satisfies (document order). One field however many rules there are, so
    the projection stays within whole-stage codegen where ``rule_flags``
    (one column per rule) would not."""
    if not batch.compiled:
        raise RuleConfigError("no rules to evaluate")
    return (spread_input(df) if spread else df).withColumn(name, _labels(batch))


def rule_flags(df: DataFrame, batch: RuleBatch, prefix: str = "hit_") -> DataFrame:
    """All rows, plus a boolean ``<prefix><rule_id>`` column per rule
    (null-safe: a predicate that is unknown for a row counts as false)."""
    return df.select("*", *[F.coalesce(p.column, F.lit(False)).alias(prefix + rid)
                            for rid, p in batch.compiled])
