"""Large sets of simple threshold rules, evaluated by position instead of one by one.

When a document holds hundreds or thousands of single-condition rules
(``field >= threshold``), testing each on each row is wasted work. The
thresholds of a field, sorted, cut the number line into intervals, and a
value's place among them (a binary search over one constant array) already
says which rules fire:

* ``x >= t`` and ``x > t`` rules: a prefix of the rules sorted by threshold;
* ``x < t`` and ``x <= t`` rules: a suffix;
* ``x = t`` rules: the run of equal thresholds; ``x != t``: the rest.

``rules_as_data_hits`` explodes those slices, so its work grows with the hits
and not with rows x rules; ``threshold_hit_counts`` only needs a histogram of
the places. Both are one scan for any number of rules, without a join of the
data and without a shuffle of rows.
"""

from __future__ import annotations

import datetime as dt
import math
import struct
from dataclasses import dataclass, field
from decimal import Decimal
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import RuleConfigError
from ..functions.predicates import Atom, CompiledPredicate, parse_number
from ..plans import resolution as R
from ..sources.ruleset import RuleSet
from .multi_rule import predicate_rule_ids, spread_input
from .rule_index import build_index, index_hit_counts

# Comparison operators a threshold rule may use.
THRESHOLD_OPS = (">=", ">", "<=", "<", "=", "==", "!=", "<>")

# Columns whose values convert to double exactly: places are found in double. bigint and decimal rules, and rules of several
# conditions, go through the predicate index (rule_index), which compares in the column's own type.
_EXACT_AS_DOUBLE = (T.ByteType, T.ShortType, T.IntegerType, T.FloatType, T.DoubleType)

@dataclass(frozen=True)
class ThresholdRule:
    rule_id: str
    field: str
    op: str
    threshold: float


@dataclass
class ThresholdSet:
    rules: list[ThresholdRule] = field(default_factory=list)
    rejected: dict[str, str] = field(default_factory=dict)


def threshold_rules(rules: RuleSet, df: DataFrame, rule_ids: Sequence[str] | None = None, *,
                    as_of: dt.date | None = None, strict: bool | None = None) -> ThresholdSet:
    """Pick the rules that are one numeric comparison on a column of ``df``.

    ``strict`` (default: on when ``rule_ids`` are named) raises on any rule
    that does not qualify; otherwise such rules are listed in ``rejected``.
    """
    if strict is None:
        strict = rule_ids is not None
    types = {f.name: f.dataType for f in df.schema.fields}
    case_sensitive = df.sparkSession.conf.get("spark.sql.caseSensitive", "false").lower() == "true"
    by_lower = {} if case_sensitive else {f.name.lower(): f.name for f in df.schema.fields}
    out = ThresholdSet()
    for rid in (rule_ids if rule_ids is not None else predicate_rule_ids(rules)):
        res = R.resolve_by_id(rules, rid, as_of)
        if not res.accepted or not res.links:
            out.rejected[rid] = res.message or f"Rule {rid} has nothing to evaluate"
            continue
        conds = [c for link in res.links for c in link.conditions]
        if res.rule.process_key != "query_builder" or len(conds) != 1:
            out.rejected[rid] = f"Rule {rid} is not a single threshold condition"
            continue
        c = conds[0]
        field = c.field_name if c.field_name in types else by_lower.get(c.field_name.lower())
        if field is None or not isinstance(types[field], _EXACT_AS_DOUBLE):
            out.rejected[rid] = (f"Rule {rid}: {c.field_name!r} is not an int/float/double column "
                                 "(evaluate it with multi_rule instead)")
            continue
        if c.operator not in THRESHOLD_OPS:
            out.rejected[rid] = f"Rule {rid}: operator {c.operator!r} is not a threshold comparison"
            continue
        value = parse_number(c.field_value)
        if value is None or not math.isfinite(float(value)):
            out.rejected[rid] = f"Rule {rid}: value {c.field_value!r} is not a finite number"
            continue
        exact = _as_double_threshold(types[field], c.operator, value)
        if exact is None:
            out.rejected[rid] = (f"Rule {rid}: {c.operator} {c.field_value} has no exact double form "
                                 f"on a {types[field].simpleString()} column "
                                 "(evaluate it with multi_rule instead)")
            continue
        out.rules.append(ThresholdRule(rid, field, exact[0], exact[1]))
    if strict and out.rejected:
        raise RuleConfigError("; ".join(f"{k}: {v}" for k, v in out.rejected.items()))
    return out


def _column(name: str) -> Column:
    """A top-level column by its exact name (dots are part of the name)."""
    return F.col("`" + name.replace("`", "``") + "`")


def _as_double_threshold(dtype: T.DataType, op: str, value: Decimal) -> tuple[str, float] | None:
    """(operator, threshold) that gives, on the double-cast column, exactly the
    answer the compiled rule gives in the column's own type; None if none does.

    Integer columns: a fractional threshold becomes the equivalent integer
    bound (``x >= 2.5`` -> ``x >= 3``). Float columns: the threshold is rounded
    to float precision first, as the compiled float comparison does.
    """
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType)):
        if value == value.to_integral_value():
            return op, float(value)
        lo = math.floor(value)
        bounds = {">=": (">=", lo + 1), ">": (">=", lo + 1), "<=": ("<=", lo), "<": ("<=", lo)}
        if op not in bounds:
            return None  # = / != a fraction: constant over integers; leave to the compiled path
        new_op, bound = bounds[op]
        return new_op, float(bound)
    if isinstance(dtype, T.FloatType):
        try:
            rounded = struct.unpack("f", struct.pack("f", float(value)))[0]
        except OverflowError:
            return None
        # beyond float range the threshold would become infinite: leave it to the compiled path
        return (op, rounded) if math.isfinite(rounded) else None
    return op, float(value)


def _constants(values: Sequence[str], dtype: str) -> Column:
    """A constant array as one literal, however many values it has."""
    return F.split(F.lit("\x1f".join(values)), "\x1f").cast(f"array<{dtype}>")


def _cuts(op: str, t: float) -> tuple[float, ...]:
    """The boundaries a rule asks about: the smallest double that satisfies ``x >= cut``."""
    up = math.nextafter(t, math.inf)
    if op in (">=", "<"):
        return (t,)
    if op in (">", "<="):
        return (up,)
    return (t, up)  # = / == / != / <>


def _places(df: DataFrame, keep: Sequence[Column], searches: Sequence[tuple[str, Sequence[float]]]) -> DataFrame:
    """``keep`` plus ``__p0, __p1, ...``: for search (field, sorted cuts), how many cuts are <= the field's value
    (null for null; NaN, the largest value in Spark's ordering, is above all cuts).

    A binary search as ``ceil(log2(m))`` projections; each reads the previous place twice, so Catalyst keeps the
    projections apart and the generated code stays small however many thresholds a field has.
    """
    fields = list(dict.fromkeys(f for f, _ in searches))
    value = {f: F.col(f"__v{i}") for i, f in enumerate(fields)}
    depth = [max(1, math.ceil(math.log2(len(cuts) + 1))) for _, cuts in searches]
    arrays = [_constants([repr(c) for c in cuts] + ["Infinity"] * (2 ** d - len(cuts)), "double")
              for (_, cuts), d in zip(searches, depth)]
    kept = [f"__k{i}" for i in range(len(keep))]
    cur = df.select(*[c.alias(n) for c, n in zip(keep, kept)],
                    *[_column(f).cast("double").alias(f"__v{i}") for i, f in enumerate(fields)],
                    *[F.lit(0).alias(f"__p{i}") for i in range(len(searches))])
    for level in range(max(depth)):
        steps = []
        for i, (f, _) in enumerate(searches):
            p = F.col(f"__p{i}")
            if level < depth[i]:
                step = 2 ** (depth[i] - 1 - level)
                p = F.when(F.element_at(arrays[i], p + step) <= value[f], p + step).otherwise(p)
            steps.append(p.alias(f"__p{i}"))
        cur = cur.select(*kept, *value.values(), *steps)
    return cur.select(*kept, *[
        F.when(value[f].isNotNull(), F.least(F.col(f"__p{i}"), F.lit(len(cuts)))).alias(f"__p{i}")
        for i, (f, cuts) in enumerate(searches)])


def _by_kind(rule_list: Sequence[ThresholdRule]) -> dict[tuple[str, str], list[ThresholdRule]]:
    """Rules by (field, kind), each list sorted by its first cut."""
    kinds = {">=": "from", ">": "from", "<": "below", "<=": "below", "=": "at", "==": "at", "!=": "off", "<>": "off"}
    groups: dict[tuple[str, str], list[ThresholdRule]] = {}
    for r in rule_list:
        groups.setdefault((r.field, kinds[r.op]), []).append(r)
    return {k: sorted(rs, key=lambda r: _cuts(r.op, r.threshold)[0]) for k, rs in sorted(groups.items())}


def rules_as_data_hits(df: DataFrame, thresholds: ThresholdSet | Sequence[ThresholdRule],
                       keys: Sequence[str], *, spread: bool = False) -> DataFrame:
    """``keys + [rule_id]`` for every (row, threshold rule) that fires
    (``spread`` applies ``spread_input`` first)."""
    rule_list = list(thresholds.rules if isinstance(thresholds, ThresholdSet) else thresholds)
    if not rule_list:
        raise RuleConfigError("no threshold rules to evaluate")
    searches: list[tuple[str, list[float]]] = []
    runs: list[Column] = []
    order = {id(r): i for i, r in enumerate(rule_list)}
    for (field, kind), rs in _by_kind(rule_list).items():
        names = _constants([str(i) for i in (order[id(r)] for r in rs)], "int")
        place = []
        for k in range(2 if kind in ("at", "off") else 1):
            place.append(F.col(f"__p{len(searches)}"))
            searches.append((field, [_cuts(r.op, r.threshold)[k] for r in rs]))
        n = len(rs)
        if kind == "from":
            runs.append(F.slice(names, 1, place[0]))
        elif kind == "below":
            runs.append(F.slice(names, place[0] + 1, n - place[0]))
        elif kind == "at":  # thresholds <= x but not < x
            runs.append(F.slice(names, place[1] + 1, place[0] - place[1]))
        else:
            runs.append(F.slice(names, 1, place[1]))
            runs.append(F.slice(names, place[0] + 1, n - place[0]))
    source = spread_input(df) if spread else df
    columns = source.select(*keys)
    placed = _places(source, [_column(c) for c in columns.columns], searches)
    empty = F.array().cast("array<int>")
    hits = placed.select(*[F.col(f"__k{i}").alias(c) for i, c in enumerate(columns.columns)],
                         F.explode(F.concat(*[F.coalesce(r, empty) for r in runs])).alias("__rule"))
    ids = _constants([r.rule_id for r in rule_list], "string")
    return hits.select(*[_column(c) for c in columns.columns],
                       F.element_at(ids, F.col("__rule") + 1).alias("rule_id"))


def threshold_hit_counts(df: DataFrame, thresholds: ThresholdSet | Sequence[ThresholdRule]) -> DataFrame:
    """``(rule_id, hits)`` for threshold rules, exact, one scan, without per-rule work per row: each field's places
    are counted (map-side combined, at most 2R+1 groups per field) and only the counted places meet the rules."""
    rule_list = list(thresholds.rules if isinstance(thresholds, ThresholdSet) else thresholds)
    if not rule_list:
        raise RuleConfigError("no threshold rules to evaluate")
    types = {f.name: f.dataType for f in df.schema.fields}
    compiled = []
    for r in rule_list:
        column = _column(r.field)
        atom = Atom("`" + r.field.replace("`", "``") + "`", types[r.field], r.op, repr(r.threshold))
        compiled.append((r.rule_id, CompiledPredicate(column, "", (r.rule_id,), dnf=((atom,),))))
    return index_hit_counts(df, build_index(df, compiled))
