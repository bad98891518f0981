"""Evaluate one rule against a table: the library's main entry point.

``run_rule`` answers a rule call with a ``RuleResult`` -- the same five facts
the original engine returned (parameters matched, rule valid, message, query
text or looked-up value, output DataFrame) plus the compiled predicate. The
output is a lazy DataFrame: nothing runs until the caller acts on it, so
chained stages collapse into one scan with merged filters.
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass, field
from typing import Any, Mapping, Sequence

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import RuleConfigError
from ..functions.json_lookup import parse_lookup_text
from ..functions.predicates import Atom, CompiledPredicate, chain_text, compile_chain, sql_string, typed_value
from ..plans import resolution as R
from ..sources.ruleset import Condition, Rule, RuleSet


@dataclass
class RuleResult:
    valid_params: bool
    rule_validity: bool
    message: str
    query: str = ""
    value: Any = None
    df: DataFrame | None = None
    predicate: Column | None = None
    rule_ids: tuple[str, ...] = field(default_factory=tuple)
    has_value: bool = False  # a looked-up value (possibly None) rather than query text
    applied_as: str | None = None  # "filter" / "flag" for builder and conditional results
    executed: str = ""  # the typed SQL that ran; ``query`` keeps the rule language's spelling

    @property
    def ok(self) -> bool:
        """Parameters matched and the rule produced its result."""
        return self.valid_params is True and bool(self.rule_validity)

    def as_tuple(self):
        """``(valid_params, rule_validity, message, query_or_value, df)``."""
        out = self.value if self.has_value else self.query
        return (self.valid_params, self.rule_validity, self.message, out, self.df)


def _escape_braces(sql: str) -> str:
    """Stored SQL is formatted by ``spark.sql(..., t=df)``: keep braces literal."""
    return sql.replace("{", "{{").replace("}", "}}")


def _reject(message: str, rule: Rule | None = None) -> RuleResult:
    return RuleResult(True, False, message, rule_ids=(rule.id,) if rule else ())


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _existing_column(df: DataFrame, name: str) -> str | None:
    """The column ``withColumn(name, ...)`` would replace, if any (Spark
    matches names case-insensitively unless spark.sql.caseSensitive)."""
    if df.sparkSession.conf.get("spark.sql.caseSensitive", "false").lower() == "true":
        return name if name in df.columns else None
    return next((c for c in df.columns if c.lower() == name.lower()), None)


def _projection_text(df: DataFrame, target: str, expr_text: str) -> str:
    """Select list of ``df`` with ``target`` replaced by (or appended as) an expression."""
    existing = _existing_column(df, target)
    cols = [f"{expr_text} as {_quote(target)}" if c == existing else _quote(c) for c in df.columns]
    if existing is None:
        cols.append(f"{expr_text} as {_quote(target)}")
    return ", ".join(cols)


def _first_lookup(rule: Rule) -> str | None:
    return rule.conditions[0].lookup_value if rule.conditions else None


def _with_table(text: str, table_name: str | None) -> str:
    if table_name and table_name.strip():
        return " select * from {} ".format(table_name) + text
    return text


def grouping_keys(spark, tail: str) -> str | None:
    """The keys of the top-level ``group by`` in a stored
    ``[where ...] group by <keys> [having ...] [order by ...]`` tail, as
    Spark's parser reads them (None when there is no such clause)."""
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan("select 1 from t\n" + tail)
    while plan.nodeName() != "Aggregate":
        if plan.children().size() != 1:
            return None
        plan = plan.children().head()
    keys = plan.groupingExpressions()
    found = [keys.apply(i) for i in range(keys.size())]
    if any(k.nodeName() in ("GroupingSets", "Cube") or k.nodeName() == "Rollup"
           and not re.search(r"with\s+rollup", tail, re.IGNORECASE) for k in found):
        raise RuleConfigError("grouping sets / rollup() / cube() lookups are not supported; "
                              "use 'group by <keys> with rollup' or plain keys")
    if len(found) == 1 and found[0].nodeName() == "Rollup":
        inner = found[0].children()
        found = [inner.apply(i) for i in range(inner.size())]
    return ", ".join(str(k.ordinal()) if k.nodeName() == "UnresolvedOrdinal" else k.sql() for k in found) or None


def gate_conditions(rule: Rule) -> list[Condition]:
    """A conditional rule's lookup object as equality conditions (AND)."""
    try:
        obj = parse_lookup_text(_first_lookup(rule))
    except ValueError:
        raise RuleConfigError(f"Rule {rule.id}: lookup_value is not JSON") from None
    if not isinstance(obj, dict) or not obj:
        raise RuleConfigError(f"Rule {rule.id}: gate needs a non-empty JSON object")
    conds = []
    for i, (k, v) in enumerate(obj.items()):
        if v is None or isinstance(v, (dict, list)):
            raise RuleConfigError(f"Rule {rule.id}: gate value for {k!r} must be a scalar")
        text = v if isinstance(v, str) else ("true" if v is True else "false" if v is False else str(v))
        conds.append(Condition(pos=i, field_name=k, operator="=", field_value=text,
                               join="AND", lookup_value=None))
    return conds


def compile_rule(df: DataFrame, res: R.Resolution, gate: bool = False,
                 group_links: bool = False, known_types=None) -> CompiledPredicate:
    conditional = res.rule.process_key == "conditional"
    extra = gate_conditions(res.rule) if gate and conditional else ()
    return compile_chain(df, res.links, group_links=group_links, extra=extra,
                         first_is_target=conditional, known_types=known_types)


def in_window(compiled: CompiledPredicate, links: Sequence[Rule], row_date: str, date_type=None) -> CompiledPredicate:
    """The predicate, for rows whose date lies in the window of every rule of the chain."""
    window = " and ".join(R.window_sql(r, row_date) for r in links)
    executed = f"({compiled.executed}) and {window}"
    dnf = None
    if compiled.dnf is not None and date_type is not None:
        bounds = tuple(Atom(row_date, date_type, op, day) for r in links for op, day in R.window_bounds(r))
        dnf = tuple(bounds + conj for conj in compiled.dnf)
    return CompiledPredicate(F.expr(executed), _in_window(compiled.where_text, window), compiled.rule_ids, executed, dnf)


def run_rule(rules: RuleSet, table: DataFrame | str | None, *, rule_id: str, process: str,
             process_key: str, is_lookup=None, value_key: str | None = None,
             as_of: dt.date | str | None = None, apply: bool = True, table_name: str | None = None,
             mode: str = "filter", aggregates: Mapping[str, str] | None = None,
             gate: bool = False, group_links: bool = False,
             order_by: Sequence[str] | None = None, columns: Sequence[str] | None = None) -> RuleResult:
    """Evaluate one rule.

    ``table`` is a DataFrame (batch or streaming) or a table/view name;
    ``table_name`` only names it in the query text. ``is_lookup`` defaults to
    what the process key implies. ``mode="flag"`` keeps every row and writes
    the rule's outcome column instead of filtering. ``aggregates`` (alias ->
    SQL expression) are computed per group for ``groupby_lookup`` rules.

    ``as_of`` is the day the validity windows are tested against (default:
    today), or the name of a date or timestamp column (any SQL expression):
    then every rule of the chain applies only to rows whose own date lies in
    its window. ``columns`` projects the output before it is ordered, so an
    ordered result reads, shuffles and sorts no other column.
    """
    if mode not in ("filter", "flag"):
        raise ValueError(f"mode must be 'filter' or 'flag', not {mode!r}")
    table_name = table_name.strip() if table_name and table_name.strip() else None
    if is_lookup is None:
        is_lookup = process_key.strip() in R.LOOKUP_KEYS
    row_date = as_of if isinstance(as_of, str) else None
    res = R.resolve(rules, process, process_key, rule_id, is_lookup, R.ANY_DAY if row_date else as_of)
    if not res.accepted:
        return RuleResult(res.valid_params, res.rule_validity, res.message,
                          rule_ids=(res.rule.id,) if res.rule else ())
    rule = res.rule
    key = rule.process_key
    if key == "conditional" and not res.links:  # answered from the rule alone
        return RuleResult(False, True, R.MSG_CONDITIONAL_BAD, value=(_first_lookup(rule) or "").strip(),
                          has_value=True, rule_ids=(rule.id,))
    df = table if not isinstance(table, str) else None
    if isinstance(table, str):
        table_name = table_name or table
        if key != "value_lookup":  # value lookups never read the table
            try:
                df = rules.spark.table(table)
            except AnalysisException as e:
                return _reject(f"Rule {rule.id}: {str(e).splitlines()[0]}", rule)
    spark = df.sparkSession if df is not None else rules.spark  # the data's own session
    window = " and ".join(R.window_sql(r, row_date) for r in (res.links or (rule,))) if row_date else None
    shape = _Shape(table_name, order_by, columns)
    try:
        if key == "value_lookup":
            if row_date:
                raise RuleConfigError(f"Rule {rule.id}: a value lookup reads no rows to date")
            return _value_lookup(rule, value_key)
        if window and key in ("query_lookup", "groupby_lookup"):  # the stored text sees only rows in the window
            df = df.where(F.expr(window)) if df is not None else None
            shape = _Shape(f"(select * from {table_name} where {window})" if table_name else None, order_by, columns)
        if key == "query_lookup":
            return _query_lookup(spark, df, rule, apply, shape)
        if key == "groupby_lookup":
            return _groupby_lookup(spark, df, rule, apply, aggregates, shape)
        if key == "transformation":
            return _transformation(df, rule, apply, shape, window)
        if df is None:  # no table: hand back the text only (nothing to type literals against)
            conditional = key == "conditional"
            extra = gate_conditions(rule) if gate and conditional else ()
            where = chain_text(res.links, group_links, extra, first_is_target=conditional)
            text = _builder_text(_in_window(where, window), res, None, mode, shape)
            return RuleResult(True, True, res.message, query=text,
                              rule_ids=tuple(r.id for r in res.links))
        compiled = compile_rule(df, res, gate=gate, group_links=group_links)
        if window:
            compiled = in_window(compiled, res.links, row_date)
        query, executed, out = _apply(df, res, compiled, apply, mode, shape)
    except RuleConfigError as e:
        return _reject(str(e), rule)
    except (AnalysisException, ParseException) as e:
        # includes an aggregate / window / generator operand: a rule error, not a crash later
        return _reject(f"Rule {rule.id}: {str(e).splitlines()[0]}", rule)
    return RuleResult(True, True, res.message, query=query, df=out, predicate=compiled.column,
                      rule_ids=compiled.rule_ids, applied_as=mode, executed=executed)


@dataclass(frozen=True)
class _Shape:
    """How a result is named, projected and ordered."""
    table_name: str | None
    order_by: Sequence[str] | None = None
    columns: Sequence[str] | None = None

    @property
    def select_list(self) -> str:
        return ", ".join(self.columns) if self.columns else "*"

    def finish(self, df: DataFrame) -> DataFrame:
        if self.order_by:
            return ordered(df, self.order_by, self.columns)
        return df.selectExpr(*self.columns) if self.columns else df

    def wrap(self, query: str) -> str:
        """A full statement, projected and ordered as a subquery (it may end in its own limit / comment)."""
        if not self.order_by and not self.columns:
            return query
        order = " order by " + ", ".join(self.order_by) if self.order_by else ""
        if self.table_name:
            return f" select {self.select_list} from ({query.strip()}\n){order}"
        return query + "\n" + order


def _in_window(where_text: str, window: str | None) -> str:
    return f" where ({where_text.strip()[len('where'):].strip()}) and {window}" if window else where_text


def _outcome(res: R.Resolution) -> Rule:
    last = res.links[-1]
    if not last.then_field or last.is_goto:
        raise RuleConfigError(f"Rule {last.id} has no outcome column to flag")
    return last


def _builder_text(where: str, res: R.Resolution, df: DataFrame | None, mode: str, shape: _Shape,
                  typed: bool = False) -> str:
    """Query text of a builder / conditional rule, the same with or without
    a table and whether or not it is applied. ``typed`` writes the outcome
    as the literal that runs instead of as text."""
    table_name = shape.table_name
    if mode == "flag":
        last = _outcome(res)
        existing = _existing_column(df, last.then_field) if df is not None else None
        value_text = "'" + last.then_value.replace("'", "''") + "'"
        if typed:
            value_text = (typed_value(last.then_value, df.schema[existing].dataType, existing)
                          if existing is not None else sql_string(last.then_value))
        pred_text = where[len(" where"):].strip()
        if existing is not None:  # keep what earlier rules wrote
            flag_text = f"case when {pred_text} then {value_text} else {_quote(existing)} end"
        else:
            flag_text = f"case when {pred_text} then {value_text} end"
        if not table_name:
            text = " " + flag_text
        elif df is not None:
            text = " select {} from {} ".format(_projection_text(df, last.then_field, flag_text), table_name)
            return shape.wrap(text) if shape.columns else text + _order_text(shape)
        else:
            text = " select *, {} as {} from {} ".format(flag_text, _quote(last.then_field), table_name)
    else:
        text = " select {} from {} ".format(shape.select_list, table_name) + where if table_name else where
    return text + _order_text(shape)


def _order_text(shape: _Shape) -> str:
    return " order by " + ", ".join(shape.order_by) if shape.order_by else ""


def _apply(df, res, compiled, apply, mode, shape):
    """The rule's query text, the typed SQL that runs, and its output DataFrame (analysed, when applied)."""
    query = _builder_text(compiled.where_text, res, df, mode, shape)
    executed = _builder_text(" where " + compiled.executed, res, df, mode, shape, typed=True)
    out = None
    if mode == "flag":
        last = _outcome(res)
        existing = _existing_column(df, last.then_field)
        value = (F.expr(typed_value(last.then_value, df.schema[existing].dataType, existing))
                 if existing is not None else F.lit(last.then_value))
        flag = F.when(compiled.column, value)
        if existing is not None:
            flag = flag.otherwise(F.col(existing))
        if apply:
            out = df.withColumn(last.then_field, flag)
    elif apply:
        out = df.where(compiled.column)
    if out is not None:
        out = shape.finish(out)
        out.schema  # analyse now (lazy plans, e.g. streaming)
    return query, executed, out


def ordered(df: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Sort by ``keys`` (SQL sort items: ``col``, ``col desc``, ``... nulls
    last``), keeping ``columns`` (default: all). The other kept columns break
    ties so that a key shared by very many rows can still be range-split
    across tasks; columns that are not kept are neither read nor sorted."""
    key_names = {k.strip().split()[0].strip("`").lower() for k in keys if k.strip()}
    kept = df.selectExpr(*columns) if columns else df
    ties = [_quote(c) for c, t in kept.dtypes if c.lower() not in key_names
            and not t.startswith(("array", "map", "struct", "variant"))]
    order = ", ".join(list(keys) + ties)
    select_list = ", ".join(columns) if columns else "*"
    return df.sparkSession.sql(f"select {_escape_braces(select_list)} from {{t}} order by " + _escape_braces(order),
                               t=df)


def _value_lookup(rule: Rule, value_key: str | None) -> RuleResult:
    text = _first_lookup(rule)
    ids = (rule.id,)
    if value_key is not None and value_key.strip():
        try:
            value = parse_lookup_text(text)[value_key.strip()]
        except (ValueError, KeyError, TypeError, IndexError):
            return RuleResult(False, True, R.MSG_VALUE_MISSING.format(value_key), value="",
                              has_value=True, rule_ids=ids)
        return RuleResult(True, True, R.MSG_VALUE_FOUND.format(value, value_key), value=value,
                          has_value=True, rule_ids=ids)
    try:
        entries = [(k, v) for k, v in parse_lookup_text(text).items()]
    except (ValueError, AttributeError):
        return RuleResult(False, True, R.MSG_VALUE_LIST_BAD, value="", has_value=True, rule_ids=ids)
    return RuleResult(True, True, R.MSG_VALUE_LIST.format(entries), value=entries, has_value=True,
                      rule_ids=ids)


def _query_lookup(spark, df, rule, apply, shape) -> RuleResult:
    tail = _first_lookup(rule)
    if tail is None or not tail.strip():
        raise RuleConfigError(f"Rule {rule.id} has no lookup query")
    tail = tail.strip()
    out = None
    query = shape.wrap(_with_table(tail, shape.table_name))
    if apply and df is not None:
        out = shape.finish(spark.sql("select * from {t} " + _escape_braces(tail), t=df))
    return RuleResult(True, True, R.MSG_QUERY_LOOKUP, query=query, df=out, rule_ids=(rule.id,), executed=query)


def _groupby_lookup(spark, df, rule, apply, aggregates, shape) -> RuleResult:
    tail = (_first_lookup(rule) or "").strip()
    keys = grouping_keys(spark, tail)
    if keys is None:
        raise RuleConfigError(
            f"Rule {rule.id}: groupby_lookup needs '[where ...] group by <columns> ...', got {tail!r}")
    if re.fullmatch(r"\d+(\s*,\s*\d+)*", keys):  # ordinals: the input's columns
        if df is None:
            raise RuleConfigError(f"Rule {rule.id}: positional group-by keys need a table")
        positions = [int(n) for n in re.split(r"\s*,\s*", keys)]
        if not all(1 <= n <= len(df.columns) for n in positions):
            raise RuleConfigError(f"Rule {rule.id}: group-by position out of range")
        keys = ", ".join(_quote(df.columns[n - 1]) for n in positions)
    aggs = aggregates or {"row_count": "count(*)"}
    select_list = ", ".join([keys] + [f"{expr} AS {_quote(name)}" for name, expr in aggs.items()])
    sql = f"select {_escape_braces(select_list)} from {{t}} " + _escape_braces(tail)
    out = shape.finish(spark.sql(sql, t=df)) if apply and df is not None else None
    query = (f" select {select_list} from {shape.table_name} " + tail) if shape.table_name else tail
    query = shape.wrap(query)
    return RuleResult(True, True, "Successfully returning the grouped query", query=query,
                      df=out, rule_ids=(rule.id,), executed=query)


def _transformation(df, rule, apply, shape, window=None) -> RuleResult:
    """Every ``when`` entry is one step: its expression becomes the target's new value, and the next
    step sees it. With a validity window only rows inside it change."""
    target = rule.then_field
    steps = [c.field_name for c in rule.conditions]
    if not target or not steps or not all(steps):
        raise RuleConfigError(
            f"Rule {rule.id}: a transformation needs then.field_name (target) and a field_name (expression) in each when")
    out, source, query = df, shape.table_name, ""
    for k, expr in enumerate(steps):
        if window:
            existing = _existing_column(out, target) if out is not None else (target if k else None)
            expr = f"case when {window} then {expr} else {_quote(existing) if existing else 'null'} end"
        select_list = _projection_text(out, target, expr) if out is not None else f"*, {expr} as {_quote(target)}"
        query = f" select {select_list} from {source} " if source else f" {select_list}"
        source = f"({query.strip()}\n)" if source else None
        if out is not None:
            out = out.withColumn(target, F.expr(expr))  # analysed here, so a bad expression is a rule error
    if len(steps) > 1 and not shape.table_name:
        raise RuleConfigError(f"Rule {rule.id}: the text of several transformation steps needs a table name")
    out = shape.finish(out) if apply and out is not None else None
    query = shape.wrap(query)
    return RuleResult(True, True, "Successfully returning the transformed table", query=query,
                      df=out, predicate=None, rule_ids=(rule.id,), executed=query)


def call_rule(rules: RuleSet, process: str, process_key: str, rule_id: str, lookup, value_key: str | None,
              table_name: str | None, dataframes=None, apply_query: bool = True,
              as_of: dt.date | None = None):
    """The positional calling shape of a rule call, answered with the
    5-tuple ``(valid_params, rule_validity, message, query_or_value, df)``.

    ``table_name`` names a registered view (or is empty for text only);
    ``dataframes`` is accepted for callers that pass it and not used.
    """
    table = table_name if table_name and table_name.strip() else None
    res = run_rule(rules, table, rule_id=rule_id, process=process, process_key=process_key,
                   is_lookup=lookup, value_key=value_key, as_of=as_of,
                   apply=bool(apply_query and table), table_name=table_name)
    return res.as_tuple()
