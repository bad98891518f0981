"""Turn rule conditions into Spark predicates.

Each condition ``(field_name, operator, field_value, join)`` becomes a native
``Column`` (so Catalyst can push it into the scan and codegen it) and, for the
audit trail, the SQL text the original rule engine would have produced.

Decisions (see SURVEY §3.5):
* ``field_name`` is a SQL expression (``a - b`` is allowed), parsed by Spark.
* The literal is typed by the *left operand's* data type, found by analysing
  ``df.select(expr)`` (no job runs). Numeric operand -> number (float columns
  compare with a float literal); string operand with an all-digit value ->
  exact numeric comparison of the text: sign, integer digits and "any non-zero
  fraction digit" are compared, so no digit is ever rounded (``'036' = 36``
  holds, malformed text is null instead of an error; text in exponent notation
  compares as ``decimal(38, 18)``); boolean / date / timestamp operands ->
  literal of that type.
* Each condition is built as typed SQL text and the ``Column`` is that text
  parsed by Spark, so the audited ``executed`` text is what ran, word for word.
* The rendered text equals the original engine's wherever that text is
  valid SQL; where it was not (a numeric LIKE value rendered ``x LIKE 36%``)
  the value is quoted instead.
* ``LIKE`` / ``NOT LIKE`` (exact spelling) are prefix matches: value + ``%``.
  Without wildcards in the value this is ``startswith`` (pushed to Parquet).
* ``join`` (AND / OR) follows a condition; conditions fold with SQL precedence
  (AND binds tighter), no parentheses. Goto links are joined with AND.
"""

from __future__ import annotations

import datetime as dt
import math
import re
from dataclasses import dataclass
from decimal import Decimal
from typing import Sequence

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import RuleConfigError
from ..sources.ruleset import Condition, Rule

# The comparison operators a rule may use; LIKE and NOT LIKE (exact spelling) add a trailing '%'.
COMPARISONS = ("=", "==", "<>", "!=", "<", "<=", ">", ">=", "<=>")
PREFIX_LIKE = ("LIKE", "NOT LIKE")
CONNECTIVES = ("AND", "OR")

# Text accepted as a boolean literal (Spark's cast rules).
TRUE_TEXT = ("t", "true", "y", "yes", "1")
FALSE_TEXT = ("f", "false", "n", "no", "0")

_NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                  T.FloatType, T.DoubleType, T.DecimalType)

_NUMBER_TEXT = re.compile(r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$")


def parse_number(value: str | None) -> Decimal | None:
    """A rule's numeric text as an exact Decimal: ASCII digits, optional sign,
    point and exponent only (no '1_000', no non-ASCII digits); else None."""
    text = (value or "").strip()
    if not _NUMBER_TEXT.match(text):
        return None
    return Decimal(text)


def is_plain_number(value: str | None) -> bool:
    """The rule language's "numeric" test: a non-empty run of ASCII digits.

    Signs, decimals and blanks are not numeric (they stay quoted in text).
    """
    return bool(value) and value.isascii() and value.isdigit()


def render_value(value: str, operator: str) -> str:
    """Literal as it appears in the generated SQL text."""
    if operator in PREFIX_LIKE:
        return "'" + value.replace("'", "''") + "%'"
    if is_plain_number(value):
        return str(int(value))
    return "'" + value.replace("'", "''") + "'"


def render_condition(cond: Condition) -> str:
    return " {} {} {}".format(cond.field_name, cond.operator, render_value(cond.field_value or "", cond.operator))


def _lhs(field_name: str) -> Column:
    if not field_name:
        raise RuleConfigError("condition has an empty field_name")
    try:
        return F.expr(field_name)
    except ParseException as e:  # pragma: no cover - depends on Spark message
        raise RuleConfigError(f"field_name {field_name!r} is not a SQL expression: {e.getMessage() if hasattr(e, 'getMessage') else e}") from None


def operand_types(df: DataFrame, field_names: Sequence[str],
                  known: dict[str, T.DataType] | None = None) -> list[T.DataType]:
    """Data types of the left operands, from one analysis of ``df`` (no job).

    ``known`` maps operands already typed (e.g. by ``operand_type_map``)
    so that compiling many rules does not analyse the plan once per rule.
    """
    if not field_names:
        return []
    known = known or {}
    missing = [f for f in dict.fromkeys(field_names) if f not in known]
    types = dict(known)
    if missing:
        cols = [_lhs(f).alias(f"_op{i}") for i, f in enumerate(missing)]
        try:
            schema = df.select(*cols).schema
        except (AnalysisException, ParseException) as e:
            raise RuleConfigError(
                f"cannot resolve condition operand(s) {missing}: {str(e).splitlines()[0]}") from None
        types.update({f: fld.dataType for f, fld in zip(missing, schema.fields)})
    return [types[f] for f in field_names]


def operand_type_map(df: DataFrame, field_names: Sequence[str]) -> dict[str, T.DataType]:
    """Types of every operand that resolves against ``df``, in one analysis
    (operands that do not resolve are left out and reported per rule)."""
    names = list(dict.fromkeys(f for f in field_names if f))

    def typed(part: list[str]) -> dict[str, T.DataType]:
        if not part:
            return {}
        try:
            return dict(zip(part, operand_types(df, part)))
        except RuleConfigError:
            if len(part) == 1:
                return {}
            mid = len(part) // 2  # bisect: a few bad operands cost a few analyses
            return {**typed(part[:mid]), **typed(part[mid:])}

    return typed(names)


def sql_string(value: str) -> str:
    """A Spark SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _sql_double(x: float) -> str:
    return f"{x!r}D" if math.isfinite(x) else f"cast('{'-' if x < 0 else ''}Infinity' as double)"


def _number(value: str, field_name: str, dtype: T.DataType) -> str:
    """``value`` as a SQL literal that compares exactly with an operand of ``dtype``."""
    d = parse_number(value)
    if d is None:
        raise RuleConfigError(
            f"value {value!r} is not a number but {field_name} is {dtype.simpleString()}")
    if isinstance(dtype, T.FloatType):
        return f"cast({_sql_double(float(d))} as float)"  # compare in the column's own precision
    if isinstance(dtype, T.DoubleType):
        return _sql_double(float(d))
    if d.adjusted() >= 38:
        # beyond decimal(38)'s range: every value of the operand compares the
        # same way as with the (possibly infinite) double
        return _sql_double(float(d))
    if d != 0 and d.adjusted() < -38:
        raise RuleConfigError(f"value {value!r} for {field_name} is finer than any decimal(38) step")
    if d == d.to_integral_value() and abs(d) < 2 ** 63:
        return f"{int(d)}" if abs(d) < 2 ** 31 else f"{int(d)}L"
    sign, digits, exponent = d.as_tuple()
    digits = list(digits)
    while len(digits) > 1 and digits[-1] == 0:  # drop trailing zeros exactly (no context rounding)
        digits.pop()
        exponent += 1
    if exponent > 0:  # Spark has no negative decimal scale
        digits, exponent = digits + [0] * exponent, 0
    if max(len(digits), -exponent) > 38:
        raise RuleConfigError(f"value {value!r} for {field_name} has more than 38 significant digits")
    return f"{format(Decimal((sign, tuple(digits), exponent)), 'f')}BD"


def parse_temporal(value: str) -> dt.date | dt.datetime | None:
    text = value.strip()
    for parse in (dt.datetime.fromisoformat, lambda s: dt.datetime.strptime(s, "%d/%m/%Y")):
        try:
            return parse(text)
        except ValueError:
            continue
    return None


_INT_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}


_FLOAT32_MAX = 3.4028234663852886e38


def _digits(d: Decimal) -> tuple[int, int]:
    """(integer digits, fractional digits) of ``d`` ignoring trailing zeros,
    computed from its digit tuple (no decimal context, so no rounding)."""
    _, digits, exponent = d.as_tuple()
    digits = list(digits)
    while len(digits) > 1 and digits[-1] == 0:
        digits.pop()
        exponent += 1
    if digits == [0]:
        return 0, 0
    return max(0, len(digits) + exponent), max(0, -exponent)


def _fits(d: Decimal, dtype: T.DataType) -> bool:
    """True if ``d`` converts to ``dtype`` without rounding or overflow."""
    int_digits, frac_digits = _digits(d)
    for kind, bits in _INT_BITS.items():
        if isinstance(dtype, kind):
            return frac_digits == 0 and -(2 ** (bits - 1)) <= int(d) < 2 ** (bits - 1)
    if isinstance(dtype, T.DecimalType):
        return frac_digits <= dtype.scale and int_digits <= dtype.precision - dtype.scale
    if isinstance(dtype, T.FloatType):
        return abs(float(d)) <= _FLOAT32_MAX
    return math.isfinite(float(d))  # double


def typed_value(value: str, dtype: T.DataType, field_name: str) -> str:
    """``value`` as a SQL literal of ``dtype`` (used for flag outcomes written
    into an existing column); RuleConfigError if it does not convert."""
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        return sql_string(value)
    if isinstance(dtype, T.BooleanType):
        text = value.strip().lower()
        if text in TRUE_TEXT + FALSE_TEXT:
            return "true" if text in TRUE_TEXT else "false"
    elif isinstance(dtype, _NUMERIC_TYPES):
        d = parse_number(value)
        if d is not None and _fits(d, dtype):
            if isinstance(dtype, tuple(_INT_BITS)):
                return f"cast('{int(d)}' as {dtype.simpleString()})"
            return f"cast('{format(d, 'f')}' as {dtype.simpleString()})"  # plain notation, exact
    elif isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        parsed = parse_temporal(value)
        if parsed is not None:
            return _temporal_sql(parsed, dtype)
    raise RuleConfigError(f"outcome value {value!r} does not fit column {field_name} "
                          f"of type {dtype.simpleString()}")


def _temporal_sql(parsed: dt.datetime, dtype: T.DataType) -> str:
    iso = parsed.date().isoformat() if isinstance(dtype, T.DateType) else parsed.isoformat(sep=" ")
    return f"cast('{iso}' as {dtype.simpleString()})"


def _text_number_sql(x: str, operator: str, value: str) -> str:
    """Text operand against an all-digit value, by sign, integer digits and fraction; nothing is rounded."""
    target = f"{int(value)}BD"
    digits = rf"regexp_extract({x}, r'^\s*[+-]?0*([0-9]*)', 1)"
    whole = f"coalesce(try_cast({digits} as decimal(38,0)), 0BD)"
    fraction = rf"{x} rlike r'\.[0-9]*[1-9]'"
    side = (rf"case when {x} rlike r'^\s*-' and ({digits} != '' or {fraction}) then -1 "
            f"when length({digits}) > 38 then 1 when {whole} < {target} then -1 when {whole} > {target} then 1 "
            f"when {fraction} then 1 else 0 end")
    plain = rf"{x} rlike r'^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)\s*$'"
    return (f"case when {plain} then ({side}) {operator} 0 "
            f"else try_cast({x} as decimal(38,18)) {operator} {target} end")


def comparison_sql(dtype: T.DataType, field_name: str, operator: str, value: str) -> str:
    """``field_name <operator> value`` as SQL text, the value typed by ``dtype``."""
    x = f"({field_name}\n)" if "--" in field_name else f"({field_name})"
    if isinstance(dtype, _NUMERIC_TYPES):
        literal = _number(value, field_name, dtype)
        d = parse_number(value)
        if isinstance(dtype, T.LongType) and not -2 ** 63 <= d < 2 ** 63:
            # beyond bigint: known for every value but null. Spark's own folding of such a comparison keeps null rows
            edge = "9223372036854775807L" if d > 0 else "cast('-9223372036854775808' as bigint)"
            holds = operator in ("<>", "!=") or operator in (("<", "<=") if d > 0 else (">", ">="))
            return f"{x} {('<=' if d > 0 else '>=') if holds else ('>' if d > 0 else '<')} {edge}"
        return f"{x} {operator} {literal}"
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        if is_plain_number(value):
            if len(value) > 38:
                raise RuleConfigError(f"numeric value {value!r} is too long")
            return _text_number_sql(x, operator, value)
        return f"{x} {operator} {sql_string(value)}"
    if isinstance(dtype, T.BooleanType):
        text = value.strip().lower()
        if text in TRUE_TEXT:
            return f"{x} {operator} true"
        if text in FALSE_TEXT:
            return f"{x} {operator} false"
        raise RuleConfigError(f"value {value!r} is not a boolean but {field_name} is boolean")
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        parsed = parse_temporal(value)
        if parsed is None:
            raise RuleConfigError(
                f"value {value!r} is not a date/time but {field_name} is {dtype.simpleString()}")
        return f"{x} {operator} {_temporal_sql(parsed, dtype)}"
    raise RuleConfigError(f"{field_name} has type {dtype.simpleString()}, which rules cannot compare")


def condition_sql(cond: Condition, dtype: T.DataType) -> str:
    """One builder condition against an operand of type ``dtype``, as the SQL text that runs."""
    operator = cond.operator
    value = cond.field_value
    if value is None:
        raise RuleConfigError(f"condition {cond.field_name!r} has no field_value")
    _lhs(cond.field_name)
    if operator.upper() in PREFIX_LIKE:
        x = f"({cond.field_name}\n)" if "--" in cond.field_name else f"({cond.field_name})"
        text = x if isinstance(dtype, T.StringType) else f"cast({x} as string)"
        if operator in PREFIX_LIKE:  # exact spelling: prefix match
            if any(ch in value for ch in "%_\\"):
                trailing = len(value) - len(value.rstrip("\\"))
                pattern = value + ("\\" if trailing % 2 else "")  # keep the appended % a wildcard
                matched = f"{text} like {sql_string(pattern + '%')}"
            else:
                matched = f"startswith({text}, {sql_string(value)})"
        else:  # other spelling: the value is the whole LIKE pattern
            matched = f"{text} like {sql_string(value)}"
        return f"not ({matched})" if operator.upper() == "NOT LIKE" else matched
    if operator not in COMPARISONS:
        raise RuleConfigError(
            f"operator {operator!r} is not supported; use one of "
            f"{', '.join(list(COMPARISONS) + list(PREFIX_LIKE))}")
    return comparison_sql(dtype, cond.field_name, operator, value)


def condition_column(cond: Condition, dtype: T.DataType) -> Column:
    """Compile one builder condition against an operand of type ``dtype``."""
    return F.expr(condition_sql(cond, dtype))


def _connective(join: str, rule_id: str) -> str:
    j = (join or "").strip().upper()
    if j and j not in CONNECTIVES:
        raise RuleConfigError(f"rule {rule_id}: join {join!r} must be AND, OR or empty")
    return j


def fold_precedence(items: Sequence[tuple[str, str]]) -> str:
    """Fold SQL texts ``c1 j1 c2 j2 c3 ...`` with AND binding tighter than OR.

    ``items[i][1]`` is the connective between item i and i+1 (last ignored).
    """
    if not items:
        raise RuleConfigError("no conditions to fold")
    groups: list[list[str]] = [[items[0][0]]]
    for (_, conn), (text, _) in zip(items, items[1:]):
        if conn == "OR":
            groups.append([text])
        else:
            groups[-1].append(text)
    return _all_of([" or ".join(_all_of(g) for g in groups)]) if len(groups) > 1 else _all_of(groups[0])


def _all_of(texts: Sequence[str]) -> str:
    return " and ".join(f"({t})" for t in texts)


@dataclass(frozen=True)
class Atom:
    """One condition with the type of its operand."""
    operand: str
    dtype: T.DataType
    operator: str
    value: str


@dataclass(frozen=True)
class CompiledPredicate:
    """A rule chain compiled against one DataFrame schema."""
    column: Column
    where_text: str          # " where ..." exactly as the SQL text renders it
    rule_ids: tuple[str, ...]
    executed: str = ""       # the typed SQL predicate ``column`` was parsed from
    dnf: tuple[tuple[Atom, ...], ...] | None = None  # the same as an OR of ANDs, where conditions say it all

    def query_text(self, table_name: str | None) -> str:
        if table_name and table_name.strip():
            return " select * from {} ".format(table_name) + self.where_text
        return self.where_text


def _flatten(links: Sequence[Rule], extra: Sequence[Condition], first_is_target: bool,
             ) -> tuple[list[tuple[Condition, str, int]], list]:
    """Conditions of the chain in order with the connective after each."""
    if not links:
        raise RuleConfigError("nothing to compile")
    flat: list[tuple[Condition, str, int]] = []  # (condition, connective after it, link index)
    gate_link = [("__gate__", list(extra))] if extra else []
    all_links = gate_link + [(r.id, list(r.conditions)) for r in links]
    for li, (rule_id, conds) in enumerate(all_links):
        if not conds:
            raise RuleConfigError(f"rule {rule_id} has no conditions")
        is_root = li == len(gate_link)  # the called rule itself
        for ci, cond in enumerate(conds):
            conn = _connective(cond.join, rule_id)
            last_in_link = ci == len(conds) - 1
            if not last_in_link and not conn:
                if is_root and not gate_link and not first_is_target:
                    raise RuleConfigError(
                        f"rule {rule_id}: condition {ci + 1} has no join before condition {ci + 2}")
                conn = "AND"  # inside goto targets an empty join means AND
            if last_in_link:
                if li < len(all_links) - 1:
                    if conn == "OR":
                        raise RuleConfigError(f"rule {rule_id}: a trailing OR cannot lead into a goto")
                    conn = "AND"
                else:
                    conn = ""  # trailing join on the final condition is ignored
            flat.append((cond, conn, li))

    return flat, gate_link


def _render(flat: list[tuple[Condition, str, int]], n_gate: int, group_links: bool) -> str:
    text = " where"
    joined_prev = False
    for idx, (cond, conn, li) in enumerate(flat):
        if idx > 0 and not joined_prev:
            text += " and"
        if n_gate and idx == n_gate and not group_links:
            text += " ("
        if group_links and (idx == 0 or flat[idx - 1][2] != li):
            text += " ("
        text += render_condition(cond)
        if group_links and (idx == len(flat) - 1 or flat[idx + 1][2] != li):
            text += " )"
        raw_join = (cond.join or "").strip()
        joined_prev = idx < len(flat) - 1 and bool(raw_join) and raw_join.upper() == conn
        if joined_prev:
            text += "  {}".format(raw_join)
    if n_gate and not group_links:
        text += " )"
    return text


def chain_text(links: Sequence[Rule], group_links: bool = False, extra: Sequence[Condition] = (),
               first_is_target: bool = False) -> str:
    """Only the " where ..." text of a chain (no table needed: literals are
    rendered, not typed)."""
    flat, _ = _flatten(links, extra, first_is_target)
    return _render(flat, len(extra), group_links)


def compile_chain(df: DataFrame, links: Sequence[Rule], group_links: bool = False,
                  extra: Sequence[Condition] = (), first_is_target: bool = False,
                  known_types: dict[str, T.DataType] | None = None) -> CompiledPredicate:
    """Compile a query-builder rule and its goto targets into one predicate.

    ``links[0]`` is the rule that was called (or, with ``first_is_target``,
    the first rule a conditional jumped to); later links are goto targets.
    Inside goto targets an empty join between two conditions means AND; in
    the called rule it is a configuration error. ``extra`` conditions (a
    conditional rule's gate) are ANDed in front.
    """
    flat, gate_link = _flatten(links, extra, first_is_target)
    types = operand_types(df, [c.field_name for c, _, _ in flat], known_types)
    parts = [condition_sql(c, t) for (c, _, _), t in zip(flat, types)]

    n_gate = len(extra)
    gate, parts = parts[:n_gate], parts[n_gate:]
    body = flat[n_gate:]
    if group_links:
        per_link: dict[int, list[tuple[str, str]]] = {}
        for part, (_, conn, li) in zip(parts, body):
            per_link.setdefault(li, []).append((part, conn))
        executed = _all_of([fold_precedence(v) for _, v in sorted(per_link.items())])
    else:
        executed = fold_precedence([(part, conn) for part, (_, conn, _) in zip(parts, body)])
    if gate:  # the gate guards the whole chain, not just its first OR-group
        executed = _all_of([*gate, executed])

    atoms = [Atom(c.field_name, t, c.operator, c.field_value) for (c, _, _), t in zip(flat, types)]
    alternatives: list[list[Atom]] = [[]]
    for atom, (_, conn, _) in zip(atoms[n_gate:], body):
        alternatives[-1].append(atom)
        if conn == "OR":
            alternatives.append([])
    dnf = None if group_links else tuple((*atoms[:n_gate], *a) for a in alternatives)

    text = _render(flat, n_gate, group_links)
    return CompiledPredicate(column=F.expr(executed), where_text=text,
                             rule_ids=tuple(r.id for r in links), executed=executed, dnf=dnf)
