"""Predicate index: many rules over shared operands, evaluated by position.

Rules of one document ask about the same few operands again and again. Equal
operands are factored out of all rules and each is evaluated once per row: the
values its conditions compare with, sorted, cut the operand's domain into
places, and a binary search over one constant array gives the row's place. In
these places

* a condition is one or two ranges (``<>`` and ``NOT LIKE`` are two; text
  equality and prefixes are ranges of the text order), exact in the operand's
  own type: bigint and decimal values are never read as double;
* a conjunction is a set of places per operand; a rule is an OR of conjunctions.

A rule on one operand is a set of that operand's places, so its hits are counted
from a histogram of the places. For the others each operand has, per place, a
word with one bit per rule that admits this place (for a validity window: the
rules valid on that day); the AND of the words at a row's places has the bits of
the rules that fire. A row costs one array look-up per operand and word of rules,
however many conditions the rules have.

Rules with a condition that has no place (numeric comparison of text, wildcard
patterns, stored query text, ...) keep their compiled predicate and share the
same scan.

``index_hits`` lists (row, rule), ``index_hit_counts`` counts per rule and
``first_hits`` gives each row the first rule in order that fires. All are one
scan without a join of the data; only the counts shuffle, and only per-task
partial rows whose number the rules bound.
"""

from __future__ import annotations

import datetime as dt
import json
import math
import struct
from bisect import bisect_left
from dataclasses import dataclass, field
from decimal import Decimal
from fractions import Fraction
from functools import reduce
from itertools import accumulate
from operator import xor
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import RuleConfigError
from ..functions.predicates import (FALSE_TEXT, PREFIX_LIKE, TRUE_TEXT, Atom, CompiledPredicate, is_plain_number,
                                    parse_number, parse_temporal, sql_string)

# Comparison operators that have a place.
_RANGE_OPS = ("=", "==", "<=>", "<>", "!=", "<", "<=", ">", ">=")

MAX_ALTERNATIVES = 8   # a rule of more OR alternatives keeps its compiled predicate
FEW_CUTS = 12          # cuts compared one by one instead of searched
WORD_BITS = 60         # rules per word: positive in 64 bits
MASK_BITS = 10         # rules per counted bit mask
_MASKS = WORD_BITS // MASK_BITS

_INTEGERS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}


# ------------------------------------------------------------------ domains
# A domain turns conditions into half-open ranges [from, to) of its cut values; None is the open end.

def _whole_ranges(operator: str, value: Decimal, scale: int) -> list[tuple[int | None, int | None]]:
    """Ranges of whole numbers (multiples of 10**-scale) that satisfy ``x <operator> value``."""
    scaled = Fraction(value) * 10 ** scale  # exact: Decimal arithmetic would round to its context
    low = math.floor(scaled)
    exact = scaled == low
    up = low if exact else low + 1
    if operator in (">=", "<"):
        return [(up, None)] if operator == ">=" else [(None, up)]
    if operator in (">", "<="):
        return [(low + 1, None)] if operator == ">" else [(None, low + 1)]
    if operator in ("=", "==", "<=>"):
        return [(low, low + 1)] if exact else []
    return [(None, low), (low + 1, None)] if exact else [(None, None)]


def _ordered_ranges(operator: str, value, after) -> list[tuple]:
    """Ranges for a domain where ``after`` is the smallest value above ``value``."""
    return {">=": [(value, None)], "<": [(None, value)], ">": [(after, None)], "<=": [(None, after)],
            "=": [(value, after)], "==": [(value, after)], "<=>": [(value, after)],
            "<>": [(None, value), (after, None)], "!=": [(None, value), (after, None)]}[operator]


def _after_prefix(prefix: str) -> str | None:
    """The smallest text above all texts that begin with ``prefix`` (code point order is UTF-8 byte order)."""
    while prefix:
        code = ord(prefix[-1]) + 1
        if code <= 0x10FFFF:
            return prefix[:-1] + chr(0xE000 if 0xD800 <= code <= 0xDFFF else code)
        prefix = prefix[:-1]
    return None


def condition_ranges(atom: Atom) -> list[tuple] | None:
    """Ranges of cut values where the condition holds; None if it has no place."""
    dtype, operator, value = atom.dtype, atom.operator, atom.value
    if operator in PREFIX_LIKE:
        if dtype != T.StringType() or any(c in value for c in "%_\\") or not value:
            return None
        end = _after_prefix(value)
        if operator == "LIKE":
            return [(value, end)]
        return [(None, value)] + ([(end, None)] if end is not None else [])
    if operator not in _RANGE_OPS:
        return None
    if dtype == T.StringType():
        return None if is_plain_number(value) else _ordered_ranges(operator, value, value + "\0")
    if isinstance(dtype, T.BooleanType):
        text = value.strip().lower()
        return _whole_ranges(operator, Decimal(text in TRUE_TEXT), 0) if text in TRUE_TEXT + FALSE_TEXT else None
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        parsed = parse_temporal(value)
        if parsed is None or getattr(parsed, "tzinfo", None) is not None:
            return None
        if isinstance(dtype, T.DateType):
            day = parsed.date() if isinstance(parsed, dt.datetime) else parsed
            return _ordered_ranges(operator, day.isoformat(), (day + dt.timedelta(days=1)).isoformat()) if day < dt.date.max else None
        at = parsed if isinstance(parsed, dt.datetime) else dt.datetime.combine(parsed, dt.time())
        if at >= dt.datetime.max or at.year < 1000:
            return None
        stamp = lambda t: t.isoformat(sep=" ", timespec="microseconds")
        return _ordered_ranges(operator, stamp(at), stamp(at + dt.timedelta(microseconds=1)))
    number = parse_number(value)
    if number is None or number.adjusted() >= 38 or len(number.as_tuple().digits) > 38:
        return None
    if isinstance(dtype, tuple(_INTEGERS)) or isinstance(dtype, T.DecimalType):
        scale = dtype.scale if isinstance(dtype, T.DecimalType) else 0
        if number != 0 and number.adjusted() < -38:
            return None
        if isinstance(dtype, T.DecimalType) and Fraction(number) * 10 ** scale % 1:
            return None  # finer than the operand: the compiled comparison may round, and the index answers as it does
        most = 10 ** dtype.precision if isinstance(dtype, T.DecimalType) else 2 ** (_INTEGERS[type(dtype)] - 1)
        least = -most + 1 if isinstance(dtype, T.DecimalType) else -most
        out = []
        for low, high in _whole_ranges(operator, number, scale):  # cuts outside the type are open ends or no range at all
            low = None if low is not None and low <= least else low
            high = None if high is not None and high >= most else high
            if (low is None or low < most) and (high is None or high > least):
                out.append((low, high))
        return out
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        x = float(number)
        if isinstance(dtype, T.FloatType):
            try:
                x = struct.unpack("f", struct.pack("f", x))[0]
            except OverflowError:
                return None
        return _ordered_ranges(operator, x, math.nextafter(x, math.inf)) if math.isfinite(x) else None
    return None


def _constant(values: Sequence, dtype: str) -> Column:
    """A constant array as one literal, however many values it has."""
    return F.from_json(F.lit(json.dumps(list(values))), f"array<{dtype}>")


def _scaled_text(whole: int, scale: int) -> str:
    """``whole * 10**-scale`` in plain notation."""
    digits = str(abs(whole)).zfill(scale + 1)
    return ("-" if whole < 0 else "") + (f"{digits[:-scale]}.{digits[-scale:]}" if scale else digits)


@dataclass
class Operand:
    """One expression that rules compare, with its sorted cuts."""
    expression: str
    dtype: T.DataType
    cuts: list = field(default_factory=list)

    @property
    def searched_as(self) -> str:
        """The type the cuts are compared in: the operand's own, or one that holds it exactly."""
        if isinstance(self.dtype, T.DecimalType):
            return self.dtype.simpleString()
        if isinstance(self.dtype, (T.FloatType, T.DoubleType)):
            return "double"
        if isinstance(self.dtype, (T.BooleanType, *_INTEGERS)):
            return "bigint"
        return self.dtype.simpleString()

    @property
    def column(self) -> Column:
        x = F.expr(self.expression)
        return x.cast("int").cast("bigint") if isinstance(self.dtype, T.BooleanType) else x.cast(self.searched_as)

    def constants(self, size: int) -> Column:
        """The cuts, filled up with their last value to ``size``."""
        cuts = self.cuts + self.cuts[-1:] * (size - len(self.cuts))
        if isinstance(self.dtype, T.DecimalType):
            return _constant([_scaled_text(c, self.dtype.scale) for c in cuts], "string").cast(f"array<{self.searched_as}>")
        if self.searched_as in ("bigint", "string"):
            return _constant(cuts, self.searched_as)
        return _constant([repr(c) if isinstance(c, float) else c for c in cuts], "string").cast(f"array<{self.searched_as}>")

    def counted(self, value: str) -> str:
        """How many cuts are at or below ``value``, as a sum in SQL text (null for null)."""
        if isinstance(self.dtype, T.DecimalType):
            texts = [_scaled_text(c, self.dtype.scale) for c in self.cuts]
        else:
            texts = [c if isinstance(c, str) else repr(c) for c in self.cuts]
        if self.searched_as == "string":
            return " + ".join(f"int({sql_string(c)} <= {value})" for c in texts)
        return " + ".join(f"int(cast('{c}' as {self.searched_as}) <= {value})" for c in texts)

    def place_range(self, low, high) -> tuple[int, int]:
        """[first, last] place of the range [low, high)."""
        first = 0 if low is None else bisect_left(self.cuts, low) + 1
        last = len(self.cuts) if high is None else bisect_left(self.cuts, high)
        return first, last


def _sorted_cuts(values: set, dtype: T.DataType) -> list:
    if dtype == T.StringType():
        return sorted(values, key=lambda s: s.encode("utf-8", "surrogatepass"))
    return sorted(values)


Ranges = list[tuple[int, int]]  # disjoint [first, last] places, in order


@dataclass
class RuleIndex:
    rule_ids: list[str]
    operands: list[Operand] = field(default_factory=list)
    places: dict[int, list[tuple[int, int, int]]] = field(default_factory=dict)  # operand -> [(rule, first, last)], rules on it alone
    conjunctions: dict[int, list[dict[int, Ranges]]] = field(default_factory=dict)  # rule -> alternatives, each operand -> places
    compiled: dict[int, CompiledPredicate] = field(default_factory=dict)  # rules without places


class _NoPlace(Exception):
    pass


def _usable(compiled: Sequence[tuple[str, CompiledPredicate]], columns: Sequence[str]) -> set[str]:
    """Operands that may be evaluated for every row: columns, and expressions that some rule evaluates first in any case
    (others could fail on rows which an earlier condition of their rule keeps away from them)."""
    plain = {c.lower() for c in columns}
    names = {a.operand for _, p in compiled for conj in p.dnf or () for a in conj}
    return ({n for n in names if n.strip().strip("`").lower() in plain}
            | {p.dnf[0][0].operand for _, p in compiled if p.dnf})


def build_index(df: DataFrame, compiled: Sequence[tuple[str, CompiledPredicate]]) -> RuleIndex:
    """Factor the operands of all rules. Metadata only, no job."""
    index = RuleIndex([rid for rid, _ in compiled])
    usable = _usable(compiled, df.columns)
    wanted: dict[tuple[str, str], set] = {}
    ranged: dict[int, list[list[tuple[tuple[str, str], list[tuple]]]]] = {}
    types: dict[tuple[str, str], T.DataType] = {}
    for at, (_, p) in enumerate(compiled):
        try:
            conjunctions = []
            for conj in p.dnf or ():
                found = []
                for atom in conj:
                    ranges = condition_ranges(atom) if atom.operand in usable else None
                    if ranges is None:
                        raise _NoPlace
                    key = (atom.operand.strip(), atom.dtype.simpleString())
                    types[key] = atom.dtype
                    found.append((key, ranges))
                conjunctions.append(found)
            if not 0 < len(conjunctions) <= MAX_ALTERNATIVES:
                raise _NoPlace
        except _NoPlace:
            index.compiled[at] = p
            continue
        ranged[at] = conjunctions
        for found in conjunctions:
            for key, ranges in found:
                wanted.setdefault(key, set()).update(c for r in ranges for c in r if c is not None)
    numbers = {}
    for key, cuts in wanted.items():
        numbers[key] = len(index.operands)
        index.operands.append(Operand(key[0], types[key], _sorted_cuts(cuts, types[key])))
        if types[key] == T.StringType():  # bisect in the text order of the data
            index.operands[-1] = TextOperand(key[0], types[key], index.operands[-1].cuts)
    for at, conjunctions in ranged.items():
        alternatives = []
        for found in conjunctions:
            places: dict[int, Ranges] = {}
            for key, ranges in found:
                f = numbers[key]
                held = _union(r for r in (index.operands[f].place_range(*x) for x in ranges) if r[0] <= r[1])
                places[f] = _common(places[f], held) if f in places else held
            if all(places.values()):
                alternatives.append(places)
        on = {f for places in alternatives for f in places}
        if len(on) == 1:
            f = on.pop()
            index.places.setdefault(f, []).extend((at, *r) for r in _union(r for a in alternatives for r in a[f]))
        elif alternatives:
            index.conjunctions[at] = alternatives
    return index


class TextOperand(Operand):
    def place_range(self, low, high) -> tuple[int, int]:
        cuts = [c.encode("utf-8", "surrogatepass") for c in self.cuts]
        code = lambda s: s.encode("utf-8", "surrogatepass")
        return (0 if low is None else bisect_left(cuts, code(low)) + 1, len(cuts) if high is None else bisect_left(cuts, code(high)))


def _union(ranges) -> Ranges:
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(r) for r in out]


def _common(some: Ranges, others: Ranges) -> Ranges:
    return [(max(a, c), min(b, d)) for a, b in some for c, d in others if max(a, c) <= min(b, d)]


# ---------------------------------------------------------------- in the row

def _place(f: int) -> str:
    return f"__p{f}"


def _placed(df: DataFrame, keep: dict[str, Column], operands: Sequence[Operand]) -> DataFrame:
    """``keep`` plus a place for each operand: how many cuts are at or below its value, -1 for null.

    Up to ``FEW_CUTS`` cuts are compared one by one. More take a binary search as ``ceil(log2(m))`` projections; each
    reads the previous place twice, so Catalyst keeps them apart and the generated code stays small however many cuts
    an operand has.
    """
    few = [len(o.cuts) <= FEW_CUTS for o in operands]
    depth = [0 if small else math.ceil(math.log2(len(o.cuts) + 1)) for o, small in zip(operands, few)]
    arrays = [o.constants(2 ** d) if d else None for o, d in zip(operands, depth)]
    values = [F.col(f"__v{f}") for f in range(len(operands))]
    cur = df.select(*[c.alias(n) for n, c in keep.items()], *[o.column.alias(f"__v{f}") for f, o in enumerate(operands)],
                    *[F.lit(0).alias(_place(f)) for f in range(len(operands))])
    for level in range(max(depth, default=0)):
        steps = []
        for f in range(len(operands)):
            p = F.col(_place(f))
            if level < depth[f]:
                step = 2 ** (depth[f] - 1 - level)
                p = F.when(F.element_at(arrays[f], p + step) <= values[f], p + step).otherwise(p)
            steps.append(p.alias(_place(f)))
        cur = cur.select(*keep, *values, *steps)
    last = [f"least(__p{f}, {len(o.cuts)})" if not small else o.counted(f"__v{f}") if o.cuts else "0"
            for f, (o, small) in enumerate(zip(operands, few))]
    return cur.select(*keep, *[F.expr(f"if(__v{f} is null, -1, {text}) as __p{f}") for f, text in enumerate(last)])


def _tables(index: RuleIndex, parts: Sequence[Sequence[int]]) -> list[dict[int, list[list[int]]]]:
    """For each alternative, operand and part: the word of the rules that admit a place (a null operand first). An empty
    list stands for an operand that no rule of the part asks about."""
    most = max((len(a) for a in index.conjunctions.values()), default=0)
    out: list[dict[int, list[list[int]]]] = []
    for k in range(most):
        tables: dict[int, list[list[int]]] = {}
        for c, part in enumerate(parts):
            have = [(bit, index.conjunctions[r][k]) for bit, r in enumerate(part) if len(index.conjunctions.get(r, ())) > k]
            for f in {f for _, places in have for f in places}:
                size = len(index.operands[f].cuts) + 2
                free = sum(1 << bit for bit, places in have if f not in places)
                flips = [0] * (size + 1)  # running XOR: a bit turns on at the first place of a range and off after the last
                for bit, places in have:
                    for a, b in places.get(f, ()):
                        flips[a + 1] ^= 1 << bit
                        flips[b + 2] ^= 1 << bit
                tables.setdefault(f, [[] for _ in parts])[c] = [now | free for now in accumulate(flips[:size], xor)]
        out.append(tables)
    return out


def _all_conjunctions(index: RuleIndex) -> RuleIndex:
    """The index with rules on one operand as conjunctions too."""
    single: dict[int, list[dict[int, Ranges]]] = {}
    for f, rules in index.places.items():
        for rule, a, b in rules:
            single.setdefault(rule, [{f: []}])[0][f].append((a, b))
    return RuleIndex(index.rule_ids, index.operands, {}, {**index.conjunctions, **single}, index.compiled)


def _words(df: DataFrame, index: RuleIndex, keep: dict[str, Column], rules: Sequence[int]):
    """``(frame, n, word)``: ``keep`` and what words need, the number of words of ``WORD_BITS`` rules, and the word of a
    part as a function of its number. The code of a word does not grow with the number of rules."""
    parts = [rules[i:i + WORD_BITS] for i in range(0, len(rules), WORD_BITS)]
    none = F.lit(0).cast("bigint")
    flags = {}
    if any(r in index.compiled for r in rules):
        flags["__g"] = F.array(*[reduce(lambda a, b: a.bitwiseOR(b), [
            F.when(index.compiled[r].column, F.lit(1 << bit).cast("bigint")).otherwise(none)
            for bit, r in enumerate(part) if r in index.compiled] or [none]) for part in parts])
    tables = [{f: _constant(t, "array<bigint>") for f, t in by_operand.items()} for by_operand in _tables(index, parts)]
    placed = _placed(df, {**keep, **flags}, index.operands)

    def word(part: Column) -> Column:
        every = F.lit((1 << WORD_BITS) - 1)
        found = [reduce(lambda a, b: a.bitwiseAND(b), [
            F.coalesce(F.get(F.get(t, part), F.col(_place(f)) + 1), every if len(by_operand) > 1 else none)
            for f, t in sorted(by_operand.items())]) for by_operand in tables]
        # a part whose rules have no k-th alternative asks about no operand at all
        for k, by_operand in enumerate(tables):
            if len(by_operand) > 1:
                asked = _constant([1 if any(len(index.conjunctions.get(r, ())) > k for r in p) else 0 for p in parts], "bigint")
                found[k] = F.when(F.get(asked, part) == 1, found[k]).otherwise(none)
        if flags:
            found.append(F.get("__g", part))
        return reduce(lambda a, b: a.bitwiseOR(b), found) if found else none
    return placed, len(parts), word


def _own_names(df: DataFrame, keys: Sequence[str]) -> tuple[list[str], dict[str, Column]]:
    columns = df.select(*keys).columns if keys else []
    quoted = [F.col("`" + c.replace("`", "``") + "`") for c in columns]
    return columns, {f"__k{i}": c for i, c in enumerate(quoted)}


def _checked(index: RuleIndex) -> None:
    if not index.rule_ids:
        raise RuleConfigError("no rules to evaluate")


def index_hits(df: DataFrame, index: RuleIndex, keys: Sequence[str]) -> DataFrame:
    """``keys + [rule_id]``, one row per rule a row satisfies."""
    _checked(index)
    columns, keep = _own_names(df, keys)
    placed, n, word = _words(df, _all_conjunctions(index), keep, range(len(index.rule_ids)))
    rows = placed.select("*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("__part"))
    rows = rows.select(*keep, "__part", word(F.col("__part")).alias("__word")).where("__word != 0")
    rows = rows.select(*keep, "__part", "__word", F.explode(F.sequence(F.lit(0), F.lit(WORD_BITS - 1))).alias("__bit"))
    rows = rows.where(F.getbit("__word", F.col("__bit")) == 1)
    ids = _constant(index.rule_ids, "string")
    return rows.select(*[F.col(k).alias(c) for k, c in zip(keep, columns)],
                       F.get(ids, F.col("__part") * WORD_BITS + F.col("__bit")).alias("rule_id"))


def index_hit_counts(df: DataFrame, index: RuleIndex) -> DataFrame:
    """``(rule_id, hits)`` for every rule, zero counts included, from one scan.

    A row gives its place on each operand that has rules of its own, and for each ``MASK_BITS`` other rules the mask of
    those that fire; equal numbers are counted map-side (a bounded number of groups) and only the counted numbers are
    turned into rules."""
    _checked(index)
    own = sorted(index.places)
    others = sorted([*index.conjunctions, *index.compiled])
    placed, n_words, word = _words(df, index, {}, others)
    kind = lambda k: F.lit(k << 32).cast("bigint")
    value = F.col("__n").bitwiseAND(F.lit((1 << 32) - 1)).cast("int")
    numbers = F.array(*[F.col(_place(f)).cast("bigint") + 1 + kind(i) for i, f in enumerate(own)]) if own else None  # null: 0
    if n_words:  # part -1 stands for the places, which need no mask
        rows = placed.select("*", F.explode(F.sequence(F.lit(-1 if own else 0), F.lit(n_words - 1))).alias("__part"))
        rows = rows.select(*[_place(f) for f in own], "__part", F.when(F.col("__part") >= 0, word(F.col("__part"))).otherwise(-1).alias("__word"))
        mask = F.array(*[F.shiftright("__word", MASK_BITS * i).bitwiseAND(F.lit((1 << MASK_BITS) - 1))
                         + F.shiftleft(F.col("__part").cast("bigint") * _MASKS + len(own) + i, 32) for i in range(_MASKS)])
        rows = rows.where("__word != 0")
        rows = rows.select(F.explode(F.when(F.col("__part") >= 0, mask).otherwise(numbers) if own else mask).alias("__n"))
    else:
        rows = placed.select(F.explode(numbers if own else F.array(kind(0))).alias("__n"))
    rows = rows.where(value != 0)  # neither nulls nor empty masks
    seen = (rows.groupBy("__n").agg(F.count(F.lit(1)).alias("n"))
            .select(F.shiftright("__n", 32).cast("int").alias("kind"), value.alias("value"), "n"))
    rules = [F.array().cast("array<int>")]
    if own:
        ranges = _constant([[{"rule": r, "a": a, "b": b} for r, a, b in index.places[f]] for f in own],
                           "array<struct<rule:int,a:int,b:int>>")
        held = F.filter(F.get(ranges, "kind"), lambda r: (r["a"] < F.col("value")) & (F.col("value") <= r["b"] + 1))
        rules.append(F.when(F.col("kind") < len(own), F.transform(held, lambda r: r["rule"])))
    if others:
        set_bits = F.filter(F.sequence(F.lit(0), F.lit(MASK_BITS - 1)), lambda i: F.getbit(F.col("value"), i) == 1)
        names = _constant(others, "int")
        rules.append(F.when(F.col("kind") >= len(own), F.transform(set_bits, lambda i: F.get(names, (F.col("kind") - len(own)) * MASK_BITS + i))))
    counted = seen.select(F.explode(F.coalesce(*rules[:0:-1], rules[0])).alias("rule"), "n")
    zeros = df.sparkSession.range(len(index.rule_ids), numPartitions=1).select(F.col("id").cast("int"), F.lit(0).cast("bigint"))
    ids = _constant(index.rule_ids, "string")
    return counted.union(zeros).groupBy("rule").agg(F.sum("n").alias("hits")).select(F.get(ids, F.col("rule")).alias("rule_id"), "hits")


def first_hits(df: DataFrame, index: RuleIndex, keys: Sequence[str]) -> DataFrame:
    """``keys + [rule_id]`` for every row: the first rule, in the order of the batch, that fires (null if none): the
    lowest bit of the first word that is not zero."""
    _checked(index)
    columns, keep = _own_names(df, keys)
    placed, n, word = _words(df, _all_conjunctions(index), keep, range(len(index.rule_ids)))
    found = placed.select(*keep, F.transform(F.sequence(F.lit(0), F.lit(n - 1)), word).alias("__words"))
    part = F.array_position(F.transform("__words", lambda w: w != 0), True) - 1  # -1 where no rule fires
    found = found.select(*keep, part.cast("int").alias("__part"), F.get("__words", part.cast("int")).alias("__word"))
    low = F.bit_count(F.bitwise_not("__word").bitwiseAND(F.col("__word") - 1))  # zeros below the lowest bit
    ids = _constant(index.rule_ids, "string")
    first = F.when(F.col("__part") >= 0, F.get(ids, F.col("__part") * WORD_BITS + low))
    return found.select(*[F.col(k).alias(c) for k, c in zip(keep, columns)], first.alias("rule_id"))
