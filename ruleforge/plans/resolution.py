"""Resolve a rule call to the rules that make up its result (metadata only).

Given the four call parameters (process, process_key, rule id, is_lookup) this
module picks the rule, checks it is switched on and inside its validity
window, and follows ``goto`` outcomes to the end of the chain. Nothing here
touches data or starts a Spark job: the rule list is already on the driver.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from ..errors import RuleConfigError
from ..sources.ruleset import Rule, RuleSet

# Process keys and the status messages a rule call reports.
LOOKUP_KEYS = ("query_lookup", "value_lookup", "groupby_lookup", "conditional")
BUILDER_KEYS = ("query_builder", "transformation")
KNOWN_KEYS = LOOKUP_KEYS + BUILDER_KEYS

MSG_UNMATCHED = "Rules are not configured for the combination of parameters passed."
MSG_DISABLED = "Rule {} is not valid and is skipped"
MSG_OUT_OF_RANGE = "Rule {} and {} are out of range and is skipped"
MSG_INVALID_KEY = "Invalid Process key."
MSG_QUERY_LOOKUP = "Successfully returning the lookup query"
MSG_QUERY_BUILDER = "Successfully returning the dynamically generated query"
MSG_VALUE_FOUND = "Successfully returning the lookup value <{}> for the value key <{}>."
MSG_VALUE_MISSING = "Value key {} requested not found in the json config file, please setup the value."
MSG_VALUE_LIST = "Successfully returning the list of lookup values <{}>."
MSG_VALUE_LIST_BAD = "Unable to return the list of lookup values, please validate the json file."
MSG_CONDITIONAL_BAD = "Conditional process without proper condition setup."

RULE_DATE_FORMAT = "%d/%m/%Y"  # day/month/year, zero padding optional


ANY_DAY = dt.date.min  # as_of of a call whose windows are tested on each row's own date


def window_bounds(rule: Rule) -> list[tuple[str, str]]:
    """The rule's validity window as (operator, ISO day) conditions on a row's date (the last day is whole)."""
    start, end = parse_rule_date(rule.valid_from), parse_rule_date(rule.valid_till)
    bounds = [(">=", start.isoformat())]
    if end < dt.date.max:
        bounds.append(("<", (end + dt.timedelta(days=1)).isoformat()))
    return bounds


def window_sql(rule: Rule, row_date: str) -> str:
    """The rule's validity window on a row's date or timestamp, as SQL."""
    return " and ".join(f"({row_date}) {op} date'{day}'" for op, day in window_bounds(rule))


def parse_rule_date(text: str | None) -> dt.date | None:
    try:
        return dt.datetime.strptime((text or "").strip(), RULE_DATE_FORMAT).date()
    except ValueError:
        return None


def lookup_flag(is_lookup) -> str:
    """Call parameter ``is_lookup`` as the document spells it."""
    if isinstance(is_lookup, bool):
        return "true" if is_lookup else "false"
    return "" if is_lookup is None else str(is_lookup).strip()


def inactive_reason(rule: Rule, as_of: dt.date) -> str | None:
    """Why a rule may not run on ``as_of`` (None when it may)."""
    if rule.is_valid != "true":
        return MSG_DISABLED.format(rule.id)
    start, end = parse_rule_date(rule.valid_from), parse_rule_date(rule.valid_till)
    if start is None or end is None:
        return "Rule {} has an unreadable validity window ({!r}, {!r})".format(
            rule.id, rule.valid_from, rule.valid_till)
    if as_of != ANY_DAY and not start <= as_of <= end:
        return MSG_OUT_OF_RANGE.format(start, end)
    return None


@dataclass(frozen=True)
class Resolution:
    valid_params: bool
    rule_validity: bool
    message: str
    rule: Rule | None = None               # the rule the call selected
    links: tuple[Rule, ...] = field(default_factory=tuple)  # builder chain

    @property
    def accepted(self) -> bool:
        return self.rule_validity and self.rule is not None


def first_usable(ruleset: RuleSet, rule_id: str, as_of: dt.date) -> Rule:
    """Goto-target lookup: first rule with this id (id only, document order)
    that has conditions. A disabled or expired match rejects the chain."""
    for rule in ruleset.find(rule_id):
        reason = inactive_reason(rule, as_of)
        if reason:
            raise RuleConfigError(reason)
        if rule.conditions:
            return rule
    raise RuleConfigError(f"Rule {rule_id} is not configured or has no conditions")


def follow_gotos(ruleset: RuleSet, start: Rule, as_of: dt.date,
                 include_start: bool = True) -> tuple[Rule, ...]:
    """``start`` plus every rule reached through ``goto`` outcomes."""
    links = [start] if include_start else []
    seen = [start.id]
    current = start
    while current.is_goto:
        target_id = current.then_value
        if not target_id:
            raise RuleConfigError(f"Rule {current.id} has a goto without a target rule id")
        if target_id in seen:
            raise RuleConfigError("goto cycle: " + " -> ".join(seen + [target_id]))
        target = first_usable(ruleset, target_id, as_of)
        if target.process_key != "query_builder":
            raise RuleConfigError(
                f"goto target {target_id} is a {target.process_key or 'keyless'} rule; "
                "only query_builder rules can be chained")
        links.append(target)
        seen.append(target_id)
        current = target
    return tuple(links)


def resolve(ruleset: RuleSet, process: str, process_key: str, rule_id: str,
            is_lookup, as_of: dt.date | None = None) -> Resolution:
    """Select the rule for a call and resolve its chain.

    The first rule matching all four parameters decides: switched off or
    outside its window -> rejected; without conditions -> the next match is
    tried; otherwise it is used.
    """
    as_of = as_of or dt.date.today()
    want = (process.strip(), process_key.strip(), rule_id.strip(), lookup_flag(is_lookup))
    matched = None
    for rule in ruleset.find(want[2]):  # same-id rules, document order
        if (rule.process, rule.process_key, rule.id, rule.is_lookup) != want:
            continue
        matched = rule
        reason = inactive_reason(rule, as_of)
        if reason:
            return Resolution(True, False, reason, rule)
        if rule.conditions:
            return _accept(ruleset, rule, as_of)
    if matched is not None:
        return Resolution(True, False, f"Rule {matched.id} has no conditions", matched)
    return Resolution(False, False, MSG_UNMATCHED)


def _accept(ruleset: RuleSet, rule: Rule, as_of: dt.date) -> Resolution:
    key = rule.process_key
    if key not in KNOWN_KEYS:
        return Resolution(True, False, MSG_INVALID_KEY, rule)
    if key in LOOKUP_KEYS and rule.is_lookup != "true":
        return Resolution(True, False, f"Rule {rule.id}: {key} rules need is_lookup true", rule)
    if key in BUILDER_KEYS and rule.is_lookup == "true":
        return Resolution(True, False, f"Rule {rule.id}: {key} rules need is_lookup false", rule)
    try:
        if key == "query_builder":
            return Resolution(True, True, MSG_QUERY_BUILDER, rule, follow_gotos(ruleset, rule, as_of))
        if key == "conditional":
            if not rule.is_goto:
                return Resolution(False, True, MSG_CONDITIONAL_BAD, rule)
            return Resolution(True, True, MSG_QUERY_BUILDER, rule,
                              follow_gotos(ruleset, rule, as_of, include_start=False))
    except RuleConfigError as e:
        return Resolution(True, False, str(e), rule)
    return Resolution(True, True, "", rule)


def resolve_by_id(ruleset: RuleSet, rule_id: str, as_of: dt.date | None = None) -> Resolution:
    """Resolve a builder / conditional rule by id alone (many-rule evaluation)."""
    as_of = as_of or dt.date.today()
    try:
        rule = first_usable(ruleset, rule_id, as_of)
    except RuleConfigError as e:
        return Resolution(bool(ruleset.find(rule_id)), False, str(e))
    if rule.process_key not in ("query_builder", "conditional"):
        return Resolution(True, False, f"Rule {rule_id} is a {rule.process_key} rule, not a predicate", rule)
    return _accept(ruleset, rule, as_of)
