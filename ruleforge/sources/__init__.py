"""Readers and writers: rule documents, transaction files, sinks."""

from .ruleset import RULESET_SCHEMA, Condition, Rule, RuleSet

__all__ = ["RULESET_SCHEMA", "Condition", "Rule", "RuleSet"]
