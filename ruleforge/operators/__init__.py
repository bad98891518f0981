"""DataFrame operators built from rules."""

from .evaluate import RuleResult, call_rule, run_rule

__all__ = ["RuleResult", "call_rule", "run_rule"]
