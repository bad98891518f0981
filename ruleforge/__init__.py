"""ruleforge: business rules written as data, run as native Spark expressions."""

from .errors import RuleConfigError
from .operators.evaluate import RuleResult, call_rule, run_rule
from .sources.ruleset import RuleSet

__all__ = ["RuleConfigError", "RuleResult", "RuleSet", "call_rule", "run_rule"]
