"""Column-level building blocks: predicates and JSON lookups."""

from .json_lookup import json_entries, json_object, json_typed, json_value, lookup_table
from .predicates import CompiledPredicate, compile_chain, fold_precedence

__all__ = ["CompiledPredicate", "compile_chain", "fold_precedence",
           "json_entries", "json_object", "json_typed", "json_value", "lookup_table"]
