"""Exceptions raised while reading or compiling a rule document."""


class RuleConfigError(ValueError):
    """A rule, condition or outcome in the document cannot be turned into a
    Spark expression (bad operator, bad literal, broken join, cycle, ...).

    Rule evaluation catches it and reports the message as a rejected rule
    instead of letting Spark fail later on a half-built query.
    """
