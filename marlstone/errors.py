"""Errors that a specification can cause."""


class SpecError(ValueError):
    """The specification is wrong: unknown names, missing values, contradictions."""


class UnsupportedSemantics(SpecError):
    """The clause is known by name only; guessing its meaning would give wrong rows."""
