"""Declarative reports: specification, conditions, and their compilation to DataFrame plans."""
