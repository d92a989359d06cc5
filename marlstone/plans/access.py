"""Row-level access: rules on entities, which hold for every instance of them that a report reads.

A rule is {"condition": a condition tree, "through": [to-one relations]}. Rows that the condition doesn't hold for are
hidden, and so are those whose related row is hidden, or missing, along a relation of through. Rules sit where entities are read,
before any join: roots, joined and aliased instances, details, trees, and reports in reports have no other way to rows.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..catalog import Catalog
from ..errors import SpecError
from .conditions import findings

#: Rows of an entity for which a condition holds; compile.py gives it, as it resolves paths.
Filtered = Callable[[Catalog, str, dict], DataFrame]


class Restricted(Catalog):
    """A catalog whose rows are those that the rules leave. base is the catalog without them."""

    def __init__(self, base: Catalog, rules: dict[str, dict[str, Any]], filtered: Filtered) -> None:
        super().__init__(base._read, list(base.entities.values()), list(base.relations.values()))
        self.base, self._filtered = base, filtered
        self.rules = {base.entity(name).name: rule for name, rule in rules.items()}
        self._rows: dict[str, DataFrame] = {}
        for name, rule in self.rules.items():
            wrong = [k for k in rule if k not in ("condition", "through")]
            if wrong:
                raise SpecError(f"access rule of {name}: unknown {wrong[0]}")
            if rule.get("condition") and (bad := findings(rule["condition"], f"access rule of {name}")):
                raise SpecError("; ".join(f"{a}: {b}" for a, b in bad))
            self._acyclic(name, ())

    def _steps(self, name: str):
        for hop in self.rules.get(name, {}).get("through", []):
            r = self.base.relation(name, hop)
            if r is None or r.many:
                raise SpecError(f"access rule of {name}: {hop} is no relation to one row")
            yield r

    def _acyclic(self, name: str, seen: tuple[str, ...]) -> None:
        if name in seen:
            raise SpecError(f"access rules lead back to {name}")
        for r in self._steps(name):
            self._acyclic(r.target, (*seen, name))

    def rows(self, name: str) -> DataFrame:
        name = self.entity(name).name
        if name not in self._rows:
            rule = self.rules.get(name, {})
            # the rule itself sees all rows of what its paths reach
            rows = self._filtered(self.base, name, rule["condition"]) if rule.get("condition") else self.base.rows(name)
            for i, r in enumerate(self._steps(name)):
                key = f"_visible{i}"
                rows = rows.join(self.rows(r.target).select(F.col(f"`{r.target_key}`").alias(key)), F.col(f"`{r.source_key}`") == F.col(key), "left_semi")
            self._rows[name] = rows
        return self._rows[name]
