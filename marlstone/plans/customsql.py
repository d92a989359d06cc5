"""A narrow door for custom SQL: an expression, screened, with a shim for three date functions of another dialect."""

from __future__ import annotations

import re
from datetime import datetime

from ..errors import UnsupportedSemantics

_FUNCTIONS = {"abs", "ceil", "coalesce", "concat", "dateadd", "datediff", "floor", "getdate", "greatest", "isnull", "least", "length", "lower", "nullif", "round", "substring", "trim", "upper", "year", "month", "day", "and", "or", "in", "not", "between", "case", "when", "then", "else", "cast"}
_UNITS = {"day": "DAY", "week": "WEEK", "month": "MONTH", "year": "YEAR", "hour": "HOUR", "minute": "MINUTE"}
_REFUSED = re.compile(r";|--|/\*|\b(select|insert|update|delete|drop|create|alter|exec|execute|union|from|join|into|grant|reflect|java_method|transform)\b", re.I)


def screened(sql: str, as_of: datetime | None = None) -> str:
    """The expression in Spark's dialect; statements, comments, subqueries and unlisted functions are refused."""
    bare = re.sub(r"'(?:[^']|'')*'", "''", sql)
    if m := _REFUSED.search(bare):
        raise UnsupportedSemantics(f"custom SQL may not use {m[0]}")
    for name in re.findall(r"\b([A-Za-z_]\w*)\s*\(", bare):
        if name.lower() not in _FUNCTIONS:
            raise UnsupportedSemantics(f"custom SQL may not call {name}")

    def now(_: re.Match) -> str:
        if as_of is None:
            raise UnsupportedSemantics("GETDATE() needs as_of")
        return f"TIMESTAMP '{as_of:%Y-%m-%d %H:%M:%S}'"

    def unit(m: re.Match) -> str:
        if m[2].lower() not in _UNITS:
            raise UnsupportedSemantics(f"unknown date part {m[2]}")
        return f"{'timestampadd' if m[1].lower() == 'dateadd' else 'timestampdiff'}({_UNITS[m[2].lower()]},"

    sql = re.sub(r"\bgetdate\s*\(\s*\)", now, sql, flags=re.I)
    sql = re.sub(r"\b(dateadd|datediff)\s*\(\s*(\w+)\s*,", unit, sql, flags=re.I)
    return re.sub(r"\bisnull\s*\(", "coalesce(", sql, flags=re.I)
