"""Selectors: "#Key", "#[Target]Key" with parts split by "|", and their escapes. Driver-side values."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..errors import SpecError

#: Characters that a selector escapes.
_ESCAPES = {"\\": "\\\\", "|": "\\|", "[": "\\[", "]": "\\]", "#": "\\#", "/": "\\/"}
_UNESCAPE = re.compile(r"\\(.)")
#: A pattern for columns: what may stand as a selector.
SELECTOR = r"^#(\[[^\]]+\])?\S.*$"


@dataclass(frozen=True)
class Selector:
    parts: tuple[str, ...]
    target: str | None = None

    def __str__(self) -> str:
        body = "|".join("".join(_ESCAPES.get(c, c) for c in p) for p in self.parts)
        return f"#[{self.target}]{body}" if self.target else f"#{body}"


def parse(text: str) -> Selector:
    if not text.startswith("#"):
        raise SpecError(f"a selector starts with #: {text!r}")
    m = re.match(r"#(?:\[([^\]\\]+)\])?(.*)\Z", text, re.S)
    if not m[2]:
        raise SpecError("a selector needs a key")
    parts, held, at = [], "", 0
    body = m[2]
    while at < len(body):
        c = body[at]
        if c == "\\":
            if at + 1 == len(body) or body[at + 1] not in _ESCAPES:
                raise SpecError(f"unknown escape in {text!r}")
            held += body[at + 1]
            at += 2
            continue
        if c == "|":
            parts.append(held)
            held = ""
        else:
            held += c
        at += 1
    return Selector((*parts, held), m[1])


def stable_key(name: str, taken: set[str] = frozenset(), digits: int = 6) -> str:
    """~ and six digits of the hash as a decimal number, longer where that is taken."""
    stream = str(int(hashlib.sha256(name.encode()).hexdigest(), 16))
    while f"~{stream[:digits]}" in taken and digits < len(stream):
        digits += 1
    return f"~{stream[:digits]}"


# The codec for columns: all of it native

#: The six escapes, and what may lie between separators.
_ESCAPED = r"\\([|\[\]@\\#])"
_TO_ESCAPE = r"([|\[\]\\#])"
_PART = r"(?:\\[|\[\]@\\#]|[^|\[\]\\])*"
DECODED = "struct<kind:string,literal:string,target:array<string>,key:array<string>>"


def encoded(key: Column, target: Column | None = None) -> Column:
    """The selector of an array of key parts, and of target parts if there are any: #a|b or #[t]a|b.

    A part's separators, brackets, backslashes and hashes are escaped, and so is a leading @, which would name something built in. NULL
    or no key parts give NULL; an empty key has no selector.
    """
    part = lambda x: F.regexp_replace(F.regexp_replace(x, _TO_ESCAPE, r"\\$1"), "^@", r"\\@")
    joined = lambda parts: F.array_join(F.transform(parts, part), "|")
    body = joined(key)
    whole = F.concat(F.lit("#"), body) if target is None else F.when(F.size(target) > 0, F.concat(F.lit("#["), joined(target), F.lit("]"), body)).otherwise(F.concat(F.lit("#"), body))
    return F.when((F.size(key) > 0) & (body != ""), whole)


def decoded(text: Column) -> Column:
    """A text as struct<kind, literal, target, key>: kind is selector, literal or invalid; NULL for NULL.

    Hashes at the start decide: of an odd number the first makes a selector, and each two of the rest are one hash of
    its key; of an even number each two are one hash of a literal text; without any the text is literal as it is. What
    doesn't follow the grammar, as by an escape that there isn't or an open bracket, is invalid.
    """
    hashes = F.length(F.regexp_extract(text, "^(#*)", 1))
    rest = F.regexp_replace(text, "^#*", "")
    lead = F.repeat(F.lit("#"), F.floor(hashes / 2).cast("int"))
    has_target = (hashes == 1) & rest.startswith("[")
    target = F.regexp_extract(rest, rf"^\[({_PART}(?:\|{_PART})*)\]", 1)
    key = F.when(has_target, F.regexp_replace(rest, rf"^\[{_PART}(?:\|{_PART})*\]", "")).otherwise(rest)
    fits = F.when(has_target, rest.rlike(rf"^\[{_PART}(?:\|{_PART})*\]{_PART}(?:\|{_PART})*$") & (target != "") & (key != "")).otherwise(rest.rlike(rf"^{_PART}(?:\|{_PART})*$") & (F.concat(lead, rest) != ""))
    # a separator is one that no escape holds: parts are read from the front, each with the separator before it
    plain = lambda x: F.regexp_replace(x, _ESCAPED, "$1")
    parts = lambda x: F.transform(F.regexp_extract_all(F.concat(F.lit("|"), x), F.lit(rf"\|({_PART})"), 1), plain)
    none = F.lit(None).cast("array<string>")
    keys = F.transform(parts(key), lambda x, i: F.when(i == 0, F.concat(lead, x)).otherwise(x))
    made = lambda kind, literal, t, k: F.struct(F.lit(kind).alias("kind"), literal.cast("string").alias("literal"), t.alias("target"), k.alias("key"))
    selector = F.when(fits, made("selector", F.lit(None), F.when(has_target, parts(target)), keys)).otherwise(made("invalid", F.lit(None), none, none))
    out = F.when(hashes % 2 == 1, selector).otherwise(made("literal", F.when(hashes == 0, text).otherwise(F.concat(lead, rest)), none, none))
    return F.when(text.isNotNull(), out.cast(DECODED))
