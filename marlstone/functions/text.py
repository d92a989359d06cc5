"""Text expressions: letter folds, stamps, redaction, classification, extraction, names. All built from JVM functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Seven letters and the forms that they fold to; ZWNJ counts as a space, direction marks as nothing.
_LETTERS, _FOLDED = "\u064a\u0649\u0643\u0624\u0623\u0625\u0622", "\u06cc\u06cc\u06a9\u0648\u0627\u0627\u0627"
#: The two letters that searches fold.
_TWO, _TWO_FOLDED = "\u064a\u0643", "\u06cc\u06a9"
_ZWNJ, _MARKS = "\u200c", "\u200f\u200e"
_UNICODE_SPACE = r"(?U)\s+"


def fold_match(c: Column) -> Column:
    """Key for matching names: seven letters folded, ZWNJ a space, marks gone, spaces collapsed, trimmed, lower-cased."""
    letters = F.translate(c, _LETTERS + _ZWNJ + _MARKS, _FOLDED + " ")
    return F.lower(F.trim(F.regexp_replace(letters, _UNICODE_SPACE, " ")))


def fold_search(c: Column) -> Column:
    """Key for searching: two letters folded, case folded; spaces stay."""
    return F.replace(F.translate(F.lower(c), _TWO + "\u03c2", _TWO_FOLDED + "\u03c3"), F.lit("\u00df"), F.lit("ss"))


def fold_caption(c: Column) -> Column:
    """Key for captions: two letters folded, ZWNJ a space, spaces collapsed and trimmed, lower-cased."""
    return F.trim(F.regexp_replace(F.translate(F.lower(c), _TWO + _ZWNJ, _TWO_FOLDED + " "), _UNICODE_SPACE, " "))


def tokens(c: Column) -> Column:
    return F.array_remove(F.split(c, _UNICODE_SPACE), "")


#: Fixed value: the date stamp that ends an export's name.
STAMP = r"\s*\(\s*\d{2}-\d{2}-\d{2}[^)]*\)\s*$"


def without_stamp(c: Column) -> Column:
    return F.regexp_replace(c, STAMP, "")


def stamp(c: Column) -> Column:
    """struct(year, month, day, hour, minute) of "(yy-MM-dd HH;mm)" in a name; NULL where there is none. No calendar conversion."""
    pattern = r"\((\d{2})-(\d{2})-(\d{2})\s+(\d{1,2});(\d{2})\)"
    part = lambda i: F.try_to_number(F.nullif(F.regexp_extract(c, pattern, i), F.lit("")), F.lit("99")).cast("int")
    return F.when(F.regexp_extract(c, pattern, 0) != "", F.struct(*(part(i + 1).alias(n) for i, n in enumerate(("year", "month", "day", "hour", "minute")))))


def months_between_stamps(a: Column, b: Column) -> Column:
    """Whole calendar months from stamp a to stamp b, as an absolute distance."""
    return F.abs((b["year"] - a["year"]) * 12 + b["month"] - a["month"])


#: Names of columns, and of keys in text, that hold secrets; and what replaces them.
SENSITIVE = r"(?i)(password|pwd|secret|token|hash|credential|connectionstring)"
_SECRET = r"(?i)(\b(?:password|pwd|secret|apikey|api_key|token|connectionstring)\s*)=\s*[^;\s\"']+"
REDACTED = "***REDACTED***"


def redact(c: Column) -> Column:
    """key = value becomes key=***REDACTED*** for keys that name secrets."""
    return F.regexp_replace(c, _SECRET, f"$1={REDACTED.replace('$', chr(92) + '$')}")


def masked(c: Column, name: str) -> Column:
    """A column whose name is sensitive: REDACTED where it has text, NULL where it is empty; others as they are."""
    import re

    if not re.search(SENSITIVE, name):
        return c
    return F.when(F.length(c.cast("string")) > 0, F.lit(REDACTED))


#: Longer strings are not classified; then the patterns of each class, statements and table names.
MAX_CLASSIFIED = 4000
_SQL = (
    r"(?is)\b(SELECT\s+.+?\s+FROM\s|INSERT\s+INTO\s|UPDATE\s+\w+\s+SET\s|DELETE\s+FROM\s|CREATE\s+(TABLE|VIEW|INDEX|PROCEDURE)\s|"
    r"ALTER\s+TABLE\s|DROP\s+(TABLE|INDEX)\s|TRUNCATE\s+TABLE\s|MERGE\s+INTO\s|EXEC(UTE)?\s+\w)"
)
_URL = r"^(https?|ftp|net\.tcp|tcp)://"
_PATH = r"^[A-Za-z]:\\|^\\\\|^/[a-z]+/"
_FILE = r"(?i)^[\w.]+\.(dll|exe|config|xml|mrt|json|zip|metaexport)$"
_TABLE = r"^(Met_|MET_|met_|Spl_|SPL_|spl_|Shr_|sec_|Sec_|m0[12]_|dyn_|Ver_|ulog_|xapp_)\w+$"
_KEY = r"^[A-Za-z][\w.]{2,60}$"
_OPERATION = r"(?i)^\s*\(*\s*(SELECT|INSERT|UPDATE|DELETE|CREATE|ALTER|DROP|TRUNCATE|MERGE|EXEC|EXECUTE)\b"
_AFTER = r"(?i)\b(?:FROM|JOIN|INTO|UPDATE|TABLE)\s+\[?([A-Za-z_][\w$.]*)\]?"
_NOT_TABLES = ("SELECT", "WHERE", "AND", "OR", "SET")


def classify(c: Column) -> Column:
    """sql, url, path, fileName, table, typeOrConfigKey or other: the first that fits; NULL stays NULL."""
    rules = [("sql", c.rlike(_SQL)), ("url", c.rlike(_URL)), ("path", c.rlike(_PATH)), ("fileName", c.rlike(_FILE)), ("table", c.rlike(_TABLE)), ("typeOrConfigKey", c.rlike(_KEY) & F.contains(c, F.lit(".")))]
    first = F.when(F.length(c) > MAX_CLASSIFIED, "other")
    return reduce(lambda w, r: w.when(r[1], r[0]), rules, first).when(c.isNotNull(), "other")


def sql_operation(c: Column) -> Column:
    """The statement's verb in capitals, UNKNOWN if another word leads; NULL if the text holds no statement."""
    verb = F.upper(F.regexp_extract(c, _OPERATION, 1))
    return F.when(c.rlike(_SQL), F.when(verb == "", "UNKNOWN").otherwise(verb))


def sql_tables(c: Column) -> Column:
    """Sorted distinct names after FROM, JOIN, INTO, UPDATE and TABLE; NULL if the text holds no statement."""
    names = F.regexp_extract_all(c, F.lit(_AFTER), 1)
    return F.when(c.rlike(_SQL), F.array_sort(F.filter(F.array_distinct(names), lambda n: ~F.upper(n).isin(*_NOT_TABLES))))


def acceptance_ids(c: Column) -> Column:
    """Sorted distinct AC-n marks of a text."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(c, F.lit(r"(AC-\d+)"), 1)))


def front_matter(c: Column) -> Column:
    """Text between the first two --- fences; NULL without them."""
    parts = F.split(c, r"(?m)^---\s*$", 3)
    trim = lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")
    return F.when((F.size(parts) == 3) & (trim(parts[0]) == ""), trim(parts[1]))


def first_non_empty(*cols: Column) -> Column:
    """The first that is neither NULL nor empty."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in cols))


def tri_state(c: Column) -> Column:
    """true, false or unknown (NULL) of a text."""
    return F.when(c.isNotNull(), F.lower(F.trim(c)).isin("true", "1", "yes"))


def safe_long(c: Column) -> Column:
    return c.try_cast("long")


def short_name(c: Column, most: int = 60) -> Column:
    """Names over most characters end in ~ and eight digits of a hash."""
    return F.when(F.length(c) > most, F.concat(F.substring(c, 1, most - 9), F.lit("~"), F.upper(F.substring(F.sha2(c, 256), 1, 8)))).otherwise(c)


def record_sign(salt: str, *cols: Column) -> Column:
    """Salted hash over selected fields; NULL and empty differ."""
    return F.sha2(F.concat_ws("\x1f", F.lit(salt), *(F.coalesce(F.concat(F.lit("v"), c.cast("string")), F.lit("n")) for c in cols)), 256)


def priority_score(owned: Column, name: Column, types: Column, terms: list[str]) -> Column:
    """0 unless owned; else 50, 3 for each term that the name holds, and types / 100 up to 10."""
    hits = reduce(lambda a, t: a + F.contains(F.lower(name), F.lit(t)).cast("int"), terms, F.lit(0))
    return F.when(owned, 50 + 3 * hits + F.least(F.floor(types / 100), F.lit(10))).otherwise(0).cast("long")


def valid_slug(c: Column) -> Column:
    """Starts with a word character, has no path part that leads elsewhere."""
    return c.rlike(r"^\w[\w-]*$")


def ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.round(part / whole, 3)).otherwise(F.lit(0.0))
