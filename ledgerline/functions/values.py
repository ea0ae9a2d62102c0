"""Value functions: coercion (P5), JSON text (F11, F12), log-text clean
(F13), control-character counts and byte size (F14)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Type-name groups of the coercion map and the accepted
# boolean spellings.
INT_TYPES = frozenset({"INT64", "INTEGER", "INT", "SMALLINT", "BIGINT", "BYTEINT"})
FLOAT_TYPES = frozenset({"FLOAT64", "FLOAT", "NUMERIC", "BIGNUMERIC"})
BOOL_TYPES = frozenset({"BOOL", "BOOLEAN"})
TRUE_WORDS = ("true", "1", "yes")
FALSE_WORDS = ("false", "0", "no")


# A decimal number in text.  A cast alone would also take Java's type suffixes
# ("12D", "7f"), which are codes and house numbers here.
NUMERIC = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$|^\s*[+-]?(?i:inf|infinity|nan)\s*$"


def number(c: Column) -> Column:
    """Text -> double; null where it is not a number."""
    return F.when(c.rlike(NUMERIC), c.try_cast("double"))


def coerce_int(c: Column) -> Column:
    """Text -> integer through a double ("3.0" -> 3), truncating toward zero;
    unparsable or non-finite -> null."""
    d = number(c)
    finite = d.isNotNull() & ~F.isnan(d) & (F.abs(d) != F.lit(float("inf")))
    whole = F.when(d < 0, F.ceil(d)).otherwise(F.floor(d))
    return F.when(finite, whole.try_cast("bigint"))


def coerce_float(c: Column) -> Column:
    return number(c)


def coerce_bool(c: Column) -> Column:
    low = F.lower(c)
    return (F.when(low.isin(*TRUE_WORDS), F.lit(True))
            .when(low.isin(*FALSE_WORDS), F.lit(False)))


def coerce_to(c: Column, expected: str) -> Column:
    """P5 for one column of text, given the expected warehouse type name."""
    e = expected.upper()
    if e in INT_TYPES:
        return coerce_int(c)
    if e in FLOAT_TYPES:
        return coerce_float(c)
    if e in BOOL_TYPES:
        return coerce_bool(c)
    return c


def json_text(c: Column) -> Column:
    """value -> JSON text, keeping null fields."""
    return F.to_json(c, {"ignoreNullFields": "false"})


def parse_json_list(c: Column) -> Column:
    """JSON text -> array<variant>; bad or non-list text -> empty list."""
    v = F.try_parse_json(c)
    arr = F.try_variant_get(v, "$", "array<variant>")
    return F.coalesce(arr, F.array().cast("array<variant>"))


# F13 fixed patterns: verb + URL prefix, trailing location/reason fragments.
VERB_URL = r"(?:GET|POST|PUT|DELETE)\s+https?://[^\s]+:\s*"
LOCATION_FRAGMENT = r",\s*location:\s*\w+"
REASON_FRAGMENT = r";\s*reason:\s*\w+"


def _cut_at(t: Column, sep: str) -> Column:
    return F.substring_index(t, sep, 1)


# Line breaks of Python's str.splitlines(), as a Java pattern.
LINE_BREAKS = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once for all of its uses."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _without(t: Column, pattern: str, sign: str) -> Column:
    """Drop what matches ``pattern``; only texts that hold ``sign`` can."""
    return F.when(t.contains(sign), F.regexp_replace(t, pattern, "")).otherwise(t)


def clean_log_text(c: Column) -> Column:
    """F13 as one Column expression over a log table.

    Drops ``VERB http...:`` prefixes; cuts the text at the first
    ``\\n\\nLocation:``, else ``\\nLocation:``, else ``Location:``; drops lines
    starting with ``Job ID:`` or ``Location:``; removes ``, location: x`` and
    ``; reason: x`` fragments and blank lines.  Each step is one pass over the
    text, and a pass is left out where plain text search finds no need for it.
    """
    def cut(t: Column) -> Column:
        return (F.when(t.contains("\n\nLocation:"), _cut_at(t, "\n\nLocation:"))
                .when(t.contains("\nLocation:"), _cut_at(t, "\nLocation:"))
                .when(t.contains("Location:"), _cut_at(t, "Location:"))
                .otherwise(t))

    lines = F.split(_let(_without(c, VERB_URL, "http"), cut), LINE_BREAKS, -1)
    lines = F.filter(lines, lambda x: ~x.rlike(r"\A\s*(?:Job ID:|Location:)"))
    lines = F.transform(lines, lambda x: _let(_without(x, LOCATION_FRAGMENT, "location:"),
                                              lambda y: _without(y, REASON_FRAGMENT, "reason:")))
    lines = F.filter(lines, lambda x: x.rlike(r"\S"))
    return F.rtrim(F.array_join(lines, "\n"), F.lit(" \t\n\x0b\f\r"))


def control_counts(c: Column) -> dict[str, Column]:
    """escaped and real control characters, and size in bytes."""
    def count(pattern: str) -> Column:
        return F.coalesce(F.regexp_count(c, F.lit(pattern)), F.lit(0)).cast("bigint")
    return {
        "escaped_crlf": count(r"\\r\\n"),
        "escaped_cr": count(r"\\r"),
        "escaped_lf": count(r"\\n"),
        "escaped_tab": count(r"\\t"),
        "real_cr": count("\r"),
        "real_lf": count("\n"),
        "real_tab": count("\t"),
        "n_bytes": F.octet_length(c).cast("bigint"),
    }
