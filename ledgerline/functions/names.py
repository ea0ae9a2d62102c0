"""Naming functions.

Column forms run inside whole-stage codegen over a column of names; the
styles that schemas need too have a driver form read from the same steps.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference for identical names.
# snake_case is two regex passes then lower-case:
#   pass 1: (.)([A-Z][a-z]+)  -> \1_\2
#   pass 2: ([a-z0-9])([A-Z]) -> \1_\2
SNAKE_PASS_1 = r"(.)([A-Z][a-z]+)"
SNAKE_PASS_2 = r"([a-z0-9])([A-Z])"
# Naming classes: snake = ^[a-z][a-z0-9_]*$, camel = ^[a-z][a-zA-Z0-9]*$
SNAKE_CLASS = r"^[a-z][a-z0-9_]*$"
CAMEL_CLASS = r"^[a-z][a-zA-Z0-9]*$"
# Camel guess of the SQL helper: suffix replacements applied in this order,
# then every remaining underscore removed.
CAMEL_GUESS_SUFFIXES = [
    ("_id", "Id"), ("_on", "On"), ("_name", "Name"), ("_code", "Code"),
    ("_type", "Type"), ("_number", "Number"), ("_date", "Date"),
    ("_total", "Total"), ("_tax", "Tax"),
]
BOM = "\ufeff"
# Characters Python's str.strip() treats as white space, as a Java class.
PY_SPACE = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


LOWER = None


class Style:
    """A rule for names: (pattern, replacement) steps and LOWER, in order.
    A column of names and a single name of a schema go through the same steps."""

    def __init__(self, *steps: tuple[str, str] | None):
        self.steps = steps

    def column(self, c: Column) -> Column:
        for step in self.steps:
            c = F.lower(c) if step is LOWER else F.regexp_replace(c, *step)
        return c

    def text(self, name: str) -> str:
        for step in self.steps:
            name = name.lower() if step is LOWER else re.sub(step[0], re.sub(r"\$(\d)", r"\\\1", step[1]), name)
        return name


# F1: words parted by underscores.
SNAKE = Style((SNAKE_PASS_1, "$1_$2"), (SNAKE_PASS_2, "$1_$2"), LOWER)
# ``/`` and ``-`` to ``_``, runs collapsed, edges stripped.
TABLE = Style(("[/-]", "_"), ("_+", "_"), ("^_+|_+$", ""))
# white space, then byte-order marks, stripped from both ends; other
# characters to ``_``; a leading digit gets a prefix.
HEADER = Style((f"^{PY_SPACE}+|{PY_SPACE}+$", ""), (f"^{BOM}+|{BOM}+$", ""), LOWER, ("[^a-z0-9_]", "_"),
               ("^(?=[0-9])", "c_"))

snake, snake_col = SNAKE.text, SNAKE.column
clean_header, clean_header_col = HEADER.text, HEADER.column
table_name_fallback_col = TABLE.column


def camel_col(c: Column) -> Column:
    """first part kept, the others capitalised (rest lower-cased)."""
    parts = F.split(c, "_", -1)
    return F.array_join(
        F.transform(
            parts,
            lambda x, i: F.when(i == 0, x).otherwise(
                F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substring(x, 2, 1 << 30)))),
        ),
        "",
    )


def naming_class_col(c: Column) -> Column:
    """F3."""
    return (F.when(c.rlike(SNAKE_CLASS), F.lit("snake_case"))
            .when(c.rlike(CAMEL_CLASS), F.lit("camelCase"))
            .otherwise(F.lit("other")))


def camel_guess_col(c: Column) -> Column:
    """nested REPLACE guess of the camel twin of a snake name."""
    out = c
    for a, b in CAMEL_GUESS_SUFFIXES:
        out = F.replace(out, F.lit(a), F.lit(b))
    out = F.replace(out, F.lit("_"), F.lit(""))
    return F.when(c.rlike(SNAKE_CLASS), out)


def title_col(c: Column) -> Column:
    """Python's ``str.title``: a letter is upper-cased when the character
    before it is not a letter (start, space, digit, punctuation), otherwise
    lower-cased (``initcap`` only looks at spaces)."""
    chars = F.split(c, "", -1)
    return F.array_join(F.transform(chars, lambda ch, i: F.when(
        (i == 0) | ~F.element_at(chars, i).rlike(r"^\p{L}$"), F.upper(ch)).otherwise(F.lower(ch))), "")


def title_file_name_col(c: Column) -> Column:
    """F16: ``_`` -> space, then title case."""
    return title_col(F.replace(c, F.lit("_"), F.lit(" ")))
