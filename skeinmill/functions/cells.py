"""Column expressions that decide whether a cell holds a value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What people write in place of a value, in lower case.
FILLERS = (
    "-", "--", "?", "n/a", "n.a.", "n/s", "nil", "none", "not available", "not given",
    "not known", "not stated", "null", "tbd", "unknown", "unspecified",
)

#: Blanks beside the ASCII ones that Java's \\s leaves out.
BLANKS = r"[\s\p{Z}\u0085​﻿]"


def strip_blanks(col: Column) -> Column:
    """The text without white space of any script at either end."""
    return F.regexp_replace(col, f"^{BLANKS}+|{BLANKS}+$", "")


def folded(col: Column) -> Column:
    """Lower case, no blanks around."""
    return F.lower(strip_blanks(col))


def is_blank(col: Column) -> Column:
    """True for null and for text of blanks only; never null."""
    return col.isNull() | (strip_blanks(col) == "")


def is_filler(col: Column) -> Column:
    """True for null, blank and for text that only says there is no value."""
    return col.isNull() | folded(col).isin("", *FILLERS)


def local_name(col: Column) -> Column:
    """A predicate without namespace prefix, blanks and upper case: ``skos:Broader `` is ``broader``."""
    return F.lower(F.regexp_replace(strip_blanks(col), r"^.*[:/#]\s*", ""))
