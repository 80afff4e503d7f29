"""Column expressions for tag text and display names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cotag.schemas import UNKNOWN

# The Unicode space separators (category Zs). ``trim`` alone strips only U+0020.
SPACE_SEPARATORS = (
    "\u0020\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
)

# All white space and the separators of control that count as such.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\u0020\u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Remove all white space from both ends, tabs and line ends included."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def trim_spaces(text: Column) -> Column:
    """Strip every Unicode space separator from both ends; tabs and newlines stay.

    Text of single bytes can hold only the plain space, for which Spark has a far cheaper trim.
    """
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.trim(text)).otherwise(F.btrim(text, F.lit(SPACE_SEPARATORS)))


def is_blank(text: Column) -> Column:
    """NULL, empty, or nothing but space separators."""
    return text.isNull() | (trim_spaces(text) == "")


def clean_account(part: Column) -> Column:
    """Drop one leading ``@`` and all trailing dots, then lower the case."""
    undotted = F.when(part.endswith("."), F.rtrim(part, F.lit("."))).otherwise(part)
    bare = undotted.substr(F.lit(2), F.length(part))
    return F.lower(F.when(part.startswith("@"), bare).otherwise(undotted))


def known_name(name: Column) -> Column:
    """Aggregate: the greatest name that is not ``unknown``, NULL when there is none."""
    return F.max(F.nullif(name, F.lit(UNKNOWN)))


def best_name(name: Column) -> Column:
    """Aggregate: the greatest known name, ``unknown`` when there is none."""
    return F.coalesce(known_name(name), F.lit(UNKNOWN))
