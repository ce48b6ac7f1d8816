"""Text cleaning shared by the staging tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def non_blank(c: Column) -> Column:
    """``c``, or NULL where it is empty. Not ``nullif``: it gives its operand a name, and with a dozen of these in one change hash
    the planner tries a filter on the hash in all combinations of names and texts."""
    return F.when(c != "", c)


def blank_to_null(c: Column) -> Column:
    return non_blank(F.trim(c))


def clean_upper(c: Column) -> Column:
    return F.upper(blank_to_null(c))


def clean_lower(c: Column) -> Column:
    return F.lower(blank_to_null(c))


def leading(c: Column, n: int) -> Column:
    """First ``n`` characters, with an empty result turned into NULL."""
    return non_blank(F.left(c, F.lit(n)))


def identifier_token(c: Column) -> Column:
    """Replaces everything that may not stand in a table name by an underscore."""
    return F.regexp_replace(c, "[^0-9a-zA-Z_]", "_")


def email_domain(c: Column) -> Column:
    return F.split_part(c, F.lit("@"), F.lit(2))


# Fixed value: accepted address form; the star is legal because masks contain it.
EMAIL_PATTERN = r"(?i)^[A-Za-z0-9.*_%-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"


def email_is_valid(c: Column) -> Column:
    return c.rlike(EMAIL_PATTERN)
