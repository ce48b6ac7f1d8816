"""Pseudonyms and masks for personal data."""

from __future__ import annotations

import os

from pyspark.sql import Column
from pyspark.sql import functions as F


def identity_hash(parts: list[Column], salt: str) -> Column:
    texts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.sha2(F.concat_ws("||", *texts, F.lit(salt)), 256)


def _unless_blank(c: Column, value: Column) -> Column:
    return F.when(F.trim(c) != "", value)


def mask_email(c: Column) -> Column:
    pieces = F.split(F.lower(F.trim(c)), "@")
    stub = F.concat(F.substring(F.get(pieces, F.lit(0)), 1, 2), F.lit("***"))
    return _unless_blank(c, F.concat_ws("@", stub, F.get(pieces, F.lit(1))))


def mask_name(c: Column) -> Column:
    first_word = F.trim(F.get(F.split(c, " "), F.lit(0)))
    return _unless_blank(c, F.concat(F.substring(first_word, 1, 1), F.lit("***")))


def resolve_salt(argument: str | None, *, production: bool, variable: str = "MILLRACE_HASH_SALT") -> str:
    """Environment before argument; a production run without a salt must not start."""
    salt = os.environ.get(variable) or argument or ""
    if production and not salt.strip():
        raise ValueError("a production run needs a hash salt")
    return salt
