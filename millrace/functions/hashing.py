"""Hash keys, change hashes and record hashes.

Text forms are fixed per type so that a hash never depends on a session setting:
floating-point numbers take their shortest exact text, timestamps a fixed pattern.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import non_blank

# Separator and the stand-in for a missing part.
SEPARATOR = "||"
MISSING = "^^"

_STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def as_text(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, _STAMP)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        # The shortest text that reads back as the same number; zero has one sign.
        return F.when(c == 0, F.lit("0.0")).otherwise(c.cast("string"))
    return c.cast("string")


def key_text(parts: Iterable[Column]) -> Column:
    """The text that a hash key is the digest of. Two keys are equal if and only if these texts are, and a text is a fraction
    of a digest's length, so joins and written tables carry the text and the digest is taken at the end."""
    filled = [F.coalesce(non_blank(F.trim(p)), F.lit(MISSING)) for p in parts]
    return F.upper(F.concat_ws(SEPARATOR, *filled))


def digest(text: Column) -> Column:
    """The hash key of a key text; NULL stays NULL."""
    return F.sha2(text, 256)


def hash_parts(parts: Iterable[Column]) -> Column:
    """SHA-256 hex over text parts: trimmed, blanks replaced, joined, upper-cased."""
    return digest(key_text(parts))


def hash_columns(df: DataFrame, names: Iterable[str]) -> Column:
    """The same hash over named columns of ``df``. Serves as hash key and as change hash."""
    return hash_parts(as_text(F.col(n), df.schema[n].dataType) for n in names)


def packed(rows: DataFrame) -> DataFrame:
    """Change hashes as bytes, half as long as their texts and in the same order."""
    return rows.withColumn("hashdiff", F.unhex("hashdiff"))


def unpacked(rows: DataFrame) -> DataFrame:
    """The inverse of :func:`packed`."""
    return rows.withColumn("hashdiff", F.lower(F.hex("hashdiff")))


def plain_key(c: Column) -> Column:
    """Key recipe of the imperative loader: SHA-256 of the bare text."""
    return F.sha2(c.cast("string"), 256)


def plain_hash(*parts: Column) -> Column:
    """Change hash of the imperative loader; a NULL part counts as empty text."""
    texts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.sha2(F.concat_ws(SEPARATOR, *texts), 256)


def record_hash(df: DataFrame, names: Iterable[str]) -> Column:
    """Record fingerprint of the cleaning job: no trimming, no case folding."""
    texts = [F.coalesce(as_text(F.col(n), df.schema[n].dataType), F.lit("")) for n in names]
    return F.sha2(F.concat_ws(SEPARATOR, *texts), 256)


def canonical_json(c: Column) -> Column:
    """JSON text with sorted keys and no spaces; text that is no JSON stays as it is."""
    return F.coalesce(F.to_json(F.try_parse_json(c)), c)
