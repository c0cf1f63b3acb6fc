"""Scalar text functions on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A number as it may stand in a text cell; casts alone would take "1d" for 1.0.
NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, "<[^>]*>", "")


def between(c: Column, opening: str, closing: str) -> Column:
    """What stands between the first opening mark and the next closing one; null without an opening mark."""
    return F.get(F.split(F.get(F.split(c, opening, 2), F.lit(1)), closing, 2), F.lit(0))


def to_number(c: Column) -> Column:
    """Double, or null for what is no number."""
    return F.when(c.rlike(NUMBER), F.trim(c)).cast("double")


def mask_secrets(c: Column) -> Column:
    """Hides the values of fields named token, password, secret or key, quoted or not, in any case."""
    return F.regexp_replace(c, r"""(?i)((?:token|password|secret|key)['"]?\s*[=:]\s*['"]?)[^\s'",;&}]+""", "$1******")


def http_status(c: Column) -> Column:
    """The first three-digit code after "status", "code" or "error", or one that begins a reason; null if there is none."""
    found = [F.nullif(F.regexp_extract(c, p, 1), F.lit("")) for p in (r"(?i)status(?:[ _]code)?\D{0,3}(\d{3})\b", r"(?i)\bcode\D{0,3}(\d{3})\b", r"\b([45]\d\d)\b")]
    return F.coalesce(*found).cast("int")


def present(*columns: Column) -> Column:
    """True if none is null or blank."""
    out = F.lit(True)
    for c in columns:
        out = out & F.coalesce(F.trim(c.cast("string")) != "", F.lit(False))
    return out


def alias_of(c: Column, aliases: dict[str, str]) -> Column:
    """The canonical name for a case-insensitive alias; null for unknown ones."""
    out = F.lit(None).cast("string")
    for name, canonical in aliases.items():
        out = F.when(F.lower(F.trim(c)) == name.lower(), F.lit(canonical)).otherwise(out)
    return out
