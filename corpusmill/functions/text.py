"""Text and key expressions; all run inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ustrip(c: Column | str) -> Column:
    """Without white space of any Unicode kind at the ends (``trim`` takes only spaces)."""
    return F.regexp_replace(_col(c), r"(?U)^\s+|\s+$", "")


def squash(c: Column | str) -> Column:
    """Runs of white space as one space, none at the ends; case is kept."""
    return ustrip(F.regexp_replace(_col(c), r"(?U)\s+", " "))


def norm(c: Column | str) -> Column:
    """Lower case, runs of white space as one space, none at the ends. Null stays null."""
    return squash(F.lower(_col(c)))


def norm_or_null(c: Column | str) -> Column:
    """``norm``, with the empty text as null."""
    return F.nullif(norm(c), F.lit(""))


def key(c: Column | str) -> Column:
    """Lower case without white space at the ends; inner white space is kept."""
    return ustrip(F.lower(_col(c)))


def reference_key(c: Column | str, *, wrapper: str = "objectid", placeholders: tuple[str, ...] = ("", "null", "none")) -> Column:
    """A stored reference in its plain form: lower case, stripped, ``wrapper('...')`` removed, placeholders as null."""
    plain = ustrip(F.regexp_replace(key(c), rf"^{wrapper}\(\s*[\"']?(.*?)[\"']?\s*\)$", "$1"))
    return F.when(~plain.isin(*placeholders), plain)


def band(c: Column | str, null_label: str | None = None) -> Column:
    """Confidence band ``<0.5``, ``0.5-0.8`` or ``>=0.8``; null and NaN get ``null_label``."""
    x = _col(c)
    return (
        F.when(x.isNull() | F.isnan(x), F.lit(null_label))
        .when(x < 0.5, "<0.5")
        .when(x < 0.8, "0.5-0.8")
        .otherwise(">=0.8")
    )
