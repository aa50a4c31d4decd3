"""Scalar column expressions (JVM-side only)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def quoted(name: str) -> Column:
    """Column by exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def half_up(c: Column, dp: int) -> Column:
    """floor(x * 10^dp + 0.5) / 10^dp; values beyond the exact range pass through."""
    scale = float(10**dp)
    c = c.cast("double")
    rounded = F.floor(c * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)
    return F.when(F.abs(c) < F.lit(1e12), rounded).otherwise(c)


def ratio(num: Column, den: Column) -> Column:
    """Double division, NULL when the denominator is zero."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def clip(c: Column, lower: float | None, upper: float | None) -> Column:
    """Bound a value; NULL stays NULL (``greatest``/``least`` would skip it)."""
    out = c
    if upper is not None:
        out = F.least(F.lit(upper), out)
    if lower is not None:
        out = F.greatest(F.lit(lower), out)
    return F.when(c.isNotNull(), out)


def log1p(c: Column) -> Column:
    """log(1 + x); NULL for x <= -1."""
    return F.when(c > F.lit(-1.0), F.log1p(c))


def is_missing(c: Column) -> Column:
    return c.isNull().cast("byte")


def nan_to_zero(c: Column) -> Column:
    return F.coalesce(F.nanvl(c, F.lit(0.0)), F.lit(0.0))


def hash_order(ident: Column, seed: int | str) -> Column:
    """A reproducible random sort key: the first 60 bits of md5('seed:id')."""
    text = F.concat(F.lit(f"{seed}:"), ident.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
