"""Column functions. All are built-in expressions: nothing here leaves the JVM."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Accented letters and what they are without accent.
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyy"


def normalize_text(c: Column) -> Column:
    """Lower-cased, without accents, runs of anything but a-z and 0-9 as one underscore."""
    c = F.regexp_replace(F.translate(F.lower(c), ACCENTED, PLAIN), "[^a-z0-9]+", "_")
    return F.regexp_replace(c, "^_+|_+$", "")


def lookup(values: Mapping, key: Column, default=None) -> Column:
    """A literal map's value; default for missing and null keys. For maps of dozens of keys."""
    if not values:
        return F.lit(default)
    found = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in values.items()))[key]
    return found if default is None else F.coalesce(found, F.lit(default))


def ratio(a: Column, b: Column, scale: float = 1.0) -> Column:
    """scale * a / b where b is positive, else null."""
    return F.when(b > 0, scale * a / b)


def degree_days(t: Column, base: float, heating: bool, null_safe: bool = True) -> Column:
    """Degrees below (heating) or above a base, at least 0. Null for null, unless null_safe is off: then 0."""
    gap = F.greatest((F.lit(base) - t) if heating else (t - F.lit(base)), F.lit(0.0))
    return F.when(t.isNotNull(), gap) if null_safe else gap


def cyclic(value: Column, period: float) -> tuple[Column, Column]:
    angle = value * (2 * 3.141592653589793 / period)
    return F.sin(angle), F.cos(angle)
