"""Small ``Column`` building blocks shared by every operator."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dbl(c: str | Column) -> Column:
    return col(c).cast("double")


def clamp(value: Column, low: float, high: float) -> Column:
    """Value limited to [low, high]."""
    return F.least(F.lit(float(high)), F.greatest(F.lit(float(low)), value))


def at_least(value: Column, bands: Iterable[tuple], below) -> Column:
    """Result of the first band whose lower bound the value reaches."""
    bands = list(bands)
    head = F.when(value >= F.lit(bands[0][0]), F.lit(bands[0][1]))
    chain = reduce(lambda acc, b: acc.when(value >= F.lit(b[0]), F.lit(b[1])), bands[1:], head)
    return chain.otherwise(F.lit(below))


def above(value: Column, bands: Iterable[tuple], below) -> Column:
    """Like :func:`at_least` with strict lower bounds."""
    bands = list(bands)
    head = F.when(value > F.lit(bands[0][0]), F.lit(bands[0][1]))
    chain = reduce(lambda acc, b: acc.when(value > F.lit(b[0]), F.lit(b[1])), bands[1:], head)
    return chain.otherwise(F.lit(below) if not isinstance(below, Column) else below)


def under(value: Column, bands: Iterable[tuple], above_all) -> Column:
    """Result of the first band whose (exclusive) upper bound exceeds the value."""
    bands = list(bands)
    head = F.when(value < F.lit(bands[0][0]), F.lit(bands[0][1]))
    chain = reduce(lambda acc, b: acc.when(value < F.lit(b[0]), F.lit(b[1])), bands[1:], head)
    return chain.otherwise(F.lit(above_all))


def lookup(key: Column, table: Mapping, default=None) -> Column:
    """Literal map lookup: a broadcast-free dimension join for tables fixed in code."""
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    found = F.try_element_at(F.create_map(*pairs), key)
    if default is None:
        return found
    return F.coalesce(found, default if isinstance(default, Column) else F.lit(default))


def hit(condition: Column) -> Column:
    """Condition as a definite boolean: unknown counts as not hit."""
    return F.coalesce(condition, F.lit(False))


def flag(condition: Column) -> Column:
    """Definite condition as 0/1."""
    return hit(condition).cast("int")


def count_of(conditions: Iterable[Column]) -> Column:
    """How many of the conditions hold on this row."""
    return reduce(lambda a, b: a + b, [flag(c) for c in conditions])


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, [hit(c) for c in conditions])


def pct(part: Column, whole: Column) -> Column:
    """Share in percent, null for an empty whole."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * F.lit(100.0)


def share(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))


def month_index(d: Column) -> Column:
    return F.year(d) * 12 + F.month(d)


def months_between(later: Column, earlier: Column) -> Column:
    """Calendar month boundaries crossed (not completed months)."""
    return month_index(later) - month_index(earlier)


def month_start(d: Column) -> Column:
    return F.trunc(d, "month")


def sum_if(value: Column, condition: Column) -> Column:
    return F.sum(F.when(condition, value).otherwise(F.lit(0.0)))


def avg_if(value: Column, condition: Column) -> Column:
    return F.avg(F.when(condition, value))


def bins(value: Column, low: Column, high: Column, n: int) -> Column:
    """1-based histogram bin of equal width; the top edge belongs to the last bin, and one value alone to the first."""
    raw = F.floor(F.try_divide(value - low, (high - low) / n)).cast("int") + 1
    return F.when(value.isNotNull(), F.least(F.lit(n), F.greatest(F.lit(1), F.coalesce(raw, F.lit(1)))))
