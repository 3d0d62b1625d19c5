"""Disclosure-control rules as Column expressions: what may be shown of a small count, and how.

Nulls: a null count gives null; a null population counts as none (no population line applies, no rate is given).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values
MIN_POPULATION = 500  # no rate below this population
MAX_SMALL = 2  # counts from 1 to this are never shown
LINE_POPULATION = 100  # population under which counts up to LINE_MAX point at residents
LINE_MAX = 5
SMALL_LABEL, WITHHELD_LABEL = "1-2", "非公開"
CLASS_TOTAL = [3, 6, 12, 24]
CLASS_RATE = [2.0, 5.0, 10.0, 20.0]


def is_small(n: Column) -> Column:
    return n.between(1, MAX_SMALL)


def suppress_rate(n: Column, pop: Column) -> Column:
    """No rate: no population; never for zero; small population; small count. The order decides."""
    p = F.coalesce(pop, F.lit(0))
    return F.when(p <= 0, True).when(n == 0, False).when(p < MIN_POPULATION, True).otherwise(is_small(n))


def bucket_label(n: Column) -> Column:
    return F.when(n <= 0, "0").when(n <= MAX_SMALL, SMALL_LABEL).otherwise(n.cast("string"))


def rate_reason(n: Column, pop: Column) -> Column:
    return F.when(F.coalesce(pop, F.lit(0)) == 0, "no_population").when(suppress_rate(n, pop), "suppressed").otherwise("shown")


def rate_hundredths(n: Column, pop: Column) -> Column:
    """Cases per 1,000 residents in hundredths, exact half-up, null where no rate is shown."""
    return F.when(rate_reason(n, pop) == "shown", F.floor((n * 200000 + pop) / (2 * pop)).cast("bigint"))


def rate_per_1k(n: Column, pop: Column) -> Column:
    return (rate_hundredths(n, pop) / 100).cast("double")


def suppress_count(n: Column, pop: Column) -> Column:
    """Hide the count: small, or few cases among few residents; not where nobody lives or victims outnumber residents."""
    p = F.coalesce(pop, F.lit(0))
    return F.when(n == 0, False).when(is_small(n), True).when((p == 0) | (n > p), False).otherwise((p < LINE_POPULATION) & (n <= LINE_MAX))


def masked(n: Column, pop: Column | None = None) -> Column:
    hide = is_small(n) if pop is None else suppress_count(n, pop)
    return F.when(~hide, n)


def label_for(n: Column) -> Column:
    """Label of a masked value."""
    return F.when(n.isNull(), SMALL_LABEL).otherwise(bucket_label(n))


def label_for_state(state: Column, value: Column, unit: str = "件") -> Column:
    return F.when(state == "withheld", WITHHELD_LABEL).when(state == "small", SMALL_LABEL + unit).otherwise(F.concat(value.cast("string"), F.lit(unit)))


def city_rate(total: Column, pop: Column, hidden: Column) -> Column:
    """``struct<value decimal(12,2), scale int>``: the finest rounding whose step is worth at least ``hidden`` cases; null value
    if none is, or if a non-zero total would show as zero."""
    k = F.greatest(F.coalesce(hidden, F.lit(0)), F.lit(1))
    p = F.coalesce(pop, F.lit(0))
    # step 10^-d per 1,000 is worth pop / 10^(3+d) cases
    scale = F.when(p >= k * 100000, 2).when(p >= k * 10000, 1).when(p >= k * 1000, 0)
    unit = F.when(scale == 2, 100).when(scale == 1, 10).otherwise(1)
    steps = F.floor((total * 2000 * unit + p) / (2 * F.greatest(p, F.lit(1))))
    value = F.when((p > 0) & scale.isNotNull() & ~((steps == 0) & (total != 0)), (steps / unit).cast("decimal(12,2)"))
    return F.struct(value.alias("value"), F.when(value.isNotNull(), scale).cast("int").alias("scale"))


def nice_ceiling(top: Column) -> Column:
    """Smallest 1, 2 or 5 times a power of ten that is not below ``top``; 1 for nothing."""
    t = F.coalesce(top, F.lit(0)).cast("bigint")
    digits = F.length(F.greatest(t, F.lit(1)).cast("string"))
    base = F.rpad(F.lit("1"), digits, "0").cast("bigint")
    return F.when(t <= 0, F.lit(1).cast("bigint")).when(t <= base, base).when(t <= base * 2, base * 2).when(t <= base * 5, base * 5).otherwise(base * 10)


def bar_width(n: Column, scale: Column) -> Column:
    """Width in percent; hidden and zero values have none."""
    return F.when(n.isNull() | (n <= 0) | is_small(n), F.lit(0.0)).otherwise(F.least(F.lit(100.0), n / scale * 100))


def class_of(n: Column, breaks: list) -> Column:
    """Number of the colour class: 0 below the first break; null where the value is hidden."""
    out = F.lit(0)
    for b in breaks:
        out = out + F.when(n >= b, 1).otherwise(0)
    return F.when(n.isNotNull(), out)


def rate_cell(rate: Column, n: Column, pop: Column) -> Column:
    """Text of a rate: two digits, or why there is none."""
    return F.when(rate.isNotNull(), F.format_string("%.2f", rate)).when(rate_reason(F.coalesce(n, F.lit(1)), pop) == "no_population", "人口0").otherwise("—")
