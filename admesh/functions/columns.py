import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sums of these stay exact whatever the order of rows: 4 places of price and discount, 16 of a share.
MONEY, RATE = "decimal(18,4)", "decimal(8,4)"
SHARE = "decimal(24,16)"


def sale_value(price: Column, discount: Column) -> Column:
    """Price after discount as an exact decimal."""
    return price.cast(MONEY) * (1 - discount.cast(RATE))


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double, NULL where the whole is 0."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def exact_sum(value: Column) -> Column:
    """Sum of doubles to 16 places, the same in any order of rows."""
    return F.sum(value.cast(SHARE)).cast("double")


def utility_score(affinity: Column, centrality: Column, largest: Column) -> Column:
    """Affinity times centrality relative to the most central user, to 6 places."""
    return F.round(F.coalesce(ratio(affinity * centrality, largest), F.lit(0.0)), 6)


def whole_seconds(start: Column, end: Column) -> Column:
    """Full seconds from one time without a zone to a later one."""
    passed = end - start
    days, hours, minutes, seconds = (F.extract(F.lit(part), passed) for part in ("DAY", "HOUR", "MINUTE", "SECOND"))
    return F.floor(((days * 24 + hours).cast("bigint") * 60 + minutes) * 60 + seconds).cast("bigint")


def id_list(ids: Column) -> Column:
    """An id array as comma-joined text."""
    return F.array_join(F.transform(ids, lambda x: x.cast("string")), ",")


def quantile_bounds(values: DataFrame, column: str, pieces: int) -> list[int]:
    """Up to ``pieces - 1`` ids that cut the column into ranges of about equal count, however the ids are spread."""
    shares = [i / pieces for i in range(1, pieces)]
    return sorted({int(b) for b in values.approxQuantile(column, shares, 0.5 / pieces)}) if shares else []


def range_of(value: Column, bounds: list[int]) -> Column:
    """The number of sorted ``bounds`` below the value, by way of every so-manieth of them."""
    if not bounds:
        return F.lit(0)
    step = math.isqrt(len(bounds) - 1) + 1

    def below(some: Column) -> Column:
        return F.size(F.filter(some, lambda b: b < value))
    first = F.greatest(below(F.lit(bounds[::step])) - 1, F.lit(0)) * step
    return first + below(F.slice(F.lit(bounds), first + 1, F.lit(step)))
