"""Column expressions on image and vector arrays (JVM-side higher-order functions)."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row.

    A column that stands inside a lambda may be replaced by the expression that
    defines it and then run again for every element.
    """
    return F.transform(F.array(value), use)[0]


def argmax_index(scores: Column) -> Column:
    """0-based position of the largest score, the first one on ties."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def indicator(label: Column, k: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: (i == label).cast("double"))


def to_rows(flat: Column, height: int, width: int) -> Column:
    return let(flat, lambda a: F.transform(F.sequence(F.lit(0), F.lit(height - 1)), lambda r: F.slice(a, r * width + 1, F.lit(width))))


def moved(values: Column, by: Column, size: int) -> Column:
    """An array's elements moved ``by`` places towards its end, the edge element repeated."""
    ahead = F.least(F.greatest(by, F.lit(0)), F.lit(size))
    back = F.least(F.greatest(-by, F.lit(0)), F.lit(size))
    kept = F.slice(values, back + 1, F.greatest(size - ahead - back, F.lit(0)))
    return F.concat(F.array_repeat(F.element_at(values, 1), ahead), kept, F.array_repeat(F.element_at(values, -1), back))
