"""Per-row losses as column expressions; average them to get the usual metric."""

from pyspark.sql import Column
from pyspark.sql import functions as F

CLIP = 1e-7


def clipped(p: Column) -> Column:
    """Away from 0 and 1; NaN and NULL stay what they are, so a diverged model shows."""
    p = p.cast("double")
    return F.when(p.isNull() | F.isnan(p), p).otherwise(_inside(p))


def _inside(p: Column) -> Column:
    return F.least(F.greatest(p, F.lit(CLIP)), F.lit(1.0 - CLIP))


def squared_error(y: Column, yhat: Column) -> Column:
    return (y - yhat) * (y - yhat)


def binary_cross_entropy(y: Column, p: Column) -> Column:
    q = clipped(p)
    return -(y * F.ln(q) + (1.0 - y) * F.ln(1.0 - q))


def categorical_cross_entropy(onehot: Column, probs: Column) -> Column:
    terms = F.zip_with(onehot, probs, lambda y, p: y * F.ln(clipped(p)))
    return -F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x)


def sparse_cross_entropy(label: Column, probs: Column) -> Column:
    return -F.ln(clipped(F.element_at(probs, label.cast("int") + 1)))


def correct(y: Column, yhat: Column) -> Column:
    """A missing prediction or label is not correct."""
    return F.coalesce(y == yhat, F.lit(False)).cast("double")
