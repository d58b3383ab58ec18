"""Expressions over vectors held as arrays of numbers."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, worked out once however often the body uses it.

    Inside a lambda Spark evaluates an expression at each of its occurrences; a lambda over an
    array of one binds it to a variable instead.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def mean_vector(vectors: Column) -> Column:
    """Mean over an array of equally long vectors; null over none."""

    def mean(vs: Column) -> Column:
        zeros = F.transform(F.get(vs, F.lit(0)), lambda x: F.lit(0.0))
        add = lambda total, v: F.zip_with(total, v, lambda x, y: x + y.cast("double"))
        total = F.aggregate(vs, zeros, add)
        return let(F.size(vs), lambda n: F.transform(total, lambda x: x / n))

    return let(vectors, mean)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity in double precision; 0 beside a zero vector."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return let(norms, lambda n: F.when(n == 0, 0.0).otherwise(dot(a, b) / n))


def has_nan(vector: Column) -> Column:
    return F.exists(vector, lambda x: F.isnan(x))
