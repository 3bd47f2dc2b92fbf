"""Vector arithmetic on array columns, in double precision."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F


def with_value(value: Column, use: Callable[[Column], Column]) -> Column:
    """Compute a value once and use it in an expression; inside a lambda it would be computed per element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def dot_with(vector: str, values: Sequence[float]) -> Column:
    """Dot product of an array column with a known vector."""
    constant = F.expr(f"array({', '.join(f'{float(v)!r}D' for v in values)})")
    return dot(F.col(vector), constant)


def dot(u: Column, v: Column) -> Column:
    products = F.zip_with(u, v, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def cosine(u: Column, v: Column) -> Column:
    return dot(u, v) / (norm(u) * norm(v))


def unit(v: Column) -> Column:
    """L2-normalised copy; a zero vector becomes null, as its direction is undefined."""

    def scaled(length: Column) -> Column:
        return F.when(length > 0, F.transform(v, lambda x: x.cast("double") / length))

    return with_value(norm(v), scaled)
