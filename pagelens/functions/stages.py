"""Keeping costly expressions from being computed more than once."""

from pyspark.sql import Column, DataFrame, functions as F


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row, also inside lambdas that run per element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def computed(df: DataFrame, *names: str) -> DataFrame:
    """Fix columns at this point of the plan.

    Predicates and projections further up would otherwise be rewritten over the expressions behind
    the columns and compute them again. A generator with one output row is a boundary for both and
    stays inside code generation.
    """
    rest = [c for c in df.columns if c not in names]
    fixed = df.select(*rest, F.inline(F.array(F.struct(*[F.col(n).alias(n) for n in names]))))
    return fixed.select(*df.columns)
