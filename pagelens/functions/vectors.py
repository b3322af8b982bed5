"""Arithmetic on array<double> columns."""

from pyspark.sql import Column, functions as F

from pagelens.functions.stages import let


def as_double(v: Column) -> Column:
    return v.cast("array<double>")


def total(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def norm(v: Column) -> Column:
    """Euclidean length."""
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x))


def unit(v: Column) -> Column:
    """Vector of length one; NULL for the zero vector, which has no direction."""
    return let(norm(v), lambda length: F.when(length > 0, F.transform(v, lambda x: x / length)))


def shares(v: Column) -> Column:
    """Vector divided by its sum."""
    return let(total(v), lambda whole: F.transform(v, lambda x: x / whole))


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def threshold(prob: Column, at: float = 0.5, inclusive: bool = True) -> Column:
    """1 where the probability reaches (``inclusive``) or exceeds the threshold, else 0."""
    passed = prob >= at if inclusive else prob > at
    return F.when(passed, 1).otherwise(0)


def _decimal_text(x: Column, digits: int) -> Column:
    """Decimal text rounded from the exact binary value, ties to even, as Python and C print it.

    ``format_number`` does that except for half a unit of the last digit, which is spelled out.
    """
    x = x.cast("double")
    half = float(f"5e-{digits + 1}")
    text = F.replace(F.format_number(x, digits), F.lit(","), F.lit(""))
    return (F.when(x == half, f"{half:.{digits}f}").when(x == -half, f"{-half:.{digits}f}").otherwise(text))


def rounded(x: Column, digits: int = 3) -> Column:
    """Python's ``round`` for doubles."""
    return _decimal_text(x, digits).cast("double")


def percent(x: Column, digits: int = 1) -> Column:
    """0.123 -> '12.3%'."""
    return F.concat(_decimal_text(x * 100, digits), F.lit("%"))


def thousands(x: Column) -> Column:
    """1234567 -> '1,234,567'."""
    return F.format_number(x, 0)
