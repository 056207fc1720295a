"""Rounding on the exact binary value, half to even, as a column expression."""

from pyspark.sql import functions as F

SPLITTER = "134217729D"  # 2^27 + 1, Veltkamp split of a double


def round_sql(x, digits):
    """SQL text that rounds the double expression `x` to `digits` places by its exact binary value.

    Spark's own `round` and `bround` look at the printed decimal, so 2.675 gives 2.68 where the
    stored number is just below the half. Only a scaled value that lands on a half needs more:
    there the sign of the product's rounding error decides, and a true half goes to even.
    """
    s = f"{10 ** digits}D"
    p = f"({x} * {s})"
    high = f"({x} * {SPLITTER} - ({x} * {SPLITTER} - {x}))"
    error = f"(({high} * {s} - {p}) + ({x} - {high}) * {s})"
    return (f"(CASE WHEN {p} - floor({p}) = 0.5D AND {error} <> 0D "
            f"THEN floor({p}) + IF({error} > 0D, 1, 0) ELSE rint({p}) END / {s})")


def round_exact(name, digits):
    """Column `name` rounded; compute the value as a column first, as it is used several times."""
    return F.expr(round_sql(f"CAST(`{name}` AS DOUBLE)", digits))


def clamp(value, low, high):
    return F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), value))
