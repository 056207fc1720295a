"""Column formulas of the two score families."""

import math

from pyspark.sql import functions as F

from riskweave import constants as C
from riskweave.functions.coerce import as_col
from riskweave.functions.rounding import round_sql


def whole_days(earlier, later):
    """Whole days between two zone-less timestamps, floored (one second in the future is -1)."""
    start, end = as_col(earlier), as_col(later)
    wrapped = time_of_day(start) > time_of_day(end)
    return F.datediff(end, start) - F.when(wrapped, 1).otherwise(0)


def seconds_between(start, end):
    """Seconds from one zone-less timestamp to another as an exact decimal, whatever the session zone."""
    a, b = as_col(start), as_col(end)
    second = lambda t: F.extract(F.lit("SECOND"), t)
    return (F.datediff(b, a).cast("bigint") * 86400 + (F.hour(b) - F.hour(a)) * 3600
            + (F.minute(b) - F.minute(a)) * 60 + (second(b) - second(a))).cast("decimal(18,6)")


def time_of_day(ts):
    return ts - ts.cast("date").cast("timestamp_ntz")


def age_days(col, as_of):
    return whole_days(col, as_of_lit(as_of))


def as_of_lit(as_of):
    return F.lit(as_of).cast("timestamp_ntz")


def decay(name, as_of, half_life=C.HALF_LIFE_DAYS):
    """Half-life weight of an age in whole days, 4 places; unknown age is 0.5."""
    now = f"TIMESTAMP_NTZ '{as_of}'"
    day = lambda t: f"({t} - CAST(CAST({t} AS DATE) AS TIMESTAMP_NTZ))"
    age = f"(datediff({now}, `{name}`) - IF({day(f'`{name}`')} > {day(now)}, 1, 0))"
    raw = f"exp({-math.log(2)!r}D * {age} / {float(half_life)!r}D)"
    return F.expr(f"coalesce({round_sql(raw, 4)}, 0.5D)")


def severity_ordinal(col):
    word = F.upper(as_col(col))
    out = F.when(F.lit(False), F.lit(0.0))
    for name, value in C.SEVERITY_ORDINALS.items():
        out = out.when(word == name, F.lit(value))
    return out.otherwise(F.lit(C.OTHER_SEVERITY_ORDINAL))


def is_major(col):
    return F.coalesce(F.lower(as_col(col)).isin(*C.MAJOR_SEVERITIES), F.lit(False))


def risk_band(col, low=C.BAND_LOW, high=C.BAND_HIGH):
    """Right-closed bands; exactly 0 and anything above 1 has no band."""
    x = as_col(col)
    return (
        F.when((x > 0) & (x <= low), "Low")
        .when((x > low) & (x <= high), "Medium")
        .when((x > high) & (x <= 1.0), "High")
    )


def level_at_or_above(col, low=C.BAND_LOW, high=C.BAND_HIGH):
    """Level words of the drill-down, where a value on the boundary takes the higher word."""
    x = as_col(col)
    return F.when(x >= high, "HIGH").when(x >= low, "MEDIUM").otherwise("LOW")
