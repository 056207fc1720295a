"""Row filters of the feeds and reports."""

from functools import reduce

from pyspark.sql import functions as F

from riskweave import constants as C
from riskweave.functions.coerce import LINE_END, as_col, strip
from riskweave.functions.risk import as_of_lit


def lookback(df, col, as_of, days=C.LOOKBACK_DAYS, null_policy="keep"):
    """Rows not older than `days`; a missing date is kept or dropped by `null_policy`."""
    recent = as_col(col) >= as_of_lit(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")
    if null_policy == "keep":
        recent = recent | as_col(col).isNull()
    return df.filter(recent)


def last_year(incidents, as_of):
    return lookback(incidents, "started_at", as_of, days=365, null_policy="drop")


def modified_between(df, low, high, col="modified_at"):
    return df.filter(as_col(col).between(as_of_lit(low), as_of_lit(high)))


def for_service(df, name, casefold=True):
    key = F.col("service_name")
    return df.filter(F.lower(key) == name.lower()) if casefold else df.filter(key == name)


def cve_only(df):
    return df.filter(F.col("cve_id").startswith("CVE-"))


def search_service(df, text, regex=False):
    """Service name search, case-insensitive; the pattern reading is the other convention."""
    name = F.lower("service_name")
    return df.filter(name.rlike(text.lower())) if regex else df.filter(name.contains(text.lower()))


def min_length(df, col, n):
    return df.filter(F.length(col) >= n)


def any_of(df, conditions, name="flag"):
    """0/1 column: does any condition hold; an unknown condition counts as false."""
    hit = reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in conditions])
    return df.withColumn(name, hit.cast("int"))


def any_case(patterns):
    return "(?i)" + "|".join(patterns)


def keep_lines(text, patterns, min_chars=15):
    """Lines of a text longer than `min_chars` (trimmed) that match no pattern, joined again."""
    kept = F.filter(
        F.split(text, LINE_END),
        lambda line: (F.length(strip(line)) > min_chars) & ~line.rlike(any_case(patterns)))
    return strip(F.array_join(kept, "\n"))


def drop_boilerplate(df, patterns, col="text", min_chars=15):
    return df.withColumn(col, keep_lines(F.col(col), patterns, min_chars))


def topic_gate(df, patterns=C.COMPLIANCE_PATTERNS, col="text"):
    return df.filter(F.col(col).rlike(any_case(patterns)))


def usable_matches(configurations):
    """Vulnerable match entries of a nested configuration list, in document order."""
    nodes = F.flatten(F.transform(configurations, lambda c: F.coalesce(c["nodes"], F.array())))
    matches = F.flatten(F.transform(nodes, lambda n: F.coalesce(n["cpeMatch"], F.array())))
    return F.filter(matches, lambda m: F.coalesce(m["vulnerable"], F.lit(False)))


def not_withdrawn(nodes):
    return nodes.filter(F.coalesce(F.col("advisory.withdrawnAt"), F.lit("")) == "")
