"""Policy files and their rules."""

from pyspark.sql import functions as F

from riskweave.functions.coerce import as_col

POLICY = (
    "org_name string, regulatory_frameworks array<string>, compensating_controls array<string>,"
    " service_tiers map<string,int>, dimension_weight_overrides map<string,double>,"
    " patch_sla_days struct<CRITICAL:int,HIGH:int,MEDIUM:int,LOW:int>")


def violations(df):
    """Array of broken rules per policy."""
    has = set(df.columns)
    col = lambda c: as_col(c) if c in has else F.lit(None)
    rules = [
        (F.coalesce(F.length(col("org_name").cast("string")), F.lit(0)) < 1, "org_name"),
        (col("regulatory_frameworks").isNull(), "regulatory_frameworks"),
        (col("compensating_controls").isNull(), "compensating_controls"),
    ]
    if "service_tiers" in has:
        rules.append((F.exists(F.map_values("service_tiers"), lambda t: t.isNull() | ~t.between(1, 3)),
                      "service_tiers"))
    if "dimension_weight_overrides" in has:
        rules.append((F.exists(F.map_values("dimension_weight_overrides"), lambda w: w.isNull() | ~w.between(0.0, 1.0)),
                      "dimension_weight_overrides"))
    return F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for bad, name in rules]))


def check_policies(df):
    """(valid policies, rejected ones with their violations)."""
    judged = df.withColumn("violations", violations(df))
    return judged.filter(F.size("violations") == 0).drop("violations"), judged.filter(F.size("violations") > 0)


def read_policies(spark, path):
    return check_policies(spark.read.schema(POLICY).option("multiLine", "true").json(path))
