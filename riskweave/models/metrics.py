"""Model quality from score and label columns."""

from pyspark.sql import functions as F

from riskweave.functions.ordered import running_sums


def by_score(df, score, label):
    """Positives and negatives of each distinct score."""
    return df.groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))


def roc_points(df, score, label, bins=None):
    """False and true positive rate at each distinct score, highest first; `bins` rounds scores first."""
    if bins:
        df = df.withColumn(score, F.floor(F.col(score) * bins) / float(bins))
    points = running_sums(by_score(df, score, label), "threshold", ["pos", "neg"])
    all_of = df.agg(F.struct(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) != 1).alias("n"))
                    .alias("c")).scalar()
    out = points.withColumn("_c", all_of)
    return out.select("threshold", F.try_divide(F.col("cum_neg"), F.col("_c.n")).alias("fpr"),
                      F.try_divide(F.col("cum_pos"), F.col("_c.p")).alias("tpr"))


def rank_auc(df, score, label):
    """Area under the curve by rank sums, ties counted half; NULL when one class is absent."""
    points = running_sums(by_score(df, score, label), "threshold", ["neg"], descending=False)
    wins = F.col("pos") * (F.col("cum_neg") * 2 - F.col("neg"))
    return points.agg(F.sum(wins).alias("w"), F.sum("pos").alias("p"), F.sum("neg").alias("n")).select(
        F.try_divide(F.col("w"), F.col("p") * F.col("n") * 2).alias("auc"),
        F.col("p").cast("bigint").alias("positives"), F.col("n").cast("bigint").alias("negatives"))


def confusion(df, score, label, cut=0.5):
    """Counts, precision, recall and F1 at a cut; an undefined ratio is 0."""
    hit, real = F.col(score) >= cut, F.col(label) == 1
    c = df.agg(F.count_if(hit & real).alias("tp"), F.count_if(hit & ~real).alias("fp"),
               F.count_if(~hit & real).alias("fn"), F.count_if(~hit & ~real).alias("tn"))
    ratio = lambda a, b: F.coalesce(F.try_divide(F.col(a), F.col(a) + F.col(b)), F.lit(0.0))
    c = c.withColumns({"precision": ratio("tp", "fp"), "recall": ratio("tp", "fn")})
    both = F.col("precision") + F.col("recall")
    return c.withColumn("f1", F.coalesce(F.try_divide(F.col("precision") * F.col("recall") * 2, both), F.lit(0.0)))


def class_report(df, score, label, cut=0.5):
    """Precision, recall, F1 and support of both classes."""
    c = confusion(df, score, label, cut)
    cell = lambda name, tp, fp, fn: F.struct(
        F.lit(name).alias("class"), F.col(tp).alias("hit"), F.col(fp).alias("extra"), F.col(fn).alias("lost"))
    rows = c.select(F.explode(F.array(cell("Low risk", "tn", "fn", "fp"), cell("High risk", "tp", "fp", "fn")))
                    .alias("r")).select("r.*")
    ratio = lambda a, b: F.coalesce(F.try_divide(F.col(a), F.col(a) + F.col(b)), F.lit(0.0))
    rows = rows.withColumns({"precision": ratio("hit", "extra"), "recall": ratio("hit", "lost")})
    both = F.col("precision") + F.col("recall")
    return rows.select("class", "precision", "recall",
                       F.coalesce(F.try_divide(F.col("precision") * F.col("recall") * 2, both), F.lit(0.0)).alias("f1"),
                       (F.col("hit") + F.col("lost")).alias("support"))


def choose_model(metrics, near=0.01):
    """Boosted trees when within `near` of the forest's AUC, else the largest AUC.

    `metrics` has model and cv_auc, one row per supervised model.
    """
    pick = lambda name: F.max(F.when(F.col("model") == name, F.col("cv_auc")))
    best = metrics.agg(
        pick("Random Forest").alias("rf"), pick("Boosted Trees").alias("gbt"),
        F.max_by("model", F.struct(F.coalesce("cv_auc", F.lit(0.0)), F.col("model"))).alias("top"))
    return best.select(F.when(F.abs(F.col("rf") - F.col("gbt")) < near, "Boosted Trees").otherwise(F.col("top"))
                       .alias("model"))
