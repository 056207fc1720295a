"""Spark ML models over the weighted feature frame."""

import statistics

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskweave.functions.ordered import hashed_row_number
from riskweave.operators.model_features import apply_weights, feature_columns, with_display_names
from riskweave.session import written

SEED = 42
SMALL = 20


def assemble_features(df, weights=None):
    """Vector column `features` of the (weighted) model inputs."""
    cols = feature_columns(df)
    weighted = apply_weights(df, weights) if weights else df
    return VectorAssembler(inputCols=cols, outputCol="features").transform(weighted), cols


def standardize(df):
    return StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True).fit(df).transform(df)


def stratified_folds(df, label, key, k=5):
    """Fold 0..k-1, balanced to one row within each label."""
    return hashed_row_number(df, [label], key).withColumn("fold", ((F.col("rn") - 1) % k).cast("int")).drop(
        "rn", "group_size")


def stratified_split(df, label, key, test=0.3):
    """(train, test) by label; below 20 rows both are the whole frame."""
    marked = hashed_row_number(df, [label], key)
    marked = marked.withColumn("_test", F.col("rn") <= F.round(F.col("group_size") * test))
    few = df.agg(F.count("*") < SMALL).scalar()
    both = marked.withColumn("_few", few).drop("rn", "group_size")
    train = both.filter(F.col("_few") | ~F.col("_test")).drop("_few", "_test")
    return train, both.filter(F.col("_few") | F.col("_test")).drop("_few", "_test")


def balance(df, label="label"):
    """Class weights n / (2 * class size)."""
    sizes = df.agg(F.struct(F.count("*").alias("n"), F.sum(label).alias("pos")).alias("c")).scalar()
    out = df.withColumn("_c", sizes)
    size = F.when(F.col(label) == 1, F.col("_c.pos")).otherwise(F.col("_c.n") - F.col("_c.pos"))
    return out.withColumn("class_weight", F.col("_c.n") / (size * 2.0)).drop("_c")


def lr_pipeline(n, c=0.01):
    """Balanced logistic regression on standardised features.

    The penalty matches inverse strength `c` per summed loss; n/(n-1) turns the scaler's sample
    deviation into the population one.
    """
    reg = (n - 1) / n / (c * n) if n > 1 else 1.0 / c
    return Pipeline(stages=[
        StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True),
        LogisticRegression(featuresCol="scaled", labelCol="label", weightCol="class_weight", regParam=reg,
                           elasticNetParam=0.0, standardization=False, maxIter=1000)])


def rf_estimator():
    return RandomForestClassifier(featuresCol="features", labelCol="label", weightCol="class_weight", numTrees=100,
                                  maxDepth=3, minInstancesPerNode=3, featureSubsetStrategy="sqrt", seed=SEED)


def with_score(model, df, name):
    """Probability of class 1 as a plain column."""
    out = model.transform(df)
    extra = [c for c in out.columns if c not in df.columns and c != "probability"]
    return out.withColumn(name, vector_to_array("probability")[1]).drop("probability", *extra)


def score_rows(df, model, name, fold=None):
    """Probability of class 1 by a `Boosted` or `Network` model; with `fold`, by the one that has not seen the row's fold."""

    @F.pandas_udf("double")
    def of(x: pd.Series, which: pd.Series) -> pd.Series:
        x, which, out = np.array(x.tolist(), dtype=float), which.to_numpy(), np.zeros(len(x))
        for m in np.unique(which):
            out[which == m] = 1 / (1 + np.exp(-model.margins(x[which == m], int(m))))
        return pd.Series(out)

    return df.withColumn(name, of(vector_to_array("features"), F.col(fold) if fold else F.lit(0)))


def score_all(models, df):
    """Class-1 probability of each fitted model as a column; `models` maps column name to model."""
    for name, model in models.items():
        df = with_score(model, df, name)
    return df


def cv_auc(df, makers, key, label="label", k=5, together=()):
    """(model, mean, standard deviation) of the fold AUCs of every model.

    `makers` maps a name to a function from the number of training rows to an estimator: penalty and class weights
    are those of the four fifths that a fit sees. `together` maps a name to a module whose `fit` learns all folds in
    the same jobs (`boosting`, `network`). The folds are written once for all fits.
    """
    folded = written(df.sparkSession, stratified_folds(df.select(*key, "features", label), label, key, k), "folds")
    judge, scores = BinaryClassificationEvaluator(labelCol=label), {name: [] for name in (*makers, *together)}
    for fold in range(k):
        train = balance(folded.filter(F.col("fold") != fold), label).cache()
        n, test = train.count(), folded.filter(F.col("fold") == fold)
        for name, make in makers.items():
            scores[name].append(judge.evaluate(make(n).fit(train).transform(test)))
        train.unpersist()
    for name in together:
        model = together[name].fit(folded, key, label, "fold", k)
        judged = written(df.sparkSession, score_rows(folded, model, "rawPrediction", "fold"), "judged")
        scores[name] = [judge.evaluate(judged.filter(F.col("fold") == fold)) for fold in range(k)]
    return [(name, statistics.fmean(s), statistics.pstdev(s)) for name, s in scores.items()]


def ranked_importances(spark, values, cols, n=15):
    """The n most important inputs with their display names."""
    pairs = sorted(zip(cols, values), key=lambda p: (-p[1], p[0]))[:n]
    rows = spark.createDataFrame([(i + 1, c, float(v)) for i, (c, v) in enumerate(pairs)],
                                 "rank int, feature string, importance double")
    return with_display_names(rows).select("rank", "feature", "display", "importance")


def prepare(frame, weights, label="high_risk"):
    """Assembled and balanced frame with `label`, plus the input names."""
    df, cols = assemble_features(frame.withColumn("label", F.col(label).cast("double")), weights)
    return balance(df), cols
