"""Reading and writing shared by the operators of this package."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from riskweave import session


def read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(spark, df, label):
    """Write to the shared folder and read back: later steps neither recompute nor depend on executors."""
    return session.written(spark, df, label)


def short_batches(spark, rows=1000):
    """Texts and word lists go to Python whole, so Arrow batches are kept short, as `session.build` sets them."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def short_plans(spark, characters=1 << 16):
    """Spark keeps the text of every plan it runs; a plan with a large literal is cut there, not in what it does."""
    spark.conf.set("spark.sql.maxPlanStringLength", str(characters))


def first_of_each(df, by, order, n, name="rank"):
    """The first `n` rows of each key by `order`, numbered from 1; Spark cuts to `n` in every task before it shuffles."""
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return ranked.where(F.col(name) <= n)
