"""Top-k lists with a 1-based rank."""
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ranked(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows with their rank; only those ``k`` rows meet in one task."""
    top = df.orderBy(*order).limit(k)
    return top.select(F.row_number().over(Window.orderBy(*order)).alias("rank"), *df.columns)


def top_per_group(df: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows of every group; cut to ``k`` per task before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("rank", rank).filter(F.col("rank") <= k)
