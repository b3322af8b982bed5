"""Cleaning of page tables."""

from pyspark.sql import DataFrame, Window, functions as F

from pagelens import schemas
from pagelens.operators import ranking


def drop_nulls(df: DataFrame, names=schemas.REQUIRED_TEXT) -> DataFrame:
    """Drop rows with NULL in a named column; an empty text stays."""
    return df.dropna(subset=list(names))


def keep_first(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key, the first in the order. Copies are pruned to one per task before the shuffle."""
    first = Window.partitionBy(key).orderBy(order)
    return df.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") == 1).drop("_n")


def deduplicated(df: DataFrame, order: str) -> DataFrame:
    """First row of each URL, then among these the first of each record id."""
    return keep_first(keep_first(df, "url", order), "warc_id", order)


def as_text(df: DataFrame, names=schemas.REQUIRED_TEXT) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("string") for n in names})


def clean_pages(df: DataFrame, order: str, required=schemas.REQUIRED_TEXT) -> DataFrame:
    df = df.drop(*schemas.TECHNICAL_COLUMNS)
    return as_text(deduplicated(drop_nulls(df, required), order))


def head(df: DataFrame, n: int, order: str) -> DataFrame:
    return df.orderBy(order).limit(n)


def tail(df: DataFrame, n: int, order: str) -> DataFrame:
    return df.orderBy(F.desc(order)).limit(n)


def describe_numbers(df: DataFrame, names) -> DataFrame:
    """count, mean, std, min, quartiles and max of numeric columns, one row per column.

    Distinct values are counted, and everything follows from these counts; the quartiles come from running
    totals, so no task holds a column.
    """
    longs = df.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("column"), F.col(n).cast("double").alias("value")) for n in names])))
    counted = longs.filter("value is not null").groupBy("column", "value").agg(F.count("*").alias("n"))
    n, value = F.col("n"), F.col("value")
    stats = counted.groupBy("column").agg(F.sum("n").alias("count"), (F.sum(n * value) / F.sum("n")).alias("mean"),
                                          F.min("value").alias("min"), F.max("value").alias("max"))
    squares = F.sum(n * (value - F.col("mean")) * (value - F.col("mean")))
    spread = counted.join(stats.select("column", "mean", "count"), "column").groupBy("column").agg(
        F.sqrt(F.try_divide(squares, F.first("count") - 1)).alias("std"))
    quartiles = ranking.exact_quantiles(counted, ["column"], [0.25, 0.5, 0.75])
    quartiles = quartiles.toDF("column", "q1", "median", "q3")
    return stats.join(spread, "column").join(quartiles, "column").select(
        "column", "count", "mean", "std", "min", "q1", "median", "q3", "max")


def describe_texts(df: DataFrame, names) -> DataFrame:
    """count, number of distinct values, and the most frequent value (first in order on ties)."""
    longs = df.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("column"), F.col(n).cast("string").alias("value")) for n in names])))
    counted = longs.filter("value is not null").groupBy("column", "value").agg(F.count("*").alias("n"))
    return counted.groupBy("column").agg(
        F.sum("n").alias("count"), F.count("*").alias("unique"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top"), F.max("n").alias("freq"))


def null_counts(df: DataFrame, names=None) -> DataFrame:
    """(column, n_null) for each column."""
    names = list(names or df.columns)
    counts = df.agg(*[F.count_if(F.col(n).isNull()).alias(n) for n in names])
    return counts.unpivot([], names, "column", "n_null")


def among(df: DataFrame, column: str, allowed) -> DataFrame:
    return df.filter(F.col(column).isin(list(allowed)))


def not_among(df: DataFrame, processed: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in the processed table."""
    return df.join(processed.select(key), key, "left_anti")


def appended(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both tables; a column one of them lacks is NULL there."""
    return existing.unionByName(new, allowMissingColumns=True)
