"""Parquet and CSV tables."""

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_parquet(spark: SparkSession, path: str, columns=None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def spread(df: DataFrame) -> DataFrame:
    """Share a scan with fewer splits than cores over all cores; larger scans stay as they are.

    Meant for work that costs far more than moving its input, such as parsing pages.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def write_parquet(df: DataFrame, path: str) -> None:
    """Replace the table."""
    df.write.mode("overwrite").parquet(path)


def append_parquet(df: DataFrame, path: str) -> None:
    """Add files to the table; what is there is neither read nor rewritten."""
    df.write.mode("append").parquet(path)


def append_once(df: DataFrame, path: str, run: str) -> None:
    """Add the rows of one run to the table; a run that is repeated, after a failure or by mistake, replaces its own rows and
    adds nothing twice. The table has the column ``run``."""
    if not run or "/" in run:
        raise ValueError("a run is named by a text without '/'")
    df.write.mode("overwrite").parquet(f"{path}/run={run}")


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """CSV with a header; blank lines are skipped, values are cast by the schema."""
    return spark.read.csv(path, schema=schema, header=True, multiLine=True, escape='"', mode="PERMISSIVE")


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header and every value quoted, so that separators and blanks inside values survive."""
    df.write.mode("overwrite").csv(path, header=True, quoteAll=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def require_columns(df: DataFrame, names) -> DataFrame:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"Missing columns: {missing}")
    return df


def row_and_column_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))
