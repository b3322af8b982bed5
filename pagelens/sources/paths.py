"""Lists of input files."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from pagelens.functions import text as tx
from pagelens.operators import ranking


def read_path_list(spark: SparkSession, listing: str, base_url: str = "") -> DataFrame:
    """One trimmed path per non-empty line of a plain or gzip text file, behind a base URL.

    ``line_no`` orders the lines of one listing file.
    """
    lines = spark.read.text(listing).withColumn("line_no", F.monotonically_increasing_id())
    path = tx.strip(F.col("value"))
    return (lines.filter(F.char_length(path) > 0)
            .select("line_no", F.concat(F.lit(base_url), path).alias("path")))


def first_paths(paths: DataFrame, n: int, order: str = "line_no") -> DataFrame:
    """The first ``n`` paths in an order; no task gets more than a range of them, however large ``n`` is."""
    return ranking.numbered(paths, order, out="_place").filter(F.col("_place") <= n).drop("_place")


def sample_paths(paths: DataFrame, n: int, seed: int = 1, key: str = "path") -> DataFrame:
    """Random sample of ``n`` paths that is the same for the same seed: those with the smallest digests."""
    drawn = paths.withColumn("_draw", F.md5(F.concat(F.col(key), F.lit(str(seed)))))
    return ranking.numbered(drawn, "_draw", key, out="_place").filter(F.col("_place") <= n).drop("_draw", "_place")


def not_processed(paths: DataFrame, processed: DataFrame, key: str = "path") -> DataFrame:
    """Paths without an entry in the processed table."""
    return paths.join(processed.select(key), key, "left_anti")
