"""Scoring page visits as they arrive."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from pagelens import schemas
from pagelens.functions import text as tx
from pagelens.operators import scoring

# Fixed value: pages of the browser extension itself.
OWN_SCHEME = "moz-extension://"


def read_visits(spark: SparkSession, folder: str, max_files_per_trigger: int = 1000, schema=schemas.VISIT) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(folder)


def finished_visits(visits: DataFrame) -> DataFrame:
    """Visits to score, with the model text; works on streams and tables alike."""
    wanted = (F.col("status") == "complete") & (F.coalesce(F.col("url"), F.lit("")) != "") \
        & ~F.startswith(F.col("url"), F.lit(OWN_SCHEME))
    done = visits.filter(wanted).withColumn("title", F.coalesce("title", F.lit("")))
    return done.withColumn("text", tx.model_text(F.col("url"), F.col("title"), ": "))


def scored_visits(visits: DataFrame, score) -> DataFrame:
    """``score`` adds ``prob`` to a table with ``text``; the best label and its percentage are reported."""
    return score(finished_visits(visits)).withColumns({
        "label": scoring.best_label(F.col("prob")), "score": F.array_max("prob"),
        "message": F.concat(F.lit("Classified as: "), scoring.best_with_percent(F.col("prob")))})


def write_scored(scored: DataFrame, out: str, checkpoint: str, once: bool = True):
    """Append to a Parquet table; with ``once`` what is there now is processed and the query ends."""
    writer = scored.writeStream.outputMode("append").format("parquet").option("path", out) \
        .option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start() if once else writer.start()
