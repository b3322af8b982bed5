"""The topic labels and the label dimension."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The label set; the position in the list is the label index.
LABELS = [
    "News", "Entertainment", "Shop", "Chat", "Education", "Government",
    "Health", "Technology", "Work", "Travel", "Uncategorized",
]
UNCATEGORIZED = "Uncategorized"
MAX_LABELS_PER_PAGE = 3


def label_array(labels=LABELS) -> Column:
    """The label set as one literal array column, in index order."""
    return F.array(*[F.lit(name) for name in labels])


def label_of(index: Column, labels=LABELS) -> Column:
    """Label name of a zero-based label index."""
    return F.get(label_array(labels), index)


def index_of(label: Column, labels=LABELS) -> Column:
    """Zero-based label index of a label name, NULL if it is not a label."""
    position = F.array_position(label_array(labels), label)
    return F.when(position > 0, (position - 1).cast("int"))


def label_dimension(spark: SparkSession, labels=LABELS) -> DataFrame:
    """One row per label: (label_idx, label)."""
    rows = spark.range(1).select(F.posexplode(label_array(labels)))
    return rows.toDF("label_idx", "label")
