"""Label counts, combinations, co-occurrence and distributions. ``category`` is an array of labels."""

from pyspark.sql import DataFrame, functions as F

from pagelens.functions import vectors as v
from pagelens.labels import LABELS, index_of, label_array

# Fixed value: whiskers reach this many interquartile ranges.
WHISKER = 1.5


def exploded(pages: DataFrame, category: str = "category") -> DataFrame:
    """One row per page and label; a page without labels keeps one row with NULL."""
    others = [c for c in pages.columns if c != category]
    return pages.select(*others, F.explode_outer(category).alias(category))


def label_counts(pages: DataFrame, allowed=None) -> DataFrame:
    """(label, n) with repeats counted; all labels, or the allowed ones."""
    labels = exploded(pages.select("category")).filter("category is not null")
    if allowed is not None:
        labels = labels.filter(F.col("category").isin(list(allowed)))
    return labels.groupBy(F.col("category").alias("label")).agg(F.count("*").alias("n"))


def by_count(counts: DataFrame) -> DataFrame:
    return counts.orderBy(F.desc("n"), "label")


def label_shares(pages: DataFrame, allowed=LABELS, digits: int = 1) -> DataFrame:
    """Percent of each allowed label among all of them, as a number and as text."""
    counts = label_counts(pages, allowed)
    whole = counts.agg(F.sum("n").alias("n")).scalar()
    share = F.col("n") / whole
    return counts.select("label", "n", (share * 100).alias("percent"), v.percent(share, digits).alias("text"))


def pages_by_label_number(pages: DataFrame) -> DataFrame:
    return pages.groupBy(F.size("category").alias("n_labels")).agg(F.count("*").alias("n")).orderBy("n_labels")


def _grid(spark, labels):
    """All cells of the label matrix, from literals."""
    names = label_array(labels)
    first = spark.range(1).select(F.explode(names).alias("cat1"))
    return first.select("cat1", F.explode(names).alias("cat2"))


def cooccurrence(pages: DataFrame, labels=LABELS) -> DataFrame:
    """(cat1, cat2, n): pages with both labels; the diagonal counts pages with the label; zeros included.

    A page has at most as many distinct allowed labels as there are labels, so its pairs are bounded.
    """
    own = F.array_intersect(F.array_distinct("category"), label_array(labels))
    pairs = pages.select(own.alias("own")).select("own", F.explode("own").alias("cat1"))
    counts = (pairs.select("cat1", F.explode("own").alias("cat2"))
              .groupBy("cat1", "cat2").agg(F.count("*").alias("n")))
    return (_grid(pages.sparkSession, labels).join(counts, ["cat1", "cat2"], "left")
            .select("cat1", "cat2", F.coalesce("n", F.lit(0)).alias("n")))


def conditional_probability(pages: DataFrame, labels=LABELS) -> DataFrame:
    """(cat1, cat2, p): co-occurrence over the count of cat1; 0 on the diagonal and for unused labels.

    The divisor counts repeated labels of a page, the numerator does not.
    """
    divisor = label_counts(pages, labels).select(F.col("label").alias("cat1"), F.col("n").alias("_n1"))
    p = F.when(F.col("cat1") == F.col("cat2"), 0.0).otherwise(F.coalesce(F.try_divide("n", "_n1"), F.lit(0.0)))
    return cooccurrence(pages, labels).join(divisor, "cat1", "left").select("cat1", "cat2", p.alias("p"))


def lower_triangle(matrix: DataFrame, labels=LABELS) -> DataFrame:
    """Cells below the diagonal."""
    return matrix.filter(index_of(F.col("cat2"), labels) < index_of(F.col("cat1"), labels))


def as_square(matrix: DataFrame, value: str, labels=LABELS) -> DataFrame:
    """Display form: one row per cat1, one column per label."""
    return matrix.groupBy("cat1").pivot("cat2", list(labels)).agg(F.first(value))


def combination_counts(pages: DataFrame) -> DataFrame:
    """(combination, n): sorted label lists, joined by ' + '; pages without labels do not count."""
    used = pages.filter(F.size("category") > 0)
    return (used.groupBy(F.array_join(F.array_sort("category"), " + ").alias("combination"))
            .agg(F.count("*").alias("n")))


def top_combinations(pages: DataFrame, n: int = 15) -> DataFrame:
    return combination_counts(pages).orderBy(F.desc("n"), "combination").limit(n)


def box_statistics(pages: DataFrame, metrics, category: str = "category") -> DataFrame:
    """Box-plot figures of whole-number columns per label, in one pass over the pages.

    Equal values are counted before anything else. A length or count column has few distinct values,
    so the counted table is small whatever the number of pages, and everything else reads only it.
    """
    labelled = exploded(pages.select(category, *metrics), category).filter(F.col(category).isNotNull())
    counted = (labelled.select(F.col(category).alias("label"), F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("long").alias("value")) for m in metrics])))
        .filter("value is not null").groupBy("label", "metric", "value").agg(F.count("*").alias("n")))
    boxes = counted.groupBy("label", "metric").agg(
        F.sum("n").alias("n_pages"), F.expr("percentile(value, array(0.25, 0.5, 0.75), n)").alias("_q"))
    boxes = boxes.select("label", "metric", "n_pages", F.col("_q")[0].alias("q1"),
                         F.col("_q")[1].alias("median"), F.col("_q")[2].alias("q3"))
    reach = (F.col("q3") - F.col("q1")) * WHISKER
    inside = F.col("value").between(F.col("q1") - reach, F.col("q3") + reach)
    return (counted.join(boxes, ["label", "metric"])
            .groupBy("label", "metric", "n_pages", "q1", "median", "q3")
            .agg(F.min(F.when(inside, F.col("value"))).alias("_low"), F.max(F.when(inside, F.col("value"))).alias("_high"),
                 F.sum(F.when(inside, 0).otherwise(F.col("n"))).alias("n_outliers"))
            .select("label", "metric", "n_pages", "q1", "median", "q3",
                    F.least(F.col("_low").cast("double"), "q1").alias("whisker_low"),
                    F.greatest(F.col("_high").cast("double"), "q3").alias("whisker_high"), "n_outliers"))
