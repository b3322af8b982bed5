"""Reading scores. ``prob`` and its companions are arrays with one entry per label, in index order,
so that a page stays one row and nothing here needs a shuffle."""

from pyspark.sql import Column, DataFrame, functions as F

from pagelens.functions import vectors as v
from pagelens.labels import LABELS, label_array, label_of


def probabilities(logits: Column) -> Column:
    return F.transform(logits, lambda x: v.sigmoid(x))


def predictions(prob: Column, at: float = 0.5, inclusive: bool = True) -> Column:
    return F.transform(prob, lambda p: v.threshold(p, at, inclusive))


def labels_over(prob: Column, at: float = 0.5, labels=LABELS, inclusive: bool = True) -> Column:
    """Labels that pass the threshold, in index order."""
    def passes(_, i):
        p = F.get(prob, i)
        return p >= at if inclusive else p > at
    return F.filter(label_array(labels), passes)


def probabilities_over(prob: Column, at: float = 0.5, labels=LABELS, inclusive: bool = True) -> Column:
    """Map of the passing labels to their probabilities."""
    passing = F.filter(prob, lambda p: p >= at if inclusive else p > at)
    return F.map_from_arrays(labels_over(prob, at, labels, inclusive), passing)


def best_label(prob: Column, labels=LABELS) -> Column:
    """Label of the highest probability; the first one on ties."""
    return label_of((F.array_position(prob, F.array_max(prob)) - 1).cast("int"), labels)


def labels_or_best(prob: Column, at: float = 0.5, labels=LABELS) -> Column:
    """Passing labels, or the best label when none passes."""
    passing = labels_over(prob, at, labels)
    return F.when(F.size(passing) == 0, F.array(best_label(prob, labels))).otherwise(passing)


def best_with_percent(prob: Column, digits: int = 2, labels=LABELS) -> Column:
    """'Label (12.34%)'."""
    return F.concat(best_label(prob, labels), F.lit(" ("), v.percent(F.array_max(prob), digits), F.lit(")"))


def wide_results(scored: DataFrame, keep=("url", "title", "combined_text"), labels=LABELS) -> DataFrame:
    """true_, pred_ and prob_ columns for each label, from the arrays y, pred and prob."""
    cells = []
    for i, label in enumerate(labels):
        cells += [F.get("y", F.lit(i)).alias(f"true_{label}"), F.get("pred", F.lit(i)).alias(f"pred_{label}"),
                  F.get("prob", F.lit(i)).alias(f"prob_{label}")]
    return scored.select(*keep, *cells)


def from_wide(results: DataFrame, keep=("url", "title", "combined_text"), prefix: str = "", labels=LABELS) -> DataFrame:
    """Back from the wide table to the arrays; ``prefix`` picks another model's columns, as in js_pred_."""
    return results.select(
        *keep, F.array(*[F.col(f"true_{n}").cast("int") for n in labels]).alias("y"),
        F.array(*[F.col(f"{prefix}pred_{n}").cast("int") for n in labels]).alias("pred"),
        F.array(*[F.col(f"{prefix}prob_{n}").cast("double") for n in labels]).alias("prob"))


def long_results(scored: DataFrame, key: str, labels=LABELS) -> DataFrame:
    """One row per page and label: (key, label_idx, label, y, prob, pred)."""
    return (scored.select(key, F.posexplode(F.arrays_zip("y", "prob", "pred")))
            .select(key, F.col("pos").alias("label_idx"), label_of(F.col("pos"), labels).alias("label"),
                    "col.y", "col.prob", "col.pred"))


def sample_report(scored: DataFrame, order: str, n: int = 5, keep=("url", "title")) -> DataFrame:
    """First rows with true labels, predicted labels and probabilities."""
    return scored.select(order, *keep, "y", "pred", "prob").orderBy(order).limit(n)
