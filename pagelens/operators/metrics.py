"""Multi-label metrics. ``scored`` has one row per page with the arrays y, pred and prob.

Everything but the exact match and the areas under curves follows from one small table of counts per
label, so the pages are read once and reduced on the map side.
"""

from pyspark.sql import Column, DataFrame, functions as F

from pagelens.functions import vectors as v
from pagelens.functions.stages import computed
from pagelens.labels import LABELS, label_of
from pagelens.operators import ranking


def _ratio(a, b) -> Column:
    """a / b, 0 for an empty divisor."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def confusion(scored: DataFrame, labels=LABELS, y: str = "y", pred: str = "pred") -> DataFrame:
    """(label_idx, label, tp, fp, fn, tn)."""
    cells = scored.select(F.posexplode(F.arrays_zip(F.col(y).alias("y"), F.col(pred).alias("pred"))))
    truth, guess = F.col("col.y") == 1, F.col("col.pred") == 1
    counts = cells.groupBy(F.col("pos").alias("label_idx")).agg(
        F.count_if(truth & guess).alias("tp"), F.count_if(~truth & guess).alias("fp"),
        F.count_if(truth & ~guess).alias("fn"), F.count_if(~truth & ~guess).alias("tn"))
    return counts.select("label_idx", label_of(F.col("label_idx"), labels).alias("label"), "tp", "fp", "fn", "tn")


def confusion_cells(counts: DataFrame) -> DataFrame:
    """(label, y, pred, n): four cells per label, zeros included."""
    return counts.select("label", F.inline(F.array(*[
        F.struct(F.lit(y).alias("y"), F.lit(p).alias("pred"), F.col(c).alias("n"))
        for y, p, c in [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]])))


def with_label_ratios(counts: DataFrame) -> DataFrame:
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    return counts.withColumns({
        "total": F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn"), "positives": F.col("tp") + F.col("fn"),
        "precision": _ratio(tp, tp + fp), "recall": _ratio(tp, tp + fn), "f1": _ratio(2 * tp, 2 * tp + fp + fn),
        "jaccard": _ratio(tp, tp + fp + fn), "accuracy": _ratio(tp + tn, tp + fp + fn + tn)})


def label_report(scored: DataFrame, labels=LABELS) -> DataFrame:
    """Counts, precision, recall, accuracy and F1 of each label."""
    return with_label_ratios(confusion(scored, labels)).select(
        "label", "total", "positives", "tp", "fp", "fn", "tn", "precision", "recall", "accuracy", "f1")


def _rows(one_row: DataFrame) -> DataFrame:
    """A one-row table of metrics as (metric, value) rows."""
    return one_row.unpivot([], one_row.columns, "metric", "value")


def count_metrics(counts: DataFrame) -> DataFrame:
    """Hamming loss, micro, macro and weighted averages as (metric, value) rows.

    The micro averages pool both classes of every cell, where all three equal the share of right
    cells; ``*_micro_pos`` pool the positive class only.
    """
    r = with_label_ratios(counts)
    right = F.sum(F.col("tp") + F.col("tn")) / F.sum("total")
    tp, fp, fn = F.sum("tp").cast("double"), F.sum("fp").cast("double"), F.sum("fn").cast("double")

    def weighted(c):
        return _ratio(F.sum(F.col(c) * F.col("positives")), F.sum("positives").cast("double"))

    return _rows(r.agg(
        (F.sum(F.col("fp") + F.col("fn")) / F.sum("total")).alias("hamming_loss"),
        right.alias("precision_micro"), right.alias("recall_micro"), right.alias("f1_micro"),
        _ratio(tp, tp + fp).alias("precision_micro_pos"), _ratio(tp, tp + fn).alias("recall_micro_pos"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1_micro_pos"),
        F.avg("precision").alias("precision_macro"), F.avg("recall").alias("recall_macro"), F.avg("f1").alias("f1_macro"),
        weighted("precision").alias("precision_weighted"), weighted("recall").alias("recall_weighted"),
        weighted("f1").alias("f1_weighted"),
        (right / (2 - right)).alias("jaccard_micro"), F.avg("jaccard").alias("jaccard_macro")))


def f1_per_label(counts: DataFrame) -> DataFrame:
    return with_label_ratios(counts).select(F.concat(F.lit("f1_"), "label").alias("metric"), F.col("f1").alias("value"))


def exact_match(scored: DataFrame) -> DataFrame:
    """Share of pages whose labels are all right."""
    return _rows(scored.agg(F.avg((F.col("y") == F.col("pred")).cast("int")).alias("exact_match")))


def score_counts(scored: DataFrame, prob: str = "prob") -> DataFrame:
    """(label_idx, score, pos, neg): equal scores of a label are added up before any ordering."""
    cells = scored.select(F.posexplode(F.arrays_zip(F.col("y").alias("y"), F.col(prob).alias("prob"))))
    return cells.groupBy(F.col("pos").alias("label_idx"), F.col("col.prob").alias("score")).agg(
        F.count_if(F.col("col.y") == 1).alias("pos"), F.count_if(F.col("col.y") != 1).alias("neg"))


def areas(counts: DataFrame, groups=()) -> DataFrame:
    """ROC-AUC and average precision per group. Without both classes the first is undefined (NULL); without
    positives the second is 0.

    A step at one score adds ``neg`` to the false and ``pos`` to the true positives; its trapezoid is
    neg * (tp - pos / 2).
    """
    groups = list(groups)
    steps = ranking.with_running_totals(counts, "score", {"tp": "pos", "fp": "neg"}, groups, descending=True)
    tp, fp, pos, neg = (F.col(c).cast("double") for c in ("tp", "fp", "pos", "neg"))
    sums = steps.groupBy(*groups).agg(
        F.sum(neg * (tp - pos / 2)).alias("_area"), F.sum(pos * tp / (tp + fp)).alias("_precision"),
        F.sum(pos).alias("_pos"), F.sum(neg).alias("_neg"))
    return sums.select(*groups, F.try_divide("_area", F.col("_pos") * F.col("_neg")).alias("roc_auc"),
                       F.coalesce(F.try_divide("_precision", "_pos"), F.lit(0.0)).alias("pr_auc"))


def area_metrics(scored: DataFrame, prob: str = "prob") -> DataFrame:
    """ROC-AUC and PR-AUC, all cells pooled (micro) and as the mean over labels (macro). The mean is
    undefined, NULL, if it is for a label."""
    return _areas_of(score_counts(scored, prob))


def _areas_of(by_label):
    pooled = by_label.groupBy("score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    micro = areas(pooled).select(F.col("roc_auc").alias("roc_auc_micro"), F.col("pr_auc").alias("pr_auc_micro"))
    macro = areas(by_label, ["label_idx"]).agg(
        F.when(F.count_if(F.isnull("roc_auc")) == 0, F.avg("roc_auc")).alias("roc_auc_macro"), F.avg("pr_auc").alias("pr_auc_macro"))
    return _rows(micro).unionByName(_rows(macro))


def cell_counts(scored: DataFrame) -> DataFrame:
    """(label_idx, score, pred, pos, neg), with one more index -1 that counts exact matches as pos.

    Everything ``all_metrics`` needs, in one pass over the pages. The columns are fixed, so that the
    consumers share this aggregation instead of pushing their own filters below it.
    """
    cells = F.transform(F.arrays_zip("y", "prob", "pred"), lambda c, i: F.struct(
        i.alias("label_idx"), c["prob"].cast("double").alias("score"), c["pred"].cast("int").alias("pred"),
        (c["y"] == 1).alias("hit")))
    exact = F.struct(F.lit(-1).alias("label_idx"), F.lit(None).cast("double").alias("score"),
                     F.lit(None).cast("int").alias("pred"), (F.col("y") == F.col("pred")).alias("hit"))
    rows = scored.select(F.inline(F.concat(cells, F.array(exact))))
    counts = rows.groupBy("label_idx", "score", "pred").agg(
        F.count_if("hit").alias("pos"), F.count_if(~F.col("hit")).alias("neg"))
    return computed(counts, *counts.columns)


def all_metrics(scored: DataFrame, labels=LABELS, digits: int | None = 3) -> DataFrame:
    """Every metric as (metric, value) rows, rounded."""
    cells = cell_counts(scored)
    of_labels = cells.filter("label_idx >= 0")
    guess = F.col("pred") == 1
    counts = of_labels.groupBy("label_idx").agg(
        F.sum(F.when(guess, F.col("pos")).otherwise(0)).alias("tp"), F.sum(F.when(guess, F.col("neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(guess, 0).otherwise(F.col("pos"))).alias("fn"), F.sum(F.when(guess, 0).otherwise(F.col("neg"))).alias("tn"))
    counts = counts.withColumn("label", label_of(F.col("label_idx"), labels))
    by_label = of_labels.groupBy("label_idx", "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    exact = cells.filter("label_idx = -1").agg((F.sum("pos") / F.sum(F.col("pos") + F.col("neg"))).alias("exact_match"))
    rows = (count_metrics(counts).unionByName(_rows(exact))
            .unionByName(_areas_of(by_label)).unionByName(f1_per_label(counts)))
    return rows if digits is None else rows.withColumn("value", v.rounded(F.col("value"), digits))


def agreement(both: DataFrame, a: str = "pred_a", b: str = "pred_b", labels=LABELS) -> DataFrame:
    """Share of equal predictions of two models per label, and overall in the row with label 'overall'."""
    cells = both.select(F.posexplode(F.zip_with(a, b, lambda x, y: (x == y).cast("int"))))
    shares = cells.rollup("pos").agg(F.sum("col").alias("n_equal"), F.count("*").alias("n"), F.avg("col").alias("agreement"))
    name = F.when(F.col("pos").isNull(), "overall").otherwise(label_of(F.col("pos"), labels))
    return shares.select(name.alias("label"), "n_equal", "n", "agreement")


def joined_predictions(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Predictions of two runs side by side; one row per page on both sides of the join."""
    return a.select(key, "y", F.col("pred").alias("pred_a")).join(
        b.select(key, F.col("pred").alias("pred_b")), key)


def multi_label_samples(scored: DataFrame) -> DataFrame:
    """How many pages there are, and how many have more than one true label."""
    n_true = F.aggregate("y", F.lit(0), lambda acc, x: acc + x)
    return scored.agg(F.count("*").alias("n_samples"), F.count_if(n_true > 1).alias("n_multi_label"))


def compared(trained: DataFrame, baseline: DataFrame) -> DataFrame:
    """(metric, trained, baseline) from two metric tables."""
    return (trained.select("metric", F.col("value").alias("trained"))
            .join(baseline.select("metric", F.col("value").alias("baseline")), "metric"))


def best_model(metrics: DataFrame, by: str = "f1_macro") -> DataFrame:
    """The model with the highest value of a metric; the first name on ties."""
    wanted = metrics.filter(F.col("metric") == by)
    return wanted.agg(F.min_by("model", F.struct(-F.col("value"), F.col("model"))).alias("model"),
                      F.max("value").alias("value"))
