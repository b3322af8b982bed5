import random

import pytest
from pyspark.sql import functions as F

from pagelens.labels import LABELS
from pagelens.operators import metrics, scoring

N = len(LABELS)


def auc(y, s):
    pos, neg = [b for a, b in zip(y, s) if a], [b for a, b in zip(y, s) if not a]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


def average_precision(y, s):
    total, value, tp = sum(y), 0.0, 0
    for cut in sorted(set(s), reverse=True):
        hits = sum(a for a, b in zip(y, s) if b == cut)
        tp += hits
        value += hits / total * tp / sum(b >= cut for b in s)
    return value


@pytest.fixture(scope="module")
def data():
    rng = random.Random(4)
    out = []
    for i in range(120):
        y = [int(rng.random() < 0.3) for _ in range(N)]
        prob = [round(rng.random() * 0.7 + 0.3 * t, 2) for t in y]
        y[9], prob[8], prob[7] = 0, 0.1, 0.5  # no positives; nothing predicted; all tied on the threshold
        out.append((i, y, prob, [int(p >= 0.5) for p in prob]))
    return out


@pytest.fixture(scope="module")
def scored(spark, data):
    return spark.createDataFrame(data, "id int, y array<int>, prob array<double>, pred array<int>").cache()


def by_name(df):
    return {r.metric: r.value for r in df.collect()}


def numbers(values):
    return {k: -1 if x is None else x for k, x in values.items()}


def test_report_follows_the_definitions(data, scored):
    got = {r.label: r for r in metrics.label_report(scored).collect()}
    f1s = []
    for j, label in enumerate(LABELS):
        cells = [(y[j], pred[j]) for _, y, _, pred in data]
        tp, fp, fn = cells.count((1, 1)), cells.count((0, 1)), cells.count((1, 0))
        r = got[label]
        assert (r.tp, r.fp, r.fn, r.tn, r.total, r.positives) == (tp, fp, fn, cells.count((0, 0)), 120, tp + fn)
        assert r.precision == pytest.approx(tp / (tp + fp) if tp + fp else 0)
        assert r.recall == pytest.approx(tp / (tp + fn) if tp + fn else 0)
        assert r.f1 == pytest.approx(2 * tp / (2 * tp + fp + fn) if 2 * tp + fp + fn else 0)
        f1s.append(r.f1)
    values = by_name(metrics.count_metrics(metrics.confusion(scored)))
    assert values["f1_macro"] == pytest.approx(sum(f1s) / N)
    assert values["f1_micro"] == values["precision_micro"] == pytest.approx(1 - values["hamming_loss"])
    exact = sum(y == pred for _, y, _, pred in data) / len(data)
    assert by_name(metrics.exact_match(scored))["exact_match"] == pytest.approx(exact)


def test_areas_follow_the_definitions(data, scored):
    flat_y, flat_s = [t for _, y, _, _ in data for t in y], [p for _, _, prob, _ in data for p in prob]
    got = by_name(metrics.area_metrics(scored))
    assert got["roc_auc_micro"] == pytest.approx(auc(flat_y, flat_s))
    assert got["pr_auc_micro"] == pytest.approx(average_precision(flat_y, flat_s))
    assert got["roc_auc_macro"] is None  # label 9 has one class only
    columns = [([y[j] for _, y, _, _ in data], [p[j] for _, _, p, _ in data]) for j in range(N) if j != 9]
    assert got["pr_auc_macro"] == pytest.approx(sum(average_precision(y, s) for y, s in columns) / N)
    by_label = {r.label_idx: r for r in metrics.areas(metrics.score_counts(scored), ["label_idx"]).collect()}
    assert by_label[9].roc_auc is None and by_label[9].pr_auc == 0
    for j in range(N):
        if j != 9:
            y, p = [y[j] for _, y, _, _ in data], [p[j] for _, _, p, _ in data]
            assert (by_label[j].roc_auc, by_label[j].pr_auc) == (pytest.approx(auc(y, p)), pytest.approx(average_precision(y, p)))
    both = scored.select(*[F.slice(c, 1, 9).alias(c) for c in ("y", "prob", "pred")])
    assert by_name(metrics.area_metrics(both))["roc_auc_macro"] == pytest.approx(sum(auc(y, s) for y, s in columns[:9]) / 9)


def test_auc_does_not_change_under_monotone_maps(scored):
    moved = scored.withColumn("prob", F.transform("prob", lambda p: p * p * p))
    a, b = by_name(metrics.area_metrics(scored)), by_name(metrics.area_metrics(moved))
    assert numbers(a) == pytest.approx(numbers(b))


def test_all_metrics_in_one_pass(scored):
    got = by_name(metrics.all_metrics(scored, digits=None))
    parts = [metrics.count_metrics(metrics.confusion(scored)), metrics.exact_match(scored), metrics.area_metrics(scored),
             metrics.f1_per_label(metrics.confusion(scored))]
    want = {k: x for p in parts for k, x in by_name(p).items()}
    assert numbers(got) == pytest.approx(numbers(want))
    assert by_name(metrics.all_metrics(scored)) == {k: x if x is None else round(x, 3) for k, x in got.items()}


def test_agreement_and_confusion_cells(data, scored):
    other = scored.withColumn("pred", F.transform("pred", lambda p, i: F.when(i == 0, 1 - p).otherwise(p)))
    got = {r.label: r.agreement for r in metrics.agreement(metrics.joined_predictions(scored, other, "id")).collect()}
    assert got["News"] == 0 and got["Shop"] == 1 and got["overall"] == pytest.approx(10 / 11)
    cells = metrics.confusion_cells(metrics.confusion(scored))
    assert cells.count() == 44 and cells.agg(F.sum("n")).first()[0] == 120 * N
    r = metrics.multi_label_samples(scored).first()
    assert (r.n_samples, r.n_multi_label) == (120, sum(sum(y) > 1 for _, y, _, _ in data))


def test_wide_table_goes_back_and_forth(scored):
    rows = scored.withColumns({"url": F.col("id").cast("string"), "title": F.lit("t"), "combined_text": F.lit("c")})
    wide = scoring.wide_results(rows)
    assert len(wide.columns) == 36
    back = {r.url: (list(r.y), list(r.prob), list(r.pred)) for r in scoring.from_wide(wide).collect()}
    assert back == {str(r.id): (list(r.y), list(r.prob), list(r.pred)) for r in scored.collect()}
    assert scoring.long_results(scored, "id").count() == 120 * N


def test_model_choice(spark):
    rows = [("a", "f1_macro", 0.5), ("b", "f1_macro", 0.7), ("c", "f1_macro", 0.7), ("a", "hamming_loss", 0.9)]
    table = spark.createDataFrame(rows, "model string, metric string, value double")
    assert metrics.best_model(table).first().asDict() == {"model": "b", "value": 0.7}
    both = metrics.compared(table.filter("model = 'a'"), table.filter("model = 'b'")).collect()
    assert [(r.metric, r.trained, r.baseline) for r in both] == [("f1_macro", 0.5, 0.7)]
