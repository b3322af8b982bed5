import pandas as pd
import pytest
from pyspark.sql import functions as F

from pagelens.labels import LABELS, index_of, label_dimension, label_of
from pagelens.operators import analysis, features, labelling, model, scoring


def one(rows, function, *texts, schema="i int, t string"):
    df = rows(list(enumerate(texts)), schema)
    return [r.x for r in df.select("i", function(F.col("t")).alias("x")).orderBy("i").collect()]


def test_label_dimension(spark):
    assert [(r.label_idx, r.label) for r in label_dimension(spark).orderBy("label_idx").collect()] == list(enumerate(LABELS))
    r = spark.range(1).select(index_of(F.lit("Shop")).alias("i"), index_of(F.lit("shop")).alias("n"), label_of(F.lit(9)).alias("l")).first()
    assert (r.i, r.n, r.l) == (2, None, "Travel")


def test_validation(rows):
    texts = ["News", "News,News", "news", "News, Shop ,Work", "News,Shop,Work,Chat", "", ",", "News,", "Uncategorized", None]
    assert one(rows, labelling.is_valid, *texts) == [True, True, False, True, False, False, False, False, True, False]


def test_clean_labels(rows):
    texts = ["Uncategorized", "Uncategorized, News", "Uncategorized,Uncategorized", " News ,Shop", ""]
    assert one(rows, labelling.clean_labels, *texts) == [["Uncategorized"], ["News"], ["Uncategorized"], ["News", "Shop"], [""]]


def test_bracketed(rows):
    assert one(rows, labelling.parse_bracketed, "[A, B]", "A", None, "[]") == [["A", "B"], ["A"], [], [""]]
    hot = one(rows, lambda c: labelling.multi_hot(labelling.parse_bracketed(c)), "[News, Travel]")
    assert hot == [[1.0 if n in ("News", "Travel") else 0.0 for n in LABELS]]


def test_prompt_holds_the_page(rows):
    df = rows([("u", "t", "s", None, "m")], "url string, title string, snippet string, language string, meta_description string")
    text = df.select(labelling.prompt().alias("p")).first().p
    assert all(part in text for part in ["URL: u\n", "Title: t\n", "Snippet: s\n", "Language: \n", "Description: m\n"] + LABELS)
    assert df.select(labelling.prompt("{title}-{url}").alias("p")).first().p == "t-u"


def test_retries():
    calls, pauses = [], []

    def flaky(frame):
        calls.append(len(frame))
        if len(calls) < 3:
            raise RuntimeError
        return ["News"] * len(frame)

    frame = pd.DataFrame({"url": ["a", "b"]})
    assert labelling.with_retries(flaky, wait=4.0, sleep=pauses.append)(frame) == ["News", "News"]
    assert 4 <= pauses[0] <= 4.4 and 8 <= pauses[1] <= 8.8

    def always(frame):
        raise RuntimeError
    pauses.clear()
    assert labelling.with_retries(always, sleep=pauses.append)(frame) == [None, None]
    assert len(pauses) == 4 and max(pauses) <= 66


def test_failing_labeller_gives_no_rows(spark):
    def broken(frame):
        raise RuntimeError
    df = spark.createDataFrame([("u", "t")], "url string, title string")
    out = labelling.label_pages(df, broken, parallelism=2, attempts=2, wait=0.0)
    assert [r.category for r in out.collect()] == [None]
    assert labelling.successful(out).count() == 0


def test_pending_batches(spark):
    pages, done = spark.range(100).withColumnRenamed("id", "k"), spark.range(0, 100, 4).withColumnRenamed("id", "k")
    out = labelling.pending(pages, done, "k", target=50, batch=10).collect()
    assert sorted(r.k for r in out) == [k for k in range(100) if k % 4][:25]
    assert sorted({r.batch_no for r in out}) == [0, 1, 2]
    assert labelling.pending(pages, done, "k", target=20).count() == 0


@pytest.fixture
def pages(rows):
    data = [(1, ["News", "Shop"]), (2, ["News"]), (3, ["News", "News", "Chat"]), (4, []), (5, ["Other", "Shop"]), (6, None)]
    return rows(data, "id int, category array<string>")


def test_label_analysis(pages):
    assert analysis.exploded(pages).count() == 10
    assert {r.label: r.n for r in analysis.label_counts(pages).collect()} == {"News": 4, "Shop": 2, "Chat": 1, "Other": 1}
    assert [r.label for r in analysis.by_count(analysis.label_counts(pages, LABELS)).collect()] == ["News", "Shop", "Chat"]
    matrix = {(r.cat1, r.cat2): r.n for r in analysis.cooccurrence(pages).collect()}
    assert len(matrix) == 121
    assert (matrix["News", "News"], matrix["News", "Shop"], matrix["Chat", "News"], matrix["Work", "Work"]) == (3, 1, 1, 0)
    assert all(matrix[a, b] == matrix[b, a] for a, b in matrix)
    p = {(r.cat1, r.cat2): r.p for r in analysis.conditional_probability(pages).collect()}
    assert (p["News", "Shop"], p["Shop", "News"], p["News", "News"], p["Work", "News"]) == (0.25, 0.5, 0.0, 0.0)
    lower = {(r.cat1, r.cat2) for r in analysis.lower_triangle(analysis.cooccurrence(pages)).collect()}
    assert len(lower) == 55 and ("Shop", "News") in lower and ("News", "Shop") not in lower
    assert {r.combination: r.n for r in analysis.combination_counts(pages).collect()} == {
        "News + Shop": 1, "News": 1, "Chat + News + News": 1, "Other + Shop": 1}
    assert [r.text for r in analysis.by_count(analysis.label_shares(pages)).collect()] == ["57.1%", "28.6%", "14.3%"]
    square = analysis.as_square(analysis.cooccurrence(pages), "n")
    assert square.count() == 11 and square.filter("cat1 = 'News'").first().Shop == 1


def test_box_statistics(rows):
    values = [1, 2, 3, 4, 5, 6, 7, 8, 9, 100]
    df = rows([(["News"], x) for x in values], "category array<string>, x int")
    r = analysis.box_statistics(df, ["x"]).first()
    assert (r.n_pages, r.q1, r.median, r.q3, r.whisker_low, r.whisker_high, r.n_outliers) == (10, 3.25, 5.5, 7.75, 1.0, 9.0, 1)


def test_split_is_stable(spark):
    df = spark.range(5000).select(F.concat(F.lit("http://x/"), F.col("id").cast("string")).alias("url"))
    a = {r.url: r.split for r in features.with_split(df).collect()}
    assert a == {r.url: r.split for r in features.with_split(df.repartition(9)).collect()}
    share = sum(s == "validation" for s in a.values()) / 5000
    assert 0.08 < share < 0.12


def test_reading_scores(rows):
    prob = [0.1] * 11
    prob[3], prob[7] = 0.5, 0.9
    low = [0.2] * 11
    df = rows([(1, prob), (2, low)], "id int, prob array<double>")
    c = F.col("prob")
    out = df.select("id", scoring.labels_over(c).alias("over"), scoring.labels_over(c, inclusive=False).alias("strict"),
                    scoring.probabilities_over(c).alias("map"), scoring.labels_or_best(c).alias("some"),
                    scoring.best_with_percent(c).alias("best")).orderBy("id").collect()
    assert out[0].over == ["Chat", "Technology"] and out[0].strict == ["Technology"]
    assert out[0]["map"] == {"Chat": 0.5, "Technology": 0.9}
    assert out[0].best == "Technology (90.00%)"
    assert out[1].over == [] and out[1].some == ["News"] and out[1].best == "News (20.00%)"


def test_trained_model_separates_labels(spark):
    data = []
    for i in range(240):
        words = {"News": "report today", "Shop": "buy cart price", "Travel": "hotel flight"}
        present = [n for j, n in enumerate(words) if (i >> j) & 1]
        data.append((i, " ".join(words[n] for n in present) + f" page{i % 7}", [1.0 if n in present else 0.0 for n in LABELS]))
    df = spark.createDataFrame(data, "id int, text string, label_vector array<double>")
    trained = model.train(df, n_features=1 << 10, epochs=10)
    out = trained.transform(df).collect()
    right = sum([float(p) for p in r.pred] == list(r.label_vector) for r in out)
    assert right >= 235
    assert all(len(r.prob) == 11 and r.prob[1] == 0.0 for r in out)


def test_a_bad_row_fails_alone_and_invalid_answers_are_asked_for_again(spark):
    import pandas as pd
    asked = []

    def labeller(frame):
        asked.append(len(frame))
        if "bad" in list(frame["url"]):
            raise RuntimeError
        return ["News" if len(asked) > 2 or url != "odd" else "no label" for url in frame["url"]]

    call = labelling.with_retries(labeller, attempts=3, wait=0.0, sleep=lambda s: None)
    assert call(pd.DataFrame({"url": ["a", "odd"]})) == ["News", "News"] and asked == [2, 1, 1]
    assert call(pd.DataFrame({"url": ["a", "bad", "b"]})) == ["News", None, "News"]


def test_rows_of_several_files_are_all_labelled(spark, tmp_path):
    from pagelens.streaming import crawl
    pages = spark.createDataFrame([(f"http://h{f}/{n}", n, "t", "s", "en", "m") for f in range(3) for n in range(1, 6)],
                                  "url string, record_no long, title string, snippet string, language string, meta_description string")
    out = str(tmp_path / "labels")
    for target in (4, 100, None):
        crawl.label_pending(pages, out, lambda frame: ["News"] * len(frame), target=target)
    assert sorted(r.url for r in spark.read.parquet(out).collect()) == sorted(r.url for r in pages.collect())


def _examples(spark, n=400):
    import random
    r = random.Random(3)
    words = {"News": "report today", "Shop": "buy cart price", "Travel": "hotel flight"}
    data = []
    for i in range(n):
        present = [name for name in words if r.random() < 0.4]
        noise = " ".join(f"w{r.randint(0, 60)}" for _ in range(r.randint(0, 5)))
        data.append((i, " ".join(words[name] for name in present) + " " + noise, [float(name in present) for name in LABELS], r.random() < 0.2))
    return spark.createDataFrame(data, "id int, text string, label_vector array<double>, held boolean")


@pytest.mark.parametrize("tasks", [5, 100])
def test_objective_is_loss_and_gradient(spark, tasks):
    """The sums of one pass against plain numpy, and the gradient against differences of the loss."""
    import numpy as np
    rng = np.random.default_rng(1)
    rows = [(rng.integers(0, 30, rng.integers(0, 8)).tolist(), rng.integers(0, 2, 3).astype(float).tolist(), bool(rng.random() < 0.3)) for _ in range(50)]
    prepared = spark.createDataFrame(rows, "indexes array<int>, y array<double>, held boolean").repartition(5)
    rarity = rng.random(30) + 0.5
    objective = model._Objective(prepared, np.arange(30), rarity, 3, tasks, 0.01)
    theta = rng.normal(size=(31, 3))
    loss, gradient, f1 = objective(theta)

    def plain(theta):
        x = np.array([np.bincount(np.array(i, int), minlength=30) for i, _, held in rows if not held]) * rarity
        y = np.array([y for _, y, held in rows if not held])
        z = x @ theta[:-1] + theta[-1]
        return (np.logaddexp(0, z) - y * z).sum() / len(y) + 0.005 * (theta[:-1] ** 2).sum()

    assert abs(loss - plain(theta)) < 1e-9
    for i, j in [(0, 0), (7, 2), (29, 1), (30, 0), (30, 2)]:
        step = np.zeros_like(theta)
        step[i, j] = 1e-5
        assert abs((plain(theta + step) - plain(theta - step)) / 2e-5 - gradient[i, j]) < 1e-7
    x = np.array([np.bincount(np.array(i, int), minlength=30) for i, _, held in rows if held]) * rarity
    y, pred = np.array([y for _, y, held in rows if held]), x @ theta[:-1] + theta[-1] >= 0
    tp, fp, fn = ((pred & (y == 1)).sum(0), (pred & (y == 0)).sum(0), (~pred & (y == 1)).sum(0))
    assert abs(f1 - np.mean(2 * tp / np.maximum(2 * tp + fp + fn, 1))) < 1e-12


def test_gradients_do_not_reach_the_driver(spark, monkeypatch):
    import pickle
    from pyspark import RDD
    rows = [(" ".join(f"w{i}x{j}" for j in range(20)) + (" buy" if i % 3 else " report"), [float(bool(i % 3) == (k == 1)) for k in range(11)]) for i in range(300)]
    df = spark.createDataFrame(rows, "text string, label_vector array<double>")
    got = []
    for kind in (RDD, type(df)):
        def collect(self, old=kind.collect):
            found = old(self)
            got.append(len(pickle.dumps(found)))
            return found
        monkeypatch.setattr(kind, "collect", collect)
    trained = model.train(df, n_features=1 << 13, epochs=6, tolerance=0)
    weights = 8 * 11 * int((trained.weights != 0).any(axis=1).sum())
    assert weights > 300_000 and len(trained.history) == 7
    assert sum(got) < 2 * weights  # The weights once, at the end, and sums.


def test_training_keeps_the_best_epoch_and_can_go_on(spark, tmp_path):
    df = _examples(spark)
    trained = model.train(df, n_features=1 << 12, held_out=F.col("held"), tolerance=1e-3, checkpoint=str(tmp_path / "steps"))
    losses, kept = [h[1] for h in trained.history], [h for h in trained.history if h[3]]
    assert all(b < a for a, b in zip(losses, losses[1:])) and len(kept) == 1 and len(losses) < 100
    assert kept[0][2] == max(h[2] for h in trained.history[1:]) > trained.history[0][2]
    first = model.MultiLabelModel.load(spark, str(tmp_path / "steps"), "epoch-1")
    again = model.train(df, n_features=1 << 12, held_out=F.col("held"), tolerance=1e-3, start=first)
    assert abs(again.history[0][1] - losses[1]) < 1e-9 and again.history[-1][1] < losses[1]
    assert trained.epochs(spark).filter("kept").count() == 1


def test_model_store(spark, tmp_path):
    df = _examples(spark, 120)
    trained = model.train(df, n_features=1 << 11, epochs=5)
    trained.save(spark, str(tmp_path), "a")
    loaded = model.MultiLabelModel.load(spark, str(tmp_path), "a")
    assert loaded.labels == trained.labels and loaded.history == trained.history
    assert loaded.transform(df).collect() == trained.transform(df).collect()
    with pytest.raises(Exception):
        trained.save(spark, str(tmp_path), "a")
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "buy " * 2000), (4, "unseen")], "id int, text string")
    found = {r.id: r.prob for r in loaded.transform(odd).collect()}
    assert len(found) == 4 and found[1] == found[2] and found[3][2] > 0.9


def test_training_on_odd_examples(spark):
    schema = "text string, label_vector array<double>"
    some = [("a", [0.0] * 11), (None, [1.0] + [0.0] * 10), ("b", None), ("c", [1.0]), ("d", [None] * 11), ("", [0.0] * 10 + [1.0])]
    model.train(spark.createDataFrame(some, schema), n_features=64, epochs=3)
    nothing = model.train(spark.createDataFrame([], schema), n_features=64, epochs=3)
    assert nothing.transform(spark.createDataFrame([("x",)], "text string")).first().prob == [0.0] * 11


def test_keyword_labels_are_those_of_the_labeller(spark):
    keywords = {"blog.": "Entertainment", "shop": "Shop", "/fr/": "Travel", "tion": "News", "heed": "Health", "buy": "Shop"}
    data = [("http://blog.x/fr/shop", "ption heed"), ("http://a/", None), (None, None), ("http://shop", "buy it"), ("x", "no words"), ("", "")]
    df = spark.createDataFrame(data, "url string, title string")
    found = [r.c for r in df.select(labelling.keyword_labels(keywords).alias("c")).collect()]
    assert found == labelling.keyword_labeller(keywords)(pd.DataFrame(data, columns=["url", "title"]))
