import numpy as np
import pytest
from pyspark.sql import functions as F

from pagelens.operators import embedding, scorematrix


def cosine(a, b):
    return 1 - np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(3, 8))
    return [(i, (centres[i % 3] + 0.2 * rng.normal(size=8)).tolist(), -1 if i % 10 == 0 else i % 3) for i in range(45)]


@pytest.fixture(scope="module")
def items(spark, vectors):
    return spark.createDataFrame(vectors, "id int, embedding array<double>, cluster int").repartition(5).cache()


@pytest.mark.parametrize("blocks", [1, 4])
def test_all_pairs_once(vectors, items, blocks):
    got = {(r.i, r.j): r.distance for r in embedding.cosine_pairs(items, "id", blocks=blocks).collect()}
    assert len(got) == 45 * 44 // 2 and all(i < j for i, j in got)
    for (i, j), d in got.items():
        assert d == pytest.approx(cosine(vectors[i][1], vectors[j][1])) and -1e-9 <= d <= 2 + 1e-9


def test_matrix_neighbours_and_extremes(vectors, items):
    pairs = embedding.cosine_pairs(items, "id").cache()
    matrix = {(r.i, r.j): r.distance for r in embedding.square_matrix(pairs, items, "id").collect()}
    assert len(matrix) == 45 * 45 and matrix[3, 3] == 0 and matrix[2, 5] == matrix[5, 2]
    near = {(r.i, r["rank"]): r.j for r in embedding.neighbours(pairs).filter("kind = 'nearest'").collect()}
    far = {(r.i, r["rank"]): r.j for r in embedding.neighbours(pairs).filter("kind = 'farthest'").collect()}
    for i in range(45):
        order = sorted((j for j in range(45) if j != i), key=lambda j: (matrix[i, j], j))
        assert [near[i, r] for r in (1, 2, 3)] == order[:3]
        assert [far[i, r] for r in (1, 2, 3)] == order[::-1][:3]
    ends = {r.kind: (r.i, r.j) for r in embedding.extreme_pairs(pairs).collect()}
    ordered = sorted((p for p in matrix if p[0] < p[1]), key=lambda p: matrix[p])
    assert ends == {"closest": ordered[0], "farthest": ordered[-1]}
    bins = embedding.histogram(pairs, 0, 2, 20)
    assert bins.agg(F.sum("n")).first()[0] == 990
    curve = [(r.x, r.density) for r in embedding.density(pairs, -1, 3, 201).collect()]
    assert sum(y for _, y in curve) * 0.02 == pytest.approx(1, abs=0.01)


def test_odd_vectors(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, [-1.0, 0.0])], "id int, embedding array<double>")
    got = {(r.i, r.j): r.distance for r in embedding.cosine_pairs(df, "id").collect()}
    assert (got[1, 2], got[1, 4], got[1, 3]) == (0.0, 2.0, None)


def silhouette(vectors):
    used = [(np.array(v), c) for _, v, c in vectors if c != -1]
    scores = []
    for i, (v, c) in enumerate(used):
        by = {}
        for j, (w, d) in enumerate(used):
            if i != j:
                by.setdefault(d, []).append(cosine(v, w))
        if c not in by:
            scores.append(0.0)
            continue
        a, b = np.mean(by[c]), min(np.mean(x) for d, x in by.items() if d != c)
        scores.append((b - a) / max(a, b))
    return np.mean(scores)


@pytest.mark.parametrize("per_chunk", [500, 1])
def test_silhouette_equals_all_pairs(monkeypatch, spark, vectors, per_chunk):
    monkeypatch.setattr(embedding, "CLUSTERS_PER_CHUNK", per_chunk)
    data = vectors + [(99, [1.0] * 8, 7)]  # a singleton cluster
    df = spark.createDataFrame(data, "id int, embedding array<double>, cluster int").repartition(3)
    assert embedding.silhouette(df, "id").first().silhouette == pytest.approx(silhouette(data))
    assert embedding.silhouette(df.filter("cluster = 1"), "id").first().silhouette is None


def test_centroids_and_members(vectors, items):
    got = {r.cluster: r for r in embedding.centroids(items).collect()}
    for c in range(3):
        want = np.mean([v for _, v, d in vectors if d == c], axis=0)
        assert np.allclose(got[c].embedding, want)
    members = embedding.cluster_members(items, "id").collect()
    assert len(members) == 45 and {r.cluster_name for r in members} == {"Noise", "Cluster 0", "Cluster 1", "Cluster 2"}
    assert embedding.cluster_members(items.filter("cluster = 1"), "id").count() == 0


def test_density_clusters(vectors, items):
    pairs = embedding.cosine_pairs(items, "id")
    got = {r.id: r.cluster for r in embedding.density_clusters(pairs, items, "id", eps=0.15).collect()}
    parent = list(range(45))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(45):
        for j in range(i):
            if cosine(vectors[i][1], vectors[j][1]) <= 0.15:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    roots = [root(i) for i in range(45)]
    assert got == {i: (roots[i] if roots.count(roots[i]) >= 2 else -1) for i in range(45)}


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(60)]
    hub = [(1000, 1001 + i) for i in range(300)]
    df = spark.createDataFrame(chain + hub + [(5000, 5001)], "i bigint, j bigint")
    got = {r.id: r.component for r in embedding.connected_components(df).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 1000 for i in range(1000, 1301)}, 5000: 5000, 5001: 5000}


def test_projection_keeps_most_variance(vectors, items):
    out = embedding.projected(items).collect()
    points = np.array([r.projection for r in sorted(out, key=lambda r: r.id)])
    x = np.array([v for _, v, _ in vectors])
    values = np.linalg.eigvalsh(np.cov(x.T))
    assert points.shape == (45, 2)
    assert np.cov(points.T).trace() == pytest.approx(values[-2:].sum())


def test_plugged_encoder(spark):
    df = spark.createDataFrame([("ab",), ("c",)], "text string")
    out = embedding.encoded(df, lambda texts: [[float(len(t)), 1.0] for t in texts]).collect()
    assert sorted(list(r.embedding) for r in out) == [[1.0, 1.0], [2.0, 1.0]]


@pytest.fixture(scope="module")
def attention(spark):
    rng = np.random.default_rng(3)
    tokens = [["[CLS]", "a", "b", ":", "c", "d", "[SEP]"], ["[CLS]", ":", "b", "c", "d", "e", "[SEP]"], ["[CLS]", "a", "b", "c", "[SEP]"]]
    rows = []
    for e, t in enumerate(tokens):
        for layer in range(2):
            for head in range(3):
                w = rng.random((len(t), len(t)))
                rows.append((e, layer, head, t, (w / w.sum(axis=1, keepdims=True)).tolist()))
    table = spark.createDataFrame(rows, "example int, layer int, head int, tokens array<string>, weights array<array<double>>").cache()
    return rows, table


def test_attention_scores(attention):
    rows, table = attention
    focus = {(r.layer, r.head): r.score for r in scorematrix.focus_scores(table).collect()}
    with_sep = scorematrix.with_separator(table)
    cross = {(r.layer, r.head): r.score for r in scorematrix.cross_segment_scores(with_sep).collect()}
    for layer in range(2):
        for head in range(3):
            mats = [(e, np.array(w)) for e, a, b, t, w in rows if (a, b) == (layer, head)]
            want = np.mean([10 + (m[0] * np.log2(m[0] + 1e-10)).sum() for _, m in mats])
            assert focus[layer, head] == pytest.approx(want)
            m = mats[0][1]  # the only example with a usable separator
            assert cross[layer, head] == pytest.approx((m[1:3, 4:6].mean() + m[4:6, 1:3].mean()) / 2)
    by_table = scorematrix.with_separator(table.drop("tokens"), table.select("example", "tokens").distinct())
    assert {(r.layer, r.head): r.score for r in scorematrix.cross_segment_scores(by_table).collect()} == pytest.approx(cross)
    none = scorematrix.cross_segment_scores(with_sep.filter("example > 0")).collect()
    assert len(none) == 6 and all(r.score == 0 for r in none)
    last = {(r.example, r.k): r.weight for r in scorematrix.attention_from_first(table, 2).collect()}
    mean = np.mean([np.array(w)[0] for e, a, _, _, w in rows if e == 0 and a == 1], axis=0)
    assert [last[0, k] for k in range(7)] == pytest.approx(list(mean))
    middle = scorematrix.attention_to_separator(with_sep, 2).collect()
    assert {r.example for r in middle} == {0, 1}


def test_head_lists(spark):
    a = spark.createDataFrame([(0, 0, 1.0), (0, 1, 3.0), (1, 0, 1.0), (1, 1, 5.0)], "layer int, head int, score double")
    b = a.withColumn("score", F.when(F.col("head") == 0, 2.0).otherwise(F.col("layer") + 0.5))
    scaled = {(r.layer, r.head): r.score for r in scorematrix.scaled(a).collect()}
    assert scaled[1, 1] == pytest.approx(1) and scaled[0, 0] == 0
    columns = {(r.layer, r.head): r.score for r in scorematrix.scaled_by_head(b).collect()}
    assert columns == {(0, 0): 0.0, (1, 0): 0.0, (0, 1): 0.0, (1, 1): 1.0}
    assert [(r.layer, r.head) for r in scorematrix.top_heads(a, 3).collect()] == [(1, 1), (0, 1), (0, 0)]
    top_a, top_b = scorematrix.top_heads(a, 2), scorematrix.top_heads(b, 2)
    assert [(r.layer, r.head) for r in scorematrix.in_both(top_a, top_b).collect()] == []
    assert [(r.layer, r.head) for r in scorematrix.in_either(top_a, top_b).collect()] == [(0, 0), (0, 1), (1, 0), (1, 1)]
    product = {(r.layer, r.head): r.score for r in scorematrix.combined(a, b).collect()}
    assert product[1, 1] == pytest.approx(5 * (1.5 + 1e-6))


def test_token_report(spark):
    df = spark.createDataFrame([(["a", "b", "c"], [[0.03, 0.04], [0.001, 0.0], [1.0, 0.0]])],
                               "tokens array<string>, gradients array<array<double>>")
    report = scorematrix.token_report(df).first().report
    assert [(p.token, round(p.importance, 4)) for p in report] == [("a", 0.05), ("c", 1.0)]
    assert len(scorematrix.token_report(df, n=1).first().report) == 1
