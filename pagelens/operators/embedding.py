"""Embeddings: category vectors, cosine distances, neighbours, clusters."""

from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window, functions as F, types as T

from pagelens.functions import vectors as v
from pagelens.functions.stages import computed
from pagelens.session import ensure_checkpoint_dir

NOISE = -1

# Items meet the clusters' mean vectors in chunks of about this many.
CLUSTERS_PER_CHUNK = 500


def encoded(texts: DataFrame, encode_batch, text: str = "text", out: str = "embedding") -> DataFrame:
    """Add vectors from ``encode_batch(list of texts) -> list of vectors``, called per Arrow batch."""
    schema = T.StructType(texts.schema.fields + [T.StructField(out, T.ArrayType(T.FloatType()))])

    def run(frames):
        for frame in frames:
            yield frame.assign(**{out: list(encode_batch(frame[text].tolist()))})

    return texts.mapInPandas(run, schema)


def mean_vectors(items: DataFrame, group: str, vector: str = "embedding") -> DataFrame:
    """(group, embedding, n): the mean vector of each group. The vectors are summed up on the map side,
    so a hot group sends one partial sum per task."""
    numbers = items.select(group, array_to_vector(v.as_double(F.col(vector))).alias("_vector"))
    means = numbers.groupBy(group).agg(Summarizer.mean(F.col("_vector")).alias("_mean"), F.count("*").alias("n"))
    return means.select(group, vector_to_array("_mean").alias("embedding"), "n")


def centroids(clustered: DataFrame, cluster: str = "cluster", vector: str = "embedding") -> DataFrame:
    """Mean vector of each cluster, noise left out."""
    return mean_vectors(clustered.filter(F.col(cluster) != NOISE), cluster, vector)


def cosine_pairs(items: DataFrame, key: str, vector: str = "embedding", blocks: int = 4) -> DataFrame:
    """(i, j, distance) with i < j for all pairs of a list of items, such as categories or centroids.

    The pairs are the result, so the list should be one whose square is wanted. Items are dealt into
    blocks by a hash of the key; every pair of blocks is one join key, so the work spreads over
    blocks * (blocks + 1) / 2 keys of equal weight. Zero vectors have no direction: distance NULL.
    """
    units = computed(items.select(F.col(key).alias("id"), v.unit(v.as_double(F.col(vector))).alias("u")), "u")
    units = units.withColumn("_block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    low = units.select("id", "u", F.col("_block").alias("_low"),
                       F.explode(F.sequence("_block", F.lit(blocks - 1))).alias("_high"))
    high = units.select(F.col("id").alias("id2"), F.col("u").alias("u2"), F.col("_block").alias("_high"),
                        F.explode(F.sequence(F.lit(0), "_block")).alias("_low"))
    pairs = low.join(high, ["_low", "_high"]).filter((F.col("_low") < F.col("_high")) | (F.col("id") < F.col("id2")))
    distance = F.lit(1.0) - v.dot(F.col("u"), F.col("u2"))
    return pairs.select(F.least("id", "id2").alias("i"), F.greatest("id", "id2").alias("j"), distance.alias("distance"))


def square_matrix(pairs: DataFrame, items: DataFrame, key: str) -> DataFrame:
    """(i, j, distance) in both directions, with a zero diagonal."""
    both = pairs.select(F.inline(F.array(F.struct("i", "j", "distance"),
                                         F.struct(F.col("j").alias("i"), F.col("i").alias("j"), "distance"))))
    return both.unionByName(items.select(F.col(key).alias("i"), F.col(key).alias("j"), F.lit(0.0).alias("distance")))


def neighbours(pairs: DataFrame, k: int = 3) -> DataFrame:
    """(i, kind, rank, j, distance): the k nearest and the k farthest other items of each item.

    The k farthest of an item are pruned in every task before the shuffle, as are the k nearest.
    """
    both = pairs.select(F.inline(F.array(F.struct("i", "j", "distance"),
                                         F.struct(F.col("j").alias("i"), F.col("i").alias("j"), "distance"))))

    def ranked(kind, order):
        place = Window.partitionBy("i").orderBy(order, "j")
        return (both.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
                .select("i", F.lit(kind).alias("kind"), "rank", "j", "distance"))

    return ranked("nearest", F.asc("distance")).unionByName(ranked("farthest", F.desc("distance")))


def extreme_pairs(pairs: DataFrame) -> DataFrame:
    """(kind, i, j, distance): the closest and the farthest pair, the first one on ties."""
    ends = pairs.agg(F.min(F.struct("distance", "i", "j")).alias("closest"),
                     F.min(F.struct((-F.col("distance")).alias("distance"), "i", "j")).alias("farthest"))
    return ends.select(F.inline(F.array(
        F.struct(F.lit("closest").alias("kind"), F.col("closest.i").alias("i"), F.col("closest.j").alias("j"),
                 F.col("closest.distance").alias("distance")),
        F.struct(F.lit("farthest").alias("kind"), F.col("farthest.i").alias("i"), F.col("farthest.j").alias("j"),
                 (-F.col("farthest.distance")).alias("distance")))))


def histogram(pairs: DataFrame, low: float = 0.0, high: float = 2.0, bins: int = 40) -> DataFrame:
    """(bin, low, high, n): counts in equal bins of a distance range; the last bin is closed."""
    width = (high - low) / bins
    number = F.least(F.floor((F.col("distance") - low) / width), F.lit(bins - 1)).cast("int")
    return (pairs.filter(F.col("distance").between(low, high)).groupBy(number.alias("bin"))
            .agg(F.count("*").alias("n"))
            .select("bin", (low + F.col("bin") * width).alias("low"), (low + (F.col("bin") + 1) * width).alias("high"), "n"))


def density(pairs: DataFrame, low: float = 0.0, high: float = 2.0, points: int = 41) -> DataFrame:
    """(x, density): Gaussian kernel density of the distances on a grid, bandwidth by Scott's rule."""
    stats = pairs.agg(F.struct(F.count("distance").alias("n"), F.stddev_samp("distance").alias("s")).alias("b")).scalar()
    grid = F.array(*[F.lit(low + (high - low) * i / (points - 1)) for i in range(points)])
    at = pairs.filter("distance is not null").select(
        "distance", stats["n"].alias("n"), (stats["s"] * F.pow(stats["n"].cast("double"), F.lit(-0.2))).alias("h"),
        F.explode(grid).alias("x"))
    z = (F.col("x") - F.col("distance")) / F.col("h")
    kernel = F.exp(-z * z / 2) / (F.col("n") * F.col("h") * F.sqrt(2 * F.pi()))
    return at.groupBy("x").agg(F.sum(kernel).alias("density"))


def projected(items: DataFrame, vector: str = "embedding", k: int = 2, out: str = "projection") -> DataFrame:
    """Add the first k principal components of each vector. A component's sign is the one that makes its largest
    weight positive."""
    prepared = items.withColumn("_vector", array_to_vector(v.as_double(F.col(vector))))
    model = PCA(k=k, inputCol="_vector", outputCol="_projection").fit(prepared.select("_vector"))
    weights = model.pc.toArray()
    signs = F.array(*[F.lit(1.0 if max(column, key=abs) >= 0 else -1.0) for column in weights.T.tolist()])
    values = F.zip_with(vector_to_array("_projection"), signs, lambda x, sign: x * sign)
    return model.transform(prepared).withColumn(out, values).drop("_vector", "_projection")


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) for the nodes of an edge table (i, j); the component is its smallest node.

    Alternates the two star operations of Kiveris et al., "Connected Components in MapReduce and
    Beyond" (2014), which need a number of rounds logarithmic in the graph. Each round is written to
    the checkpoint folder, so a lost executor costs at most one round.
    """
    ensure_checkpoint_dir(edges.sparkSession)

    def large_star(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        return both.filter("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))

    def small_star(e):
        down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        smallest = down.groupBy("u").agg(F.min("v").alias("m"))
        moved = down.join(smallest, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        return moved.unionByName(smallest.select("u", F.col("m").alias("v"))).distinct()

    def state(e):
        return e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    current = edges.filter("i <> j").select(F.col("i").alias("u"), F.col("j").alias("v")).distinct().checkpoint()
    before = None
    while (now := state(current)) != before:
        before = now
        current = small_star(large_star(current).distinct()).checkpoint()
    nodes = current.select(F.col("u").alias("id"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return nodes.unionByName(roots)


def density_clusters(pairs: DataFrame, items: DataFrame, key: str, eps: float, min_cluster_size: int = 2,
                     min_samples: int = 1) -> DataFrame:
    """(key, cluster): components of the graph of pairs within ``eps``, numbered by their smallest item;
    items in smaller components, or with too few close items, are noise."""
    close = pairs.filter(F.col("distance") <= eps).select("i", "j")
    if min_samples > 1:
        ends = close.select(F.explode(F.array("i", "j")).alias("id"))
        core = ends.groupBy("id").count().filter(F.col("count") >= min_samples).select("id")
        close = (close.join(core.withColumnRenamed("id", "i"), "i", "left_semi")
                 .join(core.withColumnRenamed("id", "j"), "j", "left_semi"))
    components = connected_components(close)
    large = components.groupBy("component").agg(F.count("*").alias("n")).filter(F.col("n") >= min_cluster_size)
    members = components.join(large, "component").select(F.col("id").alias(key), F.col("component").alias("cluster"))
    return (items.select(key).join(members, key, "left")
            .select(key, F.coalesce("cluster", F.lit(NOISE)).alias("cluster")))


def silhouette(clustered: DataFrame, key: str, cluster: str = "cluster", vector: str = "embedding") -> DataFrame:
    """Mean cosine silhouette without noise, NULL for fewer than two clusters. Exact and linear.

    The mean cosine distance from a unit vector to a cluster is 1 minus its product with the mean of
    the cluster's unit vectors, so no pair of items is ever formed.
    """
    ensure_checkpoint_dir(clustered.sparkSession)
    units = (clustered.filter(F.col(cluster) != NOISE)
             .select(F.col(key).alias("key"), F.col(cluster).alias("cluster"), v.unit(v.as_double(F.col(vector))).alias("u")))
    units = computed(units, "u").filter("u is not null")
    clusters = mean_vectors(units, "cluster", "u").checkpoint()
    n_clusters = clusters.count()
    as_list = F.collect_list(F.struct("cluster", "n", F.col("embedding").alias("c")))
    # Items are dealt into parts by a hash; each part meets every chunk, so no join key holds all items.
    chunks = max(1, -(-n_clusters // CLUSTERS_PER_CHUNK))
    dealt = int(clustered.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = (clusters.withColumn("chunk", F.pmod(F.xxhash64("cluster"), F.lit(chunks)).cast("int"))
              .groupBy("chunk").agg(as_list.alias("others"))
              .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(dealt - 1)))))
    placed = units.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(dealt)).cast("int"))
    placed = placed.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))).join(pieces, ["part", "chunk"])
    parts = _compare(placed, ["key", "cluster"]).groupBy("key", "cluster").agg(
        F.max("own").alias("own"), F.max("n").alias("n"), F.min("b").alias("b"))
    return _mean_silhouette(parts, n_clusters)


def _compare(placed, keep):
    """Mean distance to the other clusters in a list, and to the own one when it is in the list."""
    distances = F.transform("others", lambda o: F.struct(
        o["cluster"].alias("cluster"), o["n"].alias("n"), (F.lit(1.0) - v.dot(F.col("u"), o["c"])).alias("d")))
    placed = computed(placed.withColumn("_d", distances), "_d")
    own = F.get(F.filter("_d", lambda d: d["cluster"] == F.col("cluster")), F.lit(0))
    nearest = F.array_min(F.transform(F.filter("_d", lambda d: d["cluster"] != F.col("cluster")), lambda d: d["d"]))
    return placed.select(*keep, own["d"].alias("own"), own["n"].alias("n"), nearest.alias("b"))


def _mean_silhouette(parts, n_clusters):
    # The own mean includes the item itself at distance 0; a singleton counts as 0.
    a = F.col("own") * F.col("n") / (F.col("n") - 1)
    s = F.when(F.col("n") == 1, 0.0).otherwise(F.coalesce(F.try_divide(F.col("b") - a, F.greatest("b", a)), F.lit(0.0)))
    value = F.avg(s) if n_clusters > 1 else F.lit(None).cast("double")
    return parts.agg(value.alias("silhouette"), F.count("*").alias("n_items")).withColumn("n_clusters", F.lit(n_clusters))


def cluster_members(clustered: DataFrame, key: str, cluster: str = "cluster") -> DataFrame:
    """(cluster_name, key) rows, if there is more than one cluster; noise has its own name.

    Members stay rows: a cluster may be any size.
    """
    name = F.when(F.col(cluster) == NOISE, "Noise").otherwise(F.concat(F.lit("Cluster "), F.col(cluster).cast("string")))
    several = clustered.agg((F.min(cluster) != F.max(cluster)).alias("several")).scalar()
    return clustered.filter(several).select(name.alias("cluster_name"), key)


def cluster_sizes(clustered: DataFrame, cluster: str = "cluster") -> DataFrame:
    return clustered.groupBy(cluster).agg(F.count("*").alias("n"))
