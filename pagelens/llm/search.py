"""Exact top-k search by inner product: a cover tree over the queries meets a cover tree over the data."""

import heapq

from pyspark.sql import Window, functions as F

LEAF = 64
LARGEST = 1 << 20
ABSENT = -(1 << 63)  # The score of a place that no candidate has taken yet.


class CoverTree:
    """Nodes over the rows of ``points``: a center, which is a point, the radius that covers all points below, and children or,
    in a leaf, rows.

    A node of radius r is cut by a net of its points: centers more than r / 2 apart, and every point with
    the first center within r / 2. Parts of a net with fewer than ``leaf`` points are put together and cut between two
    points that are far apart, until they are leaves, so that what lies close stays together. Points that are all
    equal are one leaf.
    """

    def __init__(self, points, leaf=LEAF):
        import numpy as np
        self.points, self.leaf = points.astype("float64"), leaf
        self.centers, self.radii, self.children, self.below = [], [], [], []
        stack = [self.node(0, np.arange(len(points)))] if len(points) else []
        while stack:
            number = stack.pop()
            self.children[number] = [self.node(center, rows) for center, rows in self.parts(number)]
            stack += self.children[number]
        self.center_points = self.points[self.centers]
        self.radii = np.array(self.radii)
        self.norms = np.sqrt((self.center_points ** 2).sum(axis=1))

    def distances(self, center, rows):
        import numpy as np
        return np.sqrt(((self.points[rows] - self.points[center]) ** 2).sum(axis=1))

    def node(self, center, rows):
        self.centers.append(int(center))
        self.radii.append(float(self.distances(center, rows).max()))
        self.children.append([])
        self.below.append(rows)
        return len(self.centers) - 1

    def clustered(self, rows, width):
        """Whether half of the points have another one much nearer than they lie apart altogether."""
        import numpy as np
        some = self.points[rows]
        squares = (some * some).sum(axis=1)
        distances = squares[:, None] + squares - 2 * (some @ some.T)
        np.fill_diagonal(distances, np.inf)
        return np.median(distances.min(axis=1)) < (width / 4) ** 2

    def parts(self, number):
        """(center, rows) of the children; none for a leaf."""
        import numpy as np
        left, radius, small = self.below[number], self.radii[number], []
        if len(left) <= self.leaf or radius == 0:
            return
        far = self.distances(self.centers[number], left)
        left = left[np.argsort(far, kind="stable")]  # The node's own center leads the net.
        nets = 0
        while len(left):
            inside = self.distances(left[0], left) <= radius / 2
            members, left = left[inside], left[~inside]
            if self.leaf <= len(members) < len(self.below[number]):
                yield members[0], members
            else:
                small.append(members)
            nets += 1
            if nets >= self.leaf:  # Hardly anything lies close to anything: the rest is cut in halves.
                small.append(left)
                break
        todo = [np.concatenate(small)] if small else []
        while todo:
            rows = todo.pop()
            if not len(rows):
                continue
            one = rows[self.distances(rows[0], rows).argmax()]
            to_one = self.distances(one, rows)
            to_other = self.distances(rows[to_one.argmax()], rows)
            nearer, width = to_one <= to_other, to_one.max()
            if width == 0 or (len(rows) <= self.leaf and not self.clustered(rows, width)):
                middle = self.points[rows].mean(axis=0)
                yield rows[((self.points[rows] - middle) ** 2).sum(axis=1).argmin()], rows
            else:
                todo += [rows[nearer], rows[~nearer]]


class Search:
    """The ``k`` best candidates of each query so far; ``meet`` brings in the points of another block."""

    def __init__(self, queries, query_ids, k, leaf=LEAF):
        import numpy as np
        self.queries, self.query_ids, self.k, self.leaf = queries, query_ids, k, leaf
        self.tree = CoverTree(queries, leaf)
        self.scores = np.full((len(queries), k), ABSENT, "int64")
        self.ids = np.zeros((len(queries), k), "int64")
        self.compared = self.pairs = 0  # Pairs of leaves that were compared, and that there were.

    def worst(self, node):
        """The lowest k-th score of the queries below a node."""
        return self.scores[self.tree.below[node], -1].min()

    def meet(self, points, point_ids):
        """Pairs of nodes, the most promising ones first. A pair is cut when no query below one can score as high with a point
        below the other as the worst k-th score of these queries so far; the bound follows from the centers'
        product and the radii. Of other pairs the node with the larger radius is opened; two leaves are compared."""
        import numpy as np
        if not len(points) or not len(self.queries):
            return
        mine, tree = self.tree, CoverTree(points, self.leaf)
        exact = "float64" if float(np.abs(self.queries).max()) * float(np.abs(points).max()) * points.shape[1] < 2 ** 53 else "int64"

        def push(queue, q, d):
            """Pairs of one node with several."""
            product = mine.center_points[q] @ tree.center_points[d].T
            bound = (product + mine.radii[q][:, None] * tree.norms[d] + mine.norms[q][:, None] * tree.radii[d] + mine.radii[q][:, None] * tree.radii[d])
            bound += 1e-9 * np.abs(bound) + 1e-6
            least = np.array([self.worst(x) for x in q])
            for i, j in zip(*(x.tolist() for x in np.nonzero(bound >= least[:, None]))):
                heapq.heappush(queue, (-bound[i, j], q[i], d[j]))

        self.pairs += sum(not c for c in mine.children) * sum(not c for c in tree.children)
        queue = []
        push(queue, [0], [0])
        while queue:
            bound, q, d = heapq.heappop(queue)
            if -bound < self.worst(q):
                continue
            q_leaf, d_leaf = not mine.children[q], not tree.children[d]
            if q_leaf and d_leaf:
                self.compare(mine.below[q], points, point_ids, tree.below[d], exact)
            elif d_leaf or (not q_leaf and mine.radii[q] * tree.norms[d] > tree.radii[d] * mine.norms[q]):
                push(queue, mine.children[q], [d])
            else:
                push(queue, [q], tree.children[d])

    def compare(self, rows, points, point_ids, columns, exact):
        import numpy as np
        self.compared += 1
        scores = (self.queries[rows].astype(exact) @ points[columns].astype(exact).T).astype("int64")
        ids = np.broadcast_to(point_ids[columns], scores.shape)
        scores = np.where(self.query_ids[rows][:, None] == ids, ABSENT, scores)
        better = scores >= self.scores[rows, -1:]
        some, which = better.any(axis=1), better.any(axis=0)
        rows, scores, ids = rows[some], scores[some][:, which], ids[some][:, which]
        if len(rows):
            scores = np.concatenate([self.scores[rows], scores], axis=1)
            ids = np.concatenate([self.ids[rows], ids], axis=1)
            # Places that no candidate has taken come last; the others by falling score, then by id.
            order = np.lexsort((ids, ~scores), axis=1)[:, :self.k]
            self.scores[rows] = np.take_along_axis(scores, order, axis=1)
            self.ids[rows] = np.take_along_axis(ids, order, axis=1)

    def found(self):
        """Places of queries, ids and scores of all candidates kept."""
        import numpy as np
        rows, places = np.nonzero(self.scores != ABSENT)
        return rows, self.ids[rows, places], self.scores[rows, places]


def blocks(vectors, n, key):
    """Vectors dealt by a hash of their ids into ``n`` blocks, one row each: key, ids and matrix as bytes, dimension."""
    def pack(frame):
        import numpy as np
        import pandas as pd
        width = max(map(len, frame["vector"]), default=0)
        matrix = np.zeros((len(frame), width), "int64")
        for row, vector in zip(matrix, frame["vector"]):
            row[:len(vector)] = vector
        return pd.DataFrame({key: [frame["_block"].iloc[0]], "ids": [frame["vec_id"].to_numpy("int64").tobytes()],
                             "matrix": [matrix.tobytes()], "width": [width]})

    dealt = vectors.withColumn("_block", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(n)))
    return dealt.groupBy("_block").applyInPandas(pack, f"{key} long, ids binary, matrix binary, width int")


def top_k(vectors, queries, k=20, block_rows=2048):
    """The ``k`` highest inner products of each query with all other vectors: query_id, rank (from 1), vec_id, score.

    Both tables have vec_id (long) and vector (array of long). Queries and vectors are dealt into blocks of
    about ``block_rows`` rows, and the blocks of vectors into stripes; a task takes a block of queries through the
    blocks of a stripe, one after the other, so the k-th scores found in one cut the search in the next, and what a
    task gives out is k rows a query. There are as many stripes as give every shuffle partition a task, one when the
    blocks of queries are enough, so these rows do not grow faster than the queries.

    A query meets every row but those of its own id; ties go to the smaller id. Missing components of shorter vectors are
    0, so an empty vector scores 0 with all. Rows of NULL id take no part. Rows that repeat an id count once per row, as
    queries too: each has its own list. With fewer than ``k`` candidates there are fewer rows; without queries, none.
    """
    spark = vectors.sparkSession
    vectors, queries = vectors.filter("vec_id IS NOT NULL"), queries.filter("vec_id IS NOT NULL")
    n_vectors, n_queries = vectors.count(), queries.count()
    if not n_vectors or not n_queries:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    n_data, n_groups = -(-n_vectors // block_rows), -(-n_queries // block_rows)
    stripes = min(n_data, -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // n_groups))
    every = F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1)).cast("array<long>"))
    data = blocks(vectors, n_data, "d").select("d", (F.col("d") % stripes).alias("stripe"), every.alias("q"), F.struct("ids", "matrix", "width").alias("data"))
    groups = blocks(queries, n_groups, "q").select("q", F.struct("ids", "matrix", "width").alias("group"))
    pairs = data.join(groups, "q").repartition(n_groups * stripes, "q", "stripe").sortWithinPartitions("q", "stripe", "d")

    def search(batches):
        import numpy as np
        import pyarrow as pa

        def unpacked(row, width):
            ids = np.frombuffer(row["ids"], "int64")
            matrix = np.frombuffer(row["matrix"], "int64").reshape(len(ids), row["width"])
            return ids, np.pad(matrix, ((0, 0), (0, width - row["width"])))

        def result(q, task):
            rows, ids, scores = task.found()
            return pa.RecordBatch.from_arrays([pa.array(task.query_ids[rows]), pa.array(np.full(len(rows), q)), pa.array(rows), pa.array(ids), pa.array(scores)],
                                              ["query_id", "q", "query_row", "vec_id", "score"])

        now, task = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                q, stripe = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                group, block = batch.column(2)[i].as_py(), batch.column(3)[i].as_py()
                width = max(group["width"], block["width"], 1)
                if now != (q, stripe):
                    if task is not None:
                        yield result(now[0], task)
                    now = q, stripe
                    query_ids, matrix = unpacked(group, width)
                    task = Search(matrix, query_ids, k)
                if task.queries.shape[1] < width:  # A longer vector; the others have zeros there, which changes no distance.
                    more = ((0, 0), (0, width - task.queries.shape[1]))
                    task.queries, task.tree.points = np.pad(task.queries, more), np.pad(task.tree.points, more)
                    task.tree.center_points = np.pad(task.tree.center_points, more)
                point_ids, points = unpacked(block, task.queries.shape[1])
                task.meet(points, point_ids)
        if task is not None:
            yield result(now[0], task)

    found = pairs.select("q", "stripe", "group", "data").mapInArrow(search, "query_id long, q long, query_row long, vec_id long, score long")
    order = Window.partitionBy("q", "query_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def integer_vectors(table, scale=64, id_column="vec_id", vector_column="embedding"):
    """vec_id and floor(scale * x) of every component; vectors that are NULL or hold NULL or non-finite components
    take no part, and neither do those with a component of LARGEST or more, whose products a long may not hold."""
    vector = table[vector_column].cast("array<double>")
    rows = table.select(table[id_column].cast("long").alias("vec_id"), vector.alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) >= LARGEST))
    return rows.filter(F.col("vector").isNotNull() & ~bad).select("vec_id", F.transform("vector", lambda x: F.floor(x * scale)).alias("vector"))
