"""Training, keeping and batch scoring of the multi-label classifier.

One logistic regression per label on hashed tokens weighted by their rarity. All labels are trained together: an
epoch is a step along the gradient of all of them, which the tasks sum over their rows. Weights and gradients stay in
blocks on the executors; the driver gets inner products, and the weights once, at the end.
"""

import math

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from pagelens.functions import text as tx
from pagelens.labels import LABELS
from pagelens.operators import scoring
from pagelens.session import ensure_checkpoint_dir

# Fixed value: longest input in tokens.
MAX_TOKENS = 512
BLOCK = 4096  # Features of a block of the gradient.
SLICE = 1 << 16  # Tokens that are multiplied at a time.


def token_indexes(text: Column, n_features: int) -> Column:
    """The feature of each token of a text."""
    return F.transform(tx.tokens(text, MAX_TOKENS), lambda token: F.pmod(F.hash(token), F.lit(n_features)).cast("int"))


def _slices(lists):
    """Cut an Arrow array of lists so that a slice has about SLICE values: first row, sizes, values."""
    import numpy as np
    offsets = lists.offsets.to_numpy()
    values = lists.values.to_numpy(zero_copy_only=False)
    row = 0
    while row < len(lists):
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + SLICE, "right")) - 1)
        yield row, np.diff(offsets[row:stop + 1]), values[offsets[row]:offsets[stop]]
        row = stop


def _logits(sizes, indexes, weights, bias):
    """Sums of the weights of each row's tokens, plus the bias."""
    import numpy as np
    logits = np.tile(bias, (len(sizes), 1))
    filled = np.flatnonzero(sizes)
    if len(filled):
        logits[filled] += np.add.reduceat(weights[indexes], (np.cumsum(sizes) - sizes)[filled], axis=0)
    return logits


class MultiLabelModel:
    """Weights (features x labels) with the features' rarity in them, one bias per label, and the epochs of the training.

    A label that never, or always, occurs in training has no weights and a bias of minus, or plus, infinity.
    """

    def __init__(self, weights, bias, labels, history=()):
        self.weights, self.bias, self.labels, self.history = weights, bias, list(labels), list(history)

    def transform(self, pages: DataFrame, text: str = "text") -> DataFrame:
        """Add the arrays ``logit``, ``prob`` and ``pred``; a narrow step. A worker gets the weights once."""
        shared = pages.sparkSession.sparkContext.broadcast((self.weights, self.bias))
        schema = T.StructType(pages.schema.fields + [T.StructField("logit", T.ArrayType(T.DoubleType()))])

        def run(batches):
            import numpy as np
            import pyarrow as pa
            weights, bias = shared.value
            for batch in batches:
                lists = batch.column(batch.num_columns - 1)
                parts = [_logits(sizes, indexes, weights, bias) for _, sizes, indexes in _slices(lists)]
                logits = np.concatenate(parts) if parts else np.zeros((0, len(bias)))
                ends = pa.array(np.arange(0, logits.size + 1, len(bias), dtype="int32"))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.ListArray.from_arrays(ends, pa.array(logits.ravel()))],
                                                 names=[*batch.schema.names[:-1], "logit"])

        indexed = pages.withColumn("_indexes", F.coalesce(token_indexes(F.col(text), len(self.weights)), F.array().cast("array<int>")))
        df = indexed.mapInArrow(run, schema).withColumn("prob", scoring.probabilities(F.col("logit")))
        return df.withColumn("pred", scoring.predictions(F.col("prob")))

    def epochs(self, spark: SparkSession) -> DataFrame:
        """epoch, loss, f1_macro (on the rows held out; NULL without any) and whether it is the one kept."""
        return spark.createDataFrame(self.history, "epoch int, loss double, f1_macro double, kept boolean")

    def save(self, spark: SparkSession, folder: str, version: str) -> None:
        """Write the model as one version of the model store in ``folder``; a version is never overwritten."""
        rows = [(i, w) for i, w in enumerate([self.bias.tolist(), *self.weights.tolist()])]
        spark.createDataFrame(rows, "row int, weights array<double>").write.parquet(f"{folder}/version={version}/weights")
        labels = spark.createDataFrame(list(enumerate(self.labels)), "label_idx int, label string")
        labels.write.parquet(f"{folder}/version={version}/labels")
        self.epochs(spark).write.parquet(f"{folder}/version={version}/epochs")

    @classmethod
    def load(cls, spark: SparkSession, folder: str, version: str) -> "MultiLabelModel":
        import numpy as np

        def rows(name, order):
            return spark.read.parquet(f"{folder}/version={version}/{name}").orderBy(order).collect()

        values = np.array([r.weights for r in rows("weights", "row")], "float64")
        return cls(values[1:], values[0], [r.label for r in rows("labels", "label_idx")], [tuple(r) for r in rows("epochs", "epoch")])


def _blocks(rows) -> list:
    """Cut the rows of an array into numbered blocks of BLOCK."""
    import numpy as np
    return list(enumerate(np.split(rows, range(BLOCK, len(rows), BLOCK))))


def _whole(blocks):
    """The rows of numbered blocks in order."""
    import numpy as np
    return np.concatenate([rows for _, rows in sorted(blocks, key=lambda item: item[0])])


class _Objective:
    """Mean loss over the training rows, its gradient, and the counts of the held-out rows, in one pass.

    The features in use are numbered anew, so that weights and gradient are as long as needed; ``place`` has the number of
    each, and that of a feature without weight for the others. The rows are dealt into parts of about PART numbers, ``tasks`` at
    least. Weights and gradient are RDDs of blocks: every part is sent the weights by a shuffle, the gradients of the parts are
    added up by another one, and the driver gets a few sums for each label.
    """
    PART = 1 << 23  # Numbers of 4 bytes that a task holds of the rows, about.

    def __init__(self, prepared: DataFrame, place, rarity, n_labels: int, tasks: int, regularisation: float):
        context = prepared.sparkSession.sparkContext
        self.context, self.rarity, self.n_labels, self.regularisation = context, rarity, n_labels, regularisation
        self.last = len(rarity) // BLOCK  # The block that ends with the bias.
        self.n_blocks = min(self.last + 1, context.defaultParallelism)  # Partitions of a table of blocks.
        self.shared = shared = context.broadcast((place, rarity))
        numbers = prepared.agg(F.sum(F.size("indexes") + 2 * n_labels)).first()[0] or 0
        tasks = max(tasks, -(-numbers // self.PART))

        def pack(batches):
            import pickle
            import pyarrow as pa
            from pyspark import TaskContext
            place, _ = shared.value
            found = []
            for batch in batches:
                truth = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, n_labels)
                held = batch.column(2).to_numpy(zero_copy_only=False)
                for row, sizes, indexes in _slices(batch.column(0)):
                    stop = row + len(sizes)
                    found.append((sizes, place[indexes].astype("int32"), truth[row:stop].copy(), held[row:stop].copy()))
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([pickle.dumps(found)], pa.binary())], ["part", "data"])

        def unpacked(row):
            import pickle
            return row.part, pickle.loads(row.data)

        packed = prepared.repartition(tasks).mapInArrow(pack, "part int, data binary").rdd
        self.data = packed.map(unpacked).partitionBy(tasks, int).persist(StorageLevel.MEMORY_AND_DISK)
        self.parts = self.data.keys().collect()

    def blocks(self, theta):
        """An array as an RDD of blocks."""
        return self.context.parallelize(_blocks(theta), self.n_blocks).partitionBy(self.n_blocks)

    def at(self, theta):
        """Loss, training rows, macro F1 of the held-out rows, and the gradient's blocks before ``regularised``. ``theta`` has the
        weights in its first rows and the bias in the last one."""
        import numpy as np
        n_labels, last, parts, shared = self.n_labels, self.last, self.parts, self.shared

        def own(item):
            block, rows = item
            sums = np.zeros((6, n_labels))  # loss, rows, of held-out rows tp, fp, fn, and the squared weights
            sums[5, 0] = ((rows[:-1] if block == last else rows) ** 2).sum()
            return [(-1, sums), (block, np.zeros_like(rows))]

        def assembled(items):
            blocks = [item for _, item in items]
            return [_whole(blocks)] if blocks else []

        def run(pair):
            (_, slices), theta = pair
            _, rarity = shared.value
            weights, bias = theta[:-1] * rarity[:, None], theta[-1]
            gradient, sums = np.zeros_like(theta), np.zeros((6, n_labels))
            for sizes, indexes, y, out in slices:
                z = _logits(sizes, indexes, weights, bias)
                error = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y) * ~out[:, None]
                sums[0] += ((np.logaddexp(0, z) - y * z) * ~out[:, None]).sum(axis=0)
                sums[1] += (~out).sum()
                gradient[-1] += error.sum(axis=0)
                for i, (a, b) in enumerate(((z >= 0, y == 1), (z >= 0, y == 0), (z < 0, y == 1))):
                    sums[2 + i] += (a & b & out[:, None]).sum(axis=0)
                for label in range(n_labels):
                    gradient[:-1, label] += np.bincount(indexes, np.repeat(error[:, label], sizes), len(rarity))
            gradient[:-1] *= rarity[:, None]
            return [(-1, sums), *_blocks(gradient)]

        sent = theta.flatMap(lambda item: [(part, item) for part in parts]).partitionBy(self.data.getNumPartitions(), int).mapPartitions(assembled)
        added = self.data.zip(sent).flatMap(run).union(theta.flatMap(own)).reduceByKey(np.add, self.n_blocks).persist(StorageLevel.MEMORY_AND_DISK)
        sums = added.filter(lambda item: item[0] == -1).values().collect()[0]
        n = max(sums[1, 0], 1)
        loss = sums[0].sum() / n + self.regularisation / 2 * sums[5, 0]
        tp, fp, fn = sums[2:5]
        f1 = float(np.mean(2 * tp / np.maximum(2 * tp + fp + fn, 1))) if (tp + fp + fn).any() else None
        return float(loss), n, f1, added

    def regularised(self, n):
        """The function of a block, its weights and its summed gradient that gives the gradient of the mean loss."""
        last, regularisation = self.last, self.regularisation

        def gradient(block, theta, added):
            found = added / n + regularisation * theta
            if block == last:
                found[-1] = added[-1] / n
            return found

        return gradient

    def __call__(self, theta):
        """The same for an array: loss, gradient, macro F1."""
        loss, n, f1, added = self.at(self.blocks(theta))
        gradient = self.regularised(n)
        rows = dict(_blocks(theta))
        found = _whole([(block, gradient(block, rows[block], total)) for block, total in added.filter(lambda item: item[0] >= 0).collect()])
        added.unpersist()
        return loss, found, f1

    def close(self):
        self.data.unpersist()


def _products(state):
    """Inner products of the changes of theta, those of the gradient, and the gradient, added up over all blocks."""
    def products(values):
        import numpy as np
        _, gradient, pairs = values
        rows = np.stack([v.ravel() for v in [*[s for s, _ in pairs], *[y for _, y in pairs], gradient]])
        return rows @ rows.T

    return state.values().map(products).reduce(lambda a, b: a + b)


def _direction(products):
    """Factors of the vectors of ``_products`` in the step of limited-memory BFGS, and the slope along it."""
    import numpy as np
    m = len(products) // 2
    factors, used = np.zeros(2 * m + 1), np.zeros(m)
    factors[-1] = -1
    for i in reversed(range(m)):
        used[i] = factors @ products[i] / products[i, m + i]
        factors[m + i] -= used[i]
    if m:
        factors *= products[m - 1, 2 * m - 1] / products[2 * m - 1, 2 * m - 1]
    for i in range(m):
        factors[i] += used[i] - factors @ products[m + i] / products[i, m + i]
    return factors, float(factors @ products[-1])


def _minimised(objective, theta, epochs: int, tolerance: float, memory: int = 10, cut: int = 10):
    """Steps of limited-memory BFGS, halved until the loss falls enough: (epoch, loss, f1, theta) from the start on. Ends
    after ``epochs`` steps, or when a step gains less than ``tolerance`` of the loss.

    All vectors stay in RDDs of blocks, theta as it is yielded (whoever gets it unpersists it). The driver holds their inner
    products only, and the step as factors of them. Every ``cut`` steps are checkpointed.
    """
    level, n_blocks = StorageLevel.MEMORY_AND_DISK, objective.n_blocks

    def started(n):
        gradient = objective.regularised(n)
        return lambda item: (item[0], (item[1][0], gradient(item[0], *item[1]), []))

    def moved(factors, step):
        def move(values):
            theta, gradient, pairs = values
            return theta + step * sum(f * v for f, v in zip(factors, [*[s for s, _ in pairs], *[y for _, y in pairs], gradient]))
        return move

    def followed(n, live):
        gradient = objective.regularised(n)

        def follow(item):
            block, (((theta, old, pairs), new), added) = item
            now = gradient(block, new, added)
            return block, (new, now, [*[pairs[i] for i in live], (new - theta, now - old)])
        return follow

    theta = objective.blocks(theta).persist(level)
    loss, n, f1, added = objective.at(theta)
    state = theta.join(added, n_blocks).map(started(n), preservesPartitioning=True).persist(level)
    products = _products(state)
    added.unpersist()
    yield 0, loss, f1, theta
    live = []  # Places of the pairs in use; the newest pair of a state is dropped if it bends the wrong way.
    try:
        for epoch in range(1, epochs + 1):
            m, size = len(live), len(products) // 2
            use = [*live, *[size + i for i in live], 2 * size]
            some, slope = _direction(products[use][:, use])
            if slope >= 0:
                return
            factors = [0.0] * (2 * size + 1)
            for place, factor in zip(use, some.tolist()):
                factors[place] = factor
            step = 1.0 if m else 1.0 / max(math.sqrt(products[-1, -1]), 1e-12)
            while True:
                theta = state.mapValues(moved(factors, step)).persist(level)
                new_loss, n, f1, added = objective.at(theta)
                if new_loss <= loss + 1e-4 * step * slope:
                    break
                theta.unpersist()
                added.unpersist()
                step /= 2
                if step < 1e-10:
                    return
            before, state = state, state.join(theta, n_blocks).join(added, n_blocks).map(followed(n, live), preservesPartitioning=True).persist(level)
            if epoch % cut == 0:
                state.checkpoint()
            products = _products(state)
            before.unpersist()
            added.unpersist()
            size = len(products) // 2
            live = list(range(size if products[size - 1, 2 * size - 1] > 1e-12 else size - 1))[-memory:]
            gained, loss = loss - new_loss, new_loss
            yield epoch, loss, f1, theta
            if gained <= tolerance * max(abs(loss), 1e-12):
                return
    finally:
        state.unpersist()


def train(examples: DataFrame, text: str = "text", y: str = "label_vector", labels=LABELS, n_features: int = 1 << 16,
          epochs: int = 100, regularisation: float = 1e-4, tolerance: float = 1e-3, patience: int = 10, held_out: Column | None = None,
          tasks: int | None = None, checkpoint: str | None = None, start: MultiLabelModel | None = None) -> MultiLabelModel:
    """Fit one logistic regression per label, and keep the best epoch.

    ``epochs`` bounds the steps; training ends earlier when a step gains less than ``tolerance`` of the loss, or when the
    macro F1 of the rows held out has not grown for ``patience`` steps. Rows for which
    ``held_out`` holds are not trained on: the epoch with the highest macro F1 on them is kept, the earliest of equal ones;
    without such rows the last one, whose loss is lowest. Examples with a NULL or wrongly sized vector are left out.
    They are dealt into ``tasks`` parts, and their features kept, as every epoch reads them again.

    With ``checkpoint``, a folder, each epoch is saved there as a version ``epoch-1``, ``epoch-2`` and so on; ``start`` goes on
    from a model, such as the last one saved by a training that was broken off.
    """
    import numpy as np
    spark, labels = examples.sparkSession, list(labels)
    ensure_checkpoint_dir(spark)
    objective = None
    tasks = tasks or spark.sparkContext.defaultParallelism
    held = F.coalesce(held_out, F.lit(False)) if held_out is not None else F.lit(False)
    indexes = F.coalesce(token_indexes(F.col(text), n_features), F.array().cast("array<int>"))
    prepared = examples.filter(F.size(y) == len(labels)).select(indexes.alias("indexes"), F.col(y).cast("array<double>").alias("y"), held.alias("held"))
    prepared = prepared.filter(~F.exists("y", lambda v: v.isNull())).repartition(tasks).persist()
    try:
        trained = prepared.filter("NOT held")
        counts = trained.agg(F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(F.col("y")[i]), F.lit(0.0)).alias(f"s{i}") for i in range(len(labels))]).first()
        used = trained.select(F.explode(F.array_distinct("indexes")).alias("feature")).groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()
        used = sorted((r.feature, r.n) for r in used)
        features = np.array([f for f, _ in used], "int64")
        place = np.full(n_features, len(used), "int32")
        place[features] = np.arange(len(used))
        rarity = np.array([math.log((counts.n + 1) / (n + 1)) for _, n in used] + [0.0])  # The last one stands for all others.
        objective = _Objective(prepared, place, rarity, len(labels), tasks, regularisation)

        def weights_of(theta):
            weights = np.zeros((n_features, len(labels)))
            weights[features] = theta[:-2] * rarity[:-1, None]
            return weights

        first = np.zeros((len(used) + 2, len(labels)))
        if start is not None:
            known = start.weights[features]
            first[:-2] = np.divide(known, rarity[:-1, None], out=np.zeros_like(known), where=rarity[:-1, None] > 0)
            first[-1] = np.where(np.isfinite(start.bias), start.bias, 0)
        best, history = None, []
        for epoch, loss, f1, theta in _minimised(objective, first, epochs, tolerance):
            history.append((epoch, loss, f1))
            if checkpoint and epoch:
                now = _whole(theta.collect())
                MultiLabelModel(weights_of(now), now[-1], labels, [(*h, h[0] == epoch) for h in history]).save(
                    spark, checkpoint, f"epoch-{epoch}")
            if epoch and (best is None or f1 is None or f1 > history[best[0]][2]):
                if best:
                    best[1].unpersist()
                best = epoch, theta
                continue
            theta.unpersist()
            if epoch and epoch - best[0] >= patience:
                break
        theta = _whole(best[1].collect()) if best else first
    finally:
        prepared.unpersist()
        if objective:
            objective.close()
    weights, bias = weights_of(theta), theta[-1].copy()
    for i, total in enumerate(counts[1:]):
        if total in (0, counts.n):
            weights[:, i], bias[i] = 0, math.inf if total and counts.n else -math.inf
    kept = best[0] if best else 0
    return MultiLabelModel(weights, bias, labels, [(e, loss, f1, e == kept) for e, loss, f1 in history])


def score_with(pages: DataFrame, open_scorer, text: str = "text", parallelism: int | None = None) -> DataFrame:
    """Add ``logit`` from a plugged scorer: ``open_scorer()`` is called once per task and returns a
    function from a list of texts to a list of logit lists."""
    if parallelism:
        pages = pages.repartition(parallelism)
    schema = T.StructType(pages.schema.fields + [T.StructField("logit", T.ArrayType(T.DoubleType()))])

    def run(frames):
        score = open_scorer()
        for frame in frames:
            yield frame.assign(logit=[[float(x) for x in row] for row in score(frame[text].tolist())])

    scored = pages.mapInPandas(run, schema)
    scored = scored.withColumn("prob", scoring.probabilities(F.col("logit")))
    return scored.withColumn("pred", scoring.predictions(F.col("prob")))
