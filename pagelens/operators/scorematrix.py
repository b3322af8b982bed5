"""Analysis of attention weights.

An attention table has one row per example, layer and head: (example, layer, head, weights), where
``weights[q][k]`` is the weight from token q to token k. Whatever is said about one matrix is one
expression over its row; only the averages over examples are grouped, by (layer, head).
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from pagelens.functions import vectors as v
from pagelens.functions.stages import computed

# Fixed values of the scores.
TINY_WEIGHT, TINY_RANGE, TINY_SCORE = 1e-10, 1e-10, 1e-6
FOCUS_BASE = 10.0
MIN_IMPORTANCE, MAX_TOKENS = 0.01, 15
SEPARATOR = ":"


def first_token_entropy(weights: Column) -> Column:
    """Entropy in bits of the first token's weights."""
    return -v.total(F.transform(F.get(weights, F.lit(0)), lambda w: w * F.log2(w + TINY_WEIGHT)))


def entropies(attention: DataFrame) -> DataFrame:
    return attention.select("example", "layer", "head", first_token_entropy(F.col("weights")).alias("entropy"))


def focus_scores(attention: DataFrame) -> DataFrame:
    """(layer, head, score): mean of 10 minus the entropy."""
    return entropies(attention).groupBy("layer", "head").agg(F.avg(FOCUS_BASE - F.col("entropy")).alias("score"))


def scaled(scores: DataFrame) -> DataFrame:
    """Min-max scaling over all heads. There are as many rows as the model has heads."""
    ends = scores.agg(F.struct(F.min("score").alias("low"), F.max("score").alias("high")).alias("e")).scalar()
    return scores.withColumn("score", (F.col("score") - ends["low"]) / (ends["high"] - ends["low"] + TINY_RANGE))


def scaled_by_head(scores: DataFrame) -> DataFrame:
    """Min-max scaling over the layers of each head; a constant column becomes 0."""
    column = Window.partitionBy("head")
    low, high = F.min("score").over(column), F.max("score").over(column)
    return scores.withColumn("score", F.coalesce(F.try_divide(F.col("score") - low, high - low), F.lit(0.0)))


def separator(tokens: Column) -> Column:
    """Zero-based position of the first separator token, NULL if there is none."""
    return F.nullif(F.array_position(tokens, SEPARATOR), F.lit(0)).cast("int") - 1


def with_separator(attention: DataFrame, tokens: DataFrame | None = None) -> DataFrame:
    """Add ``sep`` and ``n_tokens``, from the table's own ``tokens`` or from a token table by example."""
    if tokens is None:
        found = attention.withColumns({"sep": separator(F.col("tokens")), "n_tokens": F.size("tokens")})
        return computed(found, "sep", "n_tokens")
    small = tokens.select("example", separator(F.col("tokens")).alias("sep"), F.size("tokens").alias("n_tokens"))
    return attention.join(small, "example")


def _block_mean(weights, q_start, q_length, k_start, k_length):
    rows = F.slice(weights, q_start + 1, q_length)
    return v.total(F.transform(rows, lambda r: v.total(F.slice(r, k_start + 1, k_length)))) / (q_length * k_length)


def cross_segment_scores(attention: DataFrame) -> DataFrame:
    """(layer, head, score): mean weight between the tokens before and after the separator, both ways.

    The first and last token belong to neither side. Examples whose separator is missing or next to
    an end do not count; a head without any valid example has score 0.
    """
    sep, n = F.col("sep"), F.col("n_tokens")
    before, after = sep - 1, n - 2 - sep
    mean = (_block_mean(F.col("weights"), F.lit(1), before, sep + 1, after)
            + _block_mean(F.col("weights"), sep + 1, after, F.lit(1), before)) / 2
    valid = (sep > 1) & (sep < n - 2)
    return attention.groupBy("layer", "head").agg(F.coalesce(F.avg(F.when(valid, mean)), F.lit(0.0)).alias("score"))


def combined(a: DataFrame, b: DataFrame) -> DataFrame:
    """(layer, head, score): a * (b + 1e-6) of two score tables."""
    other = b.select("layer", "head", F.col("score").alias("_b"))
    return a.join(other, ["layer", "head"]).select(
        "layer", "head", (F.col("score") * (F.col("_b") + TINY_SCORE)).alias("score"))


def top_heads(scores: DataFrame, n: int = 10) -> DataFrame:
    return scores.orderBy(F.desc("score"), "layer", "head").limit(n)


def in_both(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select("layer", "head").intersect(b.select("layer", "head"))


def in_either(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select("layer", "head").union(b.select("layer", "head")).distinct().orderBy("layer", "head")


def attention_from_first(attention: DataFrame, n_layers: int) -> DataFrame:
    """(example, k, weight): mean over heads of the first token's weights in the last layer."""
    last = attention.filter(F.col("layer") == n_layers - 1)
    cells = last.select("example", F.posexplode(F.get("weights", F.lit(0))).alias("k", "weight"))
    return cells.groupBy("example", "k").agg(F.avg("weight").alias("weight"))


def attention_to_separator(attention: DataFrame, n_layers: int) -> DataFrame:
    """(example, q, weight): mean over heads of the weights to the separator in the middle layer."""
    middle = attention.filter((F.col("layer") == n_layers // 2) & F.col("sep").isNotNull())
    column = F.transform("weights", lambda row: F.get(row, F.col("sep")))
    cells = middle.select("example", F.posexplode(column).alias("q", "weight"))
    return cells.groupBy("example", "q").agg(F.avg("weight").alias("weight"))


def token_report(gradients: DataFrame, tokens: str = "tokens", vectors: str = "gradients",
                 over: float = MIN_IMPORTANCE, n: int = MAX_TOKENS) -> DataFrame:
    """Add ``report``: the first n (token, importance) in token order whose gradient norm is over a limit."""
    pairs = F.zip_with(tokens, vectors, lambda t, g: F.struct(t.alias("token"), v.norm(g).alias("importance")))
    return gradients.withColumn("report", F.slice(F.filter(pairs, lambda p: p["importance"] > over), 1, n))
