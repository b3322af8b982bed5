"""Running totals, row numbers and first-n over a whole table, without a single-task window.

Rows are dealt into contiguous value ranges with about equal row counts, as many as there are shuffle partitions (in
powers of two). Each range is summed on its own, the few range totals are accumulated, and a row's running total is the
total of the earlier ranges plus the running total inside its range. The result is exact for any range
limits; the limits only balance the tasks.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from pagelens.functions.stages import computed
from pagelens.session import shared_folder


def range_depth(df: DataFrame) -> int:
    """The power of two that is the number of shuffle partitions, or the next larger one."""
    return max(1, (int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())


def range_limits(df: DataFrame, value: str, depth: int) -> Column:
    """Approximate quantiles of a numeric column as one array, a scalar subquery of the plan."""
    parts = 2 ** depth
    shares = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    limits = df.agg(F.percentile_approx(F.col(value), shares, 20 * parts).alias("limits"))
    return limits.scalar()


def range_number(value: Column, limits: Column, depth: int) -> Column:
    """How many limits are below the value, found by bisection."""
    steps = F.array(*[F.lit(2 ** i) for i in reversed(range(depth))])
    return F.aggregate(
        steps, F.lit(0),
        lambda at, step: F.when(F.get(limits, at + step - 1) < value, at + step).otherwise(at))


def with_running_totals(df: DataFrame, value: str, totals: dict[str, str], groups=(), descending=False,
                        ties=(), depth: int | None = None, ranges_of: DataFrame | None = None) -> DataFrame:
    """Add running totals of columns in the order of a numeric column, per group.

    ``totals`` maps each new column to the column it sums. Rows with equal values are told apart by
    ``ties``; many rows with one value should be added up before, as they stay in one range. Group
    columns must be few-valued and not NULL.
    """
    columns = df.columns
    depth = depth or range_depth(df)
    limits = range_limits(ranges_of if ranges_of is not None else df, value, depth)
    df = df.withColumn("_limits", limits)
    df = df.withColumn("_range", range_number(F.col(value), F.col("_limits"), depth)).drop("_limits")
    if descending:
        df = df.withColumn("_range", -F.col("_range"))
    # Fixed here: the test of the join key below would otherwise repeat the bisection under the aggregation.
    df = computed(df, "_range")
    groups = list(groups)

    per_range = df.groupBy(*groups, "_range").agg(*[F.sum(c).alias(f"_sum_{t}") for t, c in totals.items()])
    earlier = Window.partitionBy(*groups, F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(*groups, "_range", *[
        F.coalesce(F.sum(f"_sum_{t}").over(earlier), F.lit(0)).alias(f"_before_{t}") for t in totals])

    key = F.col(value).desc() if descending else F.col(value)
    inside = (Window.partitionBy(*groups, "_range").orderBy(key, *ties)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    df = df.select("*", *[F.sum(c).over(inside).alias(f"_inside_{t}") for t, c in totals.items()])
    # The window left the rows partitioned by these keys, so the join moves only the offsets.
    df = df.join(offsets, groups + ["_range"])
    return df.select(
        *columns,
        *[(F.col(f"_before_{t}") + F.col(f"_inside_{t}")).alias(t) for t in totals])


def with_row_numbers(df: DataFrame, order: str, ties=(), out: str = "row_no", depth: int | None = None) -> DataFrame:
    """Number the rows of a table from 1 in the order of a numeric column."""
    numbered = with_running_totals(df.withColumn("_one", F.lit(1)), order, {out: "_one"}, ties=ties, depth=depth)
    return numbered.drop("_one")


def first_rows(df: DataFrame, n: int, order: str, ties=(), depth: int | None = None) -> DataFrame:
    """First ``n`` rows in the order of a numeric column, for an ``n`` too large for one task."""
    numbered = with_row_numbers(df, order, ties, "_row_no", depth)
    return numbered.filter(F.col("_row_no") <= n).drop("_row_no")


def numbered(df: DataFrame, *order, out: str = "row_no") -> DataFrame:
    """Number the rows of a table from 1 in any order, of texts too.

    The rows are dealt by ranges of the order, as many as there are shuffle partitions, and written to the shared folder, so
    both passes see the same ranges: the first counts them, the second numbers their rows behind those of all
    earlier ones. Rows that are equal in the order may come in any order.
    """
    spark = df.sparkSession
    folder = shared_folder(spark, "ranges-")
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()).write.parquet(folder)
    dealt = spark.read.parquet(folder)
    in_order = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # One row for each range.
    before = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(in_order), F.lit(0)).alias("_before"))
    inside = dealt.withColumn("_inside", F.row_number().over(Window.partitionBy("_range").orderBy(*order)))
    return inside.join(before, "_range").select(*df.columns, (F.col("_before") + F.col("_inside")).alias(out))


def exact_quantiles(counted: DataFrame, groups, shares, value: str = "value", n: str = "n", depth: int | None = None) -> DataFrame:
    """Linearly interpolated quantiles per group of a table of distinct values and their counts.

    Adds nothing up in one task: positions come from running totals, and each quantile picks the two
    values around its position. Result: one row per group with ``q0 .. qk`` in the order of ``shares``.
    """
    groups = list(groups)
    placed = with_running_totals(counted.select(*groups, value, n), value, {"_end": n}, groups, depth=depth)
    sizes = counted.groupBy(*groups).agg(F.sum(n).alias("_size"))
    placed = placed.join(sizes, groups)

    def value_at(position):
        holds = (F.col("_end") - F.col(n) <= position) & (position < F.col("_end"))
        return F.max(F.when(holds, F.col(value).cast("double")))

    aggregates = []
    for i, share in enumerate(shares):
        position = F.lit(share) * (F.col("_size") - 1)
        aggregates += [value_at(F.floor(position)).alias(f"_low{i}"), value_at(F.ceil(position)).alias(f"_high{i}"),
                       F.max(position - F.floor(position)).alias(f"_part{i}")]
    found = placed.groupBy(*groups).agg(*aggregates)
    return found.select(*groups, *[
        (F.col(f"_low{i}") + (F.col(f"_high{i}") - F.col(f"_low{i}")) * F.col(f"_part{i}")).alias(f"q{i}")
        for i in range(len(shares))])
