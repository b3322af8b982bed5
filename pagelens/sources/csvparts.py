"""CSV files cut into byte ranges that are read side by side, however large a file is."""

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from pagelens.sources.warc import filesystem_of

STEP = 1 << 20  # Bytes that are searched for the end of a row at a time.


def _ranges(spark: SparkSession, path: str, chunk_bytes: int) -> DataFrame:
    """(path, start, stop) of all ranges; the contents are not read."""
    files = spark.read.format("binaryFile").load(path).select("path", "length").filter("length > 0")
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(chunk_bytes).cast("long")))
    ranges = files.select("path", "length", starts.alias("start"))
    ranges = ranges.select("path", "start", F.least(F.col("start") + chunk_bytes, F.col("length")).alias("stop"))
    return ranges.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path", "start")


def _with_quoted(ranges: DataFrame) -> DataFrame:
    """Add whether a range starts inside quotes: whether the ranges before it have an odd number of quotes. Doubled quotes
    inside a value change nothing about that. One row a range is shuffled."""
    def count(batches):
        import pyarrow as pa
        for batch in batches:
            odd = []
            for path, start, stop in zip(*[c.to_pylist() for c in batch.columns]):
                filesystem, name = filesystem_of(path)
                with filesystem.open_input_file(name) as file:
                    file.seek(start)
                    n = 0
                    for at in range(start, stop, STEP):
                        n += file.read(min(STEP, stop - at)).count(b'"')
                    odd.append(n & 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(odd, pa.int32())], ["path", "start", "stop", "odd"])

    counted = ranges.mapInArrow(count, "path string, start long, stop long, odd int")
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return counted.withColumn("quoted", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1)


def _row_end(file, at, quoted):
    """The place behind the first line end from ``at`` on that is not in quotes; the end of the file without one."""
    import numpy as np
    file.seek(at)
    while data := file.read(STEP):
        found = np.frombuffer(data, "uint8")
        outside = (np.cumsum(found == 34, dtype="int32") & 1) == int(quoted)
        ends = np.flatnonzero((found == 10) & outside)
        if len(ends):
            return at + int(ends[0]) + 1
        quoted ^= bool((found == 34).sum() & 1)
        at += len(data)
    return at


def _rows(path, start, stop, quoted):
    """The parsed rows that begin in a range; the header is the first row of a file."""
    import csv
    import io
    filesystem, name = filesystem_of(path)
    with filesystem.open_input_file(name) as file:
        first = 0
        if start:  # A row begins behind a line end, which may be the last byte before the range.
            file.seek(start - 1)
            first = _row_end(file, start - 1, quoted ^ (file.read(1) == b'"'))
        if first >= stop:
            return
        file.seek(first)
        data = file.read(stop - 1 - first)
        last = _row_end(file, stop - 1, bool(data.count(b'"') & 1))
        file.seek(stop - 1)
        text = (data + file.read(last - stop + 1)).decode("utf-8", "replace")
    rows = csv.reader(io.StringIO(text, newline=""), quoting=csv.QUOTE_NOTNULL)
    for number, row in enumerate(row for row in rows if row):
        if number or start:
            yield row


def read_csv_parts(spark: SparkSession, path: str, schema, chunk_bytes: int = 32 << 20, bad_rows: str | None = None) -> DataFrame:
    """CSV with a header, values quoted where needed and quotes doubled, line ends in values included.

    A first pass counts the quotes of each byte range, which tells for every range whether it starts inside a value; the
    second one parses the rows that begin in each. So one large file is read by as many tasks as there are ranges of
    ``chunk_bytes``; a range is in memory at a time. Blank lines are skipped, an empty value without quotes is NULL.
    A value that its column's type cannot hold is NULL, and a row with another number of values has NULLs only; with
    ``bad_rows``, a column of that name has such a row as text, NULL for good rows.
    """
    fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    width = len(fields)

    def parse(batches):
        import pyarrow as pa
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                values, whole = [], []
                for found in _rows(*row):
                    values.append(found if len(found) == width else [None] * width)
                    whole.append(",".join(x or "" for x in found) if len(found) != width else None)
                    if len(values) == 2000:
                        yield pa.RecordBatch.from_arrays([pa.array(values, pa.list_(pa.string())), pa.array(whole, pa.string())], ["values", "bad"])
                        values, whole = [], []
                yield pa.RecordBatch.from_arrays([pa.array(values, pa.list_(pa.string())), pa.array(whole, pa.string())], ["values", "bad"])

    ranges = _with_quoted(_ranges(spark, path, chunk_bytes)).select("path", "start", "stop", "quoted")
    rows = ranges.mapInArrow(parse, "values array<string>, bad string")

    def value(i):
        return F.col("values")[i]

    cast = [value(i).try_cast(f.dataType) for i, f in enumerate(fields)]
    columns = [c.alias(f.name) for c, f in zip(cast, fields)]
    if bad_rows:
        wrong = F.lit(False)
        for i, c in enumerate(cast):
            wrong = wrong | (F.coalesce(value(i), F.lit("")) != "") & c.isNull()
        text = F.array_join(F.transform("values", lambda x: F.coalesce(x, F.lit(""))), ",")
        columns.append(F.coalesce("bad", F.when(wrong, text)).alias(bad_rows))
    return rows.select(*columns)
