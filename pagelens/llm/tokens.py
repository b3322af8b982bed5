"""Token-id files: documents in the order of their ids as Parquet lists that can be read in parts."""

from pyspark.sql import Window, functions as F

from pagelens.llm.encoding import WordEncoder, documents, kept_in_worker, small_batches, text_slices, with_end

SCHEMA = "doc_id long, part int, first long, n_tokens long, tokens array<int>"
OFFSETS = "_offsets"  # Below the folder of the files; hidden from a read of the folder.


def write_tokens(docs, folder, tokenizer, end_id=2, id_column="doc_id", text_column="text", partitions=None,
                 row_group_bytes=16 << 20, page_rows=2000, page_bytes=256 << 10):
    """Encode every whole text, append ``end_id``, and write the ids in ascending order of the documents.

    Each task encodes one contiguous range of ids and writes one file. The ids of tokens are a list
    column with a dictionary (at most the vocabulary's size) and bit packing; the counters are delta
    encoded; ``row_group_bytes``, ``page_rows`` and ``page_bytes`` set the granularity, and Parquet's
    page indexes let a reader fetch single documents or only the counters.

    NULL and empty texts give the end id alone. Equal document ids stay apart, in the order of a hash
    of their texts; rows that are equal in full are written once each. NULL ids come first. An empty
    table gives an empty file set.
    """
    spark = docs.sparkSession
    small_batches(spark)
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def encode(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext
        encoder = kept_in_worker(WordEncoder, tokenizer)
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            for keys, texts in text_slices(batch):
                ids, n = with_end(*encoder.encode(texts), end_id)
                ends = np.cumsum(n)
                yield pa.RecordBatch.from_arrays([
                    keys, pa.array(np.full(len(n), part, "int32")), pa.array(before + ends - n), pa.array(n),
                    pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype("int32")), pa.array(ids))],
                    ["doc_id", "part", "first", "n_tokens", "tokens"])
                before += int(ends[-1])

    ranged = documents(docs, id_column, text_column).withColumn("_tie", F.xxhash64("text"))
    ranged = ranged.repartitionByRange(partitions, "doc_id", "_tie").sortWithinPartitions("doc_id", "_tie")
    (ranged.drop("_tie").mapInArrow(encode, SCHEMA).write
     .option("parquet.block.size", row_group_bytes).option("parquet.page.size", page_bytes)
     .option("parquet.page.row.count.limit", page_rows).option("parquet.writer.version", "PARQUET_2_0")
     .option("parquet.enable.dictionary", "true").option("parquet.enable.dictionary#doc_id", "false")
     .option("parquet.enable.dictionary#first", "false").option("parquet.enable.dictionary#n_tokens", "false")
     .option("compression", "zstd").parquet(folder))
    # The counters of each file alone; one row a file, in a table whose size Spark knows.
    sizes = spark.read.parquet(folder).groupBy("part").agg(F.sum("n_tokens").alias("size"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes.select("part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("base")).write.parquet(f"{folder}/{OFFSETS}")


def read_tokens(spark, folder, doc_ids=None, tokens=True):
    """Documents of the files: doc_id, start (ids of all earlier documents), n_tokens and, unless only the
    counters are wanted, tokens. ``doc_ids``, a list, is pushed down to the page indexes.

    The offset of each file is in a small table beside the files.
    """
    stored = spark.read.parquet(folder)
    bases = spark.read.parquet(f"{folder}/{OFFSETS}")
    if doc_ids is not None:
        stored = stored.filter(F.col("doc_id").isin([int(x) for x in doc_ids]))
    columns = ["doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens"] + ["tokens"] * tokens
    return stored.join(bases, "part").select(*columns)


def checksums(stored):
    """crc32 of each document's ids as little-endian unsigned 32-bit integers."""
    def crc(batches):
        import zlib
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            lists = batch.column("tokens")
            values = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4")
            ends = np.cumsum(batch.column("n_tokens").to_numpy())
            starts = np.concatenate([[0], ends[:-1]])
            sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(starts, ends)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("doc_id", "start", "n_tokens")]
                                             + [pa.array(sums, "int64")], ["doc_id", "start", "n_tokens", "ids_crc32"])

    small_batches(stored.sparkSession)
    return stored.mapInArrow(crc, "doc_id long, start long, n_tokens long, ids_crc32 long")
