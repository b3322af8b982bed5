"""Line deduplication: a line that many documents have stays only in the document with the largest id."""

from pyspark.sql import functions as F

from pagelens.functions.stages import computed
from pagelens.llm.encoding import documents
from pagelens.session import shared_folder

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
COMMON = 1 << 12  # A line is common if it has more than one in so many of the repeated lines' documents.


def lower_ascii(text):
    """A-Z in lower case. For texts of single-byte characters this is what ``lower`` gives, faster."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def digests(value, names):
    """Two 64-bit hashes of different seeds, which together name a value."""
    return [F.xxhash64(value).alias(names[0]), F.xxhash64(F.lit(1), value).alias(names[1])]


def line_places(texts, min_chars):
    """Every line of at least ``min_chars`` code points: document, place, and the two hashes h1, h2 of its key."""
    rows = texts.select("doc_id", "t1", "t2", F.posexplode_outer(F.split("text", "\n")).alias("place", "line"))
    rows = computed(rows.withColumn("line", F.btrim("line", F.lit(BLANKS))), "line")
    return rows.filter(F.char_length("line") >= min_chars).select("doc_id", "t1", "t2", "place", *digests(lower_ascii(F.col("line")), ("h1", "h2")))


def drop_common_lines(docs, min_documents=3, min_chars=20, id_column="doc_id", text_column="text"):
    """Texts without the lines that at least ``min_documents`` documents have: doc_id, text, n_lines, n_dropped, dropped.

    Texts are split at ``\\n``. A line's key is the line without ``[\\x20\\x09-\\x0D]`` at its ends and with A-Z in lower
    case; keys are compared by 128 bits of hashes. A key of at least ``min_chars`` code points that stands in
    enough documents loses all its lines, except in the document with the largest id that has it, which
    keeps every one. ``dropped`` holds the places of the lines that went, from 0, in order (empty: none); the others
    are joined by ``\\n`` as they were.

    A document is an id: rows that share an id count once, are the largest together, and are cut one by one.
    Rows without an id are one document, before all others. There is a result row for each row, also for
    repeated ones. A NULL text is an empty one, which has one empty line; a text that loses all lines is empty.
    An empty table gives an empty table; other columns are ignored, whatever their names.

    Each document counts a key once and the counts are summed before they meet. A line that a large share
    of the documents has is told by a table of at most COMMON rows, which every task gets; all other lines are
    joined by their hashes, so no key brings more than one in COMMON of them to a task.
    """
    spark = docs.sparkSession
    texts = documents(docs, id_column, text_column).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.select("doc_id", "text", *digests(F.col("text"), ("t1", "t2")))
    places = line_places(texts, min_chars)
    counts = places.select("h1", "h2", "doc_id").distinct().groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keeper"))
    folder = shared_folder(spark, "lines-")
    counts.filter(F.col("n") >= min_documents).write.parquet(folder)
    repeated = spark.read.parquet(folder)
    limit = (repeated.agg(F.sum("n")).first()[0] or 0) // COMMON
    common = repeated.filter(F.col("n") > limit).select("h1", "h2", F.col("keeper").alias("common_keeper"))
    rare = repeated.filter(F.col("n") <= limit).select("h1", "h2", F.col("keeper").alias("rare_keeper"))

    # Common lines are decided here and go through the second join under a key of their own, so they spread.
    decided = places.join(F.broadcast(common), ["h1", "h2"], "left")
    decided = decided.withColumn("h1", F.when(F.col("common_keeper").isNull(), F.col("h1")).otherwise(F.xxhash64("t1", "place")))
    keeper = F.coalesce("common_keeper", "rare_keeper")
    gone = decided.join(rare, ["h1", "h2"], "left").filter(keeper.isNotNull() & ~keeper.eqNullSafe(F.col("doc_id")))
    dropped = gone.groupBy(F.col("doc_id").alias("id"), F.col("t1").alias("u1"), F.col("t2").alias("u2")).agg(
        F.sort_array(F.collect_set("place")).alias("dropped"))

    rows = texts.join(dropped, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("t1") == F.col("u1")) & (F.col("t2") == F.col("u2")), "left")
    rows = computed(rows.select("doc_id", "text", "dropped", F.split("text", "\n").alias("lines")), "lines")
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "dropped")
    kept = F.array_join(F.transform(stay, lambda place: F.get("lines", place)), "\n")
    return rows.select("doc_id", F.when(F.col("dropped").isNull(), F.col("text")).otherwise(kept).alias("text"),
                       F.size("lines").cast("long").alias("n_lines"), F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
                       F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"))
