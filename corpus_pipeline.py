"""A pipeline over the documents: language, near copies, repeated passages, packing.

Every stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written as Parquet and read
again as the documents of the next one.
"""

import public_tokenizers
from pyspark.sql import functions as F

from pagelens.llm import jaccard, language, packing, passages
from pagelens.llm.encoding import small_batches
from pagelens.session import shared_folder

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark, docs, sf_dir):
    """Documents whose text has letters, so that a language can be told; ``lang`` is filled with the prediction where
    it is missing. Rows are judged one by one, so rows with equal or NULL ids stay as they are."""
    small_batches(spark)
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = language.train(docs.filter(~held_out))
    found = language.predict(docs, model, carried=["lang", "source", "n_chars"]).filter(F.col("lang_pred") != language.UNDETERMINED)
    return found.select("doc_id", "text", F.coalesce("carried.lang", "lang_pred").alias("lang"), "carried.source", "carried.n_chars")


def join_near_copies(spark, docs, sf_dir):
    """One document of each group of near copies, the one with the smallest id.

    The decision is made for a shingle set and an id, so texts that share an id, or have none, are judged
    by their own groups; ties go to the smallest digest, then to the smallest text. Texts without words are
    in no group and stay, but rows of these with equal ids and texts count once. The texts are shuffled once, to
    meet the sets to keep.
    """
    small_batches(spark)
    groups = jaccard.similar_groups(docs, percent=80, size=5).filter("first AND node IS NOT NULL")
    sets = groups.groupBy("node", "doc_id").agg(F.count(F.lit(1)).alias("_rows"))
    sets = jaccard.stored(sets.select(F.col("node").alias("_node"), F.col("doc_id").alias("_id"), (F.col("_rows") > 1).alias("_repeated")), "kept")

    def rows_of(sets, docs):
        rows = jaccard.with_nodes(docs, COLUMNS, size=5)
        # Always by a shuffle of the texts, whatever the size of the sets, so that the stage is alike at every size.
        return rows.join(sets.hint("merge"), (F.col("node") == F.col("_node")) & F.col("doc_id").eqNullSafe(F.col("_id")))

    kept = rows_of(sets.filter("NOT _repeated"), docs).select(*COLUMNS)
    # Only the rows of the ids concerned are hashed again for these two.
    several = sets.filter("_repeated")
    # A table of its own, so that a few ids are known to be few before the texts are shuffled to meet them.
    ids = jaccard.stored(several.select("_id").distinct(), "repeated-ids")
    again = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    repeated = rows_of(several, again).groupBy("node").agg(F.min(F.struct("text", *[c for c in COLUMNS if c != "text"])).alias("_row"))
    wordless = docs.filter(~F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")).select(*COLUMNS).dropDuplicates(["doc_id", "text"])
    return kept.union(repeated.select(*[f"_row.{c}" for c in COLUMNS])).union(wordless)


def drop_passages(spark, docs, sf_dir):
    """Texts without the passages that an earlier document has; documents of which nothing is left go.
    Rows with equal ids keep a row each."""
    small_batches(spark, 500)
    rest = passages.drop_repeats(docs, carried=["lang", "source"]).filter(F.trim("text") != "")
    return rest.select("doc_id", "text", "carried.lang", "carried.source", F.char_length("text").cast("long").alias("n_chars"))


def pack_windows(spark, docs, sf_dir):
    """Training windows of at most 2048 ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)


STAGES = [
    ("language", identify_language),
    ("near_copies", join_near_copies),
    ("passages", drop_passages),
    ("packing", pack_windows),
]
ORACLE_SQL = None  # The first stage trains a network and the last one packs.


def run(spark, sf_dir):
    """Apply the stages to the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = shared_folder(spark, f"pipeline-{name}-")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
