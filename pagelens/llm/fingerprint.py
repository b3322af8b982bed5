"""Fingerprints of documents by consistent weighted sampling, in DataFrame operations only.

A document is a vector of word counts. For sample k every word has three random numbers that follow
from the word and k alone: r and c from a gamma distribution with shape 2 and a uniform shift b. With
weight w the word's value is ln c - r (floor(ln w / r + b) - b) - r, and the smallest value is the
sample. Two documents have the same sample with a probability equal to their generalised Jaccard
similarity, the sum of the smaller weights over the sum of the larger ones.
"""

from pyspark.sql import Window, functions as F

from pagelens.functions.stages import computed

SAMPLES = 32


def hashed(word_hash, weights, k):
    """The values of one word for sample ``k`` under several weights; NULL where the weight is 0."""
    one, two = F.xxhash64(word_hash, F.lit(2 * k)), F.xxhash64(word_hash, F.lit(2 * k + 1))

    def uniform(h, shift, bits):
        return (F.shiftrightunsigned(h, shift).bitwiseAND(F.lit((1 << bits) - 1)).cast("double") + 0.5) / float(1 << bits)

    r = -F.ln(uniform(one, 0, 32) * uniform(one, 32, 32))
    log_c = F.ln(-F.ln(uniform(two, 0, 22) * uniform(two, 22, 22)))
    shift = uniform(two, 44, 20)
    return [F.when(w > 0, log_c - r * (F.floor(F.ln(w) / r + shift) - shift) - r) for w in weights]


def words(text):
    return F.split(F.replace(F.replace(text, F.lit("\n"), F.lit(" ")), F.lit("\t"), F.lit(" ")), " ")


def signatures(texts, keys, sides, samples=SAMPLES):
    """One row per group of ``keys`` with an array of ``samples`` numbers for each side.

    ``texts`` has the keys, ``side`` (0 and up) and ``text``. If it is partitioned by one of the keys, nothing
    is shuffled. Groups without words have no row.
    """
    rows = texts.select(*keys, "side", F.explode(words(F.col("text"))).alias("word")).filter("word <> ''")
    rows = rows.select(*keys, "side", F.xxhash64("word").alias("word"))
    weights = rows.groupBy(*keys, "word").agg(*[
        F.sum(F.when(F.col("side") == s, 1.0).otherwise(0.0)).alias(f"w{s}") for s in range(sides)])
    drawn = [hashed(F.col("word"), [F.col(f"w{s}") for s in range(sides)], k) for k in range(samples)]
    sampled = weights.groupBy(*keys).agg(*[F.min(drawn[k][s]).alias(f"s{s}_{k}") for s in range(sides) for k in range(samples)])
    return sampled.select(*keys, *[F.array(*[f"s{s}_{k}" for k in range(samples)]).alias(f"signature{s}") for s in range(sides)])


def codes(signature, samples=SAMPLES):
    """16 bits of every sample; all 0 for a document without words."""
    return F.coalesce(F.transform(signature, lambda x: F.coalesce(F.xxhash64(x).bitwiseAND(F.lit(0xFFFF)), F.lit(0).cast("long"))),
                      F.array_repeat(F.lit(0).cast("long"), samples))


def in_hex(code):
    return F.array_join(F.transform(code, lambda x: F.lower(F.lpad(F.hex(x), 4, "0"))), "")


def likeness(a, b, samples=SAMPLES):
    """Share of equal samples."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same)) / F.lit(float(samples))


def fingerprints(docs, id_column="doc_id", text_column="text", samples=SAMPLES):
    """Fingerprint of every text and of its first half followed by the next document's beginning.

    Documents follow each other in descending order of their ids (NULL last; equal ids in the order of a
    hash of their texts), the first after the last. The last floor(n / 2) of a text's n code points are
    replaced by as many of the next text, or all it has. Columns: doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint (hex), near_edited and near_next (share of equal samples).

    NULL counts as empty; texts without words have a fingerprint of zeros. Rows with equal ids keep a
    row each; an empty table gives an empty result. Texts are shuffled once, into ranges of ids; the first
    row of the following range is dealt to both, so that every row finds its next one in its own range.
    """
    spark = docs.sparkSession
    rows = docs.select(docs[id_column].cast("long").alias("doc_id"), F.coalesce(docs[text_column].cast("string"), F.lit("")).alias("text"))
    partitions = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / (4 * partitions) for i in range(1, 4 * partitions)]
    # Range limits are ids of the table, as many as four times the partitions.
    found = rows.agg(F.percentile_approx("doc_id", shares, 20 * partitions).alias("limits"), F.max("doc_id").alias("top")).first()
    limits = sorted(set(found.limits or []))
    bounds = F.lit(limits) if limits else F.array().cast("array<long>")
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(max(1, len(limits).bit_length())))])
    own = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(bounds, at + step - 1) < F.col("doc_id"), at + step).otherwise(at))
    own = F.coalesce(own, F.lit(0))
    after = F.array_position(bounds, F.col("doc_id")).cast("int")  # Of a limit, the range above; else 0.
    copies = F.concat(
        F.array(F.struct(own.alias("range"), F.lit(0).alias("guest"))),
        F.when(after > 0, F.array(F.struct(after.alias("range"), F.lit(1).alias("guest")))).otherwise(F.array()),
        F.when(F.col("doc_id").eqNullSafe(F.lit(found.top).cast("long")), F.array(F.struct(F.lit(0).alias("range"), F.lit(2).alias("guest")))).otherwise(F.array()))
    # The filter drops nothing; with it both uses of the table below have the same plan and share one shuffle.
    dealt = rows.select("doc_id", "text", F.inline(copies)).filter("range IS NOT NULL").repartition(partitions, "range")
    order = Window.partitionBy("range").orderBy("guest", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"))
    placed = dealt.select("range", "guest", "doc_id", "text", F.row_number().over(order).alias("place"),
                          F.coalesce(F.lead("text").over(order), F.lit("")).alias("following"))
    placed = placed.withColumn("n_chars", F.char_length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("following", F.lit(1), half))
    placed = placed.select("range", "guest", "place", "doc_id", "n_chars", "text", F.when(F.col("guest") == 0, edited).alias("edited"))
    both = placed.select("range", "place", F.inline(F.array(
        F.struct(F.lit(0).alias("side"), F.col("text").alias("text")), F.struct(F.lit(1).alias("side"), F.col("edited").alias("text")))))
    signed = signatures(both, ["range", "place"], 2, samples)
    about = placed.select("range", "place", "guest", "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"))
    joined = about.join(signed, ["range", "place"], "left")
    joined = computed(joined.select("range", "place", "guest", "doc_id", "n_chars", "edited_sha256", codes(F.col("signature0"), samples).alias("own"),
                                    codes(F.col("signature1"), samples).alias("changed")), "own", "changed")
    following = F.lead("own").over(Window.partitionBy("range").orderBy("place"))
    joined = joined.withColumn("following", following).filter("guest = 0")
    return joined.select("doc_id", "n_chars", "edited_sha256", in_hex(F.col("own")).alias("fingerprint"),
                         in_hex(F.col("changed")).alias("edited_fingerprint"), likeness(F.col("own"), F.col("changed"), samples).alias("near_edited"),
                         likeness(F.col("own"), F.col("following"), samples).alias("near_next"))
