"""Language of a text: naive Bayes over character trigrams, trained on texts of known language.

The model is a table of trigrams, of any length, that texts are joined with: neither training nor scoring
gathers anything on the driver or sends the model to every executor.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pagelens.functions.stages import let
from pagelens.session import shared_folder


def words(text: Column) -> Column:
    """Runs of letters of the lower-cased text."""
    return F.array_remove(F.split(F.regexp_replace(F.lower(text), r"[^\p{L}]+", " "), " "), "")


def trigrams(text: Column) -> Column:
    """Overlapping trigrams of the words, each word between two blanks on either side.

    Cutting the text into threes from its first, second and third character gives each one once.
    With two blanks between words, the trigrams of a text are those of its words taken one by one.
    """
    padded = F.concat(F.lit("  "), F.array_join(words(text), "  "), F.lit("  "))
    return let(padded, lambda t: F.concat(*[
        F.regexp_extract_all(F.substring(t, start, 2**31 - 1), F.lit("..."), F.lit(0)) for start in (1, 2, 3)]))


def trigram_counts(texts: DataFrame, text: str = "text", language: str = "lang") -> DataFrame:
    """(language, gram, n) in one pass over the texts; the empty gram counts the texts themselves.

    Words are counted first and cut into trigrams once per distinct word, so the rows that meet the
    first aggregation are words, not characters, and what follows grows with the vocabulary only.
    """
    tokens = F.concat(F.array(F.lit("")), words(F.col(text)))
    rows = texts.select(F.col(language).alias("language"), F.explode(tokens).alias("word")).filter("language is not null")
    counted = rows.groupBy("language", "word").agg(F.count("*").alias("n"))
    grams = F.when(F.col("word") == "", F.array(F.lit(""))).otherwise(trigrams(F.col("word")))
    return (counted.select("language", "n", F.explode(grams).alias("gram"))
            .groupBy("language", "gram").agg(F.sum("n").alias("n")))


class LanguageModel:
    """A trained model in a folder that every executor reaches.

    ``grams``: gram, and per language that has it the log of its count plus one. ``languages``: language, prior (log of
    its smoothed share of texts) and scale (log of all its trigrams plus the distinct ones of all languages). A
    language's score for a text is prior - known * scale + the sum of the logs, for ``known`` known trigrams.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.folder = folder
        self.grams = spark.read.parquet(f"{folder}/grams")
        self.languages = spark.read.parquet(f"{folder}/languages")


def train(texts: DataFrame, text: str = "text", language: str = "lang", folder: str | None = None) -> LanguageModel:
    """Fit on whole texts and write the model; counts are Laplace-smoothed. Texts of NULL language are left out."""
    spark = texts.sparkSession
    folder = folder or shared_folder(spark, "language-")
    counts = trigram_counts(texts, text, language)
    entry = F.struct("language", F.col("n").cast("double").alias("n"))
    counts.groupBy("gram").agg(F.collect_list(entry).alias("entries")).write.parquet(f"{folder}/counts")
    by_gram = spark.read.parquet(f"{folder}/counts")  # One row a trigram, with an entry for each language that has it.
    logs = F.transform("entries", lambda e: F.struct(e["language"], F.ln(e["n"] + 1).alias("value")))
    by_gram.filter("gram <> ''").select("gram", logs.alias("entries")).write.parquet(f"{folder}/grams")

    each = by_gram.select("gram", F.inline("entries"))
    sizes = each.groupBy("language").agg(F.sum(F.when(F.col("gram") == "", F.col("n"))).alias("texts"),
                                         F.coalesce(F.sum(F.when(F.col("gram") != "", F.col("n"))), F.lit(0.0)).alias("total"))
    every = by_gram.agg(F.count(F.when(F.col("gram") != "", 1)).alias("distinct"),
                        F.first(F.when(F.col("gram") == "", F.size("entries")), ignorenulls=True).alias("languages"),
                        F.first(F.when(F.col("gram") == "", F.aggregate("entries", F.lit(0.0), lambda a, e: a + e["n"])), ignorenulls=True).alias("texts"))
    whole = F.struct(*every.columns)
    sizes = sizes.withColumn("all", every.select(whole).scalar())
    sizes.select("language", (F.ln(F.col("texts") + 1) - F.ln(F.col("all.texts") + F.col("all.languages"))).alias("prior"),
                 F.ln(F.col("total") + F.col("all.distinct")).alias("scale")).write.parquet(f"{folder}/languages")
    return LanguageModel(spark, folder)


def word_scores(vocabulary: DataFrame, model: LanguageModel) -> DataFrame:
    """(word, language, value, every): the sum of the logs of a word's trigrams for each language that has one of them, and
    in a row without language how many are known, and how many there are."""
    grams = vocabulary.select("word", F.explode(trigrams(F.col("word"))).alias("gram")).join(model.grams, "gram", "left")
    known = F.when(F.col("entries").isNull(), 0.0).otherwise(1.0)
    itself = F.array(F.struct(F.lit(None).cast("string").alias("language"), known.alias("value"), F.lit(1.0).alias("every")))
    logs = F.transform(F.coalesce("entries", F.array().cast(model.grams.schema["entries"].dataType)), lambda e: F.struct(
        e["language"], e["value"], F.lit(0.0).alias("every")))
    rows = grams.select("word", F.inline(F.concat(itself, logs)))
    return rows.groupBy("word", "language").agg(F.sum("value").alias("value"), F.sum("every").alias("every"))


def with_language(df: DataFrame, model: LanguageModel, text: str = "snippet") -> DataFrame:
    """Add ``language``; NULL for a text that is NULL, has no letter, or of whose trigrams the model knows less than half,
    as those of a script or language that it has not seen.

    Each distinct text is scored once, from its distinct words, and each distinct word once, from its
    trigrams; texts are named by 128 bits of hashes. The rows are written to the shared folder first, so what led to
    them is not computed again for the join with the languages found. Equal scores go to the first language in order.
    """
    folder = shared_folder(df.sparkSession, "texts-")
    named = ["_t1", "_t2"]
    df.withColumns({"_t1": F.xxhash64(text), "_t2": F.xxhash64(F.lit(1), text)}).write.parquet(folder)
    rows = df.sparkSession.read.parquet(folder)
    texts = rows.filter(F.col(text).isNotNull()).groupBy(*named).agg(F.first(text).alias("text"))
    counted = texts.select(*named, F.explode(words(F.col("text"))).alias("word")).groupBy(*named, "word").agg(F.count(F.lit(1)).alias("n"))
    scores = word_scores(counted.select("word").distinct(), model)
    n = F.col("n")
    by_language = counted.join(scores, "word").groupBy(*named, "language").agg(
        F.sum(n * F.col("value")).alias("value"), F.sum(n * F.col("every")).alias("every"))
    of_language = F.col("language").isNotNull()
    found = by_language.groupBy(*named).agg(
        F.sum(F.when(~of_language, F.col("value"))).alias("known"), F.sum("every").alias("every"),
        F.map_from_entries(F.collect_list(F.when(of_language, F.struct("language", "value")))).alias("sums"))
    found = found.filter(2 * F.col("known") >= F.col("every"))
    languages = model.languages.agg(F.array_sort(F.collect_list(F.struct("language", "prior", "scale"))).alias("languages"))
    found = found.withColumn("languages", languages.scalar())
    score = F.transform("languages", lambda m: F.struct(
        (m["prior"] - F.col("known") * m["scale"] + F.coalesce(F.element_at("sums", m["language"]), F.lit(0.0))).alias("score"), m["language"]))
    best = let(score, lambda s: F.reduce(s, F.get(s, F.lit(0)), lambda a, b: F.when(b["score"] > a["score"], b).otherwise(a)))
    found = found.select(*named, best["language"].alias("language"))
    return rows.join(found, named, "left").select(*df.columns, "language")
