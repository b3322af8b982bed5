"""Tables derived from the given ones with Spark. Each grows with its source table."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from pagelens.functions import html, text as tx, vectors as v
from pagelens.labels import LABELS, label_array, label_of
from pagelens.operators import embedding, extract, labelling, scoring
from pagelens.sources import tables

RECORDS_PER_FILE = 64


def table(spark: SparkSession, folder: str, name: str, *columns) -> DataFrame:
    return tables.read_parquet(spark, f"{folder}/{name}.parquet", columns or None)


def page_records(spark, folder) -> DataFrame:
    """Pages as crawl records with an HTTP header block and, on some, a description tag."""
    page = F.col("page_id")
    text_id = page.cast("string")
    head = (F.when(page % 6 == 0, F.replace("html", F.lit("<head>"), F.concat(
                F.lit('<head><meta property="og:description" content="og '), text_id, F.lit('">'))))
            .when(page % 6 == 1, F.replace("html", F.lit("<head>"), F.concat(
                F.lit('<head><meta name="description" content="about '), text_id, F.lit('">'))))
            .otherwise(F.col("html")))
    payload = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nSERVER: s"), (page % 3).cast("string"),
                       F.lit("\r\n\r\n"), head)
    return table(spark, folder, "pages", "page_id", "url", "html").select(
        "page_id", F.floor(page / RECORDS_PER_FILE).cast("int").alias("warc_file"), page.alias("record_no"),
        F.concat(F.lit("urn:"), text_id).alias("warc_id"), "url", F.lit("2024-01-01T00:00:00Z").alias("warc_date"),
        payload.alias("payload"))


def page_parts(spark, folder) -> DataFrame:
    """Records with title, snippet, description and domain."""
    records = tables.spread(page_records(spark, folder))
    return extract.with_page_parts(extract.split_payload(records))


def dup_pages(spark, folder) -> DataFrame:
    """Every page four times: as it is, again under a new id, under a new URL, and again with the id
    or, for short URLs, without one."""
    page = page_records(spark, folder).select("page_id", "warc_id", "url")
    copies = F.array(
        F.struct(F.col("page_id"), F.col("warc_id"), F.col("url")),
        F.struct((F.col("page_id") + 1000000000).alias("page_id"),
                 F.concat(F.lit("urn:d"), F.col("page_id").cast("string")).alias("warc_id"), F.col("url")),
        F.struct((F.col("page_id") + 2000000000).alias("page_id"), F.col("warc_id"),
                 F.concat("url", F.lit("?copy=1")).alias("url")),
        F.struct((F.col("page_id") + 3000000000).alias("page_id"),
                 F.when(F.char_length("url") > 40, F.col("warc_id")).alias("warc_id"), F.col("url")))
    return page.select(F.inline(copies))


def _label_indexes():
    p = F.col("page_id")
    return (p * p + 3) % 11, (p * p * 3 + p + 6) % 11, (p * 3 + 10) % 11


def labelled_pages(spark, folder) -> DataFrame:
    """Pages with label texts of one to three labels, with uneven blanks and repeats."""
    a, b, c = (label_of(i.cast("int")) for i in _label_indexes())
    category = (F.when(F.col("page_id") % 7 == 0, F.concat(a, F.lit(", "), b, F.lit(","), c))
                .when(F.col("page_id") % 7 < 3, F.concat(a, F.lit(","), b)).otherwise(a))
    return table(spark, folder, "pages", "page_id", "url").withColumn("category", category)


def label_lists(spark, folder) -> DataFrame:
    return labelled_pages(spark, folder).withColumn("category", labelling.clean_labels(F.col("category")))


def label_features(spark, folder) -> DataFrame:
    """Label lists with the page's own lengths and counts."""
    pages = html.with_title(table(spark, folder, "pages", "page_id", "html")).select("page_id", "title")
    # Both sides hold one row per page.
    lists = label_lists(spark, folder)
    return lists.join(pages, "page_id").withColumns({
        "title_length": F.char_length("title"), "url_length": F.char_length("url"),
        "url_special_count": tx.punctuation_count(F.col("url")), "title_word_count": tx.word_count(F.col("title"))})


def predictions(spark, folder) -> DataFrame:
    """Truth and the probabilities of two models as arrays, one row per page."""
    p = F.col("page_id")
    first, second, third = _label_indexes()

    def truth(_, i):
        i = i.cast("bigint")
        return F.when((i == first) | ((p % 7 < 3) & (i == second)) | ((p % 7 == 0) & (i == third)), 1).otherwise(0)

    def prob_a(y, i):
        i = i.cast("bigint")
        return (y * 400 + (p * 7919 + p * i * 31 + i * 104729) % 599).cast("double") / 1000 + 0.0005

    def prob_b(y, i):
        i = i.cast("bigint")
        return (y * 350 + (p * p * 13 + p * i * 17 + i * 104723) % 640).cast("double") / 1000 + 0.0005

    rows = table(spark, folder, "pages", "page_id").withColumn("y", F.transform(label_array(), truth))
    rows = rows.withColumns({"prob_a": F.transform("y", prob_a), "prob_b": F.transform("y", prob_b)})
    return rows.withColumns({"pred_a": scoring.predictions(F.col("prob_a")), "pred_b": scoring.predictions(F.col("prob_b"))})


def scored(spark, folder, model: str = "a") -> DataFrame:
    return predictions(spark, folder).select(
        "page_id", "y", F.col(f"prob_{model}").alias("prob"), F.col(f"pred_{model}").alias("pred"))


def categories(spark, folder) -> DataFrame:
    """One embedding per category: the mean of its items."""
    items = table(spark, folder, "embeddings", "label", "embedding")
    return embedding.mean_vectors(items, "label")


def clustered(spark, folder) -> DataFrame:
    noise = F.col("vec_id") % 17 == 0
    return table(spark, folder, "embeddings").select(
        "vec_id", "embedding", F.when(noise, -1).otherwise(F.col("label")).alias("cluster"))


N_LAYERS, N_HEADS = 2, 3


def tokens(spark, folder) -> DataFrame:
    """Tokens of URL and title between the two marks."""
    pages = html.with_title(tables.spread(table(spark, folder, "pages", "page_id", "url", "html")))
    inner = tx.tokens(tx.model_text(F.col("url"), F.col("title")))
    return pages.select(F.col("page_id").alias("example"),
                        F.concat(F.array(F.lit("[CLS]")), inner, F.array(F.lit("[SEP]"))).alias("tokens"))


def attention(spark, folder) -> DataFrame:
    """Attention matrices of every page, rows summing to one."""
    rows = tokens(spark, folder)
    layers = F.explode(F.sequence(F.lit(0), F.lit(N_LAYERS - 1))).alias("layer")
    heads = F.explode(F.sequence(F.lit(0), F.lit(N_HEADS - 1))).alias("head")
    rows = rows.select("*", layers).select("*", heads)
    at = F.sequence(F.lit(0), F.size("tokens") - 1)

    def raw(q, k):
        return ((F.col("example") * 31 + F.col("layer") * 17 + F.col("head") * 13 * (k + 1) + q * 7 + k * k * 5) % 97
                + 1).cast("double")

    rows = rows.withColumn("weights", F.transform(at, lambda q: F.transform(at, lambda k: raw(q, k))))
    return rows.withColumn("weights", F.transform("weights", v.shares))


def gradients(spark, folder) -> DataFrame:
    """Gradient vectors of 16 tokens for each embedding, cut from it four numbers at a time."""
    at = F.sequence(F.lit(0), F.lit(15))
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("example"), F.get(label_array(), F.col("label") % len(LABELS)).alias("label"),
        F.transform(at, lambda i: F.concat(F.lit("w"), i.cast("string"))).alias("tokens"),
        F.transform(at, lambda i: F.transform(F.slice(v.as_double(F.col("embedding")), i * 4 + 1, 4),
                                              lambda x: x / 20)).alias("gradients"))


def visits(spark, folder) -> DataFrame:
    """Page visits: loading or complete, own pages of the extension, missing titles."""
    p = F.col("page_id")
    pages = html.with_title(table(spark, folder, "pages", "page_id", "url", "html"))
    return pages.select(
        p.alias("tab_id"),
        F.when(p % 10 == 3, F.concat(F.lit("moz-extension://x/"), p.cast("string"))).otherwise(F.col("url")).alias("url"),
        F.when(p % 8 != 5, F.col("title")).alias("title"),
        F.when(p % 4 == 0, "loading").otherwise("complete").alias("status"))
