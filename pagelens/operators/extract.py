"""From WARC records to extracted pages."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from pagelens.functions import html, text as tx, url as u
from pagelens.functions.stages import computed

# Limits of the extraction.
MIN_SNIPPET = 10
MAX_PER_DOMAIN = 100
TITLE_LENGTH, SNIPPET_LENGTH, META_LENGTH = 500, 1000, 500


def split_payload(records: DataFrame, payload: str = "payload") -> DataFrame:
    """Add ``content_type``, ``server`` and ``html`` from a payload with or without HTTP headers."""
    df = records
    if dict(df.dtypes)[payload] == "binary":
        df = df.withColumn(payload, html.decode(F.col(payload)))
    df = df.withColumns({"_block": html.header_block(F.col(payload)), "html": html.body(F.col(payload))})
    return df.withColumns({
        "content_type": html.header(F.col("_block"), "content-type"),
        "server": html.header(F.col("_block"), "server"),
    }).drop("_block", payload)


def with_page_parts(pages: DataFrame, sentences: int = 2, keep_xml: bool = False) -> DataFrame:
    """Add title, snippet, meta description and domain; the page itself is dropped."""
    if not keep_xml:
        # Fixed first, or the filter would cut the page out of its payload again for each mark.
        pages = computed(pages, "html")
        pages = pages.filter(~html.is_xml(F.col("html")))
    df = pages.withColumns({"title": html.raw_title(F.col("html")),
                            "meta_description": html.raw_meta_description(F.col("html"))})
    df = html.with_visible_text(df, "html", "snippet").drop("html")
    df = df.withColumns({
        "title": tx.strip(html.decode_entities(F.col("title"))),
        "meta_description": html.decode_entities(F.col("meta_description")),
        "snippet": html.first_sentences(F.col("snippet"), sentences),
        "domain": u.domain(F.col("url")),
    })
    return computed(df, "title", "snippet", "meta_description", "domain")


def usable(pages: DataFrame) -> DataFrame:
    """Pages with a title and a snippet long enough to tell the language; others are rejected."""
    return pages.filter(
        (F.col("url") != "") & (F.col("title") != "") & (F.char_length("snippet") > MIN_SNIPPET))


def rejection_reason() -> Column:
    """Why ``usable`` drops a page; NULL for pages it keeps."""
    return (F.when(F.coalesce(F.col("url"), F.lit("")) == "", "no url")
            .when(F.coalesce(F.col("title"), F.lit("")) == "", "no title")
            .when(F.coalesce(F.char_length("snippet"), F.lit(0)) <= MIN_SNIPPET, "short snippet"))


def rejected_count(pages: DataFrame) -> DataFrame:
    """How many pages ``usable`` drops, by reason."""
    return (pages.select(rejection_reason().alias("reason")).filter(F.col("reason").isNotNull())
            .groupBy("reason").agg(F.count("*").alias("n")))


def cap_per_domain(pages: DataFrame, n: int = MAX_PER_DOMAIN, scope: str = "file", order="record_no") -> DataFrame:
    """At most ``n`` pages of a domain, per WARC file or in the whole corpus.

    ``row_number <= n`` also prunes each group before the shuffle, so a hot domain sends at most
    ``n`` rows per task.
    """
    if scope not in ("file", "corpus"):
        raise ValueError("scope is 'file' or 'corpus'")
    keys = ["warc_file", "domain"] if scope == "file" else ["domain"]
    order = [order] if isinstance(order, str) else list(order)
    if scope == "corpus":  # Record numbers repeat from file to file.
        order += [c for c in ("warc_file",) if c in pages.columns and c not in order]
    first = Window.partitionBy(*keys).orderBy(*order)
    return pages.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= n).drop("_n")


def truncated(pages: DataFrame) -> DataFrame:
    """Cut the text fields to their stored lengths; NULL becomes ''."""
    def cut(name, length):
        return F.coalesce(F.substring(F.col(name), 1, length), F.lit(""))
    return pages.withColumns({"title": cut("title", TITLE_LENGTH), "snippet": cut("snippet", SNIPPET_LENGTH),
                              "meta_description": cut("meta_description", META_LENGTH)})


def sanitised(pages: DataFrame) -> DataFrame:
    return truncated(tx.with_sanitised(pages, "title", "snippet", "meta_description"))
