"""From records to a labelled, featurised corpus."""

from pyspark.sql import DataFrame, Window, functions as F

from pagelens import schemas
from pagelens.functions import html
from pagelens.functions.stages import computed
from pagelens.operators import analysis, clean, extract, features, labelling, language
from pagelens.sources import warc


def extracted_pages(records: DataFrame, language_model, max_per_domain: int = extract.MAX_PER_DOMAIN,
                    keep_xml: bool = False) -> DataFrame:
    """WARC records to the extracted-pages table. One shuffle: the cap per file and domain.

    Pages whose language cannot be told are dropped. Only pages that are kept count towards the cap, so it comes after the language step; the text is
    sanitised last, for kept pages only.
    """
    pages = extract.with_page_parts(extract.split_payload(records), keep_xml=keep_xml)
    pages = language.with_language(extract.usable(pages), language_model).filter("language is not null")
    capped = extract.cap_per_domain(pages, max_per_domain)
    return extract.sanitised(capped).select(*schemas.EXTRACTED.fieldNames(), "warc_file", "record_no")


def extraction_report(records: DataFrame, language_model, max_per_domain: int = extract.MAX_PER_DOMAIN,
                      keep_xml: bool = False) -> DataFrame:
    """What ``extracted_pages`` makes of an archive: (reason, n), one row for each reason a record or damaged place is lost,
    and ``kept``. ``records`` are read with rejects, so they have a status; each row counts once, for its first reason.
    """
    pages = extract.split_payload(records)
    xml = F.lit(False) if keep_xml else html.is_xml(F.col("html"))
    pages = computed(pages.withColumn("xml", xml), "html", "xml")
    pages = extract.with_page_parts(pages, keep_xml=True)
    lost = F.coalesce(F.when(F.col("status") != warc.OK, F.col("status")), F.when(F.col("xml"), "xml page"), extract.rejection_reason())
    pages = pages.select("warc_file", "domain", lost.alias("lost"), F.when(lost.isNull(), F.col("snippet")).alias("snippet"))
    pages = language.with_language(pages, language_model)
    reason = F.when(F.col("lost").isNull() & F.col("language").isNull(), "unknown language").otherwise(F.col("lost"))
    counts = pages.groupBy("warc_file", "domain", reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))
    cap = F.lit(max_per_domain).cast("long")
    split = F.when(F.col("reason").isNotNull(), F.array(F.struct("reason", "n"))).otherwise(F.array(
        F.struct(F.lit("kept").alias("reason"), F.least("n", cap).alias("n")),
        F.struct(F.lit("over domain limit").alias("reason"), F.greatest(F.col("n") - cap, F.lit(0)).alias("n"))))
    return counts.select(F.inline(split)).groupBy("reason").agg(F.sum("n").alias("n")).filter("n > 0")


def cleaned_features(classified: DataFrame, order: str) -> DataFrame:
    """Classified pages to the cleaned table with label lists and features."""
    cleaned = classified.withColumn("category", labelling.clean_labels(F.col("category")))
    cleaned = clean.clean_pages(cleaned, order, schemas.REQUIRED_TEXT + ["category"])
    return features.with_features(cleaned)


def label_profile(featured: DataFrame) -> DataFrame:
    """Per label: pages, share in percent, and quartiles of the title length."""
    boxes = analysis.box_statistics(featured, ["title_length"])
    # One row per label: the window holds at most as many rows as there are labels.
    whole = F.sum("n_pages").over(Window.partitionBy(F.lit(0)))
    return boxes.select("label", "n_pages", F.round(F.col("n_pages") * 100.0 / whole, 6).alias("percent"),
                        "q1", "median", "q3")
