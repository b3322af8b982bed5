"""Metadata and plain-text conversion records of WARC responses."""

from pyspark.sql import Column, DataFrame, functions as F

from pagelens.functions import html
from pagelens.functions.stages import computed, let

# Elements whose content is no text, and elements that begin a line of their own.
UNSHOWN = ["script", "style", "noscript", "template"]
BLOCKS = ("address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figure|footer|form|h1|h2|h3|h4|h5|h6|head|header|hr|html|"
          "li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul")


def plain_text(markup: Column) -> Column:
    """Text of an HTML page, with entities still encoded: a line per block, blanks of the markup made single.

    Comments and elements of ``UNSHOWN`` go from left to right, so a comment mark inside a script is part of
    the script. A comment, element or tag that is not closed reaches to the end of the page, so every
    expression reads the page once. Blanks are matched only where they change.
    """
    hidden = "|".join([r"<!--.*?(?:-->|\z)", *[rf"<{name}\b[^>]*+(?:>.*?(?:</{name}\s*>|\z)|\z)" for name in UNSHOWN]])
    page = F.regexp_replace(markup, f"(?is){hidden}", " ")
    page = F.regexp_replace(page, r"[\x09-\x0D][\x20\x09-\x0D]*+|\x20[\x20\x09-\x0D]++", " ")
    page = F.regexp_replace(page, rf"(?i)</?(?:{BLOCKS})\b[^>]*+(?:>|\z)", "\n")
    page = F.regexp_replace(page, r"<[A-Za-z/!?][^>]*+(?:>|\z)", "")
    page = F.regexp_replace(page, r"(?<! ) ++\n[ \n]*+|\n[ \n]++", "\n")
    return F.btrim(page, F.lit(" \n"))


def record_id(*parts: Column) -> Column:
    """A urn:uuid that follows from the parts, so a task that runs again names its records alike."""
    digest = F.sha2(F.concat_ws("\n", *parts), 256)
    pieces = [F.substring(digest, at, n) for at, n in ((1, 8), (9, 4), (14, 3), (18, 3), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), pieces[0], F.lit("-"), pieces[1], F.lit("-5"), pieces[2], F.lit("-8"), pieces[3], F.lit("-"),
                    pieces[4], F.lit(">"))


def sha256(content: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(content.cast("binary"), 256))


def header_lines(pairs) -> Column:
    """Header lines of the values that are not NULL; line ends inside a value become blanks."""
    return F.concat_ws("", *[
        F.concat(F.lit(name + ": "), F.regexp_replace(value.cast("string"), r"[\r\n]+", " "), F.lit("\r\n")) for name, value in pairs])


def derive(responses: DataFrame, id_column="warc_id", url_column="url", date_column="warc_date", payload_column="payload") -> DataFrame:
    """Two linked records per response, as one row: warc_id, url, warc_date, http_headers, payload_digest,
    conversion_id, conversion_text, conversion_record, metadata_id, metadata_record (whole records, as text).

    The conversion record holds the page's plain text and its digest and refers to the response; the
    metadata record refers to the response too, names the conversion, and keeps the source's headers and
    payload digest as warc-fields. Ids follow from the source's id, url and digest. Narrow: one pass.

    A NULL payload counts as empty and gives an empty text; NULL ids, urls and dates leave their header
    out. Equal rows give equal records. Other columns are left behind.
    """
    rows = responses.select(
        responses[id_column].cast("string").alias("warc_id"), responses[url_column].cast("string").alias("url"),
        responses[date_column].cast("string").alias("warc_date"),
        F.coalesce(html.decode(responses[payload_column]), F.lit("")).alias("_content"))
    rows = rows.select("warc_id", "url", "warc_date", html.header_block(F.col("_content")).alias("http_headers"),
                       html.body(F.col("_content")).alias("_body"))
    rows = computed(rows.withColumn("payload_digest", sha256(F.col("_body"))), "_body", "http_headers", "payload_digest")
    rows = computed(rows.withColumn("_body", plain_text(F.col("_body"))), "_body")
    rows = computed(rows.withColumn("conversion_text", html.decode_entities(F.col("_body"))).drop("_body"), "conversion_text")
    source = F.coalesce("warc_id", F.lit("")), F.coalesce("url", F.lit("")), F.col("payload_digest")
    rows = rows.withColumns({
        "conversion_id": record_id(F.lit("conversion"), *source), "metadata_id": record_id(F.lit("metadata"), *source),
        "_text_digest": sha256(F.col("conversion_text"))})
    rows = computed(rows, "conversion_id", "metadata_id", "_text_digest")
    fields = header_lines([
        ("source-status", F.nullif(F.regexp_extract("http_headers", r"\AHTTP/\S+ +(\d+)", 1), F.lit(""))),
        ("source-content-type", F.nullif(html.header(F.col("http_headers"), "content-type"), F.lit(""))),
        ("source-server", F.nullif(html.header(F.col("http_headers"), "server"), F.lit(""))),
        ("source-payload-digest", F.col("payload_digest")), ("conversion-record", F.col("conversion_id")),
        ("conversion-digest", F.col("_text_digest")), ("conversion-characters", F.char_length("conversion_text"))])

    def record(kind, own_id, content_type, block, digest):
        head = header_lines([
            ("WARC-Type", F.lit(kind)), ("WARC-Record-ID", own_id), ("WARC-Refers-To", F.col("warc_id")), ("WARC-Target-URI", F.col("url")),
            ("WARC-Date", F.col("warc_date")), ("Content-Type", F.lit(content_type)), ("WARC-Block-Digest", digest),
            ("Content-Length", F.octet_length(block))])
        return F.concat(F.lit("WARC/1.0\r\n"), head, F.lit("\r\n"), block, F.lit("\r\n\r\n"))

    return rows.select(
        "warc_id", "url", "warc_date", "http_headers", "payload_digest", "conversion_id", "conversion_text",
        record("conversion", F.col("conversion_id"), "text/plain; charset=UTF-8", F.col("conversion_text"), F.col("_text_digest")).alias("conversion_record"),
        "metadata_id",
        let(fields, lambda f: record("metadata", F.col("metadata_id"), "application/warc-fields", f, sha256(f))).alias("metadata_record"))


def write_records(derived: DataFrame, folder: str) -> None:
    """Write the records as a text table that reads as WARC when its files are put together: gzip, metadata before
    conversion. Spark's writer commits whole files only, so a lost executor leaves none behind."""
    (derived.select(F.concat("metadata_record", "conversion_record").alias("value"))
     .write.option("compression", "gzip").option("lineSep", "\r\n").text(folder))
