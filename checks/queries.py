"""One query per operator: name -> function of (spark, folder)."""

from pyspark.sql import functions as F

from checks import views as w
from pagelens.functions import html, text as tx, url as u, vectors as v
from pagelens import schemas
from pagelens.labels import LABELS, index_of, label_array, label_dimension
from pagelens.operators import (
    analysis, clean, embedding, extract, features, labelling, language, metrics, model, ranking, scorematrix,
    scoring,
)
from pagelens.plans import corpus
from pagelens.session import shared_folder
from pagelens.sources import csvparts, paths, tables, warc
from pagelens.streaming import crawl, visits

QUERIES = {}

# Keywords of the local labeller, for the words that occur in the given pages.
KEYWORDS = {
    "blog.": "Entertainment", "spam-farm": "Shop", "://m.": "Chat", "/fr/": "Travel", "/es/": "Education",
    "/de/": "Work", "tion": "News", "heed": "Health",
}
EPS = 0.9


def query(function):
    QUERIES[function.__name__] = function
    return function


def _round(df, *names, digits=6):
    return df.withColumns({n: F.round(F.col(n), digits) for n in names})


def _text(df, *names):
    """Label lists as text, for comparison."""
    return df.withColumns({n: F.array_join(F.col(n).cast("array<string>"), "|") for n in names})


# ------------------------------------------------------------------ sources
DAMAGED_EVERY, DAMAGED_AT = 50, 11  # Pages whose member of the archive is damaged.


def _warc_folder(s, d, damaged=False):
    """The pages as gzip WARC files, written by the tasks; with some members damaged in the middle."""
    folder = shared_folder(s, "warc-")

    filesystem_of = warc.filesystem_of

    def write(frames):
        import gzip
        import pandas as pd
        filesystem, name = filesystem_of(folder)
        filesystem.create_dir(name, recursive=True)
        current, out = None, None
        for frame in frames:  # Sorted by file, so a file is written from one end to the other.
            for row in frame.itertuples():
                if row.warc_file != current:
                    if out:
                        out.close()
                    current, out = row.warc_file, filesystem.open_output_stream(f"{name}/part-{row.warc_file:06d}.warc.gz", compression=None)
                for kind, block in (("request", b"GET / HTTP/1.1\r\n\r\n"), ("response", row.payload.encode())):
                    head = (f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {row.url}\r\n"
                            f"WARC-Record-ID: {row.warc_id}\r\nWARC-Date: {row.warc_date}\r\n"
                            f"Content-Length: {len(block)}\r\n\r\n").encode()
                    member = gzip.compress(head + block + b"\r\n\r\n")
                    if damaged and kind == "response" and row.page_id % DAMAGED_EVERY == DAMAGED_AT:
                        middle = len(member) // 2
                        member = member[:middle] + bytes(255 - b for b in member[middle:middle + 8]) + member[middle + 8:]
                    out.write(member)
            yield pd.DataFrame({"n": [len(frame)]})
        if out:
            out.close()

    records = w.page_records(s, d).repartition("warc_file").sortWithinPartitions("warc_file", "record_no")
    records.mapInPandas(write, "n long").write.format("noop").mode("overwrite").save()
    return folder


@query
def s01_read_warc(s, d):
    records = warc.read_warc(s, _warc_folder(s, d))
    return records.select("url", "warc_id", "warc_date",
                          F.md5(html.decode(F.col("payload"))).alias("payload_md5"))


@query
def s01_read_damaged_warc(s, d):
    """Archives with damaged members: all sound records, and a row without payload for each damaged place."""
    records = warc.read_warc(s, _warc_folder(s, d, damaged=True), rejects=True)
    return records.groupBy(F.regexp_extract("warc_file", r"part-(\d+)", 1).cast("int").alias("warc_file"), "status").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length("payload")), F.lit(0)).alias("bytes"))


@query
def s02_cap_records_per_file(s, d):
    return warc.cap_records(w.page_records(s, d).select("warc_file", "record_no", "url"), 20)


@query
def s03_read_path_list(s, d):
    folder = shared_folder(s, "paths-")
    lines = w.table(s, d, "pages", "url").select(F.concat(F.lit("  "), "url", F.lit(" \n \n")))
    lines.write.mode("overwrite").text(folder)
    return paths.read_path_list(s, folder).select("path")


@query
def s04_first_paths(s, d):
    return paths.first_paths(w.table(s, d, "pages", "url").withColumnRenamed("url", "path"), 50, "path")


@query
def s05_sample_paths(s, d):
    return paths.sample_paths(w.table(s, d, "pages", "url").withColumnRenamed("url", "path"), 40, seed=1)


@query
def s06_read_gzip_path_list(s, d):
    folder = shared_folder(s, "paths-")
    lines = w.table(s, d, "pages", "url").select(u.path(F.col("url")))
    lines.write.mode("overwrite").option("compression", "gzip").text(folder)
    return paths.read_path_list(s, folder, "https://data.example.org").select("path")


@query
def s07_skip_processed(s, d):
    urls = w.table(s, d, "pages", "url").withColumnRenamed("url", "path")
    return paths.not_processed(urls, urls.filter(F.contains("path", F.lit("/en/"))))


@query
def s08_stop_at_target(s, d):
    target = w.table(s, d, "documents", "doc_id").count()
    existing = w.table(s, d, "labels", "doc_id").count()
    return ranking.first_rows(w.table(s, d, "documents", "doc_id", "lang"), target - existing, "doc_id")


@query
def s09_read_parquet(s, d):
    return w.table(s, d, "documents", "doc_id", "lang", "source", "n_chars")


@query
def s10_write_parquet(s, d):
    """One language after the other is written over the one before; all are read back in between."""
    folder = shared_folder(s, "table-")
    docs = w.table(s, d, "documents")
    found = []
    for lang in ("de", "en", "es", "fr"):
        tables.write_parquet(docs.filter(F.col("lang") == lang), folder)
        found.append(tables.read_parquet(s, folder, ["lang", "n_chars"]).groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("n_chars")).first())
    rest = docs.filter(F.coalesce(F.col("lang"), F.lit("")).isin("de", "en", "es", "fr") == F.lit(False))
    tables.write_parquet(rest.unionByName(docs.filter("lang = 'en'")), folder)
    left = tables.read_parquet(s, folder, ["doc_id", "lang", "n_chars"])
    before = s.createDataFrame([r for r in found if r], "lang string, n long, n_chars long")
    return left.groupBy("lang").agg(F.count(F.lit(1)).alias("n_left"), F.sum("n_chars").alias("chars_left")).join(before, "lang", "full")


@query
def s11_append_parquet(s, d):
    folder = shared_folder(s, "table-")
    docs = w.table(s, d, "documents")
    for part in range(4):  # All documents, in four appends.
        tables.append_parquet(docs.filter(F.pmod("doc_id", F.lit(4)) == part), folder)
    return tables.read_parquet(s, folder, ["doc_id", "lang", "n_chars"])


@query
def s12_s13_csv_results(s, d):
    folder = shared_folder(s, "csv-")
    rows = w.scored(s, d).join(w.table(s, d, "pages", "page_id", "url"), "page_id")
    tables.write_csv(scoring.wide_results(rows, ("url",)), folder)
    schema = "url string, " + ", ".join(
        f"true_{n} int, pred_{n} int, prob_{n} double" for n in LABELS)
    back = scoring.from_wide(tables.read_csv(s, folder, schema), ("url",))
    n_true = F.aggregate("y", F.lit(0), lambda a, x: a + x)
    n_pred = F.aggregate("pred", F.lit(0), lambda a, x: a + x)
    return back.select("url", n_true.alias("n_true"), n_pred.alias("n_pred"), F.round(v.total(F.col("prob")), 6).alias("sum_prob"))


@query
def s12_read_csv_in_parts(s, d):
    """CSV files of all documents, whose texts have quotes and line ends, each of them read by many tasks. Every task writes a
    file of its own, as one for all would pass through one task."""
    folder = shared_folder(s, "csv-")
    docs = w.table(s, d, "documents", "doc_id", "text", "lang").withColumn("text", F.concat(F.lit('" ,\n"'), F.coalesce("text", F.lit("")), F.lit("\n\"")))
    tables.write_csv(docs, folder)
    back = csvparts.read_csv_parts(s, f"{folder}/*.csv", "doc_id long, text string, lang string", chunk_bytes=100_000, bad_rows="bad")
    return back.select("doc_id", F.md5("text").alias("text_md5"), F.nullif("lang", F.lit("")).alias("lang"), F.col("bad").isNull().alias("good"))


@query
def s14_required_columns(s, d):
    return tables.row_and_column_count(tables.require_columns(w.table(s, d, "pages"), ["url", "html"]))


@query
def s15_processed_state(s, d):
    folder = shared_folder(s, "state-")
    docs = w.table(s, d, "documents", "doc_id", "lang")
    tables.append_parquet(docs.join(w.table(s, d, "labels", "doc_id"), "doc_id", "left_semi").select("doc_id"), folder)
    return clean.not_among(docs, tables.read_parquet(s, folder), "doc_id")


# --------------------------------------------------------------- extraction
@query
def h01_decode_bytes(s, d):
    # A byte that is no UTF-8 in front of each text.
    broken = F.concat(F.unhex(F.lit("FF")), F.encode("text", "UTF-8"))
    docs = tables.spread(w.table(s, d, "documents", "doc_id", "text"))
    return docs.select("doc_id", F.md5(html.decode(broken)).alias("text_md5"))


@query
def h02_split_payload(s, d):
    records = w.page_records(s, d)
    return records.select("page_id", F.md5(html.header_block(F.col("payload"))).alias("headers_md5"),
                          F.md5(html.body(F.col("payload"))).alias("html_md5"))


@query
def h03_header_lookup(s, d):
    return extract.split_payload(w.page_records(s, d)).select("page_id", "content_type", "server")


@query
def h04_xml_test(s, d):
    # The inner part of each page, once as HTML and once behind an XML mark.
    bodies = F.array(F.col("html"), F.concat(F.lit("\n <?xml version='1.0'?>"), "html"), F.concat(F.lit(" <rss>"), "html"))
    pages = w.table(s, d, "pages", "page_id", "html").select("page_id", F.posexplode(bodies).alias("kind", "html"))
    return pages.select("page_id", "kind", html.is_xml(F.col("html")).cast("int").alias("is_xml"))


@query
def h05_title(s, d):
    return html.with_title(w.table(s, d, "pages", "page_id", "html")).select("page_id", "title")


@query
def h06_meta_description(s, d):
    pages = extract.split_payload(w.page_records(s, d))
    return html.with_meta_description(pages).select("page_id", "meta_description")


@query
def h07_drop_hidden_elements(s, d):
    return w.table(s, d, "pages", "page_id", "html").select(
        "page_id", F.md5(F.regexp_replace(html.drop_hidden(F.col("html")), r"\s+", "")).alias("rest_md5"))


@query
def h08_visible_text(s, d):
    return html.with_visible_text(tables.spread(w.table(s, d, "pages", "page_id", "html"))).select(
        "page_id", F.md5("visible_text").alias("text_md5"))


@query
def h09_first_sentences(s, d):
    return html.with_snippet(tables.spread(w.table(s, d, "pages", "page_id", "html"))).select("page_id", "snippet")


@query
def h10_domain(s, d):
    return w.table(s, d, "pages", "page_id", "url").select("page_id", u.domain(F.col("url")).alias("domain"))


@query
def h11_h12_usable_pages(s, d):
    return extract.usable(w.page_parts(s, d)).select("page_id", "title", "snippet")


def _language_model(s, d):
    return language.train(tables.spread(w.table(s, d, "documents", "text", "lang")))


@query
def h13_language(s, d):
    trained = _language_model(s, d)
    pages = extract.usable(w.page_parts(s, d)).select("page_id", "snippet")
    return language.with_language(pages, trained).select("page_id", "language")


@query
def h14_cap_per_domain(s, d):
    pages = w.page_records(s, d).withColumn("domain", u.domain(F.col("url")))
    return extract.cap_per_domain(pages, 2).select("warc_file", "domain", "page_id")


@query
def h14_cap_per_domain_in_corpus(s, d):
    pages = w.page_records(s, d).withColumn("domain", u.domain(F.col("url")))
    return extract.cap_per_domain(pages, 5, "corpus").select("domain", "page_id")


@query
def h15_sanitise(s, d):
    docs = tables.spread(w.table(s, d, "documents", "doc_id", "text"))
    return tx.with_sanitised(docs, "text").select("doc_id", F.md5("text").alias("text_md5"))


@query
def h15_sanitise_page_fields(s, d):
    return extract.sanitised(w.page_parts(s, d)).select("page_id", "title", "snippet", "meta_description")


@query
def h16_truncate(s, d):
    docs = w.table(s, d, "documents", "doc_id", "text")
    cut = extract.truncated(docs.select("doc_id", F.col("text").alias("title"), F.col("text").alias("snippet"),
                                        F.when(F.col("doc_id") % 2 == 0, F.col("text")).alias("meta_description")))
    return cut.select("doc_id", *[F.md5(c).alias(c) for c in ("title", "snippet", "meta_description")])


# Bodies that are lost for a reason, with the remainders of the page ids that get them; the first one counts.
LOST_BODIES = [
    (5, 2, "unknown language", "<title>Новости</title><p>Сегодня в городе открыли новый мост через реку. Движение начнётся завтра.</p>"),
    (7, 3, "no title", "<title> </title><p>A page without a title, whose text is long enough.</p>"),
    (11, 4, "xml page", "<?xml version='1.0'?><title>Feed</title><p>An item of a feed that is long enough.</p>"),
    (13, 5, "short snippet", "<title>S</title><p>Few.</p>"),
]


@query
def h17_rejected_rows(s, d):
    """What becomes of every record of damaged archives, by reason; some pages have bodies that are lost."""
    records = warc.read_warc(s, _warc_folder(s, d, damaged=True), rejects=True)
    page = F.split_part("warc_id", F.lit(":"), F.lit(2)).cast("long")
    payload = F.when(F.col("payload").isNull(), None)
    for divisor, rest, _, body in LOST_BODIES:
        payload = payload.when(page % divisor == rest, F.lit("HTTP/1.1 200 OK\r\n\r\n" + body).cast("binary"))
    return corpus.extraction_report(records.withColumn("payload", payload.otherwise(F.col("payload"))), _language_model(s, d), 2)


# ---------------------------------------------------------------- labelling
def _labelling_input(s, d):
    pages = w.page_parts(s, d)
    return pages.select("page_id", "record_no", "url", "title", "snippet", F.lit("en").alias("language"), "meta_description")


@query
def l01_prompt(s, d):
    return _labelling_input(s, d).select("page_id", labelling.prompt().alias("prompt"))


@query
def l02_label_pages(s, d):
    pages = w.table(s, d, "pages", "page_id", "url", "html")
    pages = html.with_title(pages).select("page_id", "url", "title")
    return labelling.label_pages(pages, labelling.keyword_labeller(KEYWORDS)).select("page_id", "category")


@query
def l03_validate_labels(s, d):
    # The given label texts, and the same with one more label, in lower case, and empty.
    texts = F.array(F.col("category"), F.concat("category", F.lit(",News")), F.lower("category"), F.lit(""))
    rows = w.labelled_pages(s, d).select("page_id", F.posexplode(texts).alias("kind", "category"))
    return rows.select("page_id", "kind", labelling.is_valid(F.col("category")).cast("int").alias("is_valid"))


@query
def l04_pending_rows(s, d):
    docs = w.table(s, d, "documents", "doc_id", "lang")
    return labelling.pending(docs, w.table(s, d, "labels", "doc_id"), "doc_id", target=11_000)


@query
def l05_successful_labels(s, d):
    rows = w.labelled_pages(s, d).withColumn("category", F.concat("category", F.lit(",News")))
    return labelling.successful(rows).select("page_id", "category")


@query
def l06_clean_labels(s, d):
    return _text(w.label_lists(s, d).select("page_id", "category"), "category")


@query
def l07_parse_bracketed_labels(s, d):
    rows = w.labelled_pages(s, d).withColumn("category", F.concat(F.lit("["), "category", F.lit("]")))
    return _text(rows.select("page_id", labelling.parse_bracketed(F.col("category")).alias("category")), "category")


# ----------------------------------------------------------------- cleaning
@query
def c01_drop_columns(s, d):
    records = extract.split_payload(w.page_records(s, d))
    return records.drop("content_type", "server", "html", "warc_date")


@query
def c02_drop_nulls(s, d):
    return clean.drop_nulls(w.dup_pages(s, d), ["url", "warc_id"])


@query
def c03_keep_first(s, d):
    return clean.keep_first(w.dup_pages(s, d), "url", "page_id")


@query
def c04_deduplicate_twice(s, d):
    return clean.deduplicated(clean.drop_nulls(w.dup_pages(s, d), ["url", "warc_id"]), "page_id")


@query
def c05_cast_to_text(s, d):
    return clean.as_text(w.table(s, d, "documents", "doc_id", "n_chars", "lang"), ["doc_id", "n_chars", "lang"])


@query
def c06_head(s, d):
    return clean.head(w.table(s, d, "pages", "page_id", "url"), 5, "page_id")


@query
def c06_tail(s, d):
    return clean.tail(w.table(s, d, "pages", "page_id", "url"), 5, "page_id")


@query
def c07_describe_numbers(s, d):
    pages = features.with_url_features(w.table(s, d, "pages", "url"))
    out = clean.describe_numbers(pages, ["url_length", "path_depth", "query_count", "url_digit_count", "url_special_count"])
    return _round(out, "mean", "std", "q1", "median", "q3")


@query
def c07_describe_texts(s, d):
    return clean.describe_texts(w.table(s, d, "documents", "lang", "source"), ["lang", "source"])


@query
def c08_select_and_rename(s, d):
    return w.labelled_pages(s, d).select(F.col("page_id").alias("id"), F.col("url").alias("address"), F.col("category").alias("labels"))


@query
def c09_allowed_values(s, d):
    return clean.among(w.table(s, d, "documents", "doc_id", "lang"), "lang", ["en", "fr"])


@query
def c10_not_processed(s, d):
    return clean.not_among(w.table(s, d, "documents", "doc_id", "lang"), w.table(s, d, "labels", "doc_id"), "doc_id")


@query
def c11_union(s, d):
    return clean.appended(w.table(s, d, "documents", "doc_id", "lang"),
                          w.table(s, d, "benchmark").select(F.col("item_id").alias("doc_id"), F.char_length("text").alias("n_chars")))


# ----------------------------------------------------------------- features
def _titles(s, d):
    return html.with_title(w.table(s, d, "pages", "page_id", "url", "html")).drop("html")


@query
def f01_lengths(s, d):
    return _titles(s, d).select("page_id", F.char_length("url").alias("url_length"), F.char_length("title").alias("title_length"))


@query
def f02_url_parts(s, d):
    return w.table(s, d, "pages", "page_id", "url").select(
        "page_id", u.domain(F.col("url")).alias("domain"), u.path(F.col("url")).alias("path"), u.query(F.col("url")).alias("query"))


@query
def f03_path_depth(s, d):
    return w.table(s, d, "pages", "page_id", "url").select("page_id", u.path_depth(F.col("url")).alias("path_depth"))


@query
def f04_query_count(s, d):
    return w.table(s, d, "pages", "page_id", "url").select("page_id", u.query_count(F.col("url")).alias("query_count"))


@query
def f05_digit_counts(s, d):
    return _titles(s, d).select("page_id", tx.digit_count(F.col("url")).alias("url_digit_count"),
                                tx.digit_count(F.col("title")).alias("title_digit_count"))


@query
def f06_punctuation_counts(s, d):
    return _titles(s, d).select("page_id", tx.punctuation_count(F.col("url")).alias("url_special_count"),
                                tx.punctuation_count(F.col("title")).alias("title_punctuation_count"))


@query
def f07_word_count(s, d):
    docs = tables.spread(w.table(s, d, "documents", "doc_id", "text"))
    return docs.select("doc_id", tx.word_count(F.col("text")).alias("n_words"))


@query
def f08_average_word_length(s, d):
    return _round(_titles(s, d).select("page_id", tx.average_word_length(F.col("title")).alias("title_avg_word_len")),
                  "title_avg_word_len")


@query
def f09_all_features(s, d):
    return _round(features.with_features(_titles(s, d)).drop("url", "title"), "title_avg_word_len")


@query
def f10_model_text(s, d):
    return _titles(s, d).select("page_id", tx.model_text(F.col("url"), F.col("title")).alias("text"),
                                tx.model_text(F.col("url"), F.col("title"), ": ").alias("visit_text"))


@query
def f11_template_text(s, d):
    url = F.col("url")
    return _titles(s, d).select("page_id", tx.template_text(u.domain(url), u.path(url), F.col("title")).alias("text"))


@query
def f12_split_at_separator(s, d):
    parts = tx.split_first(tx.model_text(F.col("url"), F.col("title")))
    return _titles(s, d).select("page_id", parts[0].alias("before"), parts[1].alias("after"))


@query
def f13_label_index(s, d):
    lists = analysis.exploded(w.label_lists(s, d).select("page_id", "category"))
    return lists.select("page_id", "category", index_of(F.col("category")).alias("label_idx"))


@query
def f14_multi_hot(s, d):
    hot = labelling.multi_hot(F.col("category")).cast("array<int>")
    return _text(w.label_lists(s, d).select("page_id", hot.alias("label_vector")), "label_vector")


@query
def f15_split(s, d):
    return features.with_split(w.table(s, d, "pages", "page_id", "url")).select("page_id", "split")


@query
def f15_split_sizes(s, d):
    return features.split_sizes(features.with_split(w.table(s, d, "documents", "doc_id"), "doc_id"))


@query
def f16_tokens(s, d):
    docs = tables.spread(w.table(s, d, "documents", "doc_id", "text"))
    found = tx.tokens(F.col("text"), 512)
    return docs.select("doc_id", found.alias("t")).select(
        "doc_id", F.size("t").alias("n_tokens"), F.md5(F.array_join("t", " ")).alias("tokens_md5"))


@query
def f17_sigmoid(s, d):
    x = F.col("o_totalprice").cast("double") / 100000 - 2
    return _round(w.table(s, d, "orders", "o_orderkey", "o_totalprice").select("o_orderkey", v.sigmoid(x).alias("p")), "p")


@query
def f18_threshold(s, d):
    long = scoring.long_results(w.scored(s, d), "page_id")
    return long.select("page_id", "label", v.threshold(F.col("prob")).alias("pred"),
                       v.threshold(F.col("prob"), 0.5, inclusive=False).alias("pred_over"))


@query
def f19_norm(s, d):
    return _round(w.table(s, d, "embeddings").select("vec_id", v.norm(v.as_double(F.col("embedding"))).alias("norm")), "norm")


@query
def f20_round(s, d):
    return w.table(s, d, "events", "event_id", "value").select("event_id", v.rounded(F.col("value"), 1).alias("value"))


@query
def f21_formats(s, d):
    n = F.col("n_chars")
    return w.table(s, d, "documents", "doc_id", "n_chars").select(
        "doc_id", v.thousands(n * 1000).alias("thousands"), v.percent(n / 40000.0, 1).alias("percent"))


# ----------------------------------------------------------- label analysis
@query
def a01_row_and_column_count(s, d):
    return tables.row_and_column_count(w.table(s, d, "documents"))


@query
def a02_null_counts(s, d):
    return clean.null_counts(w.dup_pages(s, d), ["url", "warc_id"])


@query
def a03_explode_labels(s, d):
    return analysis.exploded(w.label_lists(s, d))


@query
def a04_label_counts(s, d):
    return analysis.label_counts(w.label_lists(s, d))


@query
def a05_allowed_label_counts(s, d):
    return analysis.label_counts(w.label_lists(s, d), LABELS)


@query
def a06_sorted_counts(s, d):
    return analysis.by_count(analysis.label_counts(w.label_lists(s, d), LABELS))


@query
def a07_label_shares(s, d):
    return _round(analysis.label_shares(w.label_lists(s, d)).drop("text"), "percent")


@query
def a08_pages_by_label_number(s, d):
    return analysis.pages_by_label_number(w.label_lists(s, d))


@query
def a09_cooccurrence(s, d):
    return analysis.cooccurrence(w.label_lists(s, d))


@query
def a10_conditional_probability(s, d):
    return _round(analysis.conditional_probability(w.label_lists(s, d)), "p")


@query
def a11_label_combinations(s, d):
    return analysis.combination_counts(w.label_lists(s, d))


@query
def a12_top_combinations(s, d):
    return analysis.top_combinations(w.label_lists(s, d), 15)


@query
def a13_box_statistics(s, d):
    out = analysis.box_statistics(w.label_features(s, d), ["title_length", "url_length", "url_special_count", "title_word_count"])
    return _round(out, "q1", "median", "q3", "whisker_low", "whisker_high")


@query
def a14_lower_triangle(s, d):
    return analysis.lower_triangle(analysis.cooccurrence(w.label_lists(s, d)))


@query
def a15_multi_label_samples(s, d):
    return metrics.multi_label_samples(w.scored(s, d))


# --------------------------------------------------------- training, scores
def _examples(s, d):
    """Pages with text and the local labeller's labels."""
    labelled = tables.spread(_titles(s, d)).withColumn("category", labelling.keyword_labels(KEYWORDS))
    return labelled.withColumns({
        "text": tx.model_text(F.col("url"), F.col("title")),
        "label_vector": labelling.multi_hot(labelling.clean_labels(F.col("category")))})


@query
def m01_train_classifier(s, d):
    examples = features.with_split(_examples(s, d))
    trained = model.train(examples, held_out=F.col("split") == "validation")
    held_out = trained.transform(examples.filter("split = 'validation'"))
    held_out = held_out.withColumn("y", F.col("label_vector").cast("array<int>"))
    return metrics.count_metrics(metrics.confusion(held_out)).unionByName(metrics.exact_match(held_out))


@query
def m01_trained_labels(s, d):
    """Examples and scores by label, and whether the training did what it should: every epoch has a lower loss, training
    ends by itself, and the epoch kept is the best one on the rows held out and better than no training."""
    examples = features.with_split(_examples(s, d)).persist()
    most = 200
    trained = model.train(examples, held_out=F.col("split") == "validation", epochs=most)
    loss = [h[1] for h in trained.history]
    f1 = [h[2] for h in trained.history]
    kept = next(h for h in trained.history if h[3])
    scored = trained.transform(examples).select("split", F.posexplode("label_vector").alias("label_idx", "y"), "prob")
    is_held = F.col("split") == "validation"
    prob = F.get("prob", F.col("label_idx"))
    return scored.groupBy("label_idx").agg(
        F.count(F.when(~is_held, 1)).alias("n_train"), F.count(F.when(is_held, 1)).alias("n_validation"),
        F.sum(F.when(~is_held, F.col("y")).otherwise(0)).cast("long").alias("y_train"),
        F.sum(F.when(is_held, F.col("y")).otherwise(0)).cast("long").alias("y_validation"),
        F.count(F.when(prob.between(0, 1), 1)).alias("n_scored"),
    ).withColumns({"loss_falls": F.lit(all(b < a for a, b in zip(loss, loss[1:]))), "ends_by_itself": F.lit(1 < len(loss) <= most),
                   "kept_is_best": F.lit(kept[2] == max(f1[1:]) and kept[2] > f1[0])})


@query
def m02_score_with_trained_model(s, d):
    """Pages scored by a model that was trained, saved as a version, and loaded again; for each label the pages scored, and
    whether probabilities tell pages that have the label from those that do not."""
    examples = _examples(s, d).persist()
    store = shared_folder(s, "models-")
    model.train(examples, epochs=20).save(s, store, "1")
    scored = model.MultiLabelModel.load(s, store, "1").transform(examples)
    rows = scored.select(F.posexplode("prob").alias("label_idx", "prob"), "label_vector")
    y = F.get("label_vector", F.col("label_idx"))
    with_label, without = F.avg(F.when(y == 1, F.col("prob"))), F.avg(F.when(y == 0, F.col("prob")))
    return rows.groupBy("label_idx").agg(F.count("prob").alias("n"), F.coalesce(with_label > without, F.lit(True)).alias("tells_apart"))


@query
def m02_score_pages(s, d):
    def open_scorer():
        # A stand-in session: one logit per label from the text's length and letters.
        return lambda texts: [[(len(t) * (i + 3) % 11 + t.count("t") % (i + 2)) / 4 - 1.5 for i in range(len(LABELS))] for t in texts]
    scored = model.score_with(_titles(s, d).withColumn("text", tx.model_text(F.col("url"), F.col("title"))), open_scorer)
    return _round(scored.select("page_id", F.posexplode("prob").alias("label_idx", "prob")), "prob")


@query
def m03_labels_over_threshold(s, d):
    prob = F.col("prob")
    over = scoring.probabilities_over(prob)
    rows = w.scored(s, d).select("page_id", scoring.labels_over(prob).alias("labels"), F.round(v.total(F.map_values(over)), 6).alias("sum_prob"))
    return _text(rows, "labels")


@query
def m04_labels_or_best(s, d):
    return _text(w.scored(s, d).select("page_id", scoring.labels_or_best(F.col("prob"), 0.9).alias("labels")), "labels")


@query
def m05_best_label(s, d):
    return w.scored(s, d).select("page_id", scoring.best_label(F.col("prob")).alias("label"),
                                 scoring.best_with_percent(F.col("prob")).alias("message"))


@query
def m06_wide_results(s, d):
    return scoring.wide_results(w.scored(s, d), ("page_id",))


@query
def m07_compare_models(s, d):
    a = metrics.count_metrics(metrics.confusion(w.scored(s, d, "a")))
    b = metrics.count_metrics(metrics.confusion(w.scored(s, d, "b")))
    return _round(metrics.compared(a, b).filter(F.col("metric").isin("hamming_loss", "f1_macro", "f1_weighted")), "trained", "baseline")


@query
def m08_best_model(s, d):
    both = None
    for name in ("a", "b"):
        rows = metrics.count_metrics(metrics.confusion(w.scored(s, d, name))).withColumn("model", F.lit(name))
        both = rows if both is None else both.unionByName(rows)
    return _round(metrics.best_model(both), "value")


@query
def m09_sample_report(s, d):
    rows = w.scored(s, d).join(w.table(s, d, "pages", "page_id", "url"), "page_id")
    report = scoring.sample_report(rows, "page_id", keep=("url",))
    report = report.withColumn("prob", F.transform("prob", lambda p: F.round(p * 10000, 0).cast("int")))
    return _text(report, "y", "pred", "prob")


# ------------------------------------------------------------------ metrics
def _metric(names):
    def run(s, d):
        rows = metrics.count_metrics(metrics.confusion(w.scored(s, d)))
        return _round(rows.filter(F.col("metric").isin(names)), "value")
    return run


for _name, _metrics in {
    "e01_hamming_loss": ["hamming_loss"],
    "e03_micro_averages": ["precision_micro", "recall_micro", "f1_micro", "precision_micro_pos", "recall_micro_pos", "f1_micro_pos"],
    "e04_macro_averages": ["precision_macro", "recall_macro", "f1_macro"],
    "e05_weighted_averages": ["precision_weighted", "recall_weighted", "f1_weighted"],
    "e08_jaccard": ["jaccard_micro", "jaccard_macro"],
}.items():
    QUERIES[_name] = _metric(_metrics)


@query
def e02_exact_match(s, d):
    return _round(metrics.exact_match(w.scored(s, d)), "value")


@query
def e06_roc_auc(s, d):
    return _round(metrics.area_metrics(w.scored(s, d)).filter(F.col("metric").startswith("roc")), "value")


@query
def e07_pr_auc(s, d):
    return _round(metrics.area_metrics(w.scored(s, d)).filter(F.col("metric").startswith("pr")), "value")


@query
def e09_f1_per_label(s, d):
    return _round(metrics.f1_per_label(metrics.confusion(w.scored(s, d))), "value")


@query
def e10_all_metrics(s, d):
    return metrics.all_metrics(w.scored(s, d))


@query
def e11_confusion_matrix(s, d):
    return metrics.confusion_cells(metrics.confusion(w.scored(s, d)))


@query
def e12_label_report(s, d):
    return _round(metrics.label_report(w.scored(s, d, "b")), "precision", "recall", "accuracy", "f1")


@query
def e13_agreement(s, d):
    a, b = w.scored(s, d, "a"), w.scored(s, d, "b")
    return _round(metrics.agreement(metrics.joined_predictions(a, b, "page_id")), "agreement")


# --------------------------------------------------------------- embeddings
def _pairs(s, d):
    return embedding.cosine_pairs(w.categories(s, d), "label")


@query
def v01_encode_texts(s, d):
    def encode(texts):
        # A stand-in encoder: letter shares.
        letters = "etaoinsr"
        return [[t.count(x) / max(len(t), 1) for x in letters] for t in texts]
    rows = embedding.encoded(_titles(s, d).select("page_id", "title"), encode, "title")
    return _round(rows.select("page_id", F.posexplode("embedding").alias("pos", "x")).withColumn("x", F.col("x").cast("double")), "x", digits=5)


@query
def v02_cosine_distances(s, d):
    return _round(_pairs(s, d), "distance")


@query
def v03_distance_matrix(s, d):
    return _round(embedding.square_matrix(_pairs(s, d), w.categories(s, d), "label"), "distance")


@query
def v04_projection(s, d):
    rows = embedding.projected(w.table(s, d, "embeddings"))
    return rows.select("vec_id", F.round(F.col("projection")[0], 6).alias("x"), F.round(F.col("projection")[1], 6).alias("y"))


@query
def v05_density_clusters(s, d):
    return embedding.density_clusters(_pairs(s, d), w.categories(s, d), "label", EPS)


@query
def v06_centroids(s, d):
    means = embedding.centroids(w.clustered(s, d))
    return _round(means.select("cluster", "n", F.posexplode("embedding").alias("pos", "mean")), "mean")


@query
def v07_centroid_distances(s, d):
    return _round(embedding.cosine_pairs(embedding.centroids(w.clustered(s, d)), "cluster"), "distance")


@query
def v08_silhouette(s, d):
    return _round(embedding.silhouette(w.clustered(s, d), "vec_id"), "silhouette")


@query
def v09_distance_histogram(s, d):
    return _round(embedding.histogram(_pairs(s, d)), "low", "high")


@query
def v09_distance_density(s, d):
    return _round(embedding.density(_pairs(s, d)), "x", "density")


@query
def v10_neighbours(s, d):
    return _round(embedding.neighbours(_pairs(s, d)), "distance")


@query
def v11_extreme_pairs(s, d):
    return _round(embedding.extreme_pairs(_pairs(s, d)), "distance")


@query
def v12_cluster_members(s, d):
    return embedding.cluster_members(w.clustered(s, d), "vec_id")


# --------------------------------------------------------- attention scores
def _focus(s, d):
    return scorematrix.focus_scores(w.attention(s, d))


def _cross(s, d):
    return scorematrix.cross_segment_scores(scorematrix.with_separator(w.attention(s, d)))


@query
def i01_first_token_entropy(s, d):
    return _round(scorematrix.entropies(w.attention(s, d)), "entropy")


@query
def i02_focus_scores(s, d):
    return _round(_focus(s, d), "score")


@query
def i03_scaled_scores(s, d):
    return _round(scorematrix.scaled(_focus(s, d)), "score")


@query
def i04_separator(s, d):
    return w.tokens(s, d).select("example", scorematrix.separator(F.col("tokens")).alias("sep"), F.size("tokens").alias("n_tokens"))


@query
def i05_cross_segment_scores(s, d):
    return _round(_cross(s, d), "score", digits=8)


@query
def i06_scaled_by_head(s, d):
    return _round(scorematrix.scaled_by_head(_focus(s, d)), "score", digits=5)


@query
def i07_combined_scores(s, d):
    both = scorematrix.combined(scorematrix.scaled_by_head(_focus(s, d)), scorematrix.scaled_by_head(_cross(s, d)))
    return _round(both, "score", digits=5)


@query
def i08_top_heads(s, d):
    return _round(scorematrix.top_heads(_focus(s, d), 3), "score")


@query
def i09_heads_in_both(s, d):
    return scorematrix.in_both(scorematrix.top_heads(_focus(s, d), 4), scorematrix.top_heads(_cross(s, d), 4))


@query
def i10_heads_in_either(s, d):
    return scorematrix.in_either(scorematrix.top_heads(_focus(s, d), 3), scorematrix.top_heads(_cross(s, d), 3))


@query
def i11_attention_from_first(s, d):
    return _round(scorematrix.attention_from_first(w.attention(s, d), w.N_LAYERS), "weight")


@query
def i11_attention_to_separator(s, d):
    rows = scorematrix.with_separator(w.attention(s, d))
    return _round(scorematrix.attention_to_separator(rows, w.N_LAYERS), "weight")


@query
def i12_token_report(s, d):
    rows = scorematrix.token_report(w.gradients(s, d))
    return rows.select("example", "label", F.posexplode("report").alias("place", "t")).select(
        "example", "label", "place", "t.token", F.round("t.importance", 6).alias("importance"))


# ---------------------------------------------------------------- streaming
@query
def t01_score_visits(s, d):
    folder, out, state = (shared_folder(s, f"{n}-") for n in ("visits", "scored", "state"))
    w.visits(s, d).repartition(4).write.mode("overwrite").parquet(folder)

    def score(rows):
        # A stand-in model: probabilities from the length of the text.
        n = F.char_length("text")
        return rows.withColumn("prob", F.transform(
            label_array(), lambda _, i: ((n * 7919 + n * i * 31 + i * 104729) % 997).cast("double") / 1000))

    arriving = visits.read_visits(s, folder, max_files_per_trigger=2)
    visits.write_scored(visits.scored_visits(arriving, score), out, state).awaitTermination()
    return s.read.parquet(out).select("tab_id", "text", "label", "message")


@query
def t02_extract_new_files(s, d):
    folder = _warc_folder(s, d)
    out, state = shared_folder(s, "extracted-"), shared_folder(s, "state-")
    trained = _language_model(s, d)
    for _ in range(2):  # The second run finds nothing new.
        crawl.extract_new_files(s, folder, out, state, trained, max_per_domain=2,
                                max_files_per_trigger=8).awaitTermination()
    return s.read.parquet(out).select(*schemas.EXTRACTED.fieldNames())


@query
def t02_stop_at_target(s, d):
    """A stream that stops within one file of its target: files in the order of their paths, all in one batch."""
    folder = _warc_folder(s, d)
    out, state = shared_folder(s, "extracted-"), shared_folder(s, "state-")
    target = w.table(s, d, "pages", "page_id").count() // 3
    crawl.extract_new_files(s, folder, out, state, _language_model(s, d), max_per_domain=2, target=target, max_files_per_trigger=1 << 16).awaitTermination()
    return s.read.parquet(out).select("url", "warc_id")


@query
def t03_label_pending(s, d):
    out = shared_folder(s, "labelled-")
    pages = _labelling_input(s, d).drop("page_id")
    target = w.table(s, d, "pages", "page_id").count()
    for share in (2, 1):  # Half of the rows first, then the rest.
        crawl.label_pending(pages, out, labelling.keyword_labeller(KEYWORDS), target=target // share)
    return s.read.parquet(out).select("record_no", "url", "category")


# -------------------------------------------------------------------- flows
@query
def extracted_corpus(s, d):
    trained = _language_model(s, d)
    pages = corpus.extracted_pages(tables.spread(w.page_records(s, d)), trained, 2)
    return pages.select("record_no", "url", "title", "snippet", "language", "content_type", "server", "meta_description")


@query
def label_profile(s, d):
    """The flagship: pages to title, snippet, language, cap, labels and features, and a profile per label."""
    trained = _language_model(s, d)
    pages = corpus.extracted_pages(tables.spread(w.page_records(s, d)), trained)
    named = pages.withColumn("category", labelling.keyword_labels(KEYWORDS))
    return corpus.label_profile(corpus.cleaned_features(labelling.successful(named), "record_no"))
