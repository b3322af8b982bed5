import gzip

import pytest
from pyspark.sql import functions as F, types as T

from pagelens import schemas
from pagelens.operators import labelling, language
from pagelens.plans import corpus
from pagelens.sources import tables, warc
from pagelens.streaming import crawl, visits


@pytest.fixture(scope="module")
def language_model(spark):
    data = [("the house and the garden are near the river " * 3, "en"), ("the cat and the dog with that thing", "en"),
            ("das haus und der garten sind nicht weit weg " * 3, "de"), ("der hund und die katze mit dem ding", "de")]
    return language.train(spark.createDataFrame(data, "text string, lang string"))


def test_language(spark, language_model):
    df = spark.createDataFrame([(1, "the river and the dog"), (2, "der hund und das haus"), (3, ""), (4, None), (5, "12 !")], "id int, snippet string")
    got = {r.id: r.language for r in language.with_language(df, language_model).collect()}
    assert got == {1: "en", 2: "de", 3: None, 4: None, 5: None}


def write_warc(path, pages):
    with gzip.open(path, "wb") as out:
        for i, (url, html) in enumerate(pages):
            block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n{html}".encode()
            out.write((f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: {url}\r\nWARC-Record-ID: {url}#{i}\r\n"
                       f"Content-Length: {len(block)}\r\n\r\n").encode() + block + b"\r\n\r\n")


def page(n):
    return f"<title>Page {n}</title><p>The house and the garden number {n}.</p>"


def test_only_new_files_are_extracted(spark, tmp_path, language_model):
    folder, out, state = tmp_path / "warc", str(tmp_path / "out"), str(tmp_path / "state")
    folder.mkdir()
    write_warc(folder / "a.warc.gz", [(f"http://h/{i}", page(i)) for i in range(6)] + [("http://x/", "<p>no title</p>")])
    write_warc(folder / "b.warc.gz", [(f"http://h/b{i}", page(i)) for i in range(2)])

    def run(**options):
        crawl.extract_new_files(spark, str(folder), out, state, language_model, max_per_domain=4, **options).awaitTermination()
        return sorted(r.url for r in spark.read.parquet(out).collect())

    first = run()
    assert first == sorted([f"http://h/{i}" for i in range(4)] + ["http://h/b0", "http://h/b1"])
    assert run() == first
    write_warc(folder / "c.warc.gz", [("http://n/", page(9))])
    assert run() == sorted(first + ["http://n/"])
    write_warc(folder / "d.warc.gz", [("http://m/", page(9))])
    assert run(target=5) == sorted(first + ["http://n/"])

    batch = corpus.extracted_pages(warc.read_warc(spark, f"{folder}/a.warc.gz,{folder}/b.warc.gz"), language_model, 4)
    assert sorted(r.url for r in batch.collect()) == first
    assert set(schemas.EXTRACTED.fieldNames()) <= set(batch.columns)


def test_extraction_stops_within_a_file_of_the_target(spark, tmp_path, language_model):
    folder, out = tmp_path / "warc", str(tmp_path / "out")
    folder.mkdir()
    for name in "dacb":
        write_warc(folder / f"{name}.warc.gz", [(f"http://{name}{i}/", page(i)) for i in range(3)])

    def run(target):
        crawl.extract_new_files(spark, str(folder), out, str(tmp_path / "state"), language_model, target=target).awaitTermination()
        return sorted(r.url for r in spark.read.parquet(out).collect())

    first = run(4)
    assert first == [f"http://{name}{i}/" for name in "ab" for i in range(3)]
    write_warc(folder / "e.warc.gz", [("http://e/", page(1))])
    assert run(6) == first
    write_warc(folder / "f.warc.gz", [("http://f/", page(1))])
    assert run(7) == first + ["http://f/"]


def test_repeated_appends_add_nothing_twice(spark, tmp_path):
    path = str(tmp_path / "table")
    tables.append_once(spark.range(5), path, "a")
    tables.append_once(spark.range(5, 8), path, "b")

    def failing(x):
        raise RuntimeError

    with pytest.raises(Exception):
        tables.append_once(spark.range(9).select(F.udf(failing, "long")("id").alias("id")), path, "c")
    tables.append_once(spark.range(5, 8), path, "b")
    tables.append_once(spark.range(8, 10), path, "c")
    assert sorted(r.id for r in tables.read_parquet(spark, path).collect()) == list(range(10))
    with pytest.raises(ValueError):
        tables.append_once(spark.range(1), path, "a/b")


def test_visits_as_stream_and_table(spark, tmp_path):
    data = [(1, "http://a/", "T", "complete"), (2, "http://b/", None, "complete"), (3, "http://c/", "T", "loading"),
            (4, "moz-extension://x", "T", "complete"), (5, None, "T", "complete"), (6, "", "T", "complete")]
    table = spark.createDataFrame(data, schemas.VISIT)
    table.repartition(3).write.parquet(str(tmp_path / "in"))

    def score(df):
        return df.withColumn("prob", F.array(*[F.lit(0.1 * i) for i in range(10)], F.lit(0.0)))

    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for _ in range(2):
        arriving = visits.read_visits(spark, str(tmp_path / "in"), 1)
        visits.write_scored(visits.scored_visits(arriving, score), out, state).awaitTermination()
    got = sorted((r.tab_id, r.text, r.message) for r in spark.read.parquet(out).collect())
    assert got == [(1, "http://a/: T", "Classified as: Travel (90.00%)"), (2, "http://b/: ", "Classified as: Travel (90.00%)")]
    assert got == sorted((r.tab_id, r.text, r.message) for r in visits.scored_visits(table, score).collect())


def test_labelling_resumes(spark, tmp_path):
    pages = spark.range(10).select(
        F.col("id").alias("record_no"), F.concat(F.lit("http://shop/"), F.col("id").cast("string")).alias("url"), F.lit("t").alias("title"),
        F.lit("s").alias("snippet"), F.lit("en").alias("language"), F.lit("").alias("meta_description"))
    out = str(tmp_path / "labelled")
    labeller = labelling.keyword_labeller({"shop": "Shop"})
    crawl.label_pending(pages, out, labeller, target=4)
    assert sorted(r.record_no for r in spark.read.parquet(out).collect()) == [0, 1, 2, 3]
    for _ in range(2):
        crawl.label_pending(pages, out, labeller, target=8, parallelism=2)
        assert sorted(r.record_no for r in spark.read.parquet(out).collect()) == list(range(8))
    with pytest.raises(ValueError, match="snippet"):
        crawl.label_pending(pages.drop("snippet"), out, labeller)


def test_cleaned_features(spark):
    data = [("http://h/a?x=1", "A title 1", "s", "en", "w1", "ct", "sv", "d", "", "News, Uncategorized", 1),
            ("http://h/a?x=1", "A copy", "s", "en", "w2", "ct", "sv", "d", "", "News", 2),
            ("http://h/b", None, "s", "en", "w3", "ct", "sv", "d", "", "News", 3)]
    schema = T.StructType(schemas.CLASSIFIED.fields + [T.StructField("record_no", T.IntegerType())])
    out = corpus.cleaned_features(spark.createDataFrame(data, schema), "record_no").collect()
    assert len(out) == 1
    r = out[0].asDict()
    assert r["category"] == ["News"] and "server" not in r
    assert (r["url_length"], r["domain"], r["path_depth"], r["query_count"], r["title_word_count"], r["title_digit_count"]) == (14, "h", 1, 1, 3, 1)
    assert tables.require_columns(corpus.cleaned_features(spark.createDataFrame(data, schema), "record_no"), ["title_avg_word_len"])
